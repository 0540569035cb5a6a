"""Toxic passages: maximum-scoring segments over token log-odds, calibrated as extreme values.

A token's log-odds come from the labelled documents that hold it, with Dirichlet priors: the
prior of a word are the counts of its longer beginning, that of a beginning those of a shorter
one, that of the shortest the labels as a whole. Words never seen thus score like their
beginnings. A text is a walk over its tokens' log-odds less a drift; one linear scan finds all
its maximal segments (a segment that no other one holds and no part of which falls below zero).

In clean texts the largest segment follows an extreme-value law, whose rate and constant are
fitted to clean training documents. It gives each segment an expected number of equals by
chance; the joint law of the best few gives the evidence of a text, and a logistic curve makes
it a probability. Training documents are scored without their own counts while fitting.

Learning reads at most ``MAX_ROWS`` labelled rows, those with the least hash of their id, and
keeps about ``MAX_NODES`` words and beginnings, those that tell most; what follows from them
covers every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathwake.llm.arrays import ASCII_LOWER, U64, mix, span_hashes, text_slices, word_spans
from pathwake.llm.language import held_out
from pathwake.runtime import stored

MAX_ROWS = 200_000
MAX_NODES = 400_000
BEGINNINGS = (6, 4)  # bytes
PRIOR = 8.0  # documents a prior counts for
DRIFT = 1.0
DECAY = 0.5  # of the chance of one more segment, as several numbers of segments are tried
CHANCE = 0.01  # expected equals by chance of a passage that is reported
RIDGE = 1e-3
_SEPARATORS = np.ones(256, dtype=bool)
_SEPARATORS[0x80:] = False
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
    _SEPARATORS[_low:_high + 1] = False


def _nodes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Keys of each word and of its beginnings, one row a level; 0 where the word is not longer."""
    keys = np.zeros((1 + len(BEGINNINGS), len(starts)), dtype=U64)
    keys[0] = span_hashes(data, starts, ends)
    for level, size in enumerate(BEGINNINGS, 1):
        longer = np.flatnonzero(ends - starts > size)
        keys[level, longer] = mix(span_hashes(data, starts[longer], starts[longer] + size) + U64(level))
    return keys.view(np.int64)


def _tokens(column: pa.Array) -> Iterator[tuple]:
    """``(first row, row after the last, bytes, bounds, starts, ends, first, nodes)`` of slices of texts."""
    for at, to, data, bounds in text_slices(column):
        lower = ASCII_LOWER[data]
        starts, ends, first = word_spans(lower, bounds, _SEPARATORS)
        yield at, to, data, bounds, starts, ends, first, _nodes(lower, starts, ends)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(node, toxic, clean)``: labelled documents of a batch that hold each node."""
    for batch in batches:
        labels = np.asarray(batch.column("toxic").to_pylist(), dtype=bool)
        for at, to, *_, first, nodes in _tokens(batch.column("text")):
            owner = np.tile(np.repeat(np.arange(to - at), np.diff(first)), len(nodes))
            flat = nodes.ravel()
            held = flat != 0
            owner, flat = owner[held], flat[held]
            once = np.unique(mix(flat.view(U64) + mix(owner.astype(U64))), return_index=True)[1]
            found, which = np.unique(flat[once], return_inverse=True)
            toxic = np.bincount(which, weights=labels[at:to][owner[once]], minlength=len(found)).astype(np.int64)
            total = np.bincount(which, minlength=len(found))
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(toxic), pa.array(total - toxic)], names=["node", "toxic", "clean"])


def segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments ``(score, start, end)`` of a walk, in linear time.

    Neighbours of one sign are added up first; a segment never begins or ends inside them.
    """
    if not (scores > 0).any():
        return []
    edges = np.flatnonzero(np.concatenate([[True], (scores[1:] > 0) != (scores[:-1] > 0)]))
    sums = np.add.reduceat(scores, edges).tolist()
    edges = [*edges.tolist(), len(scores)]
    # Of each segment: walk before it, walk after it, first and last run, last one that begins lower.
    kept: list[tuple[float, float, int, int, int]] = []
    walk = 0.0
    for i, value in enumerate(sums):
        before, walk = walk, walk + value
        if value <= 0:
            continue
        begin, low = i, len(kept) - 1
        while True:
            while low >= 0 and kept[low][0] >= before:
                low = kept[low][4]
            if low < 0 or kept[low][1] >= walk:
                break
            before, begin, low_next = kept[low][0], kept[low][2], kept[low][4]
            del kept[low:]
            low = low_next
        kept.append((before, walk, begin, i, low))
    return [(right - left, edges[begin], edges[end + 1]) for left, right, begin, end, _ in kept]


@dataclass(frozen=True)
class Model:
    nodes: np.ndarray  # sorted keys
    toxic: np.ndarray
    clean: np.ndarray
    share: float  # of toxic documents
    rate: float = 1.0
    constant: float = 0.1
    offset: float = 0.0
    slope: float = 1.0

    def log_odds(self, keys: np.ndarray, own: bool | None = None) -> np.ndarray:
        """Log-odds of words; ``own`` takes one document of that label out of all counts."""
        share = np.full(keys.shape[1], self.share)
        for level in range(len(keys) - 1, -1, -1):
            at = np.searchsorted(self.nodes, keys[level])
            at[at == len(self.nodes)] = 0
            known = (self.nodes[at] == keys[level]) & (keys[level] != 0) if len(self.nodes) else np.zeros(len(at), bool)
            toxic, clean = (np.where(known, c[at], 0) if len(c) else np.zeros(len(at)) for c in (self.toxic, self.clean))
            if own is not None:
                toxic, clean = np.maximum(toxic - (known & own), 0), np.maximum(clean - (known & (not own)), 0)
            share = (toxic + PRIOR * share) / (toxic + clean + PRIOR)
        return np.log(share / (1 - share)) - np.log(self.share / (1 - self.share))

    def expected(self, score: np.ndarray, words: int) -> np.ndarray:
        """Logarithm of the number of such segments by chance."""
        return np.log(self.constant * max(words, 1)) - self.rate * score

    def evidence(self, scores: list[float], words: int) -> float:
        """-log of the chance of the best few segments together; 0 without any."""
        if not scores:
            return 0.0
        sums = -np.cumsum(self.expected(np.sort(np.array(scores))[::-1], words))
        n = np.arange(1, len(sums) + 1)
        products = np.cumsum(np.log(n))  # log n!
        joint = sums + products + products - np.log(n) - (n - 1) * np.log(np.maximum(sums, 1.0)) + (n - 1) * np.log(DECAY)
        return float(max(0.0, np.where(sums >= n, joint, 0.0).max()))

    def probability(self, evidence: np.ndarray | float) -> np.ndarray | float:
        return 1 / (1 + np.exp(-(self.offset + self.slope * np.log1p(evidence))))


def extreme_values(largest: np.ndarray, words: np.ndarray) -> tuple[float, float]:
    """Rate and constant of the law of the largest segment, by likelihood; 0 means no segment."""
    found = largest > 0
    if not found.any():
        return 1.0, 1.0 / max(float(words.sum()), 1.0)
    many, total = int(found.sum()), float(largest.sum())

    def slope(rate: float) -> float:
        weights = words * np.exp(-rate * largest)
        return many / rate - total + many * float((weights * largest).sum() / weights.sum())

    low, high = 0.01, 20.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if slope(middle) > 0 else (low, middle)
    # Log-odds are at best the true ones, for which the rate is 1.
    rate = min(low, 1.0)
    return rate, max(many / float((words * np.exp(-rate * largest)).sum()), 1e-9)


def logistic(evidence: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Offset and slope of a rising logistic curve of log(1 + evidence), by Newton's method with a small ridge."""
    rows = np.stack([np.ones_like(evidence), np.log1p(evidence)], axis=1)
    weights, penalty = np.zeros(2), RIDGE * np.array([1.0, 1.0]) * len(evidence)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        gradient = rows.T @ (toxic - p) - penalty * weights
        curvature = (rows * (p * (1 - p))[:, None]).T @ rows + np.diag(penalty)
        step = np.linalg.solve(curvature, gradient)
        weights += step
        if np.abs(step).max() < 1e-9:
            break
    return float(weights[0]), float(max(weights[1], 0.0))


def _once_more(words: np.ndarray) -> np.ndarray:
    """How often each word has come up to and including this place."""
    order = np.argsort(words, kind="stable")
    fresh = np.ones(len(words), dtype=bool)
    fresh[1:] = words[order][1:] != words[order][:-1]
    begin = np.maximum.accumulate(np.where(fresh, np.arange(len(words)), 0))
    out = np.empty(len(words), dtype=np.int64)
    out[order] = np.arange(len(words)) - begin + 1
    return out


def _steps(odds: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The walk's steps: a word that comes again is no new evidence, the k-th time weighs 1 / k."""
    return np.where(odds > 0, odds / _once_more(words), odds) - DRIFT if len(words) else odds


def _walks(model: Model, column: pa.Array, labels: np.ndarray | None = None):
    """``(row, segments, starts, ends, bytes)`` of each text; with labels, without its own counts."""
    for at, to, data, bounds, starts, ends, first, nodes in _tokens(column):
        whole = model.log_odds(nodes) if labels is None else None
        for i in range(to - at):
            lo, hi = first[i], first[i + 1]
            odds = model.log_odds(nodes[:, lo:hi], bool(labels[at + i])) if whole is None else whole[lo:hi]
            begin = bounds[i]
            yield at + i, segments(_steps(odds, nodes[0, lo:hi])), starts[lo:hi] - begin, ends[lo:hi] - begin, data[begin:bounds[i + 1]]


def _sample(labels: DataFrame) -> DataFrame:
    """At most ``MAX_ROWS`` labelled ids outside the held-out part."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter("doc_id is not null and toxic in (0, 1)").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = known.count()
    if total > 2 * MAX_ROWS:  # only hashes that can be among the least go on
        known = known.filter(F.xxhash64("doc_id") <= F.lit(int(((1 << 64) * 1.5 * MAX_ROWS) // total) - (1 << 63)).cast("long"))
    return stored(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_ROWS), "labelled")


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Learn from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``; None without both labels."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The sample has at most MAX_ROWS rows of two numbers.
    known = texts.join(F.broadcast(_sample(labels)), "doc_id").select("text", "toxic")
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    counts = stored(
        known.mapInArrow(_counted, "node bigint, toxic bigint, clean bigint").groupBy("node").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")),
        "nodes",
    )
    share = sizes[1] / (sizes[0] + sizes[1])
    odds = F.log((F.col("toxic") + PRIOR * share) / (F.col("clean") + PRIOR * (1 - share))) - float(np.log(share / (1 - share)))
    weight = F.abs(odds) / F.sqrt(1 / (F.col("toxic") + PRIOR * share) + 1 / (F.col("clean") + PRIOR * (1 - share)))
    rated = counts.withColumn("weight", weight)
    total = rated.count()
    if total > MAX_NODES:
        least = rated.agg(F.percentile_approx("weight", 1 - MAX_NODES / total, 100_000)).first()[0]
        rated = rated.filter(F.col("weight") > least)
    table = rated.select("node", "toxic", "clean").toArrow().sort_by("node")
    model = Model(*(table.column(c).to_numpy() for c in ("node", "toxic", "clean")), share)

    def measure(fitted: Model):
        def walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                marks = np.asarray(batch.column("toxic").to_pylist(), dtype=bool)
                rows = [(len(starts), [s for s, _, _ in found]) for _, found, starts, _, _ in _walks(fitted, batch.column("text"), marks)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(marks.astype(np.int32)), pa.array([w for w, _ in rows], pa.int64()), pa.array([max(s, default=0.0) for _, s in rows], pa.float64()), pa.array([s for _, s in rows], pa.list_(pa.float64()))],
                    names=["toxic", "words", "largest", "scores"],
                )

        return walks

    walked = stored(known.mapInArrow(measure(model), "toxic int, words bigint, largest double, scores array<double>"), "walks")
    clean = walked.filter("toxic = 0 and words > 0").select("words", "largest").toArrow()
    rate, constant = extreme_values(clean.column("largest").to_numpy(), clean.column("words").to_numpy().astype(float))
    fitted = Model(model.nodes, model.toxic, model.clean, share, rate, constant)
    evidence = F.pandas_udf(lambda words, scores: words.__class__([fitted.evidence(list(s), w) for w, s in zip(words, scores, strict=True)]), "double")
    points = walked.select("toxic", evidence("words", "scores").alias("evidence")).toArrow()
    offset, slope = logistic(points.column("evidence").to_numpy(), points.column("toxic").to_numpy().astype(float))
    return Model(model.nodes, model.toxic, model.clean, share, rate, constant, offset, slope)


_RESULT = "score double, passages array<struct<start: bigint, end: bigint, score: double, chance: double>>"


def _places(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, passages: list) -> list[dict]:
    """Passages of words as spans of code points."""
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return [{"start": int(points[starts[lo]]), "end": int(points[ends[hi - 1]]), "score": value, "chance": chance} for lo, hi, value, chance in passages]


def scorer(model: Model | None):
    """A function of a text column: ``struct(score, passages)``, passages as code points, end exclusive."""

    @F.arrow_udf(_RESULT)
    def score(texts: pa.Array) -> pa.Array:
        values, passages = [0.0] * len(texts), [[] for _ in range(len(texts))]
        for row, found, starts, ends, data in _walks(model, texts) if model else ():
            words = len(starts)
            values[row] = float(model.probability(model.evidence([s for s, _, _ in found], words)))
            chances = [(lo, hi, value, float(np.exp(model.expected(value, words)))) for value, lo, hi in found]
            passages[row] = _places(data, starts, ends, [c for c in chances if c[3] <= CHANCE])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("chance", pa.float64())]))
        return pa.StructArray.from_arrays([pa.array(values, pa.float64()), pa.array(passages, kind)], names=["score", "passages"])

    return score


def toxicity(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, passages.

    ``score`` is the probability of the label 1, ``predicted`` is 1 from 0.5 on; ``passages``
    are the segments that chance gives less than ``CHANCE`` times in such a text, with their
    spans in code points, scores and expected numbers by chance.

    Defined for every input: a null or empty text and one without words have no segment and the
    score of no evidence; without documents of both labels to learn from all scores are 0; null
    ids and labels other than 0 and 1 teach nothing; an id labelled both ways counts as toxic;
    repeated rows give equal rows; an empty table gives an empty result; a text of any length is
    scanned whole, in memory proportional to it; other columns than doc_id and text are not read.
    """
    score = scorer(train(docs, labels) if model is None else model)
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), score(F.col("text").cast("string")).alias("s"))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "s.score", F.when(F.col("s.score") >= 0.5, 1).otherwise(0).alias("predicted"), "s.passages"
    )
