"""Language identification by the nearest of several centroids per language.

A text becomes a vector of hashed byte n-grams (two and three bytes of the lower-cased text,
everything that is no letter read as one space), weighted by log(1 + count) times inverse
document frequency and scaled to length one. Training clusters the vectors of each language
(spherical k-means); the language of a text is that of the centroid with the largest cosine.
A text is rejected when this cosine lies below what training texts of its length reach.

Training reads at most ``PER_LANGUAGE`` labelled texts of each language, the ones with the least
hash of their id; this bounds the model and the work of one clustering task. Predictions read
every text in full.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pathwake.llm.arrays import text_slices
from pathwake.runtime import stored

PER_LANGUAGE = 800
CENTROIDS = 4
DIMENSIONS = 4096
ROUNDS = 12
HELD_OUT = 5
# A text is rejected below this part of the least cosine of training texts of its length.
SLACK = 0.5
UNKNOWN = "und"
_ROWS = 256

_LETTERS = np.full(256, 32, dtype=np.uint8)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


@dataclass
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray  # one row each, of length one
    idf: np.ndarray
    least: np.ndarray  # by the power of two of the number of n-grams: cosine below is rejected


def gram_counts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(first row, row after the last, counts)`` with one row of hashed n-gram counts a text."""
    for at, to, data, bounds in text_slices(column, most_rows=_ROWS):
        rows = to - at
        # One space before each text and one after the last.
        text_of = np.repeat(np.arange(rows), np.diff(bounds))
        # Codes and bins fit 32 bits: these arrays are most of what a task holds.
        padded = np.full(len(data) + rows + 1, 32, dtype=np.uint32)
        owner = np.zeros(len(padded), dtype=np.uint32)
        places = np.arange(len(data)) + text_of + 1
        padded[places] = _LETTERS[data]
        owner[places] = text_of
        gaps = bounds + np.arange(rows + 1)
        owner[gaps[:-1]] = np.arange(rows)
        gap = np.zeros(len(padded), dtype=bool)
        gap[gaps] = True
        space = padded == 32
        pairs = (padded[:-1] << 8) | padded[1:]
        keep = np.flatnonzero(~(space[:-1] & space[1:]))
        bins = [owner[keep] * DIMENSIONS + _bucket(pairs[keep])]
        if len(padded) > 2:
            triples = (pairs[:-1] << 8) | padded[2:]
            doubled = space[1:-1] & (space[:-2] | space[2:])
            keep = np.flatnonzero(~(doubled | gap[1:-1]))
            bins.append(owner[keep] * DIMENSIONS + _bucket(triples[keep] | (1 << 24)))
        yield at, to, np.bincount(np.concatenate(bins), minlength=rows * DIMENSIONS).reshape(rows, DIMENSIONS)


def _bucket(codes: np.ndarray) -> np.ndarray:
    return (codes * np.uint32(0x9E3779B1)) >> np.uint32(32 - DIMENSIONS.bit_length() + 1)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighted = np.log1p(counts.astype(np.float32)) * idf
    return weighted / np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-12)


def _steps(counts: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(counts.sum(axis=1), 1)).astype(np.int64)


def _clusters(rows: np.ndarray) -> np.ndarray:
    """Spherical k-means; starts from the row nearest the mean, then the farthest from all so far."""
    chosen = [int(np.argmax(rows @ rows.mean(axis=0)))]
    near = rows @ rows[chosen[0]]
    while len(chosen) < min(CENTROIDS, len(rows)):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, rows @ rows[chosen[-1]])
    centroids = rows[chosen].copy()
    for _ in range(ROUNDS):
        member = np.argmax(rows @ centroids.T, axis=1)
        for i in range(len(centroids)):
            if (member == i).any():
                mean = rows[member == i].mean(axis=0)
                centroids[i] = mean / max(np.linalg.norm(mean), 1e-12)
    return centroids


def _gram_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, to, counts in gram_counts(batch.column(2)):
            rows, grams = np.nonzero(counts)
            ends = np.searchsorted(rows, np.arange(to - at + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(at, to - at), batch.column(1).slice(at, to - at),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(grams.astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(counts[rows, grams].astype(np.int32))),
                ],
                names=["doc_id", "lang", "grams", "counts"],
            )


def held_out(doc_id: Column) -> Column:
    """Documents never learned from: crc32 of the id as text leaves no rest by ``HELD_OUT``."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % HELD_OUT == 0, F.lit(False))


def train(docs: DataFrame) -> Model | None:
    """Learn from text and non-null lang of the documents that are not held out; None without any."""
    labels = docs.select("doc_id", "lang").filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    # Of a language with many texts only small hashes are compared: about twice as many as are
    # chosen, however large the table. One row a language, as in the model.
    sizes = labels.groupBy("lang").agg(F.approx_count_distinct("doc_id", 0.02).alias("n"))
    small = F.xxhash64("doc_id") / F.lit(2.0**64) + 0.5 <= F.lit(2.0 * PER_LANGUAGE) / F.col("n")
    labels = labels.join(F.broadcast(sizes), "lang").filter(small).select("doc_id", "lang").distinct()
    order = W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = labels.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= PER_LANGUAGE).select("doc_id", "lang")
    texts = docs.select("doc_id", "lang", F.col("text").cast("string").alias("text")).filter("text is not null")
    # At most PER_LANGUAGE ids a language, and of repeated ones the least text.
    sample = texts.join(F.broadcast(chosen), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    grams = stored(
        sample.select(F.col("doc_id").cast("long"), "lang", "text").mapInArrow(_gram_batches, "doc_id bigint, lang string, grams array<int>, counts array<int>"),
        "grams",
    )
    frequency = np.zeros(DIMENSIONS)
    for row in grams.select(F.explode("grams").alias("gram")).groupBy("gram").count().collect():
        frequency[row["gram"]] = row["count"]
    total = grams.count()
    idf = (np.log((1 + total) / (1 + frequency)) + 1).astype(np.float32)

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("doc_id", kind="stable")
        counts = np.zeros((len(group), DIMENSIONS), dtype=np.int32)
        for i, (grams_of, counts_of) in enumerate(zip(group["grams"], group["counts"], strict=True)):
            counts[i, grams_of] = counts_of
        counts = counts[counts.sum(axis=1) > 0]
        if not len(counts):
            return pd.DataFrame({"lang": [], "centroids": [], "steps": [], "least": []})
        rows = vectors(counts, idf)
        centroids = _clusters(rows)
        best, steps = (rows @ centroids.T).max(axis=1), _steps(counts)
        seen = np.unique(steps)
        least = [float(best[steps == s].min()) for s in seen]
        return pd.DataFrame({"lang": [group["lang"].iloc[0]], "centroids": [centroids.ravel().tolist()], "steps": [seen.tolist()], "least": [least]})

    found = grams.groupBy("lang").applyInPandas(cluster, "lang string, centroids array<float>, steps array<bigint>, least array<double>").collect()
    if not found:
        return None
    found.sort(key=lambda r: r["lang"])
    lowest = np.ones(64)
    for row in found:
        for step, value in zip(row["steps"], row["least"], strict=True):
            lowest[step] = min(lowest[step], value)
    # Texts longer than those of a step are at least as near; unseen short lengths never fail.
    known = np.flatnonzero(lowest < 1)
    limits = np.zeros(64)
    if len(known):
        for step in range(known[0], 64):
            limits[step] = SLACK * min(lowest[max(k for k in known if k <= step):])
    matrices = [np.array(r["centroids"], dtype=np.float32).reshape(-1, DIMENSIONS) for r in found]
    return Model([r["lang"] for r, m in zip(found, matrices, strict=True) for _ in m], np.concatenate(matrices), idf, limits)


def _has_letter(data: np.ndarray) -> bool:
    low = data | 32
    if ((low >= 97) & (low <= 122)).any():
        return True
    return bool((data > 127).any()) and any(c.isalpha() for c in data.tobytes().decode("utf-8", "replace"))


def predictor(model: Model | None):
    """A function of a text column giving struct(lang_pred, score, rejected)."""
    languages = np.array(model.languages if model else [UNKNOWN], dtype=object)

    @F.arrow_udf("lang_pred string, score double, rejected boolean")
    def predict(texts: pa.Array) -> pa.Array:
        names, scores, far = [], [], []
        lettered = np.zeros(len(texts), dtype=bool)
        for at, to, data, bounds in text_slices(texts):
            for i in range(to - at):
                lettered[at + i] = _has_letter(data[bounds[i]:bounds[i + 1]])
        for at, to, counts in gram_counts(texts):
            known = lettered[at:to] & (model is not None)
            if model is None:
                cosines = np.zeros((to - at, 1))
            else:
                cosines = vectors(counts, model.idf) @ model.centroids.T
            best = cosines.argmax(axis=1)
            score = np.clip(cosines[np.arange(to - at), best].astype(np.float64), 0.0, 1.0)
            limit = model.least[_steps(counts)] if model else np.zeros(to - at)
            names.append(np.where(known, languages[best], UNKNOWN))
            scores.append(np.where(known, score, 0.0))
            far.append(~known | (score < limit))
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        return pa.StructArray.from_arrays(
            [pa.array(join(names, object), pa.string()), pa.array(join(scores, float), pa.float64()), pa.array(join(far, bool), pa.bool_())],
            names=["lang_pred", "score", "rejected"],
        )

    return predict


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, rejected.

    ``lang_pred`` is a learned language, or ``und`` for a null text, a text without a letter, or
    when nothing could be learned; ``score`` is the cosine, 0 for ``und``. ``rejected`` is true
    for ``und`` and for texts too far from every centroid.

    Defined for every input: a null id is neither held out nor learned from; repeated rows give
    equal rows; an empty table gives an empty result; ties of centroids go to the language
    first in order; columns other than doc_id, text and lang are not read, and lang is only
    read in training.
    """
    predict = predictor(train(docs) if model is None else model)
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), predict(F.col("text").cast("string")).alias("p"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "p.lang_pred", "p.score", "p.rejected")


def drop_rejected(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is not rejected; columns stay as they are."""
    predict = predictor(train(docs))
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"), predict(docs["text"].cast("string")).alias("p"))
    return rows.filter(~F.col("p.rejected")).select("doc.*")
