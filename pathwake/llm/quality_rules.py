"""Quality rules: a decision list learned from labelled statistics.

Statistics of every text are counted in one pass. Sequential covering then learns rules that
recognise bad documents: a rule starts empty and grows by the threshold condition of largest
information gain on two thirds of the rows it may use; it is pruned on the other third, by
leaving out its last conditions; it joins the list if it is precise enough there, and the rows
it covers are put aside. The list becomes one ordered Spark conditional expression.

Learning reads at most ``MAX_ROWS`` labelled rows, those with the least hash of their id.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathwake.llm.arrays import SPACES, U64, mix, span_hashes, text_slices, window_hashes, word_spans
from pathwake.runtime import stored

MAX_ROWS = 20_000
MAX_RULES = 16
MAX_CONDITIONS = 4
PRECISION = 0.95  # of a rule on the rows it was pruned on
LEAST_COVERED = 5
THRESHOLDS = 32
WINDOW = 5
# Fixed by the contract.
LEAST_WORDS, REPEAT_PERCENT = 10, 20
_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

# Features are ratios of the counts; the same expressions serve learning and applying.
FEATURES: dict[str, str] = {
    "words": "cast(n_words as double)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols": "n_symbols / greatest(n_words, 1)",
    "dup_lines": "cast(n_dup_lines as double)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
}


def _repeated(groups: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Marks elements whose hash occurs again in the same group."""
    keys = mix(hashes + mix(groups.astype(U64)))
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return counts[inverse] > 1


def count_slice(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The five counts, one row a text."""
    starts, ends, first = word_spans(data, bounds, SPACES)
    rows = len(bounds) - 1
    out = np.zeros((rows, 5), dtype=np.int64)
    out[:, 0] = np.diff(first)
    letters = ((data & 0xC0) != 0x80) & ~SPACES[data]
    for column, marks in ((1, letters), (2, _SYMBOLS[data])):
        out[:, column] = np.diff(np.concatenate([[0], np.cumsum(marks)])[bounds])
    if not len(starts):
        return out
    text = np.repeat(np.arange(rows), out[:, 0])
    # Lines with a word: the first word of each, and the line around it.
    breaks = np.flatnonzero(data == 10)
    line = np.searchsorted(breaks, starts)
    fresh = np.ones(len(starts), dtype=bool)
    fresh[1:] = (line[1:] != line[:-1]) | (text[1:] != text[:-1])
    at, owner = line[fresh], text[fresh]
    edges = np.concatenate([[-1], breaks, [len(data)]])
    begin = np.maximum(edges[at] + 1, bounds[owner])
    stop = np.minimum(edges[at + 1], bounds[owner + 1])
    keys = mix(span_hashes(data, begin, stop) + mix(owner.astype(U64)))
    _, earliest = np.unique(keys, return_index=True)
    out[:, 3] = np.bincount(owner, minlength=rows) - np.bincount(owner[earliest], minlength=rows)
    windows = window_hashes(span_hashes(data, starts, ends), WINDOW)
    inside = np.flatnonzero(text[:len(windows)] == text[WINDOW - 1:]) if len(windows) else np.zeros(0, np.int64)
    twice = inside[_repeated(text[inside], windows[inside])]
    cover = np.zeros(len(starts) + 1, dtype=np.int64)
    cover[twice] += 1
    cover[twice + WINDOW] -= 1
    out[:, 4] = np.diff(np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)])[first])
    return out


def _statistics(texts: pa.Array) -> pa.Array:
    parts = [count_slice(data, bounds) for _, _, data, bounds in text_slices(texts)]
    table = np.concatenate(parts) if parts else np.zeros((0, 5), np.int64)
    return pa.StructArray.from_arrays([pa.array(table[:, i], pa.int64()) for i in range(5)], names=list(COUNTS))


def statistics(text: Column) -> Column:
    """struct(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words); null counts as empty."""
    return F.arrow_udf(_statistics, ", ".join(f"{c} long" for c in COUNTS))(text.cast("string"))


@dataclass(frozen=True)
class Condition:
    feature: int
    above: bool  # value > threshold, else value <= threshold
    threshold: float

    def holds(self, table: np.ndarray) -> np.ndarray:
        values = table[:, self.feature]
        return values > self.threshold if self.above else values <= self.threshold

    def sql(self) -> str:
        return f"({list(FEATURES.values())[self.feature]}) {'>' if self.above else '<='} {self.threshold!r}D"


Rule = tuple[Condition, ...]


def _covered(rule: Rule, table: np.ndarray) -> np.ndarray:
    out = np.ones(len(table), dtype=bool)
    for condition in rule:
        out &= condition.holds(table)
    return out


def _grow(table: np.ndarray, bad: np.ndarray) -> Rule:
    rule: Rule = ()
    inside = np.ones(len(table), dtype=bool)
    while len(rule) < MAX_CONDITIONS and (~bad[inside]).any():
        best, chosen = 0.0, None
        p0, n0 = bad[inside].sum(), (~bad[inside]).sum()
        for feature in range(table.shape[1]):
            values = np.unique(table[inside, feature])
            middle = (values[1:] + values[:-1]) / 2
            if len(middle) > THRESHOLDS:
                middle = middle[np.linspace(0, len(middle) - 1, THRESHOLDS).astype(int)]
            for threshold in middle:
                for above in (True, False):
                    condition = Condition(feature, above, float(threshold))
                    kept = inside & condition.holds(table)
                    p, n = bad[kept].sum(), (~bad[kept]).sum()
                    gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))) if p else 0.0
                    if gain > best + 1e-9:
                        best, chosen = gain, condition
        if chosen is None:
            break
        rule += (chosen,)
        inside &= chosen.holds(table)
    return rule


def learn(table: np.ndarray, bad: np.ndarray) -> list[Rule]:
    """Rules for the bad rows of a table of features, most useful first."""
    rules: list[Rule] = []
    part = np.arange(len(table)) % 3 == 2  # rows come in the order of a hash
    while len(rules) < MAX_RULES and bad[~part].any():
        rule = _grow(table[~part], bad[~part])
        scores = []
        for size in range(1, len(rule) + 1):
            covered = _covered(rule[:size], table[part])
            p, n = bad[part][covered].sum(), (~bad[part])[covered].sum()
            scores.append(((p - n) / (p + n) if p + n else -1.0, size, p, n))
        if not scores:
            break
        _, size, p, n = max(scores, key=lambda s: (s[0], -s[1]))
        if p + n < LEAST_COVERED or p < PRECISION * (p + n):
            break
        rules.append(rule[:size])
        keep = ~_covered(rules[-1], table)
        table, bad, part = table[keep], bad[keep], part[keep]
    return rules


def expression(rules: list[Rule]) -> Column:
    """Ordered conditional: false at the first rule that holds, true if none does."""
    verdict = None
    for rule in rules:
        holds = F.expr(" and ".join(c.sql() for c in rule))
        verdict = F.when(holds, False) if verdict is None else verdict.when(holds, False)
    return F.lit(True) if verdict is None else verdict.otherwise(True)


def learn_rules(stats: DataFrame, labels: DataFrame) -> list[Rule]:
    """Learn from rows of ``stats`` with a non-null label; ``quality`` 0 is bad."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").filter("quality is not null")
    # Only hashes that can be among the least reach the driver, however many tasks there are.
    total = known.count()
    if total > 2 * MAX_ROWS:
        share = int(((1 << 64) * 1.5 * MAX_ROWS) // total) - (1 << 63)
        known = known.filter(F.xxhash64("doc_id") <= F.lit(share).cast("long"))
    rows = (
        stats.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", *COUNTS, "quality").limit(MAX_ROWS)
        .select(*[F.expr(f"cast({e} as double)").alias(f) for f, e in FEATURES.items()], (F.col("quality") == 0).alias("bad")).collect()
    )
    if not rows:
        return []
    return learn(np.array([r[:-1] for r in rows], dtype=float), np.array([r["bad"] for r in rows], dtype=bool))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, the five counts, base_failed, kept.

    ``base_failed``: fewer than ten words, or more than a fifth of them in repeated windows.
    ``kept`` is false if that fails, else the verdict of the list learned from ``labels``.

    Defined for every input: a null text has no words and fails; repeated rows give equal rows;
    without labels, or with one kind only, the list is empty and keeps all; null labels and
    null ids teach nothing; an empty table gives an empty result; columns other than doc_id
    and text are not read.
    """
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), statistics(F.col("text")).alias("s"))
    stats = stored(counted.select("doc_id", "s.*"), "statistics")
    rules = learn_rules(stats, labels)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return stats.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & expression(rules))
