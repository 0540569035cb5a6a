"""Removal of passages that repeat across documents, by sliding spans of sentences.

A sentence ends at ``.``, ``!`` or ``?`` before white space, or at a line break. Runs of
consecutive sentences of enough words are hashed by their lower-cased words. They are taken
twice, with sentences that end at every line break and with such that only blank lines end:
lists of lines need the first, texts wrapped at other columns the second. Every sentence of a
repeated passage of two or more sentences and ``RUN_WORDS`` words is in a run within it. Runs
are joined globally; the first place of a repeated run, by document id and position, is kept and
the sentences of every other place are removed. Each text is read twice rather than storing all
runs; texts are shuffled once, runs twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathwake.llm.arrays import ASCII_LOWER, SPACES, U64, mix, sequence_hashes, span_hashes, text_slices, word_spans
from pathwake.llm.hot import hot_keys, spread_join
from pathwake.runtime import stored

RUN_WORDS = 25
LONG_SENTENCE = 50
_ENDS = np.zeros(256, dtype=bool)
_ENDS[[ord(c) for c in ".!?"]] = True


def sentence_bounds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, first, words, word_of, wide)`` of the sentences of a slice, in bytes.

    Text ``i`` has sentences ``first[i]:first[i + 1]``; sentence ``j`` has the word hashes
    ``words[word_of[j]:word_of[j + 1]]`` and ends with its last word. ``wide`` marks those that
    begin a sentence also if a single line break ends none.
    """
    starts, ends, word_first = word_spans(data, bounds, SPACES)
    words = span_hashes(ASCII_LOWER[data], starts, ends)
    if not len(starts):
        return starts, ends, word_first, words, np.zeros(1, np.int64), np.zeros(0, dtype=bool)
    breaks = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(data == 10, out=breaks[1:])
    lines = breaks[starts[1:]] - breaks[ends[:-1]]
    wide = np.ones(len(starts), dtype=bool)
    wide[1:] = _ENDS[data[ends[:-1] - 1]] | (lines > 1)
    wide[word_first[:-1][word_first[:-1] < len(starts)]] = True
    opens = wide.copy()
    opens[1:] |= lines > 0
    at = np.flatnonzero(opens)
    word_of = np.append(at, len(starts))
    return starts[at], ends[word_of[1:] - 1], np.searchsorted(at, word_first), words, word_of, wide[at]


def _runs(first: np.ndarray, word_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(start, end)`` of the runs of sentences, some of them twice."""
    n = len(word_of) - 1
    at = np.arange(n)
    texts = np.diff(first)
    end = np.maximum(at + 2, np.searchsorted(word_of, word_of[:-1] + RUN_WORDS))
    fits = end <= np.repeat(first[1:], texts)
    start = np.minimum(at - 1, np.searchsorted(word_of, word_of[1:] - RUN_WORDS, side="right") - 1)
    fits_back = start >= np.repeat(first[:-1], texts)
    alone = np.flatnonzero(np.diff(word_of) >= LONG_SENTENCE)
    return np.concatenate([at[fits], start[fits_back], alone]), np.concatenate([end[fits], at[fits_back] + 1, alone + 1])


def runs_of(
    first: np.ndarray, words: np.ndarray, word_of: np.ndarray, wide: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, high, low)`` of every run, in order: its sentences and two hashes of its words.

    A run starts, and another ends, at each sentence and takes the fewest sentences, at least
    two, that hold ``RUN_WORDS`` words; a sentence of ``LONG_SENTENCE`` words is also a run by
    itself. The same runs are taken of the sentences that begin at ``wide`` ones. Runs stay
    inside their text.
    """
    n = len(word_of) - 1
    start, end = _runs(first, word_of)
    if not wide.all():
        at = np.append(np.flatnonzero(wide), n)
        a, b = _runs(np.searchsorted(at, first), word_of[at])
        start, end = np.concatenate([start, at[a]]), np.concatenate([end, at[b]])
    both = np.unique(start * (n + 1) + end)
    start, end = both // (n + 1), both % (n + 1)
    begin, stop = word_of[start], word_of[end]
    return start, end, sequence_hashes(words, begin, stop), sequence_hashes(mix(words + U64(7)), begin, stop)


def _firsts(start: np.ndarray, high: np.ndarray, low: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Marks the first occurrence of each run within its text."""
    order = np.lexsort((start, low, high, text))
    fresh = np.ones(len(order), dtype=bool)
    a, b = order[:-1], order[1:]
    fresh[1:] = (high[a] != high[b]) | (low[a] != low[b]) | (text[a] != text[b])
    found = np.zeros(len(order), dtype=bool)
    found[order[fresh]] = True
    return found


def _run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, to, data, bounds in text_slices(batch.column(2)):
            _, _, first, words, word_of, wide = sentence_bounds(data, bounds)
            start, _, high, low = runs_of(first, words, word_of, wide)
            text = np.searchsorted(first, start, side="right") - 1
            keep = np.flatnonzero(_firsts(start, high, low, text))
            text = text[keep]
            rows = pa.array(text + at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(high[keep].view(np.int64)), pa.array(low[keep].view(np.int64)), batch.column(0).take(rows), batch.column(1).take(rows),
                 pa.array(keep - np.searchsorted(start, first)[text], pa.int32())],
                names=["high", "low", "id", "check", "place"],
            )


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, column, places = batch.columns
        for at, to, data, bounds in text_slices(column):
            starts, ends, first, words, word_of, wide = sentence_bounds(data, bounds)
            start, end, high, low = runs_of(first, words, word_of, wide)
            text_of = np.searchsorted(first, start, side="right") - 1
            again = ~_firsts(start, high, low, text_of)
            own = np.searchsorted(start, first)  # runs of text i: own[i]:own[i + 1]
            blob = data.tobytes()
            texts, counts, removed, spans = [], [], [], []
            for i in range(to - at):
                lo, hi = first[i], first[i + 1]
                gone = np.zeros(hi - lo, dtype=bool)
                marked = again[own[i]:own[i + 1]].copy()
                found = places[at + i].as_py()  # numbers of runs of the text
                if found:
                    marked |= np.isin(np.arange(len(marked)), found)
                for a, b in zip(start[own[i]:own[i + 1]][marked], end[own[i]:own[i + 1]][marked], strict=True):
                    gone[a - lo:b - lo] = True
                text = column[at + i].as_py()
                counts.append(int(hi - lo))
                removed.append(int(gone.sum()))
                if not gone.any():
                    texts.append(text)
                    spans.append("")
                    continue
                # Adjacent removed sentences form one span, cut with the white space after it.
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                kept, done, chars, listed = [], int(bounds[i]), 0, []
                for a, b in zip(edges[::2], edges[1::2], strict=True):
                    begin, stop = int(starts[lo + a]), int(ends[lo + b - 1])
                    after = int(starts[lo + b]) if lo + b < hi else int(bounds[i + 1])
                    kept.append(blob[done:begin])
                    chars += len(kept[-1].decode())
                    size = len(blob[begin:stop].decode())
                    listed.append(f"{chars}:{chars + size}")
                    chars += size + len(blob[stop:after].decode())
                    done = after
                kept.append(blob[done:bounds[i + 1]])
                texts.append(b"".join(kept).decode())
                spans.append(",".join(listed))
            yield pa.RecordBatch.from_arrays(
                [rows.slice(at, to - at), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.string()), pa.array(texts, pa.string())],
                names=["doc_id", "n_sentences", "n_removed", "spans", "text"],
            )


def remove_repeated(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_sentences, n_removed, spans, text.

    ``text`` lacks the sentences of every run that a document with a lesser id has, or that the
    text itself had before; ``spans`` lists them as start:end in code points of the given text.

    Defined for every input: a null text stays null and has no sentences; an empty text, or one
    without a run, is never changed; repeated rows are one document and are changed alike; rows
    of equal id but different text do not take runs from each other; a null id comes before all
    others; an empty table gives an empty result; other columns are not read.
    """
    least = -(1 << 63)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = rows.withColumn("id", F.coalesce("doc_id", F.lit(least))).withColumn("check", F.hash("text"))
    runs = keyed.select("id", "check", "text").mapInArrow(_run_batches, "high bigint, low bigint, id bigint, check int, place int")
    # Combined before the shuffle; a run that is everywhere is one row of each task.
    keys = ["high", "low"]
    counted = runs.groupBy(*keys).agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n"))
    firsts = stored(counted.filter("first < last").select(*keys, "first", "n"), "firsts")
    again = spread_join(runs, firsts.drop("n"), keys, hot_keys(firsts, keys), F.col("id")).filter("id > first")
    marks = again.groupBy("id", "check").agg(F.collect_set("place").alias("places"))
    marked = keyed.join(marks, ["id", "check"], "left").select("doc_id", "text", "places")
    return marked.mapInArrow(_cut_batches, "doc_id bigint, n_sentences bigint, n_removed bigint, spans string, text string")
