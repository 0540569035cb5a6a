"""Segments against their definition, and the score on held-out labels."""

import random
import time

import numpy as np
from pyspark.sql import functions as F

from pathwake.llm import toxicity
from tests.llm.test_operators import SCHEMA, awkward

LABELS = "doc_id long, quality int, toxic int"


def by_definition(scores, at=0):
    """Best segment of the walk, then those left and right of it; ties to the shortest, first one."""
    best = None
    for i in range(len(scores)):
        total = 0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > 0 and (best is None or (total, i - j, -i) > (best[0], best[1] - best[2], -best[1])):
                best = (total, i, j)
    if best is None:
        return []
    total, i, j = best
    return by_definition(scores[:i], at) + [(total, at + i, at + j + 1)] + by_definition(scores[j + 1:], at + j + 1)


def test_segments_by_definition():
    rng = random.Random(3)
    for _ in range(300):
        scores = [rng.uniform(-3, 2) for _ in range(rng.randrange(0, 25))]
        found = toxicity.segments(np.array(scores))
        wanted = by_definition(scores)
        assert [(i, j) for _, i, j in found] == [(i, j) for _, i, j in wanted]
        assert np.allclose([s for s, _, _ in found], [s for s, _, _ in wanted])


def test_segments_take_linear_time():
    rng = np.random.default_rng(1)
    walk = rng.normal(0.0, 1.0, 400_000)
    start = time.perf_counter()
    toxicity.segments(walk)
    toxicity.segments(np.tile([1.0, -1.5], 200_000))
    toxicity.segments(np.tile([1.5, -1.0], 200_000))
    assert time.perf_counter() - start < 10


def test_extreme_value_law_is_found_again():
    rng = np.random.default_rng(5)
    words = rng.integers(50, 5000, 20_000).astype(float)
    largest = np.maximum(0.0, (np.log(0.02 * words) - np.log(-np.log(rng.random(20_000)))) / 0.8)
    rate, constant = toxicity.extreme_values(largest, words)
    assert abs(rate - 0.8) < 0.03 and abs(constant / 0.02 - 1) < 0.1


def test_held_out_documents(spark):
    directory = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{directory}/{n}.parquet") for n in ("documents", "labels"))
    found = toxicity.toxicity(docs, labels).join(labels, "doc_id").filter("held_out").select("toxic", "score", "predicted").toPandas()
    toxic = found.toxic == 1
    assert (found.predicted == 1)[toxic].mean() > 0.85 and (found.predicted == 0)[~toxic].mean() > 0.99
    ranks = found.score.rank()
    assert (ranks[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum()) > 0.95


def model(spark):
    clean = "the quick river bends over every quiet field and all is well"
    rows = [(i, clean + (" you utter blockhead" if i % 5 == 0 else "")) for i in range(400)]
    labels = [(i, None, int(i % 5 == 0)) for i in range(400)]
    return toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS))


def test_passages_and_awkward_rows(spark):
    learned = model(spark)
    insult = "é The quick river, YOU utter Blockheads bends"
    rows = awkward() + [(100, insult, None, None, 0, 1, 2, "v"), (101, "word " * 200_000 + insult, None, None, 0, 1, 2, "v")]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as score", "2 as s", "'x' as passages", "3 as predicted")
    found = toxicity.toxicity(docs, None, learned).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    one = next(r for r in found if r.doc_id == 100)
    assert one.predicted == 1 and any(insult[p.start:p.end].startswith("YOU utter Blockhead") for p in one.passages)
    long = next(r for r in found if r.doc_id == 101)
    assert any("utter" in rows[-1][1][p.start:p.end] for p in long.passages)
    assert all(r.predicted == 0 and not r.passages for r in found if r.doc_id is None or r.doc_id < 100)
    same = [r.score for r in found if r.doc_id in (0, 1)]
    assert same[0] == same[1]  # null and empty


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(i, f"some text {i}") for i in range(20)], "doc_id long, text string")
    for labels in ([], [(i, 1, 0) for i in range(20)], [(None, 1, 1), (3, 1, None), (4, 1, 7)]):
        found = toxicity.toxicity(docs, spark.createDataFrame(labels, LABELS)).collect()
        assert [r.score for r in found] == [0.0] * 20
    assert toxicity.toxicity(docs.limit(0), spark.createDataFrame([], LABELS)).collect() == []


def test_other_columns_do_not_matter(spark):
    learned = model(spark)
    docs = spark.createDataFrame([(1, "you utter blockhead", "en", "a"), (1, "you utter blockhead", None, None)], "doc_id long, text string, lang string, source string")
    assert len({r.score for r in toxicity.toxicity(docs, None, learned).select(F.col("score")).collect()}) == 1
