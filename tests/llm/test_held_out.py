"""Learned verdicts on labels that were kept out of learning."""

import numpy as np
from pyspark.sql import functions as F

from pathwake.llm import language, quality_rules

DIRECTORY = "/root/testdata/sf0.1"


def test_rules_find_bad_documents_and_leave_good_ones(spark):
    docs, labels = (spark.read.parquet(f"{DIRECTORY}/{n}.parquet") for n in ("documents", "labels"))
    counted = docs.select("doc_id", quality_rules.statistics(F.col("text")).alias("s")).select("doc_id", "s.*")
    features = [F.expr(f"cast({e} as double)").alias(f) for f, e in quality_rules.FEATURES.items()]
    base = (F.col("n_words") < quality_rules.LEAST_WORDS) | (100 * F.col("n_repeat_words") > quality_rules.REPEAT_PERCENT * F.col("n_words"))
    rows = counted.join(labels, "doc_id").select(
        language.held_out(F.col("doc_id")).alias("out"), (F.col("quality") == 0).alias("bad"), base.alias("base"), *features).toPandas()
    table = rows[list(quality_rules.FEATURES)].to_numpy(dtype=float)
    bad, out = rows["bad"].to_numpy(), rows["out"].to_numpy()
    order = np.random.default_rng(1).permutation(np.flatnonzero(~out))
    rules = quality_rules.learn(table[order], bad[order])
    dropped = np.zeros(len(table), dtype=bool)
    for rule in rules:
        dropped |= quality_rules._covered(rule, table)
    found, lost = dropped[out & bad], dropped[out & ~bad]
    print(f"rules {len(rules)}, bad {found.sum()} of {len(found)}, good {lost.sum()} of {len(lost)}")
    assert found.mean() > 0.9 and lost.mean() < 0.01


def test_languages_by_language(spark):
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet")
    found = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null and lang_pred <> 'und'")
    rows = found.groupBy("lang").agg(F.count("*").alias("n"), F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("right"),
                                     F.avg(F.col("rejected").cast("double")).alias("rejected")).collect()
    for r in rows:
        print(r.lang, r.n, round(r.right, 4), round(r.rejected, 4))
        assert r.right > 0.95 and r.rejected < 0.02
