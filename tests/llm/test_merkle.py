"""The manifest against a plain construction of the trees."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from pathwake.llm import merkle, queries
from tests import compare
from tests.llm.test_operators import SCHEMA, awkward

DIRECTORY = "/root/testdata/sf0.001"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def claimed_text(row):
    text = row["text"]
    if text is None or row["doc_id"] is None or zlib.crc32(str(row["doc_id"]).encode()) % 2:
        return text
    return text.replace("\n", "")


def plain(rows):
    sources = {}
    for row in rows:
        sources.setdefault(row["source"], []).append(row)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for members in sources.values():
        members.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
    trees = {s: levels_of([leaf(r, r["text"]) for r in sources[s]]) for s in order}
    top = levels_of([trees[s][-1][0] for s in order]) if order else []
    out = []
    for at, source in enumerate(order):
        for i, row in enumerate(sources[source]):
            reached, proof = leaf(row, claimed_text(row)), []
            for levels, place in ((trees[source], i), (top, at)):
                for level in levels[:-1]:
                    run, slot = level[place - place % 3:place - place % 3 + 3], place % 3
                    reached = digest(*run[:slot], reached, *run[slot + 1:])
                    proof += [h for j, h in enumerate(run) if j != slot]
                    place //= 3
            root = top[-1][0]
            out.append((row["doc_id"], trees[source][0][i], trees[source][-1][0], root, "".join(proof), reached, reached == root))
    return sorted(out, key=repr)


def built(docs, levels):
    text = F.col("text")
    claimed = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
    return sorted((tuple(r) for r in merkle.manifest(docs, claimed, levels).collect()), key=repr)


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest_equals_plain_trees(spark, levels):
    docs = spark.createDataFrame(awkward() * 3, SCHEMA)
    assert built(docs, levels) == plain([r.asDict() for r in docs.collect()])


def test_tampered_rows_alone_fail(spark):
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    failed = {r.doc_id for r in queries.QUERIES["op11_merkle_manifest"](spark, DIRECTORY).collect() if not r.verified}
    assert failed and failed == {i for i, r in rows.items() if claimed_text(r) != r["text"]}


def test_manifest_sql(spark):
    left = compare.spark_rows(queries.QUERIES["op11_merkle_manifest"](spark, DIRECTORY))
    right = compare.sql_rows(compare.connect(DIRECTORY), queries.ORACLE_SQL["op11_merkle_manifest"])
    assert compare.differences(left, right) is None


def test_empty_single_and_clashing_columns(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).collect() == []
    one = spark.createDataFrame([(1, "a\nb", None, None, 3)], "doc_id long, text string, lang string, source string, n_chars long")
    crowded = one.selectExpr("*", "1 as position", "2 as digest", "3 as other", "4 as payload", "5 as block", "6 as tree", "7 as _row")
    for docs in (one, crowded):
        row = merkle.manifest(docs).first()
        assert row.leaf == row.subroot == row.root == leaf(one.first(), "a\nb") and row.proof == "" and row.verified


@pytest.mark.parametrize("leaves, levels", [(1, 1), (1, 7), (2, 2), (3, 2), (4, 3), (9, 3), (10, 4), (100, 6), (728, 7), (729, 7), (500, 9)])
def test_addresses_fill_the_block_and_keep_subtrees_together(leaves, levels):
    places = merkle.addresses(leaves, levels)
    sizes = [-(-leaves // 3**level) for level in range(levels)]
    assert [len(p) for p in places] == sizes
    assert sorted(a for p in places for a in p.tolist()) == list(range(sum(sizes)))
    assert places[-1].tolist() == [0]
    lower = levels // 2
    if lower:  # every lower subtree is one stretch
        for root in range(sizes[lower - 1]):
            inside = [a for level in range(lower) for a in places[level][root * 3**(lower - 1 - level):(root + 1) * 3**(lower - 1 - level)].tolist()]
            assert max(inside) - min(inside) + 1 == len(inside)
