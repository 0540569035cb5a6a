"""Rows that the pipeline's filters keep when ids repeat."""

from pathwake.llm import decontaminate, near_dedup

A = "one two three four five six seven eight nine ten eleven twelve"
B = "the quick brown fox jumps over a lazy dog by the river at dawn and sleeps all day long there"
NEAR = B + " now"


def rows(spark, values, **more):
    return spark.createDataFrame(values, "doc_id long, text string").selectExpr("*", "1 as verdict", "2 as doc", "'x' as label", "3 as text_high", "4 as class")


def left(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


C, D = (" ".join(reversed(t.split())) for t in (A, B))


def test_rows_go_by_their_own_text(spark):
    """A unique text outlives a copy under its id; null ids of different groups stay apart."""
    docs = rows(spark, [(3, B), (7, A), (7, NEAR), (None, C), (None, C), (None, D), (None, D + " now")])
    found = near_dedup.drop_near_duplicates(docs)
    kept = left(found)
    assert found.columns == docs.columns and len(kept) == 4
    assert {(3, B), (7, A), (None, C)} < set(kept) and {t for _, t in kept} & {D, D + " now"}


def test_one_row_of_a_group_stays(spark):
    docs = rows(spark, [(7, A), (7, A), (7, A), (9, B), (9, NEAR), (None, B), (None, None), (None, None), (5, "")])
    found = left(near_dedup.drop_near_duplicates(docs))
    assert found.count((7, A)) == 1 and [i for i, t in found if t in (B, NEAR)] == [9]
    assert found.count((None, None)) == 2 and (5, "") in found and len(found) == 5


def test_many_texts_under_one_id(spark):
    docs = spark.range(2000).selectExpr("1L as doc_id", "concat_ws(' ', transform(sequence(1, 12), i -> sha2(concat(id, '-', i), 256))) as text")
    both = docs.union(docs.limit(500).selectExpr("null as doc_id", "concat(text, '\n') as text"))
    assert near_dedup.drop_near_duplicates(both).count() == 2000


def test_kept_rows_are_those_of_the_verdict(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = {r.doc_id for r in near_dedup.near_duplicates(docs).filter("kept").collect()}
    assert {r.doc_id for r in near_dedup.drop_near_duplicates(docs).collect()} == kept


def test_contamination_goes_by_row(spark):
    item = " ".join(f"word{i}" for i in range(20))
    benchmark = spark.createDataFrame([("q", item)], "item_id string, text string")
    docs = rows(spark, [(1, item), (1, A), (2, item), (None, B), (None, item)])
    assert left(decontaminate.drop_contaminated(docs, benchmark)) == left(rows(spark, [(1, A), (None, B)]))
