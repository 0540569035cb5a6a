"""Passages that very many documents hold, and many positions of a store at once."""

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pathwake.llm import hot, repeated_passages, token_store

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PASSAGE = " ".join(f"The {w} river runs past every quiet mill and turns the old wheel there." for w in ("first", "second", "third", "fourth"))


def test_a_passage_in_very_many_documents(spark, monkeypatch):
    monkeypatch.setattr(hot, "LEAST_ROWS", 10)
    own = "concat('Document ', id, ' says ', sha2(concat(id, 'a'), 256), ' and nothing else at all. ')"
    docs = spark.range(20_000).selectExpr("id as doc_id", f"concat({own}, '{PASSAGE}', ' ', {own}) as text")
    found = repeated_passages.remove_repeated(docs)
    left = found.filter(F.col("text").contains("quiet mill")).select("doc_id").collect()
    assert [r.doc_id for r in left] == [0]
    assert found.filter(~F.col("text").contains("nothing else")).count() == 0 and found.count() == 20_000


def test_many_positions_of_one_document(spark, tmp_path):
    text = " ".join(f"word{i} and" for i in range(40_000))
    docs = spark.createDataFrame([(1, text), (2, "short one"), (3, None)], "doc_id long, text string")
    token_store.write_tokens(docs, f"{tmp_path}/store", BYTE_BPE)
    ids = Tokenizer.from_file(BYTE_BPE).encode(text, add_special_tokens=False).ids
    wanted = spark.range(0, len(ids) + 5).selectExpr("1L as doc_id", "id as at").union(spark.createDataFrame([(2, 0), (2, -1), (9, 0)], "doc_id long, at long"))
    got = token_store.tokens_at(spark, f"{tmp_path}/store", wanted).collect()
    found = sorted((r["at"], r.id) for r in got if r.doc_id == 1)
    assert found[:-1] == list(enumerate(ids)) and found[-1] == (len(ids), 2)
    assert [r["at"] for r in got if r.doc_id != 1] == [0]
