"""op1: ids of any type, inputs in changing order, and the merges by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import prose
from vigilspark.llm import bpe
from vigilspark.llm.queries import tokenizer


@pytest.mark.parametrize("kind", ["int", "string", "bigint"])
def test_ids_of_any_type(spark, kind):
    path = tokenizer("byte_bpe_multi_50k.tiktoken")
    one = bpe.word_encoder(path)
    rows = spark.createDataFrame([(None, "a b"), (None, None), (1, "c d")], "n int, text string").select(F.col("n").cast(kind).alias("doc_id"), "text")
    got = sorted((str(r.doc_id), list(r.ids)) for r in bpe.encode(rows, path).collect())
    assert got == sorted([("None", one("a b")), ("None", []), ("1", one("c d"))])
    assert bpe.encode(rows.filter("doc_id IS NULL"), path).count() == 2


def test_input_that_changes_its_order(spark):
    """Every reading deals the rows to other partitions in another order; each document still has its own ids."""
    path = tokenizer("byte_bpe_multi_50k.tiktoken")
    one = bpe.word_encoder(path)
    texts = {i: prose(100 + i, 60) for i in range(300)}
    rows = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3, F.rand()).sortWithinPartitions(F.rand())
    assert {r.doc_id: list(r.ids) for r in bpe.encode(rows, path).collect()} == {i: one(t) for i, t in texts.items()}


def test_many_blocks(spark, monkeypatch):
    """A text longer than a block has one of its own."""
    path = tokenizer("byte_bpe_multi_50k.tiktoken")
    one = bpe.word_encoder(path)
    texts = {i: prose(i, 8000 if i == 3 else 50) for i in range(12)} | {12: "", 13: " "}
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 1000)
    rows = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").coalesce(2)
    assert {r.doc_id: list(r.ids) for r in bpe.encode(rows, path).collect()} == {i: one(t) for i, t in texts.items()}


def test_merges_by_hand(spark):
    """The ids of words by the plain rule: merge the pair of the least rank until none is left."""
    path = tokenizer("byte_bpe_multi_50k.tiktoken")
    table = bpe.ranks(path)

    def merged(word: bytes) -> list[int]:
        parts = [word[k : k + 1] for k in range(len(word))]
        while found := [(table[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in table]:
            k = min(found)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return [table[p] for p in parts]

    texts = ["déjà vu 中文 internationalization 12345 '''' \n\n x", prose(7, 20)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = {i: [x for w in bpe.finder()(t) for x in merged(w.encode())] for i, t in enumerate(texts)}
    assert {r.doc_id: list(r.ids) for r in bpe.encode(rows, path).collect()} == want
    back = bpe.decode(bpe.encode(rows, path), path)
    assert {r.doc_id: bytes(r.decoded).decode() for r in back.collect()} == dict(enumerate(texts))


def test_unknown_ids_are_an_error(spark):
    rows = spark.createDataFrame([(1, [60_000_000])], "doc_id bigint, ids array<int>")
    with pytest.raises(Exception, match="out of bounds|has not"):
        bpe.decode(rows, tokenizer("byte_bpe_multi_50k.tiktoken")).collect()
