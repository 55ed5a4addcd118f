"""Packing by concatenate and cut.

Pass one encodes every text once and writes its ids with the running token total inside its partition.
The partitions' totals, one small row each, get their prefix sums; with these every document knows its
global offset. Pass two cuts each document at the multiples of the sequence length: a piece on a boundary
record's edge goes on in the next sequence. Only the last sequence can be short.
"""

from __future__ import annotations

import functools
import json
import os
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigilspark.llm.common import slices, texts_only, written
from vigilspark.llm.pretokens import PART_SLICE, PartCache, WholeTexts, spread
from vigilspark.llm.token_counts import byte_letters, departures

LENGTH, END_ID = 1024, 0


@functools.cache
def encoder(path: str) -> tuple[Callable, type]:
    """From texts to their ids' bytes as the tokenizers library encodes them, and the type of an id.

    Where the file is a byte-level BPE whose merges come in the order of their ids, tiktoken, which takes ids
    as ranks, gives the same ids in less time; texts with a special token's string go to the library itself, and so
    do the texts of other files, whole.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    kind = np.uint16 if tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
    batch = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
    by_library = lambda texts: [np.array(e.ids, kind).tobytes() for e in batch(texts, add_special_tokens=False)]
    found = id_ranks(path)
    if not found:
        return by_library, kind
    import public_tokenizers
    import tiktoken

    ranks, special = found
    one = tiktoken.Encoding("ids", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    code = "H" if kind is np.uint16 else "I"

    def encode(texts: list[str]) -> list[bytes]:
        return [by_library([t])[0] if any(s in t for s in special) else array(code, one(t)).tobytes() for t in texts]

    return encode, kind


def id_ranks(path: str) -> tuple[dict[bytes, int], list[str]] | None:
    """Token bytes to ids, and the special tokens, if ids can serve as ranks."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model = file["model"]
    if departures(file):
        return None
    special = [t["content"] for t in file["added_tokens"]]
    made = [model["vocab"].get("".join(m.split(" ") if isinstance(m, str) else m), -1) for m in model["merges"]]
    if sorted(made) != made or made[0] < 0:
        return None
    letters = byte_letters()
    return {bytes(map(letters.__getitem__, t)): i for t, i in model["vocab"].items() if t not in special}, special


def encoded(docs: DataFrame, path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pass one: doc_id, part (partition), before (tokens before it there), n (tokens, with the closing end_id), ids (binary, little-endian)."""
    rows = texts_only(docs, id_col, text_col)
    kind = dict(rows.dtypes)["doc_id"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts, dtype = encoder(path)
        known = PartCache(encode_texts) if id_ranks(path) else WholeTexts(encode_texts)
        part, before, width = TaskContext.get().partitionId(), 0, dtype().itemsize
        for batch in slices(batches, most=PART_SLICE):
            of_text, coded, of = known.encoded(batch.column("text"))
            size = np.fromiter(map(len, coded), np.int64, len(coded)) // width
            flat, first = np.frombuffer(b"".join(coded), dtype), np.cumsum(size) - size
            tokens = np.concatenate([[0], np.cumsum(size[of])])[np.concatenate([[0], np.cumsum(of_text)])]  # before each text
            n = np.diff(tokens) + 1
            out = np.full(int(n.sum()), end_id, dtype)
            out[spread(np.cumsum(n) - n, n - 1)] = flat[spread(first[of], size[of])]
            ends = before + np.cumsum(n)
            offsets = pa.py_buffer((np.concatenate([[0], np.cumsum(n)]) * width).astype(np.int32))
            ids = pa.BinaryArray.from_buffers(pa.binary(), len(n), [None, offsets, pa.py_buffer(out)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.full(len(n), part, np.int32)), pa.array(ends - n), pa.array(n), ids], ["doc_id", "part", "before", "n", "ids"])
            before = int(ends[-1])

    return rows.mapInArrow(encode, f"doc_id {kind}, part int, before bigint, n bigint, ids binary")


def pack(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (binary, little-endian unsigned 32-bit).

    A document is its text's ids by the tokenizers file at path, then end_id; null and empty texts are end_id
    alone. Documents follow one another in the order in which they are read, without gaps, so all sequences
    but the last are full. Repeated rows are packed as often as they come; an empty table gives an empty
    result. Texts are never cut before encoding.
    """
    whole = written(encoded(docs, path, end_id, id_col, text_col), "packing")
    totals = whole.groupBy("part").agg(F.sum("n").alias("total"))
    # one row for each partition that was read; its running sum is the only step in one task
    offsets = totals.select("part", (F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("total")).alias("base"))
    placed = whole.join(F.broadcast(offsets), "part").select("doc_id", "n", "ids", (F.col("base") + F.col("before")).alias("at"))
    kind = dict(whole.dtypes)["doc_id"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = encoder(path)[1]
        for batch in batches:
            row, start, size, total, sequence, offset, ids = [], [], [], [], [], [], []
            for k, (n, at, data) in enumerate(zip(batch.column("n").to_pylist(), batch.column("at").to_pylist(), batch.column("ids"), strict=True)):
                all_ids = np.frombuffer(data.as_buffer(), dtype).astype("<u4")
                done = 0
                while done < n:
                    s, o = divmod(at + done, length)
                    take = min(length - o, n - done)
                    row.append(k), start.append(done), size.append(take), total.append(n), sequence.append(s), offset.append(o), ids.append(all_ids[done : done + take].tobytes())
                    done += take
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, size, total, sequence, offset)), pa.array(ids, pa.binary())],
                ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    return placed.mapInArrow(cut, f"doc_id {kind}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary")
