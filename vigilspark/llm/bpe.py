"""Byte-level BPE encoding and decoding through a global distinct-word shuffle.

One pass over the texts cuts each block of bounded size into words (pretokens) and writes, once, the block's
different words, dealt into shares by a hash, and its documents as packed positions in that list. The shares
are shuffled, so that equal words of all blocks meet in one place, where each distinct word is encoded once.
Ids go back to their block, joined by its number, and positions put the documents together again. The table is
written in buckets of blocks, so the positions don't move again. Both legs read it, so a lost executor or an
input that comes in another order a second time changes nothing. A block holds at most BLOCK_BYTES of text (or
one text), so no task gathers more, whatever the skew of words, sources or copies; a word comes once from each
block.

Decoding joins ids to the table of token bytes, whose size is the vocabulary's, so it is broadcast.
"""

from __future__ import annotations

import base64
import functools
import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilspark.llm.common import bucketed, lists, slices, texts_only, trim
from vigilspark.llm.pretokens import PART_SLICE, Parts, distinct, spread

BLOCK_BYTES = 8 << 20
#: Tokens of a block's documents in one row (or one document).
POSITION_ROWS = 1 << 18
#: Distinct words of one share that a task remembers; with more, some are encoded again.
MAX_WORDS = 1_000_000


#: A part without white space but a blank in front.
_PLAIN = re.compile(r" ?\S+").fullmatch


@functools.cache
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@functools.cache
def word_encoder(path: str):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(path), special_tokens={}).encode_ordinary


@functools.cache
def finder():
    import public_tokenizers
    import regex

    return regex.compile(public_tokenizers.PATTERN).findall


def packed(flat: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers with their bytes in planes, so that high zero bytes cost little."""
    planes = np.ascontiguousarray(flat.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().astype(np.int64) if len(planes) else np.zeros(0, np.int64)


def words_of(parts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The different words of some parts, each part's number of words, and the parts' words by their numbers, end to end.

    Parts without white space but a blank in front are searched at once: a line break between two of them is
    always a match of its own.
    """
    find = finder()
    plain = [k for k, p in enumerate(parts) if _PLAIN(p)]
    found: list[str] = find("\n".join([parts[k] for k in plain]))
    size = np.zeros(len(parts), np.int64)
    number = {w: k for k, w in enumerate(dict.fromkeys(["\n", *found]))}
    flat = np.fromiter(map(number.__getitem__, found), np.int64, len(found))
    between = np.append(np.flatnonzero(flat == 0), len(flat)) if plain else np.zeros(0, np.int64)
    if len(between) != len(plain):
        raise RuntimeError("parts don't match their words")
    size[plain] = np.diff(between, prepend=-1) - 1
    flat = flat[flat > 0]
    rest = np.setdiff1d(np.arange(len(parts)), plain)
    if len(rest):  # parts with other white space, one by one
        several = [find(parts[k]) for k in rest]
        number["\n"] = number.pop("\n")  # stays 0: a word here, too
        size[rest] = list(map(len, several))
        more = np.array([number.setdefault(w, len(number)) for ws in several for w in ws], np.int64)
        ends = np.cumsum(size)
        out = np.zeros(int(ends[-1]), np.int64)
        out[spread((ends - size)[plain], size[plain])] = flat
        out[spread((ends - size)[rest], size[rest])] = more
        flat = out
    names = [""] * len(number)
    for w, k in number.items():
        names[k] = w
    return names, size, flat


BLOCK = ["block", "share", "words", "doc_ids", "sizes", "positions"]


def block_rows(number: int, shares: int, ids: list[pa.Array], slices_: list[Parts]) -> Iterator[pa.RecordBatch]:
    """Rows of one block: its words by share (words, sizes), in order, then its documents (doc_ids, sizes, positions in the list of all shares)."""
    parts, of = distinct(slices_)
    names, size, flat = words_of(parts) if parts else ([], np.zeros(0, np.int64), np.zeros(0, np.int64))
    used = np.unique(flat)
    coded = [names[k].encode() for k in used.tolist()]
    share = np.fromiter(map(zlib.crc32, coded), np.int64, len(coded)) % shares
    order = sorted(range(len(coded)), key=coded.__getitem__)
    order = np.array(order, np.int64)[np.argsort(share[order], kind="stable")]
    rank = np.zeros(len(names), np.int64)
    rank[used[order]] = np.arange(len(order))
    code, first = rank[flat], np.cumsum(size) - size
    doc_ids = pa.concat_arrays(ids)
    kind = pa.list_(doc_ids.type)
    squeeze, edge = zstandard.ZstdCompressor(level=3).compress, np.searchsorted(share[order], np.arange(shares + 1))
    some = [[coded[k] for k in order[a:b].tolist()] for a, b in zip(edge, edge[1:], strict=False)]
    there = [k for k, w in enumerate(some) if w]
    n = len(there)
    if n:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([number] * n), pa.array(there, pa.int32()), pa.array([squeeze(b"".join(some[k])) for k in there]), pa.nulls(n, kind),
                pa.array([packed(np.array(list(map(len, some[k])))) for k in there]), pa.nulls(n, pa.binary()),
            ],
            BLOCK,
        )
    del names, coded, some, order, share, used, flat
    words = np.concatenate([[0], np.cumsum(size[of])])  # words before each part
    part = np.concatenate([[0], np.cumsum(np.concatenate([s.of_text for s in slices_]))])
    token = words[part]  # words before each document
    a = 0
    while a < len(doc_ids):
        b = max(a + 1, int(np.searchsorted(token, token[a] + POSITION_ROWS, "right")) - 1)
        which = of[part[a] : part[b]]
        at = code[spread(first[which], size[which])]
        listed = pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), doc_ids.slice(a, b - a))
        yield pa.RecordBatch.from_arrays([pa.array([number]), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), listed, pa.array([packed(np.diff(token[a : b + 1]))]), pa.array([packed(at)])], BLOCK)
        a = b


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, ids array<int>.

    path: a tiktoken ranks file. Each match of the public pretoken pattern is encoded separately, without
    special tokens, as the library's encode_ordinary does. Null texts count as empty and have no ids. Ids of
    any type, null ones too, come back as they are. Repeated rows each get a row; an empty table gives an
    empty result; other columns are not read.
    """
    rows = texts_only(docs, id_col, text_col)
    kind = dict(rows.dtypes)["doc_id"]
    shares = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The blocks of a partition, under numbers of their own."""
        number, ids, held, size = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in slices(batches, most=PART_SLICE):
            parts = Parts(batch.column("text"))
            if held and size + len(parts.data) > BLOCK_BYTES:
                yield from block_rows(number, shares, ids, held)
                number, ids, held, size = number + 1, [], [], 0
                trim()
            ids.append(batch.column("doc_id")), held.append(parts)
            size += len(parts.data)
        if held:
            yield from block_rows(number, shares, ids, held)

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Over rows sorted by share."""
        one, last, known = word_encoder(path), None, {}
        for batch in batches:
            sizes_out, ids_out = [], []
            for share, data, sizes in zip(*(batch.column(c).to_pylist() for c in ("share", "words", "sizes")), strict=True):
                if share != last or len(known) > MAX_WORDS:
                    last, known = share, {}
                data, ends, found = zstandard.ZstdDecompressor().decompress(data), np.cumsum(unpacked(sizes)).tolist(), []
                for a, b in zip([0, *ends], ends, strict=False):
                    ids = known.get(word := data[a:b])
                    if ids is None:
                        ids = known[word] = one(word.decode())
                    found.append(ids)
                sizes_out.append(packed(np.fromiter(map(len, found), np.int64, len(found))))
                ids_out.append(packed(np.fromiter(itertools.chain.from_iterable(found), np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("share"), pa.array(sizes_out, pa.binary()), pa.array(ids_out, pa.binary())], ["block", "share", "sizes", "ids"])

    def reassemble(left: pa.Table, right: pa.Table) -> pa.Table:
        got = sorted(zip(*(right.column(c).to_pylist() for c in ("share", "sizes", "ids")), strict=True))
        length, ids = (np.concatenate([unpacked(row[k]) for row in got] or [np.zeros(0, np.int64)]) for k in (1, 2))
        start, ids, out = np.cumsum(length) - length, ids.astype(np.int32), []
        for batch in left.to_batches():
            for doc_ids, n, at in zip(batch.column("doc_ids"), batch.column("sizes").to_pylist(), batch.column("positions").to_pylist(), strict=True):
                n, at = unpacked(n), unpacked(at)
                each = length[at]
                ends = np.concatenate([[0], np.cumsum(each)])[np.concatenate([[0], np.cumsum(n)])]
                out.append(pa.RecordBatch.from_arrays([doc_ids.values, lists(ids[spread(start[at], each)], np.diff(ends), pa.int32())], ["doc_id", "ids"]))
        return pa.Table.from_batches(out)

    table = bucketed(rows.mapInArrow(deal, f"block bigint, share int, words binary, doc_ids array<{kind}>, sizes binary, positions binary"), "blocks", "block", shares)
    words = table.filter("words IS NOT NULL").select("block", "share", "words", "sizes").repartitionById(shares, "share").sortWithinPartitions("share")
    ids = words.mapInArrow(encode_words, "block bigint, share int, sizes binary, ids binary")
    documents = table.filter("positions IS NOT NULL").select("block", "doc_ids", "sizes", "positions")
    return documents.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(reassemble, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """Adds decoded binary: the bytes of a row's ids, by a lookup in the token-byte table, which the vocabulary bounds and which is broadcast. Null ids: null; unknown ids are an error."""
    table = {i: b for b, i in ranks(path).items()}
    whole = [table.get(i, b"") for i in range(max(table) + 1)]
    size = np.array(list(map(len, whole)), np.int64)
    shared = encoded.sparkSession.sparkContext.broadcast((np.cumsum(size) - size, size, np.frombuffer(b"".join(whole), np.uint8)))
    out = encoded.withColumn("decoded", F.lit(None).cast("binary"))
    names = out.columns

    def bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, size, data = shared.value
        for batch in batches:
            ids, done = batch.column(ids_col), []
            for row in ids:
                if not row.is_valid:
                    done.append(None)
                    continue
                some = np.asarray(row.values)
                if (some < 0).any() or (size[some] == 0).any():
                    raise ValueError("an id that the table has not")
                done.append(data[spread(start[some], size[some])].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.binary()) if c == "decoded" else batch.column(c) for c in names], names)

    return out.mapInArrow(bytes_of, out.schema)
