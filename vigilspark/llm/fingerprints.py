"""Document fingerprints by one-permutation MinHash.

A text's five-word shingles are hashed once; a hash's high bits name its bin and each bin keeps its least
hash. An empty bin takes the value of the first filled bin in its own random order of bins (optimal
densification), mixed with its own number, so that values agree by chance in each bin anew. The low-order BITS of each bin are packed into the fingerprint. Two fingerprints' share of
equal bins, less the share that agrees by chance, estimates the Jaccard similarity.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilspark.llm.common import slices, texts_only
from vigilspark.llm.shingles import mix, sets

BINS, BITS = 512, 4
#: Ranges of ids that are dealt out, at most; one row for each comes to the driver.
MAX_RANGES = 4096
NONE = (1 << 63) - 1
#: What is mixed into a value that another bin lends.
OWN = mix(np.arange(BINS, dtype=np.uint64) + np.uint64(1 << 40))
#: Lookups of one step in search of filled bins, about, and attempts a bin in it, at most.
SOME, MAX_TRIES = 1 << 14, 256
FIELDS = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def sketches(texts: pa.Array) -> np.ndarray:
    """Low-order bits, a row of BINS for each text; texts without words have 255 everywhere."""
    flat, sizes = sets(texts)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    key = doc * BINS + (flat >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    filled = np.zeros(len(sizes) * BINS, bool)
    out = np.full(len(sizes) * BINS, 255, np.uint8)
    filled[key[first]] = True
    out[key[first]] = (flat[first] & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    held, value = key[first], flat[first]

    def copied(row: np.ndarray, at: np.ndarray, bin_: np.ndarray) -> np.ndarray:
        found = value[np.searchsorted(held, row * BINS + at)]
        return (mix(found ^ OWN[bin_]) & np.uint64((1 << BITS) - 1)).astype(np.uint8)

    filled, out = filled.reshape(-1, BINS), out.reshape(-1, BINS)
    one = filled.sum(1) == 1
    row, bin_ = np.nonzero(~filled & one[:, None])
    out[row, bin_] = copied(row, filled.argmax(1)[row], bin_)  # its only value is every bin's
    row, bin_ = np.nonzero(~filled & (filled.sum(1) > 1)[:, None])
    attempt = 0
    while len(row):
        tries = np.arange(attempt + 1, attempt + 1 + min(MAX_TRIES, max(1, SOME // len(row))), dtype=np.uint64)  # many at once for the last few
        at = (mix(bin_.astype(np.uint64)[:, None] + (tries << np.uint64(20))) % np.uint64(BINS)).astype(np.int64)
        good = filled[row[:, None], at]
        hit, first = good.any(1), good.argmax(1)
        out[row[hit], bin_[hit]] = copied(row[hit], at[hit, first[hit]], bin_[hit])
        row, bin_, attempt = row[~hit], bin_[~hit], attempt + len(tries)
    return out


def packed(row: np.ndarray) -> str:
    """Hexadecimal; empty for a text without words."""
    return "" if row[0] == 255 else np.packbits(np.unpackbits(row[:, None], axis=1)[:, 8 - BITS :]).tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1. Two texts without words are alike, one such and another are not."""
    if a[0] == 255 or b[0] == 255:
        return float(a[0] == b[0])
    chance = 1 / (1 << BITS)
    return float(min(1.0, max(0.0, ((a == b).mean() - chance) / (1 - chance))))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, fingerprint of the whole text. Null counts as empty."""
    rows = texts_only(docs, id_col, text_col)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(map(packed, sketches(batch.column("text"))), pa.string())], ["doc_id", "fingerprint"])

    return rows.mapInArrow(step, f"doc_id {dict(rows.dtypes)['doc_id']}, fingerprint string")


def edited(text: str, after: str) -> str:
    """The last floor(n / 4) code points replaced by the first as many, or all, of the next text."""
    n = len(text) // 4
    return text[: len(text) - n] + after[:n]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by range, role, id: each row of role 0 with the row behind it."""
    held = None  # range, role, id, text, sketch of the last row, and whether its id is null
    for batch in slices(batches, most=1 << 20):
        own = sketches(batch.column("text"))
        rows = [*([held] if held else []), *zip(batch.column("r").to_pylist(), batch.column("role").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), own, batch.column("none").to_pylist(), strict=True)]
        pairs = [(a, b) for a, b in zip(rows, rows[1:], strict=False) if a[0] == b[0] and a[1] == 0]
        held = rows[-1]
        if not pairs:
            continue
        texts = [edited(a[3], b[3]) for a, b in pairs]
        new = sketches(pa.array(texts, pa.string()))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([None if a[5] else a[2] for a, _ in pairs], pa.int64()),
                pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts]),
                pa.array([packed(a[4]) for a, _ in pairs]),
                pa.array(map(packed, new), pa.string()),
                pa.array([likeness(a[4], s) for (a, _), s in zip(pairs, new, strict=True)]),
                pa.array([likeness(a[4], b[4]) for a, b in pairs]),
            ],
            ["doc_id", *(f.split()[0] for f in FIELDS.split(", "))],
        )


def compare_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id and FIELDS: its fingerprint, that of its edited text, and how like they are to it.

    The next document is the one with the next larger id; after the last comes the first. Rows of one id
    follow one another by a hash of their texts. Null texts count as empty, null ids come last, a single
    document is its own next; an empty table gives an empty result. ids are read as bigint.

    Ids are cut into ranges of about equal row counts (from quantiles over all rows); an id, or the null ids, of
    more than a range's rows has several, by the hash of the text. One shuffle brings a range's texts together in
    order, with the first text of the next range behind them.
    """
    rows = texts_only(docs, id_col, text_col).withColumn("none", F.col("doc_id").isNull()).withColumn("doc_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NONE)))
    n = min(MAX_RANGES, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], F.lit(20 * n)).alias("q")).first()["q"] or []
    rows = with_range(rows.withColumn("h", F.xxhash64("text")), sorted(map(int, cuts)))
    heads = sorted((r["r"], r["first"]["doc_id"], r["first"]["h"]) for r in rows.groupBy("r").agg(F.min(F.struct("doc_id", "h")).alias("first")).collect())  # one row for each range
    before = {(i, h): heads[k - 1][0] for k, (_, i, h) in enumerate(heads)}
    copies = F.array(F.struct(F.col("r").alias("r"), F.lit(0).alias("role")))
    if before:
        ahead = docs.sparkSession.createDataFrame([(i, h, r) for (i, h), r in before.items()], "doc_id bigint, h bigint, ahead int")
        rows = rows.join(F.broadcast(ahead), ["doc_id", "h"], "left")
        copies = F.when(F.col("ahead").isNull(), copies).otherwise(F.concat(copies, F.array(F.struct(F.col("ahead").alias("r"), F.lit(1).alias("role")))))
    dealt = rows.select("doc_id", "text", "h", "none", F.inline(copies)).repartition("r").sortWithinPartitions("r", "role", "doc_id", "h", "none")
    return dealt.mapInArrow(_pairs, f"doc_id bigint, {FIELDS}")


def with_range(rows: DataFrame, cuts: list[int]) -> DataFrame:
    """rows and r, the number of the range of doc_id and h, growing with both. A cut that comes m > 1 times has m ranges of its own."""
    if not cuts:
        return rows.withColumn("r", F.lit(0))
    values, times = (a.tolist() for a in np.unique(np.array(cuts, np.int64), return_counts=True))
    own = [m if m > 1 else 0 for m in times]
    base = [1 + k + b for k, b in enumerate(np.cumsum([0, *own[:-1]]).tolist())]
    upto = lambda found: F.size(F.filter(found, lambda c: c <= F.col("doc_id")))
    at, several = F.col("at"), F.col("several")
    part = F.least(F.floor((F.col("h") / F.lit(2.0**64) + 0.5) * several), several - 1)
    inner = F.when((several > 0) & (F.col("doc_id") == F.get(F.lit(values), at)), part).otherwise(several)
    return (  # in steps, so that no search is made twice for a row
        rows.withColumn("block", 64 * F.greatest(upto(F.lit(values[::64])) - 1, F.lit(0)))
        .withColumn("at", F.col("block") + upto(F.slice(F.lit(values), F.col("block") + 1, F.lit(64))) - 1)  # place of the last cut up to the id, -1 if none
        .withColumn("several", F.get(F.lit(own), at))
        .withColumn("r", F.when(at < 0, 0).otherwise(F.get(F.lit(base), at) + inner).cast("int"))
        .drop("block", "at", "several")
    )
