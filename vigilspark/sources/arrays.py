"""Large JSON arrays: one file, read by many tasks.

Spark's text reader cuts a file into byte ranges at closing braces, wherever these stand. One pass counts, for each
range, quotes and brackets under both assumptions, that it starts inside a string or outside of one; one small row
a range tells from these where every range really starts. A second pass cuts the records out; what a range has of a
record that another one begins or ends meets it by that record's first range.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ESCAPE = re.compile(rb"\\.", re.S)


def _brackets(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Places of brackets, +1 or -1 for each, whether an odd number of quotes stands before it, and how many quotes there are."""
    text = np.frombuffer(_ESCAPE.sub(b"  ", data) if b"\\" in data else data, np.uint8)
    quotes = np.flatnonzero(text == 34)
    low = text | 32  # { and [ differ from } and ] in other bits than this
    at = np.flatnonzero(((low == 123) | (low == 125)) & (text >= 91))
    step = np.where(low[at] == 123, 1, -1)
    return at, step, (np.searchsorted(quotes, at) & 1).astype(bool), len(quotes)


def _ranges(batches: Iterator[pa.RecordBatch], names: tuple[str, ...] = ("path", "start")) -> Iterator[tuple[tuple[str, int], bytes, bool]]:
    """The bytes of a task's ranges in order, in pieces: range, bytes, and whether it is the range's first piece."""
    last = None
    for batch in batches:
        keys = list(zip(*(batch.column(n).to_pylist() for n in names), strict=True))
        values, at = batch.column("value").to_pylist(), 0
        while at < len(keys):
            to = at
            while to < len(keys) and keys[to] == keys[at]:
                to += 1
            yield keys[at], b"}".join(values[at:to]) + b"}", keys[at] != last
            last, at = keys[at], to


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each range: its quotes modulo 2; and, for a start outside and inside of a string, by how much it goes down or up, and its lowest depth."""
    found: dict[tuple[str, int], list] = {}
    for key, data, _ in _ranges(batches):
        own = found.setdefault(key, [0, [0, 0], [0, 0]])
        _, step, odd, quotes = _brackets(data)
        for inside in (0, 1):
            run = np.cumsum(step[odd == bool((inside + own[0]) & 1)])
            if len(run):
                own[2][inside] = min(own[2][inside], own[1][inside] + int(run.min()))
                own[1][inside] += int(run[-1])
        own[0] = (own[0] + quotes) & 1
    if found:
        rows = [(*k, q, *depth, *low) for k, (q, depth, low) in found.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["path", "start", "quotes", "out_by", "in_by", "out_low", "in_low"])


def _starts(rows) -> dict[tuple[str, int], tuple[int, int, int]]:
    """Of each range: whether it starts inside a string, at what depth, and the range in which the record that it starts in began (-1: in none)."""
    found, path = {}, None
    for r in sorted(rows, key=lambda r: (r.path, r.start)):
        if r.path != path:
            path, inside, depth, began = r.path, 0, 0, -1
        found[r.path, r.start] = (inside, depth, began)
        by, low = (r.in_by, r.in_low) if inside else (r.out_by, r.out_low)
        goes_on = began >= 0 and depth + low > 1
        inside, depth = inside ^ r.quotes, depth + by
        began = began if goes_on else r.start if depth > 1 else -1
    return found


def _cut(starts):
    """The records of each range, and its parts of those that other ranges share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        key = inside = depth = began = None

        def rest() -> list[tuple]:
            return [(key[0], key[1], key[1] if began is None else began, b"".join(held))] if held else []

        for now, data, first in _ranges(batches):
            out = []
            if first:
                if key is not None:
                    out += rest()
                key, (inside, depth, began), held = now, starts.value[now], []
            at, step, odd, quotes = _brackets(data)
            real = odd == bool(inside)
            at, step = at[real], step[real]
            run = depth + np.cumsum(step)
            open_, close = at[(run == 2) & (step == 1)], at[(run == 1) & (step == -1)]
            if depth > 1:  # in a record that an earlier piece began
                end = int(close[0]) + 1 if len(close) else len(data)
                held.append(data[:end])
                if len(close):
                    whole, close = b"".join(held), close[1:]
                    out.append((key[0], None, None, whole) if began is None else (key[0], key[1], began, whole))
                    held = []
            began = None if depth <= 1 or not held else began
            for a, b in zip(open_.tolist(), close.tolist(), strict=False):
                out.append((key[0], None, None, data[a : b + 1]))
            if len(open_) > len(close):
                held, began = [data[int(open_[-1]) :]], None
            inside, depth = (inside + quotes) & 1, int(run[-1]) if len(run) else depth
            if out:
                yield _parts(out)
        if key is not None and (out := rest()):
            yield _parts(out)

    return run


def _parts(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["path", "start", "began", "part"])


def array_texts(spark: SparkSession, path: str) -> DataFrame:
    """value: the text of each object of the JSON arrays at path. Elements that are no objects are left out.

    Ranges are those of spark.sql.files.maxPartitionBytes. What reaches the driver is one small row a range.
    """
    pieces = spark.read.option("lineSep", "}").text(path).select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
    rows = pieces.mapInArrow(_counted, "path string, start bigint, quotes bigint, out_by bigint, in_by bigint, out_low bigint, in_low bigint").collect()
    starts = spark.sparkContext.broadcast(_starts(rows))
    cut = pieces.mapInArrow(_cut(starts), "path string, start bigint, began bigint, part binary")
    whole = cut.filter("began IS NULL").select(F.col("part").cast("string").alias("value"))
    shared = cut.filter("began IS NOT NULL").groupBy("path", "began").agg(F.array_sort(F.collect_list(F.struct("start", "part"))).alias("p"))
    # at most one part a range and record
    joined = F.aggregate("p", F.lit(b""), lambda text, x: F.concat(text, x["part"]))
    return whole.unionByName(shared.select(joined.cast("string").alias("value"))).filter(F.startswith("value", F.lit("{")))


def read_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The objects of the JSON arrays at path as rows of a schema; a large file is many tasks."""
    return array_texts(spark, path).select(F.from_json("value", schema).alias("r")).select("r.*")
