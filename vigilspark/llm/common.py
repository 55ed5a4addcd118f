"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one numpy step holds at most, unless a single text is longer.
SLICE_BYTES = 512 << 10
#: Rows of such a step at most.
SLICE_ROWS = 4096


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one only where that is unset."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("on a cluster, spark.checkpoint.dir names a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="vigilspark-"))
        found = spark.sparkContext.getCheckpointDir()
    return found


def written(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage: df as a Parquet table in the shared folder, read back."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def drop(*tables: DataFrame) -> None:
    """Removes tables that written has made and that nothing will read again."""
    for table in tables:
        jvm = table.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(table.written_at)
        path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """As written, but in buckets of a key, so that a later join or grouping by it leaves these rows where they are."""
    name = f"{name}_{uuid.uuid4().hex}"
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/{name}"
    df.write.option("compression", "zstd").option("path", path).bucketBy(buckets, key).saveAsTable(name)
    out = df.sparkSession.table(name)
    df.sparkSession.sql(f"DROP TABLE `{name}`")  # the frame knows files and buckets by now, and the catalogue keeps nothing
    return out


def partitions_for(df: DataFrame, each: int = 32 << 20) -> int:
    """How many partitions a shuffle of df's rows takes: one for so many bytes of input by the plan's statistics, and one a core at least."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(df.sparkSession.sparkContext.defaultParallelism, min(size // each, 100_000))


def texts_only(df: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """The columns that an operator needs, under its own names, so that other columns can't clash. Null text: empty."""
    return df.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
        *(F.col(f"`{c}`") for c in more),
    )


def free_name(name: str, taken: list[str]) -> str:
    """A column name that is not taken."""
    while name in taken:
        name += "_"
    return name


def trim() -> None:
    """Hands memory that an earlier task of this Python worker has left back to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that each holds at most so many bytes of text (or one row) and SLICE_ROWS rows."""
    trim()
    for batch in batches:
        column = batch.column(text)
        n = len(column)
        if not n:
            continue
        wide = column.type in (pa.large_string(), pa.large_binary())
        ends = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1]
        at = 0
        while at < n:
            to = min(n, at + SLICE_ROWS, max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1))
            yield batch.slice(at, to - at)
            at = to


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column's rows, end to end, and len + 1 offsets into them."""
    wide = column.type in (pa.large_string(), pa.large_binary())
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) if not isinstance(c, pa.Array) else c for c, f in zip(columns, schema, strict=True)], schema=schema)


def lists(flat: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from its values end to end and the rows' lengths."""
    ends = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))
