"""Structured Streaming forms of the event, change and log operators."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vigilspark.operators.changes import KEY
from vigilspark.sources import tables

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def source(spark: SparkSession, root: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files below root, each read once."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(root)


def run_to_end(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Everything that is there now, to a Parquet table at out; the checkpoint makes a second call go on where the first ended.

    Append mode uses the exactly-once file sink. In update mode each batch's rows get its number, and the result is the last of each key by callers.
    """
    writer = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
    if mode == "append":
        query = writer.format("parquet").option("path", out).outputMode("append").start()
        query.awaitTermination()
    else:
        on_batch(stream, lambda df, n: df.write.mode("overwrite").parquet(f"{out}/batch={n}"), checkpoint, mode)
    return stream.sparkSession.read.parquet(out)


def on_batch(stream: DataFrame, callback: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Calls back with every batch of the stream and its number, to the end of what is there now. After a failure the last batch may come again under its number."""
    writer = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).outputMode(mode)
    writer.foreachBatch(callback).start().awaitTermination()


def json_files(spark: SparkSession, root: str, glob: str = "*.json", files_per_batch: int | None = None) -> DataFrame:
    """New files below root, in folders of any depth, each once: path, content."""
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
    reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).load(root).select("path", "content")


def ingest_json(
    spark: SparkSession, root: str, schema: str, good: str, bad: str, checkpoint: str, glob: str = "*.json", multiline: bool = True, files_per_batch: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Every new file's records to a table at good, and what is no record to one at bad, with path and reason, to the end of what is there now.

    One record a file, or one a line; a file is read as one value. Both tables are written under the batch's number, so a batch that comes again
    after a failure replaces itself: nothing is there twice, and nothing is lost between the two. Files without
    bytes, which no stream gives, are listed anew by each call, in a part of bad of their own.
    """

    def both(df: DataFrame, n: int) -> None:
        text = F.col("content").cast("string")
        value = text if multiline else F.explode(F.filter(F.split(text, "\\r?\\n"), lambda x: F.trim(x) != ""))
        read = tables.judged(df.select("path", value.alias("value")), schema).persist()  # two writes, one reading
        for rows, out in zip(tables.lenient(read), (good, bad), strict=True):
            rows.write.mode("overwrite").parquet(f"{out}/batch={n}")
        read.unpersist()

    on_batch(json_files(spark, root, glob, files_per_batch), both, checkpoint)
    empty = tables.empty_files(spark, root, glob).select(F.lit("").alias("value"), "path")
    tables.lenient(tables.judged(empty, schema))[1].write.mode("overwrite").parquet(f"{bad}/batch=-1")
    return tuple(spark.read.parquet(out).drop("batch") for out in (good, bad))


def live_counters(events: DataFrame) -> DataFrame:
    """Running counts per run and event (update mode)."""
    return events.groupBy("run_id", "event").agg(F.count("*").alias("n"))


def daily(events: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Events per UTC day and kind; a day is told once the watermark has passed it."""
    counted = events.withWatermark("ts", lateness).groupBy(F.window("ts", "1 day"), "event").agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("day"), "event", "n")


def sessions(log: DataFrame, silence: str = "5 seconds", by: str = "origin") -> DataFrame:
    """Stretches of activity per origin that no silence of that length interrupts."""
    grouped = log.withWatermark("ts", "1 minute").groupBy(F.session_window("ts", silence), by).agg(F.count("*").alias("n"))
    return grouped.select(by, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def corrections(records: DataFrame, keys: list[str], lateness: str = "30 days") -> DataFrame:
    """Each distinct (id, hash) once while it is inside the lookback window, so late edits pass and repeats do not."""
    return records.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(keys)


@contextmanager
def rocksdb(spark: SparkSession):
    """The state store that keyed state with timers and initial state needs, for the streams started within."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: Keyed state lies in so many buckets of ids: each batch then has a few calls to the state store for each bucket it
#: touches, and none for each id. A bucket's state is read and written as one text, so take a number by which it holds
#: some thousands of ids at most; it must stay the same as long as a checkpoint is used.
BUCKETS = 4096


def bucket(key: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int").alias("_bucket")


class _Held:
    """A bucket's rows as one JSON value of the state store."""

    def __init__(self, handle: StatefulProcessorHandle, name: str) -> None:
        self.value = handle.getValueState(name, "rows string")

    def get(self) -> list:
        return json.loads(self.value.get()[0]) if self.value.exists() else []

    def put(self, rows: list) -> None:
        if rows:
            self.value.update((json.dumps(rows, separators=(",", ":")),))
        else:
            self.value.clear()


class _Changes(StatefulProcessor):
    """Keeps the current hash of each document of a bucket and tells what each capture does to it: at once, or once the watermark has passed its time."""

    def __init__(self, waits: bool) -> None:
        self.waits = waits

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.current = _Held(handle, "current")
        if self.waits:
            self.pending = _Held(handle, "pending")

    def _hashes(self) -> dict:
        return {tuple(key): digest for *key, digest in self.current.get()}

    def _keep(self, held: dict) -> None:
        self.current.put([(*key, digest) for key, digest in held.items()])

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        held = self._hashes()  # a bucket's rows may come in several parts
        for *document, digest in initialState[[*KEY, "current_hash"]].itertuples(index=False, name=None):
            held[tuple(document)] = digest
        self._keep(held)

    def _judged(self, captures: list) -> Iterator[pd.DataFrame]:
        held, out = self._hashes(), []
        for *document, us, digest in sorted(captures, key=lambda c: c[-2:]):
            before = held.get(tuple(document))
            out.append((*document, us, digest, "new" if before is None else "unchanged" if before == digest else "updated"))
            held[tuple(document)] = digest
        self._keep(held)
        yield pd.DataFrame(out, columns=[*KEY, "us", "content_hash", "event"])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        captures = [c for frame in rows for c in zip(*(frame[n].tolist() for n in (*KEY, "us", "content_hash")), strict=True)]
        if not self.waits:
            yield from self._judged(captures)
            return
        waiting = self.pending.get()
        self.pending.put(waiting + captures)
        first = self._due(captures)
        if not waiting or first < self._due(waiting):
            self.handle.registerTimer(first)

    @staticmethod
    def _due(captures: list) -> int:
        """When the watermark has passed the first of them."""
        return min(c[-2] for c in captures) // 1000 + 1

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        captures = self.pending.get()
        due = [c for c in captures if c[-2] // 1000 + 1 <= until]
        if due:
            later = [c for c in captures if c[-2] // 1000 + 1 > until]
            self.pending.put(later)
            if later:  # the bucket's only timer is the one of its first capture
                self.handle.registerTimer(self._due(later))
            yield from self._judged(due)

    def close(self) -> None:
        pass


def changes(captures: DataFrame, held: DataFrame | None = None, lateness: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Streaming change detection, keyed by document: the event of each capture.

    held: a state that the stream takes over from (KEY, current_hash), read once when its checkpoint is new. Without
    lateness captures are judged as they come, in order of time within a batch. With it a capture waits until the
    watermark, so much behind the latest time seen, has passed its time; so one that comes later than captures of
    later times is still judged in its place. One that comes behind the watermark is left out.
    """
    timed = captures.filter("content_hash IS NOT NULL").withColumn("us", F.unix_micros("ts"))
    if lateness is not None:
        timed = timed.withWatermark("ts", lateness)
    of = bucket(KEY, buckets)
    first = held.select(*KEY, "current_hash", of).groupBy("_bucket") if held is not None else None
    schema = "regulation string, source string, document_id string, us bigint, content_hash string, event string"
    told = timed.select("*", of).groupBy("_bucket").transformWithStateInPandas(_Changes(lateness is not None), schema, "append", "none" if lateness is None else "eventTime", first)
    return told.select(*KEY, F.timestamp_micros("us").alias("ts"), "content_hash", "event")


class _Edits(StatefulProcessor):
    """Keeps the last hash and time of each record of a bucket for a while; tells new content, and what comes too late."""

    def __init__(self, hold_ms: int) -> None:
        self.hold = hold_ms * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = _Held(handle, "last")

    def _gone(self, us: int) -> int:
        """When what is held since then goes."""
        return (us + self.hold) // 1000 + 1

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        late_before = timerValues.getCurrentWatermarkInMs()
        kept = self.last.get()
        held, out = {i: (digest, us) for i, digest, us in kept}, []
        first = min((us for *_, us in kept), default=None)
        changed = False
        records = [r for frame in rows for r in zip(frame["us"].tolist(), frame["content_hash"].tolist(), frame["id"].tolist(), strict=True)]
        for us, digest, i in sorted(records, key=lambda r: (r[0], r[1] or "")):
            if us // 1000 < late_before:
                out.append((i, us, digest, "late"))
                continue
            last = held.get(i)
            if last is None or us >= last[1] + self.hold or last[0] != digest:
                out.append((i, us, digest, "passed"))
            held[i] = (digest, us if last is None else max(us, last[1]))
            changed = True
        if changed:
            self.last.put([(i, *last) for i, last in held.items()])
            oldest = min(us for _, us in held.values())
            if oldest != first:
                self.handle.registerTimer(self._gone(oldest))
        if out:
            yield pd.DataFrame(out, columns=["id", "us", "content_hash", "outcome"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        kept = self.last.get()
        left = [r for r in kept if self._gone(r[-1]) > until]
        if len(left) < len(kept):
            self.last.put(left)
            if left:
                self.handle.registerTimer(self._gone(min(r[-1] for r in left)))
        yield from ()

    def close(self) -> None:
        pass


def edits(records: DataFrame, lateness: str = "30 days", hold_days: int = 30, buckets: int = BUCKETS) -> DataFrame:
    """Records (id, content_hash, ts) whose content is new: passed; and those that come behind the watermark: late (they change nothing).

    Within a batch a record's rows count by time. One passes if nothing is held of its id, if the hash is another one than the
    last, or if the last is hold_days old by the rows' times. What is held of an id goes once the watermark has passed
    that, so state does not grow with all ids ever seen. Repeats give no row.
    """
    # the processor itself tells late rows, so the column that has the watermark does not reach it
    timed = records.withWatermark("ts", lateness).select(F.col("id").cast("string").alias("id"), "content_hash", F.unix_micros("ts").alias("us"))
    told = timed.select("*", bucket(["id"], buckets)).groupBy("_bucket").transformWithStateInPandas(_Edits(hold_days * 86_400_000), "id string, us bigint, content_hash string, outcome string", "append", "eventTime")
    return told.select("id", F.timestamp_micros("us").alias("ts"), "content_hash", "outcome")
