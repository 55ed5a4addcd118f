"""Change detection by content hash, current state, versions and events.

Tables: captures (regulation, source, document_id, content, ts, title, url, ext, filename; content_type,
http_status and source_metadata where there are any) and current state (STATE). All joins are on the three-part key, so one shuffle of hashes and metadata serves a whole batch;
content is hashed where it is read and does not move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

KEY = ["regulation", "source", "document_id"]
VERSION = "struct<ts:timestamp_ntz,hash:string,size_bytes:bigint>"
STATE = {
    "title": "string", "original_filename": "string", "canonical_url": "string", "first_seen_at": "timestamp_ntz", "last_scraped_at": "timestamp_ntz",
    "last_checked_at": "timestamp_ntz", "last_changed_at": "timestamp_ntz", "current_hash": "string", "current_storage_path": "string",
    "size_bytes": "bigint", "version_history": f"array<{VERSION}>", "content_type": "string", "source_metadata": "map<string,string>",
}
#: Fixed value: the content that marks an item known to have no file.
SENTINEL = '{"not_applicable": true}'


def hashed(captures: DataFrame) -> DataFrame:
    """Adds content_hash (SHA-256, lowercase hex) and size_bytes, and drops the content."""
    return captures.withColumns({"content_hash": F.sha2(F.col("content").cast("binary"), 256), "size_bytes": F.octet_length("content").cast("bigint")}).drop("content")


def current_path(ext: Column) -> Column:
    return F.concat_ws("/", "regulation", "source", F.lit("documents"), "document_id", F.concat(F.lit("current."), ext))


def version_path(changed_at: Column, old_hash: Column, ext: Column) -> Column:
    """Path of an archived version: the ISO time (UTC) of its change without : and -, its hash's first 8 characters and the new extension."""
    micros = F.regexp_replace(F.date_format(changed_at, ".SSSSSS"), "^[.]000000$", "")
    stamp = F.concat(F.date_format(changed_at, "yyyyMMdd'T'HHmmss"), micros, F.lit("+0000"))
    return F.concat_ws("/", "regulation", "source", F.lit("documents"), "document_id", F.lit("versions"), F.concat(stamp, F.lit("__"), F.substring(old_hash, 1, 8), F.lit("."), ext))


def event_path(ts: Column, run_id: Column, seq: Column, event: Column) -> Column:
    """Day folder, then run, number within the run, document and event; slashes in the id as _."""
    name = F.concat_ws("__", run_id, F.lpad(seq.cast("string"), 5, "0"), F.replace(F.col("document_id"), F.lit("/"), F.lit("_")), event)
    return F.concat_ws("/", "regulation", "source", F.lit("_manifest/events"), F.date_format(ts, "yyyy/MM/dd"), F.concat(name, F.lit(".json")))


def empty_state(captures: DataFrame) -> DataFrame:
    return captures.select(*KEY).limit(0).select(*KEY, *(F.lit(None).cast(t).alias(c) for c, t in STATE.items()))


def _own(captures: DataFrame, name: str, kind: str) -> Column:
    """A column that captures may lack."""
    return F.col(name) if name in captures.columns else F.lit(None).cast(kind)


def classify(captures: DataFrame, state: DataFrame) -> DataFrame:
    """Adds event to hashed captures (new, unchanged or updated), old_hash and held_path, where the held content is. One capture per document."""
    known = state.select(*KEY, F.col("current_hash").alias("old_hash"), F.col("current_storage_path").alias("held_path"), F.lit(True).alias("held"))
    event = F.when(F.col("held").isNull(), "new").when(F.col("old_hash") == F.col("content_hash"), "unchanged").otherwise("updated")
    return captures.join(known, KEY, "left").withColumn("event", event).drop("held")


def no_metadata() -> Column:
    return F.create_map().cast("map<string,string>")


def merge(captures: DataFrame, state: DataFrame) -> DataFrame:
    """The state after a batch of hashed captures. An unchanged capture touches only last_checked_at and a missing file name.

    Several captures of one document count one after the other, by time and hash: each that differs from the one
    before is a version, and the last of these is current. Only versions and one row a document are gathered. A
    capture without content does not count. state has one row a document. Both sides are shuffled by KEY at most once; a side that lies in buckets of KEY is not.
    """
    taken = F.struct(
        "ts", "content_hash", "size_bytes", "title", "url", "ext", "filename", _own(captures, "content_type", "string").alias("content_type"),
        F.coalesce(_own(captures, "source_metadata", "map<string,string>"), no_metadata()).alias("source_metadata"),
    )
    before = F.lag("content_hash").over(Window.partitionBy(*KEY).orderBy("ts", "content_hash"))
    by_time = lambda a, b: F.when(a["ts"] < b["ts"], -1).when(a["ts"] > b["ts"], 1).when(a["content_hash"] < b["content_hash"], -1).otherwise(1)
    rows = captures.filter("content_hash IS NOT NULL").withColumn("_before", before).withColumn("_version", F.when(~F.col("_before").eqNullSafe(F.col("content_hash")), taken))
    batch = rows.groupBy(*KEY).agg(
        F.array_sort(F.collect_list("_version"), by_time).alias("_all"), F.min("ts").alias("_first"), F.max("ts").alias("_last"),
        F.min_by("filename", F.when(F.col("filename").isNotNull(), F.struct("ts", "content_hash"))).alias("_named"),
    )
    both = state.alias("o").join(batch.alias("n"), KEY, "full_outer")
    # the first of the batch is no version if it is what is held
    same = F.get("_all", F.lit(0))["content_hash"].eqNullSafe(F.col("o.current_hash"))
    both = both.withColumn("_new", F.when(same, F.slice("_all", F.lit(2), F.greatest(F.size("_all") - 1, F.lit(0)))).otherwise(F.coalesce("_all", F.array().cast(rows.select(F.array("_version")).schema[0].dataType))))
    names = F.filter(F.transform("_new", lambda v: v["filename"]), lambda f: f.isNotNull())
    v, changed, now = F.element_at("_new", F.when(F.size("_new") > 0, -1)), F.size("_new") > 0, F.col("_last").cast("timestamp_ntz")
    take = lambda a, b: F.when(changed, a).otherwise(b)
    when = v["ts"].cast("timestamp_ntz")
    versions = F.transform("_new", lambda x: F.struct(x["ts"].cast("timestamp_ntz").alias("ts"), x["content_hash"].alias("hash"), x["size_bytes"].alias("size_bytes")))
    path = F.concat_ws("/", "regulation", "source", F.lit("documents"), "document_id", F.concat(F.lit("current."), v["ext"]))
    return both.select(
        *KEY,
        take(v["title"], F.col("o.title")).alias("title"),
        F.coalesce(F.get(names, F.size(names) - 1), "o.original_filename", "_named").alias("original_filename"),
        take(v["url"], F.col("o.canonical_url")).alias("canonical_url"),
        F.coalesce(F.col("o.first_seen_at"), F.col("_first").cast("timestamp_ntz")).alias("first_seen_at"),
        take(when, F.col("o.last_scraped_at")).alias("last_scraped_at"),
        F.coalesce(now, F.col("o.last_checked_at")).alias("last_checked_at"),
        take(when, F.col("o.last_changed_at")).alias("last_changed_at"),
        take(v["content_hash"], F.col("o.current_hash")).alias("current_hash"),
        take(path, F.col("o.current_storage_path")).alias("current_storage_path"),
        take(v["size_bytes"], F.col("o.size_bytes")).alias("size_bytes"),
        take(v["content_type"], F.col("o.content_type")).alias("content_type"),
        take(v["source_metadata"], F.col("o.source_metadata")).alias("source_metadata"),
        take(F.concat(F.coalesce("o.version_history", F.array().cast(f"array<{VERSION}>")), versions), F.col("o.version_history")).alias("version_history"),
    )


def replaced(captures: DataFrame, state: DataFrame) -> DataFrame:
    """Versions that a batch replaces, with the path under which each is archived."""
    old = state.select(*KEY, "current_hash", "current_storage_path", "last_changed_at")
    both = captures.join(old, KEY).filter("current_hash <> content_hash AND current_storage_path IS NOT NULL")
    return both.select(*KEY, "current_hash", "current_storage_path", version_path(F.col("last_changed_at"), F.col("current_hash"), F.col("ext")).alias("archive_path"))


def archived(replaced: DataFrame, files: DataFrame) -> DataFrame:
    """The bytes of replaced versions under their archive path: archive_path, content_hash, size_bytes, content.

    files: path and content, as a reader of raw files gives them. A version whose file is gone is left out.
    """
    held = files.select(F.col("path").alias("current_storage_path"), "content")
    return replaced.join(held, "current_storage_path").select(
        *KEY, "archive_path", F.sha2("content", 256).alias("content_hash"), F.octet_length("content").cast("bigint").alias("size_bytes"), "content"
    )


def replay(captures: DataFrame) -> DataFrame:
    """Versions of every document from any number of hashed captures: those whose hash differs from the one before. A return to an old hash is a new version."""
    before = F.lag("content_hash").over(Window.partitionBy(*KEY).orderBy("ts"))
    return captures.withColumn("before", before).filter(~F.col("before").eqNullSafe(F.col("content_hash"))).drop("before")


def histories(captures: DataFrame) -> DataFrame:
    """version_history of every document, oldest first, and its length."""
    entry = F.struct(F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("content_hash").alias("hash"), F.col("size_bytes").alias("size_bytes"))
    return replay(captures).groupBy(*KEY).agg(F.array_sort(F.collect_list(entry)).alias("version_history")).withColumn("version_count", version_count(F.col("version_history")))


def version_count(history: Column) -> Column:
    return F.greatest(F.coalesce(F.size(history), F.lit(0)), F.lit(1)).cast("bigint")


def events(classified: DataFrame, run_id: Column) -> DataFrame:
    """One fetch event per classified capture. An unchanged one tells the path of what is held, the others that of the new content."""
    path = F.when(F.col("event") == "unchanged", F.col("held_path")).otherwise(current_path(F.col("ext")))
    return classified.select(
        run_id.alias("run_id"), *KEY, "event", "ts", "url", _own(classified, "http_status", "int").alias("http_status"),
        "content_hash", path.alias("storage_path"), F.lit(None).cast("string").alias("error"),
    )


def error_events(failed: DataFrame, run_id: Column) -> DataFrame:
    """Fetch events of outcomes without content: error and its text, no hash and no path."""
    none = lambda kind: F.lit(None).cast(kind)
    return failed.select(
        run_id.alias("run_id"), *KEY, F.lit("error").alias("event"), "ts", "url", none("int").alias("http_status"),
        none("string").alias("content_hash"), none("string").alias("storage_path"), "error",
    )


def ordered(value: Column, kind: DataType) -> Column:
    """A value with its fields and keys in order of name, at every level: structs, arrays and maps. VARIANT objects have theirs in order by themselves."""
    if isinstance(kind, StructType):
        fields = F.struct(*(ordered(value.getField(f.name), f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)))
        return F.when(value.isNotNull(), fields)
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: ordered(x, kind.elementType)) if _nested(kind.elementType) else value
    if isinstance(kind, MapType):
        keys = F.array_sort(F.map_keys(value))
        return F.map_from_arrays(keys, F.transform(keys, lambda k: ordered(F.element_at(value, k), kind.valueType)))
    return value


def _nested(kind: DataType) -> bool:
    return isinstance(kind, StructType | ArrayType | MapType)


def canonical(rows: DataFrame, columns: list[str] | None = None) -> Column:
    """JSON of columns (all, if not given), nulls included, with fields and keys in order at every level, so that their order never looks like a change."""
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    told = F.struct(*(ordered(F.col(f"`{c}`"), kinds[c]).alias(c) for c in sorted(columns or kinds)))
    return F.to_json(told, {"ignoreNullFields": "false"})


def settled_miss(row_ok: Column, content: Column) -> Column:
    """Content of a capture: the file, or the sentinel that marks an item known to have none."""
    return F.when(row_ok, content).otherwise(F.lit(SENTINEL))


def not_applicable(rows: DataFrame, title: Column, reason: Column, *keys: str) -> DataFrame:
    """Captures of items known to have no file, so that later runs skip them: the sentinel, a title, and metadata of the keys, not_applicable and reason."""
    pairs = [x for k in keys for x in (F.lit(k), F.col(k).cast("string"))]
    metadata = F.create_map(*pairs, F.lit("not_applicable"), F.lit("true"), F.lit("reason"), reason)
    return rows.withColumns({
        "title": title, "content": F.lit(SENTINEL), "ext": F.lit("json"), "content_type": F.lit("application/json"),
        "http_status": F.lit(200), "source_metadata": metadata,
    })


def registry_diff(old: DataFrame, new: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    """insert, update, unchanged or delete for each key of two registries."""
    a, b = old.select(*key, *(F.col(v).alias(f"old_{v}") for v in values), F.lit(1).alias("in_old")), new.select(*key, *values, F.lit(1).alias("in_new"))
    same = F.lit(True)
    for v in values:
        same &= F.col(v).eqNullSafe(F.col(f"old_{v}"))
    action = F.when(F.col("in_old").isNull(), "insert").when(F.col("in_new").isNull(), "delete").when(same, "unchanged").otherwise("update")
    return a.join(b, key, "full_outer").select(*key, *values, action.alias("action"))
