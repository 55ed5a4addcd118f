"""Readers and writers of the monitor's tables. Every reader has a fixed schema, so nothing is inferred."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT = "run_id string, regulation string, source string, document_id string, event string, ts timestamp, url string, http_status int, content_hash string, storage_path string, error string"
DOCUMENT = "regulation string, source string, document_id string, title string, original_filename string, canonical_url string, first_seen_at string, last_scraped_at string, last_checked_at string, last_changed_at string, current_hash string, current_storage_path string, content_type string, size_bytes bigint, version_history array<struct<ts:string,hash:string,size_bytes:bigint>>, source_metadata map<string,string>"
RUN = (
    "run_id string, regulation string, source string, started_at string, finished_at string, status string, checked bigint, new bigint, updated bigint, "
    "unchanged bigint, errors bigint, part int, error_details array<struct<document_id:string,error:string>>, skipped_already_known bigint, stop_reason string"
)
ESTIMATE = (
    "regulation string, source string, computed_at string, total_available bigint, already_known bigint, remaining bigint, note string, "
    "next_available_at string, next_available_note string"
)
LOG = "ts timestamp, level string, logger string, message string"
CORRUPT = "_corrupt"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one that the cluster shares; a temporary one only where that is unset."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("on a cluster, spark.checkpoint.dir names a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="vigilspark-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def manifest(root: str, kind: str = "") -> str:
    """Where the records of all sources below root lie: kind is events, runs, or empty for the folder of the estimates. Spark passes over folders with a leading underscore unless the path names them."""
    return f"{root.rstrip('/')}/*/*/_manifest/{kind}".rstrip("/")


def judged(texts: DataFrame, schema: str) -> DataFrame:
    """Records of texts (value, path): the schema's fields, mistyped, path, reason and _corrupt.

    reason: null for a record, else why the text is none: empty, undecodable (no UTF-8; the text is then kept as
    base64), or unparsable. A field of another type than the schema's does not spoil its record: it is null there,
    and mistyped has its text.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    raw = F.col("value")
    bare = F.trim(F.coalesce(raw, F.lit("")), F.lit(" \t\r\n"))
    # the parser passes over what follows a value, so the text is the one element of a list
    listed = F.when(F.col("_ok") & bare.endswith("}"), F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]"))))
    rows = texts.withColumn("_ok", F.is_valid_utf8(raw)).withColumn("_l", listed)
    rows = rows.withColumn("_v", F.when(F.try_variant_get("_l", "$[1]", "variant").isNull(), F.try_variant_get("_l", "$[0]", "variant")))
    reason = F.when(bare == "", "empty").when(~F.col("_ok"), "undecodable").when(F.col("_v").isNull() | ~F.startswith(F.schema_of_variant("_v"), F.lit("OBJECT")), "unparsable")
    rows = rows.withColumn("reason", reason).withColumn("r", F.from_json(F.when(F.col("reason").isNull(), raw), f"{schema}, {CORRUPT} string", options))
    fields = [f.name for f in rows.schema["r"].dataType.fields if f.name != CORRUPT]
    odd = lambda n: F.when(F.col(f"r.{n}").isNull(), F.get_json_object("value", f"$.{n}"))
    pairs = F.filter(F.array(*(F.struct(F.lit(n).alias("key"), odd(n).alias("value")) for n in fields)), lambda p: p["value"].isNotNull())
    mistyped = F.when(F.col(f"r.{CORRUPT}").isNotNull(), F.map_from_entries(pairs))
    kept = F.when(F.col("reason") == "undecodable", F.base64(raw.cast("binary"))).when(F.col("reason").isNotNull(), raw)
    return rows.select(*(F.col(f"r.{n}") for n in fields), mistyped.alias("mistyped"), "path", "reason", kept.alias(CORRUPT))


def empty_files(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """path of each file without bytes. Spark's scans pass over these, so they are what the listing, which the driver makes for a scan anyway, has and no scan gives. Only where the two differ in number are paths compared."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    place = F.regexp_replace(F.coalesce(F.try_url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))), "path"), "^file:/+", "file:/")
    files = listed._jdf.inputFiles()  # a list in the JVM
    if len(files) == listed.count():
        return listed.filter("false").select("path")
    names = spark.createDataFrame([(f,) for f in files], "path string")
    return names.withColumn("_p", place).join(listed.select(place.alias("_p")), "_p", "left_anti").select("path")


def read_json(spark: SparkSession, root: str, schema: str, glob: str = "*.json", multiline: bool = True) -> DataFrame:
    """A tree of JSON files: one record a file, or one a line (blank ones do not count), judged. A file without bytes is an empty text."""
    texts = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(root, wholetext=multiline).select("value", F.col("_metadata.file_path").alias("path"))
    texts = texts if multiline else texts.filter(F.trim("value") != "")
    return judged(texts.unionByName(empty_files(spark, root, glob).select(F.lit("").alias("value"), "path")), schema)


def lenient(read: DataFrame, mistyped: bool = False) -> tuple[DataFrame, DataFrame]:
    """Good rows (with mistyped, if asked for), and what is none, with its path and reason."""
    good = read.filter("reason IS NULL").drop("reason", CORRUPT)
    return good if mistyped else good.drop("mistyped"), read.filter("reason IS NOT NULL").select("path", "reason", CORRUPT)


def read_events(spark: SparkSession, root: str, multiline: bool = True) -> DataFrame:
    return lenient(read_json(spark, root, EVENT, multiline=multiline))[0]


def read_documents(spark: SparkSession, root: str, glob: str = "current.meta.json", multiline: bool = True) -> DataFrame:
    """Document sidecars only: files named current.meta.json, unless another pattern is given."""
    return lenient(read_json(spark, root, DOCUMENT, glob, multiline))[0]


def read_runs(spark: SparkSession, root: str, multiline: bool = True) -> DataFrame:
    return lenient(read_json(spark, root, RUN, multiline=multiline))[0]


def read_estimates(spark: SparkSession, root: str, glob: str = "estimate.json", multiline: bool = True) -> DataFrame:
    return lenient(read_json(spark, root, ESTIMATE, glob, multiline))[0]


def read_bytes(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Raw files: path, size_bytes, content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    return files.select("path", F.col("length").alias("size_bytes"), "content")


def read_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A bulk JSON array, one row per element."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_log(spark: SparkSession, root: str) -> DataFrame:
    """JSON-lines request logs: the four fixed fields, and all others as a VARIANT in extras."""
    lines = spark.read.text(root)
    row = lines.select(F.from_json("value", LOG).alias("r"), F.try_parse_json("value").alias("extras"))
    return row.select("r.*", "extras")


def extra(field: str, kind: str):
    return F.try_variant_get("extras", f"$.{field}", kind)


def write_lines(lines: DataFrame, root: str) -> None:
    """Lines of text, in a folder below root. A task without rows leaves no file in it, while one that writes to root itself may leave a file without bytes, which readers tell as an empty record."""
    lines.select("value", F.lit("lines").alias("kind")).write.partitionBy("kind").text(root)


def by_folder(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of one folder together, so that a write leaves few files in it and not one for each task. Spark splits a hot folder."""
    return rows.hint("rebalance", *keys)


def write_state(state: DataFrame, root: str) -> None:
    """Replaces the current state of the namespaces in state and leaves the others."""
    by_folder(state, "regulation", "source").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("regulation", "source").parquet(root)


def append_events(events: DataFrame, root: str) -> None:
    """Adds events, by namespace and day."""
    dated = events.withColumn("day", F.to_date("ts"))
    by_folder(dated, "regulation", "source", "day").write.mode("append").partitionBy("regulation", "source", "day").parquet(root)


def write_log(log: DataFrame, root: str, session: str = "session_id") -> None:
    by_folder(log, session).write.mode("append").partitionBy(session).json(root)


def append_versions(archived: DataFrame, root: str) -> None:
    """Adds replaced versions: their archive path and, where the frame has them, their bytes."""
    by_folder(archived, "regulation", "source").write.mode("append").partitionBy("regulation", "source").parquet(root)


def write_estimates(estimates: DataFrame, root: str) -> None:
    """One snapshot per source; those of other sources stay."""
    estimates.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("regulation", "source").parquet(root)


def append_runs(runs: DataFrame, root: str) -> None:
    by_folder(runs, "regulation", "source").write.mode("append").partitionBy("regulation", "source").parquet(root)


def write_buckets(state: DataFrame, name: str, root: str, buckets: int, *key: str) -> DataFrame:
    """A state as a table of the catalogue in buckets of its key, below root; replaces one of that name.

    What is merged with it by the key moves, in as many partitions (in_buckets), and the state does not; nor does the result
    when it is written back in as many buckets, to another root. Take the number so that a bucket of the state fits a task.
    """
    state.write.mode("overwrite").option("path", root).bucketBy(buckets, *key).sortBy(*key).saveAsTable(name)
    return state.sparkSession.table(name)


def in_buckets(batch: DataFrame, buckets: int, *key: str) -> DataFrame:
    """A batch in the partitions of a state's buckets."""
    return batch.repartition(buckets, *key)


def expired(then: Column, now: Column, days: Column | int) -> Column:
    """Whether a file of that time is older than the days for which files are kept. None or fewer days: files are kept for ever; so is a file without a time."""
    days = F.lit(days) if isinstance(days, int) else days
    return F.coalesce((days > 0) & (F.unix_micros(then) < F.unix_micros(now) - days.cast("bigint") * 86_400_000_000), F.lit(False))


def expired_files(spark: SparkSession, root: str, now: Column, days: int, glob: str = "*.log") -> DataFrame:
    """path and modified of the files below root that are to be removed. Only the listing is read, no file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    return files.filter(expired(F.col("modificationTime"), now, days)).select("path", F.col("modificationTime").alias("modified"))
