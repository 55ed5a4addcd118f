"""Queries over captured documents: change detection, candidates, state and versions.

Snapshots of the documents table stand for batches of captures: A leaves out every tenth document, B every
thirteenth and changes every seventh, C is A again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilspark.functions import columns as fn
from vigilspark.operators import changes, runs, select
from vigilspark.operators.changes import KEY
from vigilspark.plans.registry import query, read
from vigilspark.sources import tables

TIMES = {"A": "2024-01-01 00:00:00", "B": "2024-01-15 12:30:00", "C": "2024-02-01 00:00:00"}
_CONTENT = {"A": "text", "B": "CASE WHEN doc_id % 7 = 0 THEN concat(text, ' v2') ELSE text END", "C": "text"}
_HELD = {"A": "doc_id % 10 <> 0", "B": "doc_id % 13 <> 0", "C": "doc_id % 10 <> 0"}
_TITLE = {"A": "concat('Document ', doc_id)", "B": "concat('Document ', doc_id, ' rev')", "C": "concat('Document ', doc_id)"}
_FILE = {"A": "CASE WHEN doc_id % 3 = 0 THEN concat(doc_id, '.txt') END", "B": "CASE WHEN doc_id % 2 = 0 THEN concat(doc_id, '-b.txt') END", "C": "CAST(NULL AS {s})"}


# every fifth document's run is unknown; a turn comes every three seconds, and some have no time
_RUN = "CASE WHEN doc_id % 5 <> 0 THEN concat(lang, ':', source) END"
_BEGAN = "CASE WHEN doc_id % 41 <> 0 THEN {}'2024-02-10 00:00:00' + {} END"
_OUTCOME = "CASE WHEN pos % 29 = 0 THEN 'hard_stop' WHEN pos % 11 = 0 THEN 'error' ELSE 'ok' END"


def snapshot(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Captures of a snapshot, hashed."""
    docs = read(spark, sf_dir, "documents").filter(_HELD[name])
    return changes.hashed(
        docs.select(
            F.col("lang").alias("regulation"), "source", F.col("doc_id").cast("string").alias("document_id"), F.col("doc_id").alias("pos"),
            F.expr(_CONTENT[name]).alias("content"), F.expr(f"TIMESTAMP_NTZ'{TIMES[name]}'").alias("ts"), F.expr(_TITLE[name]).alias("title"),
            F.expr("concat('https://example.gov/', source, '/', doc_id)").alias("url"), F.lit("txt" if name == "A" else "html").alias("ext"), F.expr(_FILE[name].format(s="string")).alias("filename"),
            F.lit("text/plain" if name == "A" else "text/html").alias("content_type"), F.lit(200).alias("http_status"),
            F.create_map(F.lit("snapshot"), F.lit(name), F.lit("chars"), F.col("n_chars").cast("string")).alias("source_metadata"),
        )
    )


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state after snapshot A."""
    first = snapshot(spark, sf_dir, "A")
    return changes.merge(first, changes.empty_state(first))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in order, with the outcome that fetching each would have."""
    return read(spark, sf_dir, "documents").select(
        F.col("lang").alias("regulation"), "source", F.col("doc_id").cast("string").alias("document_id"), F.col("doc_id").alias("pos"),
        F.expr(_OUTCOME.replace("pos", "doc_id")).alias("outcome"), F.expr(_RUN).alias("run"), F.expr(_BEGAN.format("TIMESTAMP_NTZ", "make_dt_interval(0, 0, 0, doc_id * 3)")).alias("began"),
    )


def _cte(name: str) -> str:
    return (
        f"{name} AS (SELECT lang AS regulation, source, CAST(doc_id AS VARCHAR) AS document_id, doc_id AS pos, sha256({_CONTENT[name]}) AS content_hash, "
        f"CAST(strlen({_CONTENT[name]}) AS BIGINT) AS size_bytes, TIMESTAMP '{TIMES[name]}' AS ts, {_TITLE[name]} AS title, concat('https://example.gov/', source, '/', doc_id) AS url, "
        f"{_FILE[name].format(s='VARCHAR')} AS filename, '{'text/plain' if name == 'A' else 'text/html'}' AS content_type, '{name}' AS meta_snapshot, CAST(n_chars AS VARCHAR) AS meta_chars, '{'txt' if name == 'A' else 'html'}' AS ext FROM documents WHERE {_HELD[name]})"
    )


A, B, C = map(_cte, "ABC")
CAND = "cand AS (SELECT lang AS regulation, source, CAST(doc_id AS VARCHAR) AS document_id, doc_id AS pos, CASE WHEN doc_id % 29 = 0 THEN 'hard_stop' WHEN doc_id % 11 = 0 THEN 'error' ELSE 'ok' END AS outcome, " + _RUN + " AS run, " + _BEGAN.format("TIMESTAMP", "to_seconds(doc_id * 3)") + " AS began FROM documents)"
ON = "USING (regulation, source, document_id)"


@query(f"WITH {B} SELECT regulation, source, document_id, content_hash, size_bytes FROM B")
def cdc_01_content_hash(spark, sf):
    return snapshot(spark, sf, "B").select(*KEY, "content_hash", "size_bytes")


CLASSIFIED = f"cls AS (SELECT B.*, A.content_hash AS old_hash, concat_ws('/', A.regulation, A.source, 'documents', A.document_id, 'current.' || A.ext) AS held_path, CASE WHEN A.document_id IS NULL THEN 'new' WHEN A.content_hash = B.content_hash THEN 'unchanged' ELSE 'updated' END AS event FROM B LEFT JOIN A {ON})"


@query(f"WITH {A}, {B}, {CLASSIFIED} SELECT regulation, source, document_id, content_hash, old_hash, event FROM cls")
def cdc_02_classify(spark, sf):
    return changes.classify(snapshot(spark, sf, "B"), state(spark, sf)).select(*KEY, "content_hash", "old_hash", "event")


@query(f"WITH {A}, {B}, {CLASSIFIED} SELECT regulation, source, event, count(*) AS documents FROM cls GROUP BY ALL")
def change_counts(spark, sf):
    return changes.classify(snapshot(spark, sf, "B"), state(spark, sf)).groupBy("regulation", "source", "event").agg(F.count("*").alias("documents"))


_STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S')"


@query(f"""WITH {A}, {B} SELECT regulation, source, document_id,
  CASE WHEN ch THEN B.title ELSE A.title END AS title, CASE WHEN ch THEN coalesce(B.filename, A.filename) ELSE coalesce(A.filename, B.filename) END AS original_filename,
  CASE WHEN ch THEN B.url ELSE A.url END AS canonical_url, {_STAMP.format('coalesce(A.ts, B.ts)')} AS first_seen_at,
  {_STAMP.format('CASE WHEN ch THEN B.ts ELSE A.ts END')} AS last_scraped_at, {_STAMP.format('coalesce(B.ts, A.ts)')} AS last_checked_at, {_STAMP.format('CASE WHEN ch THEN B.ts ELSE A.ts END')} AS last_changed_at,
  CASE WHEN ch THEN B.content_hash ELSE A.content_hash END AS current_hash, CASE WHEN ch THEN B.size_bytes ELSE A.size_bytes END AS size_bytes,
  concat_ws('/', regulation, source, 'documents', document_id, 'current.' || CASE WHEN ch THEN B.ext ELSE A.ext END) AS current_storage_path,
  CASE WHEN ch THEN B.content_type ELSE A.content_type END AS content_type, CASE WHEN ch THEN B.meta_snapshot ELSE A.meta_snapshot END AS meta_snapshot,
  CASE WHEN ch THEN B.meta_chars ELSE A.meta_chars END AS meta_chars,
  CAST(CASE WHEN A.ts IS NOT NULL AND ch THEN 2 ELSE 1 END AS BIGINT) AS versions
FROM A FULL OUTER JOIN B {ON}, LATERAL (SELECT B.content_hash IS NOT NULL AND B.content_hash IS DISTINCT FROM A.content_hash AS ch)""")
def cdc_03_merge(spark, sf):
    merged = changes.merge(snapshot(spark, sf, "B"), state(spark, sf))
    stamps = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("first_seen_at", "last_scraped_at", "last_checked_at", "last_changed_at")}
    meta = {f"meta_{k}": F.col("source_metadata")[k] for k in ("snapshot", "chars")}
    return merged.withColumns(stamps | {"versions": changes.version_count(F.col("version_history"))} | meta).drop("version_history", "source_metadata")


@query(f"""WITH {A} SELECT regulation, source, document_id AS documentId, title, filename AS originalFilename, url AS canonicalUrl,
concat_ws('/', regulation, source, 'documents', document_id, 'current.' || ext) AS storagePath, content_hash AS contentHash, content_type AS contentType, size_bytes AS sizeBytes,
CAST(1 AS BIGINT) AS versionCount, {_STAMP.format('ts')} AS firstSeenAt, {_STAMP.format('ts')} AS lastScrapedAt, {_STAMP.format('ts')} AS lastCheckedAt, {_STAMP.format('ts')} AS lastChangedAt,
'chars=' || meta_chars || ';snapshot=A' AS sourceMetadata FROM A""")
def prj_03_document_report(spark, sf):
    """Current documents under their names on the wire."""
    told = runs.document_report(state(spark, sf))
    stamps = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("firstSeenAt", "lastScrapedAt", "lastCheckedAt", "lastChangedAt")}
    pairs = F.array_sort(F.transform(F.map_entries("sourceMetadata"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return told.withColumns(stamps | {"sourceMetadata": F.array_join(pairs, ";")})


ALL = "al AS (SELECT * FROM A UNION ALL BY NAME SELECT * FROM B UNION ALL BY NAME SELECT * FROM C)"
REPLAY = "rep AS (SELECT * FROM (SELECT *, lag(content_hash) OVER (PARTITION BY regulation, source, document_id ORDER BY ts) AS b FROM al) WHERE b IS DISTINCT FROM content_hash)"


def all_snapshots(spark, sf):
    return snapshot(spark, sf, "A").unionByName(snapshot(spark, sf, "B")).unionByName(snapshot(spark, sf, "C"))


@query(f"WITH {A}, {B}, {C}, {ALL}, {REPLAY} SELECT regulation, source, document_id, string_agg(strftime(ts, '%Y-%m-%d') || ' ' || content_hash || ' ' || size_bytes, ',' ORDER BY ts) AS history, count(*) AS version_count FROM rep GROUP BY ALL")
def cdc_04_history(spark, sf):
    h = changes.histories(all_snapshots(spark, sf))
    text = F.array_join(F.transform("version_history", lambda v: F.concat_ws(" ", F.date_format(v["ts"], "yyyy-MM-dd"), v["hash"], v["size_bytes"].cast("string"))), ",")
    return h.select(*KEY, text.alias("history"), "version_count")


@query(f"WITH {A}, {B}, {C}, {ALL}, {REPLAY} SELECT regulation, source, document_id, ts::DATE::VARCHAR AS day, content_hash FROM rep")
def cdc_04_replay(spark, sf):
    return changes.replay(all_snapshots(spark, sf)).select(*KEY, F.date_format("ts", "yyyy-MM-dd").alias("day"), "content_hash")


@query(f"WITH {A}, {B} SELECT regulation, source, document_id, CASE WHEN B.content_hash IS NOT NULL AND B.content_hash IS DISTINCT FROM A.content_hash THEN coalesce(B.filename, A.filename) ELSE coalesce(A.filename, B.filename) END AS original_filename FROM A FULL OUTER JOIN B {ON}")
def cdc_05_filename_backfill(spark, sf):
    return changes.merge(snapshot(spark, sf, "B"), state(spark, sf)).select(*KEY, "original_filename")


@query(f"WITH {A}, {B}, {C}, {ALL}, {REPLAY} SELECT regulation, source, version_count, count(*) AS documents FROM (SELECT regulation, source, document_id, greatest(count(*), 1) AS version_count FROM rep GROUP BY ALL) GROUP BY ALL")
def cdc_06_version_counts(spark, sf):
    return changes.histories(all_snapshots(spark, sf)).groupBy("regulation", "source", "version_count").agg(F.count("*").alias("documents"))


@query(f"""WITH {A}, {B}, {CLASSIFIED} SELECT concat(source, '-b') AS run_id, regulation, source, document_id, event, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, url, CAST(200 AS INT) AS http_status, content_hash,
CASE WHEN event = 'unchanged' THEN held_path ELSE concat_ws('/', regulation, source, 'documents', document_id, 'current.' || ext) END AS storage_path, CAST(NULL AS VARCHAR) AS error FROM cls""")
def cdc_09_events(spark, sf):
    out = changes.events(changes.classify(snapshot(spark, sf, "B"), state(spark, sf)), F.concat("source", F.lit("-b")))
    return out.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


@query(f"WITH {A}, {B} SELECT regulation, source, document_id, A.content_hash AS current_hash, concat_ws('/', regulation, source, 'documents', document_id, 'current.' || A.ext) AS current_storage_path, concat_ws('/', regulation, source, 'documents', document_id, 'versions', strftime(A.ts, '%Y%m%dT%H%M%S+0000') || '__' || A.content_hash[1:8] || '.' || B.ext) AS archive_path FROM A JOIN B {ON} WHERE A.content_hash <> B.content_hash")
def snk_04_archive_paths(spark, sf):
    return changes.replaced(snapshot(spark, sf, "B"), state(spark, sf))


@query(f"""WITH {A}, {B} SELECT concat_ws('/', regulation, source, 'documents', document_id, 'versions', strftime(A.ts, '%Y%m%dT%H%M%S+0000') || '__' || A.content_hash[1:8] || '.' || B.ext) AS archive_path,
A.content_hash AS content_hash, A.size_bytes AS size_bytes FROM A JOIN B {ON} WHERE A.content_hash <> B.content_hash AND A.pos % 31 <> 0""")
def snk_04_archive_bytes(spark, sf):
    """The bytes of replaced versions, appended to the archive and read back; every 31st document's file is gone."""
    root = tables.scratch(spark, "versions")
    held = read(spark, sf, "documents").filter(f"{_HELD['A']} AND doc_id % 31 <> 0").select(F.col("lang").alias("regulation"), "source", F.col("doc_id").cast("string").alias("document_id"), "text")
    files = held.select(changes.current_path(F.lit("txt")).alias("path"), F.col("text").cast("binary").alias("content"))
    tables.append_versions(changes.archived(changes.replaced(snapshot(spark, sf, "B"), state(spark, sf)), files), root)
    back = spark.read.parquet(root)
    return back.select("archive_path", F.sha2("content", 256).alias("content_hash"), F.octet_length("content").cast("bigint").alias("size_bytes"))


@query(f"WITH {CAND}, {A} SELECT cand.* EXCLUDE (run, began) FROM cand ANTI JOIN A {ON}")
def join_01_not_held(spark, sf):
    return select.missing(candidates(spark, sf), state(spark, sf)).drop("run", "began")


# times of the last check as ISO text: some missing, some malformed, some with only a time of the last scrape
CHECKED = """chk AS (SELECT A.*, ts + INTERVAL (pos % 40) DAY + INTERVAL (pos % 5) HOUR AS t FROM A)"""


@query(f"""WITH {CAND}, {A}, {CHECKED} SELECT cand.* EXCLUDE (run, began) FROM cand LEFT JOIN chk {ON} WHERE chk.pos IS NULL OR chk.pos % 17 IN (0, 2)
OR floor(epoch_us(TIMESTAMP '2024-02-10 02:00:00' - CASE WHEN chk.pos % 17 = 1 THEN t - INTERVAL 3 DAY WHEN chk.pos % 17 = 3 THEN t + INTERVAL 5 HOUR ELSE t END) / 86400000000) >= 7""")
def join_02_due(spark, sf):
    at = F.expr("ts + make_dt_interval(CAST(pos % 40 AS INT), CAST(pos % 5 AS INT))")
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    zone = F.when(F.col("pos") % 17 == 3, "-05:00").otherwise("+00:00")
    checked = F.when(F.col("pos") % 17 < 2, None).when(F.col("pos") % 17 == 2, "soon").otherwise(F.concat(iso(at), zone))
    scraped = F.when(F.col("pos") % 17 == 1, F.concat(iso(at - F.expr("INTERVAL 3 DAYS")), F.lit("+00:00")))
    held = snapshot(spark, sf, "A").select(*KEY, checked.alias("last_checked_at"), scraped.alias("last_scraped_at"))
    return select.due(candidates(spark, sf), held, F.expr("TIMESTAMP_NTZ'2024-02-10 02:00:00'"), 7).drop("run", "began")


@query(f"WITH {CAND}, {A} SELECT cand.regulation, cand.source, count(*) AS already_known FROM cand SEMI JOIN A {ON} GROUP BY ALL")
def join_03_held_counts(spark, sf):
    return candidates(spark, sf).join(state(spark, sf).select(*KEY), KEY, "left_semi").groupBy("regulation", "source").agg(F.count("*").alias("already_known"))


@query(f"WITH {CAND}, {A} SELECT cand.regulation, cand.source, CASE WHEN cand.source = 'src3' THEN NULL ELSE count(*) END AS total_available, count(A.pos) AS already_known, CASE WHEN cand.source = 'src3' THEN NULL ELSE greatest(0, count(*) - count(A.pos)) END AS remaining FROM cand LEFT JOIN A {ON} GROUP BY cand.regulation, cand.source")
def agg_07_estimate(spark, sf):
    found = select.estimate(candidates(spark, sf), state(spark, sf), ["regulation", "source"])
    total = F.when(F.col("source") != "src3", F.col("total_available"))  # a source whose total is unknown
    return found.withColumn("total_available", total).withColumn("remaining", select.remaining(F.col("total_available"), F.col("already_known")))


def _cut_sql(budget: int | None, run: str = "run", minutes: int | None = None) -> str:
    stop = "CASE WHEN NOT known AND outcome = 'hard_stop' THEN 'hard_stop' "
    stop += "" if budget is None else f"WHEN NOT known AND outcome = 'ok' AND sum(CASE WHEN NOT known AND outcome = 'ok' THEN 1 ELSE 0 END) OVER (PARTITION BY {run} ORDER BY pos) >= {budget} THEN 'budget_reached' "
    beyond = "pos > cut_pos"
    if minutes:
        stop = stop.replace("CASE ", "CASE WHEN NOT known AND late THEN 'budget_reached' ", 1)
        beyond = "(pos > cut_pos OR (pos = cut_pos AND late))"
    late = f"coalesce(began - min(began) OVER (PARTITION BY {run}) >= INTERVAL {minutes or 0} MINUTE, false)"
    if budget == 0:
        stop, beyond = "CASE WHEN NOT known THEN 'budget_reached' ", "pos >= cut_pos"
    return f"""{CAND}, {A}, k AS (SELECT cand.*, A.pos IS NOT NULL AND cand.pos % 3 <> 0 AS known FROM cand LEFT JOIN A {ON}),
s AS (SELECT *, {stop} END AS stop FROM (SELECT *, {late} AS late FROM k)), cut AS (SELECT *, min(CASE WHEN stop IS NOT NULL THEN pos END) OVER (PARTITION BY {run}) AS cut_pos FROM s),
lab AS (SELECT cut.*, CASE WHEN cut_pos IS NOT NULL AND {beyond} THEN 'not_reached' WHEN known THEN 'skipped_known' ELSE 'executed' END AS label,
coalesce(max(CASE WHEN pos = cut_pos THEN stop END) OVER (PARTITION BY {run}), 'completed') AS stop_reason FROM cut)"""


def cut(spark, sf, budget, run=("run",), **more):
    held = state(spark, sf).select(*KEY).withColumn("held", F.lit(True))
    marked = candidates(spark, sf).join(held, KEY, "left").withColumn("known", F.col("held").isNotNull() & (F.col("pos") % 3 != 0)).drop("held")
    return select.run_cut(marked, list(run), "pos", budget, **more)


@query(f"WITH {_cut_sql(5)} SELECT regulation, source, document_id, label, stop_reason FROM lab")
def win_01_run_cut(spark, sf):
    return cut(spark, sf, 5).select(*KEY, "label", "stop_reason")


@query(f"WITH {_cut_sql(0)} SELECT regulation, source, document_id, label, stop_reason FROM lab")
def win_01_run_cut_zero(spark, sf):
    return cut(spark, sf, 0).select(*KEY, "label", "stop_reason")


@query(f"WITH {_cut_sql(None)} SELECT regulation, source, document_id, label, stop_reason FROM lab")
def win_01_run_cut_unlimited(spark, sf):
    return cut(spark, sf, None).select(*KEY, "label", "stop_reason")


@query(f"WITH {_cut_sql(5, minutes=4)} SELECT regulation, source, document_id, label, stop_reason FROM lab")
def win_02_both_budgets(spark, sf):
    """A budget of documents and one of minutes: whichever ends a run first."""
    return cut(spark, sf, 5, minutes=4).select(*KEY, "label", "stop_reason")


@query(f"WITH {_cut_sql(5, 'regulation, source')} SELECT regulation, source, any_value(stop_reason) AS stop_reason, count(*) FILTER (WHERE label = 'skipped_known') AS skipped_already_known, count(*) FILTER (WHERE label = 'executed') AS executed FROM lab GROUP BY ALL")
def agg_13_skip_counts(spark, sf):
    return cut(spark, sf, 5, ("regulation", "source")).groupBy("regulation", "source").agg(F.first("stop_reason").alias("stop_reason"), F.count_if(F.col("label") == "skipped_known").alias("skipped_already_known"), F.count_if(F.col("label") == "executed").alias("executed"))


@query(f"""{'WITH ' + _cut_sql(5, 'regulation, source').replace('AND cand.pos % 3 <> 0 ', '')} SELECT regulation, source, document_id, label, stop_reason FROM lab""")
def udf_02_callback(spark, sf):
    """A run whose outcomes come from a callback over the candidates that are not held."""
    listed = candidates(spark, sf).drop("outcome")
    fetch = lambda df: df.withColumn("outcome", F.expr(_OUTCOME))
    return select.process(listed, state(spark, sf), fetch, ["regulation", "source"], "pos", 5).select(*KEY, "label", "stop_reason")


@query(f"WITH {CAND}, {A} SELECT regulation, source, document_id FROM cand EXCEPT SELECT regulation, source, document_id FROM A")
def set_02_except(spark, sf):
    return candidates(spark, sf).select(*KEY).exceptAll(state(spark, sf).select(*KEY))


@query(f"WITH {CAND}, {A} SELECT regulation, source, document_id FROM cand INTERSECT SELECT regulation, source, document_id FROM A")
def set_03_intersect(spark, sf):
    return candidates(spark, sf).select(*KEY).intersect(state(spark, sf).select(*KEY))


@query(f"WITH {A} SELECT regulation, source, count(*) AS documents FROM A GROUP BY ALL")
def agg_04_documents_per_source(spark, sf):
    return state(spark, sf).groupBy("regulation", "source").agg(F.count("*").alias("documents"))


@query("SELECT doc_id, coalesce(nullif(regexp_replace(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g')[1:120], ''), 'untitled') AS slug FROM documents")
def fn_01_slug(spark, sf):
    return read(spark, sf, "documents").select("doc_id", fn.slug(F.col("text")).alias("slug"))


@query(f"WITH {B}, n AS (SELECT *, row_number() OVER (PARTITION BY regulation, source ORDER BY pos) AS seq FROM B) SELECT document_id, concat_ws('/', regulation, source, 'documents', document_id, 'current.' || ext) AS current_path, concat_ws('/', regulation, source, 'documents', document_id, 'versions', strftime(ts, '%Y%m%dT%H%M%S+0000') || '__' || content_hash[1:8] || '.' || ext) AS version_path, concat_ws('/', regulation, source, '_manifest/events', strftime(ts, '%Y/%m/%d'), concat_ws('__', source || '-b', lpad(CAST(seq AS VARCHAR), 5, '0'), document_id, 'new') || '.json') AS event_path FROM n")
def fn_14_paths(spark, sf):
    rows = snapshot(spark, sf, "B").withColumn("_back", -F.floor(F.col("pos") / 1000))
    rows = select.numbered(rows, ["regulation", "source"], "_back", [F.col("pos")], "seq").withColumn("seq", F.col("seq") + 1)
    return rows.select("document_id", changes.current_path(F.col("ext")).alias("current_path"), changes.version_path(F.col("ts"), F.col("content_hash"), F.col("ext")).alias("version_path"), changes.event_path(F.col("ts"), F.concat("source", F.lit("-b")), F.col("seq"), F.lit("new")).alias("event_path"))


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN '<' || strlen(text) || ' bytes, content-type=''application/pdf'' — not shown>' WHEN length(text) <= 2000 THEN text ELSE text[1:2000] || '... (' || length(text) || ' chars total, truncated)' END AS snippet FROM documents")
def fn_16_body_snippet(spark, sf):
    kind = F.when(F.col("doc_id") % 4 == 0, "application/pdf").otherwise("text/HTML; charset=utf-8")
    return read(spark, sf, "documents").select("doc_id", fn.body_snippet(F.col("text"), kind).alias("snippet"))
