"""Queries over fetch events and request logs; both stand on the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilspark.functions import columns as fn
from vigilspark.operators import requests, runs, select
from vigilspark.plans.registry import query, read
from vigilspark.sources import tables

_KIND = "CASE event_type WHEN 'signup' THEN 'new' WHEN 'click' THEN 'updated' WHEN 'view' THEN 'unchanged' WHEN 'error' THEN 'error' ELSE 'skipped_disallowed' END"


# Retry-After of throttled answers: seconds, seconds beyond the limit, or a date, which counts as none
_AFTER = "CASE WHEN event_type = 'signup' THEN CASE event_id % 4 WHEN 0 THEN '7' WHEN 1 THEN '300' WHEN 2 THEN 'Wed, 21 Oct 2026 07:28:00 GMT' END END"


def fetch_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        "event_id", "ts", F.lit("fda").alias("regulation"), F.concat(F.lit("s"), F.col("user_id") % 20).alias("source"),
        F.concat(F.lit("s"), F.col("user_id") % 20, F.lit("-"), F.date_format("ts", "yyyy-MM-dd")).alias("run_id"),
        F.when((F.col("event_type") == "error") & (F.col("event_id") % 29 == 0), "__run__").otherwise(F.get_json_object("props", "$.k")).alias("document_id"), F.expr(_KIND).alias("event"),
        F.concat(F.lit("status of "), F.col("event_id"), F.lit(" "), F.repeat(F.lit("x"), (F.col("event_id") % 300).cast("int"))).alias("error"),
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    origin = F.concat(F.lit("h"), F.col("user_id") % 10)
    return read(spark, sf_dir, "events").select(
        "event_id", "ts", F.lit("http_request").alias("message"), origin.alias("origin"), F.concat(origin, F.lit("/"), F.get_json_object("props", "$.k")).alias("url"),
        F.expr("CASE event_type WHEN 'error' THEN 503 WHEN 'signup' THEN 429 WHEN 'purchase' THEN 404 ELSE 200 END").alias("status"), F.col("value").alias("elapsed_ms"), F.expr(_AFTER).alias("retry_after"),
        F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'"), F.col("ts")).alias("us"),
    )


def spotty_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with some origins and times unknown."""
    some = lambda n, c: F.when(F.col("event_id") % n != 0, F.col(c))
    return request_log(spark, sf_dir).withColumns({"origin": some(50, "origin"), "ts": some(97, "ts"), "us": some(97, "us")})


EVT = f"evt AS (SELECT event_id, ts, 'fda' AS regulation, 's' || (user_id % 20) AS source, 's' || (user_id % 20) || '-' || strftime(ts, '%Y-%m-%d') AS run_id, CASE WHEN event_type = 'error' AND event_id % 29 = 0 THEN '__run__' ELSE json_extract_string(props, '$.k') END AS document_id, {_KIND} AS event, concat('status of ', event_id, ' ', repeat('x', event_id % 300)) AS error FROM events)"
LOG = f"log AS (SELECT event_id, ts, 'h' || (user_id % 10) AS origin, 'h' || (user_id % 10) || '/' || json_extract_string(props, '$.k') AS url, CASE event_type WHEN 'error' THEN 503 WHEN 'signup' THEN 429 WHEN 'purchase' THEN 404 ELSE 200 END AS status, value AS elapsed_ms, {_AFTER} AS retry_after, epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00') AS us FROM events)"
SPOTTY = f"{LOG}, sp AS (SELECT * REPLACE (CASE WHEN event_id % 50 <> 0 THEN origin END AS origin, CASE WHEN event_id % 97 <> 0 THEN ts END AS ts, CASE WHEN event_id % 97 <> 0 THEN us END AS us) FROM log)"
BAD = "event IN ('error', 'skipped_disallowed')"
RUNS = f"runs AS (SELECT regulation, source, run_id, count(*) AS checked, count(*) FILTER (WHERE event = 'new') AS new, count(*) FILTER (WHERE event = 'updated') AS updated, count(*) FILTER (WHERE event = 'unchanged') AS unchanged, count(*) FILTER (WHERE {BAD}) AS errors, min(ts) AS started_at, max(ts) AS finished_at, CASE WHEN count(*) FILTER (WHERE event = 'error' AND document_id = '__run__') > 0 THEN 'failed' WHEN count(*) FILTER (WHERE {BAD}) > 0 THEN 'partial_failure' ELSE 'success' END AS status FROM evt GROUP BY ALL)"
STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"


def stamp(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


@query(f"WITH {EVT}, {RUNS} SELECT regulation, source, run_id, checked, new, updated, unchanged, errors FROM runs")
def agg_01_run_counters(spark, sf):
    return runs.counters(fetch_events(spark, sf)).select(*runs.RUN, "checked", "new", "updated", "unchanged", "errors")


@query(f"""WITH {EVT}, n AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY ts, event_id) AS n FROM evt WHERE {BAD})
SELECT regulation, source, run_id, CAST((n - 1) // 5 AS INT) AS part, string_agg(document_id || '=' || error, ';' ORDER BY n) AS error_details FROM n GROUP BY ALL""")
def agg_02_error_details(spark, sf):
    """Every error of every run, in arrays of five."""
    found = runs.error_list(fetch_events(spark, sf), most=5)
    return found.withColumn("error_details", F.array_join(F.transform("error_details", lambda x: F.concat_ws("=", x["document_id"], x["error"])), ";"))


@query(f"WITH {EVT}, {RUNS} SELECT run_id, status, {STAMP.format('started_at')}, {STAMP.format('finished_at')} FROM runs")
def agg_03_run_status(spark, sf):
    return runs.counters(fetch_events(spark, sf)).select("run_id", "status", stamp("started_at"), stamp("finished_at"))


# several runs may start at one time: of these the first name counts
LATE = "late AS (SELECT *, date_trunc('day', started_at) - INTERVAL (day(started_at) % 3) DAY AS begun FROM runs)"


def coarse(runs_):
    """Runs with start times by day, of which three in a row are the same."""
    day = F.date_trunc("day", "started_at")
    return runs_.withColumn("started_at", day - F.make_dt_interval(days=F.dayofmonth("started_at") % 3))


@query(f"""WITH {EVT}, {RUNS}, {LATE}, k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY begun DESC, run_id) AS n FROM late)
SELECT regulation, source, run_id, checked, status FROM k WHERE n = 1""")
def agg_05_latest_run(spark, sf):
    return runs.latest_run(coarse(runs.counters(fetch_events(spark, sf))), ["run_id", "checked", "status"])


@query(f"WITH {EVT}, {RUNS} SELECT regulation, source, max(run_id) AS run_id, arg_max(errors, run_id) AS errors FROM runs GROUP BY ALL")
def agg_06_latest_run_by_name(spark, sf):
    return runs.latest_run(runs.counters(fetch_events(spark, sf)), ["run_id", "errors"], "run_id")


def _registry(spark, sf):
    return read(spark, sf, "events").select((F.col("user_id") % 25).alias("n")).distinct().select(F.lit("fda").alias("regulation"), F.concat(F.lit("s"), "n").alias("source"))


REG = "reg AS (SELECT DISTINCT 'fda' AS regulation, 's' || (user_id % 25) AS source FROM events)"
DOCS = "docs AS (SELECT DISTINCT regulation, source, document_id FROM evt WHERE event IN ('new', 'updated', 'unchanged'))"
EST = "est AS (SELECT regulation, source, count(DISTINCT document_id) AS total_available, count(DISTINCT CASE WHEN event = 'new' THEN document_id END) AS already_known FROM evt WHERE source <> 's7' GROUP BY ALL)"
# a run's candidates are its events; it stops at its second hard stop, and every fourth document was known before
CUTS = """cand AS (SELECT regulation, source, run_id, event_id, event_id % 4 = 0 AS known, CASE WHEN event_id % 13 = 0 THEN 'hard_stop' WHEN event IN ('error', 'skipped_disallowed') THEN 'error' ELSE 'ok' END AS outcome FROM evt),
cutat AS (SELECT run_id, min(event_id) AS cut FROM cand WHERE NOT known AND outcome = 'hard_stop' GROUP BY run_id),
cuts AS (SELECT run_id, count(*) FILTER (WHERE known AND (cut IS NULL OR event_id <= cut)) AS skipped_already_known, CASE WHEN any_value(cut) IS NULL THEN 'completed' ELSE 'hard_stop' END AS reason
FROM cand LEFT JOIN cutat USING (run_id) GROUP BY run_id),
full_runs AS (SELECT runs.*, skipped_already_known, CASE WHEN status = 'failed' THEN 'hard_stop' ELSE reason END AS stop_reason FROM runs JOIN cuts USING (run_id))"""


def held(events):
    return events.filter(F.col("event").isin("new", "updated", "unchanged")).select("regulation", "source", "document_id").distinct()


def run_summaries(spark, sf):
    """Run summaries with what their candidates tell."""
    events = fetch_events(spark, sf)
    outcome = F.when(F.col("event_id") % 13 == 0, "hard_stop").when(F.col("event").isin(*runs.ERRORS), "error").otherwise("ok")
    candidates = events.withColumns({"known": F.col("event_id") % 4 == 0, "outcome": outcome})
    return runs.summaries(events, select.run_cut(candidates, ["run_id"], "event_id", None))


def counted(events):
    """Documents of each source: held, told of, and new, in one pass."""
    of = lambda condition: F.count_distinct(F.when(condition, F.col("document_id")))
    kind = F.col("event")
    return events.groupBy("regulation", "source").agg(
        of(kind.isin("new", "updated", "unchanged")).alias("documents"), F.count_distinct("document_id").alias("total_available"), of(kind == "new").alias("already_known")
    )


def estimates(events, counts=None):
    out = (counted(events) if counts is None else counts).filter("source <> 's7'").drop("documents")
    noted = F.concat(F.lit("of "), "source").alias("note"), F.lit("2024-02-01T00:00:00+00:00").alias("computed_at")
    return out.withColumn("remaining", select.remaining(F.col("total_available"), F.col("already_known"))).select("*", *noted)


LATEST = """last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY started_at DESC, run_id) AS n FROM full_runs) WHERE n = 1)"""
SUMMARY = f"""{EVT}, {RUNS}, {REG}, {DOCS}, {EST}, {CUTS}, {LATEST}, summ AS (SELECT reg.regulation, reg.source, coalesce(d.n, 0) AS documents, run_id AS last_run_id,
strftime(started_at, '%Y-%m-%d %H:%M:%S') AS last_started_at, strftime(finished_at, '%Y-%m-%d %H:%M:%S') AS last_finished_at, status AS last_status, stop_reason AS last_stop_reason,
coalesce(checked, 0) AS last_checked, coalesce(new, 0) AS last_new, coalesce(updated, 0) AS last_updated, coalesce(unchanged, 0) AS last_unchanged,
coalesce(skipped_already_known, 0) AS last_skipped_already_known, coalesce(errors, 0) AS last_errors, total_available, already_known,
CASE WHEN total_available IS NOT NULL THEN greatest(0, total_available - already_known) END AS remaining, CASE WHEN est.source IS NOT NULL THEN 'of ' || est.source END AS estimate_note,
CASE WHEN est.source IS NOT NULL THEN '2024-02-01T00:00:00+00:00' END AS estimate_computed_at
FROM reg LEFT JOIN (SELECT regulation, source, count(*) AS n FROM docs GROUP BY ALL) d USING (regulation, source) LEFT JOIN last USING (regulation, source) LEFT JOIN est USING (regulation, source))"""


def summary(spark, sf):
    events = fetch_events(spark, sf)
    counts = counted(events)
    out = runs.source_summary(_registry(spark, sf), counts.select("regulation", "source", "documents"), run_summaries(spark, sf), estimates(events, counts))
    return out.withColumns({c: stamp(c) for c in ("last_started_at", "last_finished_at")})


@query(f"WITH {SUMMARY} SELECT * FROM summ")
def join_05_source_summary(spark, sf):
    return summary(spark, sf)


@query(f"""WITH {SUMMARY} SELECT regulation || ':' || source AS name, CAST(documents AS VARCHAR) AS documents, coalesce(CAST(total_available AS VARCHAR), '?') AS available,
coalesce(last_run_id, '-') AS last_run, coalesce(last_status, '-') AS last_status FROM summ""")
def prj_06_display(spark, sf):
    shown = {"documents": ("documents", "?"), "available": ("total_available", "?"), "last_run": ("last_run_id", "-"), "last_status": ("last_status", "-")}
    return summary(spark, sf).select(F.concat_ws(":", "regulation", "source").alias("name"), *(runs.shown(c, blank).alias(n) for n, (c, blank) in shown.items()))


_ISO = "'%Y-%m-%dT%H:%M:%S+00:00'"


@query(f"""WITH {EVT}, {RUNS}, {CUTS} SELECT run_id AS runId, regulation, source, strftime(started_at, {_ISO}) AS startedAt, strftime(finished_at, {_ISO}) AS finishedAt, status, checked, new, updated,
unchanged, errors, stop_reason AS stopReason, (SELECT count(*) FROM evt e WHERE e.run_id = full_runs.run_id AND {BAD}) AS details FROM full_runs""")
def prj_03_run_report(spark, sf):
    """Runs under their names on the wire, live."""
    iso = {c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'+00:00'") for c in ("started_at", "finished_at")}
    told = runs.run_report(run_summaries(spark, sf).withColumns(iso), live=True)
    return runs.detail_counts(told, "errorDetails", "errorPart")


@query(f"""WITH {EVT}, {EST} SELECT regulation, source, '2024-02-01T00:00:00+00:00' AS computedAt, total_available AS totalAvailable, already_known AS alreadyKnown,
greatest(0, total_available - already_known) AS remaining, 'of ' || source AS note FROM est""")
def prj_03_estimate_report(spark, sf):
    return runs.estimate_report(estimates(fetch_events(spark, sf)))


@query(f"WITH {EVT}, {RUNS}, {DOCS}, {EST} SELECT s.regulation, s.source, coalesce(d.n, 0) AS documents, coalesce(r.n, 0) AS runs, est.source IS NOT NULL AS estimate FROM (SELECT DISTINCT regulation, source FROM evt) s LEFT JOIN (SELECT regulation, source, count(*) AS n FROM docs GROUP BY ALL) d USING (regulation, source) LEFT JOIN (SELECT regulation, source, count(*) AS n FROM runs GROUP BY ALL) r USING (regulation, source) LEFT JOIN est USING (regulation, source)")
def agg_09_recovery_counts(spark, sf):
    events, key = fetch_events(spark, sf), ["regulation", "source"]
    d = held(events).groupBy(*key).agg(F.count("*").alias("documents"))
    r = runs.counters(events).groupBy(*key).agg(F.count("*").alias("runs"))
    e = estimates(events).select(*key, F.lit(True).alias("estimate"))
    zero = F.lit(0).cast("bigint")
    return events.select(*key).distinct().join(d, key, "left").join(r, key, "left").join(e, key, "left").select(*key, F.coalesce("documents", zero).alias("documents"), F.coalesce("runs", zero).alias("runs"), F.coalesce("estimate", F.lit(False)).alias("estimate"))


@query(f"WITH {EVT}, {RUNS} SELECT substr(run_id, -10) AS day, bool_or(errors > 0) AS had_errors, count(*) AS runs FROM runs GROUP BY ALL")
def agg_10_any_error(spark, sf):
    return runs.counters(fetch_events(spark, sf)).groupBy(F.substring("run_id", -10, 10).alias("day")).agg(F.bool_or(F.col("errors") > 0).alias("had_errors"), F.count("*").alias("runs"))


@query(f"WITH {LOG} SELECT origin, count(*) AS requests FROM log GROUP BY ALL")
def agg_11_requests_per_origin(spark, sf):
    return request_log(spark, sf).filter(F.col("message") == "http_request").groupBy("origin").agg(F.count("*").alias("requests"))


@query(f"WITH {LOG} SELECT origin, count(*) AS requests, count(*) FILTER (WHERE status BETWEEN 200 AND 299) AS ok, count(*) FILTER (WHERE status BETWEEN 400 AND 499) AS client_errors, count(*) FILTER (WHERE status >= 500) AS server_errors, count(*) FILTER (WHERE status = 429) AS throttled, round(avg(elapsed_ms), 4) AS avg_ms, round(quantile_disc(elapsed_ms, 0.5), 4) AS p50_ms FROM log GROUP BY ALL")
def agg_12_outcomes(spark, sf):
    return requests.outcomes(request_log(spark, sf))


@query(f"WITH {EVT} SELECT strftime(ts, '%Y-%m-%d') AS day, event, count(*) AS events FROM evt GROUP BY ALL")
def agg_14_daily_events(spark, sf):
    return fetch_events(spark, sf).groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event").agg(F.count("*").alias("events"))


@query(f"WITH {SPOTTY} SELECT event_id, us - min(us) OVER (PARTITION BY origin) < 3600000000 AS reached FROM sp")
def win_02_time_budget(spark, sf):
    return select.time_cut(spotty_log(spark, sf), ["origin"], "ts", 60).select("event_id", "reached")


@query(f"WITH {EVT} SELECT * EXCLUDE (rn, ts, error), strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM (SELECT *, row_number() OVER (PARTITION BY source, document_id ORDER BY ts DESC, event_id) AS rn FROM evt) WHERE rn = 1")
def win_05_latest_per_key(spark, sf):
    return select.latest(fetch_events(spark, sf), ["source", "document_id"], F.desc("ts"), F.asc("event_id")).drop("error").withColumn("ts", stamp("ts"))


@query(f"WITH {EVT} SELECT run_id, event_id, CAST(n AS INT) AS n, error[1:160] AS error FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY ts, event_id) AS n FROM evt WHERE {BAD}) WHERE n <= 10")
def win_06_top_errors(spark, sf):
    return runs.error_details(fetch_events(spark, sf), most=10).select("run_id", "event_id", "n", "error")


@query(f"WITH {EVT} SELECT event_id, run_id, CAST(row_number() OVER (PARTITION BY run_id ORDER BY ts, event_id) AS INT) AS seq FROM evt")
def win_09_event_sequence(spark, sf):
    from pyspark.sql import Window

    return fetch_events(spark, sf).select("event_id", "run_id", F.row_number().over(Window.partitionBy("run_id").orderBy("ts", "event_id")).alias("seq"))


CHAIN = "ch AS (SELECT *, sum(st) OVER (PARTITION BY url ORDER BY ts, event_id) AS chain FROM (SELECT *, CASE WHEN coalesce(lag(status) OVER (PARTITION BY url ORDER BY ts, event_id) IN (429, 500, 502, 503, 504), false) THEN 0 ELSE 1 END AS st FROM log)), att AS (SELECT *, row_number() OVER (PARTITION BY url, chain ORDER BY ts, event_id) AS attempt FROM ch)"


@query(f"WITH {LOG}, {CHAIN} SELECT url, CAST(chain AS BIGINT) AS chain, CAST(max(attempt) AS INT) AS attempts, count(*) FILTER (WHERE status = 200) AS ok FROM att GROUP BY url, chain")
def win_10_retry_chains(spark, sf):
    return requests.retry_chains(request_log(spark, sf)).groupBy("url", "chain").agg(F.max("attempt").alias("attempts"), F.count_if(F.col("status") == 200).alias("ok"))


@query(f"WITH {LOG}, {CHAIN} SELECT event_id, CAST(attempt AS INT) AS attempt, CASE WHEN TRY_CAST(retry_after AS DOUBLE) IS NOT NULL THEN least(120.0::DOUBLE, TRY_CAST(retry_after AS DOUBLE)) ELSE least(120.0::DOUBLE, pow(2.0, attempt)) END AS wait_s, round((lead(us) OVER (PARTITION BY url, chain ORDER BY ts, event_id) - us) / 1e6, 3) AS observed_s FROM att")
def win_11_expected_wait(spark, sf):
    from pyspark.sql import Window

    chains = requests.retry_chains(request_log(spark, sf))
    nxt = F.lead("us").over(Window.partitionBy("url", "chain").orderBy("ts", "event_id"))
    return chains.select("event_id", "attempt", requests.expected_wait(F.col("attempt"), F.col("retry_after")).alias("wait_s"), F.round((nxt - F.col("us")) / F.lit(1e6), 3).alias("observed_s"))


@query(f"WITH {SPOTTY}, g AS (SELECT origin, (us - lag(us) OVER (PARTITION BY origin ORDER BY ts, event_id)) / 1e6 AS gap FROM sp) SELECT origin, count(gap) AS gaps, count(*) FILTER (WHERE gap < 30) AS violations, round(min(gap), 4) AS shortest FROM g GROUP BY ALL")
def win_12_pacing_audit(spark, sf):
    return requests.gaps(spotty_log(spark, sf), ["origin"]).groupBy("origin").agg(F.count("gap_s").alias("gaps"), F.count_if(F.col("gap_s") < 30).alias("violations"), F.round(F.min("gap_s"), 4).alias("shortest"))


@query(f"WITH {SPOTTY}, k AS (SELECT *, row_number() OVER (PARTITION BY origin ORDER BY us, event_id) AS k FROM sp) SELECT event_id, CASE WHEN us IS NOT NULL THEN CAST(max(us - k * 1800000000) OVER (PARTITION BY origin ORDER BY us, event_id) + k * 1800000000 AS BIGINT) END AS slot FROM k")
def win_13_slots(spark, sf):
    return requests.slots(spotty_log(spark, sf), "us", 1_800_000_000).select("event_id", "slot")


@query(f"WITH {SPOTTY}, g AS (SELECT event_id, origin, (us - lag(us) OVER (PARTITION BY origin ORDER BY ts, event_id)) / 1e6 AS gap FROM sp) SELECT event_id, origin, round(gap, 3) AS silence_s FROM g WHERE gap > 5")
def win_14_silence(spark, sf):
    return requests.gaps(spotty_log(spark, sf), ["origin"]).filter(F.col("gap_s") > 5).select("event_id", "origin", F.round("gap_s", 3).alias("silence_s"))


@query(f"""WITH {LOG}, f AS (SELECT origin, strftime(ts, '%Y-%m-%d') AS day, count(*) AS rows, max(ts) AS modified, CAST(substr(origin, 2) AS INT) * 2 AS days FROM log GROUP BY ALL)
SELECT origin, day, rows, days > 0 AND modified < (SELECT max(ts) FROM log) - INTERVAL (days) DAY AS expired FROM f""")
def flt_09_retention(spark, sf):
    """Session logs by host and day, each host with days of its own for which they are kept; the first host keeps them for ever."""
    log = request_log(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    files = log.groupBy("origin", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("rows"), F.max("ts").alias("modified"))
    now = files.agg(F.max("modified").alias("now"))
    days = F.substring("origin", 2, 9).cast("int") * 2
    return files.crossJoin(F.broadcast(now)).select("origin", "day", "rows", tables.expired(F.col("modified"), F.col("now"), days).alias("expired"))  # one row on the other side


@query("SELECT event_id, concat_ws('-', 'fda', 's' || (user_id % 20), strftime(ts, '%Y%m%dT%H%M%SZ'), substr(sha1(concat_ws('|', 'fda', 's' || (user_id % 20), strftime(ts, '%Y%m%dT%H%M%SZ'))), 1, 8)) AS run_id, 'fda' AS regulation, 's' || (user_id % 20) AS source, strftime(ts, '%Y%m%dT%H%M%SZ') AS stamp FROM events")
def fn_23_run_ids(spark, sf):
    e = fetch_events(spark, sf).select("event_id", fn.run_id(F.col("regulation"), F.col("source"), F.col("ts")).alias("run_id"))
    return e.withColumn("p", fn.run_id_parts(F.col("run_id"))).select("event_id", "run_id", "p.regulation", "p.source", "p.stamp")


@query("SELECT event_id, CASE WHEN s < 60 THEN s || 's' WHEN s // 60 < 60 THEN (s // 60) || 'm' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') || 's' ELSE (s // 3600) || 'h' || lpad(CAST(s // 60 % 60 AS VARCHAR), 2, '0') || 'm' END AS duration FROM (SELECT event_id, CAST(round_even(value * (1 + event_id % 300), 0) AS BIGINT) AS s FROM events)")
def fn_17_duration(spark, sf):
    return read(spark, sf, "events").select("event_id", fn.duration(F.col("value") * (1 + F.col("event_id") % 300)).alias("duration"))
