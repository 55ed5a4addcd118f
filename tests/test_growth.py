"""What shows on larger tables only: runs of many errors, tasks without rows, cut titles, long listings, many ids."""

from __future__ import annotations

import glob
import os
from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from vigilspark.functions import columns as fn
from vigilspark.operators import extract, runs, select
from vigilspark.plans import specs
from vigilspark.streaming import operators as streaming

QUERIES, SQL = __spark_entry__.queries(), __spark_entry__.oracle_sql()
SF, DAY = "/root/testdata/sf0.001", datetime(2024, 1, 1)


def against_sql(spark, name, sf):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    found = con.execute(SQL[name])
    columns = [c[0] for c in found.description]
    return sorted(map(str, QUERIES[name](spark, sf).select(columns).toPandas().itertuples(index=False, name=None))), sorted(map(str, found.df().itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", ["prj_03_run_report", "snk_06_run_summaries", "src_03_run_summaries"])
def test_runs_of_more_errors_than_an_array_holds(spark, monkeypatch, name):
    whole = runs.error_list
    monkeypatch.setattr(runs, "ERROR_PART", 3)
    monkeypatch.setattr(runs, "error_list", lambda events, key, most=3: whole(events, key, 3))
    got, want = against_sql(spark, name, SF)
    assert got == want


def test_a_summary_has_all_errors(spark):
    rows = [("fda", "s", "r", k, f"d{k}", "error", DAY + timedelta(hours=k), "x") for k in range(7)]
    events = spark.createDataFrame(rows, "regulation string, source string, run_id string, event_id int, document_id string, event string, ts timestamp_ntz, error string")
    told = runs.summaries(events, most=3).orderBy("part")
    assert [[e.document_id for e in r.error_details] for r in told.collect()] == [["d0", "d1", "d2"], ["d3", "d4", "d5"], ["d6"]]
    (one,) = runs.detail_counts(told).collect()
    assert (one.checked, one.errors, one.details) == (7, 7, 7)


@pytest.mark.parametrize("name", ["src_05_bytes", "src_05_lenient"])
def test_tasks_without_rows_leave_no_empty_file(spark, tmp_path, name):
    con = duckdb.connect()
    con.execute(f"COPY (SELECT e.* REPLACE (event_id + k * 100000 AS event_id) FROM '{SF}/events.parquet' e, range(20) t(k)) TO '{tmp_path}/events.parquet' (FORMAT parquet, ROW_GROUP_SIZE 1000000)")
    names = {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "1"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)  # one row group over several tasks, of which the first has no row
    try:
        got, want = against_sql(spark, name, str(tmp_path))
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
    assert got == want


def test_a_capped_listing_marks_what_is_beyond(spark):
    body = lambda *ids: '{"results": [' + ",".join(f'{{"id": {i}}}' for i in ids) + "]}"
    pages = [("a", 0, body(1, 2)), ("a", 1, body(3, 4)), ("a", 2, body(5)), ("a", 3, body()), ("a", 4, body(9)), ("b", 0, body(6))]
    df = spark.createDataFrame(pages, "listing string, page int, body string")
    got = {r.id: r.within for r in select.unnest_pages(df, ["listing"], "page", "body", "id:int", 3, mark="within").collect()}
    assert got == {1: True, 2: True, 3: True, 4: False, 5: False, 6: True}
    assert "WHERE last IS NULL OR page < last" in SQL["src_07_max_records"]


def test_entities_that_a_cut_has_opened_stay(spark):
    texts = ["a &amp;&amp;&amp", "&lt;b&gt; &#39;&#x41;&middot;", "&amp;amp; &am", "&notit; &copy", "", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1).select(fn.unescaped_closed(F.col("t"))).collect()]
    assert got == ["a &&&amp", "<b> 'A·", "&amp; &am", "&notit; &copy", None, None]


def test_cut_titles_equal_the_sql(spark, tmp_path):
    duckdb.connect().execute(f"COPY (SELECT 1::BIGINT AS page_id, 'https://a.org/' AS url, '<title>A &amp;&amp; b&amp</title>' AS html) TO '{tmp_path}/pages.parquet'")
    got, want = against_sql(spark, "fn_13_titles", str(tmp_path))
    assert got == want


@pytest.mark.parametrize("buckets", [1, 3])
def test_documents_of_one_bucket_are_judged_apart(spark, tmp_path, buckets):
    root, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "regulation string, source string, document_id string, ts timestamp, content_hash string"
    held = spark.createDataFrame([("r", None, "a", "1"), ("r", "s", "b", "1")], "regulation string, source string, document_id string, current_hash string")
    batches = [[(None, "a", 1, "1"), ("s", "b", 5, "2"), ("s", "a", 5, "1")], [(None, "a", 3, "2"), ("s", "b", 4, "1"), ("s", "a", 2, "1")], [("s", "z", 40, "0")]]
    with streaming.rocksdb(spark):
        for rows in batches:
            df = spark.createDataFrame([("r", s, i, DAY + timedelta(days=d), h) for s, i, d, h in rows], schema)
            df.coalesce(1).write.mode("append").parquet(root)
            told = streaming.run_to_end(streaming.changes(streaming.source(spark, root, df.schema), held, "5 days", buckets), out, check)
    got = sorted((str(r.source), r.document_id, (r.ts - DAY).days, r.event) for r in told.collect())
    assert got == [("None", "a", 1, "unchanged"), ("None", "a", 3, "updated"), ("s", "a", 2, "new"), ("s", "a", 5, "unchanged"), ("s", "b", 4, "unchanged"), ("s", "b", 5, "updated")]


def test_records_of_one_bucket_are_held_apart(spark, tmp_path):
    batches = [[("a", 0, "1"), ("b", 2, "1"), ("c", 2, "1")], [("a", 3, "2"), ("b", 9, "1")], [("c", 1, "7"), ("c", 30, "1"), ("a", 8, "2")]]
    with streaming.rocksdb(spark):
        for rows in batches:
            df = spark.createDataFrame([(i, h, DAY + timedelta(days=d)) for i, d, h in rows], "id string, content_hash string, ts timestamp")
            df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            told = streaming.run_to_end(streaming.edits(streaming.source(spark, str(tmp_path / "in"), df.schema), "5 days", 6, 1), str(tmp_path / "out"), str(tmp_path / "check"))
    got = sorted((r.id, (r.ts - DAY).days, r.content_hash, r.outcome) for r in told.collect())
    assert got == [("a", 0, "1", "passed"), ("a", 3, "2", "passed"), ("b", 2, "1", "passed"), ("b", 9, "1", "passed"), ("c", 1, "7", "late"), ("c", 2, "1", "passed"), ("c", 30, "1", "passed")]


def test_a_batch_of_pages_gives_its_rows_by_pieces():
    taken = []
    rows = ((taken.append(k) or k, None) for k in range(3 * extract.PIECE))
    frames = extract.pieces(rows, ["k", "pos"], {"pos": "Int32"})
    assert len(next(frames)) == extract.PIECE == len(taken)
    assert [len(f) for f in frames] == [extract.PIECE] * 2


def test_rows_are_dealt_out_before_one_row_an_id(spark):
    raw = spark.range(50).selectExpr("id AS pos", *(f"'x' AS {c}" for c in specs.LICENCE if c != "original_licence_no"), "CAST(id / 3 AS INT) AS original_licence_no")
    rows = specs.SPECS["ca:mdall"].candidates(raw)
    assert "RepartitionByExpression" in rows._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((int(r.document_id), r.pos) for r in rows.collect()) == [(k, 3 * k) for k in range(17)]
