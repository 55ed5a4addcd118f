"""Each registered query against its SQL on the smallest tables."""

from __future__ import annotations

import glob
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
QUERIES, SQL = __spark_entry__.queries(), __spark_entry__.oracle_sql()
OWN = sorted(n for n in QUERIES if not n.startswith("op") and n != "pipeline")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    return f"{value:.9g}" if isinstance(value, float) else str(value)


def test_names():
    assert set(SQL) <= set(QUERIES) and len(OWN) > 90


@pytest.mark.parametrize("name", OWN)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    if name not in SQL:
        assert df.count() > 0
        return
    found = duck.execute(SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted(tuple(plain(r[c]) for c in columns) for r in df.collect()) == sorted(tuple(map(plain, r)) for r in found.fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_every_anchor_is_a_table_row(spark):
    links = QUERIES["ext_04_nav_links"](spark, SF).filter("href <> '' AND text <> ''")
    want = sorted((r.page_id, r.href, r.text) for r in links.collect())
    assert max(n for _, n in links.groupBy("page_id").count().collect()) > 5
    rows = QUERIES["udf_04_tables"](spark, SF).filter("href <> '' AND text <> ''")
    assert sorted((r.page_id, r.href, r.text) for r in rows.collect()) == want


def test_snapshots_keep_their_partitions(spark, monkeypatch):
    from vigilspark.plans import storage

    whole, roots = storage.documents.snapshot, set()
    source = storage.streaming.source
    monkeypatch.setattr(storage.documents, "snapshot", lambda *a: whole(*a).repartition(3))
    monkeypatch.setattr(storage.streaming, "source", lambda spark, root, *a: roots.add(root) or source(spark, root, *a))
    assert QUERIES["str_03_streaming_changes"](spark, SF).count() > 0
    assert len(spark.read.parquet(roots.pop()).inputFiles()) == 9


@pytest.mark.parametrize("name,most", [("src_07_unnest_pages", 2), ("src_07_max_records", 2), ("join_05_source_summary", 6), ("win_01_run_cut", 4)])
def test_scans(spark, name, most):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= most


def test_entry_goes_on_without_what_only_the_operators_of_llm_need():
    code = "import sys; sys.modules['zstandard'] = None; import warnings; warnings.simplefilter('ignore'); import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op1_') for n in e.queries()))"
    told = subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(os.path.abspath(__spark_entry__.__file__)), capture_output=True, text=True, timeout=120)
    assert told.stdout.split() == [str(len(OWN)), "False"], told.stderr


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace

    from vigilspark.sources import tables

    context = SimpleNamespace(getConf=lambda: SimpleNamespace(get=lambda name: None), getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tables.scratch(SimpleNamespace(sparkContext=context), "x")
