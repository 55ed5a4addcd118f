"""State, streams and spans: repeated keys, null keys, late captures, files of every kind."""

from __future__ import annotations

import json
import os
import random
from datetime import UTC, datetime, timedelta
from urllib.robotparser import RobotFileParser

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from vigilspark.operators import changes, extract, requests, select
from vigilspark.operators.changes import KEY
from vigilspark.plans import specs
from vigilspark.sources import tables
from vigilspark.streaming import operators as streaming

DAY = datetime(2024, 1, 1)
CAPTURE = "regulation string, source string, document_id string, content string, ts timestamp_ntz, title string, url string, ext string, filename string"


def captured(spark, rows):
    """rows: id, content, hour, filename."""
    return changes.hashed(spark.createDataFrame([("r", "s", i, c, DAY + timedelta(hours=h), f"t{h}", f"u{h}", "txt", f) for i, c, h, f in rows], CAPTURE))


def test_a_batch_with_repeated_documents_equals_batches_one_by_one(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice("abc"), rnd.choice("xyz"), h, rnd.choice([None, None, f"{h}.txt"])) for h in range(14)]
    state = one = changes.empty_state(captured(spark, rows[:1]))
    for k, row in enumerate(rows):
        merged = changes.merge(captured(spark, [row]), one)
        one = spark.createDataFrame(merged.collect(), merged.schema)
        state = one if k < 4 else state
    both = [sorted(changes.merge(captured(spark, rows[4:]), state).collect()), sorted(one.collect())]
    assert both[0] == both[1] and len(both[0]) == 3
    assert changes.merge(captured(spark, [("d", None, 1, None)]), state).count() == state.count()


def test_bucketed_state_does_not_move(spark, tmp_path):
    rows = captured(spark, [(str(k), "x", 0, None) for k in range(50)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        held = tables.write_buckets(changes.merge(rows, changes.empty_state(rows)), "state_t", str(tmp_path / "s"), 6, *KEY)
        merged = changes.merge(tables.in_buckets(rows, 6, *KEY), held)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        assert merged.count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE IF EXISTS state_t")


@pytest.mark.parametrize("name", sorted(specs.SPECS))
def test_one_row_an_id(spark, name):
    spec = specs.SPECS[name]
    two = specs.SourceSpec(spec.regulation, spec.name, lambda raw: raw, spec.keep)
    raw = spark.createDataFrame([("a", 3, "late"), ("a", 1, "early"), ("b", 2, "b"), (None, 0, "n"), ("", 0, "e")], "document_id string, pos bigint, title string")
    raw = raw.select("*", *(F.lit(None).cast("string").alias(c) for c in ("url", "ext", "content_type", "content")), F.create_map(F.lit("k"), "title").alias("source_metadata"))
    got = {r.document_id: (r.pos, r.title, r.source_metadata["k"]) for r in two.candidates(raw).collect()}
    want = "late" if name in ("fda:guidance", "eu:mdcg_guidance", "ca:recalls", "ca:guidance") else "early"
    assert got == {"a": (1, want, want), "b": (2, "b", "b")}


def test_recalls_with_one_number_twice(spark):
    fields = ["recall_number", "product_description", "classification", "status", "recalling_firm", "report_date", "product_code"]
    raw = spark.createDataFrame([(k, n, f"p{k}", *[""] * 5) for k, n in enumerate(["Z-1", None, "Z-1", ""])], ["pos", *fields])
    got = sorted((r.document_id, r.title) for r in specs.SPECS["fda:recalls"].candidates(raw).collect())
    assert got == [("Z-1", "p0"), ("unknown", "p1")]


def loop(rows, budget, minutes):
    """What a run does, one candidate after the other. rows: known, outcome, began, ended."""
    labels, saved, why = [], 0, None
    start = min((b for _, _, b, _ in rows if b is not None), default=None)
    over = lambda t: minutes is not None and t is not None and t >= start + timedelta(minutes=minutes)
    for known, outcome, began, ended in rows:
        if why:
            labels.append("not_reached")
        elif known:
            labels.append("skipped_known")
        elif over(began) or (budget is not None and saved >= budget):
            labels.append("not_reached")
            why = "budget_reached"
        else:
            labels.append("executed")
            if outcome in ("hard_stop", "bot_block"):
                why = outcome
            elif outcome == "ok":
                saved += 1
                if over(ended) or (budget is not None and saved >= budget):
                    why = "budget_reached"
    return labels, why or "completed"


def test_both_budgets_equal_the_loop(spark):
    rnd, rows = random.Random(9), []
    for run in [None, *"abcdefghij"]:
        t = DAY
        for k in range(rnd.randint(1, 14)):
            t += timedelta(seconds=rnd.randint(0, 90))
            began = None if rnd.random() < 0.1 else t
            rows.append((run, k, rnd.random() < 0.3, rnd.choice(["ok"] * 5 + ["error", "hard_stop"][: rnd.randint(0, 2)]), began, began and t + timedelta(seconds=40)))
    df = spark.createDataFrame(rows, "run string, k int, known boolean, outcome string, began timestamp_ntz, ended timestamp_ntz")
    for budget, minutes, ended in ((3, 4, "ended"), (3, 4, None), (None, 3, "ended"), (2, None, None), (0, 2, None)):
        got = {(r.run, r.k): (r.label, r.stop_reason) for r in select.run_cut(df, ["run"], "k", budget, minutes, ended=ended).collect()}
        assert len(got) == len(rows)
        for run in {r[0] for r in rows}:
            own = [r for r in rows if r[0] == run]
            labels, why = loop([(r[2], r[3], r[4], r[5] if ended else None) for r in own], budget, minutes)
            assert [got[run, r[1]] for r in own] == [(x, why) for x in labels], (run, budget, minutes)


def test_process_stops_at_the_first_budget(spark):
    listed = spark.createDataFrame([("r", "s", str(k), k) for k in range(8)], "regulation string, source string, document_id string, pos int")
    state = spark.createDataFrame([("r", "s", "0")], "regulation string, source string, document_id string")
    fetch = lambda df: df.withColumns({"outcome": F.lit("ok"), "began": F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, pos)")})
    for budget, minutes, last in ((2, 60, 2), (100, 3, 3)):
        got = {r.pos: r.label for r in select.process(listed, state, fetch, ["regulation"], "pos", budget, minutes).collect()}
        assert got == {0: "skipped_known"} | {k: "executed" if k <= last else "not_reached" for k in range(1, 8)}


def log(spark, n=600, seed=1):
    rnd = random.Random(seed)
    rows = []
    for k in range(n):
        url = None if rnd.random() < 0.1 else "hot" if rnd.random() < 0.4 else f"u{rnd.randint(0, 5)}"
        rows.append((k, url, None if rnd.random() < 0.05 else DAY + timedelta(hours=rnd.randint(0, 24 * 9)), rnd.choice([200, 503, 429, 503, 404, None])))
    return spark.createDataFrame(rows, "event_id int, url string, ts timestamp, status int")


def test_chains_across_days_equal_one_window(spark):
    for seed in (1, 2, 3):
        df = log(spark, seed=seed)
        order = Window.partitionBy("url").orderBy("ts", "event_id")
        start = F.when(F.lag("status").over(order).isin(*requests.RETRYABLE), 0).otherwise(1)
        want = df.withColumn("_s", start).withColumn("chain", F.sum("_s").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        want = want.withColumn("attempt", F.row_number().over(Window.partitionBy("url", "chain").orderBy("ts", "event_id")))
        rows = lambda d: sorted((r.event_id, r.chain, r.attempt) for r in d.collect())
        got = requests.retry_chains(df)
        assert rows(got) == rows(want) and len(rows(got)) == 600 and got.columns == [*df.columns, "chain", "attempt"]


def test_null_groups_and_times_stay(spark):
    df = log(spark).withColumn("t", F.unix_micros("ts") / 1e6)
    order = Window.partitionBy("url").orderBy("ts", "event_id")
    want = {r.event_id: r.g for r in df.select("event_id", (F.unix_micros("ts") - F.unix_micros(F.lag("ts").over(order))).alias("g")).collect()}
    got = {r.event_id: r.gap_s for r in requests.gaps(df, ["url"]).collect()}
    assert len(got) == 600 and all((got[k] is None) == (g is None) and (g is None or abs(got[k] - g / 1e6) < 1e-6) for k, g in want.items())
    slots = requests.slots(df, "t", 5000.0, "url", 90_000.0).collect()
    last = {}
    for r in sorted((r for r in slots if r.t is not None), key=lambda r: (r.t, r.event_id)):
        last[r.url] = max(r.t, last.get(r.url, -1e18) + 5000.0)
        assert abs(r.slot - last[r.url]) < 1e-3
    assert len(slots) == 600 and all((r.slot is None) == (r.t is None) for r in slots)
    assert select.time_cut(df, ["url"], "ts", 60).count() == 600
    numbers = sorted((r.url or "", r.n) for r in select.numbered(df, ["url"], "ts", [F.col("event_id")], "n").collect())
    assert len(numbers) == 600 and all(b == (a[0], a[1] + 1) for a, b in zip(numbers, numbers[1:], strict=False) if a[0] == b[0])
    seen = df.select(F.col("url").alias("origin"), "ts", F.lit("loaded").alias("state"), F.col("event_id").cast("string").alias("policy"))
    assert requests.last_policy(seen, bucket=F.to_date("ts")).count() == 600
    pages = spark.createDataFrame([(None, 0, 5), (None, 1, 0), (None, 2, 5), ("a", 0, 1)], "l string, page int, n int")
    assert sorted((r.l or "", r.page) for r in select.until_empty(pages, ["l"], "page", "n").collect()) == [("", 0), ("a", 0)]


def test_nested_records_are_canonical(spark):
    record = {"b": {"z": 1, "a": None}, "a": [{"y": "é", "x": [2, 1]}, None], "m": {"k2": "v", "k1": "w"}}
    kinds = ("b struct<z:int,a:string>, a array<struct<y:string,x:array<int>>>, m map<string,string>", "a array<struct<x:array<int>,y:string>>, m map<string,string>, b struct<a:string,z:int>")
    told = set()
    for kind in kinds:
        rows = spark.createDataFrame([(json.dumps(record),)], "value string").select(F.from_json("value", kind).alias("r")).select("r.*")
        told.add(rows.select(changes.canonical(rows)).first()[0])
    for order in (record, dict(reversed(record.items()))):
        rows = spark.createDataFrame([(json.dumps(order),)], "t string").select(F.parse_json("t").alias("v"))
        assert json.loads(rows.select(changes.canonical(rows)).first()[0]) == {"v": record}
        told.add(rows.select(F.to_json("v")).first()[0])
    assert told == {json.dumps(record, sort_keys=True, ensure_ascii=False, separators=(",", ":"))}


def test_files_are_judged(spark, tmp_path):
    files = {
        "good.json": b'{"run_id": "r1", "http_status": 200}', "typed.json": b'{"run_id": "r2", "http_status": "soon"}', "empty.json": b"", "blank.json": b" \n",
        "bytes.json": b'{"run_id": "\xc3\x28"}', "cut.json": b'{"run_id": "r', "list.json": b"[1]", "more.json": b'{"run_id": "r3"} x', "two.json": b'{"run_id": "r6"}, {"run_id": "r7"}', "a b+c.json": b'{"run_id": "r4"}',
    }
    (tmp_path / "2024/01").mkdir(parents=True)
    for name, data in files.items():
        (tmp_path / "2024/01" / name).write_bytes(data)
    good, bad = tables.lenient(tables.read_json(spark, str(tmp_path), tables.EVENT), mistyped=True)
    assert sorted((r.run_id, r.http_status, r.mistyped) for r in good.collect()) == [("r1", 200, None), ("r2", None, {"http_status": "soon"}), ("r4", None, None)]
    want = {"empty.json": "empty", "blank.json": "empty", "bytes.json": "undecodable", "cut.json": "unparsable", "list.json": "unparsable", "more.json": "unparsable", "two.json": "unparsable"}
    assert {r.path.split("/")[-1]: r.reason for r in bad.collect()} == want
    out = [str(tmp_path / n) for n in ("g", "b", "c")]
    for _ in range(2):  # a second call finds nothing new
        kept, left = streaming.ingest_json(spark, str(tmp_path / "2024"), tables.EVENT, *out)
        assert sorted(r.run_id for r in kept.collect()) == ["r1", "r2", "r4"] and {r.path.split("/")[-1]: r.reason for r in left.collect()} == want and left.count() == 7
    (tmp_path / "2024/02").mkdir()
    (tmp_path / "2024/02/new.json").write_bytes(b'{"run_id": "r5"}')
    assert streaming.ingest_json(spark, str(tmp_path / "2024"), tables.EVENT, *out)[0].count() == 4


def test_late_captures_are_judged_in_their_place(spark, tmp_path):
    root, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "regulation string, source string, document_id string, ts timestamp, content_hash string"
    held = spark.createDataFrame([("r", "s", "a", "1"), ("r", "s", "b", "1")], "regulation string, source string, document_id string, current_hash string")
    batches = [[("a", 1, "1"), ("a", 5, "2"), ("c", 5, "1")], [("a", 3, "2"), ("b", 4, "1"), ("c", 2, "1")], [("z", 20, "0")], [("b", 1, "9"), ("z", 40, "0")]]
    with streaming.rocksdb(spark):
        for rows in batches:
            df = spark.createDataFrame([("r", "s", i, DAY + timedelta(days=d), h) for i, d, h in rows], schema)
            df.coalesce(1).write.mode("append").parquet(root)
            told = streaming.run_to_end(streaming.changes(streaming.source(spark, root, df.schema), held, "5 days"), out, check)
    got = sorted((r.document_id, (r.ts - DAY).days, r.event) for r in told.collect())
    # b's capture of the first day comes behind the watermark and is left out
    assert got == [("a", 1, "unchanged"), ("a", 3, "updated"), ("a", 5, "unchanged"), ("b", 4, "unchanged"), ("c", 2, "new"), ("c", 5, "unchanged"), ("z", 20, "new")]


def test_old_files(spark, tmp_path):
    for name, days in (("new.log", 1), ("edge.log", 13.99), ("old.log", 14.01), ("older.log", 90), ("old.txt", 90)):
        (tmp_path / "s").mkdir(exist_ok=True)
        (tmp_path / "s" / name).write_text("x")
        at = (DAY - timedelta(days=days)).replace(tzinfo=UTC).timestamp()
        os.utime(tmp_path / "s" / name, (at, at))
    now = F.lit(DAY.replace(tzinfo=UTC)).cast("timestamp")
    found = lambda days: sorted(r.path.split("/")[-1] for r in tables.expired_files(spark, str(tmp_path), now, days).collect())
    assert found(14) == ["old.log", "older.log"] and found(0) == found(-3) == [] and found(60) == ["older.log"]


def test_edits_pass_once_and_late_ones_are_told(spark, tmp_path):
    batches = [[("a", 0, "1"), ("a", 1, "1"), ("a", 2, "2"), ("b", 2, "1")], [("a", 3, "2"), ("a", 1, "3"), ("b", 9, "1")], [("b", 1, "7"), ("a", 30, "3"), ("b", 8, "1")]]
    with streaming.rocksdb(spark):
        for rows in batches:
            df = spark.createDataFrame([(i, h, DAY + timedelta(days=d)) for i, d, h in rows], "id string, content_hash string, ts timestamp")
            df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            told = streaming.run_to_end(streaming.edits(streaming.source(spark, str(tmp_path / "in"), df.schema), "5 days", 6), str(tmp_path / "out"), str(tmp_path / "check"))
    got = sorted((r.id, (r.ts - DAY).days, r.content_hash, r.outcome) for r in told.collect())
    assert got == [("a", 0, "1", "passed"), ("a", 1, "3", "passed"), ("a", 2, "2", "passed"), ("a", 3, "2", "passed"), ("a", 30, "3", "passed"), ("b", 1, "7", "late"), ("b", 2, "1", "passed"), ("b", 9, "1", "passed")]


def test_long_robots_files_equal_the_standard_parser(spark):
    rnd = random.Random(6)
    piece = lambda: "".join(rnd.choice(["/a", "/b", "/c%20d", "/é", "/e?f=1", "x", "/"]) for _ in range(rnd.randint(1, 5)))
    bodies = [["User-agent: *", *(f"{rnd.choice(['Allow', 'Disallow'])}: {rnd.choice([piece(), '/' + piece(), '', '*', f'/n/{k}'][:3 if k else 5])}" for k in range(n, 0, -1))] for n in (3, 300, 10_000)]
    parsers = []
    for body in bodies:
        parsers.append(RobotFileParser())
        parsers[-1].parse(body)
    urls = [(k, f"https://h{k}.org", f"https://h{k}.org/{piece()}") for k in range(3) for _ in range(60)] + [(9, "https://none.org", "https://none.org/a")]
    rows = spark.createDataFrame(urls, "k int, origin string, url string")
    files = spark.createDataFrame([(f"https://h{k}.org", "\n".join(b)) for k, b in enumerate(bodies)] + [("https://copy.org", "\n".join(bodies[1]))], "origin string, body string")
    for short in (0, 64, 1 << 30):
        got = extract.allowed_paths(rows, files, "vigilspark", short).collect()
        assert len(got) == len(urls) and all(r.allowed == (r.k == 9 or parsers[r.k].can_fetch("vigilspark", r.url)) for r in got), short
