"""Semantics on inline rows: run cuts, versions, policies, selectors, expressions and tables."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from vigilspark.functions import columns as fn
from vigilspark.functions import policy
from vigilspark.operators import changes, extract, requests, select
from vigilspark.plans import specs
from vigilspark.sources import tables
from vigilspark.streaming import operators as streaming


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v"))).first()[0]


def loop_cut(rows, budget):
    """The rule as a loop over one run's candidates."""
    labels, saved, reason = [], 0, None
    for known, outcome in rows:
        if reason:
            labels.append("not_reached")
        elif known:
            labels.append("skipped_known")
        elif budget is not None and saved >= budget:
            reason = "budget_reached"
            labels.append("not_reached")
        else:
            labels.append("executed")
            if outcome in ("hard_stop", "bot_block"):
                reason = outcome
            elif outcome == "ok":
                saved += 1
                if budget is not None and saved >= budget:
                    reason = "budget_reached"
    return labels, reason or "completed"


def test_run_cut_equals_the_loop(spark):
    rng, rows, want = random.Random(1), [], {}
    for run in range(120):
        cands = [(rng.random() < 0.3, rng.choice(["ok"] * 6 + ["error", "error", "hard_stop", "bot_block"])) for _ in range(rng.randrange(0, 12))]
        rows += [(run, k, *c) for k, c in enumerate(cands)]
        want[run] = cands
    df = spark.createDataFrame(rows, "run int, pos int, known boolean, outcome string").cache()
    for budget in (None, 0, 1, 3):
        got = {}
        for r in select.run_cut(df, ["run"], "pos", budget).orderBy("run", "pos").collect():
            got.setdefault(r.run, ([], r.stop_reason))[0].append(r.label)
        assert got == {run: loop_cut(c, budget) for run, c in want.items() if c}


def test_slots_equal_the_recursion(spark):
    rng, rows = random.Random(2), []
    for host in "abc":
        rows += [(host, k, t) for k, t in enumerate(sorted(rng.uniform(0, 50) for _ in range(40)))]
    got = {(r.origin, r.event_id): r.slot for r in requests.slots(spark.createDataFrame(rows, "origin string, event_id int, t double"), "t", 2.5).collect()}
    last = {}
    for host, k, t in rows:
        last[host] = max(t, last.get(host, -1e9) + 2.5)
        assert abs(got[host, k] - last[host]) < 1e-6


def captures(spark, rows):
    return changes.hashed(spark.createDataFrame([("fda", "s", i, c, datetime(2024, 1, d), t, f"u{i}", "txt", f) for i, c, d, t, f in rows], "regulation string, source string, document_id string, content string, ts timestamp_ntz, title string, url string, ext string, filename string"))


def test_merge_is_idempotent_but_for_the_check_time(spark):
    first = captures(spark, [("a", "1", 1, "A", None), ("b", "1", 1, "B", "b.txt")])
    state = changes.merge(first, changes.empty_state(first))
    second = captures(spark, [("a", "2", 5, "A2", "a.txt"), ("b", "1", 5, "B2", None), ("c", "1", 5, "C", None)])
    once = changes.merge(second, state)
    rows = {r.document_id: r for r in once.collect()}
    assert rows["b"].title == "B" and rows["b"].original_filename == "b.txt" and rows["b"].last_checked_at == datetime(2024, 1, 5) and rows["b"].last_scraped_at == datetime(2024, 1, 1)
    assert rows["a"].title == "A2" and len(rows["a"].version_history) == 2 and rows["a"].first_seen_at == datetime(2024, 1, 1)
    twice = {r.document_id: r for r in changes.merge(second, once).collect()}
    assert twice == rows
    assert [r.event for r in changes.classify(second, state).orderBy("document_id").collect()] == ["updated", "unchanged", "new"]
    assert changes.replaced(second, state).first().archive_path.startswith("fda/s/documents/a/versions/20240101T000000+0000__")


def test_a_return_to_an_old_hash_is_a_version(spark):
    rows = captures(spark, [("a", "1", 1, "t", None), ("a", "2", 2, "t", None), ("a", "2", 3, "t", None), ("a", "1", 4, "t", None)])
    r = changes.histories(rows).first()
    assert r.version_count == 3 and [v.ts.day for v in r.version_history] == [1, 2, 4]


def test_canonical_json_ignores_column_order(spark):
    rows = spark.createDataFrame([(1, None, "x")], "b int, a string, c string")
    a = rows.select(changes.canonical(rows, ["c", "a", "b"])).first()[0]
    assert a == '{"a":null,"b":1,"c":"x"}'


def test_due_counts_whole_days(spark):
    state = spark.createDataFrame([("r", "s", "a", datetime(2024, 1, 1, 0, 0, 1)), ("r", "s", "b", datetime(2024, 1, 1)), ("r", "s", "c", None)], "regulation string, source string, document_id string, last_checked_at timestamp_ntz")
    cands = spark.createDataFrame([("r", "s", x) for x in "abcd"], "regulation string, source string, document_id string")
    now = F.expr("TIMESTAMP_NTZ'2024-01-08 00:00:00'")
    ids = lambda days: sorted(r.document_id for r in select.due(cands, state, now, days).collect())
    assert ids(7) == ["b", "c", "d"] and ids(None) == ["d"] and ids(0) == ["a", "b", "c", "d"]


def test_selectors(spark):
    reg = spark.createDataFrame([("fda", "a", True), ("fda", "b", False), ("eu", "c", True)], "regulation string, source string, enabled boolean")
    req = spark.createDataFrame([(1, "all"), (2, "fda:all,eu:c,fda:a"), (3, "fda:b"), (4, "nope")], "request_id int, expr string")
    got = sorted((r.request_id, r["at"], r.source, r.unknown) for r in select.choose_sources(req, reg).collect())
    assert [g for g in got if g[0] == 2] == [(2, 0, "a", None), (2, 1, "c", None)]
    assert sorted(g[2] for g in got if g[0] == 1) == ["a", "c"] and got[-2:] == [(3, 0, "b", None), (4, 0, None, "nope")]


@pytest.mark.parametrize(
    ("body", "want"),
    [
        ("Hit-rate: 30\nCrawl-delay: 5", (30.0, None, None, None)),
        ("User-agent: *\nCrawl-delay: 5", (5.0, None, None, None)),
        ("visiting-hours: 23:00EDT-05:00EDT", (None, 1380, 300, "America/New_York")),
        ("Visiting-hours: 24:15 PST - 1:00 XYZ", (None, 15, 60, "America/Los_Angeles")),
        ("Visiting-hours: 23:00XXX-05:00XXX\nDisallow: /", (None, None, None, None)),
    ],
)
def test_robots_policy(spark, body, want):
    assert tuple(one(spark, body, policy.policy)) == want


def test_window_across_daylight_saving(spark):
    p = spark.createDataFrame([((None, 1380, 300, "America/New_York"),)], f"p {policy.POLICY}")
    for now, is_open, opens in (
        ("2024-03-10 03:30:00", False, "2024-03-10 03:30"),
        ("2024-03-10 04:30:00", True, None),
        ("2024-07-01 12:00:00", False, "2024-07-02 03:00"),
        ("2024-12-01 12:00:00", False, "2024-12-02 04:00"),
    ):
        row = p.select(policy.open_now(F.col("p"), F.expr(f"TIMESTAMP'{now} UTC'")), F.date_format(policy.next_open(F.col("p"), F.expr(f"TIMESTAMP'{now} UTC'")), "yyyy-MM-dd HH:mm")).first()
        if now.startswith("2024-03-10 03:30"):
            assert row[0] is False and row[1] == "2024-03-10 04:00"
        else:
            assert (row[0], row[1]) == (is_open, opens)
    never = spark.createDataFrame([((None, 60, 60, "UTC"),)], f"p {policy.POLICY}").select(policy.open_now(F.col("p"), F.expr("TIMESTAMP'2024-01-01 01:00:00 UTC'"))).first()[0]
    assert never is False
    assert p.select(policy.described(F.col("p"))).first()[0] == "11:00 PM–5:00 AM America/New York"


def test_last_policy_modes(spark):
    rows = spark.createDataFrame([("o", 1, "loaded", "p"), ("o", 2, "absent", None), ("o", 3, "blocked", None), ("o", 4, "loaded", None), ("o", 5, "blocked", None)], "origin string, ts int, state string, policy string")
    force = lambda mode: [r.policy_in_force for r in requests.last_policy(rows, mode).orderBy("ts").collect()]
    assert force("store") == ["p", None, "p", None, "p"] and force("clear") == ["p", None, None, None, None]


@pytest.mark.parametrize(
    ("header", "want"),
    [
        ('attachment; filename="a b.pdf"', "a b.pdf"),
        ("attachment; filename=plain.pdf; size=3", "plain.pdf"),
        ("attachment; filename=\"x.pdf\"; filename*=UTF-8''Summary%20K1.pdf", "Summary K1.pdf"),
        ("attachment; filename*=iso-8859-1''caf%E9.pdf", "café.pdf"),
        ("inline", None),
        ('attachment; filename=""', None),
    ],
)
def test_disposition(spark, header, want):
    assert one(spark, header, lambda c: fn.disposition_filename(c)) == want


def test_expressions(spark):
    assert one(spark, "  Déjà Vu: 21 CFR!", fn.slug) == "d-j-vu-21-cfr" and one(spark, "!!", fn.slug) == "untitled"
    assert one(spark, "https://x.gov/a/b.pdf?x=1", fn.url_filename) == "b.pdf" and one(spark, "https://x.gov/a/b", fn.url_filename) is None
    assert one(spark, "https://x.gov/a/doc/", fn.slug_or_hash) == "doc" and len(one(spark, "https://x.gov/a/doc?y", fn.slug_or_hash)) == 16
    assert [one(spark, s, fn.duration, "double") for s in (59.5, 0.5, 65.0, 7380.0)] == ["1m00s", "0s", "1m05s", "2h03m"]
    assert one(spark, "Tom &amp; &eacute;", fn.unescaped) == "Tom & é" and one(spark, "", fn.unescaped) is None
    assert one(spark, "https://a.gov:80", fn.origin_slug) == "a.gov%3A80"
    assert [one(spark, s, select.clean_id) for s in (" /a/b/ ", "..", "a/../b", "a..b", " / ")] == ["a/b", None, None, "a..b", None]
    assert [one(spark, s, select.bare_root) for s in ("https://x.gov", "https://x.gov/", "https://x.gov/?a", "https://x.gov/a")] == [True, True, False, False]
    assert one(spark, "K241234", lambda c: fn.pdf_url("b", c)) == "b/pdf24/K241234.pdf" and one(spark, "K091234", lambda c: fn.pdf_url("b", c)) == "b/pdf09/K091234.pdf" and one(spark, "KX", lambda c: fn.pdf_url("b", c)) is None
    assert one(spark, datetime(2024, 1, 2, 3, 4, 5), lambda c: fn.run_id_parts(fn.run_id(F.lit("fda"), F.lit("clear-510k"), c))["source"], "timestamp") == "clear-510k"


LETTERS = "<table><thead><tr><th>h</th></tr></thead><tbody><tr><td>01/02/2024</td><td>12/01/2023</td><td><a href='/a/firm-1/'>Firm <b>One</b></a></td><td>Office &amp; Co</td><td>Sub<br>ject</td><td></td><td></td></tr><tr><td>x</td><td>no link</td></tr></tbody></table>"
HDE = "<table><tr><td>1999</td><td><a href='x'>H990001</a></td><td>Dev <i>ice</i></td><td>Co</td><td>Desc</td></tr><tr><td>H980002</td><td>H980002</td><td>Old</td><td>Co</td><td>D</td></tr><tr><td>a</td><td>H970001</td></tr></table>"
MDCG = "<h2>Topic <b>A</b></h2><table class='x ecl-table'><tr><th>h</th></tr><tr><td data-ecl-table-header='Reference'><a href='/d/1.pdf'>R1</a></td><td data-ecl-table-header='Title'>T1</td></tr><tr><td data-ecl-table-header='Title'>none</td></tr></table><h3>B</h3><table class='ecl-table'><tr><td>h</td></tr><tr><td data-ecl-table-header='Title'><a href='https://o/2'>T2</a><table><tr><td>inner</td></tr></table></td></tr></table>"


def test_listing_tables(spark):
    rows = extract.read_tables(spark.createDataFrame([(1, LETTERS), (2, HDE), (3, MDCG), (4, None), (5, "<p>no table")], "page_id bigint, html string")).cache()
    letter = extract.letters(rows.filter("page_id = 1")).collect()
    assert [(r.document_id, r.title, r.posted_date, r.issuing_office, r.subject) for r in letter] == [("firm-1", "FirmOne", "01/02/2024", "Office & Co", "Subject")]
    approval = extract.approvals(rows.filter("page_id = 2")).orderBy("number").collect()
    assert [(r.number, r.device_name, r.has_detail_page) for r in approval] == [("H980002", "Old", False), ("H990001", "Dev ice", True)]
    classed = extract.classed_rows(rows.filter("page_id = 3"), "https://b").orderBy("url").collect()
    assert [(r.url, r.reference, r.title, r.category) for r in classed] == [("https://b/d/1.pdf", "R1", "T1", "TopicA"), ("https://o/2", None, "T2inner", "B")]


def test_region_links(spark):
    html = '<nav><a href="/n">N</a></nav><article><a class="k" href="/a">A <b>x</b></a><a href="">E</a></article>'
    got = extract.region_links(spark.createDataFrame([(1, html), (2, "<p>")], "page_id int, html string")).orderBy("page_id", "pos").collect()
    assert [(r.page_id, r.region_missing, r.href, r.text) for r in got] == [(1, False, "/a", "Ax"), (1, False, "", "E"), (2, True, None, None)]


def test_block_and_response_classes(spark):
    df = spark.createDataFrame([("text/HTML", 100, "x <b>ACCESS denied"), ("application/pdf", 100, "access denied"), ("text/html", 20_001, "captcha"), ("text/html", 5000, " " * 4000 + "captcha")], "t string, n int, b string")
    assert [r[0] for r in df.select(extract.is_block_page(F.col("t"), F.col("n"), F.col("b"))).collect()] == [True, False, False, False]


def test_versions(spark):
    href = "/legal-content/EN/ALL/?uri=CELEX:{}"
    anchors = [("m", 1, href.format("02017R0745-20240101"), "t"), ("m", 2, href.format("02017R0745-20230101"), "Access current version (1)"), ("m", 3, "/x", "Access current version"),
               ("n", 1, href.format("02017R0746-20200101"), "t"), ("n", 2, href.format("02017R0746-20210101"), "t"), ("k", 1, href.format("02099R0001-20210101"), "t")]
    acts = [("m", "32017R0745"), ("n", "32017R0746"), ("k", "32017R0747"), ("none", "32017R0748")]
    found = extract.consolidated(spark.createDataFrame(acts, "act string, celex string"), spark.createDataFrame(anchors, "act string, pos int, href string, text string"))
    got = {r.act: (r.consolidated_celex, r.error is None) for r in found.collect()}
    assert got == {"m": ("02017R0745-20230101", True), "n": ("02017R0746-20210101", True), "k": (None, False), "none": (None, False)}


def test_allowed_paths(spark):
    cands = spark.createDataFrame([("o", "https://o/private/a"), ("o", "https://o/b"), ("q", "https://q/private")], "origin string, url string")
    robots = spark.createDataFrame([("o", "User-agent: *\nDisallow: /private")], "origin string, body string")
    assert {r.url: r.allowed for r in extract.allowed_paths(cands, robots, "bot").collect()} == {"https://o/private/a": False, "https://o/b": True, "https://q/private": True}


def test_settings(spark):
    """Command, then own, then global, then default; -1 is no limit only once it has won."""
    sources = spark.createDataFrame([("r", x) for x in "abcd"], "regulation string, source string")
    own = spark.createDataFrame([("r", "a", 0.2, -1, 14), ("r", "b", None, 40, None)], "regulation string, source string, rps double, max_new int, recheck_after_days int")
    over = spark.createDataFrame([("r", "b", -1, 3), ("r", "c", 7, None)], "regulation string, source string, max_new int, lookback_days int")
    got = {r.source: (r.enabled, r.rps, r.max_new, r.recheck_after_days, r.lookback_days, r.time_budget_minutes) for r in specs.effective(sources, own, over, {"max_new": 25}).collect()}
    assert got == {"a": (True, 0.2, None, 14, None, None), "b": (True, 1.0, None, None, 3, None), "c": (True, 1.0, 7, None, None, None), "d": (True, 1.0, 25, None, None, None)}
    plain = {r.max_new for r in specs.effective(sources, own.limit(0)).collect()}
    assert plain == {1000}
    left = spark.createDataFrame([(0.2, None, 90), (1.0, 7, 10), (1.0, 1000, None)], "rps double, max_new int, remaining bigint")
    assert [(r.this_run, r.eta_s) for r in specs.preview(left).collect()] == [(90, 450.0), (7, 7.0), (None, None)]


def test_lenient_files(spark, tmp_path):
    for folder, text in (("a", '{"run_id": "r1", "source": "s",\n "ts": "2024-01-01T00:00:00Z", "event": "new"}'), ("b", "{broken"), ("c", '{"run_id": "r2"}')):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "e.json").write_text(text)
        (tmp_path / folder / "note.txt").write_text("no")
    good, bad = tables.lenient(tables.read_json(spark, str(tmp_path), tables.EVENT))
    assert sorted(r.run_id for r in good.collect()) == ["r1", "r2"] and [r.path.split("/")[-2] for r in bad.collect()] == ["b"]
    assert tables.read_documents(spark, str(tmp_path)).count() == 0
    assert {r.path.split("/")[-1] for r in tables.read_bytes(spark, str(tmp_path), "*.txt").collect()} == {"note.txt"}


def test_arrays_and_logs(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"x": 1}, {"x": 2}]')
    assert sorted(r.x for r in tables.read_array(spark, str(tmp_path / "a.json"), "x int").collect()) == [1, 2]
    (tmp_path / "l.log").write_text('{"ts": "2024-01-01T00:00:00Z", "level": "INFO", "message": "m", "status": 200}\nnot json\n')
    got = tables.read_log(spark, str(tmp_path / "l.log")).select("message", tables.extra("status", "int").alias("status")).collect()
    assert [tuple(r) for r in got] == [("m", 200), (None, None)]


def test_streamed_changes_equal_replay(spark, tmp_path):
    root = str(tmp_path / "in")
    rows = [("r", "s", str(i % 3), datetime(2024, 1, 1 + i), str(i % 2)) for i in range(9)]
    df = spark.createDataFrame(rows, "regulation string, source string, document_id string, ts timestamp, content_hash string")
    df.coalesce(1).write.parquet(root)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", streaming.ROCKSDB)
    told = streaming.run_to_end(streaming.changes(streaming.source(spark, root, df.schema)), str(tmp_path / "out"), str(tmp_path / "ck"))
    versions = changes.replay(df).select("document_id", "ts")
    assert told.filter("event <> 'unchanged'").select("document_id", "ts").exceptAll(versions).isEmpty() and told.count() == 9
