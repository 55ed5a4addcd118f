"""Each source's chain on inline records and pages, and the rules of state, runs, robots files and responses."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from vigilspark.functions import columns as fn
from vigilspark.functions import policy
from vigilspark.operators import changes, extract, requests, runs, select
from vigilspark.plans import specs
from vigilspark.sources import tables
from vigilspark.streaming import operators as streaming


def records(spark, *rows: dict):
    """Rows of strings, with pos."""
    names = list(dict.fromkeys(k for r in rows for k in r))
    return spark.createDataFrame([(k, *(r.get(n) for n in names)) for k, r in enumerate(rows)], "pos bigint, " + ", ".join(f"`{n}` string" for n in names))


def read(name, raw):
    return specs.SPECS[name].candidates(raw).orderBy("pos").collect()


def test_all_sources_are_there():
    assert sorted(specs.SPECS) == sorted(
        "fda:ecfr fda:fdc_act fda:guidance fda:clearances_510k fda:pma fda:hde fda:recalls fda:classification fda:warning_letters "
        "eu:mdr eu:ivdr eu:mdcg_guidance ca:mdr ca:food_and_drugs_act ca:mdall ca:recalls ca:guidance".split()
    )


@pytest.mark.parametrize(
    ("name", "document_id", "ext", "meta"),
    [
        ("fda:ecfr", "title-21", "xml", {"title": "21", "source": "govinfo_bulkdata"}),
        ("fda:fdc_act", "fdc-act", "xml", {"title": "Federal Food, Drug, and Cosmetic Act", "source": "govinfo_comps", "package_id": "COMPS-973"}),
        ("ca:mdr", "mdr", "html", {"instrument_number": "SOR/98-282", "source": "justice_laws"}),
        ("ca:food_and_drugs_act", "food-and-drugs-act", "html", {"citation": "R.S.C., 1985, c. F-27", "source": "justice_laws"}),
    ],
)
def test_fixed_documents(spark, name, document_id, ext, meta):
    (row,) = read(name, spark.range(5))
    assert (row.document_id, row.ext, row.source_metadata, row.content) == (document_id, ext, meta, None)


@pytest.mark.parametrize(("name", "celex"), [("mdr", "32017R0745"), ("ivdr", "32017R0746")])
def test_acts(spark, name, celex):
    own = "0" + celex[1:]
    html = f"<a href='?uri=CELEX:{own}-20250101'>01/01/2025</a><a href='?uri=CELEX:{own}-20240101&x'> <b>Access current version</b> (1)</a><a href='?uri=CELEX:02001R0001-20260101'>Access current version</a>"
    (row,) = read(f"eu:{name}", spark.createDataFrame([(html,)], "html string"))
    assert row.document_id == name and row.url.endswith(f"CELEX:{own}-20240101")
    assert row.source_metadata == {"original_celex": celex, "consolidated_celex": f"{own}-20240101", "source": "eur_lex"}
    assert read(f"eu:{name}", spark.createDataFrame([("<p>none",)], "html string")) == []


def test_fda_guidance(spark):
    base = {"field_regulated_product_field": "Biologics, Medical Devices", "field_issue_datetime": "2024-01-01", "field_final_guidance_1": "Final", "field_communication_type": "",
            "field_issuing_office_taxonomy": "Center for A &amp; B", "field_center": "", "field_docket_number": '<a href="/d">FDA-1</a>', "open-comment": " No ", "changed": "x"}
    rows = [
        base | {"title": '<a href="/media/one/">One &amp; <i> only</i></a>'}, base | {"title": "<a>no target</a>"}, base | {"title": '<a href="/x">x</a>', "field_regulated_product_field": "Drugs"},
        base | {"title": '<a href="https://o.gov/two">Two</a>', "field_docket_number": None}, base | {"title": '<a href="/other/one">Again</a>'},
    ]
    first, second = read("fda:guidance", records(spark, *rows))
    assert (first.document_id, first.pos, first.title, first.url) == ("one", 0, "Again", "https://www.fda.gov/other/one")
    assert (second.document_id, second.url) == ("two", "https://o.gov/two") and second.source_metadata["docket_number"] is None
    assert first.source_metadata == {
        "issue_date": "2024-01-01", "status": "Final", "communication_type": None, "issuing_office": "Center for A & B", "center": None,
        "regulated_product_field": "Biologics, Medical Devices", "docket_number": "FDA-1", "open_for_comment": "No",
    }


def test_clearances(spark):
    one = {"k_number": "K241234", "device_name": "Dev", "applicant": "Co", "decision_date": "2024-01-01", "decision_code": "SE", "product_code": "ABC", "clearance_type": "T", "statement_or_summary": "Summary"}
    rows = read("fda:clearances_510k", records(spark, one, one | {"k_number": "K240001", "statement_or_summary": "Statement"}, one | {"k_number": "KX1"}))
    assert [(r.document_id, r.ext) for r in rows] == [
        ("K241234/metadata", "json"), ("K241234/summary", "pdf"), ("K240001/metadata", "json"), ("K240001/summary", "json"), ("KX1/metadata", "json"),
    ]
    assert set(rows[0].source_metadata) == {"k_number", "applicant", "decision_date", "decision_code", "product_code", "clearance_type", "statement_or_summary"}
    assert rows[1].url == "https://www.accessdata.fda.gov/cdrh_docs/pdf24/K241234.pdf" and rows[1].content is None and rows[1].title == "510(k) Summary — Dev"
    assert rows[3].content == changes.SENTINEL and rows[3].source_metadata == {"k_number": "K240001", "not_applicable": "true", "reason": "statement_or_summary != 'Summary'"}
    (bad,) = specs.file_errors(records(spark, one, one | {"k_number": "KX1"}), F.col("k_number"), "summary").collect()
    assert bad.document_id == "KX1/summary" and "KX1" in bad.error


def test_pma(spark):
    one = {"pma_number": "P240001", "supplement_number": "S002", "applicant": "Co", "trade_name": "", "generic_name": "Gen", "product_code": "A", "decision_date": "d", "decision_code": "APPR",
           "supplement_type": "t", "supplement_reason": "r", "advisory_committee": "c"}
    meta, order = read("fda:pma", records(spark, one))
    assert (meta.document_id, meta.title) == ("P240001S002/metadata", "Gen") and order.url.endswith("/pdf24/P240001S002A.pdf")
    assert set(meta.source_metadata) == {
        "pma_number", "supplement_number", "applicant", "product_code", "decision_date", "decision_code", "supplement_type", "supplement_reason", "advisory_committee",
    }
    assert order.source_metadata == {"pma_number": "P240001", "supplement_number": "S002"}


def test_hde(spark):
    html = "<table><tbody><tr><td>01/02/2020</td><td><a href='x'>H200002</a></td><td>Dev</td><td>Co</td><td>Desc</td></tr><tr><td>H980002</td><td>H980002</td><td>Old</td><td>Co</td><td>D</td></tr></tbody></table>"
    rows = {r.document_id: r for r in read("fda:hde", spark.createDataFrame([(1, html)], "page_id bigint, html string"))}
    assert rows["H200002/order"].url.endswith("/pdf20/H200002A.pdf") and rows["H200002/metadata"].source_metadata == {"hde_number": "H200002", "approval_date": "01/02/2020", "company": "Co"}
    assert rows["H980002/order"].source_metadata == {"hde_number": "H980002", "not_applicable": "true", "reason": "no detail page listed"}


def test_recalls_and_classification(spark):
    recall = {"recall_number": "Z-1", "product_description": "P", "classification": "Class II", "status": "Ongoing", "recalling_firm": "Firm", "report_date": "d", "product_code": "A"}
    one, other = read("fda:recalls", records(spark, recall, recall | {"recall_number": "", "event_id": "e7"}))
    assert one.source_metadata == {"recall_number": "Z-1", "classification": "Class II", "status": "Ongoing", "firm_name": "Firm", "report_date": "d", "product_code": "A"}
    assert other.document_id == "e7" and '"recalling_firm":"Firm"' in one.content
    code = dict.fromkeys(specs.CLASSIFICATION, "v") | {"product_code": "ABC", "extra": "kept in content only"}
    (row,) = read("fda:classification", records(spark, code))
    assert row.document_id == "ABC" and set(row.source_metadata) == set(specs.CLASSIFICATION) and "extra" in row.content


def test_warning_letters(spark):
    page = "<table><tbody>{}</tbody></table>"
    row = "<tr><td>01/02/2024</td><td>12/01/2023</td><td><a href='/a/{0}/'>Firm {0}</a> (closed out)</td><td>Office</td><td>Sub</td><td></td><td></td></tr>"
    pages = [(0, page.format(row.format("a") + row.format("b"))), (1, page.format(row.format("c"))), (2, page.format("")), (3, page.format(row.format("d")))]
    rows = read("fda:warning_letters", spark.createDataFrame(pages, "page int, html string"))
    assert [(r.document_id, r.title, r.url) for r in rows] == [(x, f"Firm {x}", f"https://www.fda.gov/a/{x}/") for x in "abc"]
    assert rows[0].source_metadata == {"company_name": "Firm a", "posted_date": "01/02/2024", "letter_issue_date": "12/01/2023", "issuing_office": "Office", "subject": "Sub"}


def test_mdcg(spark):
    cell = "<td data-ecl-table-header='{}'>{}</td>"
    uuid = "0a1b2c3d-0000-4000-8000-000000000001"
    html = (
        "<h2>Topic</h2><table class='ecl-table'><tr><th>h</th></tr>"
        + "<tr>" + cell.format("Reference", f"<a href='/document/download/{uuid}_en?filename=a.pdf'>MDCG 1</a>") + cell.format("Title", "T") + cell.format("Publication", "May") + "</tr>"
        + "<tr>" + cell.format("Reference", "") + cell.format("Title", "<a href='https://ext.example/page'>Ext</a>") + "</tr></table>"
    )
    one, two = read("eu:mdcg_guidance", spark.createDataFrame([(1, html)], "page_id bigint, html string"))
    assert (one.document_id, one.ext, one.content_type, one.title) == (uuid, "pdf", "application/pdf", "T")
    assert one.source_metadata == {"reference": "MDCG 1", "category": "Topic", "publication": "May"}
    assert len(two.document_id) == 16 and two.ext == "html" and two.source_metadata["reference"] is None


def test_canadian_lists(spark):
    licence = dict.fromkeys(specs.LICENCE, "1") | {"licence_name": "L"}
    (row,) = read("ca:mdall", records(spark, licence))
    assert row.document_id == "1" and set(row.source_metadata) == set(specs.LICENCE) and row.title == "L"
    recall = {"NID": "7", "Title": "T", "URL": "", "Organization": "Medical devices", "Product": "P", "Issue": "I", "Category": "C", "Recall class": "II", "Last updated": "d", "Archived": "0"}
    (row,) = read("ca:recalls", records(spark, recall, recall | {"NID": None}, recall | {"NID": "8", "Organization": "Food"}))
    assert row.source_metadata == {"nid": "7", "issue": "I", "category": "C", "recall_class": "II", "last_updated": "d", "archived": "0"} and row.url == specs.RECALL_DATA


def test_canadian_guidance(spark):
    html = (
        "<nav><a href='/noise.html'>noise</a></nav><main property='mainContentOfPage'><main><ul><li><a href='/en/a/one.html'>One &amp; <b>x</b></a></li></ul></main>"
        "<a href='https://www.mdsap.global/'>site</a><a href='https://e.example/learn?id=1'>E</a><a href='/en/empty.html'> </a><a href='/en/b/one.html'>Later</a></main><a href='/after.html'>after</a>"
    )
    rows = read("ca:guidance", spark.createDataFrame([(1, html)], "page_id bigint, html string"))
    assert [(r.document_id[:8], r.title) for r in rows] == [("one.html", "Later"), (rows[1].document_id[:8], "E")] and len(rows[1].document_id) == 16
    assert rows[0].url == "https://www.canada.ca/en/b/one.html" and rows[0].source_metadata == {"link_text": "Later"}
    missing = extract.region_links(spark.createDataFrame([(1, "<main><a href='/x'>x</a></main>")], "page_id bigint, html string"), attribute=("property", "mainContentOfPage")).collect()
    assert [(r.region_missing, r.pos) for r in missing] == [(True, None)]


CAPTURE = (
    "regulation string, source string, document_id string, content string, ts timestamp_ntz, title string, url string, ext string, filename string, "
    "content_type string, http_status int, source_metadata map<string,string>"
)


def capture(spark, content, day, ext="html", **meta):
    return changes.hashed(spark.createDataFrame([("fda", "s", "a", content, datetime(2024, 1, day), f"T{day}", f"u{day}", ext, None, f"t/{day}", 200, meta)], CAPTURE))


def test_state_keeps_metadata_and_events_tell_the_held_path(spark):
    first = capture(spark, "1", 1, "htm", k="one")
    state = changes.merge(first, changes.empty_state(first))
    again = capture(spark, "1", 5, "pdf", k="two")
    (row,) = changes.merge(again, state).collect()
    assert row.source_metadata == {"k": "one"} and row.content_type == "t/1" and row.last_checked_at.day == 5
    (event,) = changes.events(changes.classify(again, state), F.lit("r")).collect()
    assert (event.event, event.storage_path, event.http_status, event.error) == ("unchanged", "fda/s/documents/a/current.htm", 200, None)
    new = capture(spark, "2", 6, "pdf", k="three")
    (row,) = changes.merge(new, state).collect()
    assert row.source_metadata == {"k": "three"} and row.content_type == "t/6" and row.current_storage_path.endswith("current.pdf")
    (event,) = changes.events(changes.classify(new, state), F.lit("r")).collect()
    assert event.storage_path == "fda/s/documents/a/current.pdf"
    files = spark.createDataFrame([("fda/s/documents/a/current.htm", bytearray(b"1"))], "path string, content binary")
    (old,) = changes.archived(changes.replaced(new, state), files).collect()
    assert bytes(old.content) == b"1" and old.archive_path.endswith(".pdf") and "20240101T000000+0000__" in old.archive_path
    failed = spark.createDataFrame([("fda", "s", "b", datetime(2024, 1, 1), "u", "gone")], "regulation string, source string, document_id string, ts timestamp_ntz, url string, error string")
    assert changes.error_events(failed, F.lit("r")).schema == changes.events(changes.classify(new, state), F.lit("r")).schema
    assert changes.error_events(failed, F.lit("r")).first().error == "gone"


def test_due_by_text_times(spark):
    times = [("a", "2024-01-01T00:00:00+00:00", None), ("b", "yesterday", "2024-01-08T00:00:00+00:00"), ("c", None, "2024-01-07T12:00:00+00:00"), ("d", "", None), ("e", "2024-01-01T01:00:00-05:00", None)]
    state = spark.createDataFrame([("r", "s", *t) for t in times], "regulation string, source string, document_id string, last_checked_at string, last_scraped_at string")
    listed = spark.createDataFrame([("r", "s", x) for x in "abcdef"], "regulation string, source string, document_id string")
    due = lambda days: sorted(r.document_id for r in select.due(listed, state, F.expr("TIMESTAMP_NTZ'2024-01-08 00:00:00'"), days).collect())
    assert due(7) == ["a", "b", "d", "f"] and due(6) == ["a", "b", "d", "e", "f"] and due(None) == ["f"] and due(0) == list("abcdef")


def test_selectors_by_item(spark):
    reg = spark.createDataFrame([("fda", "a", False), ("fda", "b", False), ("eu", "c", True), ("eu", "d", False)], "regulation string, source string, enabled boolean")
    req = spark.createDataFrame([(1, "all,"), (2, "fda:all"), (3, "eu:d, ,eu:c,eu:all,x:all,eu:z,bare")], "request_id int, expr string")
    items = select.selector_items(req)
    assert sorted((r.request_id, r.item) for r in select.unknown_items(items, reg).collect()) == [(3, "bare"), (3, "eu:z"), (3, "x:all")]
    got = sorted((r.request_id, r.source, r["at"]) for r in select.choose_sources(req, reg).filter("source IS NOT NULL").collect())
    assert got == [(1, "c", 0), (3, "c", 2), (3, "d", 0)]
    assert sorted(tuple(r) for r in select.requests_per_source(items, reg).collect()) == [("eu", "c", 2), ("eu", "d", 1)]


@pytest.mark.parametrize(
    ("body", "interval", "window"),
    [
        ("User-agent: other\nCrawl-delay: 100\n\nUser-agent: *\nDisallow: /x", None, None),
        ("User-agent: *\nCrawl-delay: 5 # please", 5.0, None),
        ("User-agent: vigilspark\nCrawl-delay: 3\n\nUser-agent: *\nCrawl-delay: 9", 3.0, None),
        ("Hit-rate: 30 # wait 30 seconds\nUser-agent: *\nCrawl-delay: 60", 30.0, None),
        ("# Hit-rate: 9\nUser-agent: *\nCrawl-delay: x", None, None),
        ("Visiting-hours: 23:00EDT-05:00EDT #night", None, (1380, 300, "America/New_York")),
        ("Visiting-hours: nightly\nVisiting-hours: 1:30 utc - 2:00 utc", None, (90, 120, "UTC")),
        ("Visiting-hours: 23:00XYZ-05:00XYZ", None, None),
    ],
)
def test_robots_files(spark, body, interval, window):
    p = spark.createDataFrame([(body,), (None,)], "b string").select(policy.policy(F.col("b")).alias("p")).select("p.*").collect()
    assert p[0].min_interval == interval and (None if p[0].zone is None else (p[0].start_min, p[0].end_min, p[0].zone)) == window
    assert tuple(p[1]) == (None, None, None, None)


def test_rules_equal_the_standard_parser(spark):
    from urllib.robotparser import RobotFileParser

    bodies = {
        "a": "User-agent: *\nAllow: /p/open\nDisallow: /p\nDisallow: /q%20r", "b": "User-agent: other\nDisallow: /\n", "c": "User-agent: Vigil\nDisallow:\n\nUser-agent: *\nDisallow: /",
        "d": "User-agent: *\nDisallow: /x?y", "e": "User-agent: *\nDisallow: *", "f": "User-agent: *\nDisallow: /é",
    }
    paths = ["", "/", "/p", "/p/open/1", "/p%2Fopen", "/q r", "/q%20r/a", "/x?y=1", "/x", "/é/z", "/%C3%A9", "/a+b", "/~u/*"]
    rows = [(o, f"https://{o}.example{p}") for o in [*bodies, "none"] for p in paths]
    found = extract.allowed_paths(spark.createDataFrame(rows, "origin string, url string"), spark.createDataFrame(list(bodies.items()), "origin string, body string"))
    for r in found.collect():
        parser = RobotFileParser()
        parser.parse(bodies.get(r.origin, "").splitlines())
        assert r.allowed == parser.can_fetch(policy.AGENT, r.url), r


def test_fetch_decisions(spark):
    night = "Visiting-hours: 23:00EDT-05:00EDT"
    held = (7.0, 60, 120, "UTC")
    robots = [("a", "loaded", f"User-agent: *\nDisallow: /p\n{night}", None), ("b", "disallow_all", None, held), ("c", "absent", None, held), ("d", "blocked", None, held), ("e", "loaded", "", held)]
    robots = spark.createDataFrame(robots, f"origin string, state string, body string, policy_in_force {policy.POLICY}")
    urls = spark.createDataFrame([("a", "https://a/p/1"), ("a", "https://a/q"), *((o, f"https://{o}/q") for o in "bcdef")], "origin string, url string")
    got = {r.url: (r.decision, r.min_interval, r.opens_at and r.opens_at.hour) for r in extract.fetch_decisions(urls, robots, F.expr("TIMESTAMP'2024-07-01 12:00:00 UTC'")).collect()}
    assert got["https://a/p/1"][0] == "disallowed" and got["https://a/q"][:2] == ("outside_hours", None) and got["https://b/q"][0] == "disallowed"
    assert got["https://c/q"] == ("allowed", None, None) and got["https://d/q"] == ("outside_hours", 7.0, 1) and got["https://e/q"] == got["https://f/q"] == ("allowed", None, None)


def test_remembered_policy_survives_refusals(spark):
    rows = [("o", 1, "loaded", "p"), ("o", 2, "disallow_all", None), ("o", 3, "absent", None), ("o", 4, "blocked", None), ("o", 5, "loaded", "q"), ("o", 9, "blocked", None)]
    df = spark.createDataFrame(rows, "origin string, ts int, state string, policy string")
    for bucket in (None, F.floor(F.col("ts") / 2), F.col("ts")):
        force = lambda mode, b=bucket: [r.policy_in_force for r in requests.last_policy(df, mode, b).orderBy("ts").collect()]
        assert force("store") == ["p", "p", None, "p", "q", "q"] and force("clear") == ["p", "p", None, None, "q", "q"]


def test_response_classes(spark):
    rows = [(False, False, False, 200, "application/pdf", False), (False, False, True, 503, "text/html", False), (False, False, True, 404, "text/html", True), (False, False, False, 404, "text/html", True),
            (False, False, False, 200, "text/html", False), (True, False, False, 200, "application/pdf", False), (False, False, False, 429, "text/html", True), (False, True, False, None, None, True)]
    df = spark.createDataFrame(rows, "d boolean, f boolean, b boolean, s int, t string, m boolean")
    c = {k: F.col(k) for k in "dfbstm"}
    got = df.select(extract.response_class(c["d"], c["f"], c["b"], c["s"]), extract.pdf_class(c["d"], c["f"], c["b"], c["s"], c["t"], c["m"])).collect()
    assert [tuple(r) for r in got] == [
        ("ok", "ok"), ("hard_stop", "hard_stop"), ("bot_block", "bot_block"), ("error", "miss"), ("ok", "error"), ("hard_stop", "hard_stop"), ("hard_stop", "hard_stop"), ("hard_stop", "hard_stop"),
    ]


def test_stored_policies(spark):
    df = spark.createDataFrame([((30.0, 1380, 305, "America/New_York"),), ((None, None, None, None),)], f"p {policy.POLICY}")
    texts = [r[0] for r in df.select(policy.to_json(F.col("p"))).collect()]
    assert texts == ['{"min_interval_seconds":30.0,"visiting_hours":{"start":"23:00:00","end":"05:05:00","zone":"America/New_York"}}', '{"min_interval_seconds":null,"visiting_hours":null}']
    back = spark.createDataFrame([(t,) for t in [*texts, "{broken", None]], "t string").select(policy.from_json(F.col("t")).alias("p")).collect()
    assert [r.p and tuple(r.p) for r in back] == [(30.0, 1380, 305, "America/New_York"), (None, None, None, None), None, None]


@pytest.mark.parametrize(
    ("header", "want"),
    [
        ('attachment; filename="a;b.pdf"; size=3', "a;b.pdf"), ("attachment; FileName = x.pdf", "x.pdf"), ("attachment; filename*=iso-8859-1''caf%E9.pdf", "café.pdf"),
        ("attachment; filename*=utf-9''a%C3%A9.pdf", "aé.pdf"), ("attachment; filename*=UTF-8''bad%FF.pdf", "bad�.pdf"), ("attachment; filename*=''plain+name.pdf", "plain+name.pdf"),
        ("attachment; filename=b.pdf; filename*=UTF-8'en'a%20b.pdf", "a b.pdf"), ("inline", None), (None, None),
    ],
)
def test_header_names(spark, header, want):
    assert spark.createDataFrame([(header,)], "h string").select(fn.disposition_filename(F.col("h"))).first()[0] == want


def test_paged_listings_end(spark):
    body = lambda *ids: '{"results": [' + ",".join(f'{{"id": {i}}}' for i in ids) + "]}"
    pages = [("a", 0, body(1, 2)), ("a", 1, body(3)), ("a", 2, body()), ("a", 3, body(9)), ("b", 0, body(4)), ("b", 1, None), ("b", 2, body(9)), ("c", 0, None)]
    df = spark.createDataFrame(pages, "listing string, page int, body string")
    ids = lambda most=None: sorted(r.id for r in select.unnest_pages(df, ["listing"], "page", "body", "id:int", most).collect())
    assert ids() == [1, 2, 3, 4] and ids(2) == [1, 2, 4] and ids(1) == [1, 4]


def test_run_summaries(spark):
    day = datetime(2024, 1, 1)
    rows = [("r1", "a", "new", None), ("r1", "b", "error", "x" * 300), ("r2", "a", "unchanged", None), ("r3", "__run__", "error", "run crashed: boom"), ("r3", "q", "skipped_disallowed", None)]
    events = spark.createDataFrame([("fda", "s", r, k, d, e, day, x) for k, (r, d, e, x) in enumerate(rows)], "regulation string, source string, run_id string, event_id int, document_id string, event string, ts timestamp_ntz, error string")
    got = {r.run_id: r for r in runs.summaries(events).collect()}
    assert [got[r].status for r in ("r1", "r2", "r3")] == ["partial_failure", "success", "failed"] and [got[r].stop_reason for r in ("r1", "r2", "r3")] == ["completed", "completed", "hard_stop"]
    assert [tuple(e) for e in got["r1"].error_details] == [("b", "x" * 300)] and got["r2"].error_details == [] and [tuple(e) for e in got["r3"].error_details] == [("__run__", "run crashed: boom"), ("q", "")]
    assert [r.part for r in runs.error_list(events, most=1).filter("run_id = 'r3'").orderBy("part").collect()] == [0, 1]
    last = runs.latest_run(runs.counters(events), ["run_id"]).first().run_id
    assert last == "r1"  # all start at one time, and the first name counts


def test_run_files(spark, tmp_path):
    folder = tmp_path / "fda" / "s" / "_manifest"
    (folder / "runs").mkdir(parents=True)
    (folder / "runs" / "r1.json").write_text('{\n "run_id": "r1", "checked": 3, "new": 1, "updated": 1, "unchanged": 0, "errors": 1, "status": "partial_failure",\n "error_details": [{"document_id": "d", "error": "e"}], "skipped_already_known": 4, "stop_reason": "budget_reached"}')
    (folder / "estimate.json").write_text('{"regulation": "fda", "source": "s", "computed_at": "2024-01-01T00:00:00+00:00", "total_available": 5, "already_known": null, "remaining": null, "note": "n"}')
    (tmp_path / "fda" / "s" / "documents" / "a").mkdir(parents=True)
    (tmp_path / "fda" / "s" / "documents" / "a" / "current.meta.json").write_text('{"document_id": "a", "title": "T", "content_type": "text/html", "source_metadata": {"k": 1}, "version_history": [{"ts": "t", "hash": "h", "size_bytes": 2}]}')
    (tmp_path / "fda" / "s" / "documents" / "a" / "current.json").write_text("{}")
    r = tables.read_runs(spark, tables.manifest(str(tmp_path), "runs")).first()
    assert (r.checked, r.new, r.updated, r.errors, r.skipped_already_known, r.stop_reason, r.error_details[0].error) == (3, 1, 1, 1, 4, "budget_reached", "e")
    e = tables.read_estimates(spark, tables.manifest(str(tmp_path))).first()
    assert (e.computed_at, e.total_available, e.already_known) == ("2024-01-01T00:00:00+00:00", 5, None)
    (d,) = tables.read_documents(spark, str(tmp_path)).collect()
    assert (d.document_id, d.content_type, d.source_metadata, d.version_history[0].size_bytes) == ("a", "text/html", {"k": "1"}, 2)


def test_gaps_across_days(spark):
    rows = [("h", k, datetime(2024, 1, d, h)) for k, (d, h) in enumerate([(1, 22), (1, 23), (2, 1), (4, 0)])] + [("g", 9, datetime(2024, 1, 1))]
    got = requests.gaps(spark.createDataFrame(rows, "origin string, event_id int, ts timestamp_ntz"), ["origin"]).orderBy("origin", "event_id").collect()
    assert [r.gap_s for r in got] == [None, None, 3600.0, 7200.0, 47 * 3600.0]




def test_retry_after(spark):
    df = spark.createDataFrame([(1, "7"), (1, "500"), (3, "Wed, 21 Oct 2026 07:28:00 GMT"), (9, None)], "a int, r string")
    assert [r[0] for r in df.select(requests.expected_wait(F.col("a"), F.col("r"))).collect()] == [7.0, 120.0, 8.0, 120.0]


def test_callbacks(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in"))
    seen = []
    stream = streaming.source(spark, str(tmp_path / "in"), spark.range(1).schema)
    streaming.on_batch(stream, lambda df, n: seen.append((n, df.count())), str(tmp_path / "ck"))
    assert seen == [(0, 5)]
    held = spark.createDataFrame([("r", "s", "1")], "regulation string, source string, document_id string")
    listed = spark.createDataFrame([("r", "s", str(k), k) for k in range(4)], "regulation string, source string, document_id string, pos int")
    done = select.process(listed, held, lambda df: df.withColumn("outcome", F.lit("ok")), ["regulation", "source"], "pos", 2).orderBy("pos").collect()
    assert [r.label for r in done] == ["executed", "skipped_known", "executed", "not_reached"] and done[0].stop_reason == "budget_reached"


def test_few_files_in_a_folder(spark, tmp_path):
    rows = spark.range(0, 4000, numPartitions=16).select(
        F.lit("fda").alias("regulation"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"),
        F.timestamp_seconds(F.col("id") % 2 * 86400).alias("ts"), F.col("id").alias("event_id"),
    )
    tables.append_events(rows, str(tmp_path / "events"))
    folders = [p for p in (tmp_path / "events").glob("*/*/*") if p.is_dir()]
    assert len(folders) == 6
    assert all(len(list(p.glob("*.parquet"))) == 1 for p in folders)
    assert spark.read.parquet(str(tmp_path / "events")).count() == 4000
