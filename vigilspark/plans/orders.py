"""Queries over decision records, catalogues, registries and settings; they stand on the order, part, supplier and customer tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigilspark.functions import columns as fn
from vigilspark.operators import changes, select
from vigilspark.plans import specs
from vigilspark.plans.registry import query, read
from vigilspark.sources import tables

PAGE_ROWS, MAX_PAGES, MAX_RECORDS = 100, 25, 5000


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("record_id"), F.to_date("o_orderdate").alias("decision_date"), F.when(F.col("o_orderstatus") != "O", "Summary").alias("kind"),
        F.concat(F.lit("K"), F.lpad((F.col("o_orderkey") % 1000000).cast("string"), 6, "0")).alias("k_number"), F.col("o_custkey").alias("applicant"), F.col("o_orderpriority").alias("priority"), F.year("o_orderdate").alias("listing"),
    )


DEC = "dec AS (SELECT o_orderkey AS record_id, CAST(o_orderdate AS DATE) AS decision_date, CASE WHEN o_orderstatus <> 'O' THEN 'Summary' END AS kind, 'K' || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0') AS k_number, o_custkey AS applicant, o_orderpriority AS priority, year(o_orderdate) AS listing FROM orders)"
# pages are numbered within a year's listing, newest first
PAGED = f"{DEC}, pg AS (SELECT *, (row_number() OVER (PARTITION BY listing ORDER BY decision_date DESC, record_id) - 1) // {PAGE_ROWS} AS page FROM dec)"


# every other year's listing ends in an empty or missing page after four fifths of its pages
NUMBERS = f"""{PAGED}, pn AS (SELECT listing, page, count(*) AS n FROM pg GROUP BY ALL),
ends AS (SELECT listing, CASE WHEN listing % 2 = 0 THEN (max(page) + 1) * 4 // 5 END AS last FROM pn GROUP BY listing)"""


def paged(spark, sf) -> DataFrame:
    rows = select.numbered(decisions(spark, sf), ["listing"], "decision_date", [F.col("record_id")], "number")
    return rows.withColumn("page", F.floor(F.col("number") / PAGE_ROWS)).drop("number")


def ends(rows: DataFrame) -> DataFrame:
    """listing and last: the page at which a listing of these records is empty; null where it has no such page."""
    pages = F.ceil(F.count("*") / PAGE_ROWS)
    return rows.groupBy("listing").agg(F.when(F.col("listing") % 2 == 0, F.floor(pages * 4 / 5)).alias("last"))


@query(f"WITH {DEC} SELECT record_id, strftime(decision_date, '%Y-%m-%d') AS day FROM dec, (SELECT max(decision_date) AS today FROM dec) WHERE decision_date BETWEEN today - INTERVAL 30 DAY AND today")
def flt_01_lookback(spark, sf):
    rows = decisions(spark, sf)
    today = F.lit(rows.agg(F.max("decision_date")).first()[0])  # one value, so that the window reaches the scan
    return select.lookback(rows, "decision_date", today).select("record_id", F.date_format("decision_date", "yyyy-MM-dd").alias("day"))


@query("SELECT p_partkey, p_type FROM part WHERE contains(coalesce(p_type, ''), 'S')")
def flt_02_contains(spark, sf):
    return select.contains(read(spark, sf, "part"), "p_type", "S").select("p_partkey", "p_type")


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey = 7 AND s_name IS NOT NULL")
def flt_03_equality(spark, sf):
    return read(spark, sf, "supplier").filter((F.col("s_nationkey") == 7) & F.col("s_name").isNotNull()).select("s_suppkey", "s_name")


@query(f"WITH {PAGED} SELECT record_id, CAST(page AS BIGINT) AS page FROM pg WHERE page < {MAX_PAGES}")
def flt_06_page_cap(spark, sf):
    order = Window.partitionBy("listing").orderBy(F.desc("decision_date"), "record_id")
    first = decisions(spark, sf).withColumn("n", F.row_number().over(order)).filter(F.col("n") <= MAX_PAGES * PAGE_ROWS)  # the cap is the feature
    return first.select("record_id", F.floor((F.col("n") - 1) / PAGE_ROWS).alias("page"))


_RAW = "CASE o_orderkey % 6 WHEN 0 THEN concat(' /a/', o_orderkey, '/ ') WHEN 1 THEN '' WHEN 2 THEN concat('x/../', o_orderkey) WHEN 3 THEN '//' WHEN 4 THEN concat('b..', o_orderkey) ELSE concat(o_orderkey, '/..') END"


@query(f"SELECT o_orderkey, CASE WHEN t = '' OR regexp_matches(t, '(^|/)\\.\\.(/|$)') THEN NULL ELSE t END AS document_id FROM (SELECT o_orderkey, regexp_replace(trim({_RAW}), '^/+|/+$', '', 'g') AS t FROM orders)")
def flt_07_document_ids(spark, sf):
    return read(spark, sf, "orders").select("o_orderkey", select.clean_id(F.expr(_RAW)).alias("document_id"))


_EXPR = """CASE c_custkey % 7 WHEN 0 THEN 'all' WHEN 1 THEN concat('r', c_custkey % 3, ':all') WHEN 2 THEN concat('r', c_custkey % 3, ':s', c_custkey % 50)
WHEN 3 THEN concat('r1:s4,r0:all, ,r1:s', c_custkey % 40, ',r1:s4,') WHEN 4 THEN 'all,' WHEN 5 THEN concat('all,r0:s', c_custkey % 60, ',r5:all') ELSE 'r9:nothing,r2:all,bare' END"""
SELECTORS = f"""reg AS (SELECT 'r' || (s_suppkey % 3) AS regulation, 's' || s_suppkey AS source, s_suppkey % 4 <> 0 AND s_suppkey % 3 <> 2 AS enabled FROM supplier),
rq AS (SELECT c_custkey AS request_id, {_EXPR} AS expr FROM customer),
sp AS (SELECT request_id, trim(unnest(string_split(expr, ','))) AS item, CAST(unnest(range(len(string_split(expr, ',')))) AS INT) AS at_pos FROM rq), it AS (SELECT * FROM sp WHERE item <> ''),
known AS (SELECT 'all' AS item UNION SELECT regulation || ':all' FROM reg UNION SELECT regulation || ':' || source FROM reg),
nm AS (SELECT regulation, source, unnest(CASE WHEN enabled THEN ['all', regulation || ':all', regulation || ':' || source] ELSE [regulation || ':' || source] END) AS item FROM reg)"""


def selectors(spark, sf) -> tuple[DataFrame, DataFrame]:
    requests = read(spark, sf, "customer").select(F.col("c_custkey").alias("request_id"), F.expr(_EXPR).alias("expr"))
    key = F.col("s_suppkey")
    registry = read(spark, sf, "supplier").select(
        F.concat(F.lit("r"), key % 3).alias("regulation"), F.concat(F.lit("s"), key).alias("source"), ((key % 4 != 0) & (key % 3 != 2)).alias("enabled")
    )
    return select.selector_items(requests), registry


@query(f"""WITH {SELECTORS}, n AS (SELECT item, count(*) AS sources FROM nm GROUP BY item)
SELECT request_id, at_pos, it.item, known.item IS NULL AS unknown, coalesce(sources, 0) AS sources FROM it LEFT JOIN known USING (item) LEFT JOIN n ON n.item = it.item""")
def flt_08_source_selectors(spark, sf):
    """Each item of each request with the number of sources it stands for; the sources themselves are one table by item."""
    items, registry = selectors(spark, sf)
    sizes = select.item_sources(registry).groupBy("item").agg(F.count("source").alias("sources"))
    bad = select.unknown_items(items, registry).select("item").distinct().withColumn("_bad", F.lit(True))
    out = items.join(sizes, "item", "left").join(bad, "item", "left")
    return out.select("request_id", F.col("at").alias("at_pos"), "item", F.col("_bad").isNotNull().alias("unknown"), F.coalesce("sources", F.lit(0).cast("bigint")).alias("sources"))


@query(f"WITH {SELECTORS} SELECT item, regulation, source FROM nm")
def flt_08_item_sources(spark, sf):
    return select.item_sources(selectors(spark, sf)[1]).filter("source IS NOT NULL")


@query(f"WITH {SELECTORS} SELECT regulation, source, count(DISTINCT request_id) AS requests FROM it JOIN nm USING (item) GROUP BY ALL")
def set_01_union_of_lists(spark, sf):
    return select.requests_per_source(*selectors(spark, sf))


_FIELDS = {
    "product_code": "p_partkey", "device_name": "p_name", "device_class": "p_brand", "regulation_number": "p_size", "review_panel": None, "medical_specialty": "p_type",
    "medical_specialty_description": None, "submission_type_id": None, "definition": "p_retailprice",
}


def classifications(spark, sf) -> DataFrame:
    """The part table as product classification records, read by that source's chain."""
    raw = read(spark, sf, "part").select(F.col("p_partkey").alias("pos"), *((F.col(c) if c else F.lit(None)).cast("string").alias(n) for n, c in _FIELDS.items()))
    return specs.SPECS["fda:classification"].candidates(raw)


@query("SELECT CAST(p_partkey AS VARCHAR) AS document_id, p_name AS title FROM part WHERE p_brand = (SELECT min(p_brand) FROM part)")
def flt_10_metadata_key(spark, sf):
    rows, office = classifications(spark, sf), F.col("source_metadata")["device_class"]
    first = rows.agg(F.min(office).alias("office"))
    return rows.join(F.broadcast(first), office == F.col("office"), "left_semi").select("document_id", "title")  # one row on the other side


@query("""SELECT CAST(p_partkey AS VARCHAR) AS document_id, p_name AS title, 'https://api.fda.gov/device/classification.json?search=product_code:' || p_partkey AS url,
'definition,device_class,device_name,medical_specialty,medical_specialty_description,product_code,regulation_number,review_panel,submission_type_id' AS keys,
p_brand AS device_class, CAST(p_size AS VARCHAR) AS regulation_number, p_type AS medical_specialty FROM part""")
def prj_01_metadata(spark, sf):
    m = F.col("source_metadata")
    keys = F.array_join(F.array_sort(F.map_keys(m)), ",").alias("keys")
    return classifications(spark, sf).select("document_id", "title", "url", keys, *(m[c].alias(c) for c in ("device_class", "regulation_number", "medical_specialty")))


# clearances: orders as records, of which those with a Summary have a file
_CLEARANCE = """c AS (SELECT o_orderkey AS pos, CASE WHEN o_orderkey % 13 <> 0 THEN 'K' || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0') END AS k, 'Device ' || o_custkey AS d,
o_orderstatus <> 'O' AS s FROM orders), r AS (SELECT *, coalesce(k, d) AS id FROM c)"""


@query(f"""WITH {_CLEARANCE}, a AS (SELECT pos * 2 AS pos, id || '/metadata' AS document_id, d AS title, 'json' AS ext, NULL AS reason FROM r
UNION ALL SELECT pos * 2 + 1, id || '/summary', '510(k) Summary — ' || d, 'pdf', NULL FROM r WHERE s AND k IS NOT NULL
UNION ALL SELECT pos * 2 + 1, id || '/summary', '510(k) Summary — not applicable (' || id || ')', 'json', 'statement_or_summary != ''Summary''' FROM r WHERE NOT s)
SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY pos) = 1""")
def udf_01_source_chain(spark, sf):
    """A source's whole chain, from records to candidates."""
    none = F.lit(None).cast("string")
    raw = read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("pos"), F.when(F.col("o_orderkey") % 13 != 0, F.concat(F.lit("K"), F.lpad((F.col("o_orderkey") % 1000000).cast("string"), 6, "0"))).alias("k_number"),
        F.concat(F.lit("Device "), "o_custkey").alias("device_name"), F.when(F.col("o_orderstatus") != "O", "Summary").otherwise("Statement").alias("statement_or_summary"),
        *(none.alias(c) for c in ("applicant", "decision_date", "decision_code", "product_code", "clearance_type")),
    )
    return specs.SPECS["fda:clearances_510k"].candidates(raw).select("pos", "document_id", "title", "ext", F.col("source_metadata")["reason"].alias("reason"))


@query(f"WITH {DEC} SELECT record_id, k_number || '/' || k AS document_id FROM dec, (VALUES ('metadata'), ('summary')) v(k) WHERE k = 'metadata' OR kind = 'Summary'")
def prj_02_fan_out(spark, sf):
    kinds = F.when(F.col("kind") == "Summary", F.array(F.lit("metadata"), F.lit("summary"))).otherwise(F.array(F.lit("metadata")))
    return decisions(spark, sf).select("record_id", "k_number", F.explode(kinds).alias("k")).select("record_id", F.concat_ws("/", "k_number", "k").alias("document_id"))


# settings: each supplier is a source; some have settings of their own, -1 for no limit; a command overrides some
_OWN = {
    "enabled": "CASE WHEN s_suppkey % 17 = 0 THEN false END", "rps": "CASE WHEN s_suppkey % 2 = 0 THEN CAST(0.2 AS DOUBLE) END",
    "max_new": "CASE WHEN s_suppkey % 5 = 0 THEN -1 WHEN s_suppkey % 5 = 1 THEN 40 END", "recheck_after_days": "CASE WHEN s_suppkey % 3 = 0 THEN 14 END",
    "lookback_days": "CASE WHEN s_suppkey % 4 = 1 THEN 60 END",
}
_COMMAND = {
    "rps": "CASE WHEN s_suppkey % 19 = 0 THEN CAST(2.0 AS DOUBLE) END", "max_new": "CASE WHEN s_suppkey % 11 = 0 THEN 7 WHEN s_suppkey % 13 = 0 THEN -1 END",
    "recheck_after_days": "CASE WHEN s_suppkey % 9 = 0 THEN 0 END", "lookback_days": "CASE WHEN s_suppkey % 8 = 1 THEN 5 END", "time_budget_minutes": "CASE WHEN s_suppkey % 6 = 0 THEN 30 END",
}
_COLUMNS = ", ".join([*(f"{e} AS o_{n}" for n, e in _OWN.items()), *(f"{e} AS c_{n}" for n, e in _COMMAND.items())])
SET_SQL = f"""raw AS (SELECT 's' || s_suppkey AS source, s_suppkey % 7 = 0 AS bare, {_COLUMNS} FROM supplier),
eff AS (SELECT source, bare AS defaulted, CASE WHEN bare THEN true ELSE coalesce(o_enabled, true) END AS enabled,
CAST(coalesce(c_rps, CASE WHEN NOT bare THEN o_rps END, 0.5) AS DOUBLE) AS rps,
nullif(coalesce(c_max_new, CASE WHEN NOT bare THEN o_max_new END, 250), -1) AS max_new, coalesce(c_recheck_after_days, CASE WHEN NOT bare THEN o_recheck_after_days END) AS recheck_after_days,
coalesce(c_lookback_days, CASE WHEN NOT bare THEN o_lookback_days END) AS lookback_days, c_time_budget_minutes AS time_budget_minutes FROM raw)"""


def settings(spark, sf, commands: bool = True, whole: dict | None = None) -> DataFrame:
    s = read(spark, sf, "supplier").withColumns({"regulation": F.lit("r"), "source": F.concat(F.lit("s"), "s_suppkey")})
    own = s.filter("s_suppkey % 7 <> 0").select("regulation", "source", *(F.expr(e).alias(n) for n, e in _OWN.items()))
    over = s.select("regulation", "source", *(F.expr(e).alias(n) for n, e in _COMMAND.items())) if commands else None
    return specs.effective(s, own, over, whole)


@query(f"WITH {SET_SQL} SELECT source, enabled, rps, max_new, recheck_after_days, lookback_days, time_budget_minutes FROM eff")
def prj_04_effective_settings(spark, sf):
    """Command, then own, then global values, of all suppliers as sources."""
    return settings(spark, sf, whole={"rps": 0.5, "max_new": 250}).drop("regulation")


@query("""SELECT 's' || s_suppkey AS source, true AS enabled, CAST(1.0 AS DOUBLE) AS rps, 1000 AS max_new, CAST(NULL AS INT) AS recheck_after_days, CAST(NULL AS INT) AS lookback_days
FROM supplier WHERE s_suppkey % 7 = 0""")
def prj_05_default_settings(spark, sf):
    """Sources that no settings mention."""
    bare = read(spark, sf, "supplier").filter("s_suppkey % 7 = 0").select(F.concat(F.lit("s"), "s_suppkey").alias("source"))
    return settings(spark, sf, commands=False).join(bare, "source", "left_semi").select("source", "enabled", "rps", "max_new", "recheck_after_days", "lookback_days")


@query(f"""WITH {SET_SQL}, e AS (SELECT 's' || l_suppkey AS source, CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE count(*) END AS remaining FROM lineitem GROUP BY l_suppkey),
j AS (SELECT e.source, remaining, rps, CASE WHEN remaining IS NULL THEN NULL WHEN max_new IS NULL THEN remaining ELSE least(remaining, max_new) END AS this_run FROM e JOIN eff USING (source))
SELECT source, remaining, this_run, round(this_run / rps, 3)::DOUBLE AS eta_s FROM j""")
def agg_08_preview(spark, sf):
    totals = read(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"))
    totals = totals.select(F.concat(F.lit("s"), "l_suppkey").alias("source"), F.when(F.col("l_suppkey") % 9 != 0, F.col("n")).alias("remaining"))
    both = totals.join(settings(spark, sf, whole={"rps": 0.5, "max_new": 250}), "source")
    return specs.preview(both).select("source", "remaining", "this_run", F.round("eta_s", 3).alias("eta_s"))


@query(f"WITH {NUMBERS} SELECT listing, CAST(page AS BIGINT) AS page, n AS rows FROM pn JOIN ends USING (listing) WHERE last IS NULL OR page < last")
def win_03_until_empty(spark, sf):
    counts = paged(spark, sf).groupBy("listing", "page").agg(F.count("*").alias("n")).join(ends(decisions(spark, sf)), "listing")
    rows = counts.select("listing", "page", F.when(F.col("page") == F.col("last"), 0).otherwise(F.col("n")).alias("rows"))
    return select.until_empty(rows, ["listing"], "page", "rows")


@query(f"WITH {DEC} SELECT record_id, k_number, strftime(decision_date, '%Y-%m-%d') AS day FROM dec ORDER BY decision_date DESC, record_id LIMIT 5000")
def win_07_newest_first(spark, sf):
    newest = decisions(spark, sf).orderBy(F.desc("decision_date"), "record_id").limit(5000)  # the cap of a listing is the feature
    return newest.select("record_id", "k_number", F.date_format("decision_date", "yyyy-MM-dd").alias("day"))


@query(f"WITH {PAGED} SELECT listing, CAST(max(page) + 1 AS BIGINT) AS pages_touched FROM pg WHERE record_id % 3 = 0 GROUP BY listing")
def win_08_pages_touched(spark, sf):
    return paged(spark, sf).filter("record_id % 3 = 0").groupBy("listing").agg((F.max("page") + 1).alias("pages_touched"))


def envelopes(spark, sf) -> DataFrame:
    """A listing's pages, as stored: JSON envelopes of at most 100 records; the page that ends a listing is empty, or missing in years that three divides."""
    row = F.array_sort(F.collect_list(F.struct("at", "record_id", "priority")))
    rows = select.numbered(decisions(spark, sf), ["listing"], "decision_date", [F.col("record_id")], "number")
    rows = rows.withColumn("page", F.floor(F.col("number") / PAGE_ROWS)).withColumn("at", F.col("number") % PAGE_ROWS)
    pages = rows.groupBy("listing", "page").agg(row.alias("results")).join(ends(decisions(spark, sf)), "listing")
    last = F.coalesce(F.col("page") == F.col("last"), F.lit(False))
    results = F.when(last, F.array()).otherwise(F.transform("results", lambda r: F.struct(r["record_id"].alias("record_id"), r["priority"].alias("priority"))))
    body = F.when(~(last & (F.col("listing") % 3 == 0)), F.to_json(F.struct(results.alias("results"))))
    root = tables.scratch(spark, "listing")
    pages.select("listing", "page", body.alias("body")).write.parquet(root)
    return spark.read.parquet(root)


@query(f"WITH {NUMBERS} SELECT listing, record_id, priority FROM pg JOIN ends USING (listing) WHERE last IS NULL OR page < last")
def src_07_unnest_pages(spark, sf):
    found = select.unnest_pages(envelopes(spark, sf), ["listing"], "page", "body", "record_id:bigint,priority:string")
    return found.select("listing", "record_id", "priority")


@query(f"""WITH {NUMBERS}, k AS (SELECT *, row_number() OVER (PARTITION BY listing ORDER BY decision_date DESC, record_id) AS n FROM pg)
SELECT listing, record_id, n <= {MAX_RECORDS} AS within FROM k JOIN ends USING (listing) WHERE last IS NULL OR page < last""")
def src_07_max_records(spark, sf):
    """Every record of each listing, and whether it is within what a reader of at most so many records gets."""
    found = select.unnest_pages(envelopes(spark, sf), ["listing"], "page", "body", "record_id:bigint,priority:string", MAX_RECORDS, mark="within")
    return found.select("listing", "record_id", "within")


@query(f"""WITH {DEC} SELECT record_id, k_number || '/summary' AS document_id, sha256('{changes.SENTINEL}') AS content_hash, 'not applicable (' || k_number || ')' AS title,
'json' AS ext, 'true' AS not_applicable, 'no summary' AS reason, k_number FROM dec WHERE kind IS NULL""")
def cdc_08_settled_miss(spark, sf):
    rows = decisions(spark, sf).filter("kind IS NULL").withColumn("document_id", F.concat("k_number", F.lit("/summary")))
    misses = changes.not_applicable(rows, F.concat(F.lit("not applicable ("), "k_number", F.lit(")")), F.lit("no summary"), "k_number")
    m = F.col("source_metadata")
    told = [m[c].alias(c) for c in ("not_applicable", "reason", "k_number")]
    return changes.hashed(misses).select("record_id", "document_id", "content_hash", "title", "ext", *told)


@query("""SELECT p_partkey, sha256('{"p_brand":"' || p_brand || '","p_name":"' || p_name || '","p_type":"' || p_type || '"}') AS content_hash FROM part""")
def cdc_07_canonical(spark, sf):
    part = read(spark, sf, "part")
    return part.select("p_partkey", F.sha2(changes.canonical(part, ["p_type", "p_name", "p_brand"]), 256).alias("content_hash"))


@query("""SELECT p_partkey, sha256('{"codes":{"10":"' || p_brand || '","9":"' || p_type || '"},"openfda":{"brand":"' || p_brand || '","size":{"max":' || p_size || ',"min":1}},"parts":[{"a":"' || p_name || '","b":null},{"a":"' || p_type || '","b":null}],"raw":{"name":"' || p_name || '","zone":' || p_size || '}}') AS content_hash FROM part""")
def cdc_07_nested(spark, sf):
    """Records with structs, arrays, maps and a VARIANT, whose fields and keys come in no order."""
    size = F.struct(F.lit(1).alias("min"), F.col("p_size").alias("max"))
    entry = lambda c: F.struct(F.lit(None).cast("string").alias("b"), F.col(c).alias("a"))
    part = read(spark, sf, "part").select(
        "p_partkey", F.struct(size.alias("size"), F.col("p_brand").alias("brand")).alias("openfda"), F.array(entry("p_name"), entry("p_type")).alias("parts"),
        F.create_map(F.lit("9"), F.col("p_type"), F.lit("10"), F.col("p_brand")).alias("codes"), F.parse_json(F.format_string('{"zone": %d, "name": "%s"}', "p_size", "p_name")).alias("raw"),
    )
    return part.select("p_partkey", F.sha2(changes.canonical(part, ["openfda", "parts", "codes", "raw"]), 256).alias("content_hash"))


REGISTRY = "old AS (SELECT s_suppkey AS source, s_name AS label, CAST(s_nationkey AS BIGINT) AS lookback FROM supplier WHERE s_suppkey % 5 <> 0), new AS (SELECT s_suppkey AS source, s_name AS label, CAST(CASE WHEN s_suppkey % 4 = 0 THEN s_nationkey + 1 ELSE s_nationkey END AS BIGINT) AS lookback FROM supplier WHERE s_suppkey % 3 <> 0)"


def _registries(spark, sf):
    s = read(spark, sf, "supplier")
    old = s.filter("s_suppkey % 5 <> 0").select(F.col("s_suppkey").alias("source"), F.col("s_name").alias("label"), F.col("s_nationkey").cast("bigint").alias("lookback"))
    new = s.filter("s_suppkey % 3 <> 0").select(F.col("s_suppkey").alias("source"), F.col("s_name").alias("label"), F.expr("CAST(CASE WHEN s_suppkey % 4 = 0 THEN s_nationkey + 1 ELSE s_nationkey END AS BIGINT)").alias("lookback"))
    return old, new


@query(f"WITH {REGISTRY} SELECT source, new.label, new.lookback, CASE WHEN old.source IS NULL THEN 'insert' WHEN new.source IS NULL THEN 'delete' WHEN old.label IS NOT DISTINCT FROM new.label AND old.lookback IS NOT DISTINCT FROM new.lookback THEN 'unchanged' ELSE 'update' END AS action FROM old FULL OUTER JOIN new USING (source)")
def cdc_10_registry_diff(spark, sf):
    return changes.registry_diff(*_registries(spark, sf), ["source"], ["label", "lookback"])


@query(f"WITH {REGISTRY} SELECT CASE WHEN old.source IS NULL THEN 'insert' WHEN new.source IS NULL THEN 'delete' WHEN old.lookback = new.lookback THEN 'unchanged' ELSE 'update' END AS action, count(*) AS sources FROM old FULL OUTER JOIN new USING (source) GROUP BY ALL")
def join_06_registry_actions(spark, sf):
    return changes.registry_diff(*_registries(spark, sf), ["source"], ["label", "lookback"]).groupBy("action").agg(F.count("*").alias("sources"))


@query("SELECT l_orderkey, l_linenumber, l_partkey AS product_code, p_name AS device_name, p_type AS device_class FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_partkey % 10 <> 0) ON l_partkey = p_partkey")
def join_04_classification(spark, sf):
    """Decisions with their classification. The catalogue grows with the data, so Spark chooses the join by its size."""
    known = read(spark, sf, "part").filter("p_partkey % 10 <> 0").select(F.col("p_partkey").alias("product_code"), F.col("p_name").alias("device_name"), F.col("p_type").alias("device_class"))
    rows = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("product_code"))
    return rows.join(known, "product_code", "left")


@query("SELECT o_orderkey, 'P' || o_custkey || CASE WHEN o_orderkey % 3 = 0 THEN 'S' || lpad(CAST(o_orderkey % 100 AS VARCHAR), 3, '0') ELSE '' END AS decision_id FROM orders")
def fn_10_decision_ids(spark, sf):
    supplement = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("S"), F.lpad((F.col("o_orderkey") % 100).cast("string"), 3, "0")))
    return read(spark, sf, "orders").select("o_orderkey", fn.decision_id(F.concat(F.lit("P"), "o_custkey"), supplement).alias("decision_id"))


@query(f"WITH {DEC} SELECT record_id, CASE WHEN record_id % 10 <> 0 THEN 'https://files.example.gov/pdf' || k_number[2:3] || '/' || k_number || '.pdf' END AS url FROM dec")
def fn_11_pdf_urls(spark, sf):
    number = F.when(F.col("record_id") % 10 == 0, F.concat(F.lit("KX"), "k_number")).otherwise(F.col("k_number"))
    return decisions(spark, sf).select("record_id", fn.pdf_url("https://files.example.gov", number).alias("url"))


@query("SELECT o_orderkey, coalesce(nullif(CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END, ''), CASE WHEN o_orderkey % 3 = 0 THEN 'c' || o_custkey END, 'unknown') AS record_id FROM orders")
def fn_12_record_ids(spark, sf):
    first = F.when(F.col("o_orderkey") % 2 == 0, "").otherwise(F.col("o_orderkey").cast("string"))
    return read(spark, sf, "orders").select("o_orderkey", fn.first_of(first, F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("c"), "o_custkey")), last="unknown").alias("record_id"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'https://data.example.gov/all' ELSE 'https://data.example.gov/item?code=' || p_partkey END AS url, coalesce(nullif(CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_name END, ''), p_brand) AS title FROM part")
def fn_24_fn_25_url_and_title(spark, sf):
    own = F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.format_string("https://data.example.gov/item?code=%d", "p_partkey"))
    title = F.when(F.col("p_partkey") % 4 == 0, "").otherwise(F.col("p_name"))
    return read(spark, sf, "part").select("p_partkey", fn.first_of(own, last="https://data.example.gov/all").alias("url"), fn.first_of(title, F.col("p_brand")).alias("title"))
