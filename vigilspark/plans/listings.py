"""Source chains of the record listings, over whole tables that stand for the listings; many ids come more than once."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigilspark.plans import pages, specs
from vigilspark.plans.pages import NAV
from vigilspark.plans.registry import query, read

_FIRST = "QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY pos) = 1"


def _raw(spark, sf, table: str, columns: dict[str, str]):
    """Records of a listing: expressions that Spark and DuckDB read alike, under their names."""
    return read(spark, sf, table).select(*(F.expr(e).alias(n) for n, e in columns.items()))


def _sql(table: str, columns: dict[str, str]) -> str:
    return f"raw AS (SELECT {', '.join(f'{e} AS "{n}"' for n, e in columns.items())} FROM {table})"


_RECALL = {
    "pos": "o_orderkey", "recall_number": "CASE WHEN o_orderkey % 10 = 0 THEN '' WHEN o_orderkey % 10 > 1 THEN concat('Z-', o_custkey) END",
    "event_id": "CASE WHEN o_orderkey % 20 <> 0 THEN concat('e', o_custkey) END", "product_description": "concat('Product ', o_orderkey)", "classification": "o_orderpriority",
    "status": "o_orderstatus", "recalling_firm": "CASE WHEN o_orderkey % 3 > 0 THEN concat('Firm ', o_custkey) END", "report_date": "CAST(o_orderkey AS STRING)", "product_code": "'ABC'",
}
_TOLD = " || ',' || ".join(f"""'"{n}":' || coalesce('"' || {n} || '"', 'null')""" for n in sorted(_RECALL) if n != "pos")


@query(f"""WITH {_sql('orders', _RECALL)}, i AS (SELECT *, coalesce(nullif(recall_number, ''), nullif(event_id, ''), 'unknown') AS document_id FROM raw)
SELECT document_id, pos, product_description AS title, 'https://api.fda.gov/device/enforcement.json?search=recall_number:' || document_id AS url, recalling_firm AS firm,
sha256('{{' || {_TOLD} || '}}') AS content FROM i {_FIRST}""")
def spec_fda_recalls(spark, sf):
    """Recalls under their number, else their event's; of one number the first record is kept, whose own JSON is the content."""
    rows = specs.SPECS["fda:recalls"].candidates(_raw(spark, sf, "orders", _RECALL))
    return rows.select("document_id", "pos", "title", "url", F.col("source_metadata")["firm_name"].alias("firm"), F.sha2(F.col("content").cast("binary"), 256).alias("content"))


_DECISION = {
    "pos": "o_orderkey", "pma_number": "CASE WHEN o_orderkey % 9 = 0 THEN concat('PX', o_custkey) WHEN o_orderkey % 9 < 8 THEN concat('P24', o_custkey) END",
    "supplement_number": "CASE WHEN o_orderkey % 2 = 0 THEN concat('S00', o_orderkey % 8) END", "trade_name": "CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderkey % 5 > 1 THEN concat('Trade ', o_orderkey) END",
    "generic_name": "concat('Generic ', o_custkey)", **dict.fromkeys(("applicant", "product_code", "decision_date", "decision_code", "supplement_type", "supplement_reason", "advisory_committee"), "o_orderpriority"),
}


@query(f"""WITH {_sql('orders', _DECISION)}, d AS (SELECT *, coalesce(pma_number, 'unknown') || coalesce(supplement_number, '') AS d FROM raw),
a AS (SELECT d || '/metadata' AS document_id, pos * 2 AS pos, coalesce(nullif(trade_name, ''), nullif(generic_name, '')) AS title,
'https://api.fda.gov/device/pma.json?search=pma_number:' || coalesce(pma_number, 'None') AS url, 'json' AS ext, applicant FROM d
UNION ALL SELECT d || '/order', pos * 2 + 1, 'PMA Approval Order — ' || coalesce(trade_name, d), 'https://www.accessdata.fda.gov/cdrh_docs/pdf24/' || d || 'A.pdf', 'pdf', NULL FROM d WHERE starts_with(pma_number, 'P24'))
SELECT * FROM a {_FIRST}""")
def spec_fda_pma(spark, sf):
    """Two documents a decision: its record, and its order where the number tells a place."""
    rows = specs.SPECS["fda:pma"].candidates(_raw(spark, sf, "orders", _DECISION))
    return rows.select("document_id", "pos", "title", "url", "ext", F.col("source_metadata")["applicant"].alias("applicant"))


_LICENCE = {"pos": "p_partkey", "licence_name": "p_name", "original_licence_no": "CASE WHEN p_partkey % 50 > 0 THEN CAST(floor(p_partkey / 3) AS INT) END", "company_id": "p_size"}
_LICENCE |= {n: "p_brand" for n in specs.LICENCE if n not in _LICENCE}


@query(f"""WITH {_sql('part', _LICENCE)}, i AS (SELECT *, coalesce(CAST(original_licence_no AS VARCHAR), 'unknown') AS document_id FROM raw)
SELECT document_id, pos, licence_name AS title, 'https://health-products.canada.ca/api/medical-devices/licence/?id=' || document_id || '&type=json&lang=en' AS url,
CAST(company_id AS VARCHAR) AS company, licence_status AS status FROM i {_FIRST}""")
def spec_ca_mdall(spark, sf):
    rows = specs.SPECS["ca:mdall"].candidates(_raw(spark, sf, "part", _LICENCE))
    m = F.col("source_metadata")
    return rows.select("document_id", "pos", "title", "url", m["company_id"].alias("company"), m["licence_status"].alias("status"))


_CA_RECALL = {
    "pos": "c_custkey", "NID": "CASE WHEN c_custkey % 11 > 0 THEN CAST(floor(c_custkey / 3) AS INT) END", "Title": "c_name", "URL": "CASE WHEN c_custkey % 4 = 0 THEN '' ELSE concat('https://r.example/', c_custkey) END",
    "Organization": "CASE WHEN c_custkey % 5 = 0 THEN 'Food' ELSE 'Medical devices' END", "Product": "c_mktsegment", "Issue": "c_mktsegment", "Category": "c_mktsegment",
    "Recall class": "concat('Type ', c_custkey % 3)", "Last updated": "CAST(c_custkey AS STRING)", "Archived": "'0'",
}


@query(f"""WITH {_sql('customer', _CA_RECALL)}, k AS (SELECT *, CAST("NID" AS VARCHAR) AS document_id FROM raw WHERE "Organization" = 'Medical devices' AND "NID" IS NOT NULL)
SELECT document_id, min(pos) AS pos, arg_max("Title", pos) AS title, coalesce(nullif(arg_max("URL", pos), ''), 'https://recalls-rappels.canada.ca/sites/default/files/opendata-donneesouvertes/HCRSAMOpenData.json') AS url,
arg_max("Recall class", pos) AS recall_class, arg_max("Last updated", pos) AS last_updated FROM k GROUP BY document_id""")
def spec_ca_recalls(spark, sf):
    """Recalls of medical devices; of one number, the first place and the last record's values."""
    rows = specs.SPECS["ca:recalls"].candidates(_raw(spark, sf, "customer", _CA_RECALL))
    m = F.col("source_metadata")
    return rows.select("document_id", "pos", "title", "url", m["recall_class"].alias("recall_class"), m["last_updated"].alias("last_updated"))


_GUIDANCE = {
    "pos": "o_orderkey", "field_regulated_product_field": "CASE WHEN o_orderkey % 4 = 0 THEN 'Drugs' ELSE 'Biologics, Medical Devices' END",
    "title": "CASE WHEN o_orderkey % 7 = 0 THEN '<a>none</a>' WHEN o_orderkey % 7 = 1 THEN concat('<a href=\"https://o.gov/', o_custkey, '\">Out &amp; about ', o_orderkey, '</a>') ELSE concat('<a href=\"/media/', o_custkey, '/\">Guide <i> ', o_orderkey, '</i></a>') END",
    "field_docket_number": "CASE WHEN o_orderkey % 3 = 0 THEN concat('<a href=\"/d\">FDA-', o_orderkey, '</a>') END", "open-comment": "CASE WHEN o_orderkey % 2 = 0 THEN ' No ' ELSE ' ' END",
    "field_issuing_office_taxonomy": "'Center for A &amp; B'", "field_center": "''", **dict.fromkeys(("field_issue_datetime", "field_final_guidance_1", "field_communication_type"), "o_orderpriority"),
}


@query(f"""WITH {_sql('orders', _GUIDANCE)}, k AS (SELECT pos, regexp_extract(title, 'href="([^"]*)"', 1) AS href, CASE WHEN contains(title, 'Out') THEN 'Out & about ' ELSE 'Guide' END || pos AS text, "open-comment" AS o,
CASE WHEN pos % 3 = 0 THEN 'FDA-' || pos END AS docket FROM raw WHERE field_regulated_product_field <> 'Drugs' AND contains(title, 'href')),
i AS (SELECT *, regexp_extract(href, '([^/]*)/*$', 1) AS document_id FROM k), l AS (SELECT document_id, min(pos) AS pos, max(pos) AS last FROM i GROUP BY document_id)
SELECT document_id, l.pos, text AS title, CASE WHEN starts_with(href, 'http') THEN href ELSE 'https://www.fda.gov' || href END AS url, 'Center for A & B' AS office, docket, nullif(trim(o), '') AS open
FROM l JOIN i USING (document_id) WHERE i.pos = last""")
def spec_fda_guidance(spark, sf):
    """Guidance on medical devices, under the last segment of each title's link."""
    rows = specs.SPECS["fda:guidance"].candidates(_raw(spark, sf, "orders", _GUIDANCE))
    m = F.col("source_metadata")
    return rows.select("document_id", "pos", "title", "url", m["issuing_office"].alias("office"), m["docket_number"].alias("docket"), m["open_for_comment"].alias("open"))


_HDE = "https://www.fda.gov/medical-devices/hde-approvals/listing-cdrh-humanitarian-device-exemptions"


@query(f"""WITH {NAV}, h AS (SELECT page_id * 1000000000 + pos AS pos, {pages._NUMBER} AS n, 'Dev ice ' || text AS name, pos % 3 <> 2 AND href <> '' AS linked, CASE WHEN pos % 3 = 2 THEN {pages._NUMBER} ELSE '1999' END AS day FROM lk WHERE pos % 5 <> 4),
a AS (SELECT n || '/metadata' AS document_id, pos * 2 AS pos, name AS title, '{_HDE}' AS url, 'json' AS ext, day, NULL AS reason FROM h
UNION ALL SELECT n || '/order', pos * 2 + 1, CASE WHEN linked THEN 'HDE Approval Order — ' || name ELSE 'HDE Approval Order — not applicable (' || n || ')' END,
CASE WHEN linked THEN 'https://www.accessdata.fda.gov/cdrh_docs/pdf' || n[2:3] || '/' || n || 'A.pdf' ELSE '{_HDE}' END, CASE WHEN linked THEN 'pdf' ELSE 'json' END, NULL, CASE WHEN NOT linked THEN 'no detail page listed' END FROM h)
SELECT * FROM a {_FIRST}""")
def spec_fda_hde(spark, sf):
    """Approvals of all pages: the record, and the order or the note that there is none."""
    rows = specs.SPECS["fda:hde"].candidates(pages.approvals_listing(spark, sf))
    m = F.col("source_metadata")
    return rows.select("document_id", "pos", "title", "url", "ext", m["approval_date"].alias("day"), m["reason"].alias("reason"))


@query(f"""WITH {NAV}, r AS (SELECT page_id * 1000000000 + pos + 1 AS pos, CASE WHEN starts_with(href, 'http') THEN href ELSE 'https://health.ec.europa.eu' || href END AS url, CASE WHEN pos % 2 = 0 THEN 'R' || pos END AS reference, text FROM lk WHERE href <> ''),
k AS (SELECT *, sha1(url)[1:16] AS document_id, lower(regexp_extract(url, '\\.([A-Za-z0-9]+)$', 1)) AS e FROM r), l AS (SELECT document_id, min(pos) AS pos, max(pos) AS last FROM k GROUP BY document_id)
SELECT document_id, l.pos, coalesce(nullif(text, ''), reference, document_id) AS title, url, CASE WHEN e IN ('pdf', 'doc', 'docx', 'xlsx') THEN e ELSE 'html' END AS ext, reference, 'TopicA' AS category FROM l JOIN k USING (document_id) WHERE k.pos = last""")
def spec_eu_mdcg_guidance(spark, sf):
    """Classed tables of all pages, under a hash of each row's link."""
    rows = specs.SPECS["eu:mdcg_guidance"].candidates(pages.classed_listing(spark, sf))
    m = F.col("source_metadata")
    return rows.select("document_id", "pos", "title", "url", "ext", m["reference"].alias("reference"), m["category"].alias("category"))


@query(f"""WITH {NAV}, r AS (SELECT page_id, 0 AS pos, '/in/' || page_id || '?a=1&b=2' AS href, 'Tom &J' || page_id AS text FROM pages WHERE page_id % 5 <> 4 UNION ALL SELECT page_id, pos + 1, href, text FROM lk WHERE page_id % 5 <> 4),
u AS (SELECT page_id * 1000000000 + pos AS pos, text, CASE WHEN starts_with(href, 'http') THEN href ELSE 'https://www.canada.ca' || href END AS url FROM r WHERE href <> '' AND text <> ''),
p AS (SELECT *, regexp_extract(regexp_replace(url, '[?#].*$', ''), '^[A-Za-z]+://[^/]*(.*)$', 1) AS path, regexp_extract(url, '^[^?#]*\\?([^#]*)', 1) AS q FROM u),
k AS (SELECT *, coalesce(CASE WHEN q = '' THEN nullif(regexp_extract(regexp_replace(path, ';[^/]*$', ''), '([^/]*)/*$', 1), '') END, sha1(url)[1:16]) AS document_id FROM p WHERE NOT (path IN ('', '/') AND q = '')),
l AS (SELECT document_id, min(pos) AS pos, max(pos) AS last FROM k GROUP BY document_id) SELECT document_id, l.pos, text AS title, url FROM l JOIN k USING (document_id) WHERE k.pos = last""")
def spec_ca_guidance(spark, sf):
    """Links of the main regions of all pages, under the last segment of their path or a hash."""
    return specs.SPECS["ca:guidance"].candidates(pages.main_pages(spark, sf)).select("document_id", "pos", "title", "url")


@query(f"""WITH v AS (SELECT '02017R074' || CASE WHEN page_id % 4 = 3 THEN '6' ELSE '5' END || '-2' || {pages._VERSION.format('VARCHAR')} AS v FROM pages), l AS (SELECT v[9:10] AS act, max(v) AS v FROM v GROUP BY 1)
SELECT 'eu' AS regulation, CASE act WHEN '45' THEN 'mdr' ELSE 'ivdr' END AS document_id, 0::BIGINT AS pos, CASE act WHEN '45' THEN 'Regulation (EU) 2017/745 (MDR) — consolidated text' ELSE 'Regulation (EU) 2017/746 (IVDR) — consolidated text' END AS title,
'https://eur-lex.europa.eu/legal-content/EN/TXT/?uri=CELEX:' || v AS url, 'eur_lex' AS source, v AS consolidated FROM l""")
def spec_eu_acts(spark, sf):
    """Both acts, whose newest version some page of all links to."""
    act = F.when(F.col("page_id") % 4 == 3, "6").otherwise("5")
    link = F.concat(F.lit("<p><a href='/legal-content/EN/ALL/?uri=CELEX:02017R074"), act, F.lit("-2"), F.expr(pages._VERSION.format("STRING")), F.lit("&x'>version</a></p>"))
    made = pages.pages(spark, sf).select("page_id", F.concat(link, "html").alias("html"))
    both = specs.SPECS["eu:mdr"].candidates(made).unionByName(specs.SPECS["eu:ivdr"].candidates(made))
    m = F.col("source_metadata")
    return both.select("regulation", "document_id", "pos", "title", "url", m["source"].alias("source"), m["consolidated_celex"].alias("consolidated"))
