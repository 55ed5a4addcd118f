"""Source specifications and settings.

A specification is a chain from a source's raw records or pages to candidates: listing, filter, rows, ids. Its
steps are the library's operators; its fixed values are the ids, names and keys that consumers read. A candidate
has regulation, source, document_id, pos, title, url, ext, content_type, source_metadata and content; content is
null where the document must still be fetched. New sources are added with register().
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilspark.functions import columns as fn
from vigilspark.operators import changes, extract, select

#: What holds where neither a command nor a source's settings nor the global ones say otherwise; -1 means no limit.
DEFAULTS = {"rps": 1.0, "max_new": 1000, "lookback_days": 30}
#: Hosts of the sources.
FDA, OPEN_FDA, FILES = "https://www.fda.gov", "https://api.fda.gov/device", "https://www.accessdata.fda.gov/cdrh_docs"
EU, CANADA, LICENCES = "https://health.ec.europa.eu", "https://www.canada.ca", "https://health-products.canada.ca/api/medical-devices/licence/"
RECALL_DATA = "https://recalls-rappels.canada.ca/sites/default/files/opendata-donneesouvertes/HCRSAMOpenData.json"
HDE_LISTING = f"{FDA}/medical-devices/hde-approvals/listing-cdrh-humanitarian-device-exemptions"
#: Titles, reasons and errors as they are stored.
CLEARANCE_FILE, CLEARANCE_NONE, CLEARANCE_REASON = "510(k) Summary — ", "510(k) Summary — not applicable (", "statement_or_summary != 'Summary'"
PMA_FILE, HDE_FILE, HDE_NONE, HDE_REASON = "PMA Approval Order — ", "HDE Approval Order — ", "HDE Approval Order — not applicable (", "no detail page listed"
NO_PLACE = "cannot derive PDF path from "
FIELDS = ["regulation", "source", "document_id", "pos", "title", "url", "ext", "content_type", "source_metadata", "content"]


@dataclass(frozen=True)
class SourceSpec:
    """read: from the source's raw frame to rows of document_id, pos, title, url, ext, content_type, source_metadata, content.

    keep: whose values an id has that comes twice. A source that works through its records one by one saves the
    first and skips the others as held; one that first lists all its links under their ids has the last.
    """

    regulation: str
    name: str
    read: Callable[[DataFrame], DataFrame]
    keep: str = "first"

    def candidates(self, raw: DataFrame) -> DataFrame:
        """Candidates in order of pos, one row an id: at its first place, with the values of its first or last row (keep). Rows without an id are left out."""
        rows = once(self.read(raw).filter("document_id IS NOT NULL AND document_id <> ''"), self.keep)
        return rows.select(F.lit(self.regulation).alias("regulation"), F.lit(self.name).alias("source"), *FIELDS[2:])


SPECS: dict[str, SourceSpec] = {}


def register(spec: SourceSpec) -> SourceSpec:
    SPECS[f"{spec.regulation}:{spec.name}"] = spec
    return spec


def source(regulation: str, name: str, keep: str = "first"):
    """Registers a function as a source's chain."""

    def add(read: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        register(SourceSpec(regulation, name, read, keep))
        return read

    return add


def metadata(**pairs: Column) -> Column:
    return F.create_map(*(x for key, value in pairs.items() for x in (F.lit(key), value.cast("string"))))


def plucked(*names: str) -> Column:
    """Metadata of columns under their own names."""
    return metadata(**{n: F.col(n) for n in names})


def rows_of(df: DataFrame, document_id: Column, title: Column, url: Column, ext: Column | str, content_type: Column | str, meta: Column, content: Column | None = None, pos: Column | None = None) -> DataFrame:
    column = lambda c: F.lit(c) if isinstance(c, str) else c
    return df.select(
        document_id.alias("document_id"), (F.lit(0) if pos is None else pos).cast("bigint").alias("pos"), title.alias("title"), url.alias("url"),
        column(ext).alias("ext"), column(content_type).alias("content_type"), meta.alias("source_metadata"),
        (F.lit(None) if content is None else content).cast("string").alias("content"),
    )


def placed(page: str, row: Column) -> Column:
    """A row's place in a listing of one or several pages."""
    return F.col(page).cast("bigint") * 1_000_000_000 + row


def once(rows: DataFrame, keep: str) -> DataFrame:
    """One row an id. A compact file of many records, or pages of many rows, may be one task, which would sort all its wide rows by id: they are dealt out first, by id and place, so that a frequent id is many tasks' work."""
    values = [c for c in FIELDS[2:] if c not in ("document_id", "pos")]
    rows = rows.repartition("document_id", "pos")
    return (select.first_of_key if keep == "first" else select.first_place_last_value)(rows, ["document_id"], "pos", values)


def inline(df: DataFrame) -> Column:
    """A record's own JSON as content."""
    return changes.canonical(df, [c for c in df.columns if c != "pos"])


def text(column: str) -> Column:
    return fn.blank_to_null(F.col(column))


def unescaped(column: str) -> Column:
    return fn.unescaped(F.col(column))


def _one(regulation: str, name: str, document_id: str, name_of: str, url: str, ext: str, content_type: str, **meta: str) -> None:
    """A source of one fixed document; its raw frame is any, and gives one row."""

    def read(raw: DataFrame) -> DataFrame:
        single = raw.sparkSession.range(1)
        return rows_of(single, F.lit(document_id), F.lit(name_of), F.lit(url), ext, content_type, metadata(**{k: F.lit(v) for k, v in meta.items()}))

    source(regulation, name)(read)


_one(
    "fda", "ecfr", "title-21", "21 CFR (Title 21) — full text", "https://www.govinfo.gov/bulkdata/ECFR/title-21/ECFR-title21.xml",
    "xml", "application/xml", title="21", source="govinfo_bulkdata",
)
_one(
    "fda", "fdc_act", "fdc-act", "Federal Food, Drug, and Cosmetic Act — full text", "https://www.govinfo.gov/content/pkg/COMPS-973/uslm/COMPS-973.xml",
    "xml", "application/xml", title="Federal Food, Drug, and Cosmetic Act", source="govinfo_comps", package_id="COMPS-973",
)
_one(
    "ca", "mdr", "mdr", "Medical Devices Regulations (SOR/98-282) — full text", "https://laws-lois.justice.gc.ca/eng/regulations/SOR-98-282/FullText.html",
    "html", "text/html", instrument_number="SOR/98-282", source="justice_laws",
)
_one(
    "ca", "food_and_drugs_act", "food-and-drugs-act", "Food and Drugs Act (R.S.C., 1985, c. F-27) — full text", "https://laws-lois.justice.gc.ca/eng/acts/f-27/FullText.html",
    "html", "text/html", citation="R.S.C., 1985, c. F-27", source="justice_laws",
)


def _act(name: str, celex: str, title: str) -> None:
    """An act whose current consolidated version its page tells; raw: html of that page. Without a version there is no candidate (see extract.consolidated for the error)."""

    def read(raw: DataFrame) -> DataFrame:
        pages = raw.select(F.lit(celex).alias("act"), "html")
        anchors = extract.region_links(pages, tag=None, keep=["act"])
        acts = pages.select("act", F.lit(celex).alias("celex")).distinct()
        found = extract.consolidated(acts, anchors).filter("error IS NULL")
        meta = metadata(original_celex=F.col("celex"), consolidated_celex=F.col("consolidated_celex"), source=F.lit("eur_lex"))
        return rows_of(found, F.lit(name), F.lit(title), F.col("url"), "html", "text/html", meta)

    source("eu", name)(read)


_act("mdr", "32017R0745", "Regulation (EU) 2017/745 (MDR) — consolidated text")
_act("ivdr", "32017R0746", "Regulation (EU) 2017/746 (IVDR) — consolidated text")


@source("fda", "guidance", keep="last")
def _fda_guidance(raw: DataFrame) -> DataFrame:
    """raw: the dataset's records, with pos. Records of medical devices whose title is a link with a text."""
    kept = select.contains(raw, "field_regulated_product_field", "Medical Devices").withColumn("_a", extract.anchor(F.col("title"))).filter("_a.href <> '' AND _a.text <> ''")
    kept = kept.withColumn("_docket", extract.anchor(F.col("field_docket_number"))["text"])
    meta = metadata(
        issue_date=text("field_issue_datetime"), status=text("field_final_guidance_1"), communication_type=text("field_communication_type"),
        issuing_office=unescaped("field_issuing_office_taxonomy"), center=unescaped("field_center"), regulated_product_field=unescaped("field_regulated_product_field"),
        docket_number=F.col("_docket"), open_for_comment=fn.blank_to_null(F.trim(F.col("`open-comment`"))),
    )
    href = F.col("_a.href")
    return rows_of(kept, fn.last_segment(href), F.col("_a.text"), fn.absolute_url(href, F.lit(FDA)), "html", "text/html", meta, pos=F.col("pos"))


def _fanned(records: DataFrame, number: Column, second: str, title: Column, url: Column, meta: Column, file: Column, file_title: Column, file_meta: Column, missing: Column, missing_title: Column, missing_url: Column, reason: str) -> DataFrame:
    """Two documents a record: its metadata, whose content is the record, and its file, to be fetched, or the sentinel where it is known to have none.

    A record whose file has no URL gives no second candidate (an error, see file_errors).
    """
    base = records.withColumns({"_id": number, "_content": inline(records)})
    first = rows_of(base, F.concat_ws("/", "_id", F.lit("metadata")), title, url, "json", "application/json", meta, F.col("_content"), F.col("pos") * 2)
    document = F.concat_ws("/", "_id", F.lit(second))
    held = rows_of(base.filter(~missing & file.isNotNull()), document, file_title, file, "pdf", "application/pdf", file_meta, pos=F.col("pos") * 2 + 1)
    none_meta = F.map_concat(file_meta, metadata(not_applicable=F.lit("true"), reason=F.lit(reason)))
    none = rows_of(base.filter(missing), document, missing_title, missing_url, "json", "application/json", none_meta, F.lit(changes.SENTINEL), F.col("pos") * 2 + 1)
    return first.unionByName(held).unionByName(none)


def _no(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


@source("fda", "clearances_510k")
def _clearances(raw: DataFrame) -> DataFrame:
    """raw: clearance records of the window, with pos."""
    k = fn.first_of(F.col("k_number"), F.col("device_name"), last="unknown")
    meta = metadata(k_number=k, **{c: F.col(c) for c in ("applicant", "decision_date", "decision_code", "product_code", "clearance_type", "statement_or_summary")})
    url = F.concat(F.lit(f"{OPEN_FDA}/510k.json?search=k_number:"), k)
    return _fanned(
        raw, k, "summary", F.col("device_name"), url, meta,
        fn.pdf_url(FILES, k), F.concat(F.lit(CLEARANCE_FILE), F.coalesce("device_name", k)), metadata(k_number=k),
        ~_no(F.col("statement_or_summary") == "Summary"), F.concat(F.lit(CLEARANCE_NONE), k, F.lit(")")), url, CLEARANCE_REASON,
    )


@source("fda", "pma")
def _pma(raw: DataFrame) -> DataFrame:
    """raw: decision records of the window, with pos. Whether an order exists only its response tells (extract.pdf_class, changes.not_applicable)."""
    number = F.coalesce("pma_number", F.lit(""))
    d = fn.decision_id(F.col("pma_number"), F.col("supplement_number"))
    meta = plucked(
        "pma_number", "supplement_number", "applicant", "product_code", "decision_date", "decision_code", "supplement_type", "supplement_reason", "advisory_committee"
    )
    url = F.concat(F.lit(f"{OPEN_FDA}/pma.json?search=pma_number:"), F.coalesce("pma_number", F.lit("None")))
    return _fanned(
        raw, d, "order", fn.first_of(F.col("trade_name"), F.col("generic_name")), url, meta,
        fn.pdf_url(FILES, number, F.concat(d, F.lit("A"))), F.concat(F.lit(PMA_FILE), F.coalesce("trade_name", d)),
        metadata(pma_number=number, supplement_number=F.col("supplement_number")), F.lit(False), F.lit(""), F.lit(""), "",
    )


@source("fda", "hde")
def _hde(raw: DataFrame) -> DataFrame:
    """raw: page_id (a number) and html of the listing's pages."""
    rows = extract.approvals(extract.read_tables(raw)).withColumnRenamed("number", "hde_number").withColumn("pos", placed("page_id", F.col("row_no"))).drop("page_id", "row_no")
    number = F.col("hde_number")
    return _fanned(
        rows, number, "order", F.col("device_name"), F.lit(HDE_LISTING), plucked("hde_number", "approval_date", "company"),
        fn.pdf_url(FILES, number, F.concat(number, F.lit("A"))), F.concat(F.lit(HDE_FILE), "device_name"), plucked("hde_number"),
        ~F.col("has_detail_page"), F.concat(F.lit(HDE_NONE), number, F.lit(")")), F.lit(HDE_LISTING), HDE_REASON,
    )


@source("fda", "recalls")
def _recalls(raw: DataFrame) -> DataFrame:
    """raw: enforcement records of the window, with pos."""
    number = fn.first_of(F.col("recall_number"), F.col("event_id") if "event_id" in raw.columns else F.lit(None).cast("string"), last="unknown")
    meta = metadata(
        recall_number=number, classification=F.col("classification"), status=F.col("status"), firm_name=F.col("recalling_firm"),
        report_date=F.col("report_date"), product_code=F.col("product_code"),
    )
    url = F.concat(F.lit(f"{OPEN_FDA}/enforcement.json?search=recall_number:"), number)
    return rows_of(raw, number, F.col("product_description"), url, "json", "application/json", meta, inline(raw), F.col("pos"))


#: Metadata keys of a product classification.
CLASSIFICATION = (
    "product_code", "device_name", "device_class", "regulation_number", "review_panel", "medical_specialty",
    "medical_specialty_description", "submission_type_id", "definition",
)


@source("fda", "classification")
def _classification(raw: DataFrame) -> DataFrame:
    """raw: catalogue records, with pos."""
    code = F.coalesce("product_code", F.lit("unknown"))
    meta = metadata(product_code=code, **{c: F.col(c) for c in CLASSIFICATION[1:]})
    url = F.concat(F.lit(f"{OPEN_FDA}/classification.json?search=product_code:"), code)
    return rows_of(raw, code, F.col("device_name"), url, "json", "application/json", meta, inline(raw), F.col("pos"))


#: Fixed value: how many listing pages of warning letters one run reads.
LETTER_PAGES = 25


@source("fda", "warning_letters")
def _letters(raw: DataFrame) -> DataFrame:
    """raw: page (from 0) and html of the listing's pages; the first page without rows ends it."""
    pages = raw.filter(F.col("page") < LETTER_PAGES)
    found = extract.letters(extract.read_tables(pages, "page"), "page")
    counts = pages.select("page", F.lit(1).alias("one")).join(found.groupBy("page").agg(F.count("*").alias("rows")), "page", "left")
    reached = select.until_empty(counts, ["one"], "page", "rows").select("page")
    rows = found.join(reached, "page", "left_semi")
    meta = metadata(company_name=F.col("title"), **{c: F.col(c) for c in ("posted_date", "letter_issue_date", "issuing_office", "subject")})
    pos = F.col("page") * 1_000_000 + F.col("row_no")
    return rows_of(rows, F.col("document_id"), F.col("title"), fn.absolute_url(F.col("href"), F.lit(FDA)), "html", "text/html", meta, pos=pos)


@source("eu", "mdcg_guidance", keep="last")
def _mdcg(raw: DataFrame) -> DataFrame:
    """raw: page_id (a number) and html of the listing's pages."""
    rows = extract.classed_rows(extract.read_tables(raw), EU).withColumn("document_id", fn.uuid_or_hash(F.col("url"))).withColumn("ext", fn.extension(F.col("url")))
    title = fn.first_of(F.col("title"), F.col("reference"), F.col("document_id"))
    pos = placed("page_id", F.col("table_no").cast("bigint") * 1_000_000 + F.col("row_no"))
    return rows_of(rows, F.col("document_id"), title, F.col("url"), F.col("ext"), fn.content_type(F.col("ext")), plucked("reference", "category", "publication"), pos=pos)


#: Metadata keys of a licence.
LICENCE = (
    "original_licence_no", "licence_status", "appl_risk_class", "licence_name", "first_licence_status_dt", "licence_type_cd", "licence_type_desc", "company_id",
)


@source("ca", "mdall")
def _mdall(raw: DataFrame) -> DataFrame:
    """raw: licence records, with pos."""
    number = F.coalesce(F.col("original_licence_no").cast("string"), F.lit("unknown"))
    url = F.concat(F.lit(f"{LICENCES}?id="), number, F.lit("&type=json&lang=en"))
    return rows_of(raw, number, F.col("licence_name"), url, "json", "application/json", plucked(*LICENCE), inline(raw), F.col("pos"))


@source("ca", "recalls", keep="last")
def _ca_recalls(raw: DataFrame) -> DataFrame:
    """raw: records of the dataset, with pos; those of medical devices with an id."""
    kept = raw.filter((F.col("Organization") == "Medical devices") & F.col("NID").isNotNull())
    meta = metadata(
        nid=F.col("NID"), issue=F.col("Issue"), category=F.col("Category"), recall_class=F.col("`Recall class`"),
        last_updated=F.col("`Last updated`"), archived=F.col("Archived"),
    )
    url = fn.first_of(F.col("URL"), last=RECALL_DATA)
    return rows_of(kept, F.col("NID").cast("string"), F.col("Title"), url, "json", "application/json", meta, inline(kept), F.col("pos"))


@source("ca", "guidance", keep="last")
def _ca_guidance(raw: DataFrame) -> DataFrame:
    """raw: page_id (a number) and html of the listing's pages. Links of the main region that lead to a document, not to a whole site."""
    links = extract.region_links(raw, attribute=("property", "mainContentOfPage")).filter("href <> '' AND text <> ''")
    rows = links.withColumn("url", fn.absolute_url(F.col("href"), F.lit(CANADA))).filter(~select.bare_root(F.col("url")))
    return rows_of(rows, fn.slug_or_hash(F.col("url")), F.col("text"), F.col("url"), "html", "text/html", metadata(link_text=F.col("text")), pos=placed("page_id", F.col("pos")))


def file_errors(records: DataFrame, number: Column, second: str, wanted: Column | None = None) -> DataFrame:
    """Records whose number tells no place of a file: document_id and error."""
    bad = ~_no(F.substring(number, 2, 2).rlike("^[0-9]{2}$"))
    kept = records.filter(bad if wanted is None else bad & wanted)
    return kept.select(F.concat_ws("/", number, F.lit(second)).alias("document_id"), F.concat(F.lit(NO_PLACE), number).alias("error"))


SETTINGS = {"enabled": "boolean", "rps": "double", "max_new": "int", "recheck_after_days": "int", "lookback_days": "int", "time_budget_minutes": "int"}


def effective(sources: DataFrame, own: DataFrame, overrides: DataFrame | None = None, whole: dict | None = None) -> DataFrame:
    """Every source's settings in force: regulation, source and SETTINGS.

    sources: regulation, source. own: their settings, for any part of them. overrides: one row a source of what a
    command says (null: nothing). whole: the global rps and max_new. Precedence: command, own, global, default;
    recheck, lookback and time budget have no global value, and null stays null. -1 as max_new becomes null (no
    limit) only after that. A source without settings is enabled.
    """
    key, general = ["regulation", "source"], DEFAULTS | (whole or {})
    pick = lambda df, name, kind: (F.col(name) if name in df.columns else F.lit(None)).cast(kind)
    both = sources.select(*key).join(own.select(*key, *(pick(own, n, k).alias(f"o_{n}") for n, k in SETTINGS.items())), key, "left")
    over = overrides if overrides is not None else sources.select(*key).limit(0)
    both = both.join(over.select(*key, *(pick(over, n, k).alias(f"c_{n}") for n, k in SETTINGS.items())), key, "left")
    value = {n: F.coalesce(f"c_{n}", f"o_{n}") for n in SETTINGS}
    value["enabled"] = F.coalesce("o_enabled", F.lit(True))
    value["rps"] = F.coalesce(value["rps"], F.lit(float(general["rps"])))
    value["max_new"] = F.nullif(F.coalesce(value["max_new"], F.lit(general["max_new"])), F.lit(-1))
    return both.select(*key, *(c.alias(n) for n, c in value.items()))


def preview(estimates: DataFrame) -> DataFrame:
    """Adds this_run (what is left, up to the budget) and eta_s; null where the total is unknown."""
    run = F.when(F.col("remaining").isNotNull(), F.least("remaining", "max_new"))
    return estimates.withColumn("this_run", run).withColumn("eta_s", F.when(F.col("rps") > 0, F.col("this_run") / F.col("rps")))
