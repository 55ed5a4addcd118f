"""Rows and links from pages, and classes of responses.

Links and tables need an HTML parser: a generator over pandas batches runs it where the page is read, so there is no
shuffle; a batch's pages are in memory, and what they hold by pieces. Classes are built-in expressions. Path rules are, too: those of
short files as arrays, those of long ones as an index by prefix.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from vigilspark.functions import policy
from vigilspark.operators.requests import RETRYABLE

#: Phrases of block pages, the size up to which a page can be one, and how far it is read.
BLOCK_PHRASES = (
    "fda apology",
    "abuse-detection",
    "excessive-requests",
    "access denied",
    "captcha",
    "are you a robot",
    "request blocked",
    "automated access",
)
BLOCK_BYTES, BLOCK_CHARS = 20_000, 4000

#: Elements without an end.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
CELLS = (
    "table_no int, row_no int, body int, category string, classes string, "
    "cells array<struct<text:string,spaced:string,header:string,href:string,link:string>>"
)


class _Over(Exception):
    """The region is over; nothing behind it counts."""


class _Links(HTMLParser):
    """Anchors with a target inside the first element that has an attribute's value (or is of a tag); all of the page's without either."""

    def __init__(self, tag: str | None = None, attribute: tuple[str, str] | None = None):
        super().__init__(convert_charrefs=True)
        self.tag, self.attribute, self.found, self.open = tag, attribute, [], None
        self.depth, self.name, self.seen = 0, None, tag is None and attribute is None
        self.inside = self.seen

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if not self.seen and (tag == self.tag or (self.attribute and a.get(self.attribute[0]) == self.attribute[1])):
            self.seen = self.inside = True
            self.name, self.depth = tag, 1
        elif self.inside and tag == self.name and tag not in VOID:
            self.depth += 1
        if self.inside and tag == "a":
            self.open = None  # anchors do not nest
            if a.get("href") is not None:
                self.open = [a["href"], []]
                self.found.append(self.open)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag == "a":
            self.open = None
        if self.inside and tag == self.name:
            self.depth -= 1
            if not self.depth:
                raise _Over

    def handle_data(self, data):
        if self.open is not None and data.strip():
            self.open[1].append(data.strip())


#: So many rows of a page batch's links or tables are in Python at once.
PIECE = 2048


def pieces(rows: Iterator[tuple], columns: list[str], kinds: dict[str, str]) -> Iterator[pd.DataFrame]:
    """Rows as frames of at most PIECE rows."""
    while out := list(islice(rows, PIECE)):
        yield pd.DataFrame(out, columns=columns).astype(kinds)


def page_links(html: str | None, tag: str | None = None, attribute: tuple[str, str] | None = None) -> list[tuple[str, str]] | None:
    """Target and text (nodes stripped, joined by nothing) of each anchor of the region; None without the region."""
    parser = _Links(tag, attribute)
    try:
        parser.feed(html or "")
        parser.close()
    except _Over:
        pass
    return [(href, "".join(nodes)) for href, nodes in parser.found] if parser.seen else None


def region_links(pages: DataFrame, html: str = "html", tag: str | None = "article", attribute: tuple[str, str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """One row per link inside the region: kept columns, region_missing, pos, href, text. A page without the region, or without links, gives one row without pos.

    The region is the first element with an attribute's value, else the first of the tag; with neither, the page.
    """
    names = keep or ["page_id"]
    kinds = dict(pages.dtypes)

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield from pieces(links(frame), [*names, "region_missing", "pos", "href", "text"], {"pos": "Int32"})

    def links(frame: pd.DataFrame) -> Iterator[tuple]:
        for kept, text in zip(frame[names].itertuples(index=False, name=None), frame[html], strict=True):
            found = page_links(text, None if attribute else tag, attribute)
            yield from [(*kept, False, k, *link) for k, link in enumerate(found or [])] or [(*kept, found is None, None, None, None)]

    kept = ", ".join(f"`{n}` {kinds[n]}" for n in names)
    return pages.select(*(F.col(f"`{c}`") for c in (*names, html))).mapInPandas(rows, f"{kept}, region_missing boolean, pos int, href string, text string")


def anchor(snippet: Column) -> Column:
    """href and text of a snippet's first anchor with a target; nulls without one."""

    @F.pandas_udf("href string, text string")
    def first(snippets: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(page_links(s) or [(None, None)])[0] for s in snippets], columns=["href", "text"], dtype=object)

    return first(snippet)


def is_block_page(content_type: Column, size: Column, body: Column) -> Column:
    head = F.lower(F.substring(body, 1, BLOCK_CHARS))
    phrase = F.lit(False)
    for p in BLOCK_PHRASES:
        phrase |= head.contains(p)
    return F.lower(content_type).contains("html") & (size <= BLOCK_BYTES) & phrase


def response_class(disallowed: Column, failed: Column, block: Column, status: Column) -> Column:
    """hard_stop, bot_block (both stop a run), error (this row only) or ok, in that order. A status that was tried again until the end is a failure, whatever the page."""
    return F.when(disallowed | failed | status.isin(*RETRYABLE), "hard_stop").when(block, "bot_block").when(status >= 400, "error").otherwise("ok")


def pdf_class(disallowed: Column, failed: Column, block: Column, status: Column, content_type: Column, settles: Column) -> Column:
    """hard_stop, bot_block, ok, miss (settled: the item has no file) or error, for items that should be a PDF."""
    good = (status == 200) & F.lower(content_type).contains("pdf")
    stop = disallowed | failed | status.isin(*RETRYABLE)
    return F.when(stop, "hard_stop").when(block, "bot_block").when(good, "ok").when(settles, "miss").otherwise("error")


def demoted(outcome: Column, host: Column, listing_host: str) -> Column:
    """A stop on another host than the listing's concerns that row only."""
    return F.when(outcome.isin("hard_stop", "bot_block") & (host != listing_host), "error").otherwise(outcome)


def robots_state(status: Column, block: Column, unreachable: Column) -> Column:
    """What a robots fetch says: blocked (or unreachable), disallow_all, absent or loaded."""
    return F.when(unreachable | block, "blocked").when(status.isin(401, 403), "disallow_all").when(status >= 400, "absent").otherwise("loaded")


#: The label of an act's current version, and what its id looks like in a link.
CURRENT, CELEX = "(?i)^access current version", r"CELEX:(0[0-9A-Za-z]*-\d{8})"


def consolidated(acts: DataFrame, anchors: DataFrame, text_url: str = "https://eur-lex.europa.eu/legal-content/EN/TXT/?uri=CELEX:") -> DataFrame:
    """The current consolidated version of each act: act, celex, consolidated_celex, url, error.

    acts: act, celex (its own id). anchors: act, pos, href, text of its page. The first link labelled current
    counts, else the one with the greatest date; an act without any has an error.
    """
    both = acts.join(anchors, "act", "left")
    own = F.concat(F.lit("0"), F.expr("substring(celex, 2)"), F.lit("-"))
    version = F.get(F.filter(F.regexp_extract_all("href", F.lit(CELEX), F.lit(1)), lambda v: v.startswith(own)), F.lit(0))
    rows = both.withColumn("v", version).withColumn("current", F.coalesce(F.col("text").rlike(CURRENT) & F.col("v").isNotNull(), F.lit(False)))
    first = F.min_by(F.when(F.col("current"), F.col("v")), F.when(F.col("current"), F.col("pos")))
    last = F.max_by("v", F.regexp_extract("v", r"-(\d{8})$", 1))
    out = rows.groupBy("act", "celex").agg(F.coalesce(first, last).alias("consolidated_celex"))
    none = F.concat(F.lit("no consolidated version found for CELEX:"), F.col("celex"))
    return out.withColumn("url", F.concat(F.lit(text_url), "consolidated_celex")).withColumn("error", F.when(F.col("consolidated_celex").isNull(), none))


class _Tables(HTMLParser):
    """Rows of a page's tables: cells with text (nodes stripped, joined by nothing and by blanks), header attribute, first link and its own text; the heading before the table."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows, self.stack, self.heading, self.in_heading, self.count = [], [], None, None, 0

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag in ("h2", "h3", "h4"):
            self.in_heading = []
        elif tag == "table":
            self.stack.append({"no": self.count, "classes": a.get("class") or "", "category": self.heading, "row": None, "n": 0, "cell": None, "bodies": 0, "body": None})
            self.count += 1
        elif self.stack:
            t = self.stack[-1]
            if tag in ("tbody", "thead", "tfoot"):
                self._close_row(t)
                t["body"] = t["bodies"] if tag == "tbody" else None
                t["bodies"] += tag == "tbody"
            elif tag == "tr":
                self._close_row(t)
                t["row"] = []
            elif tag == "td" and t["row"] is not None:
                self._close_cell(t)
                t["cell"] = {"nodes": [], "header": (a.get("data-ecl-table-header") or "").strip(), "href": None, "link": None, "open": False}
            elif tag == "th":
                self._close_cell(t)
            elif tag == "a":
                for cell in self._cells():
                    cell["open"] = False
                    if a.get("href") is not None and cell["href"] is None:
                        cell.update(href=a["href"], link=[], open=True)

    def handle_endtag(self, tag):
        if tag in ("h2", "h3", "h4") and self.in_heading is not None:
            self.heading, self.in_heading = "".join(self.in_heading), None
        elif self.stack:
            t = self.stack[-1]
            if tag == "a":
                for cell in self._cells():
                    cell["open"] = False
            elif tag in ("td", "th"):
                self._close_cell(t)
            elif tag == "tr":
                self._close_row(t)
            elif tag in ("tbody", "thead", "tfoot"):
                self._close_row(t)
                t["body"] = None
            elif tag == "table":
                self._close_row(t)
                self.stack.pop()

    def handle_data(self, data):
        text = data.strip()
        if not text:
            return
        if self.in_heading is not None:
            self.in_heading.append(text)
        for cell in self._cells():
            cell["nodes"].append(text)
            if cell["open"]:
                cell["link"].append(text)

    def _cells(self):
        return [t["cell"] for t in self.stack if t["cell"] is not None]

    def _close_cell(self, t):
        if t["cell"] is not None:
            c = t["cell"]
            link = None if c["link"] is None else "".join(c["link"])
            t["row"].append({"text": "".join(c["nodes"]), "spaced": " ".join(c["nodes"]), "header": c["header"], "href": c["href"], "link": link})
            t["cell"] = None

    def _close_row(self, t):
        self._close_cell(t)
        if t["row"] is not None:
            self.rows.append((t["no"], t["n"], t["body"], t["category"], t["classes"], t["row"]))
            t["n"] += 1
            t["row"] = None


def table_rows(html: str) -> list[tuple]:
    """Rows as CELLS has them. body: the number of the row's tbody, null outside of one; 0 in a table without any."""
    parser = _Tables()
    parser.feed(html or "")
    parser.close()
    while parser.stack:
        parser._close_row(parser.stack.pop())
    parted = {no for no, _, body, *_ in parser.rows if body is not None}
    return [(no, n, body if no in parted else 0, *rest) for no, n, body, *rest in parser.rows]


def read_tables(pages: DataFrame, id_col: str = "page_id", html: str = "html") -> DataFrame:
    """One row per table row of each page: the id and CELLS."""
    kind = dict(pages.dtypes)[id_col]

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = ((i, *row) for i, text in zip(frame[id_col], frame[html], strict=True) for row in table_rows(text))
            yield from pieces(out, [id_col, "table_no", "row_no", "body", "category", "classes", "cells"], {"body": "Int32"})

    return pages.select(F.col(f"`{id_col}`"), F.col(f"`{html}`")).mapInPandas(rows, f"`{id_col}` {kind}, {CELLS}")


class HtmlRows:
    """table_rows as a table function: html_rows(html) has a row for each table row of a page."""

    @staticmethod
    def analyze(html: AnalyzeArgument) -> AnalyzeResult:
        text, number = StringType(), IntegerType()
        cell = StructType([StructField(c, text) for c in ("text", "spaced", "header", "href", "link")])
        plain = {"table_no": number, "row_no": number, "body": number, "category": text, "classes": text}
        return AnalyzeResult(StructType([*(StructField(c, t) for c, t in plain.items()), StructField("cells", ArrayType(cell))]))

    def eval(self, html: str | None):
        for *plain, cells in table_rows(html or ""):
            yield *plain, [(c["text"], c["spaced"], c["header"], c["href"], c["link"]) for c in cells]


def register_functions(spark: SparkSession) -> None:
    """Makes html_rows known to SQL: SELECT ... FROM pages, LATERAL html_rows(pages.html)."""
    spark.udtf.register("html_rows", F.udtf(HtmlRows))


def _cell(k: int, field: str = "text") -> Column:
    return F.get("cells", F.lit(k))[field]


def first_table(rows: DataFrame) -> DataFrame:
    """Rows of each page's first table that lie in its first body."""
    return rows.filter("table_no = 0 AND body = 0")


def letters(rows: DataFrame, id_col: str = "page_id") -> DataFrame:
    """First table: rows whose first link has a target and a text of its own, which is the title; dates, office and subject by place."""
    link = F.get(F.filter("cells", lambda c: c["href"].isNotNull()), F.lit(0))
    held = first_table(rows).withColumn("link", link).filter("link.href <> '' AND link.link <> ''")
    href = F.col("link.href")
    return held.select(
        id_col, F.regexp_extract(href, "([^/]*)/*$", 1).alias("document_id"), F.col("link.link").alias("title"), href.alias("href"),
        _cell(0).alias("posted_date"), _cell(1).alias("letter_issue_date"), _cell(3).alias("issuing_office"), _cell(4).alias("subject"), "row_no",
    )


def approvals(rows: DataFrame, id_col: str = "page_id", number: str = r"(H\d{6})") -> DataFrame:
    """First table: rows of five cells or more with a number in the second cell, else in the first."""
    found = F.coalesce(F.nullif(F.regexp_extract(_cell(1, "spaced"), number, 1), F.lit("")), F.nullif(F.regexp_extract(_cell(0, "spaced"), number, 1), F.lit("")))
    held = first_table(rows).filter(F.size("cells") >= 5).withColumn("number", found).filter("number IS NOT NULL")
    return held.select(
        id_col, "number", _cell(0, "spaced").alias("approval_date"), _cell(2, "spaced").alias("device_name"), _cell(3, "spaced").alias("company"),
        _cell(4, "spaced").alias("description"), _cell(1, "href").isNotNull().alias("has_detail_page"), "row_no",
    )


def classed_rows(rows: DataFrame, base: str, id_col: str = "page_id", cls: str = "ecl-table") -> DataFrame:
    """Rows of tables of a class, by header attribute, with the heading before the table and the first link of any cell."""
    by = lambda name: F.nullif(F.try_element_at(F.filter("cells", lambda c: c["header"] == name), F.lit(-1))["text"], F.lit(""))
    linked = F.filter("cells", lambda c: c["href"].isNotNull())
    held = rows.filter(F.array_contains(F.split("classes", r"\s+"), cls) & (F.col("row_no") > 0) & (F.size(linked) > 0)).withColumn("href", F.get(linked, F.lit(0))["href"]).filter("href <> ''")
    url = F.when(F.col("href").startswith("http"), F.col("href")).otherwise(F.concat(F.lit(base), F.col("href")))
    return held.select(id_col, "table_no", "row_no", url.alias("url"), by("Reference").alias("reference"), by("Title").alias("title"), by("Publication").alias("publication"), "category")


def fetch_decisions(candidates: DataFrame, robots: DataFrame, now: Column, agent: str = policy.AGENT) -> DataFrame:
    """Adds decision, min_interval and opens_at to candidates (origin, url).

    robots: one row per origin with state (loaded, absent, disallow_all, blocked), body, and policy_in_force, a
    policy that is remembered. A loaded file tells rules and policy; under the other states the policy is the one
    in force (none if absent), and only disallow_all forbids paths. decision: disallowed (by a path rule or
    altogether), outside_hours (then opens_at tells when the host opens), or allowed. An origin without a row is
    allowed. Each different file is parsed once; only the rules meet the URLs.
    """
    fields = ["min_interval", "start_min", "end_min", "zone"]
    read = robots.withColumn("_r", policy.robots(F.when(F.col("state") == "loaded", F.col("body")), agent))
    own, held = (F.struct(*(F.col(f"{c}.{f}").alias(f) for f in fields)) for c in ("_r", "policy_in_force"))
    force = F.when(F.col("state") == "loaded", own).when(F.col("state").isin("blocked", "disallow_all"), held)
    known = read.select("origin", F.col("state").alias("_state"), force.alias("_policy"))
    both = allowed_paths(candidates, robots.filter("state = 'loaded'"), agent, name="_allowed").join(known, "origin", "left")
    barred = (F.col("_state") == "disallow_all") | ~F.col("_allowed")
    closed = F.col("_policy").isNotNull() & ~policy.open_now(F.col("_policy"), now)
    decision = F.when(barred, "disallowed").when(closed, "outside_hours").otherwise("allowed")
    out = both.withColumn("decision", decision).withColumn("min_interval", F.col("_policy.min_interval"))
    return out.withColumn("opens_at", F.when(closed, policy.next_open(F.col("_policy"), now))).drop("_state", "_policy", "_allowed")


#: Up to so many rules a file are tried one by one on each URL; those of longer files are looked up.
SHORT = 64


def rule_index(files: DataFrame) -> DataFrame:
    """The rules of each file (file, rules) by their path: file, path, at (its first place), allow."""
    rules = files.select("file", F.posexplode("rules").alias("at", "r"))
    return rules.groupBy("file", F.col("r.path").alias("path")).agg(F.min("at").alias("at"), F.min_by("r.allow", "at").alias("allow"))


def allowed_paths(candidates: DataFrame, robots: DataFrame, agent: str = policy.AGENT, short: int = SHORT, name: str = "allowed") -> DataFrame:
    """Adds allowed to candidates by their origin's robots file (origin, body, one row each) alone. Without a file everything is allowed.

    The first rule of a file that fits decides. Each different file is parsed once. A file of at most short rules goes
    with its origin, and its rules are tried on each URL. A longer file is an index: a URL's path looks up its own starts
    of the lengths that the file's rules have, and the hit with the least place decides; what meets the index are the
    different paths, and the work for one does not grow with the number of rules.
    """
    bodies = robots.filter("body IS NOT NULL").withColumn("file", F.sha2(F.col("body").cast("binary"), 256))
    files = bodies.groupBy("file").agg(F.first("body").alias("body")).select("file", policy.robots(F.col("body"), agent)["rules"].alias("rules"))
    index = rule_index(files.filter(F.size("rules") > short))
    lengths = index.groupBy("file").agg(F.collect_set(F.length("path")).alias("_lengths"))
    tried = files.select("file", F.when(F.size("rules") <= short, F.col("rules")).alias("_rules")).join(lengths, "file", "left")
    known = bodies.select("origin", "file").join(tried, "file").withColumnRenamed("file", "_file")
    both = candidates.join(known, "origin", "left").withColumn("_path", policy.rule_path(F.col("url")))
    asked = both.filter("_lengths IS NOT NULL").select(F.col("_file").alias("file"), "_path", "_lengths").distinct()
    starts = F.transform(F.filter("_lengths", lambda n: n <= F.length("_path")), lambda n: F.substring(F.col("_path"), F.lit(1), n))
    probes = asked.select("file", "_path", F.explode(F.array_distinct(F.concat(F.array(F.lit("*")), starts))).alias("path"))
    hits = probes.join(index, ["file", "path"]).groupBy(F.col("file").alias("_file"), "_path").agg(F.min_by("allow", "at").alias("_hit"))
    out = both.join(hits, ["_file", "_path"], "left")
    told = F.when(F.col("_rules").isNotNull(), policy.first_fit(F.col("_rules"), F.col("_path"))).otherwise(F.col("_hit"))
    return out.withColumn(name, F.coalesce(told, F.lit(True))).drop("_file", "_rules", "_lengths", "_path", "_hit")
