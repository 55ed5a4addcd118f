"""Choosing candidates: windows, filters, joins with what is held, the run cut, and set operations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilspark.operators.changes import KEY

_DAY = 86_400_000_000


def lookback(df: DataFrame, date: str, today: Column, days: int = 30) -> DataFrame:
    """Rows of the last days, both ends included."""
    return df.filter(F.col(date).between(today - F.expr(f"INTERVAL {days} DAYS"), today))


def contains(df: DataFrame, column: str, text: str) -> DataFrame:
    return df.filter(F.coalesce(F.col(column), F.lit("")).contains(text))


def complete(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which none of the columns is null or empty."""
    kept = F.lit(True)
    for c in columns:
        kept &= F.col(c).isNotNull() & (F.col(c) != "")
    return df.filter(kept)


def bare_root(url: Column) -> Column:
    """Whether a link leads to a whole site: no path but /, and no query."""
    return F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")).isin("", "/") & F.coalesce(F.try_parse_url(url, F.lit("QUERY")), F.lit("")).eqNullSafe(F.lit(""))


def clean_id(raw: Column) -> Column:
    """A document id without blanks, then slashes, at its ends; null if empty or with a .. segment."""
    text = F.regexp_replace(F.regexp_replace(raw, r"^\s+|\s+$", ""), "^/+|/+$", "")
    return F.when((text == "") | text.rlike(r"(^|/)\.\.(/|$)"), None).otherwise(text)


def age_days(now: Column, then: Column) -> Column:
    """Whole elapsed days."""
    return F.floor(F.timestamp_diff("MICROSECOND", then, now) / F.lit(_DAY))


def instant(df: DataFrame, column: str) -> Column:
    """Microseconds since 1970 of a time: a timestamp, one without zone (as UTC), or ISO text (in its own zone, else UTC); null if malformed."""
    kind = dict(df.dtypes).get(column)
    if kind is None:
        return F.lit(None).cast("bigint")
    if kind == "timestamp_ntz":
        return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col(column))
    if kind == "timestamp":
        return F.unix_micros(column)
    zoned = F.when(F.col(column).rlike(r"(Z|[+-]\d\d:?\d\d)$"), F.col(column)).otherwise(F.concat(column, F.lit("Z")))
    return F.unix_micros(zoned.try_cast("timestamp"))


def due(candidates: DataFrame, state: DataFrame, now: Column, recheck_days: int | None) -> DataFrame:
    """Candidates that are not held, or held and due again. None: never again.

    What counts is the time of the last check, else of the last scrape; where both are missing, or the one that
    counts is malformed, the document is due. now is a UTC time.
    """
    told = lambda c: F.col(c).cast("string") if c in state.columns else F.lit(None).cast("string")
    checked = F.nullif(told("last_checked_at"), F.lit("")).isNotNull()
    then = F.when(checked, instant(state, "last_checked_at")).otherwise(instant(state, "last_scraped_at"))
    held = state.select(*KEY, F.lit(True).alias("held"), then.alias("checked"))
    both = candidates.join(held, KEY, "left")
    at = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), now.cast("timestamp_ntz"))
    again = F.lit(False) if recheck_days is None else F.col("checked").isNull() | (F.floor((at - F.col("checked")) / F.lit(_DAY)) >= recheck_days)
    return both.filter(F.col("held").isNull() | again).drop("held", "checked")


def missing(candidates: DataFrame, state: DataFrame) -> DataFrame:
    return candidates.join(state.select(*KEY), KEY, "left_anti")


def estimate(candidates: DataFrame, state: DataFrame, by: list[str]) -> DataFrame:
    """Per group: total, known, remaining (never below 0; null if either is)."""
    known = state.select(*KEY).distinct().withColumn("one", F.lit(1))
    both = candidates.join(known, KEY, "left").groupBy(*by).agg(F.count("*").alias("total_available"), F.count("one").alias("already_known"))
    return both.withColumn("remaining", remaining(F.col("total_available"), F.col("already_known")))


def remaining(total: Column, known: Column) -> Column:
    return F.when(total.isNotNull() & known.isNotNull(), F.greatest(F.lit(0).cast("bigint"), total - known))


def group_key(*columns: str) -> Column:
    """Columns as one key: a struct, in which nulls equal nulls."""
    return F.struct(*(F.col(c) for c in columns))


def run_cut(candidates: DataFrame, run: list[str], order: str, budget: int | None, minutes: float | None = None, began: str = "began", ended: str | None = None) -> DataFrame:
    """Labels ordered candidates of each run: executed, skipped_known or not_reached; adds the run's stop_reason.

    candidates: known (boolean) and outcome (ok, error, hard_stop, bot_block); with minutes also began (when each
    one's turn comes) and, if named, ended (when it is saved). A run stops at the first of: a stop outcome; the saved
    document that fills the budget; an unknown candidate whose turn comes when the run's first time is minutes
    old; a document saved so late; the first unknown candidate, if the budget is 0. Only ok outcomes use budget. Each
    candidate is of one kind of stop, of which the first of a run counts (of saved ones the last within the budget),
    so at most that many rows of a kind leave a task; the least is joined back, and no run has to fit in one task.
    A null in run is a run like any other. Times that are null are never late.
    """
    rows = candidates.withColumn("_run", group_key(*run))
    late = timely = F.lit(False)
    if minutes is not None:
        start = rows.groupBy("_run").agg(F.min(began).alias("_start"))
        rows = rows.join(start, "_run")
        late, timely = (F.coalesce(_old(F.col("_start"), F.col(c), minutes), F.lit(False)) if c else F.lit(False) for c in (began, ended))
    saved = F.col("outcome") == "ok"
    kind = F.when(F.lit(budget == 0), "none").when(late, "late").when(F.col("outcome").isin("hard_stop", "bot_block"), "stop").when(saved & timely, "slow").when(F.lit(budget is not None) & saved, "saved")
    tried = rows.filter(~F.col("known")).select("_run", F.col(order).alias("at"), "outcome", kind.alias("kind")).filter("kind IS NOT NULL")
    place = F.row_number().over(Window.partitionBy("_run", "kind").orderBy("at"))
    tried = tried.withColumn("_n", place).filter(F.col("_n") <= max(budget or 1, 1))
    tried = tried.filter(F.col("_n") == F.when(F.col("kind") == "saved", budget or 1).otherwise(1))
    why = F.when(F.col("kind") == "stop", F.col("outcome")).otherwise("budget_reached")
    cut = tried.groupBy("_run").agg(F.min(F.struct("at", (~F.col("kind").isin("none", "late")).alias("done"), why.alias("why"))).alias("cut"))
    both = rows.join(cut, "_run", "left")
    beyond = (F.col(order) > F.col("cut.at")) | ((F.col(order) == F.col("cut.at")) & ~F.col("cut.done"))
    label = F.when(F.col("cut").isNotNull() & beyond, "not_reached").when(F.col("known"), "skipped_known").otherwise("executed")
    return both.withColumn("label", label).withColumn("stop_reason", F.coalesce("cut.why", F.lit("completed"))).drop("cut", "_run", "_start")


def process(
    candidates: DataFrame, state: DataFrame, fetch: Callable[[DataFrame], DataFrame], run: list[str], order: str, budget: int | None = None,
    minutes: float | None = None, began: str = "began", ended: str | None = None,
) -> DataFrame:
    """A run over candidates with a callback: fetch adds outcome (and times, with minutes) to those not held, and run_cut tells how far the run gets. Times are null for those held."""
    held = state.select(*KEY).distinct().withColumn("_held", F.lit(True))
    both = candidates.join(held, KEY, "left").withColumn("known", F.col("_held").isNotNull()).drop("_held")
    tried = both.filter(~F.col("known")).transform(fetch)
    kept = both.filter("known").withColumn("outcome", F.lit(None).cast("string"))
    return run_cut(tried.unionByName(kept, allowMissingColumns=True), run, order, budget, minutes, began, ended)


def _old(start: Column, at: Column, minutes: float) -> Column:
    return F.timestamp_diff("MICROSECOND", start, at) >= int(minutes * 60_000_000)


def time_cut(df: DataFrame, run: list[str], ts: str, minutes: float) -> DataFrame:
    """Adds reached: whether a row starts before the run's first row is minutes old. Null for rows without a time; a null in run is a run like any other."""
    keyed = df.withColumn("_run", group_key(*run))
    start = keyed.groupBy("_run").agg(F.min(ts).alias("_start"))
    return keyed.join(start, "_run").withColumn("reached", ~_old(F.col("_start"), F.col(ts), minutes)).drop("_run", "_start")


def numbered(df: DataFrame, by: list[str], step: str, order: list[Column], name: str) -> DataFrame:
    """Adds each row's number, from 0, within its group in the order of step (descending, nulls last) and then order.

    Rows are numbered within each value of step; the counts of these, one row each, give the numbers before it.
    """
    keyed = df.withColumn("_k", F.struct(group_key(*by).alias("g"), F.col(step).alias("s")))
    before = F.sum("_rows").over(Window.partitionBy("_k.g").orderBy(F.desc("_k.s")).rowsBetween(Window.unboundedPreceding, -1))
    steps = keyed.groupBy("_k").agg(F.count("*").alias("_rows")).select("_k", F.coalesce(before, F.lit(0)).alias("_before"))
    inner = F.row_number().over(Window.partitionBy("_k").orderBy(*order)) - 1
    return keyed.withColumn("_inner", inner).join(steps, "_k").withColumn(name, F.col("_before") + F.col("_inner")).drop("_k", "_inner", "_before")


def until_empty(pages: DataFrame, by: list[str], page: str, rows: str) -> DataFrame:
    """Pages before the first one without rows (an empty or missing page ends a listing). A null in by is a listing like any other; of an ended one, a page without a number is left out."""
    keyed = pages.withColumn("_k", group_key(*by))
    first = keyed.filter(F.coalesce(F.col(rows), F.lit(0)) == 0).groupBy("_k").agg(F.min(page).alias("_first"))
    return keyed.join(first, "_k", "left").filter(F.col("_first").isNull() | (F.col(page) < F.col("_first"))).drop("_k", "_first")


def first_place_last_value(df: DataFrame, key: list[str], pos: str, values: list[str]) -> DataFrame:
    """One row per key at its first position with the values of its last one."""
    return df.groupBy(*key).agg(F.min(pos).alias(pos), F.max_by(F.struct(*values), F.col(pos)).alias("_v")).select(*key, pos, *(F.col(f"_v.{v}").alias(v) for v in values))


def first_of_key(df: DataFrame, key: list[str], pos: str, values: list[str]) -> DataFrame:
    """One row per key: its first row by position."""
    return df.groupBy(*key).agg(F.min(pos).alias(pos), F.min_by(F.struct(*values), F.col(pos)).alias("_v")).select(*key, pos, *(F.col(f"_v.{v}").alias(v) for v in values))


def latest(df: DataFrame, key: list[str], *order: Column) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("_n = 1").drop("_n")


def selector_items(requests: DataFrame, request: str = "request_id", expr: str = "expr") -> DataFrame:
    """The items of comma lists in order: request, at, item. Empty items are left out."""
    items = requests.select(request, F.posexplode(F.split(F.col(expr), ",")).alias("at", "item"))
    return items.withColumn("item", F.trim("item")).filter("item <> ''")


def item_sources(registry: DataFrame) -> DataFrame:
    """What each item that is no plain name stands for, and each plain name: item, regulation, source.

    all and reg:all give the enabled sources (a row with a null source where none is), reg:name that source whatever its state.
    """
    name = F.concat_ws(":", "regulation", "source")
    every = F.array(F.struct(F.lit("all").alias("item"), "enabled"), F.struct(F.concat("regulation", F.lit(":all")).alias("item"), "enabled"), F.struct(name.alias("item"), F.lit(True).alias("enabled")))
    rows = registry.select("regulation", "source", F.explode(every).alias("i"))
    held = rows.filter("i.enabled").select("i.item", "regulation", "source")
    empty = rows.select("i.item").distinct().join(held.select("item").distinct(), "item", "left_anti")
    return held.unionByName(empty.select("item", F.lit(None).cast("string").alias("regulation"), F.lit(None).cast("string").alias("source")))


def unknown_items(items: DataFrame, registry: DataFrame) -> DataFrame:
    """Items whose regulation or source is not registered: request, item."""
    known = registry.select(F.explode(F.array(F.concat("regulation", F.lit(":all")), F.concat_ws(":", "regulation", "source"))).alias("item")).distinct()
    return items.filter("item <> 'all'").join(known, "item", "left_anti")


def choose_sources(requests: DataFrame, registry: DataFrame, request: str = "request_id", expr: str = "expr") -> DataFrame:
    """Source selectors to sources, in order of first mention: request, unknown, regulation, source, at.

    A selector is a comma list of: all, reg:all (enabled sources only), reg:name (enabled or not). An item that
    names no registered regulation or source gives a row with unknown. registry: regulation, source, enabled.
    The result has a row for each request and source; to count or to join facts, meet item_sources by item instead.
    """
    items = selector_items(requests, request, expr)
    found = items.join(item_sources(registry), "item").filter("source IS NOT NULL").select(request, F.lit(None).cast("string").alias("unknown"), "regulation", "source", "at")
    bad = unknown_items(items, registry).select(request, F.col("item").alias("unknown"), F.lit(None).cast("string").alias("regulation"), F.lit(None).cast("string").alias("source"), "at")
    return found.unionByName(bad).groupBy(request, "unknown", "regulation", "source").agg(F.min("at").alias("at"))


def requests_per_source(items: DataFrame, registry: DataFrame, request: str = "request_id") -> DataFrame:
    """How many requests choose each source: regulation, source, requests; sources that none chooses are left out.

    A request's plain names count only for sources that its all and reg:all items don't bring, so the counts of
    the three kinds add up, and no row of request and source is made.
    """
    asked = items.select(request, "item").distinct()
    every = asked.filter("item = 'all'").select(request).withColumn("_all", F.lit(True))
    part = asked.filter("item LIKE '%:all'").select(request, F.substring_index("item", ":", 1).alias("regulation"))
    named = asked.filter("item <> 'all' AND item NOT LIKE '%:all' AND item LIKE '%:%'")
    named = named.select(request, F.substring_index("item", ":", 1).alias("regulation"), F.regexp_replace("item", "^[^:]*:", "").alias("source"))
    by_part = part.join(every, request, "left_anti").groupBy("regulation").agg(F.count("*").alias("_part"))
    flags = named.join(every, request, "left").join(part.withColumn("_in", F.lit(True)), [request, "regulation"], "left")
    covered = F.col("_all").isNotNull() | F.col("_in").isNotNull()
    by_name = flags.groupBy("regulation", "source").agg(F.count("*").alias("_named"), F.count_if(~covered).alias("_more"))
    total = every.agg(F.count("*").alias("_every"))
    out = registry.join(by_part, "regulation", "left").join(by_name, ["regulation", "source"], "left").crossJoin(F.broadcast(total))  # one row
    zero = F.lit(0).cast("bigint")
    wide = F.col("_every") + F.coalesce("_part", zero) + F.coalesce("_more", zero)
    return out.select("regulation", "source", F.when(F.col("enabled"), wide).otherwise(F.coalesce("_named", zero)).alias("requests")).filter("requests > 0")


def unnest_pages(pages: DataFrame, by: list[str], page: str, body: str, record: str, max_records: int | None = None, mark: str | None = None) -> DataFrame:
    """The records of a paged listing: by, page, at (place in the page) and the record's fields.

    body: an envelope {"results": [...]}; the first page that is empty or missing (null, as after a 404) ends a
    listing. record: the schema of one result. max_records: where each listing ends at the latest, or, with mark, up to
    where that column is true; then no record is left out. Pages are read
    twice: once for their sizes, one row a page, whose running sums tell each page's end and what it has left; and once
    for the records. Numbers of pages are distinct in a listing; a page without one is left out.
    """
    keyed = pages.filter(F.col(page).isNotNull()).withColumn("_k", group_key(*by, page)).withColumn("_r", F.from_json(body, f"results array<struct<{record}>>")["results"])
    upto = Window.partitionBy(*by).orderBy(page).rowsBetween(Window.unboundedPreceding, 0)
    sizes = keyed.select("_k", *by, page, F.greatest(F.coalesce(F.size("_r"), F.lit(0)), F.lit(0)).alias("_n"))
    sizes = sizes.withColumn("_ended", F.max(F.col("_n") == 0).over(upto)).withColumn("_left", F.lit(max_records) - F.sum("_n").over(upto) + F.col("_n"))
    cut = max_records is not None and mark is None
    kept = sizes.filter(~F.col("_ended")).filter(F.col("_left") > 0 if cut else F.lit(True)).select("_k", "_left")
    whole = keyed.join(kept, "_k")
    records = F.slice("_r", F.lit(1), F.col("_left").cast("int")) if cut else F.col("_r")
    within = [] if mark is None else [F.coalesce(F.col("at") < F.col("_left"), F.lit(True)).alias(mark)]
    return whole.select(*by, page, "_left", F.posexplode(records).alias("at", "r")).select(*by, page, "at", "r.*", *within)
