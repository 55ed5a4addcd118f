"""Request logs: outcomes, retries, pacing and silence, each by one window per origin or URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Status codes that are tried again, and the longest wait in seconds.
RETRYABLE = (429, 500, 502, 503, 504)
MAX_WAIT = 120.0


def seconds_between(earlier: Column, later: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", earlier, later) / F.lit(1_000_000.0)


def outcomes(log: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Per origin: requests, status classes, throttled, latency. The median is off by 1 / accuracy of the ranks at most."""
    s, ms = F.col("status"), F.col("elapsed_ms")
    return log.filter(F.col("message") == "http_request").groupBy("origin").agg(
        F.count("*").alias("requests"),
        F.count_if((s >= 200) & (s < 300)).alias("ok"),
        F.count_if((s >= 400) & (s < 500)).alias("client_errors"),
        F.count_if(s >= 500).alias("server_errors"),
        F.count_if(s == 429).alias("throttled"),
        F.round(F.avg(ms), 4).alias("avg_ms"),
        F.round(F.percentile_approx(ms, 0.5, accuracy), 4).alias("p50_ms"),
    )


def retry_chains(log: DataFrame) -> DataFrame:
    """Adds chain (per URL, from 1) and attempt: a request goes on with a chain when the one before it could be tried again.

    Rows meet by URL and day, so a busy URL is many tasks. Of each day one row tells how many chains start in it
    behind its first request, how long the last of them is, and whether that can go on; running sums over these
    rows tell each day which chain it goes on with, and how many attempts that has had. A null URL is a URL like any
    other; rows without a time come first.
    """
    rows = spanned(log, ["url"], F.to_date("ts"))
    order = Window.partitionBy("_k").orderBy("ts", "event_id")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    again = F.coalesce(F.col("status").isin(*RETRYABLE), F.lit(False))
    rows = rows.withColumn("_again", again).withColumn("_n", F.row_number().over(order))
    rows = rows.withColumn("_start", F.when((F.col("_n") > 1) & ~F.lag("_again").over(order), F.col("_n")))
    rows = rows.withColumn("_local", F.count("_start").over(upto)).withColumn("_from", F.max("_start").over(upto))
    own = rows.groupBy("_k").agg(F.max("_n").alias("_rows"), F.count("_start").alias("_starts"), F.max("_start").alias("_last"), F.max_by("_again", "_n").alias("_open"))
    by = Window.partitionBy("_k.g").orderBy("_k.s")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    own = own.withColumn("_goes_on", F.coalesce(F.lag("_open").over(by), F.lit(False)))
    first = (~F.col("_goes_on")).cast("int")
    own = own.withColumn("_chains", F.coalesce(F.sum(F.col("_starts") + first).over(before), F.lit(0)) + first)
    # attempts of the open chain at a day's end: of its own last chain, or, if none starts in it, with those of the days before
    own = own.withColumn("_group", F.sum(((F.col("_starts") > 0) | ~F.col("_goes_on")).cast("int")).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    grown = F.sum(F.col("_rows") - F.coalesce(F.col("_last") - 1, F.lit(0))).over(Window.partitionBy("_k.g", "_group").orderBy("_k.s").rowsBetween(Window.unboundedPreceding, 0))
    own = own.withColumn("_tail", grown).withColumn("_had", F.when(F.col("_goes_on"), F.lag("_tail").over(by)).otherwise(0))
    both = rows.join(own.select("_k", "_chains", "_had"), "_k")
    attempt = F.when(F.col("_from").isNull(), F.col("_had") + F.col("_n")).otherwise(F.col("_n") - F.col("_from") + 1)
    return both.withColumn("chain", F.col("_chains") + F.col("_local")).withColumn("attempt", attempt.cast("int")).drop("_k", "_again", "_n", "_start", "_local", "_from", "_chains", "_had")


def expected_wait(attempt: Column, retry_after: Column | None = None) -> Column:
    """Seconds before the next attempt: a numeric Retry-After up to the limit, else 2 to the attempt; without jitter."""
    backoff = F.least(F.lit(MAX_WAIT), F.pow(F.lit(2.0), attempt))
    if retry_after is None:
        return backoff
    asked = retry_after.try_cast("double")  # a date is none
    return F.when(asked.isNotNull(), F.least(F.lit(MAX_WAIT), asked)).otherwise(backoff)


def spanned(df: DataFrame, by: list[str], span: Column) -> DataFrame:
    """Adds _k, a row's group (g) and its span (s) as one key. It is a struct, in which nulls equal nulls, so no row is lost when spans meet again by it."""
    return df.withColumn("_k", F.struct(F.struct(*(F.col(c) for c in by)).alias("g"), span.alias("s")))


def gaps(log: DataFrame, by: list[str], name: str = "gap_s") -> DataFrame:
    """Adds the seconds since the row before of the same group.

    Rows meet by group and day, so a busy group is many tasks; a day's first row takes its predecessor from the
    day before, of which one row is kept. A null in by is a group like any other. Rows without a time stay, have no
    gap and are nobody's predecessor.
    """
    days = spanned(log, by, F.to_date("ts"))
    each = days.groupBy("_k").agg(F.max("ts").alias("_last"))
    before = each.select("_k", F.lag("_last").over(Window.partitionBy("_k.g").orderBy("_k.s")).alias("_before"))
    inner = F.lag("ts").over(Window.partitionBy("_k").orderBy("ts", "event_id"))
    return days.withColumn("_lag", inner).join(before, "_k").withColumn(name, seconds_between(F.coalesce("_lag", "_before"), F.col("ts"))).drop("_k", "_lag", "_before")


def slots(log: DataFrame, at: str, interval: float, by: str = "origin", bucket: float | None = None) -> DataFrame:
    """Adds slot: start_k = max(t_k, start_(k-1) + interval) per host, as the running max of t - k * interval, plus k * interval.

    Rows meet by host and a span of time (bucket, in units of at; 2000 intervals if not given); the counts and
    maxima of a host's spans, one row each, carry on from one to the next. A null host is a host like any other;
    rows without a time get no slot and take none.
    """
    cut = spanned(log, [by], F.floor(F.col(at) / (bucket or 2000 * interval)))
    order = Window.partitionBy("_k").orderBy(at, "event_id")
    cut = cut.withColumn("_n", F.row_number().over(order).cast("bigint")).withColumn("_lead", F.col(at) - F.col("_n") * interval)
    each = cut.groupBy("_k").agg(F.count(at).alias("_rows"), F.max("_lead").alias("_most"))
    earlier = Window.partitionBy("_k.g").orderBy("_k.s").rowsBetween(Window.unboundedPreceding, -1)
    each = each.withColumn("_base", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).withColumn("_reach", F.max(F.col("_most") - F.col("_base") * interval).over(earlier))
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    cut = cut.withColumn("_run", F.max("_lead").over(upto)).join(each.select("_k", "_base", "_reach"), "_k")
    slot = F.greatest(F.col("_run") - F.col("_base") * interval, F.col("_reach")) + (F.col("_base") + F.col("_n")) * interval
    return cut.withColumn("slot", F.when(F.col(at).isNotNull(), slot)).drop("_k", "_n", "_lead", "_run", "_base", "_reach")


def last_policy(observations: DataFrame, mode: str = "store", bucket: Column | None = None) -> DataFrame:
    """Adds policy_in_force: the policy that holds after each robots observation of an origin.

    observations: origin, ts, state (loaded, absent, blocked, disallow_all) and policy (null without
    restrictions). A load with restrictions is remembered; one without keeps what is remembered but applies
    nothing now. absent applies nothing; under store it keeps what is remembered, under clear it forgets.
    blocked and disallow_all apply the remembered one. bucket: an expression that does not fall as ts grows;
    with it rows meet by origin and bucket, and one row a bucket carries the memory on. A null origin is an
    origin like any other. An observation without a time is not remembered, and remembers nothing.
    """
    if mode not in ("store", "clear"):
        raise ValueError("mode is store or clear")
    kind = dict(observations.dtypes)["policy"]
    told = F.when((F.col("state") == "loaded") & F.col("policy").isNotNull(), F.struct(F.col("policy").alias("p")))
    if mode == "clear":
        told = F.coalesce(told, F.when(F.col("state") == "absent", F.struct(F.lit(None).cast(kind).alias("p"))))
    timed = F.col("ts").isNotNull()
    span = F.when(timed, F.lit(0) if bucket is None else bucket)
    rows = spanned(observations, ["origin"], span).withColumn("_told", F.when(timed, told))
    order = Window.partitionBy("_k").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_known", F.last("_told", ignorenulls=True).over(order))
    each = rows.groupBy("_k").agg(F.max_by("_told", F.when(F.col("_told").isNotNull(), F.col("ts"))).alias("_last"))
    earlier = Window.partitionBy("_k.g").orderBy("_k.s").rowsBetween(Window.unboundedPreceding, -1)
    each = each.select("_k", F.last("_last", ignorenulls=True).over(earlier).alias("_before"))
    remembered = F.coalesce("_known", "_before")["p"]
    force = F.when(F.col("state") == "loaded", F.col("policy")).when(F.col("state").isin("blocked", "disallow_all"), remembered)
    return rows.join(each, "_k").withColumn("policy_in_force", force).drop("_k", "_told", "_known", "_before")
