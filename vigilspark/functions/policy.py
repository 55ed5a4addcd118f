"""Robots directives, visiting windows and intervals as column expressions.

A robots file is parsed once for each different body of an Arrow batch: delays and path rules by the standard
library's parser, which knows agent groups, and the two directives it ignores by a small line grammar. What
comes out is a struct, so policies and rules apply to any number of URLs as built-in expressions.
"""

from __future__ import annotations

from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: US zone abbreviations (and UTC) that robots files use.
ZONES = {
    "EST": "America/New_York",
    "EDT": "America/New_York",
    "CST": "America/Chicago",
    "CDT": "America/Chicago",
    "MST": "America/Denver",
    "MDT": "America/Denver",
    "PST": "America/Los_Angeles",
    "PDT": "America/Los_Angeles",
    "UTC": "UTC",
    "GMT": "UTC",
}
POLICY = "struct<min_interval:double,start_min:int,end_min:int,zone:string>"
RULES = "array<struct<allow:boolean,path:string>>"
AGENT = "vigilspark"


def directives(body: str) -> list[tuple[str, str]]:
    """Lower-case keys and values of a robots file's lines, without comments."""
    out = []
    for line in body.splitlines():
        key, colon, value = line.partition("#")[0].partition(":")
        if colon:
            out.append((key.strip().lower(), value.strip()))
    return out


def _number(text: str) -> float | None:
    """The decimal number that a value starts with."""
    whole = text[: len(text) - len(text.lstrip("0123456789"))]
    rest = text[len(whole) + 1 :] if text[len(whole) :].startswith(".") else ""
    part = rest[: len(rest) - len(rest.lstrip("0123456789"))]
    return float(f"{whole}.{part or 0}") if whole else None


def _clock(text: str) -> tuple[int, str] | None:
    """Minute of day and zone letters of a time such as 23:00EDT; hours count modulo 24."""
    hour, _, rest = text.strip().partition(":")
    minute, zone = rest[:2], rest[2:].strip()
    zone = zone[: len(zone) - len(zone.lstrip("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"))]
    if not (hour.isdigit() and len(hour) < 3 and minute.isdigit() and len(minute) == 2 and int(minute) < 60 and zone):
        return None
    return int(hour) % 24 * 60 + int(minute), zone.upper()


def parsed(body: str, agent: str = AGENT) -> dict:
    """min_interval, start_min, end_min, zone and rules of a robots file, for an agent.

    The first Hit-rate goes before the agent's Crawl-delay, even when smaller. The window's zone is the start's;
    an unknown one means no window. rules: those of the agent's group in order, of which the first that fits decides.
    """
    lines = body.splitlines()
    parser = RobotFileParser()
    parser.parse(lines)
    found = directives(body)
    rates = [n for key, value in found if key == "hit-rate" and (n := _number(value)) is not None]
    delay = parser.crawl_delay(agent)
    out = {"min_interval": rates[0] if rates else None if delay is None else float(delay), "start_min": None, "end_min": None, "zone": None}
    for key, value in found:
        start, dash, end = value.partition("-")
        if key == "visiting-hours" and dash and (a := _clock(start)) and (b := _clock(end)):
            if a[1] in ZONES:
                out |= {"start_min": a[0], "end_min": b[0], "zone": ZONES[a[1]]}
            break
    group = next((e for e in parser.entries if e.applies_to(agent)), parser.default_entry)
    out["rules"] = [{"allow": line.allowance, "path": line.path} for line in group.rulelines] if group else []
    return out


def robots(body: Column, agent: str = AGENT) -> Column:
    """Struct of POLICY's fields and rules; null without a body."""

    @F.pandas_udf(POLICY[:-1] + f",rules:{RULES}>")
    def each(bodies: pd.Series) -> pd.DataFrame:
        known = {b: parsed(b, agent) for b in bodies.dropna().unique()}
        empty = dict.fromkeys(("min_interval", "start_min", "end_min", "zone", "rules"))
        out = pd.DataFrame([known.get(b, empty) for b in bodies], columns=list(empty), dtype=object)
        return out.astype({"min_interval": "float64", "start_min": "Int32", "end_min": "Int32"})

    return each(body)


def policy(body: Column, agent: str = AGENT) -> Column:
    """Interval and window of a robots file."""
    r = robots(body, agent)
    return F.struct(r["min_interval"].alias("min_interval"), r["start_min"].alias("start_min"), r["end_min"].alias("end_min"), r["zone"].alias("zone"))


def rule_path(url: Column) -> Column:
    """What path rules are compared with: all behind the host, decoded and encoded anew; / for none."""
    rest = F.regexp_replace(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?(.*)$", 1), "[?#]$", "")
    plain = F.coalesce(F.try_url_decode(F.replace(rest, F.lit("+"), F.lit("%2B"))), rest)
    coded = F.url_encode(plain)
    for code, char in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        coded = F.replace(coded, F.lit(code), F.lit(char))
    return F.coalesce(F.nullif(coded, F.lit("")), F.lit("/"))


def first_fit(rules: Column, path: Column) -> Column:
    """What the first rule that fits a path says; null without one."""
    return F.get(F.filter(rules, lambda r: (r["path"] == "*") | F.startswith(path, r["path"])), F.lit(0))["allow"]


def allowed(rules: Column, url: Column) -> Column:
    """Whether the first rule that fits a URL allows it; without one it is allowed."""
    return F.coalesce(first_fit(rules, rule_path(url)), F.lit(True))


def restricts(p: Column) -> Column:
    return p["min_interval"].isNotNull() | p["zone"].isNotNull()


def local_minute(now: Column, zone: Column) -> Column:
    """Minute of day, with fractions, of a UTC time in a zone."""
    local = F.from_utc_timestamp(now, zone)
    return F.hour(local) * 60 + F.minute(local) + F.second(local) / 60


def open_now(p: Column, now: Column) -> Column:
    """Whether a window [start, end), which may pass midnight, is open; none: always; start equal to end: never."""
    at, start, end = local_minute(now, p["zone"]), p["start_min"], p["end_min"]
    return F.when(p["zone"].isNull(), True).when(start <= end, (start <= at) & (at < end)).otherwise((at >= start) | (at < end))


def next_open(p: Column, now: Column) -> Column:
    """The next opening in UTC; null while open."""
    local = F.from_utc_timestamp(now, p["zone"])
    today = F.date_trunc("day", local) + F.make_dt_interval(mins=p["start_min"])
    opening = F.when(today <= local, today + F.expr("INTERVAL 1 DAY")).otherwise(today)
    return F.when(~open_now(p, now), F.to_utc_timestamp(opening, p["zone"]))


def described(p: Column) -> Column:
    """The window in 12-hour form, with its zone."""
    clock = lambda m: F.concat(F.when(F.floor(m / 60) % 12 == 0, F.lit("12")).otherwise((F.floor(m / 60) % 12).cast("string")), F.lit(":"), F.lpad((m % 60).cast("string"), 2, "0"), F.when(m < 720, F.lit(" AM")).otherwise(" PM"))
    return F.when(p["zone"].isNotNull(), F.concat(clock(p["start_min"]), F.lit("–"), clock(p["end_min"]), F.lit(" "), F.replace(p["zone"], F.lit("_"), F.lit(" "))))


def effective_interval(rate: Column, p: Column) -> Column:
    """Seconds between requests: the longer of one over our rate and what the host asks for."""
    own = F.when(rate > 0, 1 / rate).otherwise(F.lit(0.0))
    return F.greatest(own, F.coalesce(p["min_interval"], F.lit(0.0)))


def to_json(p: Column) -> Column:
    """The stored form: min_interval_seconds, and visiting_hours as null or start, end and zone."""
    clock = lambda m: F.format_string("%02d:%02d:00", F.floor(m / 60).cast("int"), (m % 60).cast("int"))
    hours = F.when(p["zone"].isNotNull(), F.struct(clock(p["start_min"]).alias("start"), clock(p["end_min"]).alias("end"), p["zone"].alias("zone")))
    return F.to_json(F.struct(p["min_interval"].alias("min_interval_seconds"), hours.alias("visiting_hours")), {"ignoreNullFields": "false"})


def from_json(text: Column) -> Column:
    """The policy of its stored form; null if the text is no such form."""
    stored = F.from_json(text, "min_interval_seconds double, visiting_hours struct<start:string,end:string,zone:string>, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    hours = stored["visiting_hours"]
    minute = lambda c: (F.substring(c, 1, 2).try_cast("int") * 60 + F.substring(c, 4, 2).try_cast("int"))
    p = F.struct(stored["min_interval_seconds"].alias("min_interval"), minute(hours["start"]).alias("start_min"), minute(hours["end"]).alias("end_min"), hours["zone"].alias("zone"))
    return F.when(stored["_bad"].isNull() & text.isNotNull(), p)
