"""URL allow and block lists by longest match.

The rules form a trie: first the host's labels from the right, then the path's segments. A rule's last
path segment may be the start of a longer one, so it hangs on its parent segment as a partial: a segment is
looked up by its starts of the lengths that occur there, longest first. The trie is broadcast when the rules number at most MAX_BROADCAST_RULES; longer lists take the shuffle join on
every (host suffix, path prefix) that some rule's shape allows.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_BROADCAST_RULES = 100_000
SCHEMA = "page_id bigint, host string, path string, rule string, verdict string"
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))


def add_rule(trie: dict, host: str, path: str, verdict: str) -> None:
    node = trie
    for label in reversed(host.split(".")):
        node = node.setdefault("labels", {}).setdefault(label, {})
    node = node.setdefault("paths", {})
    *segments, last = path.split("/")
    for segment in segments:
        node = node.setdefault("segments", {}).setdefault(segment, {})
    partials = node.setdefault("partials", {})
    if last not in partials:  # of a rule given twice, the first stands
        partials[last] = (host + path, verdict)
        lengths = node.setdefault("lengths", [])
        at = bisect.bisect_left(lengths, len(last))
        if lengths[at : at + 1] != [len(last)]:
            lengths.insert(at, len(last))


def longest(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """(rule, verdict) of the rule with the longest host, then the longest path, that fits."""
    nodes, node = [], trie
    for label in reversed(host.split(".")):
        node = node.get("labels", {}).get(label)
        if node is None:
            break
        if "paths" in node:
            nodes.append(node["paths"])
    segments = path.split("/")
    best = None
    for depth, node in enumerate(nodes):
        for k, segment in enumerate(segments):
            lengths = node.get("lengths", ())
            for size in reversed(lengths[: bisect.bisect_right(lengths, len(segment))]):
                found = node["partials"].get(segment[:size])
                if found:
                    rule, verdict = found
                    best = max(best or (-1, -1, -1), (len(rule), depth, k, rule, verdict))
                    break
            node = node.get("segments", {}).get(segment)
            if node is None:
                break
    return best and best[3:]


def split_url(df: DataFrame, url: str) -> DataFrame:
    """Adds host and path. Null urls and those without :// have both empty."""
    rest = F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://(.*)$", 1), F.lit(""))
    return df.withColumn("_rest", rest).withColumn("host", F.translate(F.regexp_extract("_rest", r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).withColumn("path", F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1)).drop("_rest")


def filter_urls(
    pages: DataFrame,
    rules: Iterable[tuple[str, str, str]] | DataFrame = RULES,
    default: str = "allow",
    id_col: str = "page_id",
    url_col: str = "url",
    max_broadcast: int = MAX_BROADCAST_RULES,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    rules: (host, path, allow or block). A rule fits its host and subdomains when the path starts with the
    rule's; the longest rule wins, and of rules given twice, block. A page that no rule fits has a null rule
    and the default verdict (allow). Null urls: host and path are empty. Repeated pages each get a row; empty
    tables give empty results; other columns are not read.
    """
    urls = split_url(pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("_url")), "_url").select("page_id", "host", "path")
    if isinstance(rules, DataFrame):
        rules = rules.select("host", "path", "verdict")
        held = rules.limit(max_broadcast + 1).collect()
        if len(held) > max_broadcast:
            return _joined(urls, rules, default)
    else:
        held = list(rules)
        if len(held) > max_broadcast:
            return _joined(urls, pages.sparkSession.createDataFrame(held, "host string, path string, verdict string"), default)
    trie: dict = {}
    for host, path, verdict in sorted(map(tuple, held), key=lambda r: r[2] != "block"):
        add_rule(trie, host, path, verdict)
    shared = pages.sparkSession.sparkContext.broadcast(trie)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = shared.value
        for batch in batches:
            found = [longest(root, h, p) for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("host"), batch.column("path"), pa.array([f and f[0] for f in found], pa.string()), pa.array([f[1] if f else default for f in found], pa.string())],
                ["page_id", "host", "path", "rule", "verdict"],
            )

    return urls.mapInArrow(judge, f"page_id {dict(urls.dtypes)['page_id']}, " + SCHEMA.partition(", ")[2])


def _joined(urls: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same for lists of any length: each distinct (host, path) meets the rules by equality of host suffix and path length's prefix."""
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block > allow
    shapes = rules.select(F.col("host").alias("r_host"), F.length("path").alias("r_len")).distinct()
    labels = F.split("host", r"\.")
    keys = (
        urls.select("host", "path").distinct()
        .withColumn("r_host", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))))
        .join(shapes, "r_host")
        .filter(F.col("r_len") <= F.length("path"))
        .withColumn("r_path", F.expr("substring(path, 1, r_len)"))
    )
    fits = keys.join(rules.select(F.col("host").alias("r_host"), F.col("path").alias("r_path"), "verdict"), ["r_host", "r_path"])
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct(F.concat("r_host", "r_path").alias("rule"), "verdict"), F.struct(F.length("r_host") + F.length("r_path"), F.length("r_host"))).alias("best"))
    return urls.join(best, ["host", "path"], "left").select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


SQL = r"""
WITH r AS (SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
rules(rh, rp, rv) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
hosts AS (SELECT DISTINCT host, path FROM u),
fit AS (SELECT host, path, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(rv, length(rh || rp)) AS rv
        FROM hosts JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY host, path)
SELECT page_id, u.host, u.path, rule, coalesce(rv, 'allow') AS verdict
FROM u LEFT JOIN fit ON u.host = fit.host AND u.path = fit.path
"""
