"""Line dedup by overlapping windows of three lines, with built-in functions only.

Every three consecutive lines of a text are one window, named by two 64-bit hashes. A window that comes
more than once in the corpus is repeated; its first occurrence, by (doc_id, text, line), stays and all later
ones cover their three lines. A text loses its covered lines: its covered positions, merged and sorted, cut
it into the runs of lines that stay. Counting windows sums up before the shuffle, so a line that a third of
all texts share costs one row per task, and the join that finds later occurrences is a plain one whose hot
keys Spark splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 3
_LAST = (1 << 63) - 1


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs, with all its columns, and n_lines, n_removed, deduped (the text that is left).

    Lines end at \\n only. Windows of white space alone never count as repeated. Texts of fewer than three
    lines have no window and stay as they are; null and empty texts count as one empty line, and a null
    text's deduped is empty. A later occurrence that overlaps the first one in the same text covers only the
    lines behind it, so one occurrence is always left whole. Rows that repeat an id and its text are one
    document, with one result. Whole numbers as ids are in order of number, others in order of their text; a
    null id comes last. A text with all its lines covered is left empty. Columns of docs with these names are
    replaced, other names are free; an empty table gives an empty result.
    """
    given = F.col(f"`{id_col}`")
    if dict(docs.dtypes)[id_col] in ("tinyint", "smallint", "int", "bigint"):
        oid = F.coalesce(given.cast("bigint"), F.lit(_LAST))
    else:
        oid = F.when(given.isNull(), "1").otherwise(F.concat(F.lit("0"), given.cast("string")))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(oid.alias("id"), text.alias("t")).select("id", F.xxhash64("t").alias("h"), F.split("t", "\n").alias("lines"))
    hashes = rows.select("id", "h", F.transform("lines", lambda x: F.struct(F.xxhash64(x).alias("v"), F.trim(F.regexp_replace(x, r"\s", "")).eqNullSafe(F.lit("")).alias("blank"))).alias("v"))
    hashes = hashes.filter(F.size("v") >= WINDOW)
    three = lambda i: [F.get("v", i + k) for k in range(WINDOW)]

    def window(i: Column) -> Column:
        a, b, c = three(i)
        return F.struct(F.xxhash64(a["v"], b["v"], c["v"]).alias("p"), F.xxhash64(c["v"], F.lit(WINDOW), a["v"], b["v"]).alias("q"), (a["blank"] & b["blank"] & c["blank"]).alias("blank"))

    windows = (
        hashes.select("id", "h", F.posexplode(F.transform(F.sequence(F.lit(0), F.size("v") - WINDOW), window)).alias("line", "w"))
        .filter(~F.col("w.blank")).select("id", "h", "line", "w.p", "w.q")
    )
    repeated = windows.groupBy("p", "q").agg(F.min(F.struct("id", "h", "line")).alias("first"), F.count("*").alias("n")).filter("n > 1").select("p", "q", "first")
    here = (F.col("id") == F.col("first.id")) & (F.col("h") == F.col("first.h"))
    start = F.when(here, F.greatest(F.col("line"), F.col("first.line") + WINDOW)).otherwise(F.col("line"))
    later = windows.join(repeated, ["p", "q"]).filter(~(here & (F.col("line") == F.col("first.line")))).select("id", "h", start.alias("a"), (F.col("line") + WINDOW - 1).alias("b")).filter("a <= b")
    covered = later.groupBy("id", "h").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.sequence("a", "b"))))).alias("gone"))

    gone = F.col("gone")
    runs = F.transform(
        F.sequence(F.lit(0), F.size(gone)),
        lambda i: F.slice("lines", F.when(i == 0, 0).otherwise(F.get(gone, i - 1) + 1) + 1, F.when(i == F.size(gone), F.size("lines")).otherwise(F.get(gone, i)) - F.when(i == 0, 0).otherwise(F.get(gone, i - 1) + 1)),
    )
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed", "deduped")]
    own = F.struct(*(F.col(f"`{c}`") for c in names)).alias("own")  # the caller's columns, apart from the names in use here
    return (
        docs.select(own, oid.alias("id"), F.xxhash64(text).alias("h"), text.alias("t"))
        .join(covered, ["id", "h"], "left")
        .withColumn("gone", F.coalesce("gone", F.array().cast("array<int>"))).withColumn("lines", F.split("t", "\n"))
        .select(
            "own.*",
            F.size("lines").cast("bigint").alias("n_lines"),
            F.size("gone").cast("bigint").alias("n_removed"),
            F.when(F.size("gone") == 0, F.col("t")).otherwise(F.array_join(F.flatten(runs), "\n")).alias("deduped"),
        )
    )


SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
w AS (SELECT doc_id, p - 1 AS line, l[p] AS a, l[p + 1] AS b, l[p + 2] AS c
      FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS p FROM d)),
v AS (SELECT doc_id, line, first_value(doc_id) OVER o AS fd, first_value(line) OVER o AS fl
      FROM w WHERE regexp_matches(a || b || c, '\S') WINDOW o AS (PARTITION BY a, b, c ORDER BY doc_id, line)),
g AS (SELECT DISTINCT doc_id, unnest(range(CASE WHEN doc_id = fd THEN greatest(line, fl + 3) ELSE line END, line + 3)) AS line
      FROM v WHERE NOT (doc_id = fd AND line = fl)),
x AS (SELECT doc_id, l[p] AS s, p - 1 AS line FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS p FROM d)),
k AS (SELECT x.doc_id, count(*) AS n_lines, count(g.line) AS n_removed,
             coalesce(string_agg(s, chr(10) ORDER BY x.line) FILTER (WHERE g.line IS NULL), '') AS t
      FROM x LEFT JOIN g ON x.doc_id = g.doc_id AND x.line = g.line GROUP BY x.doc_id)
SELECT doc_id, n_lines, n_removed, sha256(t) AS text_sha256 FROM k
"""
