"""Exact dedup of whole texts by a heavy-hitter split, with built-in functions only.

Every text is read and hashed once; ids and digests are written as a table, on which all else works.
Misra-Gries (DataFrame.stat.freqItems, whose counters merge across partitions) names at most
1 / SUPPORT digests that may be frequent. One aggregation with map-side partial sums verifies
these: it counts them exactly and finds the row that stays. The winners, whose number is bounded,
are broadcast, so rows of large groups are decided where they are read and never meet in a task.
All other digests, whose groups have under SUPPORT of the rows, take the ordinary shuffle: a grouping
with partial sums and a plain join, so no group has to fit in a task. Only digests and ids move, never texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilspark.llm.common import written

#: Digests with more than this share of all rows count as heavy: at most 1 / SUPPORT of them.
SUPPORT = 0.001


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; null counts as empty. Of equal texts the largest id stays; a null id
    stays only if its group has no other. Rows that repeat an id and its text share its verdict: all are
    marked kept, and all count in group_size. An empty table gives an empty result. Other columns of docs
    are not read.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary"), 256).alias("text_sha256"))
    rows = written(rows, "digests")
    candidates = rows.select("text_sha256").stat.freqItems(["text_sha256"], support).select(F.explode("text_sha256_freqItems").alias("text_sha256"))
    verdict = [F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")]
    heavy = rows.join(F.broadcast(candidates), "text_sha256", "left_semi").groupBy("text_sha256").agg(*verdict)
    split = rows.join(F.broadcast(heavy), "text_sha256", "left")
    rest = split.filter(F.col("group_size").isNull()).select("doc_id", "text_sha256")
    light = rest.join(rest.groupBy("text_sha256").agg(*verdict), "text_sha256").select("doc_id", "text_sha256", "keep_id", "group_size")
    return (
        split.filter(F.col("group_size").isNotNull())
        .select("doc_id", "text_sha256", "keep_id", "group_size")
        .unionByName(light)
        .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    )


SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, h AS text_sha256
FROM (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents)
WINDOW g AS (PARTITION BY h)
"""
