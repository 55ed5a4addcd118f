"""A corpus from raw documents in five stages, each of which reads what the one before it wrote.

Language ID drops documents without a language; the quality classifier drops what scores below its
threshold; line dedup removes repeated passages and drops documents of which nothing is left; of each group
of near duplicates one document stays; the rest is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilspark.llm import jaccard_join, language_id, line_dedup, packing, quality
from vigilspark.llm.common import drop, read, written
from vigilspark.llm.queries import tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: A stage's rules need SQL that can't express models and hashed files, so there is none; tests compare with brute force.
ORACLE_SQL = None


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is und (no text or no letter). The filters learn from all documents of docs with a language.

    Where no document has one, nothing can be told apart: then those without a letter go, and all others stay.
    """
    filters, verdict = language_id.learn(docs), language_id.UNKNOWN
    if not filters.names:
        return docs.filter(F.coalesce("text", F.lit("")).rlike(r"\p{L}")).select(*COLUMNS)
    return language_id.tagged(docs, filters).filter(F.col("lang_pred") != verdict).select(*COLUMNS)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score below the threshold, by a model of all labels."""
    model = quality.learn(docs, read(spark, sf_dir, "labels"))
    return quality.tagged(docs, model).filter(F.col("predicted") == 1).select(*COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes later occurrences of three-line windows. Documents that lose all their lines go; n_chars is of the text that is left."""
    left = line_dedup.dedup_lines(docs).filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    text = F.when(F.col("n_removed") == 0, F.col("text")).otherwise(F.col("deduped"))
    chars = F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(F.length("deduped").cast("bigint"))
    return left.select("doc_id", text.alias("text"), "lang", "source", chars.alias("n_chars"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents one row stays, of the smallest id; documents without words link with nothing.

    Rows that share an id are one document, of which the least row stays. A null id is a document of its own text, and comes last.
    """
    own = F.col("doc_id").cast("bigint")
    rows = docs.withColumn("_key", F.coalesce(own, F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 2) + F.lit((1 << 62) - 1)))
    groups = jaccard_join.jaccard_groups(rows, id_col="_key").filter("doc_id = component_id")
    stays = written(groups.groupBy(F.col("doc_id").alias("_key")).agg(F.count("*").alias("n")), "stays")
    single = rows.join(stays.filter("n = 1"), "_key", "left_semi").select(*COLUMNS)
    least = F.min(F.struct("text", *(c for c in COLUMNS if c != "text"))).alias("r")
    return single.union(rows.join(stays.filter("n > 1"), "_key", "left_semi").groupBy("_key").agg(least).select(*(F.col(f"r.{c}") for c in COLUMNS)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens."""
    pieces = packing.pack(docs, tokenizer("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language_id", identified),
    ("quality", good),
    ("line_dedup", without_repeats),
    ("ngram_jaccard", one_of_each_group),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's result is written to the shared folder and read again. Once the next one's is written it is removed; what the last reads stays."""
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
            if k:
                drop(before)
    return docs
