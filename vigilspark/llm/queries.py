"""The registered queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilspark.llm import bpe, conversations, exact_dedup, fingerprints, hard_negatives, jaccard_join, language_id, line_dedup, packing, pii, quality, token_counts, url_filters
from vigilspark.llm.common import read


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer("byte_bpe_multi_50k.tiktoken")
    both = bpe.decode(bpe.encode(read(spark, sf_dir, "documents"), path), path)
    return both.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("deduped").cast("binary"), 256).alias("text_sha256"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.filter_urls(read(spark, sf_dir, "pages"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_groups(read(spark, sf_dir, "documents"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_neighbours(read(spark, sf_dir, "documents"))


def fold(n: int) -> Column:
    """crc32 of doc_id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.learn(docs, read(spark, sf_dir, "labels").filter(fold(5) != 0))
    return quality.score(docs, model).select("doc_id", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    filters = language_id.learn(docs.filter(fold(3) != 1))
    return language_id.identify(docs, filters).select("doc_id", F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damaged(read(spark, sf_dir, "conversations")), "copies")


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(read(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


QUERIES = {f.__name__: f for f in (op1_byte_bpe, op2_line_dedup, op3_exact_dedup, op4_token_counts, op5_packing, op6_url_filters, op7_ngram_jaccard, op8_fingerprints, op9_quality, op10_language_id, op11_conversations, op12_pii, op13_hard_negatives)}
SQL = {"op2_line_dedup": line_dedup.SQL, "op3_exact_dedup": exact_dedup.SQL, "op6_url_filters": url_filters.SQL, "op13_hard_negatives": hard_negatives.SQL}
