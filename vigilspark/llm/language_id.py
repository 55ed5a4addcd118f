"""Language identification by language-bitmask n-gram filters.

Each language's most frequent byte four-grams go into one bit-sliced Bloom filter: slot i holds a mask with
a bit for every language, so the masks at an n-gram's HASHES slots, combined by and, are all languages that
contain it. A text's n-grams are looked up at once; the popcount of each language's bit, corrected for the
false positives that its fill makes likely, decides.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilspark.llm.common import free_name, raw, slices, texts_only
from vigilspark.llm.shingles import mix

#: Documents of each language that are learned from, in expectation; chosen by a hash of the id.
LEARN_DOCS = 600
#: N-grams kept of each language.
KEPT = 4096
SLOTS, HASHES = 1 << 18, 3
#: Languages that can be told apart; more are an error.
MAX_LANGUAGES = 1024
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}").search


@functools.cache
def _lower() -> np.ndarray:
    """Bytes as n-grams see them: A-Z lower-cased, other ASCII but letters as a blank, the rest as it is."""
    table = np.full(256, 32, np.uint8)
    table[97:123] = table[65:91] = np.arange(97, 123)
    table[128:] = np.arange(128, 256)
    return table


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The four-grams of each text as 32-bit numbers, without those of two blanks or more, and their number in each text."""
    folded = pa.array([f" {t.lower()} " for t in texts.to_pylist()], pa.string())  # words at the ends have their edges too
    data, ends = raw(folded)
    x = _lower()[data].astype(np.uint32)
    if len(x) < 4:
        return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
    code = (x[:-3] << np.uint32(24)) | (x[1:-2] << np.uint32(16)) | (x[2:-1] << np.uint32(8)) | x[3:]
    blank = (x == 32).astype(np.int8)
    ok = blank[:-3] + blank[1:-2] + blank[2:-1] + blank[3:] < 2
    doc = np.repeat(np.arange(len(texts)), np.diff(ends))
    ok &= doc[:-3] == doc[3:]
    return code[ok], np.bincount(doc[:-3][ok], minlength=len(texts))


def slots(codes: np.ndarray) -> list[np.ndarray]:
    h = mix(codes.astype(np.uint64) + np.uint64(0x5DEECE66D))
    return [((h >> np.uint64(20 * k)) % np.uint64(SLOTS)).astype(np.int64) for k in range(HASHES)]


class Filters:
    """The bit-sliced filter and each language's rate of false positives."""

    def __init__(self, found: dict[str, np.ndarray], rows: dict[str, int] | None = None):
        """found: each language's n-grams. rows: how many rows each has; of languages that fit alike, the one with more is taken."""
        self.names = sorted(found, key=lambda name: (-(rows or {}).get(name, 0), name))
        self.masks = np.zeros((max(1, -(-len(found) // 64)), SLOTS), np.uint64)
        self.false = np.zeros(len(found))
        for k, name in enumerate(self.names):
            bit = np.uint64(1 << (k % 64))
            for at in slots(found[name]):
                np.bitwise_or.at(self.masks[k // 64], at, bit)
            self.false[k] = ((self.masks[k // 64] & bit) > 0).mean() ** HASHES

    def counts(self, codes: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Corrected number of each text's n-grams (rows) that each language (columns) contains."""
        out = np.zeros((len(n), len(self.names)))
        at, doc = slots(codes), np.repeat(np.arange(len(n)), n)
        for word, masks in enumerate(self.masks):
            both = masks[at[0]]
            for a in at[1:]:
                both = both & masks[a]
            for k in range(64 * word, min(len(self.names), 64 * word + 64)):
                has = (both >> np.uint64(k % 64)) & np.uint64(1)
                out[:, k] = np.bincount(doc, weights=has, minlength=len(n))
        return np.maximum(0.0, (out - n[:, None] * self.false) / (1 - self.false))

    def decide(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        codes, n = grams(texts)
        found = self.counts(codes, n) if self.names else np.zeros((len(n), 1))
        best, total = found.argmax(1), found.sum(1)
        score = np.where(total > 0, found.max(1) / np.maximum(total, 1e-9), 0.0)
        named = [self.names[b] if self.names and _LETTER(t) else UNKNOWN for t, b in zip(texts.to_pylist(), best, strict=True)]
        return named, np.array([s if name != UNKNOWN else 0.0 for name, s in zip(named, score, strict=True)])


def learn(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", learn_docs: int = LEARN_DOCS, kept: int = KEPT) -> Filters:
    """Filters from the rows of docs with a language, of which a hash of the id (of the text, where the id is null) picks about learn_docs for each.

    Counting the languages reads all rows; each language's share then picks its rows where they are read.
    """
    rows = texts_only(docs, id_col, text_col, lang_col).withColumnRenamed(lang_col, "lang").filter("lang IS NOT NULL")
    shares = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(shares) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not shares:
        return Filters({})
    draw = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.col("text"))), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rate = F.create_map(*(x for name, n in shares.items() for x in (F.lit(name), F.lit(min(1.0, learn_docs / n)))))
    picked = rows.filter(draw < F.element_at(rate, F.col("lang"))).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            codes, n = grams(batch.column("text"))
            lang = np.repeat(np.array(batch.column("lang").to_pylist(), object), n)
            for name in set(batch.column("lang").to_pylist()):
                values, k = np.unique(codes[lang == name], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(values), pa.string()), pa.array(values.astype(np.int64)), pa.array(k.astype(np.int64))], ["lang", "code", "k"])

    counted = picked.mapInArrow(count, "lang string, code bigint, k bigint").groupBy("lang", "code").agg(F.sum("k").alias("k"))
    top = counted.groupBy("lang").agg(F.slice(F.sort_array(F.collect_list(F.struct("k", "code")), asc=False), 1, kept).alias("top"))  # of a bounded sample
    return Filters({r["lang"]: np.array([x["code"] for x in r["top"]], np.uint32) for r in top.collect()}, shares)


def identify(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, lang_pred, score.

    lang_pred is a learned language, or und for null texts and those without a letter; of equals, the one
    with more learned rows, then the first by name. score: the language's share of all languages' corrected counts, 0 for und or when no n-gram is
    known. Whole texts are read; repeated rows each get a row; an empty table gives an empty result.
    """
    rows = texts_only(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(filters)  # SLOTS * 8 bytes for each 64 languages

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            names, score = shared.value.decide(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(step, f"doc_id {dict(rows.dtypes)['doc_id']}, lang_pred string, score double")


def tagged(docs: DataFrame, filters: Filters, text_col: str = "text") -> DataFrame:
    """docs with lang_pred and score added to each row (replacing columns of these names), in the same pass."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    own = free_name("_text", names)
    rows = docs.select(*(F.col(f"`{c}`") for c in names), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias(own))
    out = rows.drop(own).withColumn("lang_pred", F.lit("")).withColumn("score", F.lit(0.0))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, own):
            found, score = shared.value.decide(batch.column(own))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(found, pa.string()), pa.array(score)], [*names, "lang_pred", "score"])

    return rows.mapInArrow(step, out.schema)
