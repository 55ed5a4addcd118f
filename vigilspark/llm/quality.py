"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

Each text is two streams of tokens: its words (white-space runs, A-Z lower-cased) and the words' shapes
(runs of upper case, lower case, digits and single other bytes, and whether the word before is the same). A token has a sparse random index vector,
and a frequent one also the sum of its neighbours' index vectors in the learned texts. A text's features are
the means of its tokens' vectors, by stream. A network of two layers scores them; its temperature is set on
learned rows that did not train it, so that scores are probabilities.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilspark.llm.common import free_name, raw, slices, texts_only
from vigilspark.llm.shingles import _tables, mix, word_hashes

#: Labelled rows that are learned from, at most; the first by a hash of the id.
LEARN_ROWS = 4000
DIM, NONZERO = 64, 4
#: Tokens with a context vector, at most.
CONTEXT_WORDS = 4096
HIDDEN, ROUNDS, RATE, DECAY = 32, 400, 0.01, 1e-3
THRESHOLD = 0.3


@functools.cache
def _classes() -> np.ndarray:
    """Upper case, lower case, digit, beyond ASCII; each other byte for itself."""
    table = np.arange(256)
    table[65:91], table[97:123], table[48:58], table[128:] = 65, 97, 48, 128
    return table


def shape_hashes(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the words' shapes: of class runs, each run counted once."""
    classes = _classes()[data]
    space = _tables()[0][data]
    change = np.ones(len(data), bool)
    change[1:] = classes[1:] != classes[:-1]
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    start = ~space & (edge[:-1] | np.concatenate([[True], space[:-1]]))
    keep = ~space & (change | start)
    word = np.cumsum(start)[keep] - 1
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else np.zeros(0, np.int64)
    place = np.arange(len(word)) - first[word] if len(word) else word
    if not len(first):
        return np.zeros(0, np.uint64)
    return mix(np.add.reduceat(mix(classes[keep].astype(np.uint64) + (np.minimum(place, 6).astype(np.uint64) << np.uint64(9))), first))


def streams(texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """Token hashes of both streams and the texts' numbers of words."""
    data, ends = raw(texts)
    words, n = word_hashes(data, ends)
    shapes = shape_hashes(data, ends)
    again = np.zeros(len(words), bool)
    again[1:] = words[1:] == words[:-1]
    return [words, np.where(again, mix(shapes), shapes)], n


def index_places(hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Place and sign of each nonzero of the tokens' index vectors."""
    h = mix(hashes ^ np.uint64(0xA5A5A5A5DEADBEEF))
    for k in range(NONZERO):
        part = h >> np.uint64(12 * k)
        yield (part % np.uint64(DIM)).astype(np.int64), 1.0 - 2.0 * ((part >> np.uint64(8)) & np.uint64(1)).astype(np.float64)


def index_sums(hashes: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """For each row the sum of the index vectors of its tokens."""
    out = np.zeros(rows * DIM)
    for place, sign in index_places(hashes):
        out += np.bincount(row * DIM + place, weights=sign, minlength=rows * DIM)
    return out.reshape(rows, DIM)


def features(texts: pa.Array, words: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Pooled vectors: means of index vectors and of context vectors in both streams, and the share of tokens with a context."""
    both, n = streams(texts)
    doc, rows, out = np.repeat(np.arange(len(n)), n), len(n), []
    each = np.maximum(n, 1)[:, None]
    for hashes in both:
        out.append(index_sums(hashes, doc, rows) / each)
        known = np.zeros(len(hashes), bool)
        if len(words):
            at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
            known = words[at] == hashes
            hits = np.flatnonzero(known)  # sums of the rows' runs of context vectors, so only tokens take memory
            sums, first = np.zeros((rows, DIM)), np.flatnonzero(np.diff(doc[hits], prepend=-1))
            if len(hits):
                sums[doc[hits[first]]] = np.add.reduceat(context[at[hits]], first, axis=0, dtype=np.float64)
            out.append(sums / each)
        else:
            out.append(np.zeros((rows, DIM)))
        out.append(np.bincount(doc, weights=known, minlength=rows)[:, None] / each)
    norms = [np.linalg.norm(v, axis=1, keepdims=True) for v in out if v.shape[1] == DIM]  # of few different tokens: long
    return np.concatenate([*out, *norms, np.log1p(n)[:, None]], 1)


class Network:
    """Two layers over standardised features, and the temperature of its output."""

    def fit(self, x: np.ndarray, y: np.ndarray, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        x = (x - self.mean) / self.scale
        order = rng.permutation(len(x))
        aside, used = order[: len(x) // 5], order[len(x) // 5 :]
        p = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
        step = 0
        for _ in range(ROUNDS // 10):
            for part in np.array_split(rng.permutation(used), 10):
                if not len(part):
                    continue
                h = np.maximum(0, x[part] @ p[0] + p[1])
                d = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -30, 30))) - y[part]) / len(part)
                dh = np.outer(d, p[2]) * (h > 0)
                step += 1
                for k, g in enumerate((x[part].T @ dh + DECAY * p[0], dh.sum(0), h.T @ d + DECAY * p[2], d.sum(keepdims=True))):
                    m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                    p[k] = p[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        self.p, self.temperature = p, 1.0
        if len(aside):
            z = self.logits(x[aside], scaled=True)
            loss = lambda t: np.mean(np.logaddexp(0, np.where(y[aside] == 1, -z, z) / t))
            self.temperature = float(min(np.geomspace(0.25, 8, 61), key=loss))
        return self

    def logits(self, x: np.ndarray, scaled: bool = False) -> np.ndarray:
        x = x if scaled else (x - self.mean) / self.scale
        return np.maximum(0, x @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


class Model:
    def __init__(self, words: np.ndarray, context: np.ndarray, network: Network | None, share: float = 0.5):
        """Without a network, every score is the share."""
        self.words, self.context, self.network, self.share = words, context, network, share

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), self.share)
        return self.network.scores(features(texts, self.words, self.context))


def _top_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        both, n = streams(batch.column("text"))
        doc = np.repeat(np.arange(len(n)), n)
        for hashes in both:
            pairs = np.unique(np.column_stack([hashes.view(np.int64), doc]), axis=0)
            values, k = np.unique(pairs[:, 0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(k.astype(np.int64))], ["w", "k"])


def context_sums(texts: pa.Array, words: np.ndarray) -> np.ndarray:
    """For each of the words, the sum of the index vectors of the two tokens on either side, over these texts."""
    both, n = streams(texts)
    doc, out = np.repeat(np.arange(len(n)), n), np.zeros((len(words), DIM))
    for hashes in both:
        at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
        known = words[at] == hashes
        for gap in (-2, -1, 1, 2):
            here = np.flatnonzero(known)
            there = here + gap
            ok = (there >= 0) & (there < len(hashes))
            here, there = here[ok], there[ok]
            same = doc[here] == doc[there]
            out += index_sums(hashes[there[same]], at[here[same]], len(words))
    return out


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", learn_rows: int = LEARN_ROWS) -> Model:
    """A model from the labelled rows of docs.

    labels: id and label 0 or 1 (others are left out; of an id labelled twice, the larger label). At most
    learn_rows of them are learned from, the first by a hash of the id; of several rows of docs with one id, the least
    text. So what comes to the driver is bounded: their features, the sample's frequent tokens and these tokens' vectors. With no labels, or only one kind,
    the model's score is that share of ones (0.5 without labels).
    """
    spark = docs.sparkSession
    known = labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("y")).filter("doc_id IS NOT NULL AND y IN (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(learn_rows)
    sample = texts_only(docs, id_col, text_col).join(F.broadcast(known), "doc_id")
    sample = sample.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y")).select("text", "y")
    sample = sample.persist()
    try:
        top = sample.mapInArrow(_top_rows, "w bigint, k bigint").groupBy("w").agg(F.sum("k").alias("k")).filter("k > 2").orderBy(F.desc("k"), "w").limit(CONTEXT_WORDS).toArrow()
        words = np.sort(np.asarray(top.column("w").combine_chunks()).view(np.uint64))
        shared = spark.sparkContext.broadcast(words)

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(shared.value), DIM))
            for batch in slices(batches):
                total += context_sums(batch.column("text"), shared.value)
            at = np.flatnonzero(total.any(1))
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(list(total[at]), pa.list_(pa.float64()))], ["at", "v"])

        context = np.zeros((len(words), DIM))
        if len(words):
            parts = sample.repartition(4).mapInArrow(sums, "at bigint, v array<double>").toArrow()  # four of CONTEXT_WORDS rows
            if len(parts):
                np.add.at(context, np.asarray(parts.column("at").combine_chunks()), np.array(parts.column("v").to_pylist()))
        context /= np.linalg.norm(context, axis=1, keepdims=True) + 1e-9
        learned = spark.sparkContext.broadcast((words, context.astype(np.float32)))

        def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(list(features(batch.column("text"), *learned.value)), pa.list_(pa.float64()))], ["y", "x"])

        rows = sample.mapInArrow(pooled, "y int, x array<double>").toArrow()
    finally:
        sample.unpersist()
    if not len(rows):
        return Model(words, context, None)
    kinds = set(rows.column("y").to_pylist())
    if len(kinds) == 1:
        return Model(words, context, None, float(kinds.pop()))
    x, y = np.array(rows.column("x").to_pylist()), np.asarray(rows.column("y").combine_chunks()).astype(float)
    order = np.lexsort(x.T)  # rows come in no fixed order
    return Model(words, context.astype(np.float32), Network().fit(x[order], y[order]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of docs: doc_id, score (0 to 1, of label 1), predicted.

    Whole texts are read; null counts as empty, and empty texts have a score too. Repeated rows each get a
    row; an empty table gives an empty result.
    """
    rows = texts_only(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            s = shared.value.scores(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return rows.mapInArrow(step, f"doc_id {dict(rows.dtypes)['doc_id']}, score double, predicted int")


def tagged(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs with score and predicted added to each row (replacing columns of these names), in the same pass."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c not in ("score", "predicted")]
    own = free_name("_text", names)
    rows = docs.select(*(F.col(f"`{c}`") for c in names), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias(own))
    out = rows.drop(own).withColumn("score", F.lit(0.0)).withColumn("predicted", F.lit(0))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, own):
            s = shared.value.scores(batch.column(own))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(s), pa.array((s >= threshold).astype(np.int32))], [*names, "score", "predicted"])

    return rows.mapInArrow(step, out.schema)
