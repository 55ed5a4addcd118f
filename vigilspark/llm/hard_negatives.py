"""Hard negatives by inner product, searched in an STR-packed R-tree.

Rows are dealt into tiles by range of label, first component and id, so that a hot label or a repeated vector is
many tiles. In a tile, sort-tile-recursive packing over its three widest coordinates makes leaves, and boxes of
boxes above them. A box's lower and upper corners give the interval of its rows' inner products with an anchor,
coordinate by coordinate. Anchors go, in blocks, to the tiles whose interval can hold a result; there a
best-first queue takes boxes by the highest score they may hold and leaves out those outside every window of
scores, or strictly below the k-th score found. A tile answers with its first k; the tiles' answers are merged.
The first search finds each anchor's positives, the second its negatives in the windows that these open.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilspark.llm.common import trim, written

#: Rows a tile aims at (it holds at most twice as many), of a leaf, and of a piece of a tile on its way; boxes in a box; anchors in a block.
TILE_ROWS, LEAF, PIECE, FANOUT, BLOCK = 1 << 17, 256, 4096, 8, 128
#: Bytes of the tiles' boxes that may be broadcast: one box a tile.
MAX_BOXES = 256 << 20
#: Blocks sort behind the pieces of their tile.
BEHIND = 1 << 20
FIRST, LAST = -(1 << 62), 1 << 62


def str_order(x: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The order in which sort-tile-recursive packing puts rows: slabs of the widest coordinate, in these slabs of the next, and leaves of the third."""
    axes = np.argsort(-x.astype(np.float64).var(axis=0), kind="stable")[:3] if x.shape[1] else []
    cuts = max(1, int(np.ceil(np.ceil(len(x) / leaf) ** (1 / 3))))

    def pack(rows: np.ndarray, depth: int) -> np.ndarray:
        if depth == len(axes):
            return rows
        rows = rows[np.argsort(x[rows, axes[depth]], kind="stable")]
        size = leaf * cuts ** (len(axes) - 1 - depth)
        return np.concatenate([pack(rows[k : k + size], depth + 1) for k in range(0, len(rows), size)]) if len(rows) else rows

    return pack(np.arange(len(x)), 0)


class Tree:
    """The boxes over one tile's rows, which come in packing order. Level 0 are the leaves, the last level is one box."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, exact: type, leaf: int = LEAF, fanout: int = FANOUT) -> None:
        self.ids, self.labels, self.x, self.leaf, self.fanout, self.exact = ids, labels, x.astype(exact), leaf, fanout, exact
        at = np.arange(0, len(ids), leaf)
        bounds = [np.minimum.reduceat(self.x, at), np.maximum.reduceat(self.x, at), np.minimum.reduceat(labels, at), np.maximum.reduceat(labels, at)]
        self.levels = [bounds]
        while len(bounds[0]) > 1:
            at = np.arange(0, len(bounds[0]), fanout)
            bounds = [f.reduceat(b, at) for f, b in zip((np.minimum, np.maximum, np.minimum, np.maximum), bounds, strict=True)]
            self.levels.append(bounds)

    def first(self, anchor: int, label: int, a: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, same: bool) -> list[list[tuple[int, int]]]:
        """For each window from low to high its first k (score, id) among rows of the same label (but not of the anchor's id), or of others."""
        a = a.astype(self.exact)
        up, down = np.maximum(a, 0), np.minimum(a, 0)
        best: list[list[tuple[int, int]]] = [[] for _ in low]  # (-score, id), in order
        kth = low.copy()  # what a window's next row must reach
        queue = [(-LAST, len(self.levels) - 1, 0)]
        while queue:
            reach, level, box = heapq.heappop(queue)
            if not (np.minimum(high, -reach) >= kth).any():
                break  # the queue is in order of what boxes may hold: the rest is below, too
            if level == 0:
                rows = slice(box * self.leaf, (box + 1) * self.leaf)
                scores = (self.x[rows] @ a).astype(np.int64)
                labels, ids = self.labels[rows], self.ids[rows]
                fits = (labels == label) & (ids != anchor) if same else labels != label
                for w in range(len(low)):
                    found = np.flatnonzero(fits & (scores >= kth[w]) & (scores <= high[w]))
                    if len(found):
                        merged = sorted(best[w] + list(zip((-scores[found]).tolist(), ids[found].tolist(), strict=True)))[:k]
                        best[w] = merged
                        if len(merged) == k:
                            kth[w] = -merged[-1][0]
                continue
            lo, hi, first, last = (b[box * self.fanout : (box + 1) * self.fanout] for b in self.levels[level - 1])
            most, least = (hi @ up + lo @ down).astype(np.int64), (lo @ up + hi @ down).astype(np.int64)
            useful = (first <= label) & (last >= label) if same else (first != label) | (last != label)
            for j in np.flatnonzero(useful):
                if ((least[j] <= high) & (np.minimum(high, most[j]) >= kth)).any():
                    heapq.heappush(queue, (-int(most[j]), level - 1, box * self.fanout + int(j)))
        return [[(-s, i) for s, i in found] for found in best]


def exact_type(most: int, dim: int) -> type:
    """The fastest type in which inner products of such components are exact."""
    size = most * most * max(dim, 1)
    return np.float32 if size < 1 << 24 else np.float64 if size < 1 << 53 else np.int64


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows; shorter ones are zero from their end on."""
    sizes = np.asarray(column.value_lengths().fill_null(0), np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dim), np.int64)
    out[np.arange(dim) < sizes[:, None]] = flat
    return out


def tiled(dim: int, kind: str, parts: int, tile_rows: int, leaf: int):
    """From sorted rows to tiles, each in pieces; the first piece of a tile has its box."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        part, k, held, n = TaskContext.get().partitionId(), 0, [], 0

        def tile() -> Iterator[pa.RecordBatch]:
            ids, labels, x = (np.concatenate(c) for c in zip(*held, strict=True))
            order = str_order(x, leaf)
            ids, labels, x = ids[order], labels[order], x[order]
            box = [x.min(axis=0).astype(np.int64).tobytes(), x.max(axis=0).astype(np.int64).tobytes(), int(labels.min()), int(labels.max())]
            for seq, at in enumerate(range(0, len(ids), PIECE)):
                to = at + PIECE
                row = [part + k * parts, seq, ids[at:to].tobytes(), labels[at:to].tobytes(), x[at:to].astype(kind).tobytes(), *(box if seq == 0 else [None] * 4)]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names)

        names = ["tile", "seq", "ids", "labels", "vectors", "low", "high", "first_label", "last_label"]
        types = [pa.int64(), pa.int32(), *[pa.binary()] * 5, pa.int64(), pa.int64()]
        for batch in batches:
            at = 0
            while at < len(batch):
                take = batch.slice(at, 2 * tile_rows - n)
                held.append((take.column("vec_id").to_numpy(), take.column("label").to_numpy(), matrix(take.column("q"), dim).astype(kind)))
                at, n = at + len(take), n + len(take)
                if n == 2 * tile_rows:
                    yield from tile()
                    k, held, n = k + 1, [], 0
        if n:
            yield from tile()

    return run, "tile bigint, seq int, ids binary, labels binary, vectors binary, low binary, high binary, first_label bigint, last_label bigint"


_BLOCK = "tile bigint, seq int, ids binary, labels binary, vectors binary, sizes binary, opened binary"


def dealt(boxes, dim: int, kind: str, exact: type, low: int, high: int, same: bool):
    """Blocks of anchors for the tiles that may hold something for them. low and high: a window in hundredths of a positive's score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles, lo, hi, first, last = boxes.value
        lo, hi = lo.astype(exact), hi.astype(exact)
        names, types = [c.split(" ")[0] for c in _BLOCK.split(", ")], [pa.int64(), pa.int32(), *[pa.binary()] * 5]
        for whole in batches:
            for at in range(0, len(whole), BLOCK):
                batch = whole.slice(at, BLOCK)
                ids, labels, x = batch.column("anchor_id").to_numpy(), batch.column("label").to_numpy(), matrix(batch.column("q"), dim)
                tags = batch.column("positives").to_pylist()
                a = x.astype(exact)
                up, down = np.maximum(a, 0), np.minimum(a, 0)
                most, least = (up @ hi.T + down @ lo.T).astype(np.int64), (up @ lo.T + down @ hi.T).astype(np.int64)
                # the widest window of each anchor: from the least low to the greatest high of its positives
                opened = [[window(p["score"], low, high) for p in t] for t in tags] if not same else [[(FIRST, LAST)]] * len(ids)
                begin = np.array([min((a for a, _ in w), default=LAST) for w in opened], np.int64)
                end = np.array([max((b for _, b in w), default=FIRST) for w in opened], np.int64)
                has = (first <= labels[:, None]) & (last >= labels[:, None]) if same else (first != labels[:, None]) | (last != labels[:, None])
                want = has & (most >= begin[:, None]) & (least <= end[:, None])
                out = []
                for t in np.flatnonzero(want.any(axis=0)):
                    rows = np.flatnonzero(want[:, t])
                    told = np.array([(p["place"], p["id"], p["score"]) for r in rows for p in tags[r]], np.int64)
                    sizes = np.array([len(tags[r]) for r in rows], np.int64)
                    out.append([int(tiles[t]), BEHIND, ids[rows].tobytes(), labels[rows].tobytes(), x[rows].astype(kind).tobytes(), sizes.tobytes(), told.tobytes()])
                for k in range(0, len(out), 64):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[k : k + 64], strict=True), types, strict=True)], names)

    return run, _BLOCK


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """The whole scores s with low * score <= 100 * s <= high * score."""
    return -(-low * score // 100), high * score // 100


def searched(dim: int, kind: str, exact: type, leaf: int, k: int, low: int, high: int, same: bool):
    """From a tile's pieces and the blocks behind them to what the tile holds for each anchor and window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        tile, pieces, tree = None, [], None
        ints = lambda data: np.frombuffer(data, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                if row["seq"] < BEHIND:
                    if row["tile"] != tile:
                        tile, pieces, tree = row["tile"], [], None
                    pieces.append((ints(row["ids"]), ints(row["labels"]), np.frombuffer(row["vectors"], kind).reshape(-1, dim)))
                    continue
                if tree is None:
                    tree = Tree(*(np.concatenate(c) for c in zip(*pieces, strict=True)), exact, leaf)
                    pieces = []
                ids, labels, x = ints(row["ids"]), ints(row["labels"]), np.frombuffer(row["vectors"], kind).reshape(-1, dim)
                told, at, out = ints(row["opened"]).reshape(-1, 3).tolist(), 0, []
                for anchor, label, a, size in zip(ids.tolist(), labels.tolist(), x, ints(row["sizes"]).tolist(), strict=True):
                    opened = [((None, None, None), (FIRST, LAST))] if same else [(tuple(p), window(p[2], low, high)) for p in told[at : at + size]]
                    at += size
                    opened = [o for o in opened if o[1][0] <= o[1][1]]
                    if opened:
                        lows, highs = (np.array(c, np.int64) for c in zip(*(o[1] for o in opened), strict=True))
                        for (positive, _), found in zip(opened, tree.first(anchor, label, a, lows, highs, k, same), strict=True):
                            out += [(anchor, *positive, i, s) for s, i in found]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["anchor_id", "place", "positive_id", "positive_score", "id", "score"])

    return run, "anchor_id bigint, place bigint, positive_id bigint, positive_score bigint, id bigint, score bigint"


def mine(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", tile_rows: int = TILE_ROWS, leaf: int = LEAF) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A component x counts as floor(256 * x). Rows with a null id, label, vector or component, or a component that is not
    finite, take no part. anchor: which rows are anchors, over the columns of vectors; of anchors that share an id, the
    least label and vector stands. A row's score is its inner product with the anchor; higher ones come first,
    then smaller ids. Positives are the anchor's first other rows (of another id) of its label; rows repeat as
    often as they come. Negatives of a positive are the first rows of other labels with a score from low to high
    hundredths of the positive's. A positive without such rows gives no row. Shorter vectors end in zeros. Scores
    must fit 63 bits. Other columns are not read; an empty table gives an empty result. What reaches the
    driver is one box a tile.
    """
    spark = vectors.sparkSession
    own = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), F.col(f"`{label_col}`").cast("bigint").alias("label"), F.col(f"`{vector_col}`").cast("array<double>").alias("_v"), anchor.alias("_anchor"))
    finite = F.forall("_v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    points = own.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite).select("vec_id", "label", F.transform("_v", lambda x: F.floor(x * 256)).alias("q"), "_anchor")
    n, dim, most = points.agg(F.count("*"), F.max(F.size("q")), F.max(F.array_max(F.transform("q", lambda x: F.abs(x.cast("double")))))).first()
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if not n or not dim:
        return spark.createDataFrame([], schema)
    most = int(most or 0)
    exact, kind = exact_type(most, dim), "int16" if most < 1 << 15 else "int64"
    parts = max(spark.sparkContext.defaultParallelism, -(-n // tile_rows))
    key = ["label", F.coalesce(F.get("q", F.lit(0)), F.lit(0)), "vec_id"]
    tiles = written(points.select("vec_id", "label", "q").repartitionByRange(parts, *key).mapInArrow(*tiled(dim, kind, parts, tile_rows, leaf)), "tiles")
    met = tiles.filter("seq = 0").select("tile", "low", "high", "first_label", "last_label")
    if -(-n // tile_rows) * dim * 16 > MAX_BOXES:
        raise ValueError("the tiles' boxes are too many to broadcast; take more rows a tile")
    rows = met.collect()
    corner = lambda c: np.array([np.frombuffer(r[c], np.int64) for r in rows])
    boxes = spark.sparkContext.broadcast((np.array([r.tile for r in rows]), corner("low"), corner("high"), np.array([r.first_label for r in rows]), np.array([r.last_label for r in rows])))
    asked = points.filter("_anchor").groupBy(F.col("vec_id").alias("anchor_id")).agg(F.min(F.struct("label", "q")).alias("r"))
    asked = written(asked.select("anchor_id", "r.label", "r.q"), "anchors")
    none = F.array().cast("array<struct<place:int,score:bigint,id:bigint>>")
    data = tiles.select(*(F.col(c) if c in tiles.columns else F.lit(None).cast("binary").alias(c) for c in (p.split(" ")[0] for p in _BLOCK.split(", "))))
    spread = min(len(rows), 100_000)

    def search(anchors: DataFrame, k: int, same: bool) -> DataFrame:
        blocks = anchors.mapInArrow(*dealt(boxes, dim, kind, exact, low, high, same))
        met = data.unionByName(blocks).repartition(spread, "tile").sortWithinPartitions("tile", "seq")
        return met.mapInArrow(*searched(dim, kind, exact, leaf, k, low, high, same))

    first = search(asked.withColumn("positives", none), positives, True)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    kept = first.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives)
    kept = kept.groupBy("anchor_id").agg(F.collect_list(F.struct("place", "score", "id")).alias("positives"))
    opened = written(asked.join(kept, "anchor_id"), "positives")
    found = search(opened, negatives, False)
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


SQL = """WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, e.vec_id, a.label = e.label AS same, CAST(list_inner_product(a.q, e.q) AS BIGINT) AS score FROM e a JOIN e ON a.vec_id % 100 = 0 AND e.vec_id <> a.vec_id),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n FROM s WHERE same) WHERE n <= 5),
r AS (SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INT) AS rank, s.vec_id AS negative_id,
p.score AS positive_score, s.score AS negative_score FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT * FROM r WHERE rank <= 10"""
