"""Exact Jaccard self-join of documents' five-word shingle sets, and the groups that its links form.

Equal sets are one class from the start, so copies cost one row each. A class of n shingles is listed under
the n - ceil(t n) + 1 first of them in a fixed order that puts frequent shingles last: two sets with
similarity t share one of these. The classes under one shingle, in order of size, are cut into bands in
which sizes differ by the factor 1 / t at most; only within such a tile can pairs link.

Round one links every class of a tile with the band's first class, which joins most copies of a text to
one group without pairing them all. A shingle known to be very frequent is dealt to several tasks there. Later
rounds take the tiles that still hold more than one group. Large ones are cut into bands of sizes, and bands into
chunks of bounded size, those of the tile's largest group apart; only chunks of one band or of neighbouring bands
meet, and never two of the largest group. They keep the pairs of different groups that pass the bit test. Where these are many,
as in a large group of near copies, a round keeps each class's likeliest partner and the tile comes again
with the groups that these links have merged; when no more merge, all pairs that are left are tested. A set's bitmap
holds the parity of its shingles' bits, so popcount(a xor b) is at most the number of unshared shingles and
(|a| + |b| - popcount) / 2 bounds the overlap from above. Pairs that pass are checked by intersecting the
sorted arrays. Classes already in one group need no check, as it can't change the groups.

The frequent shingles only set the order, so results don't depend on which are found. No step holds a tile
whole: round one keeps one row for each size, the others at most two chunks. Sorted arrays are made again, in the
rounds, for the documents of pairs that passed the bit test alone: kept for all, they would take more room than
the texts. What a round has written is removed when the next no longer needs it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilspark.llm.common import drop, slices, texts_only, written
from vigilspark.llm.components import components, extended
from vigilspark.llm.shingles import mix, sets

PERCENT = 75
#: Frequent shingles that are told to all tasks: 16 bytes each, 4 MB in all.
MAX_FREQUENT = 1 << 18
#: A shingle counts as frequent from so many documents on.
FREQUENT = 24
#: Classes of a tile's chunk; tiles with more are cut.
CHUNK = 1024
#: Documents of a frequent shingle that round one leaves in one task.
HOT = 200_000
#: Candidate pairs a row, up to which a tile is settled at once; with more, first each row's likeliest.
PER_ROW = 4
#: Bits of the table that tells which documents' arrays are needed.
NEEDED_BITS = 1 << 22
NONE = (1 << 63) - 1
_ODD = np.uint64(0x9E3779B97F4A7C15)


def width(n: int) -> int:
    """Bits of the bitmap of a set of n shingles: the power of two from n on, 64 to 65,536."""
    return 1 << min(16, max(6, int(n - 1).bit_length()))


def bitmap(hashes: np.ndarray) -> bytes:
    bits = width(len(hashes))
    return np.packbits((np.bincount((mix(hashes) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def folded(bits: np.ndarray, to: int) -> np.ndarray:
    """The bitmap over fewer bits. Positions were taken modulo a power of two, so halves add up."""
    while bits.shape[-1] > to:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def overlap(sizes_a, sizes_b, percent: int):
    """Least intersection with which two sets have the similarity."""
    return -(-percent * (sizes_a + sizes_b) // (100 + percent))


def _digest(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One 64-bit value per set, equal for equal sets; with the size beside it, it names the class."""
    out = np.zeros(len(sizes), np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        starts = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
        out[some] = np.add.reduceat(mix(flat + _ODD), starts) ^ np.add.reduceat(mix(flat ^ _ODD), starts) * _ODD
    return out.view(np.int64)


def _bounds(sizes: np.ndarray) -> Iterator[tuple[int, int, int]]:
    ends = np.cumsum(sizes)
    return zip(range(len(sizes)), (ends - sizes).tolist(), ends.tolist(), strict=True)


def class_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document: its size, class and bitmap."""
    for batch in slices(batches):
        flat, sizes = sets(batch.column("text"))
        bits = [bitmap(flat[a:b]) for _, a, b in _bounds(sizes)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes), pa.array(_digest(flat, sizes)), pa.array(bits, pa.binary())], ["doc_id", "n", "c", "bits"])


def frequent_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that come in more than one document of a few MB of text, with the count. A lossy count: what is rarer everywhere is left out."""
    held, rows = [], 0

    def count() -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        more = counts > 1
        return pa.RecordBatch.from_arrays([pa.array(values[more].view(np.int64)), pa.array(counts[more].astype(np.int64))], ["s", "k"])

    for batch in slices(batches):
        held.append(sets(batch.column("text"))[0])
        rows += len(held[-1])
        if rows > 1_500_000:
            yield count()
            held, rows = [], 0
    if held:
        yield count()


class Order:
    """The order of a set's shingles: by hash, but frequent ones last, the most frequent at the end."""

    def __init__(self, values: np.ndarray, counts: np.ndarray):
        by = np.argsort(values)
        self.values, self.counts = values[by], counts[by]

    def prefix(self, one: np.ndarray, length: int) -> np.ndarray:
        if not len(self.values):
            return one[:length]
        at = np.minimum(np.searchsorted(self.values, one), len(self.values) - 1)
        known = self.values[at] == one
        if not known[:length].any():
            return one[:length]
        late = one[known]
        late = late[np.lexsort((late, self.counts[at[known]]))]
        return np.concatenate([one[~known], late])[:length]


    def parts(self, shingles: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Into which part of its shingle each row goes: 0, or for shingles of more than HOT documents one by the class."""
        out = np.zeros(len(shingles), np.int32)
        if len(self.values) and self.counts.max() > HOT:
            at = np.minimum(np.searchsorted(self.values, shingles), len(self.values) - 1)
            hot = np.flatnonzero((self.values[at] == shingles) & (self.counts[at] > HOT))
            out[hot] = 1 + mix(classes[hot].view(np.uint64)) % (1 + self.counts[at[hot]] // HOT).astype(np.uint64)
        return out


def star_rows(percent: int):
    """Over rows (s, z, c, n, pos) sorted by s, z, n, c: each row whose shingle has another class, and the link of a class with its band's first.

    z: 0, or from 1 on the part of a shingle that is in several parts, and so has other classes for certain.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = np.zeros((0, 6), np.int64)  # of the last shingle: one row for each size, and whether it is told already
        for batch in batches:
            rows = np.column_stack([np.asarray(batch.column(k)).astype(np.int64) for k in ("s", "z", "n", "c", "pos")] + [np.zeros(len(batch), np.int64)])
            rows = np.concatenate([carry, rows])
            if not len(rows):
                continue
            same = np.concatenate([[False], (rows[1:, :4] == rows[:-1, :4]).all(1)])
            rows = rows[~same]
            s, z, n, c, pos, told = rows.T
            begins = np.concatenate([[True], (s[1:] != s[:-1]) | (z[1:] != z[:-1])])
            first, group = np.flatnonzero(begins), np.cumsum(begins) - 1
            size = np.diff(np.append(first, len(rows)))
            wide = np.int64(1) << 33
            key = group * wide + n
            lead = np.searchsorted(key, group * wide + -(-percent * n // 100))
            new = told == 0
            shared = new & ((size[group] > 1) | (z > 0))
            star = shared & (lead < np.arange(len(rows))) & ((c[lead] != c) | (n[lead] != n))
            pairs = np.unique(np.column_stack([c[lead[star]], n[lead[star]], c[star], n[star]]), axis=0) if star.any() else np.zeros((0, 4), np.int64)
            k, p = int(shared.sum()), len(pairs)
            if k + p:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([pa.array(s[shared]), pa.nulls(p, pa.int64())]),
                        pa.array(np.concatenate([c[shared], pairs[:, 2]])),
                        pa.array(np.concatenate([n[shared], pairs[:, 3]])),
                        pa.concat_arrays([pa.array(pos[shared]), pa.nulls(p, pa.int64())]),
                        pa.concat_arrays([pa.nulls(k, pa.int64()), pa.array(pairs[:, 0])]),
                        pa.concat_arrays([pa.nulls(k, pa.int64()), pa.array(pairs[:, 1])]),
                    ],
                    ["s", "c", "n", "pos", "lead_c", "lead_n"],
                )
            last = rows[first[-1] :]
            alone = len(last) == 1 and not last[0, 1]
            last = last[np.concatenate([[True], last[1:, 2] != last[:-1, 2]])].copy()
            if not alone:
                last[:, 5] = 1
            carry = last

    return step


def tile_rows(percent: int, most: int | None):
    """Over rows sorted by tile (s, i, j): pairs (x, y) of different groups whose sizes, places and bitmaps allow the similarity.

    A tile with more than most such pairs a row tells only the likeliest partner of each row outside its largest group, and its s once, with no pair.
    """

    def pairs(rows: list[tuple]) -> tuple[np.ndarray, bool]:
        rows.sort(key=lambda r: r[0])
        n, pos, node, group, side = (np.array(x, np.int64) for x in zip(*(r[:5] for r in rows), strict=True))
        bits: dict[int, np.ndarray] = {}
        of_width = np.array([len(r[5]) * 8 for r in rows])
        both = rows[0][6] != rows[0][7]
        left, right, likely = [], [], []
        upto = np.searchsorted(n, n * 100 // percent, "right")
        for a in range(len(rows)):
            near = slice(a + 1, upto[a])
            need = overlap(n[a], n[near], percent)
            fit = (group[near] != group[a]) & (np.minimum(n[a] - pos[a], n[near] - pos[near]) >= need)
            if both:
                fit &= side[near] != side[a]
            found = np.flatnonzero(fit)
            if not len(found):
                continue
            at, need, w = found + a + 1, need[found], int(of_width[a])
            if w not in bits:  # all rows of this and the next width, over w bits
                table = np.zeros((len(rows), w // 64), np.uint64)
                for k in np.flatnonzero((of_width == w) | (of_width == 2 * w)):
                    table[k] = np.packbits(folded(np.unpackbits(np.frombuffer(rows[k][5], np.uint8)), w)).view(np.uint64)
                bits[w] = table
            bound = n[a] + n[at] - np.bitwise_count(bits[w][at] ^ bits[w][a]).sum(1).astype(np.int64) - 2 * need
            ok = bound >= 0
            if ok.any():
                left.append(np.full(int(ok.sum()), a)), right.append(at[ok]), likely.append(bound[ok] / (n[a] + n[at[ok]]))
        if not left:
            return np.zeros((0, 2), np.int64), False
        left, right, likely = map(np.concatenate, (left, right, likely))
        more = most is not None and len(left) > most * len(rows)
        if more:
            # the rows of the tile's largest group need not tell theirs: what is near to them tells it
            names, times = np.unique(group, return_counts=True)
            rest = group != names[times.argmax()]
            rank = np.argsort(-likely, kind="stable")
            one, two = rank[rest[left[rank]]], rank[rest[right[rank]]]
            rank = np.union1d(one[np.unique(left[one], return_index=True)[1]], two[np.unique(right[two], return_index=True)[1]])
            left, right = left[rank], right[rank]
        return np.column_stack([np.minimum(node[left], node[right]), np.maximum(node[left], node[right])]), more

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tile, done, more = [], None, [], []

        def close() -> None:
            if len(held) > 1:
                found, left = pairs(held)
                done.append(found)
                more.extend([tile[0]] * left)

        def tell() -> pa.RecordBatch:
            links = np.unique(np.concatenate(done), axis=0) if done else np.zeros((0, 2), np.int64)
            k = len(more)
            return pa.RecordBatch.from_arrays([pa.concat_arrays([pa.array(links[:, 0]), pa.nulls(k, pa.int64())]), pa.concat_arrays([pa.array(links[:, 1]), pa.nulls(k, pa.int64())]), pa.concat_arrays([pa.nulls(len(links), pa.int64()), pa.array(more, pa.int64())])], ["x", "y", "s"])

        for batch in batches:
            for s, i, j, *row in zip(*(batch.column(k).to_pylist() for k in ("s", "i", "j", "n", "pos", "node", "grp", "side", "bits")), strict=True):
                if (s, i, j) != tile:
                    close()
                    held, tile = [], (s, i, j)
                held.append((*row, i, j))
            if sum(map(len, done)) > 100_000:
                yield tell()
                done, more = [], []
        close()
        yield tell()

    return step


def _links(pairs: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["x", "y"])


def bit_test(percent: int):
    """Over pairs with both sizes and bitmaps: those that may have the similarity."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x, y, nx, ny, bx, by in zip(*(batch.column(k).to_pylist() for k in ("x", "y", "nx", "ny", "bx", "by")), strict=True):
                w = 8 * min(len(bx), len(by))
                a, b = (np.packbits(folded(np.unpackbits(np.frombuffer(v, np.uint8)), w)) for v in (bx, by))
                if nx + ny - int(np.bitwise_count(a ^ b).sum()) >= 2 * overlap(nx, ny, percent):
                    out.append((x, y))
            if out:
                yield _links(np.array(out, np.int64))

    return step


def exact_test(percent: int):
    """Over pairs with both sorted arrays: those that have the similarity."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x, y, ax, ay in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), batch.column("ax").to_pylist(), batch.column("ay").to_pylist(), strict=True):
                a, b = np.frombuffer(ax, np.uint64), np.frombuffer(ay, np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * both >= percent * (len(a) + len(b) - both):
                    out.append((x, y))
            if out:
                yield _links(np.array(out, np.int64))

    return step


def checked(pairs: DataFrame, rows: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The links among pairs (x, y: documents that stand for their classes), by bit test, then by exact intersection."""
    one = classes.select(F.col("node").alias("x"), F.col("n").alias("nx"), F.col("bits").alias("bx"))
    two = classes.select(F.col("node").alias("y"), F.col("n").alias("ny"), F.col("bits").alias("by"))
    may = written(pairs.join(one, "x").join(two, "y").mapInArrow(bit_test(percent), "x bigint, y bigint"), "pairs")
    needed = may.select(F.explode(F.array("x", "y")).alias("doc_id")).distinct()
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(NEEDED_BITS))
    words = needed.select(bucket.alias("b")).groupBy(F.shiftright("b", 5).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 32 as int))")).alias("bits")).collect()  # 131,072 rows at most
    table = np.zeros(NEEDED_BITS // 32, "<u4")
    table[[r["at"] for r in words]] = [r["bits"] for r in words]
    shared = rows.sparkSession.sparkContext.broadcast(table)

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = shared.value
        for batch in slices(batches):
            b = np.asarray(batch.column("b"))
            batch = batch.filter(pa.array(((flags[b >> 5] >> (b & 31).astype(np.uint32)) & 1).astype(bool)))
            if len(batch):
                flat, sizes = sets(batch.column("text"))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([flat[a:e].tobytes() for _, a, e in _bounds(sizes)], pa.binary())], ["doc_id", "a"])

    held = written(rows.select("doc_id", "text", bucket.alias("b")).mapInArrow(arrays, "doc_id bigint, a binary").join(needed, "doc_id", "left_semi"), "arrays")
    full = may.join(held.select(F.col("doc_id").alias("x"), F.col("a").alias("ax")), "x").join(held.select(F.col("doc_id").alias("y"), F.col("a").alias("ay")), "y")
    found = written(full.mapInArrow(exact_test(percent), "x bigint, y bigint"), "links")
    drop(may, held)
    return found


def cut_tiles(rows: DataFrame, percent: int) -> DataFrame:
    """Rows (s, n, pos, node, grp) of large tiles, dealt to the pairs of chunks (i, j) that can hold pairs of different groups and like sizes; side: the row's own chunk.

    Two sizes within the factor lie in one band or in two neighbouring ones. A tile's largest group has chunks of its
    own, which don't meet one another; so a large group of near copies costs its rows times the chunks of the rest.
    """
    most = rows.groupBy("s", "grp").agg(F.count("*").alias("c")).groupBy("s").agg(F.max_by("grp", "c").alias("main"))
    width = -np.log(percent / 100) if percent < 100 else 1.0
    placed = rows.join(most, "s").withColumns({"band": F.floor(F.log(F.col("n") + 0.5) / F.lit(float(width))), "own": (F.col("grp") == F.col("main")).cast("int")})
    sizes = placed.groupBy("s", "band", "own").agg(F.ceil(F.count("*") / CHUNK).alias("k"))
    theirs = sizes.select("s", F.explode(F.array(*(F.col("band") + d for d in (-1, 0, 1)))).alias("band"), F.struct(F.col("band"), F.col("own"), F.col("k")).alias("t"))
    near = sizes.join(theirs, ["s", "band"]).filter((F.col("own") == 0) | (F.col("t.own") == 0)).groupBy("s", "band", "own", "k").agg(F.collect_list("t").alias("near"))  # six at most
    number = lambda band, own, chunk: ((band * 2 + own) * F.lit(1 << 40) + chunk).cast("bigint")
    meets = F.flatten(F.transform("near", lambda t: F.transform(F.sequence(F.lit(0).cast("bigint"), t["k"] - 1), lambda o: number(t["band"], t["own"], o))))
    side = number(F.col("band"), F.col("own"), F.pmod(F.xxhash64("node"), F.col("k")))
    dealt = placed.join(near, ["s", "band", "own"]).withColumn("side", side).withColumn("o", F.explode(meets))
    return dealt.select("s", F.least("side", "o").alias("i"), F.greatest("side", "o").alias("j"), "n", "pos", "node", "grp", "side")


def jaccard_groups(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id.

    Sets with 100 * intersection >= percent * union link; component_id is the smallest doc_id that links
    reach. Texts without words (null, empty, white space) have 0 shingles and link with nothing, not even
    with one another. Rows that share a doc_id count as one document: a link of either is a link of both,
    and all of them have one component. Null ids are no shared id. A null doc_id sorts last, and a group of null ids alone has a null component. doc_id is read as bigint. An
    empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    rows = texts_only(docs, id_col, text_col).withColumn("doc_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NONE)))
    each = written(rows.mapInArrow(class_rows, "doc_id bigint, n bigint, c bigint, bits binary"), "sets")
    classes = written(each.filter("n > 0").groupBy("c", "n").agg(F.min("doc_id").alias("node"), F.first("bits").alias("bits")), "classes")

    common = (
        rows.mapInArrow(frequent_rows, "s bigint, k bigint").groupBy("s").agg(F.sum("k").alias("k")).filter(F.col("k") >= FREQUENT)
        .orderBy(F.desc("k"), "s").limit(MAX_FREQUENT).toArrow()
    )
    common = spark.sparkContext.broadcast((np.asarray(common.column("s").combine_chunks()).view(np.uint64), np.asarray(common.column("k").combine_chunks())))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = Order(*common.value)
        for batch in slices(batches):
            flat, sizes = sets(batch.column("text"))
            c, seen, out = _digest(flat, sizes), set(), []
            for i, a, b in _bounds(sizes):
                if b > a and (c[i], b - a) not in seen:
                    seen.add((c[i], b - a))
                    out.append((i, order.prefix(flat[a:b], b - a - -(-percent * (b - a) // 100) + 1)))
            if out:
                length = np.array([len(p) for _, p in out])
                at = np.repeat([i for i, _ in out], length)
                pos = np.arange(len(at)) - np.repeat(np.cumsum(length) - length, length)
                flat = np.concatenate([p for _, p in out])
                z = order.parts(flat, c[at])
                yield pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64)), pa.array(z), pa.array(c[at]), pa.array(sizes[at].astype(np.int32)), pa.array(pos.astype(np.int32))], ["s", "z", "c", "n", "pos"])

    tiles = rows.mapInArrow(prefixes, "s bigint, z int, c bigint, n int, pos int").repartition("s", "z").sortWithinPartitions("s", "z", "n", "c")
    told = written(tiles.mapInArrow(star_rows(percent), "s bigint, c bigint, n bigint, pos bigint, lead_c bigint, lead_n bigint"), "tiles")

    key = classes.select("c", "n", "node")
    stars = (
        told.filter("s IS NULL").select("c", "n", "lead_c", "lead_n").distinct()
        .join(key, ["c", "n"]).select(F.col("node").alias("b"), F.col("lead_c").alias("c"), F.col("lead_n").alias("n"))
        .join(key, ["c", "n"]).select(F.least("b", "node").alias("x"), F.greatest("b", "node").alias("y")).filter("x <> y").distinct()
    )
    # rows of one id are one document, so its classes link whatever their likeness
    name = F.struct("c", "n")
    several = each.filter(F.col("doc_id") != NONE).groupBy("doc_id").agg(F.min(name).alias("a"), F.max(name).alias("b")).filter("a <> b").select("doc_id")
    several = written(each.select("doc_id", "c", "n").join(several, "doc_id", "left_semi").filter("n > 0").distinct(), "several")
    same = several.join(key, ["c", "n"]).select("node", "doc_id")
    same = same.join(same.groupBy("doc_id").agg(F.min("node").alias("x")), "doc_id").select("x", F.col("node").alias("y")).filter("x <> y").distinct()
    links = checked(stars, rows, classes, percent).union(same)
    found = components(links)

    shared_rows = told.filter("s IS NOT NULL").select("s", "c", "n", "pos")
    open_tiles, most, last = None, PER_ROW, []
    while True:
        nodes = classes.join(found, "node", "left").select("node", "c", "n", F.coalesce("component", "node").alias("grp"))
        listed = shared_rows if open_tiles is None else shared_rows.join(open_tiles, "s", "left_semi")
        listed = written(listed.join(nodes, ["c", "n"]).select("s", "n", "pos", "node", "grp"), "listed")
        drop(*last)
        mixed = listed.groupBy("s").agg(F.min("grp").alias("a"), F.max("grp").alias("b"), F.count("*").alias("m")).filter("a <> b").select("s", "m")
        large = written(mixed.filter(F.col("m") > CHUNK).select("s"), "large")
        zero = F.lit(0).cast("bigint")
        whole = listed.join(mixed.filter(F.col("m") <= CHUNK).select("s"), "s", "left_semi")
        chunks = whole.select("s", zero.alias("i"), zero.alias("j"), "n", "pos", "node", "grp", zero.alias("side"))
        if not large.isEmpty():
            chunks = chunks.union(cut_tiles(listed.join(large, "s", "left_semi"), percent))
        chunks = chunks.join(classes.select("node", "bits"), "node")
        tested = written(chunks.repartition("s", "i", "j").sortWithinPartitions("s", "i", "j").mapInArrow(tile_rows(percent, most), "x bigint, y bigint, s bigint"), "tested")
        more = checked(tested.filter("x IS NOT NULL").select("x", "y").distinct(), rows, classes, percent)
        drop(listed, large)
        last = [tested]
        grown = not more.isEmpty()
        if grown:
            found = extended(found, more)
        open_tiles = tested.filter("x IS NULL").select("s").distinct()
        if open_tiles.isEmpty():
            break
        if not grown:
            most = None  # all that is left is tested in full

    label = key.join(found, "node", "left").select("c", "n", F.coalesce("component", "node").alias("component_id"))
    own = written(several.join(label, ["c", "n"]).groupBy("doc_id").agg(F.min("component_id").alias("own")), "own")  # for rows without words
    out = each.select("doc_id", "n", "c").join(label, ["c", "n"], "left").join(own, "doc_id", "left")
    return out.select(
        F.nullif("doc_id", F.lit(NONE)).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.nullif(F.coalesce("component_id", "own", "doc_id"), F.lit(NONE)).alias("component_id"),
    )
