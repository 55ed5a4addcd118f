"""op7: large tiles cut into chunks, and frequent shingles in several parts, give the same groups."""

from __future__ import annotations

import numpy as np

from tests.llm.test_operators import brute_groups, prose
from vigilspark.llm import jaccard_join


def near_copies(n: int) -> list[tuple[int, str]]:
    """Near copies of a few texts of several lengths, which share most shingles, and lone texts that share some."""
    rng, rows = np.random.default_rng(5), []
    base = prose(31, 80).split()
    for k in range(n):
        words = base[: int(rng.integers(20, 80))]
        for at in rng.integers(0, len(words), int(rng.integers(0, 4))):
            words[at] = f"w{rng.integers(0, 50)}"
        rows.append((k, " ".join(words)))
    return rows + [(1000 + k, " ".join([*base[:8], prose(50 + k, 12)])) for k in range(20)]


def groups(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_groups(docs).collect())


def test_cut_tiles_and_parts(spark, monkeypatch):
    rows = near_copies(120)
    want = sorted(brute_groups(rows))
    monkeypatch.setattr(jaccard_join, "CHUNK", 8)
    monkeypatch.setattr(jaccard_join, "HOT", 4)
    monkeypatch.setattr(jaccard_join, "FREQUENT", 3)
    assert groups(spark, rows) == want


def test_chunks_meet_in_every_fitting_pair(spark):
    """Each pair of like sizes and different groups is in one tile; none of the largest group meets its own."""
    rng = np.random.default_rng(3)
    rows = [(7, int(n), 0, k, int(g)) for k, (n, g) in enumerate(zip(rng.integers(5, 400, 3000), rng.choice([1, 1, 1, 1, 2, 3], 3000), strict=True))]
    df = spark.createDataFrame(rows, "s bigint, n int, pos int, node bigint, grp bigint")
    tiles: dict = {}
    for r in jaccard_join.cut_tiles(df, 75).collect():
        tiles.setdefault((r.i, r.j), []).append(r)
    met = set()
    for (i, j), held in tiles.items():
        assert i == j or {r.side for r in held} <= {i, j}
        for side in {r.side for r in held}:
            assert sum(r.side == side for r in held) < 3 * jaccard_join.CHUNK
        left = [r for r in held if r.side == i]
        right = [r for r in held if r.side == j]
        met |= {(min(a.node, b.node), max(a.node, b.node)) for a in left[:200] for b in right[:200] if a.node != b.node}
        assert not all(r.grp == 1 for r in held) or len({r.side for r in held}) == 1
    sides = {r.node: r.side for held in tiles.values() for r in held}
    for a in rows[:150]:
        for b in rows[150:300]:
            if a[4] != b[4] and min(a[1], b[1]) * 100 >= 75 * max(a[1], b[1]):
                assert tuple(sorted((sides[a[3]], sides[b[3]]))) in tiles


def test_extended_components_equal_components_of_all(spark):
    from vigilspark.llm.components import components, extended

    rng = np.random.default_rng(9)
    one, two = ([(int(min(a, b)), int(max(a, b))) for a, b in rng.integers(0, 80, (40, 2)) if a != b] for _ in range(2))
    links = lambda pairs: spark.createDataFrame(pairs, "x bigint, y bigint")
    rows = lambda df: sorted((r.node, r.component) for r in df.collect())
    assert rows(extended(components(links(one)), links(two))) == rows(components(links(one + two)))
    assert rows(extended(components(links([])), links(two))) == rows(components(links(two)))
