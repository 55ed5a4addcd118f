"""Hard negatives against all inner products, and the tree against sorting."""

from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from vigilspark.llm import hard_negatives as h
from vigilspark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(rows: list[tuple], anchor) -> list[tuple]:
    rows = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a in sorted({r[0] for r in rows if anchor(r[0])}):
        _, label, q = min(r for r in rows if r[0] == a)
        scored = [(-sum(x * y for x, y in zip(q, v, strict=False)), i, lab) for i, lab, v in rows]
        positives = sorted((s, i) for s, i, lab in scored if lab == label and i != a)[:5]
        for ps, p in positives:
            fits = sorted((s, i) for s, i, lab in scored if lab != label and 30 * -ps <= 100 * -s <= 90 * -ps)[:10]
            out += [(a, p, n, i, -ps, -s) for n, (s, i) in enumerate(fits, 1)]
    return sorted(out)


def told(df) -> list[tuple]:
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def test_op13(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    rows = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, v) for i, lab, v in con.execute("SELECT vec_id, label, embedding FROM embeddings").fetchall()]
    got = told(QUERIES["op13_hard_negatives"](spark, SF))
    assert got == brute(rows, lambda i: i % 100 == 0) and len(got) > 50
    found = con.execute(h.SQL)
    assert [c[0] for c in found.description] == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert got == sorted(found.fetchall())


SCHEMA = "vec_id bigint, label int, embedding array<float>, q string, tile int"


def mined(spark, rows, **sizes):
    return told(h.mine(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA), F.col("vec_id") % 5 == 0, **sizes))


@pytest.mark.parametrize("spread", [0.3, 3.0, 300.0])
def test_small_tiles_and_leaves(spark, spread):
    """Many tiles and boxes, clusters, ties and a label with a third of the rows."""
    rnd = random.Random(7)
    centres = [[rnd.uniform(-1, 1) * spread for _ in range(3)] for _ in range(4)]
    rows = []
    for i in range(700):
        lab = rnd.choice([0, 0, 1, 2, 3])
        v = [round(c + rnd.gauss(0, 0.1 * spread), 1) for c in centres[lab]]
        rows.append((i, lab, v if i % 3 else [spread, 0.0, 0.1]))
    assert mined(spark, rows, tile_rows=40, leaf=4) == brute([(i, lab, np.float32(v).astype(float).tolist()) for i, lab, v in rows], lambda i: i % 5 == 0)


def test_odd_rows(spark):
    rows = [(0, 1, [1.0, 0.0]), (5, 1, [1.0, 0.5]), (1, 1, [0.9]), (2, 2, [0.5, 0.25]), (2, 2, [0.5, 0.25]), (3, 2, []), (4, None, [1.0, 1.0]), (None, 2, [0.5, 0.5]), (6, 2, None), (7, 3, [0.5, None]), (8, 3, [float("nan"), 0.5]), (9, 3, [float("inf"), 0.5]), (10, 3, [0.0, 0.0]), (0, 1, [1.0, 0.0])]
    assert mined(spark, rows) == brute(rows, lambda i: i % 5 == 0) != []
    assert mined(spark, []) == [] and mined(spark, [(5, 1, [])]) == [] and mined(spark, [(5, 1, [0.5])]) == []
    big = [(i, i % 2, [1e5 * (i + 1), -1e4 * i]) for i in range(30)]
    assert mined(spark, big) == brute(big, lambda i: i % 5 == 0) != []


def test_tree_equals_sorting_and_prunes():
    rnd = np.random.default_rng(1)
    x = np.concatenate([rnd.normal(c, 3, (200, 3)) for c in rnd.uniform(-90, 90, (12, 3))]).astype(np.int64)
    labels, ids = np.repeat(np.arange(4), 600), rnd.permutation(2400)
    order = h.str_order(x, 16)
    assert sorted(order) == list(range(2400))
    tree = h.Tree(ids[order], labels[order], x[order], np.float64, 16, 4)
    low, high = np.array([h.FIRST, -500, 0, 2000]), np.array([h.LAST, 4000, 900, 2100])
    for at in range(0, 2400, 97):
        a, label, own = x[at], int(labels[at]), int(ids[at])
        for same in (True, False):
            scores = x @ a
            fits = (labels == label) & (ids != own) if same else labels != label
            want = [sorted(((-int(s), int(i)) for s, i in zip(scores[m], ids[m], strict=True)))[:7] for lo, hi in zip(low, high, strict=True) for m in [fits & (scores >= lo) & (scores <= hi)]]
            assert tree.first(own, label, a, low, high, 7, same) == [[(-s, i) for s, i in w] for w in want]
    spread = lambda o: sum(np.ptp(x[o][k : k + 16], axis=0).sum() for k in range(0, 2400, 16))
    assert spread(order) < 0.3 * spread(rnd.permutation(2400))
