"""One JSON array, cut at random places, against the standard parser."""

from __future__ import annotations

import json
import random

import pytest

from vigilspark.sources import arrays

TEXTS = ["", "}", "{", '"', "\\", '\\"', "},{", "]}", "é😀", 'a"b}', "x" * 60, "\\\\}", "[", "\n", "},\n{"]


def value(rnd, depth=0):
    kind = rnd.random()
    if kind < 0.5 or depth > 3:
        return rnd.choice(TEXTS) + rnd.choice(TEXTS)
    if kind < 0.7:
        return [value(rnd, depth + 1) for _ in range(rnd.randint(0, 3))]
    return {rnd.choice(TEXTS): value(rnd, depth + 1) for _ in range(rnd.randint(0, 3))}


@pytest.fixture
def cuts(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    yield lambda size: [spark.conf.set(n, v) for n, v in zip(names, (size, 1), strict=True)]
    for n, v in zip(names, before, strict=True):
        spark.conf.set(n, v)


def test_one_file_is_many_tasks(spark, tmp_path, cuts):
    rnd = random.Random(8)
    files = {}
    for k in range(6):
        records = [{"id": j, "v": value(rnd)} for j in range(rnd.choice([0, 1, 40]))] + [rnd.choice([1, None, "s}", [{"no": 1}]])] * (k % 2)
        files[k] = [r for r in records if isinstance(r, dict)]
        (tmp_path / f"{k}.json").write_text(json.dumps(records, indent=rnd.choice([None, 2]), ensure_ascii=False), encoding="utf-8")
    want = sorted(json.dumps(r, sort_keys=True) for rows in files.values() for r in rows)
    for size in (7, 64, 1000, 1 << 20):
        cuts(size)
        got = arrays.array_texts(spark, str(tmp_path))
        assert sorted(json.dumps(json.loads(r.value), sort_keys=True) for r in got.collect()) == want, size
    cuts(64)
    big = next(k for k, rows in files.items() if len(rows) == 40)
    assert spark.read.option("lineSep", "}").text(str(tmp_path / f"{big}.json")).rdd.getNumPartitions() > 2
    assert sorted(r.id for r in arrays.read_array(spark, str(tmp_path / f"{big}.json"), "id int").collect()) == list(range(40))


def test_no_records(spark, tmp_path):
    (tmp_path / "e.json").write_text("[]")
    assert arrays.read_array(spark, str(tmp_path), "id int").count() == 0
