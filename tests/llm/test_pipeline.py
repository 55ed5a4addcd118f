"""The pipeline's stages against brute force on the smallest tables."""

from __future__ import annotations

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.test_operators import brute_groups, brute_lines, prose
from vigilspark.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        out.append(docs)
    return out


def test_stage_columns(kept):
    for df in kept[:-1]:
        assert df.columns == corpus_pipeline.COLUMNS


def test_filters_keep_clean_documents(spark, kept):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    first, second = ({r.doc_id for r in df.collect()} for df in kept[:2])
    assert first == {i for i, t in before.items() if t and any(c.isalpha() for c in t)}
    assert np.mean([i in second for i in first if labels.get(i) == 1]) > 0.98
    assert np.mean([i not in second for i in first if labels.get(i) == 0]) > 0.8


def test_dedup_stages(kept):
    lines = brute_lines([(r.doc_id, r.text) for r in kept[1].collect()])
    want = {i: t for (i, before), t in lines.items() if t == before or t}
    got = {r.doc_id: r.text for r in kept[2].collect()}
    assert got == want
    assert {r.doc_id for r in kept[3].collect()} == {i for i, _, c in brute_groups(sorted(got.items())) if i == c}


def test_packing_takes_all(kept):
    rows = kept[4].collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in kept[3].collect()}
    ends = sorted((r.sequence_id * 1024 + r.offset, r.length) for r in rows)
    assert all(a + n == b for (a, n), (b, _) in zip(ends, ends[1:], strict=False))


def test_run(spark, kept):
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SF).collect()) == sorted(r.doc_id for r in kept[4].collect())


def test_registered():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)


def test_one_row_of_each_group(spark):
    a, b, c, d = (prose(k, 40) for k in (21, 22, 23, 24))
    rows = [(3, a), (3, a), (3, b), (7, b), (None, c), (None, c), (None, d), (8, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = [(r.doc_id or 99, r.text) for r in corpus_pipeline.one_of_each_group(spark, docs, SF).collect()]
    assert sorted(got) == sorted([(3, min(a, b)), (8, ""), (99, c), (99, d)])


EDGES = [(1, "one two three four five six", "en"), (1, "one two three four five six", "en"), (None, "alpha beta gamma delta epsilon", None), (None, None, "en"), (2, "", "de"), (3, "12 34 !", None), (4, "a\nb\nc\nd", "de")]


def edge_docs(spark, rows=EDGES, lang=True):
    data = [(i, t, g if lang else None, "s", len(t or ""), "more") for i, t, g in rows]
    return spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, n_chars bigint, score string")


def test_stages_on_odd_rows(spark):
    """Null ids and texts, repeated rows, extra columns with names that the operators use."""
    docs = edge_docs(spark)
    first = corpus_pipeline.identified(spark, docs, SF)
    assert first.columns == corpus_pipeline.COLUMNS and sorted(str(r.doc_id) for r in first.collect()) == ["1", "1", "4", "None"]
    good = corpus_pipeline.good(spark, docs, SF)
    assert good.columns == corpus_pipeline.COLUMNS and good.count() <= len(EDGES)
    lines = corpus_pipeline.without_repeats(spark, docs, SF)
    assert lines.columns == corpus_pipeline.COLUMNS and lines.count() == len(EDGES)
    assert sorted(str(r.doc_id) for r in corpus_pipeline.one_of_each_group(spark, docs, SF).collect()) == ["1", "2", "3", "4", "None", "None"]
    packed = corpus_pipeline.packed(spark, docs, SF).collect()
    assert sum(r.length for r in packed if r.start == 0) > 0 and len({(r.doc_id, r.start, r.offset, r.sequence_id) for r in packed}) == len(packed) == len(EDGES)


def test_stages_on_an_empty_table(spark):
    docs = edge_docs(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_without_any_language(spark):
    docs = edge_docs(spark, lang=False)
    assert sorted(str(r.doc_id) for r in corpus_pipeline.identified(spark, docs, SF).collect()) == ["1", "1", "4", "None"]
