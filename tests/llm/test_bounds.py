"""Bounds and odd inputs: long rule lists, learned rows, other tokenizer files, null and largest ids, tables left behind."""

from __future__ import annotations

import json
import random
import time

import numpy as np
import pytest

from vigilspark.llm import bpe, fingerprints, language_id, packing, quality, token_counts, url_filters
from vigilspark.llm.queries import tokenizer


def test_many_rules_of_one_host():
    rnd = random.Random(2)
    rules = {("example.org", f"/a/{''.join(rnd.choice('xyz0') for _ in range(rnd.randint(1, 40)))}"): rnd.choice(["allow", "block"]) for _ in range(16_000)}
    began, trie = time.time(), {}
    for (host, path), verdict in rules.items():
        url_filters.add_rule(trie, host, path, verdict)
    assert time.time() - began < 1
    paths = [p + rnd.choice(["", "x", "/q"]) for _, p in rnd.sample(sorted(rules), 300)]
    began = time.time()
    found = [url_filters.longest(trie, "www.example.org", p) for p in paths]
    assert time.time() - began < 0.5
    for p, f in zip(paths, found, strict=True):
        fits = max((len(r), r) for (_, r) in rules if p.startswith(r))[1]
        assert f == ("example.org" + fits, rules["example.org", fits])


def test_of_one_id_one_row_is_learned(spark, monkeypatch):
    seen = []
    fit = quality.Network.fit
    monkeypatch.setattr(quality.Network, "fit", lambda self, x, y: seen.append(len(x)) or fit(self, x, y))
    docs = spark.createDataFrame([(k % 4, f"words of text {k} and {k % 7}") for k in range(2000)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(0, 0), (1, 1), (2, 0), (3, 1)], "doc_id bigint, quality int")
    quality.learn(docs, labels, learn_rows=3)
    assert seen == [3]


def other_file(tmp_path, **token) -> str:
    with open(tokenizer("byte_bpe_50k.json"), encoding="utf-8") as f:
        file = json.load(f)
    new = max([*file["model"]["vocab"].values(), *(t["id"] for t in file["added_tokens"])]) + 1
    file["added_tokens"].append({"id": new, "content": "hello world", "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": False} | token)
    path = tmp_path / "other.json"
    path.write_text(json.dumps(file), encoding="utf-8")
    return str(path)


def test_other_tokenizer_files(spark, tmp_path):
    from tokenizers import Tokenizer

    path = other_file(tmp_path)
    with pytest.raises(ValueError, match="added tokens"):
        token_counts.PrefixCounter(path)
    texts = ["hello worldhello world", "", "say hello world now", "hello  world", "plain text"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    library = Tokenizer.from_file(path)
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.pack(docs.coalesce(1), path).collect()}
    assert got == {k: [*library.encode(t, add_special_tokens=False).ids, 0] for k, t in enumerate(texts)}
    assert token_counts.departures({"model": {"type": "Unigram"}, "added_tokens": []})


def test_null_and_largest_ids(spark):
    rows = [(None, "alpha beta gamma delta epsilon"), (2**63 - 1, "one two three four five six"), (-(2**63), "x y"), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in fingerprints.compare_neighbours(docs).collect())
    assert got == [(False, -(2**63)), (False, 2**63 - 1), (True, 0), (True, 0)]
    none = spark.createDataFrame([(None, "wort " + "".join(chr(97 + int(d)) for d in f"{k * k * k:09d}"), "de") for k in range(400)], "doc_id bigint, text string, lang string")
    few, all_ = (language_id.learn(none, learn_docs=n) for n in (20, 400))
    assert 0 < few.masks.astype(bool).sum() < all_.masks.astype(bool).sum()


def test_no_table_stays_in_the_catalogue(spark):
    before = len(spark.catalog.listTables())
    docs = spark.createDataFrame([(k, f"some words {k} of text") for k in range(20)], "doc_id bigint, text string")
    path = tokenizer("byte_bpe_multi_50k.tiktoken")
    both = bpe.decode(bpe.encode(docs, path), path)
    assert {r.doc_id: bytes(r.decoded).decode() for r in both.collect()} == {k: f"some words {k} of text" for k in range(20)}
    assert len(spark.catalog.listTables()) == before
