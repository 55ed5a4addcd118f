"""The registered queries on the smallest tables, columns and all, against brute force; and models by hand."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.test_operators import brute_groups, brute_lines
from vigilspark.llm import fingerprints, language_id, quality, shingles
from vigilspark.llm.queries import QUERIES, tokenizer

SF = "/root/testdata/sf0.001"
sha = lambda data: hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def got(spark):
    held = {}

    def run(name):
        if name not in held:
            held[name] = QUERIES[name](spark, SF).collect()
        return held[name]

    return run


def fold(i: int, n: int) -> int:
    return zlib.crc32(str(i).encode()) % n


def test_op1(texts, got):
    import public_tokenizers
    import tiktoken

    from vigilspark.llm.bpe import ranks

    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(tokenizer("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    want = {i: (len(ids), sha(",".join(map(str, ids)).encode()), sha(t.encode())) for i, t in texts.items() for ids in [library.encode_ordinary(t)]}
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got("op1_byte_bpe")} == want


def test_op2(texts, got):
    left = brute_lines(sorted(texts.items()))
    assert {r.doc_id: r.text_sha256 for r in got("op2_line_dedup")} == {i: sha(t.encode()) for (i, _), t in left.items()}


def test_op3(texts, got):
    groups = defaultdict(list)
    for i, t in texts.items():
        groups[t].append(i)
    want = {i: (max(groups[t]), len(groups[t]), i == max(groups[t]), sha(t.encode())) for i, t in texts.items()}
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got("op3_exact_dedup")} == want


def test_op4(texts, got):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    n = {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in texts.items()}
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in got("op4_token_counts")} == {i: (len(t.encode()), n[i], n[i] > 512) for i, t in texts.items()}


def test_op5(texts, got):
    from tokenizers import Tokenizer

    library, seen, spans = Tokenizer.from_file(tokenizer("byte_bpe_50k.json")), Counter(), []
    ids = {i: library.encode(t, add_special_tokens=False).ids + [0] for i, t in texts.items()}
    for r in got("op5_packing"):
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert (r.length, r.doc_tokens, r.ids_crc32) == (len(part), len(ids[r.doc_id]), zlib.crc32(part.tobytes()))
        assert r.offset + r.length <= 1024
        seen[r.doc_id] += r.length
        spans.append((r.sequence_id * 1024 + r.offset, r.length))
    assert seen == {i: len(x) for i, x in ids.items()}
    spans.sort()
    assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:], strict=False))


def test_op6(spark, got):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
    want = {}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        rest = (r.url or "").partition("://")[2]
        cut = min([k for k in map(rest.find, "/?#") if k >= 0], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].partition("#")[0].partition("?")[0]
        fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        want[r.page_id] = (host, path, *(max(fits)[1:] if fits else (None, "allow")))
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got("op6_url_filters")} == want


def test_op7(texts, got):
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got("op7_ngram_jaccard")) == sorted(brute_groups(sorted(texts.items())))


def sketch_by_hand(text: str) -> list[int] | None:
    """The fingerprint's values, bin by bin, in plain whole numbers."""
    mask = (1 << 64) - 1

    def mix(x):
        x ^= x >> 30
        x = x * 0xBF58476D1CE4E5B9 & mask
        x ^= x >> 27
        x = x * 0x94D049BB133111EB & mask
        return x ^ x >> 31

    held = {}
    for h in map(int, shingles.sets(pa.array([text]))[0]):
        b = h >> 55
        held[b] = min(held.get(b, h), h)
    if not held:
        return None
    out = []
    for b in range(512):
        at, attempt = b, 0
        if b not in held and len(held) == 1:
            at = next(iter(held))
        while at not in held:
            at = mix(b + ((attempt + 1) << 20)) % 512
            attempt += 1
        out.append((held[b] if b in held else mix(held[at] ^ mix(b + (1 << 40)))) & 15)
    return out


def test_op8(texts, got):
    ids = sorted(texts)
    rows = {r.doc_id: r for r in got("op8_fingerprints")}
    assert sorted(rows) == ids
    prints = {i: sketch_by_hand(texts[i]) for i in ids}
    like = lambda a, b: float(a is b) if a is None or b is None else max(0.0, (np.mean(np.array(a) == np.array(b)) - 1 / 16) / (15 / 16))
    for k, i in enumerate(ids):
        nxt, r = ids[(k + 1) % len(ids)], rows[i]
        n = len(texts[i]) // 4
        edited = texts[i][: len(texts[i]) - n] + texts[nxt][:n]
        own, new = prints[i], sketch_by_hand(edited)
        assert (r.n_chars, r.edited_sha256) == (len(texts[i]), sha(edited.encode()))
        assert r.fingerprint == ("" if own is None else "".join(f"{v:x}" for v in own)) and r.edited_fingerprint == ("" if new is None else "".join(f"{v:x}" for v in new))
        assert abs(r.near_edited - like(own, new)) < 1e-9 and abs(r.near_next - like(own, prints[nxt])) < 1e-9


def test_ranges_grow_and_split_hot_ids(spark):
    rows = [(i, h) for i in (1, 5, 9, fingerprints.NONE) for h in (-(1 << 62), -3, 0, 1 << 62)]
    df = spark.createDataFrame(rows, "doc_id bigint, h bigint")
    for cuts in ([], [5], [1, 5, 5, 5, 9], [5] * 3 + [fingerprints.NONE] * 4, list(range(0, 2000, 2))):
        found = [r[0] for r in fingerprints.with_range(df, cuts).orderBy("doc_id", "h").select("r").collect()]
        assert found == sorted(found)
    assert len({r[0] for r in fingerprints.with_range(df.filter("doc_id = 5"), [1, 5, 5, 5, 9]).select("r").collect()}) == 3


def test_repeated_and_null_ids_are_neighbours(spark):
    rows = [(7, f"text number {k} of many words here") for k in range(40)] + [(None, f"other {k} of many words here too") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    out = fingerprints.compare_neighbours(docs).collect()
    assert len(out) == 80 and sum(r.doc_id is None for r in out) == 40


def test_op9(spark, texts, got):
    """Folds, and each score by a forward pass in plain loops over the learned model."""
    from pyspark.sql import functions as F

    from vigilspark.llm.queries import fold as fold_column

    rows = {r.doc_id: r for r in got("op9_quality")}
    assert sorted(rows) == sorted(texts) and all(r.held_out == (fold(i, 5) == 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for i, r in rows.items())
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.learn(docs, labels.filter(fold_column(5) != 0))
    net, place = model.network, {int(w): k for k, w in enumerate(model.words)}
    for i in sorted(texts)[:25]:
        both, n = quality.streams(pa.array([texts[i]]))
        size, out, norms = max(int(n[0]), 1), [], []
        for hashes in both:
            index, context, known = np.zeros(quality.DIM), np.zeros(quality.DIM), 0
            for h in hashes:
                for at, sign in quality.index_places(np.array([h], np.uint64)):
                    index[at[0]] += sign[0]
                if int(h) in place:
                    context += model.context[place[int(h)]]
                    known += 1
            out += [*(index / size), *(context / size), known / size]
            norms += [np.sqrt(sum((index / size) ** 2)), np.sqrt(sum((context / size) ** 2))]
        x = (np.array([*out, *norms, np.log1p(n[0])]) - net.mean) / net.scale
        hidden = [max(0.0, sum(x * net.p[0][:, k]) + net.p[1][k]) for k in range(len(net.p[1]))]
        z = sum(h * w for h, w in zip(hidden, net.p[2], strict=True)) + net.p[3][0]
        assert abs(1 / (1 + np.exp(-np.clip(z / net.temperature, -30, 30))) - rows[i].score) < 1e-4
    known = {r.doc_id: r.quality for r in labels.filter(F.col("quality").isNotNull()).collect()}
    held = [(known[i], rows[i].predicted) for i in known if i in rows and fold(i, 5) == 0]
    assert np.mean([a == b for a, b in held]) > 0.9


def test_quality_of_one_kind(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c"), (None, "d"), (4, None)], "doc_id bigint, text string")
    for y in (0, 1):
        model = quality.learn(docs, spark.createDataFrame([(1, y), (2, y)], "doc_id bigint, quality int"))
        assert {r.score for r in quality.score(docs, model).collect()} == {float(y)}
    none = quality.learn(docs, spark.createDataFrame([], "doc_id bigint, quality int"))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}


def test_op10(spark, texts, got):
    """Folds, and each decision by sets in place of the bit-sliced filter."""
    from vigilspark.llm.queries import fold as fold_column

    rows = {r.doc_id: r for r in got("op10_language_id")}
    assert sorted(rows) == sorted(texts) and all(r.held_out == (fold(i, 3) == 1) for i, r in rows.items())
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    filters = language_id.learn(docs.filter(fold_column(3) != 1))
    lang = {r.doc_id: r.lang for r in docs.collect()}
    bits = {name: {(k, int(s)) for k in range(1) for s in np.flatnonzero(filters.masks[0] >> np.uint64(b) & np.uint64(1))} for b, name in enumerate(filters.names)}
    for i in sorted(texts)[:40]:
        codes, _ = language_id.grams(pa.array([texts[i]]))
        places = [tuple(int(at[0]) for at in language_id.slots(np.array([c], np.uint32))) for c in codes]
        count = {}
        for b, name in enumerate(filters.names):
            hits = sum(all((0, p) in bits[name] for p in ps) for ps in places)
            false = filters.false[b]
            count[name] = max(0.0, (hits - len(places) * false) / (1 - false))
        if not any(c.isalpha() for c in texts[i]):
            assert rows[i].lang_pred == "und"
            continue
        best = max(filters.names, key=lambda n, c=count: c[n])  # names come in order of learned rows, and the first of equals counts
        assert rows[i].lang_pred == best and abs(rows[i].score - (count[best] / max(sum(count.values()), 1e-9))) < 1e-6
    held = [(lang[i], rows[i].lang_pred) for i in texts if lang[i] and fold(i, 3) == 1 and rows[i].lang_pred != "und"]
    assert np.mean([a == b for a, b in held]) > 0.9


def test_ties_of_languages(spark):
    docs = spark.createDataFrame([(1, "same words here", "bb"), (2, "same words here", "bb"), (3, "same words here", "aa")], "doc_id bigint, text string, lang string")
    found = language_id.identify(docs, language_id.learn(docs)).collect()
    assert {r.lang_pred for r in found} == {"bb"}
    equal = language_id.identify(docs, language_id.learn(docs.filter("doc_id > 1"))).collect()
    assert {r.lang_pred for r in equal} == {"aa"}


def test_clashing_names_stay(spark):
    from vigilspark.llm import line_dedup

    docs = spark.createDataFrame([(1, "a\nb\nc\nd", 5, "x", "y"), (2, "a\nb\nc\ne", 6, "z", "w")], "doc_id string, text string, id int, h string, _text string")
    out = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    assert (out["1"].n_removed, out["2"].deduped, out["2"].id, out["2"].h, out["2"]._text) == (0, "e", 6, "z", "w")
    scored = quality.tagged(docs, quality.Model(np.zeros(0, np.uint64), np.zeros((0, 64), np.float32), None)).collect()
    named = language_id.tagged(docs, language_id.Filters({"en": np.array([1], np.uint32)})).collect()
    assert sorted(r._text for r in scored) == sorted(r._text for r in named) == ["w", "y"]
