"""Small fixtures against brute force: nulls, empty and long texts, ties, repeated rows, empty tables and extra columns."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from vigilspark.llm import bpe, exact_dedup, fingerprints, jaccard_join, language_id, line_dedup, packing, pretokens, quality, shingles, token_counts, url_filters
from vigilspark.llm.components import components
from vigilspark.llm.queries import tokenizer

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def prose(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(f"{WORDS[k % 12]}{k}" for k in rng.integers(0, 400, n))


BASE = prose(1, 120)
NEAR = BASE.replace(BASE.split()[60], "changed", 1)
LONG = prose(2, 30_000)
ODD = ["", None, " ", "\n\n", "a", "Two words", "x  y\t z\u00a0q", "tab\tand  two\n \nlines ", "<|endoftext|> in <|endoftext|>text", "déjà vu 中文 😀 don't I'LL", "one two three four five", "ONE two THREE four FIVE"]
TEXTS = [*ODD, BASE, NEAR, BASE, "line a\nline b\nline c\nline d", "head\nline a\nline b\nline c\ntail", "r\nr\nr\nr\nr", LONG, LONG + " end"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "kept") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "en", "kept"), (12, BASE, "en", "kept")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string").repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


def text_of(row) -> str:
    return row["text"] or ""


def test_bpe_equals_library_and_round_trips(docs, nothing):
    import public_tokenizers
    import tiktoken

    path = tokenizer("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(path), special_tokens={})
    got = sorted((r.doc_id, list(r.ids), bytes(r.decoded)) for r in bpe.decode(bpe.encode(docs, path), path).collect())
    want = sorted((r.doc_id, library.encode_ordinary(text_of(r)), text_of(r).encode()) for r in docs.collect())
    assert got == want
    assert bpe.decode(bpe.encode(nothing, path), path).count() == 0


def test_bpe_decodes_null_and_keeps_columns(spark):
    path = tokenizer("byte_bpe_multi_50k.tiktoken")
    rows = spark.createDataFrame([(1, None, "x"), (2, [], "y")], "doc_id bigint, ids array<int>, decoded string")
    assert [(r.doc_id, r.decoded) for r in bpe.decode(rows, path).orderBy("doc_id").collect()] == [(1, None), (2, bytearray())]


def test_parts_join_to_text():
    texts = [t for t in TEXTS if t] + ["a  b", " a", "a ", "a \n b", "\x1c a", ""]
    parts = pretokens.Parts(pa.array(texts))
    names, of = pretokens.distinct([parts])
    edge = np.concatenate([[0], np.cumsum(parts.of_text)])
    assert ["".join(names[k] for k in of[a:b]) for a, b in zip(edge, edge[1:])] == texts
    assert len(set(names)) == len(names)


def test_parts_with_one_hash_stay_apart():
    parts = pretokens.Parts(pa.array(["one two two", "six"]))
    parts.key[:] = 7
    names, of = pretokens.distinct([parts])
    assert [names[k] for k in of] == ["one", " two", " two", "six"]


def test_words_of_parts():
    import public_tokenizers
    import regex

    parts = ["one", " two,", "a\tb", " ", "\n\n x", " I'll", "\x1c q", "\u3000z", " <|endoftext|>", "\n"]
    names, size, flat = bpe.words_of(parts)
    ends = np.cumsum(size)
    assert [[names[k] for k in flat[e - n : e]] for e, n in zip(ends, size)] == [regex.findall(public_tokenizers.PATTERN, p) for p in parts]
    assert len(set(names)) == len(names)


def test_token_counts_equal_library(docs, nothing):
    from tokenizers import Tokenizer

    path = tokenizer("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    n = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for r in token_counts.count_tokens(docs, path, 10).collect():
        text = TEXTS[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n(text), n(text) > 10)
        head = text.encode()[: r.fit_bytes].decode()
        assert n(head) <= 10 and (r.fit_bytes == r.n_bytes) == (not r.over_limit)
    assert token_counts.count_tokens(nothing, path).count() == 0


def test_every_prefix_count():
    from tokenizers import Tokenizer

    path = tokenizer("byte_bpe_50k.json")
    counter, library = token_counts.counter(path), Tokenizer.from_file(path)
    for word in (" internationalization", "aaaaaaaaaaaa", " zzyzx", "''''''''", "0123456789"):
        count, last = [0], [b""]
        counter.prefixes(word.encode(), count, last)
        assert count == [len(library.encode(word[:k], add_special_tokens=False).ids) for k in range(len(word) + 1)]
    assert counter.fit("one two three four", 2) == len("one two")


def test_prefix_table(docs):
    path = tokenizer("byte_bpe_50k.json")
    totals = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(docs, path).collect()}
    for r in token_counts.prefix_table(docs, path).collect():
        assert (r.ends[-1], r.counts[-1]) == totals[r.doc_id]


def test_prefixes_within_words(spark):
    from tokenizers import Tokenizer

    path = tokenizer("byte_bpe_50k.json")
    counter, library = token_counts.counter(path), Tokenizer.from_file(path)
    n = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    odd = ["漢字かな交じり文" * 9, "a\tb\tc\n\nd \n  e", "internationalization" * 5, "we've  they'll\n\n  you're''re", "x!!<|endoftext|>  <|endoftext|><|endoftext|> y ", "\x1c \u3000 z  ", "日本 don't\u00a0 end😀 "]
    for text in [*odd, *(t for t in ODD if t)]:
        want = [n(text[:k]) for k in range(len(text) + 1)]
        ends = [len(text[:k].encode()) for k in range(len(text) + 1)]
        got = counter.prefix_counts(text)
        assert (list(got[0]), list(got[1])) == (ends, want)
        for limit in range(max(want) + 1):
            assert counter.fit(text, limit) == max(e for e, w in zip(ends, want, strict=True) if w <= limit)
    rows = spark.createDataFrame(list(enumerate(odd)), "doc_id bigint, text string")
    for r in token_counts.count_tokens(rows, path, 7).collect():
        text = odd[r.doc_id]
        assert r.fit_bytes == max(len(text[:k].encode()) for k in range(len(text) + 1) if n(text[:k]) <= 7)
    for r in token_counts.prefix_table(rows, path).collect():
        assert r.counts == [n(odd[r.doc_id][:k]) for k in range(len(odd[r.doc_id]) + 1)]


def test_packing(docs, nothing):
    from tokenizers import Tokenizer

    path = tokenizer("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    pieces = packing.pack(docs, path, 64).collect()
    of, spans = defaultdict(list), defaultdict(list)
    encoded = [library.encode(t or "", add_special_tokens=False).ids + [0] for t in TEXTS]
    for p in pieces:
        ids, whole = np.frombuffer(p.ids, "<u4").tolist(), encoded[p.doc_id]
        assert p.length == len(ids) > 0 and p.doc_tokens == len(whole) and ids == whole[p.start : p.start + p.length]
        spans[p.sequence_id].append((p.offset, p.length))
        of[p.doc_id].append(p.length)
    rows = defaultdict(int)
    for r in docs.collect():
        rows[r.doc_id] += 1
    assert all(sum(n) == rows[i] * len(encoded[i]) for i, n in of.items()) and len(of) == len(TEXTS)
    full = []
    for s in sorted(spans):
        at = 0
        for o, n in sorted(spans[s]):
            assert o == at
            at += n
        full.append(at)
    assert all(n == 64 for n in full[:-1]) and sorted(spans) == list(range(len(spans)))
    assert packing.pack(nothing, path).count() == 0


def test_exact_dedup(docs, nothing):
    groups = defaultdict(list)
    for r in docs.collect():
        groups[text_of(r)].append(r.doc_id)
    want = sorted((i, max(g), len(g), i == max(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g)
    for support in (0.2, 0.001):
        assert sorted(map(tuple, exact_dedup.exact_dedup(docs, support=support).collect())) == want
    assert exact_dedup.exact_dedup(nothing).count() == 0


def test_exact_dedup_null_ids(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (None, "b"), (5, "b")], "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(df).collect()), key=str)
    assert got == sorted([(None, None, 2, True), (None, None, 2, True), (None, 5, 2, False), (5, 5, 2, True)], key=str)


def brute_lines(rows):
    seen, gone = {}, defaultdict(set)
    for i, t in sorted(set(rows)):
        lines = t.split("\n")
        for k in range(len(lines) - 2):
            w = tuple(lines[k : k + 3])
            if not re.search(r"\S", "".join(w)):
                continue
            if w not in seen:
                seen[w] = (i, k)
            else:
                first = seen[w]
                gone[i, t] |= set(range(max(k, first[1] + 3) if first[0] == i else k, k + 3))
    return {(i, t): "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i, t]) for i, t in rows}


def test_line_dedup(docs, nothing):
    got = line_dedup.dedup_lines(docs)
    assert got.columns == [*docs.columns, "n_lines", "n_removed", "deduped"]
    want = brute_lines([(r.doc_id, text_of(r)) for r in docs.collect()])
    for r in got.collect():
        assert r.deduped == want[r.doc_id, text_of(r)]
        assert r.n_lines == len(text_of(r).split("\n"))
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_line_dedup_random(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), "\n".join(rng.choice(list("abc "), rng.integers(0, 14)))) for i in range(60)]
    want = brute_lines(rows)
    for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect():
        assert r.deduped == want[r.doc_id, r.text]


URLS = [
    "http://example.org/es/x", "https://A.Example.ORG/es/", "http://example.org/es", "http://example.org/en/12", "http://notexample.org/es/x", "http://x.com/fr/1?u=/de/", "http://x.com/de/#a", "x.com/de/",
    None, "", "://", "http://com/de/", "http://org", "http://org/", "http://example.org:80/es/", "ftp://a//b://c/d", "http://EXAMPLE.org/en/1?x",
]


def brute_url(url, rules=url_filters.RULES):
    rest = (url or "").split("://", 1)[1] if "://" in (url or "") else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[1], max(fits)[2]) if fits else (host, path, None, "allow")


@pytest.mark.parametrize("most", [100, 2])
def test_url_filters(spark, most):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate([*URLS, URLS[0]])], "page_id bigint, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filters.filter_urls(pages, max_broadcast=most).collect()}
    assert got == {i: brute_url(u) for i, u in enumerate([*URLS, URLS[0]])}
    rules = spark.createDataFrame(list(url_filters.RULES), "host string, path string, verdict string")
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filters.filter_urls(pages, rules, max_broadcast=most).collect()} == got
    assert url_filters.filter_urls(pages.limit(0)).count() == 0


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute_groups(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return sorted((i, len(s), find(i)) for i, s in sets)


def test_shingle_sets():
    flat, sizes = shingles.sets(pa.array([t or "" for t in TEXTS]))
    assert sizes.tolist() == [len(shingle_set(t)) for t in TEXTS] and len(flat) == sizes.sum()


def test_one_word_longer_than_a_step():
    long = "w" * (2 * shingles.STEP + 5)
    words, n = shingles.word_hashes(np.frombuffer(f"{long} {long} {long}x".encode(), np.uint8), np.array([0, 3 * len(long) + 3]))
    assert n.tolist() == [3] and words[0] == words[1] != words[2]


def test_jaccard_groups(docs, nothing):
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_groups(docs).collect())
    assert got == brute_groups([(r.doc_id, r.text) for r in docs.collect()])
    assert jaccard_join.jaccard_groups(nothing).count() == 0


@pytest.mark.parametrize("per_row", [4, 0])
def test_jaccard_groups_of_near_copies(spark, monkeypatch, per_row):
    monkeypatch.setattr(jaccard_join, "PER_ROW", per_row)
    monkeypatch.setattr(jaccard_join, "CHUNK", 16)
    rng = np.random.default_rng(5)
    base, rows = prose(9, 80).split(), []
    for i in range(60):
        words = list(base)
        for at in rng.integers(0, 80, rng.integers(0, 4)):
            words[at] = f"new{rng.integers(0, 9)}"
        rows.append((i * 3, " ".join(words[: rng.integers(60, 81)])))
    rows += [(1000 + i, prose(100 + i, 30)) for i in range(20)]
    got = jaccard_join.jaccard_groups(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(map(tuple, got.collect())) == brute_groups(rows)


def test_jaccard_rows_of_one_id(spark):
    a, b, c = (prose(k, 40) for k in (21, 22, 23))
    rows = [(1, a), (5, a), (5, b), (7, b), (7, None), (8, c), (9, ""), (None, b), (None, prose(24, 40))]
    got = jaccard_join.jaccard_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id or 99, r.component_id or 99) for r in got) == [(1, 1), (5, 1), (5, 1), (7, 1), (7, 1), (8, 8), (9, 9), (99, 1), (99, 99)]


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 102), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "x bigint, y bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in (100, 101, 102)}


def test_fingerprints(docs, nothing):
    rows = {r.doc_id: text_of(r) for r in docs.collect()}
    ids = sorted(rows)
    one = docs.dropDuplicates(["doc_id"])
    own = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(docs).collect()}
    got = fingerprints.compare_neighbours(one).collect()
    assert len(got) == len(rows)
    for r in got:
        text, after = rows[r.doc_id], rows[ids[(ids.index(r.doc_id) + 1) % len(ids)]]
        new = text[: len(text) - len(text) // 4] + after[: len(text) // 4]
        jaccard = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        assert (r.n_chars, r.edited_sha256, r.fingerprint) == (len(text), hashlib.sha256(new.encode()).hexdigest(), own[r.doc_id])
        if min(len(shingle_set(text)), len(shingle_set(new))) > 50:
            assert abs(r.near_edited - jaccard(shingle_set(text), shingle_set(new))) < 0.12
        if min(len(shingle_set(text)), len(shingle_set(after))) > 50 or text == after:  # two sets of a few shingles can agree by chance
            assert abs(r.near_next - jaccard(shingle_set(text), shingle_set(after))) < 0.12
    assert own[12] == own[14] and own[0] == own[1] == ""
    assert fingerprints.compare_neighbours(nothing).count() == 0
    assert fingerprints.compare_neighbours(docs).count() == docs.count()


def test_fingerprints_of_short_texts():
    texts = [prose(100 + k, n) for k, n in enumerate([1, 2, 3, 5, 5, 6, 7, 9] * 8)]
    rows = fingerprints.sketches(pa.array(texts))
    for i, a in enumerate(texts):
        for j, b in enumerate(texts[:i]):
            if not shingle_set(a) & shingle_set(b):
                assert fingerprints.likeness(rows[i], rows[j]) < 0.12
    ten = prose(5, 14)
    a, b = fingerprints.sketches(pa.array([ten, f"{ten} behind"]))
    assert 0.6 < fingerprints.likeness(a, b) <= 1 and fingerprints.likeness(a, a) == 1


def labelled(spark, n=400):
    rng, rows, labels = np.random.default_rng(11), [], []
    for i in range(n):
        good = i % 4 != 0
        words = prose(i, int(rng.integers(5, 60))).split()
        text = " ".join(words) if good else " ".join(f"{w.upper()}!!" for w in words)
        rows.append((i, text, "x"))
        labels.append((i, int(good), 0))
    return spark.createDataFrame(rows, "doc_id bigint, text string, score string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_quality(spark, docs, nothing):
    rows, labels = labelled(spark)
    model = quality.learn(rows, labels.filter("doc_id % 5 <> 0"))
    got = {r.doc_id: r for r in quality.score(rows, model).collect()}
    held = [i for i in got if i % 5 == 0]
    assert np.mean([got[i].predicted == (i % 4 != 0) for i in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    assert quality.score(docs, model).count() == docs.count() and quality.score(nothing, model).count() == 0
    assert quality.tagged(rows, model).columns == ["doc_id", "text", "score", "predicted"]
    untaught = quality.learn(rows, labels.limit(0))
    assert {r.score for r in quality.score(rows, untaught).collect()} == {0.5}


def test_language_id(spark, docs, nothing):
    en, fr = "the and of thing with that when".split(), "le la des être où très été".split()
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(rng.choice(en if i % 2 else fr, 30)), "en" if i % 2 else "fr") for i in range(300)] + [(900, "12 34 !?", "en"), (901, None, None), (902, "", "fr")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    filters = language_id.learn(table.filter("doc_id % 3 <> 1"))
    got = {r.doc_id: r for r in language_id.identify(table, filters).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows[:300])
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and got[900].score == 0
    assert language_id.identify(docs, filters).count() == docs.count() and language_id.identify(nothing, filters).count() == 0
    assert language_id.tagged(docs, filters).columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    assert language_id.identify(docs, language_id.learn(nothing)).count() == docs.count()


def test_filter_tells_all_languages():
    codes = np.arange(1000, 5000, dtype=np.uint32)
    filters = language_id.Filters({f"l{k:02d}": codes[k * 10 : k * 10 + 2000] for k in range(70)})
    found = filters.counts(codes[690:1990], np.array([1300]))
    assert found.shape == (1, 70) and (found > 1290).all()


def test_crc_of_pieces(spark):
    from pyspark.sql import functions as F

    path = tokenizer("byte_bpe_50k.json")
    piece = packing.pack(spark.createDataFrame([(1, "abc def")], "doc_id bigint, text string"), path).select("ids", F.crc32("ids").alias("c")).first()
    assert piece.c == zlib.crc32(bytes(piece.ids))
