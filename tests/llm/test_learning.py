"""What the models learn, against plain loops: a language's four-grams, and the words' context vectors."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from vigilspark.llm import language_id, quality


def prose(rnd: random.Random, words: list[str], n: int) -> str:
    return " ".join(rnd.choice(words) for _ in range(n))


def four_grams(text: str) -> list[int]:
    out = bytearray(b" ")
    for b in text.lower().encode():
        out.append(b if b >= 128 or 97 <= b <= 122 else 32)
    out.append(32)
    return [int.from_bytes(out[k : k + 4], "big") for k in range(len(out) - 3) if out[k : k + 4].count(32) < 2]


def test_four_grams_of_a_language(spark):
    rnd = random.Random(3)
    words = {"de": ["Straße", "schön", "und", "Öl", "x", "2024!", "der"], "en": ["the", "of", "Street", "and", "on-line", "a"], "fr": ["été", "où", "l'eau", "ça"]}
    rows = [(k, prose(rnd, words[lang], rnd.randint(0, 30)), lang) for k, lang in enumerate(rnd.choice(list(words)) for _ in range(90))]
    rows += [(None, "ohne Kennung", "de"), (1, None, "en"), (2, "no language", None), (3, "doppelt " * 30, "de"), (3, "doppelt " * 30, "de")]
    found = language_id.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3), learn_docs=10**6, kept=25)
    counts = defaultdict(Counter)
    for _, text, lang in rows:
        if lang:
            counts[lang].update(four_grams(text or ""))
    top = {lang: np.array([c for _, c in sorted(((k, c) for c, k in n.items()), reverse=True)[:25]], np.uint32) for lang, n in counts.items()}
    want = language_id.Filters(top, Counter(lang for _, _, lang in rows if lang))
    assert found.names == want.names and (found.masks == want.masks).all() and (found.false == want.false).all()
    for _, text, lang in rows[:90]:
        codes, n = language_id.grams(pa.array([text]))
        assert codes.tolist() == four_grams(text) and n.tolist() == [len(codes)]
        if len(codes) > 20:
            assert found.decide(pa.array([text]))[0] == [lang]


def test_context_vectors_of_words(spark):
    rnd = random.Random(5)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(40)]
    texts = {k: prose(rnd, words, rnd.randint(0, 25)) for k in range(30)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame([(k, k % 2) for k in range(30)], "doc_id bigint, quality int")
    model = quality.learn(docs, labels)

    def index(token: int) -> np.ndarray:
        out = np.zeros(quality.DIM)
        for at, sign in quality.index_places(np.array([token], np.uint64)):
            out[at[0]] += sign[0]
        return out

    streams = [[s.tolist() for s in quality.streams(pa.array([t]))[0]] for t in texts.values()]
    seen = Counter(token for both in streams for tokens in both for token in set(tokens))
    kept = sorted(token for token, k in seen.items() if k > 2)
    assert model.words.tolist() == kept and len(kept) > 20
    sums = {token: np.zeros(quality.DIM) for token in kept}
    for both in streams:
        for tokens in both:
            for k, token in enumerate(tokens):
                if token in sums:
                    for j in (k - 2, k - 1, k + 1, k + 2):
                        if 0 <= j < len(tokens):
                            sums[token] += index(tokens[j])
    want = np.array([v / (np.linalg.norm(v) + 1e-9) for v in sums.values()])
    assert np.abs(model.context - want).max() < 1e-5
