"""Personal data: base spans against the plain patterns, disguises by hand."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from vigilspark.llm import pii
from vigilspark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain(text: str) -> list[tuple[str, int, int]]:
    """The contract's patterns as they stand."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        total = sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(reversed(d)))
        if 14 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def told(spans) -> str:
    order = {"email": 0, "ip": 1, "card": 2, "phone": 3}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], order[s[0]])))


def test_op12(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op12_pii"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts) and sum(r.n_card + r.n_email for r in rows) > 0
    for r in rows:
        want = plain(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in want) for kind in pii.KINDS]
        assert r.base_sha256 == hashlib.sha256(told(want).encode()).hexdigest()
        assert r.spans == told(want) and r.n_added == 0  # clean texts are left alone


def test_base_equals_patterns_on_random_texts():
    rnd = random.Random(5)
    for _ in range(20000):
        text = "".join(rnd.choice("aZ09.@-+ %_()1234567éa.@1") for _ in range(rnd.randint(0, 60)))
        assert sorted(pii.base_spans(text)) == sorted(plain(text)), text
    for _ in range(3000):
        text = "".join(rnd.choice(["411111", "1111", " ", "-", "2", "+1", "255", ".", "256", "(", ")", "x"]) for _ in range(rnd.randint(0, 14)))
        assert sorted(pii.base_spans(text)) == sorted(plain(text)), text


CARD = "4111111111111111"
DISGUISED = [
    ("email", "jane-at-example-dot-com"), ("email", "jane_doe_at_mail_dot_example_dot_org"), ("email", "und.34 at mail7.example.com"), ("email", "john7 at mail3.example.com"),
    ("email", "john dot smith at mail3 dot example dot com"), ("phone", "+1 (two four three) five five five-four five two six"), ("ip", "97(dot)51(dot)17(dot)173"),
    ("phone", "+44\u00a020\u00a07946\u00a00958"), ("card", "4111\u20131111\u20131111\u20131111"), ("ip", "192\u00ad.168.1.20"),
    ("email", "jane.doe at example dot com"), ("email", "jane.doe (at) example (dot) com"), ("email", "jane[at]example.co[dot]uk"), ("email", "jane {AT} example.com"),
    ("email", "jаne@exаmple.com"), ("email", "jane＠example．com"), ("email", "jane @ example . com"), ("email", "ja​ne@exam​ple.com"), ("email", "jane arroba example punto com"),
    ("ip", "192 dot 168 dot 1 dot 20"), ("ip", "192[.]168[.]1[.]20"), ("ip", "one nine two dot one six eight dot one dot two zero"), ("ip", "１９２.１６８.１.２０"), ("ip", "192 . 168 . 1 . 20"),
    ("card", "four one one one one one one one one one one one one one one one"), ("card", "４１１１１１１１１１１１１１１１"), ("card", "41l1 1111 11l1 1111"),
    ("card", "4111 1111 1111 1111"), ("card", "٤١١١١١١١١١١١١١١١"),
    ("phone", "+1 (O17) 555-77l3"), ("phone", "plus one two zero two five five five zero one seven three"), ("phone", "+４４ ２０ ７９４６ ０９５８"), ("phone", "+44 two zero 7946 zero nine five eight"),
    ("phone", "plus four double four two zero seven nine four six one"),
]


@pytest.mark.parametrize("kind,text", DISGUISED)
@pytest.mark.parametrize("before,after", [("", ""), ("Schön, write to: ", ", please."), ("x (see é): ", "\nthen go")])
def test_disguises(kind, text, before, after):
    whole = before + text + after
    assert not [s for s in plain(whole) if s[0] == kind]
    found = pii.added_spans(whole, pii.base_spans(whole))
    assert [(k, whole[a:b]) for k, a, b in found if k == kind] == [(kind, text)]
    assert pii.masked(whole, found) == f"{before}[{kind}]{after}"


CLEAN = [
    "Read more at docs.example.com and look at 5 at en.example.org", "state-of-the-art dot-to-dot", "well-known at home.",
    "They met at the house. Dot com was a bubble.", "one two three four", "Look at example.com for more", "The null hypothesis, six of one", "at 5 . 10 we left",
    "éèü – 12 — 13", "I lost 100 of 1000", "un deux trois, cinq", "plus 1234567890 more", "4 1 l I O", "Seven at nine", "a @ b", "(at) night",
]


@pytest.mark.parametrize("text", CLEAN)
def test_clean_texts_stay_alone(text):
    assert pii.added_spans(text, pii.base_spans(text)) == []


def test_base_spans_stay_and_added_ones_keep_apart():
    text = f"mail bob@example.com or bob (at) example.com, {CARD} and {CARD[:8]} {CARD[8:]}"
    base = pii.base_spans(text)
    both = base + pii.added_spans(text, base)
    assert [text[a:b] for k, a, b in sorted(both, key=lambda s: s[1])] == ["bob@example.com", "bob (at) example.com", CARD, f"{CARD[:8]} {CARD[8:]}"]
    near = "bob@example.com (dot) au"
    assert pii.added_spans(near, pii.base_spans(near)) == []


def test_long_runs_are_linear(spark):
    size = 300_000
    for text in ("a" * size, "1" * size, "1." * size, "+" * size, "+1" + "-" * size, "one " * (size // 4), " (at)" * (size // 5), ". " * size, "@" * size, "a@" * size, "O" * size, "-" * size + "1", "at a dot " * (size // 9), "a1 at " * (size // 6), "a.b-at-" * (size // 7), "_dot_" * (size // 5), "a." * size):
        pii.added_spans(text, pii.base_spans(text))


def test_odd_cases(spark):
    docs = spark.createDataFrame([(1, None, 2), (2, "", 3), (3, "a@b.co", 4), (3, "a@b.co", 4), (None, "x", 1)], "doc_id bigint, text string, n_email int")
    rows = pii.find_pii(docs).collect()
    assert len(rows) == 5 and {r.spans for r in rows} == {"", "email:0:6"}
    assert sorted(r.text for r in pii.mask_pii(docs).collect()) == ["", "", "[email]", "[email]", "x"]
    assert pii.find_pii(docs.limit(0)).count() == 0
