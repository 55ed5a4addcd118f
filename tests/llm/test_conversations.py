"""Structure repair against a plain search over whole conversations."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import cache

import pytest

from vigilspark.llm import conversations as c
from vigilspark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(rows: list[tuple]) -> tuple:
    """rows: turn, role, text in order. What the contract asks for, by trying every edit."""
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))

    after = lambda state, role: {"s": "s", "u": "u", "su": "u", "ua": "a", "au": "u"}.get(state + role)

    @cache
    def best(i: int, state: str, room: int) -> tuple[int, str]:
        found = [(0, "")] if i == len(rows) and state in ("", "a") else []
        if room:
            found += [(3 + cost, "I" + letters) for r in "ua" if (to := after(state, r)) is not None for cost, letters in [best(i, to, room - 1)]]
        if i < len(rows):
            found += [(4 + cost, "D" + letters) for cost, letters in [best(i + 1, state, 2)]]
            if faults[i] not in ("blank", "duplicate"):
                more = 3 * (faults[i] == "truncated")
                if rows[i][1][:1] in tuple("sua") and (to := after(state, rows[i][1][:1])) is not None:
                    found += [(more + cost, "K" + letters) for cost, letters in [best(i + 1, to, 2)]]
                found += [(3 + more + cost, "R" + letters) for r in "ua" if (to := after(state, r)) is not None for cost, letters in [best(i + 1, to, 2)]]
        return min(found, default=(1 << 40, ""))

    for i in range(len(rows), -1, -40):
        for state in ("", "s", "su", "u", "a"):
            best(i, state, 2)
    cost, audit = best(0, "", 2)
    at, last, lines = 0, "", []
    for letter in audit:
        if letter == "I":
            last = "a" if last == "u" else "u"
            lines.append(f"{ {'u': 'user', 'a': 'assistant'}[last]}:")
            continue
        _, role, text = rows[at]
        at += 1
        if letter == "K":
            last = role[0]
            lines.append(f"{role}:{text}")
        if letter == "R":
            last = "a" if last == "u" else "u"
            lines.append(f"{ {'u': 'user', 'a': 'assistant'}[last]}:{text}")
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damaged(rows) -> dict:
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        some = lambda x: " " if x is None else str(x)
        role, text, d = some(role), some(text), zlib.crc32(f"{some(conv)}:{some(turn)}".encode()) % 20
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        out[conv] += [(turn, "user" if d == 4 else role, text)] * {0: 0, 3: 2}.get(d, 1)
    return out


def placed(rows: list[tuple]) -> list[tuple]:
    key = lambda r: (r[0] is not None, r[0] or 0, *((True, r[1], hashlib.sha256(r[2].encode()).digest()) if r[2].strip(" \t\n\x0b\x0c\r") else (False,)))
    return sorted(rows, key=key)


def told(rows) -> dict:
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}


def test_op11(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = {k: brute(placed(v)) for k, v in damaged(rows).items()}
    got = QUERIES["op11_conversations"](spark, SF).collect()
    assert len(got) == len(want) and told(got) == want


def table(seed: int = 0, n: int = 60) -> list[tuple]:
    rnd = random.Random(seed)
    roles, texts = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "user2"], ["Yes.", "No!", "why", "", " \n", None, "Is it? ", "one. two", "é。"]
    out = []
    for conv in [None, *range(n)]:
        for turn in sorted(rnd.sample(range(40), rnd.randint(1, 12))):
            out.append((conv, None if rnd.random() < 0.03 and (not out or out[-1][0] != conv) else turn, rnd.choice(roles), rnd.choice(texts)))
    return out


@pytest.mark.parametrize("chunk", [3, 4096])
def test_chunks_and_tasks_do_not_tell(spark, monkeypatch, chunk):
    monkeypatch.setattr(c, "partitions_for", lambda df: 7)
    rows = table(chunk)
    long = [(10**6, t, "user" if t % 3 else "assistant", f"line {t % 50}{'.' * (t % 2)}") for t in range(400)]
    df = spark.createDataFrame(rows + long, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    run = c.streamed
    if chunk == 3:

        def small(kind):
            f, schema = run(kind)

            def g(batches):
                c.CHUNK_ROWS = 3
                yield from f(batches)

            return g, schema

        monkeypatch.setattr(c, "streamed", small)
    got = told(c.repair(c.damaged(df), "copies").collect())
    want = {k: brute(placed(v)) for k, v in damaged(rows + long).items()}
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == v, k


def test_runs_equal_steps():
    rnd = random.Random(3)
    for _ in range(200):
        symbols = bytes(s for _ in range(rnd.randint(0, 6)) for s in [rnd.randint(0, 8)] * rnd.choice([1, 1, 2, 7, 33]))
        v = c.end_costs()
        for s in reversed(symbols):
            v = c.applied(c.power(s, 0), v)
        assert c.applied(c.matrix(symbols), c.end_costs()) == v
        audit, state = c.unroll(symbols, c.end_costs(), 0)
        assert len(audit.replace("I", "")) == len(symbols)
        assert c.closing(state)[1] in (0, 3)


def test_odd_cases(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, digest int, part int, copies string"
    assert c.repair(spark.createDataFrame([], schema)).count() == 0
    same = [(1, 0, "user", "Hi.", 7, 7, "x")] * 50 + [(2, None, None, None, 1, 1, "y")] * 3 + [(3, 1, "assistant", "word " * 400_000, 0, 0, "z")]
    got = told(c.repair(spark.createDataFrame(same, schema)).collect())
    assert got[1] == brute([(0, "user", "Hi.")] * 50)
    assert got[2] == brute([(None, " ", " ")] * 3)
    assert got[3] == brute([(1, "assistant", "word " * 400_000)])
    none = spark.createDataFrame([(5, 0, "user", "Hi.", 0)], "conv_id bigint, turn bigint, role string, text string, n int")
    assert told(c.repair(none, "n").collect()) == {5: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
