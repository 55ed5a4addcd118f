"""Structure repair of conversations by a run-length DP.

Rows are sorted by conversation and turn over the whole cluster, so that a long conversation lies in many
tasks. A task reads its rows as a stream and turns each into one of nine symbols (role class, truncated or not,
or gone). Equal consecutive symbols are one run; a run's min-plus transition over the four states of
(s?(ua)+)? is advanced through cached binary powers. A conversation that lies inside one task and one chunk
is finished there. All others leave chunks of bounded size: their transitions, one small row each, give the
cost to go behind every chunk; then chunks are unrolled apart, for each state they may start in; and last
the chunks of a conversation are read in order for its audit and hash. SHA-256 and the audit are
sequential by definition, so the last step streams one conversation's chunks through one task, a batch at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from vigilspark.llm.common import partitions_for, slices, written

#: What counts as white space, and what ends a sentence.
WHITE, ENDS = " \t\n\x0b\x0c\r", ".!?"
#: Rows and text bytes of a chunk at most (one text may be longer).
CHUNK_ROWS, CHUNK_BYTES = 4096, 1 << 20
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
FAR = 1 << 60
#: States: 0 nothing yet, 1 behind system, 2 behind user, 3 behind assistant. NEXT is where an inserted or reroled row leads.
NEXT, ACCEPT = (2, 2, 3, 2), (0, FAR, FAR, 0)
KEPT = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})
#: Symbols are 2 x role class (system, user, assistant, other) + truncated; GONE must be deleted.
GONE = 8
ROLE_OF = {2: "user", 3: "assistant"}

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def role_class(role: str) -> int:
    return "sua".find(role[:1]) if role[:1] in ("s", "u", "a") else 3


def product(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(FAR, *(a[i][k] + b[k][j] for k in range(4))) for j in range(4)) for i in range(4))


def applied(a: Matrix, v: Vector) -> Vector:
    return tuple(min(FAR, *(a[i][k] + v[k] for k in range(4))) for i in range(4))


UNIT: Matrix = tuple(tuple(0 if i == j else FAR for j in range(4)) for i in range(4))


@cache
def inserts() -> Matrix:
    """Any number of inserted rows."""
    once = tuple(tuple(0 if i == j else INSERT if NEXT[i] == j else FAR for j in range(4)) for i in range(4))
    return product(once, once)  # behind two inserted rows a state comes again


def steps(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """What a row can become: letter, cost, state behind it."""
    found = [("D", DELETE, state)]
    if symbol != GONE:
        extra = TRUNCATED * (symbol & 1)
        if state in KEPT[symbol >> 1]:
            found.append(("K", KEEP + extra, KEPT[symbol >> 1][state]))
        found.append(("R", REROLE + extra, NEXT[state]))
    return found


@cache
def power(symbol: int, k: int) -> Matrix:
    """The transition of 2 to the k equal rows, with inserts before each."""
    if k:
        half = power(symbol, k - 1)
        return product(half, half)
    row = tuple(tuple(min([FAR, *(cost for _, cost, to in steps(symbol, i) if to == j)]) for j in range(4)) for i in range(4))
    return product(inserts(), row)


def run_matrix(symbol: int, length: int) -> Matrix:
    out = UNIT
    for k in range(length.bit_length()):
        if length >> k & 1:
            out = product(out, power(symbol, k))
    return out


@lru_cache(1 << 16)
def _advance(symbol: int, length: int, v: Vector) -> Vector:
    for k in range(length.bit_length()):
        if length >> k & 1:
            v = applied(power(symbol, k), v)
    return v


def advance(symbol: int, length: int, v: Vector) -> Vector:
    """Costs to go before a run, from those behind it. What is cached depends on their differences only."""
    low = min(v)
    return tuple(x + low for x in _advance(symbol, length, tuple(x - low for x in v)))


def end_costs() -> Vector:
    return applied(inserts(), ACCEPT)


def runs(symbols: bytes) -> list[tuple[int, int]]:
    return [(s, sum(1 for _ in g)) for s, g in groupby(symbols)]


def matrix(symbols: bytes) -> Matrix:
    out = UNIT
    for symbol, length in runs(symbols):
        out = product(out, run_matrix(symbol, length))
    return out


@lru_cache(1 << 16)
def _choices(symbol: int, before: Vector, behind: Vector, state: int) -> tuple[str, int]:
    """The least letters for one row, and the state behind it."""
    letters = ""
    while True:
        found = [(letter, to) for letter, cost, to in steps(symbol, state) if behind[to] + cost == before[state]]
        if before[NEXT[state]] + INSERT == before[state]:
            found.append(("I", NEXT[state]))
        letter, state = min(found)
        letters += letter
        if letter != "I":
            return letters, state


def unroll(symbols: bytes, behind: Vector, state: int) -> tuple[str, int]:
    """The ASCII-least of the cheapest audits of rows in a state, given the costs to go behind them, and the state they lead to."""
    edges = [behind]
    parts = runs(symbols)
    for symbol, length in reversed(parts):
        edges.append(advance(symbol, length, edges[-1]))
    out = []
    for (symbol, length), last in zip(parts, reversed(edges[:-1]), strict=True):
        inner = [last]
        for _ in range(length):
            inner.append(advance(symbol, 1, inner[-1]))
        for k in range(length, 0, -1):
            low = min(inner[k - 1])
            letters, state = _choices(symbol, tuple(x - low for x in inner[k]), tuple(x - low for x in inner[k - 1]), state)
            out.append(letters)
    return "".join(out), state


def closing(state: int) -> tuple[str, int]:
    """Inserted rows that end a conversation."""
    letters = ""
    while ACCEPT[state]:
        letters, state = letters + "I", NEXT[state]
    return letters, state


def repaired(audit: str, symbols: bytes, roles: list[str], texts: list[str], state: int) -> Iterator[str]:
    """The lines role:text that an audit leaves. roles and texts are of the rows that are not gone."""
    row = of = 0
    for letter in audit:
        if letter == "I":
            state = NEXT[state]
            yield f"{ROLE_OF[state]}:"
            continue
        symbol, row = symbols[row], row + 1
        if letter == "K":
            state = KEPT[symbol >> 1][state]
            yield f"{roles[of]}:{texts[of]}"
        elif letter == "R":
            state = NEXT[state]
            yield f"{ROLE_OF[state]}:{texts[of]}"
        of += symbol != GONE


class Digest:
    """SHA-256 of lines joined by newlines, a line at a time."""

    def __init__(self) -> None:
        self.sha, self.any = hashlib.sha256(), False

    def add(self, lines: Iterator[str]) -> None:
        for line in lines:
            self.sha.update(("\n" + line if self.any else line).encode())
            self.any = True


class Piece:
    """Rows of one conversation as they come, and what they tell."""

    def __init__(self, conv) -> None:
        self.conv = conv
        self.clear()

    def clear(self) -> None:
        self.symbols, self.roles, self.texts, self.size = bytearray(), [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.first_role = self.last_role = None

    def add(self, turn, role: str, fault: int, first: bool, copies: int, text: str) -> None:
        """fault: 0 none, 1 truncated, 2 blank."""
        if not copies:
            return
        if turn is not None:
            self.turns += turn != self.last_turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        initial = role[:1]
        if self.first_role is None:
            self.first_role = initial
        else:
            self.illegal += not legal(self.last_role, initial)
        self.illegal += (copies - 1) * (not legal(initial, initial))
        self.last_role = initial
        if fault == 2:
            self.blank += copies
            self.symbols += bytes([GONE]) * copies
        elif not first:
            self.duplicate += copies
            self.symbols += bytes([GONE]) * copies
        else:
            self.duplicate += copies - 1
            self.truncated += fault
            self.symbols += bytes([2 * role_class(role) + fault]) + bytes([GONE]) * (copies - 1)
            self.roles.append(role), self.texts.append(text)
            self.size += len(text)

    def told(self) -> list:
        return [self.first_turn, self.last_turn, self.turns, self.first_role, self.last_role, self.blank, self.duplicate, self.truncated, self.illegal]

    def finished(self) -> list:
        behind, symbols = end_costs(), bytes(self.symbols)
        cost = behind
        for symbol, length in reversed(runs(symbols)):
            cost = advance(symbol, length, cost)
        audit, state = unroll(symbols, behind, 0)
        audit += closing(state)[0]
        digest = Digest()
        digest.add(repaired(audit, symbols, self.roles, self.texts, 0))
        return [cost[0], audit, digest.sha.hexdigest()]


def legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


_TOLD = "first_turn bigint, last_turn bigint, turns bigint, first_role string, last_role string, blank bigint, duplicate bigint, truncated bigint, illegal bigint"
_PIECE = f"part int, k int, {_TOLD}, cost bigint, audit string, sha string, symbols binary, roles array<string>, texts array<string>, step array<bigint>"


def streamed(kind: str) -> tuple:
    """From sorted rows to finished conversations and to chunks (k is null for the first)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, piece, first, split, mark = TaskContext.get().partitionId(), 0, None, True, False, None
        names = ["conv_id", *(c.split(" ")[0] for c in _PIECE.split(", "))]
        out, size = [], 0

        def chunk(piece: Piece) -> list:
            nonlocal k
            symbols, k = bytes(piece.symbols), k + 1
            return [piece.conv, part, k - 1, *piece.told(), None, None, None, symbols, list(piece.roles), list(piece.texts), [x for row in matrix(symbols) for x in row]]

        def done(piece: Piece) -> list:
            return [piece.conv, part, None, *piece.told(), *piece.finished(), None, None, None, None]

        def flush() -> pa.RecordBatch:
            nonlocal out, size
            columns = list(zip(*out, strict=True))
            out, size = [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        types = None
        for batch in slices(batches, "text"):
            if types is None:
                long, text = pa.int64(), pa.string()
                types = [batch.column("conv_id").type, pa.int32(), pa.int32(), long, long, long, text, text, long, long, long, long, long, text, text, pa.binary(), pa.list_(text), pa.list_(text), pa.list_(long)]
            for conv, turn, role, key, is_row, copies, fault, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "digest", "is_row", "copies", "fault", "text")), strict=True):
                if piece is None or piece.conv != conv:
                    if piece is not None:
                        out.append(chunk(piece) if first or split else done(piece))
                        size += piece.size + len(piece.symbols)
                        first = split = False
                    piece, mark = Piece(conv), None
                if not is_row:
                    mark = (turn, role, key)
                    continue
                own = mark == (turn, role, key)
                piece.add(turn, role or "", fault, own, copies, text or "")
                if own:
                    mark = None
                if len(piece.symbols) >= CHUNK_ROWS or piece.size >= CHUNK_BYTES:
                    out.append(chunk(piece))
                    size, split = size + piece.size, True
                    piece.clear()
                if size >= CHUNK_BYTES or len(out) >= CHUNK_ROWS:
                    yield flush()
        if piece is not None:
            out.append(chunk(piece))  # the next task may go on with it
        if out:
            yield flush()

    return run, f"conv_id {kind}, {_PIECE}"


def costs_behind(kind: str) -> tuple:
    """From the chunks of whole conversations, last first, to the costs to go behind each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, v = None, None
        for batch in batches:
            out = []
            for c, part, k, step in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "part", "k", "step")), strict=True):
                if v is None or c != conv:
                    conv, v = c, end_costs()
                out.append((part, k, list(v)))
                v = applied(tuple(tuple(step[4 * i : 4 * i + 4]) for i in range(4)), v)
            if out:
                part, k, behind = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(k, pa.int32()), pa.array(behind, pa.list_(pa.int64()))], ["part", "k", "behind"])

    return run, "part int, k int, behind array<bigint>"


def unrolled(schema) -> tuple:
    """Adds to each chunk the audits for every state it may start in, and the states they lead to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            audits, ends = [], []
            for symbols, behind in zip(batch.column("symbols").to_pylist(), batch.column("behind").to_pylist(), strict=True):
                found = [unroll(symbols, tuple(behind), q) for q in range(4)]
                audits.append([a for a, _ in found]), ends.append([q for _, q in found])
            yield batch.append_column("audits", pa.array(audits, pa.list_(pa.string()))).append_column("ends", pa.array(ends, pa.list_(pa.int32())))

    return run, StructType([*schema.fields]).add("audits", ArrayType(StringType())).add("ends", ArrayType(IntegerType()))


_RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def joined(kind: str) -> tuple:
    """From the chunks of whole conversations, first first, to one row for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv = total = None
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if total is None or r["conv_id"] != conv:
                    if total is not None:
                        rows.append(total.row())
                    conv, total = r["conv_id"], Whole(r["conv_id"], r)
                total.add(r)
            yield from _result(rows, batch.column("conv_id").type)
        if total is not None:
            yield from _result([total.row()], batch.column("conv_id").type)

    return run, f"conv_id {kind}, {_RESULT}"


class Whole:
    """A conversation from its chunks."""

    def __init__(self, conv, first: dict) -> None:
        self.conv, self.state, self.audit, self.digest = conv, 0, [], Digest()
        self.first_turn = self.last_turn = self.last_role = self.cost = None
        self.turns, self.counts = 0, [0, 0, 0, 0]

    def add(self, r: dict) -> None:
        if self.cost is None:
            step = r["step"]
            self.cost = min(step[k] + b for k, b in enumerate(r["behind"]))
        if r["first_turn"] is not None:
            self.turns += r["turns"] - (r["first_turn"] == self.last_turn)
            self.first_turn = r["first_turn"] if self.first_turn is None else self.first_turn
            self.last_turn = r["last_turn"]
        self.counts = [a + r[c] for a, c in zip(self.counts, ("blank", "duplicate", "truncated", "illegal"), strict=True)]
        if r["first_role"] is not None:
            self.counts[3] += self.last_role is not None and not legal(self.last_role, r["first_role"])
            self.last_role = r["last_role"]
        audit = r["audits"][self.state]
        self.digest.add(repaired(audit, r["symbols"], r["roles"], r["texts"], self.state))
        self.audit.append(audit)
        self.state = r["ends"][self.state]

    def row(self) -> list:
        letters = closing(self.state)[0]
        self.digest.add(repaired(letters, b"", [], [], self.state))
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        return [self.conv, gaps, *self.counts, self.cost, "".join(self.audit) + letters, self.digest.sha.hexdigest()]


def _result(rows: list[list], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    if rows:
        types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        names = ["conv_id", *(c.split(" ")[0] for c in _RESULT.split(", "))]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def damaged(conversations: DataFrame) -> DataFrame:
    """Damage by crc32 of conv_id:turn modulo 20 (nulls: one space): adds copies (0: dropped), changes role and text."""
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", some("role").alias("role"), some("text").alias("text"), (F.crc32(F.concat(some("conv_id"), F.lit(":"), some("turn")).cast("binary")) % 20).alias("_d"))
    role = F.when(F.col("_d") == 4, "user").otherwise(F.col("role"))
    text = F.when(F.col("_d") == 1, "").when(F.col("_d") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    copies = F.when(F.col("_d") == 0, 0).when(F.col("_d") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))


def fault(text: Column) -> Column:
    """2 blank, 1 truncated, 0 none of these."""
    bare = F.rtrim(text, F.lit(WHITE))
    return F.when(bare == "", 2).when(F.substring(bare, -1, 1).isin(*ENDS), 0).otherwise(1)


def repair(conversations: DataFrame, copies: str | None = None, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are taken by turn (nulls first), then role and hash of the text; rows that are equal in all of these come
    together. Of these, the first is the original and the others are duplicates. Null roles and texts count as
    one space, which is no role and blank. A null id is a conversation of its own. copies: a column that tells
    how often each row stands there; a conversation all of whose rows have 0 gets zeros, an empty audit and the
    hash of nothing. Turns are whole numbers. Other columns are not read; an empty table gives an empty result.
    """
    named = {"conv_id": id_col, "turn": turn_col, "role": role_col, "text": text_col}
    n = F.col(f"`{copies}`").cast("int") if copies else F.lit(1)
    rows = conversations.select(*((F.col(f"`{c}`") if k == "conv_id" else F.col(f"`{c}`").cast("bigint") if k == "turn" else F.coalesce(F.col(f"`{c}`"), F.lit(" "))).alias(k) for k, c in named.items()), n.alias("copies"))
    kind = dict(rows.dtypes)["conv_id"]
    parts = partitions_for(conversations)
    rows = rows.withColumn("fault", fault(F.col("text")))
    there = (F.col("copies") > 0) & (F.col("fault") < 2)
    rows = rows.withColumn("digest", F.when(there, F.unhex(F.sha2("text", 256))))
    # where each role and text of a conversation comes first: a mark that sorts right before its row
    seen = rows.filter(there).groupBy("conv_id", "role", "digest").agg(F.max(F.col("turn").isNull()).alias("_none"), F.min("turn").alias("_turn"))
    none = lambda t: F.lit(None).cast(t)
    marks = seen.select("conv_id", F.when(~F.col("_none"), F.col("_turn")).alias("turn"), "role", none("string").alias("text"), F.lit(0).alias("copies"), F.lit(0).alias("fault"), "digest", F.lit(False).alias("is_row"))
    text = F.when(there, F.col("text"))
    both = rows.withColumns({"text": text, "is_row": F.lit(True)}).unionByName(marks)
    key = ["conv_id", "turn", "role", "digest"]
    run, schema = streamed(kind)
    pieces = written(both.repartitionByRange(parts, *key).sortWithinPartitions(*key, "is_row").mapInArrow(run, schema), "conversations")
    done = pieces.filter("k IS NULL")
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0))
    done = done.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.col("sha").alias("repaired_sha256"))
    chunks = pieces.filter("k IS NOT NULL").drop("cost", "audit", "sha")
    run, schema = costs_behind(kind)
    behind = chunks.select("conv_id", "part", "k", "step").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("k")).mapInArrow(run, schema)
    known = chunks.join(behind, ["part", "k"])
    known = known.mapInArrow(*unrolled(known.schema))
    long = known.repartition("conv_id").sortWithinPartitions("conv_id", "part", "k").mapInArrow(*joined(kind))
    return done.unionByName(long)
