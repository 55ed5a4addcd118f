"""Exact token counts of every prefix by dynamic programming over a byte-level BPE's merges.

For a pretoken, the last token of each prefix's encoding is the one vocabulary entry t that ends there
and that stays next to the last token before it: encoding those two strings together gives the two
tokens again. With that, count[i] = count[i - len(t)] + 1 at every byte i, in one pass, and a word's counts are
kept as a whole. A prefix of a text has the tokens of the pretokens before its end and the last one's count
up to there, so the kept counts answer how many tokens any prefix has, and how long the longest prefix
within a budget is. Only where a prefix of its own would be grouped differently, other words are looked up:
white space at its end, two letters of a contraction, and a special token that is cut.
"""

from __future__ import annotations

import functools
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vigilspark.llm.common import slices, texts_only
from vigilspark.llm.pretokens import PART_SLICE, PartCache

LIMIT = 512
#: Entries of a worker's word cache; beyond, it starts anew. Only speed depends on it.
MAX_WORDS = 300_000
#: Bytes of words in that cache, at most, beside those of one slice.
MAX_WORD_BYTES = 64 << 20
#: Pretokens whose first two characters are two pretokens.
CONTRACTIONS = {"'re", "'ve", "'ll"}
SCHEMA = "n_bytes bigint, n_tokens bigint, over_limit boolean, fit_bytes bigint"


def byte_letters() -> dict[str, int]:
    """The printable letters by which byte-level vocabulary files write bytes: printable Latin-1 ones stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def departures(file: dict) -> list[str]:
    """In what a tokenizers file is no plain byte-level BPE that cuts texts by the public pattern and has only special added tokens."""
    model, before = file["model"], file.get("pre_tokenizer") or {}
    found = {
        "another model": model.get("type") != "BPE",
        "another pre-tokenizer": before.get("type") != "ByteLevel" or not before.get("use_regex", True),
        "a prefix space": bool(before.get("add_prefix_space")),
        "a normalizer": bool(file.get("normalizer")),
        "dropout": bool(model.get("dropout")),
        "ignored merges": bool(model.get("ignore_merges")),
        "added tokens that are not special or take in blanks": any(not t["special"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in file["added_tokens"]),
    }
    return [name for name, holds in found.items() if holds]


class PrefixCounter:
    """Prefix token counts for a tokenizers file with a byte-level BPE. A file of another kind is an error, as its counts would not be the library's."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        if found := departures(file):
            raise ValueError(f"prefix counts do not hold for a file with {', '.join(found)}")
        letters = byte_letters()
        as_bytes = lambda s: bytes(map(letters.__getitem__, s))
        merges = [m.split(" ") if isinstance(m, str) else m for m in file["model"]["merges"]]
        self.ranks = {(as_bytes(a), as_bytes(b)): k for k, (a, b) in enumerate(merges)}
        self.special = [t["content"] for t in file["added_tokens"] if t["special"]]
        special = {as_bytes(t) for t in self.special if all(c in letters for c in t)}
        self.vocab = {as_bytes(t) for t in file["model"]["vocab"] if all(c in letters for c in t)} - special
        self.tails = {t[k:] for t in self.vocab for k in range(len(t))}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.edges: tuple[dict, dict] = ({}, {})
        self.words: dict[str, bytes | array] = {}
        self.held = 0
        import public_tokenizers

        self.find = regex.compile(public_tokenizers.PATTERN).findall
        self.blank = regex.compile(r"\s").match
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else None

    def edge(self, token: bytes, right: bool) -> tuple[list[bytes], list[float]] | None:
        """What stands at one end of a token while it is built, from its outer byte on, and the rank of the merge that takes each in. None if the merges don't build it."""
        known = self.edges[right]
        if token not in known:
            pieces, stands, taken = [token[k : k + 1] for k in range(len(token))], [], []
            stands.append(pieces[-right])
            while len(pieces) > 1:
                rank, at = min((self.ranks.get(pair, 1 << 60), k) for k, pair in enumerate(zip(pieces, pieces[1:], strict=False)))
                if rank == 1 << 60:
                    break
                pieces[at : at + 2] = [pieces[at] + pieces[at + 1]]
                if len(pieces[-right]) > len(stands[-1]):
                    taken.append(rank)
                    stands.append(pieces[-right])
            known[token] = (stands, [*taken, float("inf")]) if len(pieces) == 1 else None
        return known[token]

    def fits(self, left: bytes, right: bytes) -> bool:
        """Whether encoding left + right gives these two: no merge across the seam comes before those that build them."""
        found = self.pairs.get((left, right))
        if found is None:
            if len(self.pairs) > 300_000:
                self.pairs.clear()
            found = self.pairs[left, right] = self._fits(left, right)
        return found

    def _fits(self, left: bytes, right: bytes) -> bool:
        a, b = self.edge(left, True), self.edge(right, False)
        if a is None or b is None:
            return False
        (x, x_rank), (y, y_rank), i, j, last = a, b, 0, 0, float("inf")
        while True:
            across = self.ranks.get((x[i], y[j]), last)
            if across < x_rank[i] and across <= y_rank[j]:  # of equal merges the leftmost comes first
                return across == last
            if x_rank[i] == y_rank[j] == last:
                return True
            if x_rank[i] <= y_rank[j]:
                i += 1
            else:
                j += 1

    def prefixes(self, word: bytes, count: list[int], last: list[bytes]) -> None:
        """Brings count and last, which hold the first bytes' counts and last tokens, to the whole word: count[i] is of word[:i]."""
        tails, vocab, fits = self.tails, self.vocab, self.fits
        for to in range(len(count), len(word) + 1):
            at = to - 1
            while at and word[at - 1 : to] in tails:
                at -= 1
            for k in range(at, to):
                token = word[k:to]
                if token in vocab and (fits(last[k], token) if k else self.edge(token, True)):
                    count.append(count[k] + 1)
                    last.append(token)
                    break
            else:
                raise ValueError(f"the vocabulary can't encode {word!r}")

    def learn(self, words: set[str]) -> None:
        """Counts new words in sorted order, so that what one shares with the next at its start is counted once."""
        if len(self.words) > MAX_WORDS or self.held > MAX_WORD_BYTES:
            self.words.clear()
            self.held = 0
        before, count, last = b"", [0], [b""]
        for word in sorted(w.encode() for w in words if w not in self.words):
            same = 0
            for x, y in zip(before, word, strict=False):
                if x != y:
                    break
                same += 1
            del count[same + 1 :], last[same + 1 :]
            self.prefixes(word, count, last)
            self.words[word.decode()] = bytes(count) if len(word) < 256 else array("i", count)
            self.held += len(word) if len(word) < 256 else 4 * len(word)
            before = word

    def counts(self, word: str) -> bytes | array:
        """Tokens of the first bytes of a word, from none on."""
        if word not in self.words:
            self.learn({word})
        return self.words[word]

    def pretokens(self, text: str) -> tuple[int, list[str]]:
        """Number of special tokens, and pretokens. A special token's string counts as that token, as the library's default has it."""
        if self.cut and any(s in text for s in self.special):
            cut = self.cut(text)
            return len(cut) // 2, [w for p in cut[::2] for w in self.find(p)]
        return 0, self.find(text)

    def parts(self, texts: list[str]) -> list[tuple[int, int]]:
        """Bytes and tokens of each text."""
        found = [self.pretokens(t) for t in texts]
        self.learn({w for _, words in found for w in words})
        known = self.words
        return [(len(t.encode()), n + sum([known[w][-1] for w in words])) for t, (n, words) in zip(texts, found, strict=True)]

    def prefix_counts(self, text: str, budget: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of each prefix of whole characters, from the empty one on, and its tokens as a text of its own.

        With a budget, it may end where all longer prefixes have more tokens. White space is one word from its
        start on where a prefix ends in it. A cut special token is no special token, and goes with the word before it.
        """
        ends, totals = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
        cut = self.cut(text) if self.cut and any(s in text for s in self.special) else [text]
        at = base = 0
        if budget is None:
            self.learn({w for p in cut[::2] for w in self.find(p)})
        for k, piece in enumerate(cut):
            if k % 2:
                for j in range(1, len(piece)):
                    special, words = self.pretokens(last + piece[:j])
                    totals.append(np.array([safe + special + sum(self.counts(w)[-1] for w in words)]))
                base += 1
                totals.append(np.array([base]))
                ends.append(at + _char_ends(piece))
                at = int(ends[-1][-1])
                continue
            run, last, safe = "", "", base
            for last in self.find(piece):
                own, to = np.array(list(self.counts(last))), _char_ends(last)
                found = base + own[to]
                if not run:
                    safe = base
                if last in CONTRACTIONS:
                    found[1] = base + 2
                if self.blank(last[-1]):
                    kept = len(run.encode())
                    run += last
                    found = safe + np.array(list(self.counts(run)))[kept + to]
                elif run:
                    if self.blank(last[0]):
                        found[0] = safe + self.counts(run + last[0])[-1]
                    run, safe = "", base
                ends.append(at + to)
                totals.append(found)
                at += int(to[-1])
                base += int(own[-1])
                if budget is not None and safe >= budget:
                    return np.concatenate(ends), np.concatenate(totals)
        return np.concatenate(ends), np.concatenate(totals)

    def fit(self, text: str, budget: int) -> int:
        """Bytes of the longest prefix of whole characters with at most so many tokens, each taken as a text of its own."""
        ends, totals = self.prefix_counts(text, budget)
        within = np.flatnonzero(totals <= budget)  # white space at the end may group differently, so counts can also fall
        return int(ends[within[-1]]) if len(within) else 0


def _char_ends(text: str) -> np.ndarray:
    """Bytes up to the end of each character."""
    data = np.frombuffer(text.encode(), np.uint8)
    return np.append(np.flatnonzero((data & 0xC0) != 0x80)[1:], len(data))


@functools.cache
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_tokens, over_limit, fit_bytes.

    fit_bytes: bytes of the longest prefix of whole characters whose tokens, as a text of its own, number at
    most limit, so the text can be cut there. All prefixes that end in later parts (see pretokens) have more
    tokens than the part that crosses the limit leaves, so only that part's prefixes are looked up. Null texts count as empty: 0 bytes, 0 tokens. Repeated
    rows each get a row. Texts are never cut before counting. path: a tokenizers file with a byte-level BPE.
    """
    rows = texts_only(docs, id_col, text_col)
    kind = dict(rows.dtypes)["doc_id"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        known = PartCache(own.parts)
        for batch in slices(batches, most=PART_SLICE):
            parts, names, coded, of = known.texts(batch.column("text"))
            table = np.array(coded, np.int64).reshape(-1, 2)
            upto = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(table[of], axis=0)])  # bytes and tokens before each part
            edge = np.concatenate([[0], np.cumsum(parts.of_text)])
            n_bytes, n_tokens = np.diff(upto[edge], axis=0).T
            fit = n_bytes.copy()
            for k in np.flatnonzero(n_tokens > limit).tolist():  # the part that crosses the limit, and its own prefixes
                a, b = edge[k], edge[k + 1]
                at = a + int(np.searchsorted(upto[a + 1 : b + 1, 1], upto[a, 1] + limit, "right"))
                fit[k] = upto[at, 0] - upto[a, 0] + own.fit(names[of[at]], limit - int(upto[at, 1] - upto[a, 1]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_bytes), pa.array(n_tokens), pa.array(n_tokens > limit), pa.array(fit)], ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_bytes"])

    return rows.mapInArrow(count, f"doc_id {kind}, {SCHEMA}")


def prefix_table(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored table: doc_id, ends array<int> (bytes) and counts array<int> (tokens up to there), of every prefix of whole characters, from the empty one on."""
    rows = texts_only(docs, id_col, text_col)
    kind = dict(rows.dtypes)["doc_id"]

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in slices(batches):
            ends, counts = zip(*map(own.prefix_counts, batch.column("text").to_pylist()), strict=True)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ends, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))], ["doc_id", "ends", "counts"])

    return rows.mapInArrow(table, f"doc_id {kind}, ends array<int>, counts array<int>")
