"""Texts cut where a byte-level BPE's pretokens always end, so that pieces can be encoded once each.

The pretoken pattern takes a blank only as the first character of a token or inside a run of white space.
A single blank between two other characters is therefore always the start of a token, and no alternative
looks back. So a text is cut before such blanks, and each part's tokens are those of the part alone. Cuts and
the search for equal parts are numpy steps over all bytes of a slice; only different parts become strings.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa

from vigilspark.llm.common import raw
from vigilspark.llm.shingles import mix

#: Entries of a worker's part cache; beyond, it starts anew. Only speed depends on it.
MAX_CACHED = 300_000
#: Text bytes of the slices that are cut at once.
PART_SLICE = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


@functools.cache
def _spaces() -> tuple[np.ndarray, np.ndarray]:
    """White space: a table of single bytes, and the sorted UTF-8 codes of wider characters."""
    import regex

    blank = [chr(k) for k in range(0x3001) if chr(k).isspace() or regex.match(r"\s", chr(k))]
    table = np.zeros(256, bool)
    table[[ord(c) for c in blank if ord(c) < 128]] = True
    return table, np.sort([int.from_bytes(c.encode(), "big") for c in blank if ord(c) > 127])


def starts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the parts of texts that lie end to end in data begin: at each text's start and before each cut blank."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n > 2:
        space, wide = _spaces()
        cut[1 : n - 1] = (data[1:-1] == 32) & ~space[data[:-2]] & ~space[data[2:]]
        at = np.flatnonzero(cut)
        at = at[(data[at - 1] > 127) | (data[at + 1] > 127)]
        if len(at):
            around = np.concatenate([np.zeros(3, np.uint8), data, np.zeros(3, np.uint8)]).astype(np.int64)
            byte = lambda k: around[at + 3 + k]
            codes = ((byte(1) << 8) | byte(2), (byte(1) << 16) | (byte(2) << 8) | byte(3), (byte(-2) << 8) | byte(-1), (byte(-3) << 16) | (byte(-2) << 8) | byte(-1))
            beside = np.zeros(len(at), bool)
            for code in codes:
                beside |= np.isin(code, wide)
            cut[at[beside]] = False
    full = ends[1:] > ends[:-1]
    cut[ends[1:][full] - 1] = False  # a blank at a text's end has nothing behind it
    cut[ends[:-1][full]] = True
    return np.flatnonzero(cut[:n])


class Parts:
    """The parts of some texts: their bytes, places, number in each text, and two 64-bit hashes by which equal ones are found."""

    def __init__(self, texts: pa.Array):
        """At most 2 GB of texts."""
        self.data, ends = raw(texts)
        self.start = starts(self.data, ends)
        self.size = np.diff(np.append(self.start, len(self.data))).astype(np.int32)
        self.of_text = np.searchsorted(self.start, ends[1:]) - np.searchsorted(self.start, ends[:-1])
        self.key = self.check = np.zeros(0, np.uint64)
        if len(self.start):
            place = np.arange(len(self.data), dtype=np.int32) - np.repeat(self.start.astype(np.int32), self.size)
            one = _values()[((place & 63) << 8) | self.data]
            if self.size.max() > 64:
                one *= (place >> 6).astype(np.uint64) * _ODD * np.uint64(2) + np.uint64(1)
            self.key = np.add.reduceat(one, self.start)
            self.check = np.bitwise_xor.reduceat(one, self.start)
        self.start = self.start.astype(np.int32)


@functools.cache
def _values() -> np.ndarray:
    """A random 64-bit value for each byte at each of 64 places."""
    return mix(np.arange(1, 64 * 256 + 1, dtype=np.uint64) * _ODD)


def distinct(slices: Sequence[Parts]) -> tuple[list[str], np.ndarray]:
    """The different parts of some slices, and for each part, in order, its number among them."""
    key, check, size = (np.concatenate([getattr(s, name) for s in slices]) for name in ("key", "check", "size"))
    base = np.cumsum([0, *(len(s.data) for s in slices)])
    start = np.concatenate([s.start + b for s, b in zip(slices, base, strict=False)])
    data = np.concatenate([s.data for s in slices]).tobytes()
    _, first, of = np.unique(key, return_index=True, return_inverse=True)
    same = first[of]
    names = [data[a : a + k].decode() for a, k in zip(start[first].tolist(), size[first].tolist(), strict=True)]
    if (check[same] != check).any() or (size[same] != size).any():  # different parts with one hash: by the strings themselves
        number: dict[str, int] = {}
        of = np.array([number.setdefault(data[a : a + k].decode(), len(number)) for a, k in zip(start.tolist(), size.tolist(), strict=True)], np.int64)
        names = list(number)
    return names, of


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers start[k] .. start[k] + size[k] - 1 for each k, in order."""
    ends = np.cumsum(size, dtype=np.int64)
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int64)


class PartCache:
    """What each part encodes to, kept in two generations of bounded size, so that frequent parts stay."""

    def __init__(self, encode: Callable[[list[str]], Sequence], most: int = MAX_CACHED):
        """encode: from a list of texts to what each encodes to, in order."""
        self.encode, self.most, self.known, self.before = encode, most, {}, {}

    def texts(self, texts: pa.Array) -> tuple[Parts, list[str], list, np.ndarray]:
        """The texts' parts; the different ones, what each of them encodes to, and the number of each part among them."""
        if len(self.known) > self.most:
            self.known, self.before = {}, self.known
        known, before = self.known, self.before
        parts = Parts(texts)
        names, of = distinct([parts])
        fresh = []
        for name in names:
            if name not in known:
                if name in before:
                    known[name] = before[name]
                else:
                    fresh.append(name)
        known.update(zip(fresh, self.encode(fresh), strict=True))
        return parts, names, [known[name] for name in names], of

    def encoded(self, texts: pa.Array) -> tuple[np.ndarray, list, np.ndarray]:
        """How many parts each text has, what the different parts encode to, and the number of each part among them."""
        parts, _, coded, of = self.texts(texts)
        return parts.of_text, coded, of


class WholeTexts:
    """Each text as one part, for encoders that may not see it cut."""

    def __init__(self, encode: Callable[[list[str]], Sequence]):
        self.encode = encode

    def encoded(self, texts: pa.Array) -> tuple[np.ndarray, list, np.ndarray]:
        return np.ones(len(texts), np.int64), list(self.encode(texts.to_pylist())), np.arange(len(texts))
