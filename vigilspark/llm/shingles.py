"""Hashes of words and of five-word shingles, computed for many texts at once.

Words are runs of other bytes than ASCII white space, with A-Z lower-cased. A word's hash is a polynomial
over random 64-bit values of its bytes, found for all words from one running sum; a shingle's mixes five
word hashes. A text with fewer words has its whole sequence as its one shingle, one without words none.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

from vigilspark.llm.common import raw

WORDS = 5
#: Bytes that one step of the polynomial holds; longer texts go in steps that end between words.
STEP = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """White space, lower-cased bytes' random values, powers of the base and their inverses."""
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    values = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
    values[65:91] = values[97:123]
    base = 0xD1342543DE82EF95
    powers = np.full(STEP + 1, base, np.uint64)
    inverse = np.full(STEP + 1, pow(base, -1, 1 << 64), np.uint64)
    powers[0] = inverse[0] = 1
    return space, values, np.multiply.accumulate(powers), np.multiply.accumulate(inverse)


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the texts that lie end to end in data, and each text's number of words."""
    space, values, powers, inverse = _tables()
    blank = space[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True  # words end where texts end
    start = ~blank & (edge[:-1] | np.concatenate([[True], blank[:-1]]))
    stop = ~blank & (edge[1:] | np.concatenate([blank[1:], [True]]))
    starts, stops = np.flatnonzero(start), np.flatnonzero(stop) + 1
    del blank, edge, start, stop
    out = np.empty(len(starts), np.uint64)
    k = 0
    while k < len(starts):
        a = starts[k]
        to = max(k + 1, int(np.searchsorted(stops, a + STEP, "right")))
        b = stops[to - 1]
        if b - a > STEP:  # one word longer than a step
            parts = [_run(values, powers, data[x : min(x + STEP, b)]) for x in range(a, b, STEP)]
            total = np.zeros(1, np.uint64)
            for part in parts:
                total = mix(total * _ODD + part)
            out[k:to] = total
        else:
            sums = np.zeros(b - a + 1, np.uint64)
            np.cumsum(values[data[a:b]] * powers[: b - a], out=sums[1:])
            out[k:to] = (sums[stops[k:to] - a] - sums[starts[k:to] - a]) * inverse[starts[k:to] - a]
        k = to
    out = mix(out + (stops - starts).astype(np.uint64) * _ODD)
    return out, np.searchsorted(starts, ends[1:]) - np.searchsorted(starts, ends[:-1])


def _run(values, powers, data):
    return np.array([np.sum(values[data] * powers[: len(data)], dtype=np.uint64)], np.uint64)


def shingle_hashes(words: np.ndarray, n_words: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of texts, with repeats, and each text's number of them."""
    ends = np.cumsum(n_words)
    starts = ends - n_words
    n = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    total = np.zeros(max(0, len(words)), np.uint64)
    short = []
    for k in range(size):
        total *= _ODD
        if k < len(words):
            total[: len(words) - k] += words[k:]
    hashes = mix(total)
    for i in np.flatnonzero((n_words > 0) & (n_words < size)):
        x = 0
        for w in words[starts[i] : ends[i]]:
            x = (x * int(_ODD) + int(w)) % (1 << 64)
        short.append((starts[i], mix(np.array([x ^ int(n_words[i])], np.uint64))[0]))
    for at, x in short:
        hashes[at] = x
    keep = np.arange(int(n.sum())) + np.repeat(starts - (np.cumsum(n) - n), n)
    return hashes[keep], n


def sets(column: pa.Array, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The texts' shingle sets: distinct hashes, sorted within each text, end to end, and the sets' sizes."""
    data, ends = raw(column)
    flat, n = shingle_hashes(*word_hashes(data, ends), size)
    out, sizes, at = [], np.zeros(len(n), np.int64), 0
    for i, k in enumerate(n.tolist()):
        if k:
            one = np.unique(flat[at : at + k])
            at += k
            out.append(one)
            sizes[i] = len(one)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), sizes
