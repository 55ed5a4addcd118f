"""Personal data by patterns, on texts and behind disguises.

Three transducers, one after the other, write a normalised text: look-alike characters become ASCII and
invisible ones go; spelled digits become digits; at and dot in words, brackets or blanks become @ and the
point. Each keeps where every piece of its output stood in its input, so a span that a pattern finds in the
normalised text is mapped back, transducer by transducer, to the source's code points. Each text is read by
itself where it lies; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from vigilspark.llm.common import slices, texts_only

KINDS = ("email", "ip", "card", "phone")
#: The contract's patterns. An email is sought by its @, and a number from the start of its digits,
#: which finds the same and stays linear in texts of one long run.
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int]


def emails(text: str) -> Iterator[Span]:
    end = 0
    for m in _AT.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            end = m.end()


def ips(text: str) -> Iterator[Span]:
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (p.lstrip("0") for p in m[0].split("."))):
            yield m.span()


def luhn(digits: str) -> bool:
    return sum(d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[Span]:
    for m in _PHONE.finditer(text):
        if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            yield m.span()


DETECT: dict[str, Callable[[str], Iterator[Span]]] = {"email": emails, "ip": ips, "card": cards, "phone": phones}


class Tape:
    """A transducer's output, and for each of its pieces where it began, and where that stood in the input."""

    def __init__(self, source: str, changes: Iterator[tuple[int, int, str]]) -> None:
        """changes: start, end and new text, in order and without overlap."""
        out, self.at, self.places, done, size = [], [], [], 0, 0
        for start, end, new in changes:
            for piece, place in ((source[done:start], (done, None)), (new, (start, end))):
                if piece:
                    self.at.append(size), self.places.append(place), out.append(piece)
                    size += len(piece)
            done = end
        if done < len(source) or not out:
            self.at.append(size), self.places.append((done, None)), out.append(source[done:])
        self.text = "".join(out)

    def _place(self, k: int) -> tuple[int, int]:
        """The input's span of one output character. A piece that was changed counts whole."""
        piece = bisect_right(self.at, k) - 1
        start, end = self.places[piece]
        return (start, end) if end is not None else (start + k - self.at[piece], start + k - self.at[piece] + 1)

    def back(self, start: int, end: int) -> Span:
        return self._place(start)[0], self._place(end - 1)[1]


#: Letters of other scripts that look like Latin ones, and characters that count as others.
LOOKALIKES = dict(zip("аеорсухіјѕԁһԛԝАВЕКМНОРСТУХІЈЅ", "aeopcyxijsdhqwABEKMHOPCTYXIJS", strict=True))
LOOKALIKES |= dict(zip("ανορικτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "avopiktuxABEZHIKMNOPTYX", strict=True))
LOOKALIKES |= dict.fromkeys("\u2010\u2011\u2012\u2013\u2014\u2212", "-") | dict.fromkeys("\u00a0\u2007\u2009\u202f\u3000", " ") | {"\u3002": "."}
INVISIBLE = "\u200b\u200c\u200d\u2060\ufeff\u00ad"
#: Letters that stand for digits inside a number.
DIGIT_LETTERS = {"O": "0", "o": "0", "I": "1", "l": "1"}
#: The digits' names in English, German, French and Spanish.
DIGIT_WORDS = (
    "zero|oh|null|zéro|cero", "one|eins|un|uno", "two|zwei|deux|dos", "three|drei|trois|tres", "four|vier|quatre|cuatro",
    "five|fünf|fuenf|cinq|cinco", "six|sechs|seis", "seven|sieben|sept|siete", "eight|acht|huit|ocho", "nine|neun|neuf|nueve",
)
TIMES = {"double": 2, "triple": 3}
#: Names of the signs.
AT_WORDS, DOT_WORDS, PLUS_WORDS = "at|arroba|arobase", "dot|punto|point|punkt", "plus|más|mas"

_STRANGE = re.compile(r"[^\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]")  # but Latin letters with accents
_MIXED = re.compile(r"(?<![A-Za-z0-9])[0-9OoIl]{3,}(?![A-Za-z0-9])")
_DIGIT_OF = {w: str(d) for d, words in enumerate(DIGIT_WORDS) for w in words.split("|")}
_WORD = f"(?:(?:{'|'.join(TIMES)})[ ])?(?:{'|'.join(sorted(_DIGIT_OF, key=len, reverse=True))})"
_SPELLED = re.compile(rf"(?<!\w)(?:(?:{PLUS_WORDS}) (?={_WORD}(?!\w)))?{_WORD}(?!\w)(?:[ -]{_WORD}(?!\w))*", re.I)
_OPEN, _CLOSE, _GAP = r"[(\[{<]", r"[)\]}>]", r"[ \t]{0,3}"
_LABEL = "[A-Za-z0-9-]{1,63}"
_BOX_DOT = rf"{_GAP}{_OPEN}{_GAP}(?:{DOT_WORDS}|\.){_GAP}{_CLOSE}{_GAP}"
_BARE_DOT = rf"[ \t]{{1,3}}(?:{DOT_WORDS})[ \t]{{1,3}}"
_WORD_LABEL = "[A-Za-z0-9]{1,63}"
_JOINED_DOT = rf"[_-](?:{DOT_WORDS})[_-]"
_BARE_AT = re.compile(rf"[ \t](?:{AT_WORDS})[ \t](?={_LABEL}(?:\.{_LABEL}){{1,4}}(?![A-Za-z0-9-]))", re.I)
# without one of these no sign is disguised
_HINT = re.compile(rf"[(\[{{<@]|[ \t_-](?:{DOT_WORDS}|\.)[ \t_-]", re.I)
_SIGNS = re.compile(
    rf"(?P<at>{_GAP}{_OPEN}{_GAP}(?:{AT_WORDS}|@){_GAP}{_CLOSE}{_GAP}"
    rf"|[ \t]{{1,3}}(?:{AT_WORDS})[ \t]{{1,3}}(?={_LABEL}(?:\.{_LABEL}){{0,4}}(?:{_BOX_DOT}|{_BARE_DOT})[A-Za-z0-9])"
    rf"|(?<=[A-Za-z0-9])[_-](?:{AT_WORDS})[_-](?={_WORD_LABEL}{_JOINED_DOT}[A-Za-z0-9])"
    r"|(?<=[A-Za-z0-9])[ \t]@[ \t]?(?=[A-Za-z0-9])|(?<=[A-Za-z0-9])@[ \t](?=[A-Za-z0-9]))"
    rf"|(?P<dot>(?<=[A-Za-z0-9])(?:{_BOX_DOT}|{_BARE_DOT}|{_JOINED_DOT}|[ \t]\.[ \t])(?=[A-Za-z0-9]))",
    re.I,
)


def plain_char(c: str) -> str:
    """What a character looks like in ASCII; itself where that is nothing."""
    if c in INVISIBLE:
        return ""
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    if unicodedata.category(c) == "Nd":
        return str(unicodedata.decimal(c))
    same = unicodedata.normalize("NFKC", c) if unicodedata.category(c) != "No" else c
    return same if len(same) == 1 and same.isascii() else c


def look_alikes(text: str) -> Iterator[tuple[int, int, str]]:
    for m in _STRANGE.finditer(text):
        if (new := plain_char(m[0])) != m[0]:
            yield *m.span(), new


def digit_letters(text: str) -> Iterator[tuple[int, int, str]]:
    """O, I and l in numbers that have more digits than letters."""
    for m in _MIXED.finditer(text):
        if not m[0].isdigit() and 2 * sum("0" <= c <= "9" for c in m[0]) > len(m[0]):
            for k, c in enumerate(m[0], m.start()):
                if c in DIGIT_LETTERS:
                    yield k, k + 1, DIGIT_LETTERS[c]


def spelled_digits(text: str) -> Iterator[tuple[int, int, str]]:
    """Each run of spelled digits becomes one number, with a sign if plus stands before it."""
    for m in _SPELLED.finditer(text):
        out, times = "", 1
        for word in re.split("[ -]", m[0].lower()):
            if word in TIMES:
                times = TIMES[word]
            elif word in _DIGIT_OF:
                out, times = out + _DIGIT_OF[word] * times, 1
            else:
                out += "+"
        yield *m.span(), out


def signs(text: str) -> Iterator[tuple[int, int, str]]:
    if not _HINT.search(text):
        return
    for m in _SIGNS.finditer(text):
        yield *m.span(), "@" if m["at"] else "."


def bare_at(text: str) -> Iterator[tuple[int, int, str]]:
    """A bare at between what looks like an account's name (it has a letter, and a digit or a sign) and a domain that is written out."""
    for m in _BARE_AT.finditer(text):
        start = end = m.start()
        while start and end - start < 65 and text[start - 1] in _LOCAL:
            start -= 1
        name = text[start:end]
        if 1 < len(name) < 65 and name[0].isalnum() and any(c.isalpha() for c in name) and any(not c.isalpha() and c not in "-%" for c in name):
            yield *m.span(), "@"


#: The transducers in order. Those on ASCII texts that have nothing to change give their input back.
TRANSDUCERS = (look_alikes, digit_letters, spelled_digits, signs, bare_at)


def normalised(text: str) -> tuple[str, list[Tape]]:
    tapes = []
    for step in TRANSDUCERS:
        if step is look_alikes and text.isascii():
            continue
        changes = list(step(text))
        if changes:
            tapes.append(Tape(text, iter(changes)))
            text = tapes[-1].text
    return text, tapes


def base_spans(text: str) -> list[tuple[str, int, int]]:
    return [(kind, *span) for kind in KINDS for span in DETECT[kind](text)]


def added_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans behind a disguise: found in the normalised text, changed by it, and apart from the base spans of their kind."""
    plain, tapes = normalised(text)
    if not tapes:
        return []
    out = []
    for kind in KINDS:
        held = sorted((a, b) for k, a, b in base if k == kind)
        starts = [a for a, _ in held]
        for found in DETECT[kind](plain):
            start, end = found
            for tape in reversed(tapes):
                start, end = tape.back(start, end)
            before = bisect_right(starts, end - 1) - 1
            if text[start:end] != plain[slice(*found)] and (before < 0 or held[before][1] <= start):
                out.append((kind, start, end))
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    The four counts and base_sha256 are of the base spans: what the patterns find in the text as it stands. spans
    are these and the n_added ones behind a disguise, as kind:start:end in code points (end exclusive), by start
    and kind. A span of one kind never overlaps a base span of the same kind. Null and empty texts have no
    spans and the hash of the empty string; repeated rows each get a row; an empty table gives an empty result;
    other columns are not read.
    """
    rows = texts_only(docs, id_col, text_col)
    kind = dict(rows.dtypes)["doc_id"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]
        for batch in slices(batches):
            rows = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                more = added_spans(text, base)
                counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
                rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + more), len(more)))
            columns = zip(zip(*rows, strict=True), [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()], strict=True)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in columns)], names)

    return rows.mapInArrow(find, f"doc_id {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint")


def masked(text: str, spans: list[tuple[str, int, int]], mark: str = "[{}]") -> str:
    """The text with each span, disguise and all, replaced by its kind. Of spans that overlap, the first, longest one stands."""
    out, done = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            out += [text[done:start], mark.format(kind)]
            done = end
    return "".join(out) + text[done:]


def mask_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text without personal data: each span is replaced by its kind in brackets. Null texts come back empty."""
    rows = texts_only(docs, id_col, text_col)
    kind = dict(rows.dtypes)["doc_id"]

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                out.append(masked(text, base + added_spans(text, base)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    return rows.mapInArrow(mask, f"doc_id {kind}, text string")
