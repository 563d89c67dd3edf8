"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, schemes, a plus before a
digit, digits beside digits, dots between digits, and words that announce an
identifier.  At each anchor a local parser finds how far the address or number
reaches to both sides and validates it.  An anchor inside what its parser has read
already is passed over, so the work is linear in the text.

The base kinds give the leftmost matches of their patterns that do not overlap; what
fails validation is dropped.  The other kinds need a cue, and only add spans.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
MORE = ("login", "iban", "ssn", "account")
KINDS = (*BASE, *MORE)

DIGITS = "0123456789"
# Words that announce an identifier.
CUES = {
    "iban": "iban",
    "ssn": "ssn",
    "social security": "ssn",
    "account": "account",
    "acct": "account",
    "konto": "account",
    "kontonummer": "account",
    "cuenta": "account",
    "compte": "account",
}

Span = tuple[int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_NUMBERS = re.compile(r"[0-9]++(?:\.[0-9]++)++")
_NUMBER = re.compile(r"[0-9]++")
_CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOGIN = re.compile(r"://[^\s/:@]++:[^\s/@]++@")
_IBAN = re.compile(r"[:\s]{0,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
_SSN = re.compile(r"[^0-9\n]{0,20}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9])")
_ACCOUNT = re.compile(r"(?:\s?(?:no|nr|number|num)\b\.?)?\s?[:#]?\s?([0-9](?:[\x20-]?[0-9]){5,17})(?![0-9])", re.IGNORECASE)


def _email(text: str, at: int, free: int) -> tuple[list[Span], int]:
    """Around the at-sign at ``at``; ``free`` is where the match before it ended."""
    start = at
    while start > free and text[start - 1] in _LOCAL:
        start -= 1
    domain = _DOMAIN.match(text, at + 1) if start < at else None
    return ([(start, domain.end())], domain.end()) if domain else ([], free)


def _ip(text: str, at: int, free: int) -> tuple[list[Span], int]:
    """Around a dot between digits: numbers and dots, taken four by four from the left."""
    if at < free:
        return [], free
    start = at
    while start > free and text[start - 1] in DIGITS:
        start -= 1
    end = _NUMBERS.match(text, start).end()
    parts = [m.span() for m in _NUMBER.finditer(text, start, end)]
    fours = [parts[k : k + 4] for k in range(0, len(parts) - 3, 4)]
    small = lambda s, e: e - s < 4 and int(text[s:e]) < 256 or int(text[s:e].lstrip("0")[:4] or 0) < 256
    return [(four[0][0], four[3][1]) for four in fours if all(small(*p) for p in four)], end


def luhn(digits: str) -> bool:
    """Whether the last digit checks those before it."""
    twice = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in twice)) % 10 == 0


def _card(text: str, at: int, free: int) -> tuple[list[Span], int]:
    """From a digit on that another one follows, with a blank or hyphen between them at most."""
    if at < free:
        return [], free
    end = _CHAIN.match(text, at).end()
    if end - at < 14:
        return [], end
    digits = text[at:end].replace(" ", "").replace("-", "")
    return ([(at, end)] if 14 <= len(digits) <= 19 and luhn(digits) else []), end


def _phone(text: str, at: int, free: int) -> tuple[list[Span], int]:
    found = _PHONE.match(text, at)
    if not found:
        return [], free
    n = sum(c in DIGITS for c in found.group())
    return ([found.span()] if 10 <= n <= 15 else []), found.end()


def _login(text: str, at: int, free: int) -> tuple[list[Span], int]:
    """A scheme, a name and a password before an at-sign."""
    found, start = _LOGIN.match(text, at), at
    while start > free and text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "+.-"):
        start -= 1
    return ([(start, found.end())], found.end()) if found and start < at else ([], free)


def _iban(text: str, at: int, free: int) -> tuple[list[Span], int]:
    """Behind its cue; blocks at the end that are no part of it are left off."""
    found = _IBAN.match(text, at)
    if not found:
        return [], free
    start, end = found.span(1)
    while end - start >= 15:
        code = text[start:end].replace(" ", "")
        if int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1:
            return [(start, end)], end
        end = text.rfind(" ", start, end)
    return [], free


def _ssn(text: str, at: int, free: int) -> tuple[list[Span], int]:
    found = _SSN.match(text, at)
    if not found:
        return [], free
    area, group, serial = found.group(1).split("-")
    valid = area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"
    return ([found.span(1)] if valid else []), found.end()


def _account(text: str, at: int, free: int) -> tuple[list[Span], int]:
    found = _ACCOUNT.match(text, at)
    return ([found.span(1)], found.end()) if found else ([], free)


PARSERS: dict[str, Callable[[str, int, int], tuple[list[Span], int]]] = {
    "email": _email, "ip": _ip, "card": _card, "phone": _phone, "login": _login, "iban": _iban, "ssn": _ssn, "account": _account,
}


class Finder:
    """The automaton of all anchors, and the parsers behind them."""

    def __init__(self, kinds: tuple[str, ...] = KINDS):
        import ahocorasick

        self.parsers = [PARSERS[k] for k in kinds]
        self.cues = [k in CUES.values() for k in kinds]
        anchors: dict[str, list[tuple[int, int]]] = {}
        # Per anchor: which parser, and where it begins, counted from the anchor's last code point.
        add = lambda kind, text, back: kind in kinds and anchors.setdefault(text, []).append((kinds.index(kind), back))
        add("email", "@", 0)
        add("login", "://", 2)
        for a in DIGITS:
            add("phone", f"+{a}", 1)
            for b in DIGITS:
                add("ip", f"{a}.{b}", 2)
                for between in ("", " ", "-"):
                    add("card", f"{a}{between}{b}", len(between) + 1)
        for cue, kind in CUES.items():
            add(kind, cue, len(cue) - 1)
        self.automaton = ahocorasick.Automaton()
        for text, actions in anchors.items():
            self.automaton.add_word(text, (len(text), tuple(actions)))
        self.automaton.make_automaton()

    def spans(self, text: str, lowered: str) -> list[tuple[int, int, int]]:
        """Start, kind, end of all that is found, in order; ``lowered`` has A-Z alone in lower case."""
        free = [0] * len(self.parsers)
        out = []
        for last, (size, actions) in self.automaton.iter(lowered):
            for kind, back in actions:
                at = last - back
                if self.cues[kind]:
                    if at and (lowered[at - 1].isalpha() or last + 1 < len(lowered) and lowered[last + 1].isalpha()):
                        continue
                    at = last + 1
                    if at < free[kind]:
                        continue
                found, free[kind] = self.parsers[kind](text, at, free[kind])
                out += [(start, kind, end) for start, end in found]
        return sorted(set(out))


# A worker process builds the automaton once.
_finders: dict[tuple[str, ...], Finder] = {}


def finder(kinds: tuple[str, ...] = KINDS) -> Finder:
    if kinds not in _finders:
        _finders[kinds] = Finder(kinds)
    return _finders[kinds]


def _texts(column: pa.Array) -> Iterator[tuple[str, str]]:
    """Each text, and the same with A-Z in lower case."""
    for value in column:
        data = value.as_buffer().to_pybytes() if value.is_valid else b""
        yield data.decode(), data.lower().decode()


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    search = finder()
    for batch in batches:
        rows = []
        for text, lowered in _texts(batch.column(1)):
            found = search.spans(text, lowered)
            said = [f"{KINDS[k]}:{s}:{e}" for s, k, e in found]
            base = ",".join(x for x, f in zip(said, found, strict=True) if f[1] < len(BASE))
            counts = [sum(f[1] == k for f in found) for k in range(len(BASE))]
            rows.append((*counts, hashlib.sha256(base.encode()).hexdigest(), ",".join(said)))
        columns = list(zip(*rows, strict=True)) or [()] * (len(BASE) + 2)
        types = [pa.int64()] * len(BASE) + [pa.string()] * 2
        names = ["doc_id", *[f"n_{k}" for k in BASE], "base_sha256", "spans"]
        yield pa.record_batch([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], names=names)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_<kind>`` of each base kind, ``base_sha256``, ``spans``.

    ``spans`` lists all finds as ``kind:start:end`` (code points, end exclusive) by
    start and then in the kinds' order; ``base_sha256`` is of the same list of base
    kinds alone.  A null or empty text has none.  Rows are scanned one by one,
    repeated ones and such without an id too.  Other columns are not looked at.  An
    empty table gives no rows.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    counts = "".join(f"n_{k} long, " for k in BASE)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_scan, f"doc_id {id_type}, {counts}base_sha256 string, spans string")


def masked(text: str, spans: list[tuple[int, int, int]], kinds: tuple[str, ...] = KINDS) -> str:
    """The text with each find, or run of overlapping ones, replaced by the kind of the first."""
    out, done = [], 0
    for start, kind, end in spans:
        if start >= done:
            out += [text[done:start], f"[{kinds[kind].upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def _masker(kinds: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = finder(kinds)
        for batch in batches:
            column = batch.column(0)
            texts = [masked(t, search.spans(t, low), kinds) for t, low in _texts(column)]
            kept = pa.array([t if v.is_valid else None for t, v in zip(texts, column, strict=True)], pa.string())
            yield pa.record_batch([kept, *batch.columns[1:]], names=batch.schema.names)

    return run


def mask_personal_data(docs: DataFrame, kinds: tuple[str, ...] = KINDS, text_col: str = "text") -> DataFrame:
    """The same rows and columns, with personal data in the text replaced by ``[KIND]``.

    Null texts stay null.  An empty table gives an empty one.
    """
    rest = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.col(f"`{text_col}`").cast("string"), *[F.col(f"`{c}`") for c in rest])
    return rows.mapInArrow(_masker(tuple(kinds)), rows.schema).select(*[f"`{c}`" for c in docs.columns])
