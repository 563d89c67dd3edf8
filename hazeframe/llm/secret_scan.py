"""Secret scans through a trigram index.

From each rule's regular expression follows a Boolean query over trigrams: strings
of three bytes that any match must hold.  An inverted index has the texts of each
trigram, in sorted posting lists; these are intersected and united as the query says,
shard by shard, and only the candidates that remain are verified with the expression
itself.  A rule without a mandatory trigram is run over every text.

The index folds A-Z to lower case.  It covers the trigrams that the rules ask for,
or all that occur (``vocabulary=None``).  A shard has a bounded number of texts, so
its lists fit one task, whatever the size of the corpus.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

# Strings an expression may stand for before it counts as open.
MANY = 128
# Texts of a posting list.
SHARD = 20_000


@dataclass(frozen=True)
class Rule:
    """An expression, and the least length of a group (0: the whole match) for a match to count."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0

    def spans(self, text: str) -> Iterator[tuple[int, int]]:
        for m in re.finditer(self.pattern, text):
            if m.end(self.group) - m.start(self.group) >= self.least:
                yield m.span()


def any_case(word: str) -> str:
    """A pattern for an ASCII word in either case, with no letter beyond ASCII."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


_KEYWORDS = "|".join(map(any_case, ("password", "passwd", "secret", "token", "api_?key")))

BASE = (
    Rule("assign", rf"""({_KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[baprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("login", r"://[^\s/:@]+:[^\s/@]+@"),
)

# A query: True (no condition), a trigram, or ("and" | "or", parts).
Query = bool | bytes | tuple


def _all(parts: Sequence[Query]) -> Query:
    parts = list(dict.fromkeys(p for p in parts if p is not True))
    return True if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _any(parts: Sequence[Query]) -> Query:
    parts = list(dict.fromkeys(parts))
    return True if True in parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _holds(strings: set[str]) -> Query:
    """Any of the strings is there."""
    found = []
    for s in sorted(strings):
        data = s.encode()
        found.append(_all([data[i : i + 3] for i in range(len(data) - 2)]))
    return _any(found)


def _letter(code: int, flags: int) -> set[str] | None:
    """What a literal may be, A-Z lowered; None if case folding reaches beyond ASCII."""
    c = chr(code)
    if flags & re.IGNORECASE and not flags & re.ASCII and (c in "kKsS" or code > 127):
        return None
    return {c.lower() if c.isascii() else c}


def _one(op, value, flags: int) -> tuple[set[str] | None, Query]:
    """The strings a part of an expression stands for (None: open), and what any match holds."""
    name = str(op)
    if name == "LITERAL":
        found = _letter(value, flags)
        return found, True
    if name == "IN":
        codes: list[int] = []
        for kind, arg in value:
            if str(kind) == "LITERAL":
                codes.append(arg)
            elif str(kind) == "RANGE" and arg[1] - arg[0] < MANY:
                codes += range(arg[0], arg[1] + 1)
            else:
                return None, True
        letters = [_letter(c, flags) for c in codes]
        found = None if None in letters else set().union(*letters)
        return (found, True) if found is not None and len(found) <= 8 else (None, True)
    if name == "SUBPATTERN":
        return _sequence(value[3], (flags | value[1]) & ~value[2])
    if name == "ATOMIC_GROUP":
        return _sequence(value, flags)
    if name == "BRANCH":
        branches = [_sequence(b, flags) for b in value[1]]
        exact = [e for e, _ in branches]
        if None not in exact and len(set().union(*exact)) <= MANY:
            return set().union(*exact), True
        return None, _any([q if e is None else _holds(e) for e, q in branches])
    if name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        least, most, part = value
        exact, query = _sequence(part, flags)
        if least == 0:
            return ({"", *exact}, True) if exact is not None and most == 1 else (None, True)
        if exact is None:
            return None, query
        repeated = {""}
        for _ in range(int(least)):
            repeated = {a + b for a in repeated for b in exact}
            if len(repeated) > MANY:
                return None, _holds(exact)
        return (repeated, True) if least == most else (None, _holds(repeated))
    if name in ("AT", "ASSERT", "ASSERT_NOT"):
        return {""}, True
    return None, True


def _sequence(parts, flags: int) -> tuple[set[str] | None, Query]:
    held, conditions, exact = {""}, [], True
    for op, value in parts:
        found, query = _one(op, value, flags)
        if found is not None and len(held) * len(found) <= MANY:
            held = {a + b for a, b in itertools.product(held, found)}
            continue
        conditions += [_holds(held), query if found is None else _holds(found)]
        held, exact = {""}, False
    return (held, True) if exact else (None, _all([*conditions, _holds(held)]))


def trigram_query(pattern: str) -> Query:
    """What trigrams any match of the expression holds; True if none is mandatory."""
    parsed = re._parser.parse(pattern)
    exact, query = _sequence(parsed, parsed.state.flags)
    return query if exact is None else _holds(exact)


def trigrams(query: Query) -> set[bytes]:
    if isinstance(query, bytes):
        return {query}
    return set() if query is True else set().union(*map(trigrams, query[1]))


def satisfying(query: Query, lists: dict[bytes, np.ndarray]) -> np.ndarray:
    """Sorted keys that satisfy the query, from sorted posting lists without repeats."""
    if query is True:
        raise ValueError("a query without a trigram has no posting lists")
    if isinstance(query, bytes):
        return lists.get(query, np.empty(0, np.int64))
    found = sorted((satisfying(q, lists) for q in query[1]), key=len)
    out = found[0]
    for other in found[1:]:
        out = np.intersect1d(out, other, assume_unique=True) if query[0] == "and" else np.union1d(out, other)
    return out


def _grams(vocabulary: list[bytes] | None):
    """Trigrams of each text, in one pass over its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None
        if vocabulary is not None:
            wanted = np.zeros(1 << 24, bool)
            wanted[[int.from_bytes(g, "big") for g in vocabulary]] = True
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for row, data, bounds in common.chunks(batch.column(1)):
                codes = common.LOWER[data].astype(np.uint32)
                codes = codes[:-2] << 16 | codes[1:-1] << 8 | codes[2:]
                at = np.arange(len(codes)) if wanted is None else np.flatnonzero(wanted[codes])
                # A trigram is one text's, so the next one begins behind it.
                text = np.searchsorted(bounds, at, "right") - 1
                inside = at + 3 <= bounds[text + 1]
                pairs = np.unique(text[inside].astype(np.uint64) << np.uint64(24) | codes[at[inside]])
                found = (pairs & np.uint64(0xFFFFFF)).astype(">u4").view(np.uint8).reshape(-1, 4)[:, 1:]
                grams = [g.tobytes().decode("latin-1") for g in found]
                yield pa.record_batch([pa.array(grams, pa.string()), pa.array(keys[row + (pairs >> np.uint64(24)).astype(np.int64)], pa.int64())], names=["gram", "text_key"])

    return run


def build_index(rows: DataFrame, vocabulary: set[bytes] | None = None, shard: int = SHARD) -> DataFrame:
    """Posting lists: ``gram`` (latin-1 text of three bytes), ``shard``, ``texts`` (sorted keys), stored.

    ``rows`` has ``text_key`` and ``text`` (no nulls).  A list holds the texts of one
    shard, so that no trigram's texts meet in one place.
    """
    wanted = None if vocabulary is None else sorted(vocabulary)
    pairs = rows.select("text_key", "text").mapInArrow(_grams(wanted), "gram string, text_key long")
    shards = max(1, -(-rows.count() // shard))
    lists = pairs.groupBy("gram", F.pmod(F.xxhash64("text_key"), F.lit(shards)).alias("shard"))
    return common.store(lists.agg(F.array_sort(F.collect_set("text_key")).alias("texts")), "postings")


def _match(queries: dict[str, Query]):
    """Texts of one shard that its posting lists let through, and the rules that they may match."""
    kinds = pa.array(list(queries), pa.string())

    def run(shard: pa.Table) -> pa.Table:
        texts = shard.column("texts").combine_chunks()
        grams = shard.column("gram").to_pylist()
        lists = {g.encode("latin-1"): texts[k].values.to_numpy(zero_copy_only=False) for k, g in enumerate(grams)}
        found = [satisfying(q, lists) for q in queries.values()]
        keys = np.concatenate(found)
        rules = np.repeat(np.arange(len(found)), [len(f) for f in found])
        order = np.argsort(keys, kind="stable")
        each, starts = np.unique(keys[order], return_index=True)
        listed = pa.ListArray.from_arrays(pa.array(np.append(starts, len(keys)), pa.int32()), kinds.take(pa.array(rules[order])))
        return pa.table({"text_key": pa.array(each, pa.int64()), "kinds": listed})

    return run


def candidates(postings: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """``text_key``, ``kinds``: texts and the rules whose queries their posting lists satisfy.

    Lists of one shard meet in one task: as many as trigrams are asked for, each of at
    most a shard's texts.
    """
    asked = sorted(g.decode("latin-1") for g in set().union(*map(trigrams, queries.values())))
    lists = postings.where(F.col("gram").isin(asked))
    return lists.groupBy("shard").applyInArrow(_match(queries), "text_key long, kinds array<string>")


def _verify(base: Sequence[Rule], more: Sequence[Rule], full: set[str]):
    rules = [*base, *more]
    names = [r.kind for r in rules]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, kinds in zip(batch.column("text"), batch.column("kinds").to_pylist(), strict=True):
                text, found = text.as_py(), []
                for number, rule in enumerate(rules):
                    if rule.kind in full or kinds and rule.kind in kinds:
                        found += [(start, number, end) for start, end in rule.spans(text)]
                found.sort()
                say = lambda some: ",".join(f"{names[n]}:{s}:{e}" for s, n, e in some)
                first = [f for f in found if f[1] < len(base)]
                counts = [sum(n == k for _, n, _ in found) for k in range(len(base))]
                out.append((*counts, hashlib.sha256(say(first).encode()).hexdigest(), say(found)))
            columns = list(zip(*out, strict=True)) or [()] * (len(base) + 2)
            types = [pa.int64()] * len(base) + [pa.string()] * 2
            fields = [f"n_{r.kind}" for r in base] + ["base_sha256", "spans"]
            yield pa.record_batch([batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], names=["doc_id", *fields])

    return run


def scan_secrets(
    docs: DataFrame, base: Sequence[Rule] = BASE, more: Sequence[Rule] = MORE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: ``doc_id``, ``n_<kind>`` of each base rule, ``base_sha256``, ``spans``.

    ``spans`` lists all matches as ``kind:start:end`` in code points, by start and then
    in the rules' order; ``base_sha256`` is of the same list of base rules alone.  A
    rule's matches are leftmost and do not overlap; those of too short a group are
    dropped.

    A null text is empty and has none.  Rows are scanned one by one, repeated ones and
    such without an id too; the index knows a row by a 64-bit hash of its id and text,
    so copies of a text don't meet in one task, and equal hashes can only add
    candidates.  Other columns are not looked at.  An empty table gives no
    rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("doc_id", "text"))
    queries = {r.kind: trigram_query(r.pattern) for r in (*base, *more)}
    indexed = {k: q for k, q in queries.items() if q is not True}
    if indexed:
        postings = build_index(rows, set().union(*map(trigrams, indexed.values())))
        found = common.store(candidates(postings, indexed), "candidates")
        rows = rows.join(found, "text_key", "left")
    else:
        rows = rows.withColumn("kinds", F.lit(None).cast("array<string>"))
    id_type = docs.schema[id_col].dataType.simpleString()
    counts = "".join(f"n_{r.kind} long, " for r in base)
    verify = _verify(tuple(base), tuple(more), set(queries) - set(indexed))
    return rows.select("doc_id", "text", "kinds").mapInArrow(verify, f"doc_id {id_type}, {counts}base_sha256 string, spans string")
