"""Long repeated byte strings, found with run-compressed indexes.

A window is a string of ``length`` bytes.  It is named after the least of the
hashes of the short strings in it (``gram_of`` bytes), so equal windows have one name wherever
they stand.  Consecutive windows of one name are a region.

1. Names are counted.  A name met once, at one place, has no repeat, and where all
   regions of a name are the same string, every window of them repeats.  Neither
   needs its text.
2. Of names with different regions, or a region that has the naming string twice,
   each distinct region is fetched once.
   Regions of one name meet in one task, which builds their run-compressed
   Burrows-Wheeler transform: suffix positions are kept, and matched against their
   neighbours, at the ends of runs only.  Within a run a match shrinks by one byte
   a step, so streaming along the text from sample to sample gives every matching
   statistic; those of ``length`` or more are marked.
3. A name with very many distinct regions would outgrow a task.  Its windows are
   counted by hash, one by one, as an aggregate over the cluster.

Marks go back to all regions by name and content hash, and merge per text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

# Bytes of the strings that name windows, for windows of twice as many or more.
GRAM = 40
# Windows in a region; a longer run of one name is cut.
PIECE = 256
# Bytes that are indexed at a time; a name's regions stay together.
INDEX_BYTES = 1 << 18
# Distinct regions of a name beyond which its windows are counted one by one.
MANY = 2000
# Bytes hashed at a time.
_BLOCK = 1 << 20

_END = 0xFF  # in no UTF-8 text
_SALT = np.uint64(0xA0761D6478BD642F)


def gram_of(length: int) -> int:
    """Bytes of the strings that name windows of ``length`` bytes."""
    return max(1, min(GRAM, length // 2))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :])


class _Hashes:
    """Hashes of any span of at most ``_BLOCK`` bytes, by differences of running sums."""

    def __init__(self, data: np.ndarray):
        self.scale = common.powers(_BLOCK + 1024)
        weighted = common._BYTE[data] * self.scale[: len(data)]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(weighted, dtype=np.uint64)])

    def of(self, starts: np.ndarray | slice, sizes: np.ndarray | int) -> np.ndarray:
        level = self.scale[len(self.sums) - 1 - starts]
        return common.mix((self.sums[starts + sizes] - self.sums[starts]) * level * self._level())

    def _level(self) -> np.uint64:
        # All blocks are brought to the same power.
        return self.scale[_BLOCK + 600 - len(self.sums)]


def _regions(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Regions of the texts in a buffer: row, first window (in the buffer), windows, name, content hash, inner.

    ``inner``: the string that gives the name is there more than once, so windows
    may repeat within the region.
    """
    none = tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64, bool))
    if len(data) < length:
        return none
    hashes = _Hashes(data)
    gram = gram_of(length)
    grams = hashes.of(np.arange(len(data) - gram + 1), gram)
    names = _least(grams, length - gram + 1)
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(names)]
    whole = np.arange(len(names)) + length <= bounds[1:][rows]
    new = np.append(True, (names[1:] != names[:-1]) | (rows[1:] != rows[:-1]) | ~whole[:-1])
    firsts = np.flatnonzero(new & whole)
    if not len(firsts):
        return none
    # The end of a region: the next one's start, or the end of its text's windows.
    lasts = np.minimum(np.append(firsts[1:], len(names)), bounds[1:][rows[firsts]] - length + 1)
    counts = lasts - firsts
    pieces = -(-counts // PIECE)
    again = np.repeat(np.arange(len(firsts)), pieces)
    step = (np.arange(len(again)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * PIECE
    first, count = firsts[again] + step, np.minimum(counts[again] - step, PIECE)
    inner = _named_often(grams, names, first, count, length - gram + 1)
    return rows[first], first, count, names[first], hashes.of(first, count + length - 1), inner


def _named_often(grams: np.ndarray, names: np.ndarray, first: np.ndarray, count: np.ndarray, width: int) -> np.ndarray:
    """Whether a region has its least hash at two places or more."""
    edge = np.full(width - 1, np.iinfo(np.uint64).max)
    # Places that are the least of some window: their hash is the greatest name of the windows there.
    least = np.flatnonzero(grams == ~_least(~np.concatenate([~edge, names, ~edge]), width))
    begin = np.searchsorted(least, first)
    size = np.searchsorted(least, first + count - 1 + width) - begin
    again = np.repeat(np.arange(len(first)), size)
    place = least[np.arange(len(again)) - np.repeat(np.cumsum(size) - size, size) + begin[again]]
    return np.bincount(again[grams[place] == names[first[again]]], minlength=len(first)) > 1


def _blocks(column: pa.Array, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row, place in its text, bytes and bounds; a text beyond the block comes in parts that overlap."""
    for row, data, bounds in common.chunks(column, _BLOCK // 2):
        if len(data) <= _BLOCK:
            yield row, 0, data, bounds
        else:
            for at in range(0, len(data) - length + 1, _BLOCK // 2):
                part = data[at : at + _BLOCK // 2 + length - 1]
                yield row, at, part, np.array([0, len(part)])


_REGION_SQL = "text_key long, first long, windows int, name long, content long, inner boolean"
_REGION = pa.schema([("text_key", pa.int64()), ("first", pa.int64()), ("windows", pa.int32()), ("name", pa.int64()), ("content", pa.int64()), ("inner", pa.bool_())])


def _find_regions(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for row, at, data, bounds in _blocks(batch.column(1), length):
                rows, first, count, names, contents, inner = _regions(data, bounds, length)
                columns = [keys[row + rows], first - bounds[rows] + at, count.astype(np.int32), names.view(np.int64), contents.view(np.int64), inner]
                yield pa.record_batch([pa.array(c) for c in columns], schema=_REGION)

    return run


def suffix_order(text: np.ndarray, rest: np.ndarray, depth: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, each up to the end of its region, equal ones by place; and classes of their first bytes.

    ``rest`` has the bytes from each place to the end mark; no region has more than
    ``depth``.  The second array numbers the suffixes' first bytes, in text order: as many
    as the greatest power of two up to ``least``, none if that is below 8.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | np.where(rest >= k, padded[k : k + n], np.uint64(0))
    order = np.argsort(key)
    sorted_key = key[order]
    head = np.append(True, sorted_key[1:] != sorted_key[:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    near = 1 << (least.bit_length() - 1)
    classes = np.zeros(n, np.int64) if near < 8 else None
    size = 8
    while size <= depth:
        if size == near:
            classes = rank.copy()
        # Only places whose class has others still have to be told apart.
        places = np.flatnonzero(~(head & np.append(head[1:], True)))
        if not len(places):
            break
        sub = order[places]
        after = np.where(rest[sub] >= size, rank[np.minimum(sub + size, n - 1)], -1)
        pair = rank[sub] * (n + 1) + after + 1
        by = np.argsort(pair)
        sub, pair = sub[by], pair[by]
        order[places] = sub
        differs = np.append(True, pair[1:] != pair[:-1])
        head[places] |= differs
        rank[sub] = np.maximum.accumulate(np.where(differs, places, 0))
        size *= 2
    places = np.flatnonzero(~(head & np.append(head[1:], True)))
    tied = order[places]
    order[places] = tied[np.argsort(rank[tied] * (n + 1) + tied)]
    return order, rank if classes is None else classes


def matching_statistics(text: np.ndarray, ends: np.ndarray, least: int = 128) -> np.ndarray:
    """For each place, the longest string there that also starts at another place, if of ``least`` bytes or more (else less than that).

    ``text`` is a sequence of regions, each followed by one ``_END``; ``ends`` are the
    places of these.  Matches stay within regions.
    """
    n = len(text)
    rest = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)
    order, classes = suffix_order(text, rest, int(rest.max()) + 1, least)
    before = text[order - 1]
    before[order == 0] = _END
    # Runs of the transform; a region's first place is always sampled.
    bounds = np.append(True, (before[1:] != before[:-1]) | (before[1:] == _END) | (before[:-1] == _END))
    best = np.zeros(n, np.int64)
    for shift in (-1, 1):
        # Samples at the first place of each run look back, those at the last look ahead.
        sampled = np.flatnonzero(bounds if shift < 0 else np.append(bounds[1:], True))
        other = sampled + shift
        inside = (other >= 0) & (other < n)
        place, match = order[sampled[inside]], order[other[inside]]
        near = classes[place] == classes[match]
        statistic = np.full(n, -1, np.int64)
        statistic[order[sampled]] = 0
        statistic[place[near]] = _common(text, rest, place[near], match[near])
        # Along the text a match shrinks by one a step, from each sample on.
        at = np.maximum.accumulate(np.where(statistic >= 0, np.arange(n), 0))
        best = np.maximum(best, statistic[at] - (np.arange(n) - at))
    return np.minimum(best, rest)


def _common(text: np.ndarray, rest: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``a`` and ``b``, within their regions."""
    longest = np.minimum(rest[a], rest[b])
    out = np.zeros(len(a), np.int64)
    for at in range(0, len(a), 4096):
        part = slice(at, at + 4096)
        reach = np.arange(longest[part].max(initial=0) + 1)
        x = text[np.minimum(a[part, None] + reach, len(text) - 1)]
        y = text[np.minimum(b[part, None] + reach, len(text) - 1)]
        stop = (x != y) | (reach >= longest[part, None])
        out[part] = stop.argmax(axis=1)
    return out


_MARK_SQL = "name long, content long, windows int, begin int, stop int"
_MARK = pa.schema([("name", pa.int64()), ("content", pa.int64()), ("windows", pa.int32()), ("begin", pa.int32()), ("stop", pa.int32())])


def _index(length: int):
    """Distinct regions, those of a name one after the other, to marked runs of windows."""

    def marks(rows: list[tuple]) -> pa.RecordBatch:
        pieces = [np.append(np.frombuffer(r[3], np.uint8), np.uint8(_END)) for r in rows]
        sizes = np.array([len(p) for p in pieces])
        ends = np.cumsum(sizes) - 1
        long_ones = matching_statistics(np.concatenate(pieces), ends, length) >= length
        begin, stop = common.spans(long_ones, ends)
        row = np.searchsorted(ends, begin)
        offset = ends[row] - sizes[row] + 1
        columns = [[rows[r][c] for r in row] for c in range(3)]
        return pa.record_batch([*[pa.array(c, f.type) for c, f in zip(columns, _MARK, strict=False)], pa.array(begin - offset, pa.int32()), pa.array(stop - offset, pa.int32())], schema=_MARK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("name", "content", "windows", "bytes")), strict=True):
                if size >= INDEX_BYTES and r[0] != held[-1][0]:
                    yield marks(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[3]) + 1
        if held:
            yield marks(held)

    return run


def _window_hashes(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content, windows, data in zip(*(batch.column(c).to_pylist() for c in ("name", "content", "windows", "bytes")), strict=True):
                found = _Hashes(np.frombuffer(data, np.uint8)).of(np.arange(windows), length).view(np.int64)
                same = [pa.array([v] * windows, t) for v, t in ((name, pa.int64()), (content, pa.int64()), (windows, pa.int32()))]
                yield pa.record_batch([*same, pa.array(np.arange(windows, dtype=np.int32)), pa.array(found)], names=["name", "content", "windows", "begin", "window"])

    return run


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Regions' places in texts, with the texts, to the regions' bytes."""
    for batch in batches:
        data, bounds = common.text_buffer(batch.column("text"))
        found = []
        wanted = batch.column("wanted")
        for k, places in enumerate(wanted.to_pylist()):
            found += [(*[p[c] for c in ("name", "content", "windows")], data[bounds[k] + p["first"] : bounds[k] + p["first"] + p["size"]].tobytes()) for p in places]
        columns = list(zip(*found, strict=True)) or [()] * 4
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["name", "content", "windows", "bytes"])


def _digest(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = common.text_buffer(batch.column("text"))
            out = []
            for k, runs in enumerate(batch.column("runs").to_pylist()):
                text = data[bounds[k] : bounds[k + 1]]
                removed = np.zeros(len(text) + 1, np.int32)
                for r in runs or ():
                    removed[r["begin"]] += 1
                    removed[r["stop"]] -= 1
                gone = np.cumsum(removed[:-1]) > 0
                n_spans = len(common.spans(gone, np.empty(0, np.int64))[0])
                out.append((len(text), int(gone.sum()), n_spans, hashlib.sha256(text[~gone].tobytes()).hexdigest()))
            columns = list(zip(*out, strict=True)) or [()] * 4
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.record_batch([batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return run


def repeated_runs(rows: DataFrame, length: int, many: int = MANY) -> DataFrame:
    """``text_key``, ``begin``, ``stop``: byte runs of windows that repeat, of each distinct text.

    ``rows`` has ``text`` (no nulls) and ``text_key``, its 64-bit hash.  Runs of one
    text may touch or overlap.
    """
    regions = rows.where(F.octet_length("text") >= length).select("text_key", "text").mapInArrow(_find_regions(length), _REGION_SQL)
    names = regions.groupBy("name").agg(F.count("*").alias("n"), F.min("content").alias("low"), F.max("content").alias("high"), F.max("inner").alias("twice"))
    names = names.where("n > 1 OR twice").select("name", F.expr("low != high OR n = 1").alias("varied"))
    hits = common.store(regions.drop("inner").join(names, "name"), "regions")

    whole = ["name", "content", "windows"]
    distinct = hits.where("varied").groupBy(*whole).agg(F.count("*").alias("n"), F.min(F.struct("text_key", "first")).alias("at"))
    wanted = F.struct(*whole, F.col("at.first").alias("first"), (F.col("windows") + length - 1).alias("size"))
    wanted = distinct.select(F.col("at.text_key").alias("text_key"), wanted.alias("one")).groupBy("text_key").agg(F.collect_list("one").alias("wanted"))
    # Copies of a text bring the same bytes; one is enough.
    fetched = rows.join(wanted, "text_key").select("text", "wanted").mapInArrow(_cut_out, "name long, content long, windows int, bytes binary")
    fetched = common.store(fetched.dropDuplicates(whole), "variants")

    crowds = fetched.groupBy("name").agg(F.count("*").alias("variants")).where(F.col("variants") > many).select("name")
    crowds = common.store(crowds, "crowds")
    few = fetched.join(crowds, "name", "left_anti").repartition("name").sortWithinPartitions("name")
    indexed = few.mapInArrow(_index(length), _MARK_SQL)

    single = fetched.join(crowds, "name", "left_semi").mapInArrow(_window_hashes(length), f"{_MARK_SQL.rpartition(',')[0]}, window long")
    twice = single.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    counted = single.join(twice, "window").select(*whole, "begin", (F.col("begin") + 1).alias("stop"))

    # A region that occurs again as a whole repeats in all its windows.
    copies = hits.groupBy(*whole).agg(F.count("*").alias("n")).where("n > 1")
    copies = copies.select(*whole, F.lit(0).alias("begin"), F.col("windows").alias("stop"))
    marks = common.store(copies.union(indexed).union(counted).distinct(), "marks")
    found = hits.join(marks, whole)
    runs = found.select("text_key", (F.col("first") + F.col("begin")).alias("begin"), (F.col("first") + F.col("stop") + length - 1).alias("stop"))
    return runs.distinct()


def remove_repeats(
    docs: DataFrame, length: int = 200, many: int = MANY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Remove every byte covered by a string of ``length`` bytes that starts twice or more in the corpus.

    Strings are judged on the UTF-8 bytes as given, within and across texts, and
    never cross from one text to the next.  Per row: ``doc_id``, ``n_bytes``,
    ``n_removed``, ``n_spans`` (maximal removed runs), ``kept_sha256`` of what is left.

    A null text counts as empty, and a text shorter than ``length`` keeps all.  Rows
    that repeat, with or without their id, are copies of each other and lose all
    that is long enough; a null id stays null.  Other columns are not looked at.
    An empty table gives no rows.  Texts and regions are told apart by 64-bit hashes.
    Any ``length`` from 1 on will do; a smaller one is an error.
    """
    if length < 1:
        raise ValueError(f"length must be 1 or more, not {length}")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    runs = repeated_runs(rows, length, many).groupBy("text_key").agg(F.collect_list(F.struct("begin", "stop")).alias("runs"))
    marked = rows.join(runs, "text_key", "left").select("doc_id", "text", "runs")
    id_type = docs.schema[id_col].dataType.simpleString()
    return marked.mapInArrow(_digest(length), f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
