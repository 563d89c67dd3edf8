"""Benchmark decontamination on templates.

Words become tokens: numbers, names and units turn into typed placeholders, all else
is a literal without case and punctuation.  Every window of ``width`` tokens gets a
hash of its template and the pattern in which its slots repeat values.  Windows of
documents meet those of the benchmark by hash; a Bloom filter of bounded size keeps
documents' other windows from being shuffled.  Along one alignment of a document and
an item, each value of the item must stand for one value of the document: so the
same question with other numbers is caught, while a chance likeness whose slots do
not fit together is not.  Windows of plain words, without placeholders, are matched
as well, for copies in another case.

Where placeholders outweigh the words, a window says too little by itself.  There a
longer span with as many words as a window must have is looked for instead, and an
item that has fewer words in all is looked for as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

WIDTH = 13
# Items of fewer tokens are one window; below this only whole lines and texts are compared.
LEAST = 5
# Literals in a template window, at least, in percent; wider spans have as many.
LITERALS = 50
# Literals of an item that is one sparse template as a whole, at least: one word among numbers is any row of a table.
LEAST_LITERALS = 2
# Forms of windows.
PLAIN, TEMPLATE, SPAN, WHOLE, LINE = range(5)
# Bits of the filter for each window of the benchmark, and in all.
BITS_EACH = 16
BITS_MOST = 1 << 27
# Windows that a task hands on at a time.
HANDED = 4096
# What a window of a text and one of an item must have in common, and the items of a window that are joined in one share.
KEY = ["hash", "pattern", "width"]
SHARE = 1000

# Words for numbers, units, and words that are no names though they begin sentences.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty "
    "thirty forty fifty sixty seventy eighty ninety hundred thousand million billion half third quarter dozen"
)
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons ounce ounces pound pounds ml l liter "
    "liters litre litres gallon gallons second seconds s minute minutes min hour hours h day days week weeks month months year years cent cents "
    "dollar dollars euro euros percent degree degrees mph kmh kph volt volts watt watts"
)
NO_NAMES = (
    "a an the i he she it we you they this that these those there what which who whom whose when where why how if then than and or but so as at by "
    "for from in into of off on to up with is are was were be been do does did has have had can could may might must shall should will would not no "
    "all any each every some many much more most one after before during while let find calculate suppose given assume consider"
)

_ALNUM = np.zeros(256, bool)
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = _ALNUM[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True

_TYPES = np.array([0, 0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179, 0x3C6EF372FE94F82B], np.uint64)  # literal, number, name, unit
_PLAIN, _SPAN, _LINE = (np.uint64(x) for x in (0x510E527FADE682D1, 0x9B05688C2B3E6C1F, 0xA54FF53A5F1D36F1))
_INVERSE = pow(int(common.powers(2)[1]), -1, 1 << 64)


def _tokens(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of the texts in a buffer: hash of the plain word, type, first token of each text."""
    return _placed_tokens(data, bounds)[:3]


def _placed_tokens(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The tokens, and the byte where each begins."""
    starts, ends = common.spans(~common.SPACE[data], bounds)
    keep = _ALNUM[data]
    before = np.concatenate([np.zeros(1, np.int64), np.cumsum(keep)])
    first, last = before[starts], before[ends]
    some = last > first
    starts, first, last = starts[some], first[some], last[some]
    kept = data[keep]
    follows = np.append(np.zeros(1, np.uint8), kept[:-1]) == 0xC3
    accented = follows & (kept >= 0x80) & (kept <= 0x9E) & (kept != 0x97)
    low = np.where(accented, kept + np.uint8(32), common.LOWER[kept])
    plain = common.hash_spans(low, first, last)
    at = np.searchsorted(starts, bounds)
    kind = np.zeros(len(first), np.int64)
    if len(first):
        head = kept[first]
        after = np.minimum(first + 1, len(kept) - 1)
        capital = _UPPER[head] | ((head == 0xC3) & accented[after] & (after < last))
        kind[capital & ~np.isin(plain, _NO_NAMES)] = 2
        kind[_DIGIT[head] | np.isin(plain, _NUMBERS)] = 1
        counted = np.append(False, kind[:-1] == 1)
        counted[at[:-1][at[:-1] < len(kind)]] = False
        kind[counted & np.isin(plain, _UNITS) & (kind == 0)] = 3
    return plain, kind, at, starts


def word_hashes(words: str) -> np.ndarray:
    """Hashes of a list of lower-case words."""
    listed = [w.encode() for w in words.split()]
    ends = np.cumsum([len(w) for w in listed])
    return common.hash_spans(np.frombuffer(b"".join(listed), np.uint8), ends - [len(w) for w in listed], ends)


_NUMBERS, _UNITS, _NO_NAMES = map(word_hashes, (NUMBER_WORDS, UNITS, NO_NAMES))


def needed(width: int) -> int:
    """Literals that a template window of a width must have."""
    return -(-LITERALS * width // 100)


class _Texts:
    """The windows of the texts in a buffer."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.plain, self.kind, self.at, starts = _placed_tokens(data, bounds)
        self.template = np.where(self.kind == 0, self.plain, _TYPES[self.kind])
        self.literals = np.concatenate([np.zeros(1, np.int64), np.cumsum(self.kind == 0)])
        self.text = np.repeat(np.arange(len(bounds) - 1), np.diff(self.at))
        self.line = np.searchsorted(np.flatnonzero(data == 10), starts)
        self._sums: tuple[np.ndarray, np.ndarray] | None = None

    def hashes(self, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
        """First tokens, widths, hashes and form of all windows, those of plain words and the template ones."""
        first = np.arange(max(0, len(self.text) - width + 1))
        first = first[self.text[first] == self.text[first + width - 1]]
        size = np.uint64(width)
        yield first, np.full(len(first), width), common.mix(common.shingles(self.plain, width)[first] + _PLAIN * np.array(size)), PLAIN
        literal = self.literals[first + width] - self.literals[first]
        # A window of literals alone is a plain one.
        some = first[(literal * 100 >= LITERALS * width) & (literal < width)]
        yield some, np.full(len(some), width), common.mix(common.shingles(self.template, width)[some] + size), TEMPLATE

    def spans(self, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
        """Spans of just the literals that a window needs, from the first to the last, that are wider than a window.

        Any run of tokens that has a window's width and literals holds a template window or one of these.
        """
        places, more = np.flatnonzero(self.kind == 0), needed(width) - 1
        first, last = places[: max(0, len(places) - more)], places[more:]
        some = (last - first >= width) & (self.text[first] == self.text[last])
        first, last = first[some], last[some] + 1
        yield first, last - first, self._span_hashes(first, last), SPAN

    def wholes(self, size: int, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
        """Windows as wide as an item that has too few literals for any other template window."""
        first = np.arange(max(0, len(self.text) - size + 1))
        literal = self.literals[first + size] - self.literals[first]
        first = first[(literal >= LEAST_LITERALS) & (literal < needed(min(size, width)))]
        first = first[self.text[first] == self.text[first + size - 1]]
        yield first, np.full(len(first), size), self._span_hashes(first, first + size), WHOLE

    def lines(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
        """Lines and texts of under ``LEAST`` tokens."""
        ends = np.flatnonzero(np.diff(self.line) + np.diff(self.text)) + 1
        cuts = np.concatenate([np.zeros(1, np.int64), ends, np.full(1, len(self.text))]) if len(self.text) else np.zeros(1, np.int64)
        first = np.concatenate([cuts[:-1], self.at[:-1]])
        size = np.concatenate([np.diff(cuts), np.diff(self.at)])
        for n in range(1, LEAST):
            some = np.unique(first[size == n])
            yield some, np.full(len(some), n), common.mix(common.shingles(self.plain, n)[some] + _LINE * np.array(np.uint64(n))), LINE

    def _span_hashes(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hashes of the templates of spans of any width."""
        if not len(first):
            return np.empty(0, np.uint64)
        if self._sums is None:
            n = len(self.template)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.template * common.powers(n)[:n], dtype=np.uint64)])
            self._sums = sums, np.concatenate([np.ones(1, np.uint64), np.full(n, _INVERSE, np.uint64)]).cumprod(dtype=np.uint64)
        sums, inverse = self._sums
        return common.mix((sums[last] - sums[first]) * inverse[first] + _SPAN * (last - first).astype(np.uint64))

    def slots(self, first: int, width: int) -> tuple[list[int], list[int]]:
        """Values of a window's slots, and for each the number of the value among them."""
        part = slice(first, first + width)
        values = self.plain[part][self.kind[part] > 0].view(np.int64).tolist()
        seen: dict[int, int] = {}
        return values, [seen.setdefault(v, len(seen)) for v in values]


_WINDOW = pa.schema(
    [("id", pa.int64()), ("place", pa.int64()), ("width", pa.int32()), ("hash", pa.int64()), ("pattern", pa.string()), ("form", pa.int32()), ("slots", pa.list_(pa.int64()))]
)
_WINDOW_SQL = "id long, place long, width int, hash long, pattern string, form int, slots array<long>"


def _rows(texts: _Texts, ids: list, row: int, first: np.ndarray, widths: np.ndarray, hashes: np.ndarray, form: int) -> Iterator[tuple]:
    for at, width, value in zip(first.tolist(), widths.tolist(), hashes.view(np.int64).tolist(), strict=True):
        text = int(texts.text[at])
        slots, pattern = ([], []) if form in (PLAIN, LINE) else texts.slots(at, width)
        yield ids[row + text], at - int(texts.at[text]), width, value, ".".join(map(str, pattern)), form, slots


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(_WINDOW)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _WINDOW, strict=True)], schema=_WINDOW)


def _of_item(one: _Texts, width: int, lines: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    size = len(one.text)
    if size >= LEAST:
        yield from one.hashes(min(width, size))
        yield from one.spans(width)
        yield from one.wholes(size, width)
    elif lines:
        # An item may be of several lines.
        one.line[:] = 0
        yield from one.lines()


def _item_windows(width: int, lines: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for row, data, bounds in common.chunks(batch.column(1)):
                for k in range(len(bounds) - 1):
                    one = _Texts(data[bounds[k] : bounds[k + 1]], bounds[k : k + 2] - bounds[k])
                    yield _batch([r for part in _of_item(one, width, lines) for r in _rows(one, ids, row + k, *part)])

    return run


def _document_windows(sizes: dict[int, list[int]], width: int, words, bits: int):
    def of_texts(texts: _Texts) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
        for size in sizes.get(PLAIN, ()):
            yield from texts.hashes(size)
        if SPAN in sizes:
            yield from texts.spans(width)
        for size in sizes.get(WHOLE, ()):
            yield from texts.wholes(size, width)
        if LINE in sizes:
            yield from texts.lines()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = words.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for row, data, bounds in common.chunks(batch.column(1)):
                texts = _Texts(data, bounds)
                for first, widths, hashes, form in of_texts(texts):
                    maybe = np.ones(len(first), bool)
                    for place in _places(hashes, bits):
                        maybe &= (table[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
                    found = np.flatnonzero(maybe)
                    for at in range(0, len(found), HANDED):
                        some = found[at : at + HANDED]
                        yield _batch(list(_rows(texts, ids, row, first[some], widths[some], hashes[some], form)))

    return run


def _places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Three places of a hash among ``bits``, a power of two."""
    mask = np.uint64(bits - 1)
    return hashes & mask, (hashes >> np.uint64(17)) & mask, (hashes >> np.uint64(34)) & mask


def _filter_words(windows: DataFrame, bits: int) -> np.ndarray:
    """The Bloom filter of the windows' hashes; at most ``bits / 64`` pairs of numbers come to the driver, as Arrow."""
    mask = F.lit(bits - 1).cast("long")
    places = [F.shiftrightunsigned("hash", s).bitwiseAND(mask) for s in (0, 17, 34)]
    one = windows.select(F.explode(F.array(*places)).alias("place"))
    # 1L << n takes n modulo 64.
    word = F.expr("bit_or(shiftleft(1L, cast(place & 63 AS int)))").alias("word")
    found = one.groupBy(F.shiftrightunsigned("place", 6).alias("at")).agg(word).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[found["at"].to_numpy()] = found["word"].to_numpy().view(np.uint64)
    return out


def decontaminate(
    spark: SparkSession,
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = WIDTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    lines: bool = False,
) -> DataFrame:
    """Per row: ``doc_id``, ``text_key``, ``contaminated``, ``items``, ``n_windows``, ``reparameterised``.

    A text is contaminated if it has a window of ``width`` tokens of an item (the whole
    item, if that is shorter), word by word or with other numbers, names and units in
    consistent places.  With ``lines`` a line or text that is an item of under five
    tokens counts too; else such items are not looked for.  ``items`` names
    every item found, ``n_windows`` counts the windows of the text, each once however
    many items have it, ``reparameterised`` says that some were found with other values.

    Null and empty texts are clean.  Rows are judged by their text, so repeated and null
    ids are no matter; null item ids match and are not named.  Other columns are not
    looked at.  Without documents there are no rows, without items all are clean.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    words_of = F.coalesce(F.col(item_text_col).cast("string"), F.lit(""))
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), words_of.alias("text"), F.xxhash64(words_of).alias("item"))
    # Items of one text are looked for once.
    known = common.store(items.select("item", "text").distinct().mapInArrow(_item_windows(width, lines), _WINDOW_SQL), "item-windows")
    keys = common.store(known.groupBy(*KEY).agg(F.count("*").alias("n")), "templates")
    # Spans can be of any width, so one row stands for them.
    wide = known.select("form", F.when(F.col("form") != SPAN, F.col("width")).alias("width")).distinct().collect()
    sizes = {form: sorted(r["width"] or 0 for r in wide if r["form"] == form) for form in {r["form"] for r in wide}}
    bits = 1 << max(10, min(BITS_MOST, keys.count() * BITS_EACH).bit_length())
    bits = min(bits, BITS_MOST)
    words = spark.sparkContext.broadcast(_filter_words(keys, bits))
    hits = rows.select("text_key", "text").mapInArrow(_document_windows(sizes, width, words, bits), _WINDOW_SQL)
    hits = common.store(hits.withColumnRenamed("id", "text_key").join(keys, KEY).distinct(), "hits")
    # Every item that has the window; one that very many have is dealt into shares.
    shares = F.ceil(F.col("n") / SHARE)
    dealt = known.join(keys, KEY).withColumn("share", F.pmod(F.xxhash64("id", "place"), shares))
    dealt = dealt.select(*KEY, "share", F.col("id").alias("item"), F.col("place").alias("item_place"), F.col("slots").alias("item_slots"))
    found = hits.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), shares - 1))).join(dealt, [*KEY, "share"])
    found = common.store(found.drop("hash", "pattern", "n", "share"), "found")

    # One alignment of a text and an item: values of slots against each other.
    where = ["text_key", "item", "shift"]
    found = found.withColumn("shift", F.col("place") - F.col("item_place"))
    slots = found.select(*where, "form", F.explode_outer(F.arrays_zip("item_slots", "slots")).alias("slot"))
    value, other = F.col("slot.item_slots"), F.col("slot.slots")
    dense, sparse = F.col("form") == TEMPLATE, F.col("form").isin(SPAN, WHOLE)
    by_value = slots.groupBy(*where, value.alias("value")).agg(
        F.min(other).alias("low"), F.max(other).alias("high"), F.min(F.when(dense, other)).alias("dense_low"), F.max(F.when(dense, other)).alias("dense_high"),
        F.max(F.col("form").isin(PLAIN, LINE)).alias("plain"), F.max(dense).alias("dense"), F.max(sparse).alias("sparse"),
        F.min(other.eqNullSafe(value)).alias("same"), F.min(F.when(dense, other.eqNullSafe(value))).alias("dense_same"),
    )
    fits = lambda low, high: F.min(F.coalesce(F.col(low) == F.col(high), F.lit(True)))
    aligned = by_value.groupBy(*where).agg(
        fits("low", "high").alias("fits"), fits("dense_low", "dense_high").alias("dense_fits"), F.max("plain").alias("plain"), F.max("dense").alias("dense"),
        F.max("sparse").alias("sparse"), F.min("same").alias("same"), F.min("dense_same").alias("dense_same"),
    )
    # Words that match as they are need no slots.
    aligned = aligned.withColumns({"dense": F.expr("dense AND dense_fits"), "sparse": F.expr("sparse AND fits")}).where("plain OR dense OR sparse")
    good = common.store(aligned, "aligned")
    windows = found.join(good.select(*where, F.col("sparse").alias("all")), where).where(F.col("all") | ~sparse).select("text_key", "place", "width").distinct()
    counted = windows.groupBy("text_key").agg(F.count("*").alias("n_windows"))
    names = good.select("text_key", "item").distinct().join(items.select("item", "item_id").distinct(), "item")
    names = names.groupBy("text_key").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    verdicts = good.groupBy("text_key").agg(F.max(F.expr("NOT plain AND (dense AND NOT dense_same OR sparse AND NOT same)")).alias("other")).join(counted, "text_key").join(names, "text_key")
    out = rows.select("doc_id", "text_key").join(common.store(verdicts, "verdicts"), "text_key", "left")
    none = F.array().cast("array<long>")
    return out.select(
        "doc_id", "text_key", F.col("n_windows").isNotNull().alias("contaminated"), F.coalesce("items", none).alias("items"),
        F.coalesce("n_windows", F.lit(0)).cast("long").alias("n_windows"), F.coalesce("other", F.lit(False)).alias("reparameterised"),
    )


def keep_clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` that hold nothing of the benchmark, with their columns."""
    leaks = decontaminate(spark, docs, benchmark, lines=True).where("contaminated").select("text_key").distinct()
    return common.unwrapped(common.wrapped(docs).join(common.store(leaks, "leaks"), "text_key", "left_anti"), docs)
