"""Spelling variants: single edits found by dense prefix-suffix tiling.

Two words differ by one inserted, deleted or replaced code point exactly if their
common prefix and common suffix together reach the longer length minus one.  Blocks
of words are padded code-point matrices, and a pair of blocks is compared as a
whole, character by character, from the left and from the right.

Which blocks meet follows from the same fact: cut the longer word, of length m, at
m // 2.  The edit leaves the part before the cut or the part behind it whole, so a
pair shares that part.  A word stands in two groups as the longer one and in two as
the shorter one; a pair counts in its prefix group if its common prefix reaches the
cut, else in its suffix group, and so exactly once.  A group beyond ``TILE`` words is
dealt into tiles, and each pair of tiles is a piece of work of its own.

Pairs are not kept: of each block a word keeps the number of its near words and the
most frequent one.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

LETTERS = "A-Za-zÀ-ÿ"
# Words of a tile.
TILE = 1024
# Cells of one comparison of blocks.
CELLS = 1 << 22
# Pairs of words that a task compares, about.
PAIRS = 20_000_000
# Distinct words that a task counts before it hands them on.
HELD = 200_000


def _counter(letters: str, least_length: int, noise: int | None):
    pattern = re.compile(f"[{letters}]{{{least_length},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.record_batch([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                # bytes.lower() lowers A-Z alone.
                found = Counter(pattern.findall(text.as_buffer().to_pybytes().lower().decode()))
                if noise is None:
                    held.update(found)
                else:
                    seed = zlib.crc32(f"{doc.as_py()}:".encode())
                    for word, n in found.items():
                        h = zlib.crc32(word.encode(), seed)
                        if h % noise == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least_length:
                                continue
                        held[word] += n
                if len(held) > HELD:
                    yield out()
        if held:
            yield out()

    return run


def count_words(
    docs: DataFrame,
    least_length: int = 6,
    least_count: int = 5,
    letters: str = LETTERS,
    noise: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``word``, ``n``: runs of letters of all whole texts, A-Z lowered, that are long and frequent enough.

    With ``noise`` a run whose crc32 (of ``<id>:<run>``) it divides loses the code
    point at crc32 modulo length: a known rate of misspellings.  A null text has no
    words; a null id counts as the text ``None``.  Tasks count before the shuffle.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    parts = texts.mapInArrow(_counter(letters, least_length, noise), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _groups(words: DataFrame) -> DataFrame:
    """The four groups of each word: ``m`` (the longer length), ``side``, ``key``."""
    size = F.length("word")
    places = []
    for m in (size, size + 1):
        cut = F.floor(m / 2).cast("int")
        places.append(F.struct(m.alias("m"), F.lit(0).alias("side"), F.xxhash64(m, F.lit(0), F.substring("word", F.lit(1), cut)).alias("key")))
        places.append(F.struct(m.alias("m"), F.lit(1).alias("side"), F.xxhash64(m, F.lit(1), F.substring("word", size - m + cut + 1, m - cut)).alias("key")))
    return words.select("word", "n", F.inline(F.array(*places)))


def _blocks(groups: DataFrame, tile: int) -> tuple[DataFrame, int]:
    """Members of each pair of tiles of each group, and how many tasks they are work for; groups without a pair are gone."""
    longer = F.count_if(F.length("word") == F.col("m"))
    sizes = groups.groupBy("key").agg(F.count("*").alias("members"), longer.alias("long")).where("members > 1 AND long > 0")
    sizes = common.store(sizes.select("key", "members"), "groups")
    pairs = sizes.agg(F.sum(F.col("members").cast("double") ** 2)).first()[0] or 0
    tiles = F.ceil(F.col("members") / tile).cast("int")
    # Groups beyond one tile are few: at most four times the words over the tile's size.
    dealt = groups.join(sizes.select("key", tiles.alias("tiles")), "key")
    own: Column = F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int")
    dealt = dealt.withColumn("own", own)
    others = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda u: F.struct(F.least("own", u).alias("i"), F.greatest("own", u).alias("j")))
    return dealt.select("m", "side", "key", "own", "word", "n", F.inline(others)), 1 + int(pairs / PAIRS)


def common_ends(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row of ``one`` with each of ``two``, over their width."""
    alive = np.ones((len(one), len(two)), bool)
    out = np.zeros(alive.shape, np.int32)
    for a, b in zip(one.T, two.T, strict=True):
        alive &= a[:, None] == b[None, :]
        out += alive
    return out


def matrix(words: list[str], width: int, right: bool = False) -> np.ndarray:
    """Code points of words, padded with 0; from the end of each word if ``right``."""
    text = "".join((w[::-1] if right else w).ljust(width, "\0") for w in words)
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).reshape(len(words), width)


def near(one: list[str], two: list[str], m: int, side: int) -> np.ndarray:
    """Which pairs of a group of length ``m`` are single edits that count on this side."""
    # Words are of length m or m - 1, so a word's padding meets a code point or another's padding.
    n_one, n_two = (np.array([len(w) for w in words], np.int32) for words in (one, two))
    shorter = np.minimum(n_one[:, None], n_two[None, :])
    longer = np.maximum(n_one[:, None], n_two[None, :])
    prefix = np.minimum(common_ends(matrix(one, m), matrix(two, m)), shorter)
    suffix = np.minimum(common_ends(matrix(one, m, True), matrix(two, m, True)), shorter)
    differ = (prefix < shorter) | (shorter < longer)
    here = prefix >= m // 2 if side == 0 else prefix < m // 2
    return differ & here & (longer == m) & (prefix + suffix >= m - 1)


class _Best:
    """For words of a piece of work: near words, and the most frequent one."""

    def __init__(self) -> None:
        self.found: dict[str, tuple[int, int, str]] = {}

    def add(self, words: list[str], hits: np.ndarray, others: list[str], counts: np.ndarray) -> None:
        """``others`` are in order: most frequent first, then by code points."""
        for row in np.flatnonzero(hits.any(axis=1)).tolist():
            first = int(hits[row].argmax())
            total, best, form = self.found.get(words[row], (0, 0, ""))
            if not total or (-int(counts[first]), others[first]) < (-best, form):
                best, form = int(counts[first]), others[first]
            self.found[words[row]] = (total + int(hits[row].sum()), best, form)

    def batch(self) -> pa.RecordBatch:
        rows = [(w, *f) for w, f in self.found.items()]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        types = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["word", "n_near", "form_n", "form"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in the order of pieces of work; a piece may span batches."""
    place, members = None, []

    def work() -> Iterator[pa.RecordBatch]:
        m, side, _, i, j = place
        best = _Best()
        ranked = sorted(members, key=lambda r: (-r[2], r[1]))
        two = [r for r in ranked if r[0] == j]
        one = two if i == j else [r for r in ranked if r[0] == i]
        words_two, n_two = [r[1] for r in two], np.array([r[2] for r in two], np.int64)
        step = max(1, CELLS // max(1, m * len(two)))
        # A tile with itself is compared both ways at once; each word's hits are its row.
        for at in range(0, len(one), step):
            some = one[at : at + step]
            words_one = [r[1] for r in some]
            hits = near(words_one, words_two, m, side)
            if hits.any():
                best.add(words_one, hits, words_two, n_two)
                if i != j:
                    best.add(words_two, hits.T, words_one, np.array([r[2] for r in some], np.int64))
        if best.found:
            yield best.batch()

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("m", "side", "key", "i", "j", "own", "word", "n")]
        for *at, own, word, n in zip(*columns, strict=True):
            if at != place:
                if len(members) > 1:
                    yield from work()
                place, members = at, []
            members.append((own, word, n))
    if len(members) > 1:
        yield from work()


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """``word``, ``n_near``, ``form_n``, ``form``: of each word that has near words their number and the most frequent one.

    ``words`` has distinct words (``word``, ``n``).  Of near words with the same count
    the first in code-point order is taken.
    """
    blocks, tasks = _blocks(_groups(words), tile)
    # Work grows with the pairs, not with the bytes that a shuffle is cut by.
    blocks = blocks.repartition(tasks, "key", "i", "j").sortWithinPartitions("m", "side", "key", "i", "j")
    found = blocks.mapInArrow(_compare, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form")
    )


def _with_roots(forms: DataFrame, ratio: int) -> DataFrame:
    """Adds ``root``: the end of the chain of forms, by doubling its steps."""
    links = common.store(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "forms")
    # Along a chain the counts grow by the ratio at least, so it has few steps.
    most, reach = forms.agg(F.max("n")).first()[0] or 0, 1
    while ratio ** (reach + 1) <= most:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = common.store(links.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
        reach *= 2
    return forms.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(words: DataFrame, ratio: int = 5, tile: int = TILE) -> DataFrame:
    """Per word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    ``words`` has ``word`` and ``n``; equal words are added up, null and empty words
    are left out, other columns are not looked at.  Two words are near if they differ
    by one inserted, deleted or replaced code point.  A word's ``form`` is its most
    frequent near word (ties: the first in code-point order), if that occurs at least
    ``ratio`` (above one) times as often, else null; ``root`` is where following forms
    ends.  An empty table gives no rows.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent than their variants")
    clean = words.select(F.col("word").cast("string").alias("word"), F.col("n").cast("long").alias("n")).where("word <> ''")
    words = common.store(clean.groupBy("word").agg(F.sum("n").alias("n")), "words")
    found = words.join(near_words(words, tile), "word", "left")
    kept = F.col("form_n") >= ratio * F.col("n")
    forms = found.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), *[F.when(kept, F.col(c)).alias(c) for c in ("form", "form_n")]
    )
    return _with_roots(common.store(forms, "variants"), ratio).select("word", "form", "root", "n", "n_near", "form_n")
