import random
import re
import zlib
from collections import Counter

import pytest

from hazeframe.llm.spelling_variants import count_words, near, near_words, spelling_variants


def single_edit(a, b):
    """One inserted, deleted or replaced code point, tried out."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def brute_force(counts, ratio=5):
    near_of = {w: [v for v in counts if single_edit(w, v)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near_of[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near_of[w]), counts[form[w]] if form[w] else None)
    return out


def plain_count(rows, least_length=6, least_count=5, noise=199):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{doc}:{word}".encode()) & 0xFFFFFFFF
            if h % noise == 0:
                k = h % len(word)
                word = word[:k] + word[k + 1 :]
            out[word] += 1
    return {w: n for w, n in out.items() if len(w) >= least_length and n >= least_count}


def vocabulary(size, seed):
    rng = random.Random(seed)
    words = {}
    while len(words) < size:
        word = "".join(rng.choices("abé", k=rng.randint(1, 9)))
        words[word] = rng.choice([5, 6, 30, 31, 160, 900, 5000])
    return words


@pytest.mark.parametrize("tile", [1024, 7])
def test_variants_equal_brute_force(spark, tile):
    counts = vocabulary(400, 3)
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r["word"]: tuple(r)[1:] for r in spelling_variants(df, tile=tile).collect()}
    assert got == brute_force(counts)


def test_chains_of_any_length_reach_their_root(spark):
    # Each word is five times as frequent as the one before it.
    counts = {"a" * k: 5**k for k in range(1, 15)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert {r["root"] for r in spelling_variants(df).collect()} == {"a" * 14}


def test_a_pair_counts_on_one_side_alone():
    rng = random.Random(5)
    words = ["".join(rng.choices("ab", k=rng.randint(1, 6))) for _ in range(60)]
    for m in range(1, 8):
        some = [w for w in set(words) if len(w) in (m, m - 1)]
        for a in some:
            for b in some:
                sides = [bool(near([a], [b], m, side)[0, 0]) for side in (0, 1)]
                assert sum(sides) == (single_edit(a, b) and max(len(a), len(b)) == m), (a, b, m)


def test_hot_groups_are_dealt_into_tiles(spark):
    words = spark.range(300).selectExpr("concat('prefix', lpad(id, 6, '0')) AS word", "id AS n")
    counts = {r["word"]: r["n"] for r in words.collect()}
    got = {r["word"]: r["n_near"] for r in near_words(words, tile=16).collect()}
    assert got == {w: f[3] for w, f in brute_force(counts).items() if f[3]}


def test_counted_words_equal_brute_force(spark):
    rng = random.Random(11)
    pieces = ["Straße", "straße", "ÉCOLE", "école", "variant", "Variants", "x", "naïveté", "a1b2c3", "don't", "\n", "ſecret", "longer" * 40]
    rows = [(k, " ".join(rng.choices(pieces, k=rng.randint(0, 60)))) for k in range(300)]
    rows += [(k, "Variants " * 5) for k in range(20_000, 21_000)]
    rows += [(9000, None), (9001, ""), (9002, "variant " * 30_000), rows[0], rows[1]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["word"]: r["n"] for r in count_words(df, noise=199).collect()}
    want = plain_count(rows)
    assert got == want and sum(single_edit(w, "variants") for w in want) > 2
    assert {r["word"]: r["n"] for r in count_words(df).collect()} != got


def test_nulls_repeated_rows_clashing_columns_and_empty(spark):
    df = spark.createDataFrame([("letter", 30, 1), ("leter", 2, 1), ("letter", 1, 2), (None, 4, 1), ("", 4, 1)], "word string, n long, key long")
    got = {r["word"]: tuple(r)[1:] for r in spelling_variants(df).collect()}
    assert got == {"letter": (None, "letter", 31, 1, None), "leter": ("letter", "letter", 2, 1, 31)}
    assert spelling_variants(df.limit(0)).count() == 0
    docs = spark.createDataFrame([(None, "letter letter letter", "a"), (1, None, "b"), (None, "letter letter", "c")], "doc_id long, text string, word string")
    assert [tuple(r) for r in count_words(docs).collect()] == [("letter", 5)]
    assert count_words(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        spelling_variants(df, ratio=1)
