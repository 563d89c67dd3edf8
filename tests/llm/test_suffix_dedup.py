import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from hazeframe.llm.suffix_dedup import _END, matching_statistics, remove_repeats


def expected(rows, length):
    texts = [(k, (t or "").encode()) for k, t in rows]
    seen = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for k, t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int(np.sum(gone & ~np.append(False, gone[:-1]))) if len(t) else 0
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((k, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n=40):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abé ", k=rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(rng.randint(30, 120))) for _ in range(6)]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(passages) if rng.random() < 0.6 else " ".join(word() for _ in range(rng.randint(1, 200)))
            if rng.random() < 0.5:
                at = rng.randrange(len(p))
                p = p[:at] + "#" + p[at + rng.randint(0, 3) :]
            parts.append(p[rng.randint(0, 20) :])
        rows.append("\n".join(parts))
    unit = "".join(rng.choices("mnopq", k=90))
    rows += [unit * 4, "1" + "".join(rng.choices("rstuv", k=230)) * 3, "".join(rng.choices("XYZ", k=211)) * 2]
    rows += ["", None, "x" * 199, "y" * 200, "y" * 201, "z" * 3000, "ab" * 900, "\x00" * 500, rows[0], rows[0], "of the " * 700 + "end"]
    return list(enumerate(rows))


@pytest.mark.parametrize(("seed", "many", "length"), [(1, 2000, 200), (2, 2, 200), (3, 2000, 201), (4, 0, 230), (5, 2000, 64), (6, 2, 127), (7, 2000, 79), (8, 2000, 17)])
def test_equals_brute_force(spark, seed, many, length):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, remove_repeats(df, length, many).collect()), key=str) == expected(rows, length)


@pytest.mark.parametrize("length", [1, 2, 5, 8, 9])
def test_very_short_strings(spark, length):
    rows = list(enumerate(["abcabd", "bd", "x", "", None, "abcdefghijklmnop", "zzefghijklmqq", "éé", "0123456789" * 2]))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, remove_repeats(df, length).collect()), key=str) == expected(rows, length)


def test_no_length_is_an_error(spark):
    with pytest.raises(ValueError, match="length"):
        remove_repeats(spark.createDataFrame([(1, "a")], "doc_id long, text string"), 0)


def test_very_long_text_over_several_blocks(spark):
    rng = random.Random(9)
    text = "".join(rng.choices("abcdefgh ", k=1_300_000))
    at = (1 << 19) - 90
    rows = [(1, text), (2, "q" * 50 + text[at : at + 700] + "q"), (3, text[1_299_700:])]
    got = {r[0]: tuple(r) for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    kept = text[:at] + text[at + 700 : 1_299_700]
    assert got[1] == (1, 1_300_000, 1000, 2, hashlib.sha256(kept.encode()).hexdigest())
    assert got[2][1:4] == (751, 700, 1) and got[3][1:4] == (300, 300, 1)


@pytest.mark.parametrize("least", [3, 8, 60, 128, 200])
def test_matching_statistics_equal_brute_force(least):
    rng = random.Random(3)
    base = "".join(rng.choices("ab", k=400))
    regions = [base[:300], base[50:380], base[100:250] + "c" + base[251:400], "".join(rng.choices("ab", k=150)), "a" * 330, "a" * 200, base[100:300], "b" + base[150:300]]
    text = np.concatenate([np.append(np.frombuffer(r.encode(), np.uint8), np.uint8(_END)) for r in regions])
    ends = np.flatnonzero(text == _END)
    got = matching_statistics(text, ends, least)
    strings = [r[i:] for r in regions for i in range(len(r) + 1)]
    for k, one in enumerate(strings):
        best = max(next((i for i, (x, y) in enumerate(zip(one, s)) if x != y), min(len(one), len(s))) for j, s in enumerate(strings) if j != k)
        assert got[k] == best if best >= least else got[k] < least, k


def test_nulls_repeated_rows_clashing_columns_and_empty(spark):
    rows = [(None, "a" * 150 + "b" * 150, 1), (7, "a" * 150 + "b" * 150, 2), (7, "a" * 150 + "b" * 150, 2), (8, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, text_key long")
    got = sorted(map(tuple, remove_repeats(df).collect()), key=str)
    assert got == expected([r[:2] for r in rows], 200)
    assert remove_repeats(df.limit(0)).count() == 0
