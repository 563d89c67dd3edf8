import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from hazeframe.llm.mixing import cube_sample, mix_sources, mixed_rows, walk


def water(sizes, weights, most=3):
    """Targets by giving out the excess again and again."""
    target = dict.fromkeys(sizes, 0.0)
    left, open_ones = float(sum(sizes.values())), set(sizes)
    while left > 1e-9 and open_ones:
        total = sum(weights[s] for s in open_ones)
        share = {s: left * weights[s] / total for s in open_ones}
        left = 0.0
        for s in list(open_ones):
            target[s] += share[s]
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                open_ones.remove(s)
    return target


def corpus(seed=1, n=3000):
    rng = random.Random(seed)
    names = ["b", "a", "Z", "é", "", None, "big"]
    rows = []
    for k in range(n):
        source = "big" if rng.random() < 0.4 else rng.choice(names)
        rows.append((k, source, "w " * min(3000, int(rng.paretovariate(0.9)))))
    rows += [(n, "tiny", "x y z"), (n + 1, "none", ""), (n + 2, None, None)]
    return rows


def check(rows, got):
    names = sorted({s for _, s, _ in rows if s is not None}) + [None]
    weights = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    size = {k: len((t or "").split()) for k, _, t in rows}
    source = {k: s for k, s, _ in rows}
    total = Counter()
    for k, s, _ in rows:
        total[s] += size[k]
    want = water({s: total[s] for s in names}, weights)
    taken, largest = Counter(), defaultdict(int)
    for r in got:
        s = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == total[s]
        assert r["target"] == pytest.approx(want[s], rel=1e-9, abs=1e-6)
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["times"] * r["size"]
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
    for s in names:
        assert abs(taken[s] - want[s]) <= largest[s], s
    return taken


def test_targets_and_taken_words(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(6)
    got = mix_sources(df).collect()
    assert len(got) == len(rows)
    check(rows, got)
    again = mix_sources(df.repartition(3)).collect()
    assert {(r["doc_id"], r["taken"]) for r in got} == {(r["doc_id"], r["taken"]) for r in again}


def test_flight_keeps_both_sums_and_leaves_two_open():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 3, 500):
        chance, size = rng.uniform(0.05, 0.95, n), rng.integers(1, 900, n).astype(float)
        out = walk(chance, size, land=False)
        assert ((out > 0) & (out < 1)).sum() <= 2
        assert out.sum() == pytest.approx(chance.sum()) and out @ size == pytest.approx(chance @ size)
        landed = walk(chance, size, land=True)
        assert set(np.unique(landed)) <= {0.0, 1.0} and abs(landed @ size - chance @ size) <= size.max(initial=0)
    same = walk(np.full(10, 0.5), np.full(10, 7.0), land=True)
    assert same.sum() == 5


def test_chances_hold_on_average():
    rng = np.random.default_rng(3)
    size = rng.integers(1, 50, 12).astype(float)
    total = np.zeros(12)
    for _ in range(1500):
        by = rng.permutation(12)
        total[by] += walk(np.full(12, 0.3), size[by], land=True)
    assert np.abs(total / 1500 - 0.3).max() < 0.08


def test_many_small_blocks(spark):
    rng = random.Random(4)
    rows = [(k, k, k % 2, rng.getrandbits(60), rng.randint(1, 100), 0.25 + 0.5 * (k % 2)) for k in range(2000)]
    df = spark.createDataFrame(rows, "row long, doc_id long, stratum long, order long, size long, chance double")
    picked = {r["row"] for r in cube_sample(df, block=16).where("picked").collect()}
    for s in (0, 1):
        mine = [r for r in rows if r[2] == s]
        assert abs(sum(r[4] for r in mine if r[0] in picked) - sum(r[4] * r[5] for r in mine)) <= 100
        assert abs(sum(r[0] in picked for r in mine) - sum(r[5] for r in mine)) <= 2


def test_nulls_repeated_rows_clashing_columns_and_empty(spark):
    rows = [(None, "a", "x y", 1), (1, "a", "x y", 1), (1, "a", "x y", 2), (2, None, None, 3), (3, "b", "one two three four", 4)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, size int")
    mixed = mix_sources(df)
    got = mixed.collect()
    assert len(got) == 5 and sum(r["size"] for r in got) == 10
    assert mixed_rows(df).columns == df.columns
    assert mix_sources(df.limit(0)).count() == 0 and mixed_rows(df.limit(0)).count() == 0


def test_rows_are_repeated(spark):
    rows = corpus(5, 200)
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    mixed = mix_sources(df)
    times = {r["doc_id"]: r["times"] for r in mixed.collect()}
    got = Counter(r["doc_id"] for r in mixed_rows(df).collect())
    assert got == Counter({k: t for k, t in times.items() if t})


def test_copies_of_equal_rows_add_up_and_columns_have_any_name(spark):
    """Rows of equal id and text are due their own number of copies, whatever the table's columns are called."""
    names = ["times", "rows", "copy", "row", "one", "each", "text_key", "size", "doc id"]
    extra = "".join(f", `{n}` map<string,int>" for n in names)
    rows = [(k % 3, "a" if k < 4 else "b", "some words " * (k // 2 + 1), *[{n: k} for n in names]) for k in range(7)]
    rows += [rows[0]] * 5 + [(None, None, None, *[None] * len(names))]
    df = spark.createDataFrame(rows, f"doc_id long, source string, text string{extra}").repartition(3)
    mixed = mix_sources(df).collect()
    got = mixed_rows(df)
    assert got.columns == df.columns and got.count() == sum(r["times"] for r in mixed) > 0
