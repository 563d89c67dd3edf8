import itertools
import random
import re

import pytest

from hazeframe.llm.common import words, hash_spans, text_buffer
from hazeframe.llm.components import components
from hazeframe.llm.near_duplicates import near_duplicates

import pyarrow as pa


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sets(rows, width):
    out = {}
    for key, text in rows:
        found = re.findall(r"[^\x20\x09-\x0D]+", lowered(text or ""))
        size = min(width, len(found))
        out[key] = {tuple(found[i : i + size]) for i in range(len(found) - size + 1)} if found else set()
    return out


def expected(rows, width, percent=80):
    found = sets(rows, width)
    root = {k: k for k in found}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(found, 2):
        x, y = found[a], found[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {k: (len(found[k]), find(k), find(k) == k) for k in found}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def edited(rng, text, share):
    return [rng.choice("pqrstuv") * 3 if rng.random() < share else w for w in text]


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcde", k=3)) for _ in range(60)]
    rows = []
    for size in (3, 8, 30, 30, 200, 2500):
        base = rng.choices(vocabulary, k=size)
        for share in [0, 0, 0.02, 0.02, 0.04, 0.05, 0.08, 0.1, 0.15]:
            rows.append(" ".join(edited(rng, base, share)))
    rows += ["", None, " \n\t", "one", "ONE", "one two", "two", "Ünë", "ünë", "x " * 5000]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("seed", "width"), [(1, 2), (2, 5), (3, 1)])
def test_groups_equal_brute_force(spark, seed, width):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(near_duplicates(df, width)) == expected(rows, width)


def test_one_large_group_of_near_copies(spark):
    rng = random.Random(5)
    base = [f"w{k}" for k in range(120)]
    rows = [(k, " ".join(edited(rng, base, 0.06 * rng.random()))) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    assert result(near_duplicates(df, 2)) == expected(rows, 2)


def test_nulls_repeated_rows_and_clashing_columns(spark):
    rows = [(None, "a b c", 1, "k"), (1, "a b c", 1, "k"), (2, "A B C", 2, None), (2, "A B C", 2, None), (3, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, node long, key string")
    got = sorted(map(tuple, near_duplicates(df, 2).collect()), key=str)
    assert got == sorted([(None, 2, None, True), (1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), (3, 0, 3, True)], key=str)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(df).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 180)] + [(5, 5)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["label"] for r in got} == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 180)}}
    assert len(got) == 41 + 80


def test_words_do_not_cross_texts():
    data, bounds = text_buffer(pa.array(["ab", "cd ef", None, " ", "ab"]))
    starts, hashes, at = words(data, bounds)
    assert starts.tolist() == [0, 2, 5, 8] and at.tolist() == [0, 1, 3, 3, 3, 4]
    assert hashes[0] == hashes[3] and len(set(hashes.tolist())) == 3
    assert len(hash_spans(data, starts[:0], starts[:0])) == 0
