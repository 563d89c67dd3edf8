import random
import re

import numpy as np
import pyarrow as pa
import pytest

from hazeframe.llm import common
from hazeframe.llm.decontamination import NO_NAMES, NUMBER_WORDS, UNITS, _tokens, decontaminate, keep_clean

ITEMS = [
    (1, "If Alice buys 3 apples at 2 dollars each and then Bob buys 3 more, how many apples are there?"),
    (2, "The quick brown fox jumps over the lazy dog while seven thin wizards quietly box their liquor jugs."),
    (3, "What is the capital of that country?"),
    (4, "Too short item"),
    (5, ""),
    (None, "Yet another passage of a test that has no number at all but many plain words."),
]


def tokens(text):
    out = []
    for w in re.findall(r"[^\x20\x09-\x0D]+", text or ""):
        core = "".join(c for c in w if c.isascii() and c.isalnum() or ord(c) > 127)
        if not core:
            continue
        low = "".join(c.lower() if c.isascii() or "À" <= c <= "Þ" and c != "×" else c for c in core)
        kind = "w"
        if low != core and core[0] != low[0] and low not in NO_NAMES.split():
            kind = "name"
        if core[0] in "0123456789" or low in NUMBER_WORDS.split():
            kind = "number"
        elif kind == "w" and out and out[-1][1] == "number" and low in UNITS.split():
            kind = "unit"
        out.append((low, kind))
    return out


def expected(docs, items, width=13):
    known = [(k, t, min(width, len(t))) for k, t in ((k, tokens(t)) for k, t in items) if len(t) >= 5]
    out = {}
    for key, text in docs:
        doc, found, other = tokens(text), set(), False
        for item, want, size in known:
            for shift in range(-len(want), len(doc)):
                plain, mapping, fits, changed = False, {}, True, False
                hit = False
                for i in range(len(want) - size + 1):
                    j = i + shift
                    if j < 0 or j + size > len(doc):
                        continue
                    a, b = want[i : i + size], doc[j : j + size]
                    if [x for x, _ in a] == [x for x, _ in b]:
                        plain = hit = True
                    shape = lambda s: [w if k == "w" else k for w, k in s]
                    literals = sum(k == "w" for _, k in a)
                    if shape(a) != shape(b) or literals * 100 < 50 * size or literals == size:
                        continue
                    pairs = [(x, y) for (x, k), (y, _) in zip(a, b) if k != "w"]
                    if len(set(pairs)) != len({x for x, _ in pairs}) or len(set(pairs)) != len({y for _, y in pairs}):
                        continue
                    hit = True
                    for x, y in pairs:
                        fits &= mapping.setdefault(x, y) == y
                        changed |= x != y
                if hit and (plain or fits):
                    found.add(item)
                    other |= changed and not plain
        out[key] = (bool(found), sorted(k for k in found if k is not None), other)
    return out


def documents():
    rng = random.Random(6)
    noise = lambda n: " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(n))
    alice, fox, capital, _, _, other = (t for _, t in ITEMS)
    texts = [
        noise(300), None, "", alice, noise(40) + " " + alice + " " + noise(40), fox.upper(), fox.lower(), "x" + fox, capital, capital.replace("capital", "king"),
        alice.replace("3", "17").replace("2", "40").replace("Alice", "Émile").replace("Bob", "Zoë").replace("dollars", "euros"),
        alice.replace("3 apples", "4 apples"), alice.replace("3 more", "5 more"), alice.replace("apples", "pears"),
        alice + "\n" + alice.replace("Alice", "Carol").replace("3", "9"), " ".join(alice.split()[:12]), " ".join(alice.split()[2:16]),
        noise(20) + "\n" + other, "Too short item", "1 2 3 4 5 6 7 8 9 10 11 12 13 14", fox.replace(" ", "\n\t ").replace("fox", "fox,"), "a " * 40_000 + fox,
    ]
    return list(enumerate(texts + texts[3:5]))


def test_tokens_equal_plain_python():
    texts = ["Alice has 3 kg, ÉTÉ Über x×y ñ 12.5 km/h! -- Seven miles The THE don't 3rd", "", "ß É", "... 5", "kg"]
    data, bounds = common.text_buffer(pa.array(texts))
    plain, kind, at = _tokens(data, bounds)
    for k, text in enumerate(texts):
        want = tokens(text)
        assert [("w", "number", "name", "unit")[x] for x in kind[at[k] : at[k + 1]]] == [x for _, x in want]
        words, starts = [w.encode() for w, _ in want], np.cumsum([0] + [len(w.encode()) for w, _ in want])
        if words:
            assert plain[at[k] : at[k + 1]].tolist() == common.hash_spans(np.frombuffer(b"".join(words), np.uint8), starts[:-1], starts[1:]).tolist()


@pytest.mark.parametrize("width", [13, 8])
def test_equals_brute_force(spark, width):
    docs = documents()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {r["doc_id"]: (r["contaminated"], r["items"], r["reparameterised"]) for r in decontaminate(spark, df, items, width).collect()}
    # Windows that several items share are named after the least.
    assert got == expected(docs, ITEMS, width)


def test_clean_rows_stay_with_their_columns(spark):
    rows = [(None, "a clean text of some length", 1), (1, ITEMS[1][1], 2), (1, ITEMS[1][1], 2), (1, "another clean one", 3), (2, None, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, hash int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = keep_clean(spark, df, items)
    assert kept.columns == df.columns and sorted(r["hash"] for r in kept.collect()) == [1, 3, 4]
    assert keep_clean(spark, df, items.limit(0)).count() == 5 and decontaminate(spark, df.limit(0), items).count() == 0


def test_every_item_of_a_template_is_tried(spark):
    words = [f"{a}{b}" for a in "abcdef" for b in "klmnop"]
    family = lambda *slots: " ".join(f"{' '.join(words[12 * k : 12 * k + 12])} {v}" for k, v in enumerate(slots))
    # No window spans two slots, so the items' windows are all alike; one value of an item can't stand for two
    # (item 1 is in text 2 word by word, up to its last slot).
    items = [(1, family(3, 4, 3)), (2, family(3, 4, 5)), (3, family(3, 4, 5)), (None, family(5, 5, 5)), (None, family(5, 6, 7)), (4, family(1, 1, 1)), (4, family(1, 1, 2))]
    docs = [(0, family(8, 9, 6)), (1, family(8, 9, 8)), (2, family(3, 4, 5)), (3, family(8, 8, 8)), (4, family(8, 8, 6))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate(spark, df, bench).collect()}
    assert [got[k]["items"] for k in range(5)] == [[2, 3], [1, 2, 3], [1, 2, 3], [1, 2, 3, 4], [2, 3, 4]]
    assert all(r["contaminated"] and r["n_windows"] == 27 for r in got.values())
    assert [got[k]["reparameterised"] for k in range(5)] == [True, True, True, True, True]


def test_items_of_few_words_and_short_ones(spark):
    dense = "Alice has 3 apples, Bob 4, Carol 5, Dan 6 and Eve 7"
    longer = "take 1 2 3 4 from 5 6 7 8 with 9 10 11 12 for 13 14 15 16 or 17 18 19 20 until 21 22 23 24 comes 25 26 27 28 last 29 30"
    items = [(1, dense), (2, longer), (3, "Yes indeed"), (4, "Wie viele Äpfel kauft Anna Schmidt Paul Meier 3 Birnen 4"), (5, "1 2 3 4 5 6 7 8 9 10 11 12 13 14")]
    other = dense.replace("Alice", "Gus").replace("Bob", "Hal").replace("3", "13").replace("7", "17")
    part = "take 51 52 53 54 from 55 56 57 58 with 59 60 61 62 for 63 64 65 66 or 67 68 69 70 until 71 72 73 74 comes"
    texts = [
        dense, "so it is that " + other + " they say", other.replace("apples", "pears"), other.replace("Dan", "Hal"), other[: other.index(" and")],
        longer, part, part.replace("70", "51"), part[: part.index(" comes")], "a line\nYes, indeed!\nmore of it", "Yes indeed it is", "YES\nindeed", "\n",
        "Wie viele Birnen kauft Otto Weber Max Huber 8 Kilo 9", " ".join(map(str, range(50, 80))),
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = decontaminate(spark, df, spark.createDataFrame(items, "item_id long, text string"), lines=True)
    got = {r["doc_id"]: (r["items"], r["reparameterised"]) for r in found.collect()}
    clean = ([], False)
    # Longer spans and whole items decide; numbers alone match only as they are.
    assert [got[k] for k in range(9)] == [([1], False), ([1], True), clean, clean, clean, ([2], False), ([2], True), clean, clean]
    assert [got[k] for k in range(9, 15)] == [([3], False), clean, ([3], False), clean, ([4], True), clean]
