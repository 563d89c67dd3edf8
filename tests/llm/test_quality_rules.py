import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hazeframe.llm.quality_rules import Limits, host_rates, judge, keep_good, measure, quality_rules

GOOD = "this is a plain text of more than ten different words in one line\nand another"
JUNK = "".join(f" #{k}" for k in range(8))


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed)


TEXTS = [
    "", None, " \t\n\x0b\x0c\r ", "a", GOOD, GOOD + "\n" + GOOD, "a b c d e " * 3, "a a a a a a", "x y\n\nx y\r\nx y\n \n \n",
    "é ü\x0b€ $ ## <b> & | 100%", "w " * 30_000, " ".join(f"w{i % 97}" for i in range(40_000)), "\xa0  x\x85y\x1cz", "ab\ncd\nab\nab",
    "one two three four five six one two three four five",
]


def test_counts_equal_brute_force(spark):
    df = spark.createDataFrame([(k, "h", t) for k, t in enumerate(TEXTS)], "doc_id long, source string, text string")
    got = {r[0]: tuple(r)[2:-1] for r in quality_rules(df).collect()}
    assert got == {k: counts(t) for k, t in enumerate(TEXTS)}


def hosts(spark):
    rows = [(k, "bad", GOOD + (JUNK if k % 10 else "")) for k in range(200)]
    rows += [(1000 + k, f"h{k % 5}", GOOD + (JUNK if k % 20 == 0 else "")) for k in range(200)]
    rows += [(2000, "small", GOOD + JUNK), (3000, None, GOOD), (3001, None, GOOD + JUNK)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string")


def test_verdict_of_the_host_decides_soft_failures(spark):
    kept = {r["doc_id"] for r in quality_rules(hosts(spark)).where("kept").collect()}
    # Clean documents stay everywhere; soft failures go on the failing host alone.
    assert {k for k in range(200)} & kept == {k for k in range(0, 200, 10)}
    assert {k for k in range(1000, 1200)} <= kept and {2000, 3000, 3001} <= kept


def test_rates_are_shrunk_by_the_beta_prior(spark):
    rows = host_rates(judge(measure(hosts(spark)))).where("rule = 'any'").collect()
    shares = [r["failed"] / r["docs"] for r in rows]
    mean = sum(shares) / len(shares)
    spread = sum((s - mean) ** 2 for s in shares) / (len(shares) - 1)
    chance = sum(s * (1 - s) / r["docs"] for s, r in zip(shares, rows, strict=True)) / len(shares)
    weight = max(mean * (1 - mean) / max(spread - chance, 1e-6) - 1, 10)
    assert [r["rate"] for r in rows] == pytest.approx([(r["failed"] + mean * weight) / (r["docs"] + weight) for r in rows])
    by = {r["host"]: r["rate"] for r in rows}
    assert by["bad"] > 0.8 and by["small"] < 0.5 and None in by


def test_nulls_repeated_rows_clashing_columns_and_empty(spark):
    rows = [(None, None, GOOD, 1), (1, "a", GOOD, 2), (1, "a", GOOD, 2), (2, "a", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, words long")
    got = [(r["doc_id"], r["n_words"], r["kept"]) for r in quality_rules(df).collect()]
    n = len(GOOD.split())
    assert Counter(got) == Counter([(None, n, True), (1, n, True), (1, n, True), (2, 0, False)])
    assert sorted((r["doc_id"] or 0, r["words"]) for r in keep_good(df).collect()) == [(0, 1), (1, 2), (1, 2)]
    assert quality_rules(df.limit(0)).count() == 0 and keep_good(df.limit(0)).columns == df.columns


def test_limits_are_parameters(spark):
    df = spark.createDataFrame([(1, "a", "just five words are here")], "doc_id long, source string, text string")
    assert quality_rules(df, Limits(least_words=3)).first()["kept"]


def test_no_python_in_the_plan(spark):
    plan = quality_rules(hosts(spark))._jdf.queryExecution().toString() + measure(hosts(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_a_very_long_text_of_distinct_words_repeats_nothing(spark):
    df = spark.range(1).select("id", F.array_join(F.transform(F.sequence(F.lit(0), F.lit(4_000_000)), lambda x: F.hex(x)), " ").alias("text"), F.lit("s").alias("source"))
    got = measure(df.withColumnRenamed("id", "doc_id")).select("n_words", "n_repeat_words").first()
    assert tuple(got) == (4_000_001, 0)
