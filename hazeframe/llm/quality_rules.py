"""Quality rules of documents and of the hosts they come from, in DataFrame functions.

Each document is held against rules.  Failures are counted per host, and a host's
rates are shrunk towards those of all hosts: the prior is a beta distribution whose
mean and spread are taken from the hosts themselves, so a host with three documents
is judged by the corpus and one with a million by its own record.  The verdict on a
host goes back to its documents: there, a document that breaks one of the softer
rules is rejected too.  A document that breaks no rule always stays.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
SOFT = ("symbols", "dup_lines", "word_length")


@dataclass(frozen=True)
class Limits:
    """Limits of the rules; shares in percent."""

    least_words: int = 10
    repeat_words: int = 20
    symbols: int = 10
    dup_lines: int = 30
    word_length: tuple[int, int] = (2, 15)
    # Failing share of a host's documents, shrunk, above which the host fails.
    host: float = 0.5
    # Documents the prior counts for at least: a handful condemns no host.
    least_prior: float = 10.0


def _without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def measure(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text") -> DataFrame:
    """Counts of each document: ``doc_id``, ``host``, ``text_key`` (64-bit hash) and the columns of the rules.

    Windows of five words are compared by 64-bit hashes; no row leaves its task.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"), text.alias("text"))
    rows = rows.select("*", F.array_remove(F.split("text", SPACES), "").alias("words"), F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    rows = rows.select(
        "doc_id",
        "host",
        F.xxhash64("text").alias("text_key"),
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashed"),
    )
    # Most texts repeat no window, which plain hashes tell; only the others need places.
    # Hash and place of each window: sorted, equal windows are neighbours.
    window = ", ".join(f"get(hashed, i + {k})" for k in range(WINDOW))
    hashes = f"CASE WHEN n_words >= {WINDOW} THEN transform(sequence(0, n_words - {WINDOW}), i -> xxhash64({window})) ELSE array() END"
    rows = rows.withColumn("windows", F.expr(hashes)).drop("hashed")
    placed = "sort_array(transform(windows, (h, i) -> struct(h AS h, CAST(i AS BIGINT) AS i)))"
    rows = rows.withColumn("placed", F.expr(f"CASE WHEN size(array_distinct(windows)) < size(windows) THEN {placed} ELSE array() END")).drop("windows")
    again = "filter(placed, (x, k) -> x.h = get(placed, k - 1).h OR x.h = get(placed, k + 1).h)"
    rows = rows.withColumn("again", F.expr(f"sort_array(transform({again}, x -> x.i))")).drop("placed")
    covered = f"transform(again, (x, k) -> least({WINDOW}L, coalesce(get(again, k + 1) - x, {WINDOW}L)))"
    return rows.withColumn("n_repeat_words", F.expr(f"aggregate({covered}, 0L, (a, x) -> a + x)")).drop("again")


def judge(counts: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The counts with ``base_failed`` and a column ``fails_<rule>`` per softer rule."""
    n, low, high = F.col("n_words"), *limits.word_length
    return counts.withColumns(
        {
            "base_failed": (n < limits.least_words) | (F.col("n_repeat_words") * 100 > n * limits.repeat_words),
            "fails_symbols": F.col("n_symbols") * 100 > n * limits.symbols,
            "fails_dup_lines": F.col("n_dup_lines") * 100 > F.col("n_lines") * limits.dup_lines,
            "fails_word_length": (F.col("word_chars") < n * low) | (F.col("word_chars") > n * high),
        }
    )


def host_rates(judged: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Failures by host and rule: ``host``, ``rule``, ``docs``, ``failed``, ``rate`` (shrunk).

    Rules: ``base``, each softer one, and ``any``.  The prior of a rule has the mean
    of the hosts' rates and their variance less what chance adds; a null host is a
    host of its own.
    """
    rules = {"base": F.col("base_failed"), **{r: F.col(f"fails_{r}") for r in SOFT}}
    any_rule = F.greatest(*rules.values())
    sums = [F.sum(c.cast("long")).alias(r) for r, c in {**rules, "any": any_rule}.items()]
    hosts = judged.groupBy("host").agg(F.count("*").alias("docs"), *sums)
    named = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("failed")) for r in [*rules, "any"]]))
    long = common.store(hosts.select("host", "docs", named.alias("one")).select("host", "docs", "one.*"), "host-failures")
    share = F.col("failed") / F.col("docs")
    moments = long.groupBy("rule").agg(
        F.avg(share).alias("mean"), F.coalesce(F.var_samp(share), F.lit(0.0)).alias("spread"), F.avg(share * (1 - share) / F.col("docs")).alias("chance")
    )
    # One row per rule.
    between = F.greatest(F.col("spread") - F.col("chance"), F.lit(1e-6))
    weight = F.greatest(F.col("mean") * (1 - F.col("mean")) / between - 1, F.lit(limits.least_prior))
    prior = moments.select("rule", "mean", weight.alias("weight"))
    rate = (F.col("failed") + F.col("mean") * F.col("weight")) / (F.col("docs") + F.col("weight"))
    return long.join(F.broadcast(prior), "rule").select("host", "rule", "docs", "failed", rate.alias("rate"))


def quality_rules(
    docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", host_col: str = "source", text_col: str = "text"
) -> DataFrame:
    """Per document: ``doc_id``, ``text_key``, counts, ``base_failed``, ``kept``.

    ``kept`` is false if a base rule fails, or a softer one on a host whose shrunk
    failure rate is above ``limits.host``.  A null or empty text has no words and
    fails; documents without a host make up one host.  Rows are judged one by one,
    repeated ones alike, and null ids stay.  Other columns are not looked at.  An
    empty table gives no rows.
    """
    judged = common.store(judge(measure(docs, id_col, host_col, text_col), limits), "judged")
    failing = host_rates(judged, limits).where((F.col("rule") == "any") & (F.col("rate") > limits.host))
    failing = failing.select(F.col("host").alias("bad_host"), F.lit(True).alias("host_failed"))
    soft = F.greatest(*[F.col(f"fails_{r}") for r in SOFT])
    kept = ~F.col("base_failed") & ~(soft & F.coalesce("host_failed", F.lit(False)))
    out = judged.join(common.store(failing, "bad-hosts"), F.col("host").eqNullSafe(F.col("bad_host")), "left")
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return out.select("doc_id", "text_key", *counts, kept.alias("kept"))


def keep_good(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``documents`` that the rules keep, with their columns.

    Verdicts find their rows by id and text, so repeated and null ids are no matter.
    """
    good = common.store(quality_rules(docs, limits).where("kept").select("doc_id", "text_key").distinct(), "good")
    rows = common.wrapped(docs)
    same = rows["doc_id"].eqNullSafe(good["doc_id"]) & (rows["text_key"] == good["text_key"])
    return common.unwrapped(rows.join(good, same, "left_semi"), docs)
