"""URL filters whose lists change over time, in DataFrame functions.

A list is a log: at some time an entry blocks a domain with all hosts below it, a
host alone or a path with all below it, or allows it again.  Entries become validity
intervals, from one entry of a key to its next, and intervals are cut at the ends of
periods.  A capture has a key for each parent of its host and its path that the list
is deep enough for; each joins the interval of its key and period that holds the fetch
time, so the as-of join is an equi-join of bounded work even where one key has a long
history.  Keys with very many captures are dealt into shares.  Of a capture's keys the
most specific one that is listed decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from . import common

# Days in a period.
PERIOD = 30
# Kinds of entries, the most specific last.
LEVELS = ("domain", "host", "path")
# A key and period with more than one in so many of the captures' keys is hot, so there are fewer hot ones than this.
HOT = 1000
# Labels of the shortest domains that the derived list has.
LABELS = 2


def host_of(url: Column) -> Column:
    """Host in lower case, without login, port and dots at its end; null if the URL has none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    host = F.rtrim(host, F.lit("."))
    return F.when(host != "", host)


def address_of(url: Column) -> Column:
    """Host and path, single slashes and none at the end; null if the URL has no host."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)
    return F.concat(host_of(url), F.rtrim(F.regexp_replace(path, "/+", "/"), F.lit("/")))


def _depth(level: str, text: str) -> str:
    """SQL: labels of a domain, steps of a path; 0 for a host."""
    if level == "host":
        return "0"
    return f"length({text}) - length(replace({text}, '.', '')) + 1" if level == "domain" else f"length({text}) - length(replace({text}, '/', ''))"


def keys_of(host: str, address: str, depths: dict[str, str]) -> Column:
    """Array of ``level``, ``depth``, ``key`` from two columns; ``depths`` has SQL arrays of the depths wanted, by level.

    A domain key is the host's last labels, a path key the host with its first steps.
    """
    key = {"domain": f"substring_index({host}, '.', -d)", "host": host, "path": f"substring_index({address}, '/', d + 1)"}
    of = {"domain": host, "host": host, "path": address}
    parts = []
    for level in LEVELS:
        deep = f"filter({depths[level]}, d -> d <= {_depth(level, of[level])})"
        parts.append(f"transform({deep}, d -> struct('{level}' AS level, cast(d AS int) AS depth, {key[level]} AS key))")
    return F.when(F.expr(f"{host} IS NOT NULL"), F.expr(f"concat({', '.join(parts)})"))


def intervals(entries: DataFrame) -> DataFrame:
    """``key``, ``level``, ``listed_on``, ``until`` (first day on which it no longer holds, or null), ``blocks``.

    ``entries`` has ``level``, ``key``, ``listed_on`` (date) and ``action`` ("block" or
    "allow").  Of entries of one key and day a block wins.  Entries with a null key,
    day or other action are left out.
    """
    known = entries.where("key IS NOT NULL AND listed_on IS NOT NULL AND action IN ('block', 'allow')")
    daily = known.groupBy("level", "key", "listed_on").agg(F.max(F.col("action") == "block").alias("blocks"))
    later = F.lead("listed_on").over(Window.partitionBy("level", "key").orderBy("listed_on"))
    return daily.withColumn("until", later)


def _numbers(values: list[int]) -> str:
    """SQL of an array of integers."""
    return f"cast(split('{','.join(map(str, sorted(values)))}', ',') AS array<int>)" if values else "cast(array() AS array<int>)"


def _periods(listed: DataFrame, periods: list[int]) -> DataFrame:
    """Intervals, once for each of the captures' periods they reach into."""
    first, to = _period(F.col("listed_on")), _period(F.date_sub("until", 1))
    return listed.withColumns({"first": first, "to": to}).withColumn("period", F.explode(F.expr(f"filter({_numbers(periods)}, p -> p >= first AND (to IS NULL OR p <= to))"))).drop("first", "to")


def _period(day: Column) -> Column:
    return F.floor(F.unix_date(day) / PERIOD).cast("int")


def _normal(entries: DataFrame) -> DataFrame:
    """Entries with keys written as captures' are: host in lower case, no dots or slashes at the end."""
    key = F.col("key").cast("string")
    host = F.rtrim(F.lower(F.substring_index(key, "/", 1)), F.lit("."))
    steps = F.rtrim(F.regexp_replace(F.regexp_extract(key, r"^[^/]*(/.*)$", 1), "/+", "/"), F.lit("/"))
    clean = F.when(F.col("level") == "path", F.concat(host, steps)).otherwise(F.rtrim(F.lower(key), F.lit(".")))
    return entries.select("level", F.when(clean != "", clean).alias("key"), F.col("listed_on").cast("date").alias("listed_on"), "action")


def evaluate(
    captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", day_col: str = "fetched_on"
) -> DataFrame:
    """Per capture: ``page_id``, ``url``, ``fetched_on``, ``matched_level``, ``matched_key``, ``listed_on``, ``verdict``, ``kept``.

    ``entries`` has ``level``, ``key``, ``listed_on`` and ``action``.  A "domain" entry
    holds for the host of its name and all below it, whatever the number of labels
    ("example.org", "co.uk"), a "host" entry for that host alone, a "path" entry
    ("example.org/a/b") for that path of that host and all below it.  Of the entries
    active on the fetch day (from their own day on) the longest path decides, else the
    host, else the longest domain: the verdict is "blocked" or "allowed", or "unlisted"
    if there is none.  Captures that are blocked are not kept.

    A null or malformed URL, or a null day, is unlisted.  Repeated captures are judged
    one by one.  Other columns are not looked at.  An empty list leaves all unlisted,
    an empty table gives no rows.
    """
    rows = captures.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(day_col).cast("date").alias("fetched_on"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "address": address_of(F.col("url")), "period": _period(F.col("fetched_on"))})
    rows = common.store(rows.withColumn("row", F.monotonically_increasing_id()), "captures")
    # One number for each month or so of the calendar that has captures.
    periods = [p for (p,) in rows.where("period IS NOT NULL").select("period").distinct().collect()]
    depth = F.expr("CASE level " + " ".join(f"WHEN '{level}' THEN {_depth(level, 'key')}" for level in LEVELS) + " END").cast("int")
    listed = common.store(_periods(intervals(_normal(entries)).withColumn("depth", depth), periods), "intervals")
    # Depths that differ: their number grows at most with the root of the list's bytes.
    asked = {level: _numbers([]) for level in LEVELS}
    asked.update({r["level"]: _numbers(r["depths"]) for r in listed.groupBy("level").agg(F.collect_set("depth").alias("depths")).collect() if r["level"] in asked})
    keys = rows.where("period IS NOT NULL").select("row", "fetched_on", "period", F.explode(keys_of("host", "address", asked)).alias("one"))
    keys = keys.select("row", "fetched_on", "period", "one.*")
    by = ["level", "key", "period"]
    counts = keys.groupBy(*by).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    each = max(1, total // HOT)
    # Fewer than 2 * HOT rows.
    hot = common.store(counts.where(F.col("n") > each).select(*by, F.ceil(F.col("n") / each).cast("int").alias("shares")), "hot-keys")
    shares = F.coalesce("shares", F.lit(1))
    dealt = keys.join(F.broadcast(hot), by, "left").withColumn("share", F.pmod(F.xxhash64("row"), shares).cast("int")).drop("shares")
    side = listed.join(F.broadcast(hot), by, "left").withColumn("share", F.explode(F.sequence(F.lit(0), shares - 1))).drop("shares", "depth")
    active = (F.col("fetched_on") >= F.col("listed_on")) & (F.col("until").isNull() | (F.col("fetched_on") < F.col("until")))
    found = dealt.join(side, [*by, "share"]).where(active)
    rank = F.expr("CASE level " + " ".join(f"WHEN '{level}' THEN {n}" for n, level in enumerate(LEVELS)) + " END")
    best = found.groupBy("row").agg(F.max(F.struct(rank.alias("rank"), "depth", "level", "key", "listed_on", "blocks")).alias("best"))
    blocks = F.col("best.blocks")
    verdict = F.when(blocks, "blocked").when(~blocks, "allowed").otherwise("unlisted")
    return rows.join(best, "row", "left").select(
        "page_id", "url", "fetched_on", F.col("best.level").alias("matched_level"), F.col("best.key").alias("matched_key"),
        F.col("best.listed_on").alias("listed_on"), verdict.alias("verdict"), (~F.coalesce(blocks, F.lit(False))).alias("kept"),
    )


def _day(text: Column, digit: int) -> Column:
    """A day of 2024 and the year after, from a hash of the text."""
    number = F.conv(F.substring(F.md5(text), digit, 4), 16, 10).cast("int")
    return F.date_add(F.lit("2024-01-01").cast("date"), number % 500)


def dated_captures(pages: DataFrame) -> DataFrame:
    """``pages`` with a fetch day.  The table has none, so a hash of the URL gives it."""
    return pages.select("page_id", "url", _day(F.coalesce("url", F.lit("")), 1).alias("fetched_on"))


def dated_list(pages: DataFrame) -> DataFrame:
    """A block list with a history: every domain, host and path of the pages' URLs, listed, taken off and listed again.

    Domains have two labels or more.  The three days of a key come from a hash of it,
    so some keys are listed before and some after their pages were fetched.
    """
    rows = pages.select(host_of(F.col("url")).alias("host"), address_of(F.col("url")).alias("address")).distinct()
    every = {
        "domain": f"sequence({LABELS}, greatest({LABELS}, {_depth('domain', 'host')}))",
        "host": "array(0)", "path": f"sequence(1, greatest(1, {_depth('path', 'address')}))",
    }
    keys = rows.select(F.explode(keys_of("host", "address", every)).alias("one")).select("one.level", "one.key").distinct()
    text = F.concat("level", F.lit(":"), "key")
    actions = [("block", 1), ("allow", 5), ("block", 9)]
    log = F.explode(F.array(*[F.struct(_day(text, digit).alias("listed_on"), F.lit(action).alias("action")) for action, digit in actions])).alias("entry")
    return keys.select("level", "key", log).select("level", "key", "entry.*")
