"""Mixing sources to target weights by balanced sampling with the cube method.

A source's target over its size says how often its documents are taken: a whole
number of times for all, and once more with the probability that is left over.  The
cube method decides who is taken once more.  It walks from the vector of
probabilities to a corner of the cube, one step along a null-space vector of the
balancing constraints at a time, so that the sums of words and of documents stay
what they were; every step settles a document.  Blocks of a source are walked at
once, each until at most two documents are open (there are two constraints); the
open ones of many blocks make up the blocks of the next round.  When a source has
but one block left, the last open documents land where the sum is nearest.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

# Documents of a block; a task walks one block at a time.
BLOCK = 4096
WEIGHTS = (1.0, 2.0, 3.0)
MOST = 3

_EDGE = 1e-9


def _words(text_col: str) -> Column:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return F.size(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")).cast("long")


def sizes(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``source``, ``size`` (words), ``text_key`` of each row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), _words(text_col).alias("size"), F.xxhash64(text).alias("text_key"))


def ranked_sources(measured: DataFrame) -> DataFrame:
    """``source``, ``docs``, ``source_size``, ``rank`` (0 first, by code point, null last).

    Ranks are counted per range of names, then shifted by the ranges before.
    """
    by_source = measured.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    # UTF-8 sorts as its code points do.
    ordered = by_source.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
    numbered = common.store(ordered.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "sources")
    parts = numbered.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    # One row per range, that is per shuffle partition.
    before, base = {}, 0
    for row in parts.orderBy("part").collect():
        before[row["part"]] = base - row["first"]
        base += row["n"]
    shift = F.element_at(F.create_map(*itertools.chain.from_iterable((F.lit(k), F.lit(v)) for k, v in before.items())), F.col("part")) if before else F.lit(0)
    return numbered.select("source", "docs", "source_size", (F.col("at") + shift).alias("rank"))


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The sources with ``target``: shares of all words by weight, at most ``most`` times a source's size.

    What a full source leaves goes to the others by weight, until none is above:
    every open source then has one level of words per unit of weight.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    weighted = common.store(sources.withColumn("weight", weight), "weighted")
    room = F.col("source_size") * most
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        open_ones = F.col("weight") * level < room if full >= 0 else F.lit(True)
        row = weighted.agg(
            F.sum(F.when(open_ones, F.col("weight"))).alias("open"), F.sum(F.when(~open_ones, room)).alias("given"), F.count(F.when(~open_ones, 1)).alias("full")
        ).first()
        if row["full"] == full or not row["open"]:
            break
        level, full = (total - (row["given"] or 0)) / row["open"], row["full"]
    return weighted.withColumn("target", F.least(F.col("weight") * F.lit(float(level)), room.cast("double")))


def walk(chance: np.ndarray, size: np.ndarray, land: bool) -> np.ndarray:
    """Flight phase over one block: chances to 0 or 1, with at most two left open unless ``land``.

    The sum of the chances and the sum of chance times size stay the same.
    """
    chance = chance.copy()
    free = np.flatnonzero((chance > _EDGE) & (chance < 1 - _EDGE)).tolist()
    chance[chance <= _EDGE] = 0.0
    chance[chance >= 1 - _EDGE] = 1.0
    scale = float(size.max(initial=0)) or 1.0
    held: list[int] = []
    while True:
        while len(held) < 3 and free:
            held.append(free.pop())
        if len(held) < 3:
            break
        a, b, c = (size[i] / scale for i in held)
        # Orthogonal to (1, 1, 1) and to the sizes; any zero-sum vector if these are equal.
        step = (b - c, c - a, a - b)
        if max(map(abs, step)) < 1e-12:
            step = (1.0, -1.0, 0.0)
        ahead = back = np.inf
        for i, s in zip(held, step, strict=True):
            if abs(s) > 1e-15:
                up, down = (1 - chance[i]) / abs(s), chance[i] / abs(s)
                ahead, back = min(ahead, up if s > 0 else down), min(back, down if s > 0 else up)
        # Either way with the odds that keep each chance what it is on average.
        move = ahead if _coin(held, chance) * (ahead + back) < back else -back
        for i, s in zip(held, step, strict=True):
            chance[i] += move * s
        settled = [i for i in held if chance[i] <= _EDGE or chance[i] >= 1 - _EDGE]
        for i in settled:
            chance[i] = round(float(chance[i]))
        held = [i for i in held if i not in settled]
    if land and held:
        want = sum(float(chance[i]) * float(size[i]) for i in held)
        best = min(itertools.product((0.0, 1.0), repeat=len(held)), key=lambda c: (abs(sum(x * float(size[i]) for x, i in zip(c, held, strict=True)) - want), c))
        for x, i in zip(best, held, strict=True):
            chance[i] = x
    return chance


def _coin(held: list[int], chance: np.ndarray) -> float:
    """A number in [0, 1) that depends on the block's state alone, so reruns agree."""
    state = np.array([*held, *chance[held].view(np.int64)], np.int64).view(np.uint64)
    mixed = common.mix(common.mix(state) * np.arange(3, 2 * len(state) + 3, 2, dtype=np.uint64)).sum(dtype=np.uint64)
    return float(common.mix(np.array([mixed]))[0] >> np.uint64(11)) / (1 << 53)


def _flight(land: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["order", "doc_id", "size", "row"], na_position="first").reset_index(drop=True)
        done = bool(land and block["last"].iloc[0])
        block["chance"] = walk(block["chance"].to_numpy(np.float64), block["size"].to_numpy(np.float64), done)
        return block[["row", "doc_id", "stratum", "block", "order", "size", "chance"]]

    return run


_ROW = "row long, doc_id long, stratum long, block long, order long, size long, chance double"


def cube_sample(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Balanced sample of each stratum: ``row`` and ``picked``.

    ``rows`` has ``row`` (unique), ``doc_id``, ``stratum``, ``order`` (any fixed
    number, evenly spread), ``size`` and ``chance``.  Within a stratum the sums of
    ``chance`` and of ``chance * size`` hold up to what two documents can differ.
    """
    settled = None
    open_rows = rows.select("row", "doc_id", "stratum", F.lit(0).cast("long").alias("block"), "order", "size", "chance")
    first = True
    while True:
        counts = common.store(open_rows.groupBy("stratum").agg(F.count("*").alias("n")), "strata")
        blocks = F.greatest(F.ceil(F.col("n") / block), F.lit(1)).cast("long")
        dealt = open_rows.join(counts, "stratum").withColumn("blocks", blocks)
        # By the documents' order at first, later whole blocks of the round before.
        number = F.pmod(F.col("order") if first else F.xxhash64("block"), F.col("blocks"))
        dealt = dealt.withColumn("block", number).withColumn("last", F.col("blocks") == 1)
        walked = dealt.groupBy("stratum", "block").applyInPandas(_flight(True), _ROW)
        walked = common.store(walked, "walk")
        is_open = (F.col("chance") > 0) & (F.col("chance") < 1)
        done = walked.where(~is_open).select("row", (F.col("chance") == 1).alias("picked"))
        settled = done if settled is None else settled.union(done)
        open_rows, first = walked.where(is_open), False
        if open_rows.isEmpty():
            return settled


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST,
    seed: int = 9,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """How many words of each document a mix takes: ``doc_id``, ``text_key``, ``size``, ``source_size``, ``target``, ``times``, ``taken``.

    Sources in code-point order weigh ``weights``, repeating (a null source is a
    source, and the last), and share all words; ``taken`` is ``times * size``.  The
    taken words of a source differ from its target by less than two documents have,
    and reruns agree.

    A null or empty text has size 0 and is never missed.  Repeated rows count, and
    are picked, one by one; a null id is an id like others.  Other columns are not
    looked at.  An empty table gives no rows; a source without words has target 0.
    """
    measured = sizes(docs, id_col, source_col, text_col)
    # Rows are numbered once, in a stored table, so that no recomputation renumbers them.
    return _mixed(common.store(measured.withColumn("row", F.monotonically_increasing_id()), "sizes"), weights, most, seed)


def _mixed(measured: DataFrame, weights: Sequence[float], most: int, seed: int) -> DataFrame:
    """The mix of stored rows with ``row``, a number of their own."""
    wanted = common.store(targets(ranked_sources(measured), weights, most), "targets")
    wanted = wanted.select(F.col("source").alias("of"), "rank", "source_size", "target")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = measured.join(wanted, measured["source"].eqNullSafe(wanted["of"])).drop("of")
    rows = rows.withColumn("whole", F.least(F.floor(share + _EDGE), F.lit(most)).cast("long"))
    rows = common.store(rows.withColumn("chance", F.greatest(share - F.col("whole"), F.lit(0.0))), "chances")
    order = F.xxhash64("doc_id", "text_key", F.lit(seed))
    asked = rows.where((F.col("chance") > _EDGE) & (F.col("size") > 0))
    asked = asked.select("row", F.col("doc_id").cast("long").alias("doc_id"), F.col("rank").alias("stratum"), order.alias("order"), "size", "chance")
    picked = cube_sample(asked).where("picked").select("row", F.lit(1).alias("extra"))
    times = (F.col("whole") + F.coalesce("extra", F.lit(0))).cast("long")
    out = rows.join(picked, "row", "left").withColumn("times", times)
    return out.select("doc_id", "text_key", "row", "size", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST, seed: int = 9) -> DataFrame:
    """The rows of ``documents`` with their columns, each as often as the mix takes it.

    Rows are numbered and stored first, so each is repeated by its own number of
    times, those of equal id and text too.
    """
    rows = common.store(common.wrapped(docs).withColumn("row", F.monotonically_increasing_id()), "numbered")
    measured = rows.select("doc_id", F.col("one.source").cast("string").alias("source"), _words("one.text").alias("size"), "text_key", "row")
    times = _mixed(common.store(measured, "sizes"), weights, most, seed).select("row", F.col("times").cast("int").alias("times"))
    taken = rows.join(times.where("times > 0"), "row")
    return common.unwrapped(taken.withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.col("times")))), docs)
