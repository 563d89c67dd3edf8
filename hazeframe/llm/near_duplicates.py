"""Near duplicates: MinHash bands propose pairs, odd sketches sift them, full sets decide.

Each text becomes the set of its word shingles.  Texts with equal sets are one
class from then on.  Two kinds of MinHash samples are taken from a class:

* independent minima, cut into bands, propose candidates;
* one minimum per bin of a single hash, folded into a parity bitmap (the odd
  sketch).  The population count of the XOR of two bitmaps estimates how many
  samples differ, and sharply so where most agree.  A pair goes on unless its
  count is five standard deviations off what the threshold allows.

In a bucket, classes are compared with one hub per band first; links found there
make components, and after that only pairs across components are compared, in
blocks.  So a group of copies costs as many pairs as it has members.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components

BANDS = 32
ROWS = 4
BINS = 4096
BITS = 4096
# Standard deviations that a sketch may be off before a pair is sifted out.
DEVIATIONS = 5
# Hubs that a class is compared with at first, by their sketches' nearness.
NEAREST = 8
# Members of a bucket on one side of a block of comparisons.
BLOCK = 1000
# Shingles whose minima are taken at a time.
_STEP = 4096

_seeded = np.random.Generator(np.random.PCG64(8))
_FACTOR = _seeded.integers(0, 1 << 31, (BANDS * ROWS, 1), np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFT = _seeded.integers(0, 1 << 32, (BANDS * ROWS, 1), np.uint32)
_BAND = _seeded.integers(0, 1 << 63, BANDS, np.uint64)
_MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)

_SIGNATURE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_key", pa.int64()),
        ("n", pa.int64()),
        ("node", pa.int64()),
        ("check", pa.int64()),
        ("filled", pa.int32()),
        ("sketch", pa.list_(pa.int64())),
        ("bands", pa.list_(pa.int64())),
    ]
)
_SIGNATURE_SQL = "doc_id long, text_key long, n long, node long, check long, filled int, sketch array<long>, bands array<long>"


def _digest(found: np.ndarray) -> tuple[np.int64, np.int64]:
    """128 bits that stand for a set of shingles."""
    one = common.mix(found + np.uint64(1)).sum(dtype=np.uint64)
    two = common.mix(found * _MULTIPLIER).sum(dtype=np.uint64)
    return one.astype(np.int64), two.astype(np.int64)


def _bands(found: np.ndarray) -> np.ndarray:
    low = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    high = (found >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(high), _STEP):
        part = _FACTOR * high[None, at : at + _STEP]
        part += _SHIFT
        np.minimum(low, part.min(axis=1), out=low)
    key = _BAND.copy()
    for minima in low.reshape(BANDS, ROWS).T:
        key = common.mix(key * _MULTIPLIER + minima)
    return key.view(np.int64)


def _odd_sketch(found: np.ndarray) -> tuple[np.ndarray, int]:
    """One minimum per bin, folded into a bitmap of parities; and the bins in use."""
    # The bin in the upper 12 bits, what ranks within it below.
    ranked = np.sort(((found % np.uint64(BINS)) << np.uint64(52)) | (found >> np.uint64(12)))
    bins = ranked >> np.uint64(52)
    lowest = ranked[np.append(True, bins[1:] != bins[:-1])]
    odd = np.bincount((common.mix(lowest) % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64), len(lowest)


def _signatures(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1)
            for row, data, bounds in common.chunks(batch.column(2)):
                _, hashes, at = common.words(data, bounds, lower=True)
                rows = []
                for k in range(len(bounds) - 1):
                    found = common.shingle_set(hashes[at[k] : at[k + 1]], width)
                    if len(found):
                        sketch, filled = _odd_sketch(found)
                        rows.append((len(found), *_digest(found), filled, sketch, _bands(found)))
                    else:
                        rows.append((0, 0, 0, 0, None, None))
                columns = list(zip(*rows, strict=True))
                yield pa.record_batch([ids.slice(row, len(rows)), keys.slice(row, len(rows)), *[pa.array(c, f.type) for c, f in zip(columns, list(_SIGNATURE)[2:], strict=True)]], schema=_SIGNATURE)

    return run


def _differing(one: str, two: str) -> Column:
    """Samples that differ, estimated from the bitmaps; null when the bitmaps are full."""
    pairs = F.zip_with(one, two, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    odd = F.aggregate(pairs, F.lit(0), lambda total, x: total + x)
    return F.when(odd * 2 < BITS, F.log(1 - odd * 2 / BITS) / math.log(1 - 2 / BITS))


def _allowed(share: float) -> Column:
    """Samples that may differ when the sets are as similar as asked, with ``DEVIATIONS``.

    Columns: set sizes ``n``, ``n2``; bins in use ``filled``, ``filled2``.
    """
    used = lambda n: (1 - F.exp(n * math.log(1 - 1 / BINS))) * BINS
    union = (F.col("n") + F.col("n2")) / (1 + share)
    # How full the bins of the two really are, against what is usual for their sizes.
    scale = (F.col("filled") + F.col("filled2")) / (used(F.col("n")) + used(F.col("n2")))
    bins = used(union) * scale
    differ = F.col("filled") + F.col("filled2") - 2 * share * bins
    # Sampling: none while every shingle has a bin of its own.
    sampled = 4 * share * (1 - share) * bins * F.greatest(F.lit(0.0), 1 - bins / union)
    folded = F.exp(4 * differ / BITS) * (BITS / 4) * (1 - F.exp(-4 * differ / BITS)) - differ
    spread = F.sqrt(sampled + F.greatest(F.lit(0.0), folded) + 0.25)
    return differ + DEVIATIONS * spread + 0.005 * bins + 1


def _similar_sizes(percent: int) -> Column:
    return F.least("n", "n2") * 100 >= F.greatest("n", "n2") * percent


def _decide(width: int, percent: int):
    """Of candidate pairs with their texts, those that the full sets confirm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            keep = []
            left, right = (_sets(batch.column(c), width) for c in ("text", "text2"))
            for k, (one, two) in enumerate(zip(left, right, strict=True)):
                # Rows that share a doc_id bring texts of other classes along.
                if (_digest(one)[0], _digest(two)[0]) == (a[k], b[k]):
                    common_ones = len(np.intersect1d(one, two, assume_unique=True))
                    if 100 * common_ones >= percent * (len(one) + len(two) - common_ones):
                        keep.append(k)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return run


def _sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    for _, data, bounds in common.chunks(column):
        _, hashes, at = common.words(data, bounds, lower=True)
        for k in range(len(bounds) - 1):
            yield common.shingle_set(hashes[at[k] : at[k + 1]], width)


def _links(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs ``a``, ``b`` that the full sets confirm, stored."""
    left = texts.select(F.col("node").alias("a"), "text")
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text2"))
    full = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "text", "text2")
    return common.store(full.mapInArrow(_decide(width, percent), "a long, b long").distinct(), "decided")


def _labelled(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """Nodes with the label of their component, their own where they have no link."""
    return nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _ends(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends are in two components, with the labels ``la`` and ``lb``."""
    for end in "ab":
        named = labels.select(F.col("node").alias(end), F.col("label").alias(f"l{end}"))
        pairs = pairs.join(named, end, "left").withColumn(f"l{end}", F.coalesce(f"l{end}", end))
    return pairs.where("la != lb")


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Groups of texts whose shingle sets are similar: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Shingles are ``width`` words, A-Z lowered; two texts are linked when at least
    ``percent`` of the union of their sets is common, and a group is what links
    connect.  ``component_id`` is the smallest id of the group.

    A text of fewer words is one shingle; an empty or null one has none and is
    linked with nothing.  Equal sets are always linked.  Rows that repeat an id
    are compared one by one, and the id's rows share what either is linked with.
    A row without an id is linked with nothing (``component_id`` null, kept).
    Other columns are not looked at.  An empty table gives no rows.

    A pair exactly at the threshold of 80 meets in no band with a probability of
    5e-8, and is sifted out with about 3e-7.
    """
    return grouped_rows(docs, width, percent, id_col, text_col).drop("text_key", "group_key")


def grouped_rows(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``near_duplicates`` with what tells rows of one id apart: ``text_key``, and ``group_key`` of the text's group.

    ``group_key`` is null where a row is linked with nothing by rule: no words or no id.
    """
    share = percent / 100
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    found = common.store(rows.select("doc_id", "text_key", "text").mapInArrow(_signatures(width), _SIGNATURE_SQL), "signatures")

    # Classes of equal sets; a copy of a class has no part in the search.
    known = found.where("n > 0 AND doc_id IS NOT NULL")
    whole = F.struct("n", "filled", "sketch", "bands")
    classes = known.groupBy("node").agg(F.min("doc_id").alias("rep"), F.min_by(whole, "doc_id").alias("one"))
    classes = common.store(classes.select("node", "rep", "one.*"), "classes")
    sketches = classes.select("node", "n", "filled", "sketch")
    members = classes.select("node", "rep", F.explode("bands").alias("key"))

    # A hub of each bucket that has more than one class.
    hubs = members.groupBy("key").agg(
        F.min(F.struct(F.xxhash64("node", "key").alias("by"), F.col("node").alias("hub")))["hub"].alias("hub"), F.count("*").alias("size")
    )
    full = common.store(members.join(hubs.where("size > 1"), "key"), "members")
    stars = full.where("node != hub").select("node", "hub").distinct()
    second = sketches.toDF("hub", "n2", "filled2", "sketch2")
    stars = stars.join(sketches, "node").join(second, "hub").where(_similar_sizes(percent))
    stars = stars.withColumn("differ", _differing("sketch", "sketch2")).where(F.col("differ") <= _allowed(share))
    far = F.struct((F.col("differ") / (F.col("filled") + F.col("filled2"))).alias("far"), "hub")

    # Texts of the classes that share a bucket with another.
    needed = full.select("node", F.col("rep").alias("doc_id")).distinct()
    texts = common.store(rows.join(needed, "doc_id").select("node", "text"), "texts")

    # Each class and its nearest hubs, of which there is one a band at most.
    near = stars.groupBy("node").agg(F.slice(F.array_sort(F.collect_list(far)), 1, NEAREST).alias("hubs"))
    near = near.select("node", F.explode("hubs.hub").alias("hub")).select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
    labels = common.store(components(_links(near.distinct(), texts, width, percent)), "labels")

    # Every pair of a bucket that is still across components.
    named = _labelled(full.select("node", "key"), labels)
    mixed = named.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size"))
    mixed = mixed.where("low != high").select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    across = common.store(named.join(mixed, "key").join(classes.select("node", "n", "filled", "sketch", "bands"), "node"), "across")
    left = across.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int")).drop("blocks")
    right = across.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    right = right.toDF("node2", "key", "label2", "n2", "filled2", "sketch2", "bands2", "block")
    differ = F.coalesce(_differing("sketch", "sketch2"), F.lit(math.inf))
    meet = (left["key"] == right["key"]) & (left["block"] == right["block"]) & (F.col("label") < F.col("label2"))
    # A pair that shares many buckets is looked at in one of them.
    once = F.array_min(F.array_intersect("bands", "bands2")) == left["key"]
    rest = left.join(right, meet & _similar_sizes(percent) & (differ <= _allowed(share)) & once)
    rest = rest.select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct()
    ends = _ends(_links(rest, texts, width, percent), labels)
    joined = components(ends.select(F.col("la").alias("a"), F.col("lb").alias("b"))).toDF("label", "joined")

    grouped = _labelled(classes.select("node", "rep"), labels).join(joined, "label", "left")
    grouped = grouped.withColumn("label", F.coalesce("joined", "label"))
    smallest = grouped.groupBy("label").agg(F.min("rep").alias("component_id"))
    grouped = grouped.join(smallest, "label").select("node", "label", "component_id")
    out = found.select("doc_id", "text_key", "n", "node").join(grouped, "node", "left")
    alone = (F.col("n") == 0) | F.col("doc_id").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
        "text_key", F.when(~alone, F.col("label")).alias("group_key"),
    )


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``documents`` with their columns, one of each group of near duplicates.

    Of rows that repeat an id those of different groups all stay, and of one group one;
    rows without an id all stay.
    """
    kept = common.store(grouped_rows(docs, width, percent).where("kept").select("doc_id", "text_key", "group_key"), "kept")
    counts = kept.where("doc_id IS NOT NULL").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("ids")).first()
    # Where a group's least id repeats, the least text of it stays; texts without words are groups of their own.
    group = F.when(F.col("doc_id").isNotNull(), F.col("group_key"))
    alone = kept.where(group.isNull()).select("doc_id", "text_key").distinct()
    named = kept.where(group.isNotNull()).groupBy("doc_id", "group_key").agg(F.min("text_key").alias("text_key")).select("doc_id", "text_key")
    named = named.unionByName(alone).toDF("kept_id", "kept_key")
    rows = common.wrapped(docs)
    out = rows.join(named, rows["doc_id"].eqNullSafe(named["kept_id"]) & (rows["text_key"] == named["kept_key"]), "left_semi")
    if counts["n"] == counts["ids"]:
        return common.unwrapped(out, docs)
    # Rows of equal id and text: the first as JSON, which a column of any type has.
    single = out.where("doc_id IS NOT NULL").groupBy("doc_id", "text_key").agg(F.min_by("one", F.to_json("one")).alias("one"))
    return common.unwrapped(single.select("one").unionByName(out.where("doc_id IS NULL").select("one")), docs)
