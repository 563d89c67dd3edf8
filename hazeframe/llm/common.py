"""Helpers that the operators share: stored tables, text buffers, word hashes."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeframe.sources import tables

# Text bytes that one round of array work takes; a single longer text is taken whole.
CHUNK_BYTES = 1 << 18

_STORED: list[str] = []


def folder(spark: SparkSession, label: str) -> str:
    """The URI of a new path in the folder that the driver and all executors share."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{tables.shared_folder(spark)}/hazeframe-llm-{label}-{uuid.uuid4().hex}")
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri().toString()
    uri = re.sub("^file:/+", "file:///", uri)
    _STORED.append(uri)
    return uri


def store(df: DataFrame, label: str) -> DataFrame:
    """Write a frame as Parquet to the shared folder and read it back.

    The lineage ends there: a lost executor costs no more than its running tasks.
    """
    path = folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete every table stored so far; results that still read them end."""
    for path in _STORED:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    _STORED.clear()


def wrapped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows as one struct each, with ``doc_id`` and ``text_key`` beside it.

    So a column of the table can have any name, and any type.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    one = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("text_key"), one.alias("one"))


def unwrapped(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The rows of ``wrapped``, with the columns that ``docs`` has."""
    return rows.select(*[F.col(f"one.`{c}`").alias(c) for c in docs.columns])


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column, and where each begins (one more: the end)."""
    column = pc.fill_null(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column, "")
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, starts, data = column.buffers()
    starts = np.frombuffer(starts, wide)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, wide)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data, starts.astype(np.int64)


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of rows with about ``limit`` bytes: first row, bytes, starts within them."""
    data, starts = text_buffer(column)
    row = 0
    while row < len(starts) - 1:
        end = max(row + 1, int(np.searchsorted(starts, starts[row] + limit, "right")) - 1)
        yield row, data[starts[row] : starts[end]], starts[row : end + 1] - starts[row]
        row = end


# Space and the bytes 9 to 13.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_PRIME = np.uint64(0x9E3779B97F4A7C15 | 3)
_BYTE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = 1 << max(10, int(n - 1).bit_length())
        _powers = np.concatenate([np.ones(1, np.uint64), np.full(size - 1, _PRIME)]).cumprod(dtype=np.uint64)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of a well-known public hash)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def spans(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``inside``; a bound always ends a run."""
    if not len(inside):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = bounds[(bounds > 0) & (bounds < len(inside))]
    cut = cut[inside[cut]]
    first[cut] = True
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[cut[inside[cut - 1]] - 1] = True
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = _BYTE) -> np.ndarray:
    """A 64-bit hash of each span of bytes; spans are in order and don't overlap.

    Bytes between spans must have the table value 0 or follow no span.
    """
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + CHUNK_BYTES)))
        s, e = starts[at:to], ends[at:to]
        begin, stop = int(s[0]), int(e[-1])
        place = np.arange(begin, stop) - np.repeat(s, np.diff(np.append(s, stop)))
        longest = int((e - s).max())
        weight = powers(longest)[np.minimum(place, longest - 1)]
        out[at:to] = np.add.reduceat(table[data[begin:stop]] * weight, s - begin)
        at = to
    return mix(out)


WORD = np.where(SPACE, np.uint64(0), _BYTE)
_WORD_LOWER = WORD[LOWER]


def words(data: np.ndarray, bounds: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+``: their starts, hashes, and the first word of each text."""
    starts, ends = spans(~SPACE[data], bounds)
    hashes = hash_spans(data, starts, ends, _WORD_LOWER if lower else WORD)
    return starts, hashes, np.searchsorted(starts, bounds)


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of every ``width`` consecutive words, whatever text they are in."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, width):
        out = out * _PRIME + hashes[k : k + n]
    return mix(out)


def shingle_set(hashes: np.ndarray, width: int) -> np.ndarray:
    """Distinct shingles of one text, sorted; fewer words than ``width`` are one shingle."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    size = min(width, len(hashes))
    return np.unique(shingles(hashes, size) + np.uint64(size))
