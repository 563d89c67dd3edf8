"""Token ids as Arrow files of equal-length sequences.

The ids of all texts, in id order, are one long stream.  It is cut into shards (one
file per task) and each shard into sequences of ``length`` ids, stored as
fixed-size lists in record batches of equal size, uncompressed.  Sequence ``k`` is
row ``k % rows`` of batch ``k // rows``, so any of them is read without decoding
what stands before it, and without a copy when the file is mapped.  A second column
masks the padding at the end of a shard.

The index tells where each text begins.  Task attempts write under names of their
own and the index names the files that count, so a lost executor leaves at most a
file that nobody reads.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

LENGTH = 2048
ROWS = 128
# Bytes that the known words and their ids may take in a worker; beyond that it begins anew.
KNOWN_BYTES = 64 << 20
# Bytes of text whose words are looked up together.
GROUPED = 1 << 21
# Letters that may be proven to stand apart from a stop behind them.
LETTERS = "".join(chr(c) for c in range(256) if chr(c).isalpha())
# New words that are encoded as one text.
TOGETHER = 500

_INDEX = pa.schema([("doc_id", pa.int64()), ("shard", pa.int32()), ("offset", pa.int64()), ("n_tokens", pa.int64()), ("file", pa.string())])
_INDEX_SQL = "doc_id long, shard int, offset long, n_tokens long, file string"
_READ_SQL = "doc_id long, start long, n_tokens long, ids_crc32 long"


class Encoder:
    """Texts to ids as little-endian bytes.

    Where a tokenizer never joins what white space parts, each word is encoded once
    and looked up later; ``by_word`` says so (default: tried out).
    Words of some letters are then encoded many at a time, without the full stop or
    comma behind them (and those of ASCII without case), if its vocabulary marks the
    ends of words.  Only letters of ``LETTERS`` whose every trial gives the same ids
    either way are taken so: others may change into a mark that joins what follows.
    """

    def __init__(self, spec: str, by_word: bool | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.width = id_type(self.tokenizer.get_vocab_size())
        probes = ["a b", "ab  cd", " x", "x\ny ", "\n\n", "a\tb\x0bc\x0cd\r\ne", "Ab, c's 12 3."]
        self.by_word = all(self._plain([p])[0] == b"".join(self._plain(p.split())) for p in probes) if by_word is None else by_word
        suffix = json.loads(spec)["model"].get("end_of_word_suffix")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for w, i in vocabulary.items() if suffix and w.endswith(suffix)]] = True
        self.tails = dict(zip(("", ".", ","), (b"", *self._plain([".", ","])), strict=True))
        apart = "".join(self._apart()) if suffix else ""
        self.core = re.compile(f"[{apart}]+" if apart else "(?!)")
        self._forget()

    def _apart(self) -> list[str]:
        """Letters that stand apart from a stop behind them, alone and in a word, in either case."""
        same = lambda a, b: a == b[0] + b[1]
        found = []
        for c in LETTERS:
            words = [c, f"a{c}", f"{c}a{c}"]
            lowered = self._plain([w.lower() if w.isascii() else w for w in words])
            if all(same(w, (low, self.tails[t])) for t in self.tails for w, low in zip(self._plain([w + t for w in words]), lowered, strict=True)):
                found.append(c)
        return found

    def _forget(self) -> None:
        """Words known so far: their hashes in order, and for each where its ids stand."""
        self.known = np.empty(0, np.uint64)
        self.begin = np.empty(0, np.int64)
        self.size = np.empty(0, np.int64)
        self.flat = np.empty(1 << 16, self.width)
        self.used = 0

    def _plain(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.width).tobytes() for x in found]

    def _together(self, cores: list[str]) -> list[bytes]:
        """Words of letters, encoded as one text that is parted at the ends of words."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(cores)], add_special_tokens=False)[0].ids, self.width)
        last = np.flatnonzero(self.ends[ids]) + 1
        if len(last) != len(cores):
            return self._plain(cores)
        data, size = ids.tobytes(), self.width.itemsize
        bounds = [0, *(last * size).tolist()]
        return [data[i:j] for i, j in zip(bounds, bounds[1:], strict=False)]

    def _at(self, hashes: np.ndarray) -> np.ndarray:
        """Where known words stand in the list; -1 for others."""
        if not len(self.known):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, at, -1)

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        """Ids of new words, and of the words of letters that are in them."""
        parts, plain = {}, {}
        for h, w in zip(hashes.tolist(), words, strict=True):
            text = w.decode()
            tail = text[-1] if text[-1] in ".," else ""
            core = text[: len(text) - len(tail)]
            if self.core.fullmatch(core):
                parts[h] = (core.lower() if core.isascii() else core).encode(), tail
            else:
                plain[h] = text
        learnt = dict(zip(plain, self._plain(list(plain.values())), strict=True))
        cores = list({core for core, _ in parts.values()})
        ids = {}
        if cores:
            ends = np.cumsum([len(c) for c in cores])
            of_cores = common.hash_spans(np.frombuffer(b"".join(cores), np.uint8), ends - [len(c) for c in cores], ends, common.WORD)
            at = self._at(of_cores)
            new = [cores[k] for k in np.flatnonzero(at < 0).tolist()]
            for k in range(0, len(new), TOGETHER):
                some = new[k : k + TOGETHER]
                ids.update(zip(some, self._together([c.decode() for c in some]), strict=True))
            learnt.update((h, ids[c]) for h, c, k in zip(of_cores.tolist(), cores, at.tolist(), strict=True) if k < 0)
            ids.update((c, self.flat[self.begin[k] : self.begin[k] + self.size[k]].tobytes()) for c, k in zip(cores, at.tolist(), strict=True) if k >= 0)
        learnt.update((h, ids[core] + self.tails[tail]) for h, (core, tail) in parts.items())

        found = np.frombuffer(b"".join(learnt.values()), self.width)
        sizes = np.array([len(f) for f in learnt.values()], np.int64) // self.width.itemsize
        self.flat = _room(self.flat, self.used + len(found))
        self.flat[self.used : self.used + len(found)] = found
        # Words of letters may be known already, with the same ids.
        added = np.concatenate([self.known, np.fromiter(learnt, np.uint64, len(learnt))])
        begin = np.concatenate([self.begin, self.used + np.cumsum(sizes) - sizes])
        self.known, kept = np.unique(added, return_index=True)
        self.begin, self.size = begin[kept], np.concatenate([self.size, sizes])[kept]
        self.used += len(found)

    def encode_buffer(self, data: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """Ids of the texts in a buffer.  Words are told apart by 64-bit hashes."""
        if not self.by_word:
            return self._plain([data[i:j].tobytes().decode() for i, j in zip(bounds, bounds[1:], strict=False)])
        if KNOWN_BYTES < 24 * len(self.known) + self.flat.nbytes:
            self._forget()
        starts, ends = common.spans(~common.SPACE[data], bounds)
        if not len(starts):
            return [b""] * (len(bounds) - 1)
        hashes, one, group = np.unique(common.hash_spans(data, starts, ends, common.WORD), return_index=True, return_inverse=True)
        new = np.flatnonzero(self._at(hashes) < 0)
        if len(new):
            whole = data.tobytes()
            self._learn(hashes[new], [whole[i:j] for i, j in zip(starts[one[new]].tolist(), ends[one[new]].tolist(), strict=True)])
        numbers = self._at(hashes)[group]
        sizes = self.size[numbers]
        stops = np.cumsum(sizes)
        ids = self.flat[np.repeat(self.begin[numbers] - stops + sizes, sizes) + np.arange(stops[-1])]
        cuts = np.append(0, stops)[np.searchsorted(starts, bounds)].tolist()
        return [ids[i:j].tobytes() for i, j in zip(cuts, cuts[1:], strict=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.encode_buffer(*common.text_buffer(pa.array(texts, pa.string())))


def _room(array: np.ndarray, size: int) -> np.ndarray:
    """The array with room for ``size`` entries."""
    return array if size <= len(array) else np.concatenate([array, np.empty(max(size, 2 * len(array)) - len(array), array.dtype)])


# A worker process keeps its encoder from task to task.
_encoders: dict[str, Encoder] = {}


def encoder_of(spec: str) -> Encoder:
    if spec not in _encoders:
        _encoders.clear()
        _encoders[spec] = Encoder(spec)
    return _encoders[spec]


def id_type(vocabulary: int) -> np.dtype:
    """The least little-endian type that holds all ids."""
    return np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")


class _Shard:
    """A file under way: takes ids, writes full batches."""

    def __init__(self, path: str, width: np.dtype, length: int, rows: int):
        store, place = fs.FileSystem.from_uri(path)
        self.length, self.room, self.width = length, length * rows, width
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(width), length)), ("mask", pa.list_(pa.bool_(), length))])
        self.out = store.open_output_stream(place)
        self.file = pa.ipc.new_file(self.out, self.schema)
        self.waiting: list[bytes] = []
        self.held = 0
        self.total = 0

    def add(self, ids: bytes) -> None:
        self.waiting.append(ids)
        self.held += len(ids)
        self.total += len(ids) // self.width.itemsize
        size = self.room * self.width.itemsize
        if self.held >= size:
            joined = b"".join(self.waiting)
            whole = len(joined) // size * size
            for at in range(0, whole, size):
                self._write(np.frombuffer(joined, self.width, self.room, at))
            self.waiting, self.held = [joined[whole:]], len(joined) - whole

    def _write(self, ids: np.ndarray) -> None:
        padded = -(-len(ids) // self.length) * self.length
        mask = np.arange(padded) < len(ids)
        columns = [np.pad(ids, (0, padded - len(ids))), mask]
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(c), self.length) for c in columns]
        self.file.write_batch(pa.record_batch(lists, schema=self.schema))

    def close(self) -> None:
        if self.held:
            self._write(np.frombuffer(b"".join(self.waiting), self.width))
        self.file.close()
        self.out.close()


def _writer(spec: str, end_id: int, path: str, length: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(spec)
        width = id_type(max(encoder.tokenizer.get_vocab_size(), end_id + 1))
        end = np.array([end_id], width).tobytes()
        number = TaskContext.get().partitionId()
        file = f"{path}/shard-{number:06d}-{uuid.uuid4().hex}.arrow"
        shard = None
        for batch in batches:
            for row, data, bounds in common.chunks(batch.column(1), GROUPED):
                shard = shard or _Shard(file, width, length, rows)
                n = len(bounds) - 1
                offsets, counts = [], []
                for ids in encoder.encode_buffer(data, bounds):
                    if width != encoder.width:
                        ids = np.frombuffer(ids, encoder.width).astype(width).tobytes()
                    offsets.append(shard.total)
                    shard.add(ids + end)
                    counts.append(shard.total - offsets[-1])
                columns = [batch.column(0).slice(row, n), [number] * n, offsets, counts, [file] * n]
                yield pa.record_batch([pa.array(c, f.type) if isinstance(c, list) else c for c, f in zip(columns, _INDEX, strict=True)], schema=_INDEX)
        if shard:
            shard.close()

    return run


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    length: int = LENGTH,
    rows: int = ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write the texts' ids to Arrow files below ``path``, a URI all executors reach; returns the index.

    The whole of each text is encoded, ``end_id`` is appended.  Texts stand in id
    order (null ids first, rows of one id by their texts).  A null or empty text is
    the end id alone.  An empty table gives no file and an empty index.  Other
    columns are not looked at.  ``tokenizer`` is the path of a file of the
    tokenizers library; the driver reads it and its text goes to the tasks.

    Index: ``doc_id``, ``file``, ``shard``, ``offset`` (in the shard), ``n_tokens``
    (with the end id), ``start`` (ids of all texts before it).
    """
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    rows_in = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    order = ["doc_id", F.xxhash64("text"), "text"]
    ranged = rows_in.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    index = common.store(ranged.mapInArrow(_writer(spec, end_id, path, length, rows), _INDEX_SQL), "token-index")
    # One row per shard, as many as there were tasks.
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    return index.join(F.broadcast(bases), "shard").select("doc_id", "file", "shard", "offset", "n_tokens", (F.col("base") + F.col("offset")).alias("start"))


class Reader:
    """Random access to one file: any run of ids, from the batches that hold it."""

    def __init__(self, path: str, rows: int = ROWS):
        store, place = fs.FileSystem.from_uri(path)
        self.source = pa.memory_map(place) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(place)
        self.file = pa.ipc.open_file(self.source)
        self.length = self.file.schema.field("ids").type.list_size
        self.room = self.length * rows
        self.number, self.batch = -1, None

    def _batch(self, number: int) -> pa.RecordBatch:
        if number != self.number:
            self.number, self.batch = number, self.file.get_batch(number)
        return self.batch

    def ids(self, offset: int, n: int) -> Iterator[np.ndarray]:
        """The ids from ``offset`` on, a view per batch."""
        while n > 0:
            held = self._batch(offset // self.room).column("ids").flatten().to_numpy(zero_copy_only=True)
            part = held[offset % self.room :][:n]
            if not len(part):
                raise ValueError(f"the file ends before id {offset}")
            yield part
            offset, n = offset + len(part), n - len(part)

    def sequence(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Sequence ``k`` and its mask."""
        rows = self.room // self.length
        batch = self._batch(k // rows)
        return tuple(batch.column(c)[k % rows].values.to_numpy(zero_copy_only=False) for c in ("ids", "mask"))

    def close(self) -> None:
        self.source.close()


def _reader(rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, reader = None, None
        for batch in batches:
            sums, counts = [], []
            for file, offset, n in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "n_tokens")), strict=True):
                if file != path:
                    path, reader = file, Reader(file, rows)
                crc = read = 0
                for part in reader.ids(offset, n):
                    crc, read = zlib.crc32(part.astype("<u4"), crc), read + len(part)
                sums.append(crc)
                counts.append(read)
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("start"), pa.array(counts, pa.int64()), pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return run


def read_tokens(index: DataFrame, rows: int = ROWS) -> DataFrame:
    """Read the ids of the indexed texts from the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    Any part of an index will do; reads are dealt out by place in the files.
    """
    placed = index.select("doc_id", "file", "shard", "offset", "n_tokens", "start")
    placed = placed.repartitionByRange("shard", "offset").sortWithinPartitions("shard", "offset")
    return placed.mapInArrow(_reader(rows), _READ_SQL)


def token_digests(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write token files to the shared folder, read them back: a row per document."""
    path = common.folder(spark, "tokens")
    store, place = fs.FileSystem.from_uri(path)
    store.create_dir(place)
    return read_tokens(write_tokens(docs, path, tokenizer, end_id))
