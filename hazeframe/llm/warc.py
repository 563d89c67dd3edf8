"""WARC archives that are read through their index.

Writing deals records to files, one member of gzip each, and returns the index: one
row per record with its file, offset and length, its URL and payload digest.
Reading takes any part of the index, sorts it by place, and merges ranges that are
near each other into one read of bounded size.

Equal payloads are stored once: the page with the largest id is the response, the
others are revisit records that refer to it and keep the HTTP head alone.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

# Bytes after which a task begins another file.
FILE_BYTES = 1 << 30
# Ranges whose gap is no larger are read at once, up to so many bytes.
GAP = 1 << 16
READ = 8 << 20
DATE = "1970-01-01T00:00:00Z"

_ID = "urn:x-page:"
_INDEX = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    + [("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
)
_INDEX_SQL = "page_id long, url string, payload_digest string, record_type string, refers_to long, file string, offset long, length long"
_READ = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    + [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
)
_READ_SQL = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<{_ID}{'' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    number = (name or "").strip("<>").removeprefix(_ID)
    return int(number) if number else None


def _line(text: str) -> str:
    """A header's value: line ends and other controls become percent signs and digits."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> tuple[bytes, str]:
    """One record as a member of gzip, and its payload's digest."""
    sha = digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _name(page_id)), ("WARC-Date", date)]
    head += [("WARC-Target-URI", _line(url))] if url is not None else []
    head += [("WARC-Payload-Digest", f"sha1:{sha}"), ("Content-Type", "application/http; msgtype=response")]
    if refers_to is not None:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", _name(refers_to))]
    head += [("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(text.encode() + block + b"\r\n\r\n") + pack.flush(), sha


def _head(data: bytes) -> tuple[dict[str, str], bytes]:
    lines, _, rest = data.partition(b"\r\n\r\n")
    fields = (x.partition(":") for x in lines.decode().split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in fields}, rest


def parse(member: bytes) -> tuple:
    """A record to a row of what reading returns; a damaged one raises."""
    head, rest = _head(zlib.decompress(member, 31))
    http, payload = _head(rest[: int(head["content-length"])])
    size, sha = int(http["content-length"]), head["warc-payload-digest"].removeprefix("sha1:")
    stored = head["warc-type"] == "response"
    if stored and (len(payload) != size or digest(payload) != sha):
        raise ValueError(f"record {head['warc-record-id']}: the payload does not match its digest")
    return (_page(head["warc-record-id"]), head.get("warc-target-uri"), head["warc-type"], _page(head.get("warc-refers-to")), size, sha, payload if stored else None)


def _writer(path: str, file_bytes: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = fs.FileSystem.from_uri(path)
        number, out, file, at = TaskContext.get().partitionId(), None, "", 0
        for batch in batches:
            rows = []
            for page_id, url, html, refers_to in zip(*(batch.column(c) for c in range(4)), strict=True):
                if out is None or at >= file_bytes:
                    if out is not None:
                        out.close()
                    name, at = f"part-{number:06d}-{uuid.uuid4().hex}.warc.gz", 0
                    file, out = f"{path}/{name}", store.open_output_stream(f"{place}/{name}", compression=None)
                key, link, refers = page_id.as_py(), url.as_py(), refers_to.as_py()
                member, sha = record(key, link, (html.as_py() or "").encode(), refers, date)
                out.write(member)
                rows.append((key, link, sha, "response" if refers is None else "revisit", refers, file, at, len(member)))
                at += len(member)
            yield _batch(rows, _INDEX)
        if out is not None:
            out.close()

    return run


def _batch(rows: Iterable[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def write_warc(
    pages: DataFrame,
    path: str,
    least_bytes: int = 0,
    file_bytes: int = FILE_BYTES,
    date: str = DATE,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Write a record per page to archives below ``path``, a URI all executors reach; returns the stored index.

    Of pages with equal payloads of at least ``least_bytes`` the one with the largest
    id is a response, the others are revisits of it; rows that share that id are
    responses all.  A null html is an empty payload.  A null URL gives a record
    without one.  Pages without an id are revisits where an equal page has one, else
    responses.  Other columns are not looked at; an empty table gives no file.

    Task attempts write files of their own; the index names those that count.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"))
    sha = F.unhex(F.sha1(html))
    long_ones = pages.where(F.octet_length(html) >= least_bytes).select(F.col(id_col).cast("long").alias("page_id"), sha.alias("sha"))
    groups = long_ones.groupBy("sha").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL")
    groups = common.store(groups.select("sha", "first"), "payloads")
    joined = rows.join(groups, F.unhex(F.sha1("html")) == groups["sha"], "left")
    # An equal digest under the least size has no group; ids decide who is a revisit.
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return common.store(joined.select("page_id", "url", "html", refers.alias("refers_to")).mapInArrow(_writer(path, file_bytes, date), _INDEX_SQL), "warc-index")


def merged(ranges: Iterable[tuple], gap: int = GAP, most: int = READ) -> Iterator[list[tuple]]:
    """Runs of (file, offset, length, ...), sorted by place, that one read serves."""
    held: list[tuple] = []
    for r in ranges:
        if held and (r[0] != held[0][0] or r[1] > held[-1][1] + held[-1][2] + gap or r[1] + r[2] > held[0][1] + most):
            yield held
            held = []
        held.append(r)
    if held:
        yield held


def _reader(payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        for batch in batches:
            places = zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True)
            for group in merged(places):
                if group[0][0] != name:
                    if source is not None:
                        source.close()
                    name = group[0][0]
                    store, place = fs.FileSystem.from_uri(name)
                    source = store.open_input_file(place)
                begin = group[0][1]
                data = source.read_at(max(o + n for _, o, n in group) - begin, begin)
                found = [parse(data[o - begin : o - begin + n]) for _, o, n in group]
                yield _batch(found if payloads else [(*r[:-1], None) for r in found], _READ)

    return run


def read_warc(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The indexed records: id, URL, type, ``refers_to``, size and digest of the payload, and the ``payload``.

    A revisit's payload is null here (it is that of the page it refers to); its size
    is the one its HTTP head states.  ``payloads=False`` leaves all of them out.
    """
    placed = index.select("file", "offset", "length").repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
    return placed.mapInArrow(_reader(payloads), _READ_SQL)


def archive(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write archives to the shared folder and read all records back."""
    path = common.folder(spark, "warc")
    store, place = fs.FileSystem.from_uri(path)
    store.create_dir(place)
    return read_warc(write_warc(pages, path), payloads=False).drop("payload")
