"""WARC archives with a two-level capture index.

Archives: each task writes the records of its rows, one gzip member a record, to
files of its own in the shared folder.  Of rows with equal payloads those with the
smallest page_id become `response` records, the others `revisit` records that refer
to it; rows without a page_id refer to it too, or are responses if there is none.

Index: captures sorted by (reversed-host URL key, page_id) over range partitions.
A partition writes its lines in gzip blocks of `LINES` to one file and a sparse
directory (each block's first key, offset and length) to another; the driver only
holds each partition's first and last key.  A lookup binary-searches partitions,
directory and block, with range reads of one directory and one block; captures are
then read from the archives with range reads of adjacent records.

Null payloads are empty; null URLs have the empty key; repeated rows have a record
each.  Files of a task attempt that fails are not referred to by anything.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.common import column, cut, map_batches, scratch, store

#: Captures per index block; bytes of an archive file and of one read of it, about.
LINES, FILE_BYTES, READ_BYTES = 300, 64 << 20, 4 << 20
CAPTURE = "key binary, page_id long, file string, offset long, length long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
NO_ID = -(1 << 63)


def url_key(url: str | None) -> bytes:
    """`com,example,www)/path?query`: host labels reversed and lower-cased; scheme,
    user, default ports and fragment dropped; white space and controls escaped."""
    rest = (url or "").split("#")[0].strip()
    scheme, sep, after = rest.partition("://")
    rest = after if sep else rest
    if not rest:
        return b""
    host, tail = re.match(r"([^/?]*)(.*)", rest, re.S).groups()
    host = re.sub(r":(80|443)$", "", host.rpartition("@")[2].lower().rstrip("."))
    name, colon, port = host.partition(":")
    key = f"{','.join(reversed(name.split('.')))}{colon}{port}){tail if tail.startswith('/') else '/' + tail}"
    return re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m[0][0], key.encode("utf-8", "surrogatepass"))


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {json.dumps(url)}", f"WARC-Payload-Digest: sha1:{digest}",
        *([] if refers_to is None else [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]),
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def parse(member: bytes) -> tuple:
    """A record's RECORD row; its payload's digest is checked."""
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    own, digest = fields["WARC-Record-ID"][len("<urn:page:") : -1], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind, refers = fields["WARC-Type"], fields.get("WARC-Refers-To")
    if kind == "response" and (len(payload) != size or digest32(payload) != digest):
        raise ValueError(f"record of page {own} is damaged")
    return None if own == "none" else int(own), json.loads(fields["WARC-Target-URI"]), size, digest, kind, int(refers[len("<urn:page:") : -1]) if refers else None, payload if kind == "response" else None


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write all rows of pages(page_id, url, html); returns the captures."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = store(folder)
        fs.create_dir(path, recursive=True)
        out, name, at = None, "", 0
        try:
            for b in batches:
                rows = []
                html = column(b, "html").cast(pa.binary()).to_pylist()
                for page, url, text, first in zip(column(b, "page_id").to_pylist(), column(b, "url").to_pylist(), html, column(b, "first").to_pylist()):
                    if out is None or at > FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"pages-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{path}/{name}", compression=None)
                    text = text or b""
                    member = record(page, url, text, digest32(text), first if first is not None and first != page else None)
                    out.write(member)
                    rows.append((url_key(url), page, name, at, len(member)))
                    at += len(member)
                yield captures(rows)
        finally:
            if out is not None:
                out.close()

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    again = rows.groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("sha", "first")
    return cut(map_batches(rows.join(again, "sha", "left").select("page_id", "url", "html", "first"), run, CAPTURE), "captures")


def captures(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.int64()))], names=["key", "page_id", "file", "offset", "length"])


@dataclass
class Index:
    """Where the parts of an index are: (first, last, block file, directory file) of
    each range partition with captures, in key order."""

    folder: str
    parts: list[tuple[tuple[bytes, int], tuple[bytes, int], str, str]]

    def find(self, requests: Iterator[tuple[bytes, int]]) -> Iterator[tuple]:
        """CAPTURE rows of requests (key, page_id); ascending requests read each
        directory and block once."""
        fs, path = store(self.folder)
        firsts = [p[0] for p in self.parts]
        opened: dict[str, list] = {}
        block: tuple = (None, None)
        for want in requests:
            i = max(0, bisect_left(firsts, want) - 1)
            while i < len(self.parts) and firsts[i] <= want:
                _, last, blocks, directory = self.parts[i]
                i += 1
                if last < want:
                    continue
                if directory not in opened:
                    with fs.open_input_file(f"{path}/{directory}") as f:
                        opened = {directory: [((base64.b64decode(k), p), o, n) for k, p, o, n in json.loads(gzip.decompress(f.read()))]}
                entries = opened[directory]
                j = max(0, bisect_left(entries, want, key=lambda e: e[0]) - 1)
                while j < len(entries) and entries[j][0] <= want:
                    if block[0] != (blocks, j):
                        with fs.open_input_file(f"{path}/{blocks}") as f:
                            block = ((blocks, j), _lines(f.read_at(entries[j][2], entries[j][1])))
                    lines = block[1]
                    for k in range(bisect_left(lines, want, key=lambda x: x[0]), bisect_right(lines, want, key=lambda x: x[0])):
                        (key, page), file, at, n = lines[k]
                        yield key, None if page == NO_ID else page, file, at, n
                    j += 1


def _lines(blob: bytes) -> list[tuple]:
    """A block's captures: `key page_id file offset length` a line."""
    rows = (line.split(b" ") for line in gzip.decompress(blob).split(b"\n")[:-1])
    return [((key, int(page)), file.decode(), int(at), int(n)) for key, page, file, at, n in rows]


def build_index(found: DataFrame, folder: str) -> Index:
    """Sort captures into compressed blocks and write their sparse directories."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = store(folder)
        fs.create_dir(path, recursive=True)
        name = f"{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        out, at, held, directory, last = None, 0, [], [], None

        def flush() -> int:
            blob = gzip.compress(b"".join(b"%s %d %s %d %d\n" % x for x in held), mtime=0)
            out.write(blob)
            directory.append((base64.b64encode(held[0][0]).decode(), held[0][1], at, len(blob)))
            held.clear()
            return at + len(blob)

        for b in batches:
            for key, page, file, offset, n in zip(*(column(b, c).to_pylist() for c in ("key", "page_id", "file", "offset", "length"))):
                out = out or fs.open_output_stream(f"{path}/cdx-{name}.gz", compression=None)
                last = (key, NO_ID if page is None else page)
                held.append((*last, file.encode(), offset, n))
                if len(held) == LINES:
                    at = flush()
        parts = []
        if out is not None:
            if held:
                at = flush()
            out.close()
            with fs.open_output_stream(f"{path}/dir-{name}.gz", compression=None) as f:
                f.write(gzip.compress(json.dumps(directory).encode(), mtime=0))
            parts = [(base64.b64decode(directory[0][0]), directory[0][1], *last, f"cdx-{name}.gz", f"dir-{name}.gz")]
        cols = list(zip(*parts)) if parts else [()] * 6
        kinds = (pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["key", "page", "last_key", "last_page", "blocks", "directory"])

    order = F.col("key"), F.coalesce("page_id", F.lit(NO_ID))
    parts = map_batches(found.repartitionByRange(*order).sortWithinPartitions(*order, "file", "offset"), run, "key binary, page long, last_key binary, last_page long, blocks string, directory string")
    rows = [((bytes(r.key), r.page), (bytes(r.last_key), r.last_page), r.blocks, r.directory) for r in parts.collect()]
    return Index(folder, sorted(rows))


def requests(pages: DataFrame) -> DataFrame:
    """Distinct (key, page_id) of the rows of pages(page_id, url)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([url_key(u) for u in column(b, "url").to_pylist()], pa.binary()), column(b, "page_id")], names=["key", "page_id"])

    picked = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    return map_batches(picked, run, "key binary, page_id long").distinct()


def lookup(wanted: DataFrame, index: Index) -> DataFrame:
    """The captures of wanted(key, page_id)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        keys = ((k, NO_ID if p is None else p) for b in batches for k, p in zip(column(b, "key").to_pylist(), column(b, "page_id").to_pylist()))
        for row in index.find(keys):
            rows.append(row)
            if len(rows) == 10_000:
                yield captures(rows)
                rows = []
        yield captures(rows)

    order = F.col("key"), F.coalesce("page_id", F.lit(NO_ID))
    return map_batches(wanted.repartitionByRange(*order).sortWithinPartitions(*order), run, CAPTURE)


def read_records(found: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The RECORD rows of captures, by range reads of runs of adjacent records."""
    names = [c.split()[0] for c in RECORD.split(", ")]
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())

    def out(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[int]]]:
        """(file, offset, lengths) of records that follow one another."""
        file, at, lengths, size = None, 0, [], 0
        for b in batches:
            for f, o, n in zip(*(column(b, c).to_pylist() for c in ("file", "offset", "length"))):
                if f != file or o != at + size or size > READ_BYTES:
                    if lengths:
                        yield file, at, lengths
                    file, at, lengths, size = f, o, [], 0
                lengths.append(n)
                size += n
        if lengths:
            yield file, at, lengths

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = store(folder)
        name, handle = None, None
        for file, at, lengths in runs(batches):
            if file != name:
                if handle is not None:
                    handle.close()
                name, handle = file, fs.open_input_file(f"{path}/{file}")
            blob, rows, i = handle.read_at(sum(lengths), at), [], 0
            for n in lengths:
                row = parse(blob[i : i + n])
                rows.append(row if payloads else (*row[:-1], None))
                i += n
            yield out(rows)
        if handle is not None:
            handle.close()

    # the rows are tiny but stand for the archives' bytes, so their number of tasks is fixed
    lanes = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_batches(found.select("file", "offset", "length").repartition(lanes, "file").sortWithinPartitions("file", "offset"), run, RECORD)


def archive(spark: SparkSession, pages: DataFrame) -> tuple[str, Index]:
    """Write pages as archives with an index, in fresh folders of the shared folder."""
    folder = scratch(spark, "warc")
    return f"{folder}/archive", build_index(write_archives(pages, f"{folder}/archive"), f"{folder}/index")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write every row, look every capture up by its URL key, and read it back."""
    folder, index = archive(pages.sparkSession, pages)
    found = lookup(requests(pages), index)
    return read_records(found, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h, min(page_id) over (partition by coalesce(html, '')) as first from pages)
select page_id, cast(strlen(html) as bigint) as payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(1 + ((cast('0x' || substr(h, cast(1 + 5 * (i // 4) as bigint), 5) as bigint) >> (15 - 5 * (i % 4))) & 31) as bigint), 1) for i in range(32)], '') as payload_digest,
  case when first is null or page_id is not distinct from first then 'response' else 'revisit' end as record_type,
  case when first is null or page_id is not distinct from first then null else first end as refers_to
from p
"""
