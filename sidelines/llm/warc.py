"""Web archives (WARC 1.1, one gzip member per record) with an index that is made while they are written.

The archives go to a folder that pyarrow can open on every executor (a shared mount, HDFS, an object store). A task
names its files by its attempt, and the index holds only what successful attempts wrote: it is the commit record, and
files of lost attempts are never read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sidelines.session import new_folder, written

INDEX = "archive string, offset long, length long, page_id long, url string, payload_digest string"
RECORDS = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "payload binary")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EOL = b"\r\n"


def roles(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, html, digest`` (hex SHA-1 of the payload) and ``refers_to``: the page whose payload this one repeats.

    Of equal payloads of at least ``min_bytes`` the one with the largest page_id is kept; a null page_id is smaller
    than any other, and if all are null, or several rows share the largest, each of these rows is kept.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", "html", F.sha1(payload).alias("digest"), F.octet_length(payload).alias("n"))
    last = (rows.filter(F.col("n") >= min_bytes).groupBy("digest", "n")
            .agg(F.max("page_id").alias("last"), F.count("*").alias("copies"))
            .filter("copies > 1 and last is not null").drop("copies"))
    last = written(last, "payloads")  # its size is then known: few are broadcast, many are shuffled
    repeats = F.col("page_id").isNull() | (F.col("page_id") < F.col("last"))
    return (rows.join(last, ["digest", "n"], "left")
            .select("page_id", "url", "html", "digest", F.when(repeats, F.col("last")).alias("refers_to")))


def _urn(page_id: int | None) -> bytes:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>".encode()


def _page_id(urn: bytes) -> int | None:
    found = urn[len("<urn:x-page:"):-1]
    return None if found == b"null" else int(found)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record: a response, or a revisit, which has the HTTP headers only."""
    http = (b"HTTP/1.1 200 OK" + EOL + b"Content-Type: text/html; charset=utf-8" + EOL
            + b"Content-Length: %d" % len(payload) + EOL + EOL)
    block = http + payload if refers_to is None else http
    kind = b"response" if refers_to is None else b"revisit"
    head = [b"WARC/1.1", b"WARC-Type: " + kind, b"WARC-Record-ID: " + _urn(page_id), b"WARC-Date: " + date.encode()]
    if url is not None:  # quoted, as not every character can stand in a header
        head.append(b"WARC-Target-URI: " + quote(url, safe=":/?#[]@!$&'()*+,;=~").encode())
    if refers_to is not None:
        head += [b"WARC-Profile: " + PROFILE.encode(), b"WARC-Refers-To: " + _urn(refers_to)]
    head += [b"WARC-Payload-Digest: sha1:" + digest.encode(), b"Content-Type: application/http; msgtype=response",
             b"Content-Length: %d" % len(block)]
    return EOL.join(head) + EOL + EOL + block + EOL + EOL


def _base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


class _Archives:
    """The archives of one task, a new one after so many bytes."""

    def __init__(self, folder: str, most_bytes: int):
        self.store, self.root = FileSystem.from_uri(folder)
        self.store.create_dir(self.root, recursive=True)
        task = TaskContext.get()
        self.stem = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        self.most_bytes, self.files, self.out, self.at = most_bytes, 0, None, 0

    def add(self, data: bytes) -> tuple[str, int, int]:
        if self.out is None or self.at >= self.most_bytes:
            self.close()
            self.name = f"{self.stem}-{self.files:04d}.warc.gz"
            # the members are compressed one by one
            self.out = self.store.open_output_stream(f"{self.root}/{self.name}", compression=None)
            self.at, self.files = 0, self.files + 1
        member = zlib.compressobj(4, zlib.DEFLATED, 31)
        packed = member.compress(data) + member.flush()
        self.out.write(packed)
        self.at += len(packed)
        return self.name, self.at - len(packed), len(packed)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
        self.out = None


def write_archives(rows: DataFrame, folder: str, date: str = "2000-01-01T00:00:00Z",
                   most_bytes: int = 1 << 30) -> DataFrame:
    """Write the rows of ``roles`` to archives in ``folder`` and return the index, itself a table in the shared folder."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives = _Archives(folder, most_bytes)
        try:
            for batch in batches:
                found = []
                for row in zip(*[batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to")]):
                    page_id, url, html, digest, refers_to = row
                    digest = _base32(digest)
                    data = record(page_id, url, (html or "").encode(), digest, refers_to, date)
                    found.append((*archives.add(data), page_id, url, digest))
                columns = list(zip(*found)) or [()] * 6
                types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
                names = ("archive", "offset", "length", "page_id", "url", "payload_digest")
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
        finally:
            archives.close()

    return written(rows.mapInArrow(write, INDEX), "warc-index")


def parse(data: bytes) -> tuple:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload of an unpacked record."""
    head, _, rest = data.partition(EOL + EOL)
    fields = dict(line.split(b": ", 1) for line in head.split(EOL)[1:])
    block = rest[: int(fields[b"Content-Length"])]
    http, _, payload = block.partition(EOL + EOL)
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields[b"WARC-Payload-Digest"].removeprefix(b"sha1:").decode()
    kind = fields[b"WARC-Type"].decode()
    if kind == "response" and (len(payload) != size
                               or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"damaged record {fields[b'WARC-Record-ID']!r}")
    url = fields.get(b"WARC-Target-URI")
    refers = fields.get(b"WARC-Refers-To")
    return (_page_id(fields[b"WARC-Record-ID"]), None if url is None else unquote(url.decode()), size, digest, kind,
            None if refers is None else _page_id(refers), payload if kind == "response" else None)


def _ranges(rows: Iterator[tuple[str, int, int]], max_gap: int, max_read: int):
    """Neighbouring (archive, offset, length), already in order, as one range each: archive, start, end, parts."""
    name = start = end = None
    parts: list[tuple[int, int]] = []
    for archive, offset, length in rows:
        if parts and archive == name and 0 <= offset - end <= max_gap and offset + length - start <= max_read:
            end = max(end, offset + length)
        else:
            if parts:
                yield name, start, end, parts
            name, start, end, parts = archive, offset, offset + length, []
        parts.append((offset, length))
    if parts:
        yield name, start, end, parts


def read_records(index: DataFrame, folder: str, payloads: bool = True, max_gap: int = 1 << 16,
                 max_read: int = 1 << 22, task_bytes: int = 1 << 25) -> DataFrame:
    """The records that the rows of ``index`` point to, read in few, large, sorted byte ranges; digests are checked.

    The index is dealt out by ranges of archive and offset, so that one archive's records may go to several tasks: one for
    about ``task_bytes`` of archives, as the rows of the index are too short to tell how much there is to read.
    """
    size = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = FileSystem.from_uri(folder)
        rows = (row for b in batches for row in zip(*[b.column(c).to_pylist() for c in ("archive", "offset", "length")]))
        file = opened = None
        for archive, start, end, parts in _ranges(rows, max_gap, max_read):
            if opened != archive:
                file, opened = store.open_input_file(f"{root}/{archive}"), archive
            data = file.read_at(end - start, start)
            found = [parse(zlib.decompress(data[o - start:o - start + n], 31)) for o, n in parts]
            if not payloads:
                found = [(*row[:-1], None) for row in found]
            types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
            names = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names)

    return (index.select("archive", "offset", "length").repartitionByRange(max(1, -(-size // task_bytes)), "archive", "offset")
            .sortWithinPartitions("archive", "offset").mapInArrow(read, RECORDS))


def archived(spark: SparkSession, pages: DataFrame, min_bytes: int = 0, payloads: bool = True) -> DataFrame:
    """``pages(page_id, url, html)`` written to archives in the shared folder and read back.

    A null html is an empty payload, a null url a record without a target; other columns are not archived. Repeated rows
    get a record each. No pages give no records.
    """
    folder = new_folder(spark, "warc")
    index = write_archives(roles(pages, min_bytes), folder)
    return read_records(index, folder, payloads)
