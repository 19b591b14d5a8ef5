import base64
import gzip
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sidelines.llm import warc

SCHEMA = "page_id long, url string, html string, digest string"
ROWS = [(1, "http://a/", "<p>same</p>", "x"), (5, "http://b/?q=1#é\r\nX: y", "<p>same</p>", None), (3, None, "<p>same</p>", ""),
        (7, "u%41", None, "x"), (2, "", "", "x"), (4, "http://c/", "é" * 70_000, "x"), (4, "http://c/", "é" * 70_000, "x"),
        (6, "d", "\r\n\r\nContent-Length: 5\r\n", "x"), (None, "n", "null id", "x"), (None, "n", "null id", "x"),
        (None, "m", "<p>same</p>", "x"), (-9, "neg", "-", "x"), (8, "http://null/", None, "x")]


def plain(rows, min_bytes=0):
    data = [(p, (h or "").encode()) for p, _, h, *_ in rows]
    found = []
    for page, payload in data:
        ids = [p for p, other in data if other == payload and p is not None]
        last = max(ids) if ids and len(payload) >= min_bytes else None
        repeats = last is not None and (page is None or page < last)
        found.append((page, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                      "revisit" if repeats else "response", last if repeats else None))
    return sorted(found, key=str)


@pytest.mark.parametrize("min_bytes", [0, 1, 12])
def test_what_is_read_back(spark, min_bytes):
    pages = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    records = warc.archived(spark, pages, min_bytes).collect()
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[n] for n in names) for r in records), key=str) == plain(ROWS, min_bytes)
    urls = sorted((str(r["page_id"]), str(r["url"])) for r in records)
    assert urls == sorted((str(p), str(u)) for p, u, *_ in ROWS)
    payloads = {(r["page_id"], bytes(r["payload"])) for r in records if r["payload"] is not None}
    assert payloads <= {(p, (h or "").encode()) for p, _, h, _ in ROWS}


def test_archives_are_plain_gzip_and_the_index_points_into_them(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, SCHEMA).coalesce(1)
    index = warc.write_archives(warc.roles(pages), f"file://{tmp_path}", most_bytes=2000)
    rows = index.collect()
    files = sorted(p.name for p in tmp_path.iterdir())
    assert len(files) > 1 and {r["archive"] for r in rows} == set(files)
    for name in files:
        own = sorted((r["offset"], r["length"]) for r in rows if r["archive"] == name)
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
        assert gzip.decompress((tmp_path / name).read_bytes()).count(b"WARC/1.1\r\n") == len(own)
    some = index.filter("page_id in (1, 4)")
    assert sorted(r["page_id"] for r in warc.read_records(some, str(tmp_path)).collect()) == [1, 4, 4]


def test_reading_tasks_follow_the_bytes(spark, tmp_path):
    random = np.random.default_rng(3)
    rows = [(i, f"http://{i}/", random.bytes(2000).hex(), "x") for i in range(200)]
    pages = spark.createDataFrame(rows, SCHEMA).coalesce(2)
    index = warc.write_archives(warc.roles(pages), f"file://{tmp_path}")
    size = index.agg({"length": "sum"}).first()[0]
    for task_bytes in (1 << 25, 100_000, 10_000):
        records = warc.read_records(index, str(tmp_path), task_bytes=task_bytes)
        parts = [r["n"] for r in records.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n")).collect()]
        assert sum(parts) == 200 and len(parts) >= 0.6 * size / task_bytes and max(parts) <= max(400 * task_bytes / size, 5)


def test_a_damaged_payload_is_noticed():
    data = warc.record(1, "u", b"payload", base64.b32encode(hashlib.sha1(b"payload").digest()).decode(), None, "2000-01-01T00:00:00Z")
    assert warc.parse(data)[0] == 1
    with pytest.raises(ValueError):
        warc.parse(data.replace(b"payload\r", b"pay1oad\r"))


def test_ranges_are_joined_up_to_the_limits():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 25, 5), ("a", 100, 10), ("b", 0, 3), ("b", 3, 50)]
    found = list(warc._ranges(iter(rows), max_gap=5, max_read=40))
    assert [(n, s, e, len(p)) for n, s, e, p in found] == [("a", 0, 30, 3), ("a", 100, 110, 1), ("b", 0, 3, 1), ("b", 3, 53, 1)]


def test_no_pages(spark):
    assert warc.archived(spark, spark.createDataFrame([], SCHEMA)).count() == 0
