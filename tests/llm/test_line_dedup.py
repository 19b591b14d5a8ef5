import numpy as np
import pytest
from pyspark.sql import functions as F

from sidelines.llm import line_dedup
from sidelines.llm.cuckoo import CuckooFilter
from sidelines.llm.line_dedup import LineIndex

WHITE = " \t\n\x0b\x0c\r"


def key_of(line):
    key = "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))
    return key if len(key) >= 10 else None


def plain(rows, among=None):
    """(doc_id, n_lines, n_dropped, text) for each row, looking for lines in the documents ``among``."""
    first, holders = {}, {}
    for doc, text in rows if among is None else among:
        if doc is not None:
            for line in (text or "").split("\n"):
                key = key_of(line)
                if key:
                    holders.setdefault(key, set()).add(doc)
                    first[key] = min(doc, first.get(key, doc))
    found = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if doc is None or key_of(x) not in first or len(holders[key_of(x)]) < 2 or first[key_of(x)] == doc]
        kept = "\n".join(left) if text is not None else None
        found.append((doc, len(lines), len(lines) - len(left), kept))
    return sorted(found, key=str)


def result(index, docs):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in index.clean(docs).collect()), key=str)


ODD = [(4, "A common line\nB\n\n a COMMON line\x0b \nown line of four"), (2, "a common line\nshort one\n123456789"), (9, None), (7, ""),
       (None, "A common line\nown line of four"), (8, "A common line\n" * 3000), (8, "own line of eight\nOWN LINE of eight"),
       (6, "ééééééééÉÉ\nÉÉÉÉÉÉÉÉÉÉ\nline with\x1c\r\n"), (5, "ééééééééÉÉ\n \nline with\x1c"), (3, "\n\n\n"), (3, "\n\n\n"),
       (1, "x" * 200_000), (10, "y\n" + "X" * 200_000), (11, "ééééééééé\nééééééééé"), (12, "ééééééééé\nkeeps")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_documents_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    index = LineIndex(spark, str(tmp_path))
    index.insert(docs)
    expected = plain([tuple(r) for r in docs.collect()])
    assert result(index, docs) == expected and sum(r[2] for r in expected) > 0


def test_odd_rows_and_columns(spark, tmp_path):
    docs = spark.createDataFrame([(d, t, "v", 1) for d, t in ODD], "doc_id long, text string, keys string, `N_Lines` int")
    index = LineIndex(spark, str(tmp_path))
    index.insert(docs.repartition(3))
    assert result(index, docs.drop("N_Lines")) == plain(ODD)
    cleaned = index.clean(docs)
    assert cleaned.columns == ["doc_id", "text", "keys", "N_Lines", "n_dropped"]


def test_batches_and_deletions_equal_a_new_index(spark, tmp_path):
    """Insert in parts, take some out and put them back: always as if the present documents had come at once."""
    random = np.random.default_rng(4)
    lines = [f"line number {i}" for i in range(25)]
    rows = [(i, "\n".join(random.choice(lines, random.integers(0, 6)))) for i in range(60)]
    index = LineIndex(spark, str(tmp_path))
    present = []

    def agree():
        opened = LineIndex.open(spark, str(tmp_path))
        assert result(opened, frame(spark, present)) == plain(present)
        refs = {(r["n_docs"], r["first_doc"]) for r in opened.refs().collect()}
        holders = {}
        for doc, text in present:
            for line in text.split("\n"):
                if key_of(line):
                    holders.setdefault(key_of(line), set()).add(doc)
        assert refs == {(len(h), min(h)) for h in holders.values()}
        held = opened.maybe_held(opened.refs()).count()
        assert held == len(holders)  # a filter never misses what is held

    for part in (rows[:20], rows[20:45]):
        index.insert(frame(spark, part))
        present += part
    agree()
    gone = {r[0] for r in rows[5:30]}
    index.delete(spark.createDataFrame([(g,) for g in gone] + [(999,), (None,)], "doc_id long"))
    present = [r for r in present if r[0] not in gone]
    agree()
    index.insert(frame(spark, rows[:10]))  # some are there already and are passed over
    present += [r for r in rows[5:10]]
    agree()
    index.delete(spark.createDataFrame([(r[0],) for r in rows], "doc_id long"))
    assert index.refs().count() == 0 and index.postings().count() == 0
    touched = [bytes(r["slots"]) for r in index._filters().collect()]
    assert not any(any(t) for t in touched)


def test_a_small_delivery_before_a_large_one(spark, tmp_path, monkeypatch):
    """Shards multiply with the keys, and everything is as if it had come at once."""
    monkeypatch.setattr(line_dedup, "KEYS_PER_SHARD", 20)
    random = np.random.default_rng(8)
    rows = [(i, "\n".join(f"line number {n}" for n in random.integers(0, 9000, 8))) for i in range(1, 1500)]
    index = LineIndex(spark, str(tmp_path))
    index.insert(frame(spark, rows[:1]))
    assert index.shards == 64
    for part in (rows[1:900], rows[900:]):
        index = LineIndex.open(spark, str(tmp_path))
        index.insert(frame(spark, part))
    index = LineIndex.open(spark, str(tmp_path))
    keys = index.refs().count()
    assert index.keys == keys == len({key for _, t in rows for key in t.split("\n")}) and index.shards * 20 >= keys
    sizes = [r["n"] for r in index.refs().groupBy(index._shard()).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 60
    assert index.maybe_held(index.refs()).count() == keys and result(index, frame(spark, rows)) == plain(rows)
    index.delete(spark.createDataFrame([(r[0],) for r in rows], "doc_id long"))
    assert index.keys == 0 and not any(any(bytes(r["slots"])) for r in index._filters().collect())


def test_a_batch_that_broke_off_leaves_no_trace(spark, tmp_path, monkeypatch):
    docs = frame(spark, [(1, "the same line"), (2, "the same line")])
    index = LineIndex(spark, str(tmp_path))
    index.insert(docs.filter("doc_id = 2"))
    monkeypatch.setattr(LineIndex, "_update_filters", lambda *a, **b: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        index.insert(docs)
    monkeypatch.undo()
    index = LineIndex.open(spark, str(tmp_path))
    assert index.postings().count() == 1
    index.insert(docs)
    assert result(index, docs) == plain([(1, "the same line"), (2, "the same line")])


def test_empty_tables(spark, tmp_path):
    docs = frame(spark, [])
    index = LineIndex(spark, str(tmp_path))
    index.insert(docs)
    index.delete(docs.select("doc_id"))
    assert result(index, docs) == []
    index.insert(frame(spark, ODD))
    assert result(index, frame(spark, ODD)) == plain(ODD)


def keys(random, n):
    return tuple(random.integers(-(1 << 63), 1 << 63, n, dtype=np.int64) for _ in range(2))


@pytest.mark.parametrize("n", [1, 7, 63, 4_000, 60_000])
def test_cuckoo_filter(n):
    random = np.random.default_rng(n)
    k1, k2 = keys(random, n)
    held = CuckooFilter()
    assert not held.contains(k1, k2).any()
    for part in np.array_split(np.arange(n), 3):
        held.insert(k1[part], k2[part])
    held = CuckooFilter.from_bytes(held.to_bytes())
    assert held.contains(k1, k2).all()
    assert sum(np.count_nonzero(t) for t in held.layers) == n
    other = keys(random, 20_000)
    assert held.contains(*other).mean() < 0.01
    gone = random.permutation(n)[: n // 2]
    held.delete(k1[gone], k2[gone])
    left = np.setdiff1d(np.arange(n), gone)
    assert held.contains(k1[left], k2[left]).all()
    assert sum(np.count_nonzero(t) for t in held.layers) == len(left)
    if len(gone) >= 50:
        assert held.contains(k1[gone], k2[gone]).mean() < 0.02
    held.delete(k1[left], k2[left])
    assert not any(t.any() for t in held.layers)
    with pytest.raises(ValueError):
        held.delete(k1[:1], k2[:1])


def test_a_key_held_many_times():
    k1, k2 = np.full(50, 5, np.int64), np.full(50, 9, np.int64)
    held = CuckooFilter()
    held.insert(k1, k2)
    held.delete(k1[:49], k2[:49])
    assert held.contains(k1[:1], k2[:1]).all()


def test_short_keys():
    assert line_dedup.line_key(" 123456789 ", 10) is None and line_dedup.line_key("1234567890", 10)
    assert line_dedup.line_key("é" * 9, 10) is None and line_dedup.line_key("é" * 10, 10)
