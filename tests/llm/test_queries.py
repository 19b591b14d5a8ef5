"""Each registered query over whole tables: against DuckDB where SQL can express it, and the pipeline stage by stage."""

import duckdb
import public_tokenizers
import pytest

import corpus_pipeline
from sidelines.llm import packing, quality_rules, registry
from tests.llm.test_line_dedup import plain as plain_lines
from tests.llm.test_packing import check as check_pieces
from tests.llm.test_packing import expected as expected_ids
from tests.llm.test_pii import base as plain_base
from tests.llm.test_quality_rules import plain as plain_measures
from tests.llm.test_simhash import plain_components

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_duckdb(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    df = QUERIES[name](spark, SF_DIR)
    result = connection.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert ordered(map(tuple, df.select(*names).collect())) == ordered(result.fetchall())


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()


def test_a_query_for_each_operator():
    assert sorted(int(n.removeprefix("op").split("_")[0]) for n in QUERIES) == list(range(1, len(QUERIES) + 1))


def test_op1(spark, documents):
    import hashlib

    found = QUERIES["op1_line_dedup"](spark, SF_DIR).collect()
    expected = [(d, n, gone, hashlib.sha256((t or "").encode()).hexdigest()) for d, n, gone, t
                in plain_lines([(r["doc_id"], r["text"]) for r in documents])]
    assert ordered(tuple(r) for r in found) == ordered(expected)


def test_op4(spark, documents):
    found = QUERIES["op4_simhash"](spark, SF_DIR).collect()
    assert ordered(tuple(r) for r in found) == ordered(plain_components([(r["doc_id"], r["text"]) for r in documents]))


def test_op10(spark, documents):
    found = {r["doc_id"]: r for r in QUERIES["op10_pii"](spark, SF_DIR).collect()}
    assert {d: r["base_sha256"] for d, r in found.items()} == {r["doc_id"]: plain_base(r["text"]) for r in documents}


def test_the_pipeline_stage_by_stage(spark, documents):
    """Each stage against brute force on what the one before kept; the sequences hold just the documents that are left."""
    columns = documents[0].__fields__
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = [r.asDict() for r in documents]

    def after(stage):
        nonlocal docs
        docs = spark.createDataFrame(corpus_pipeline.STAGES[stage][1](spark, docs, SF_DIR).collect(), docs.schema)
        rows = [r.asDict() for r in docs.collect()]
        assert docs.columns == list(columns)
        return rows

    good = {r["doc_id"] for r in quality_rules.judged(docs).filter("kept").collect()}
    failed = {r["doc_id"] for r in kept if (m := plain_measures(r["text"]))[0] < 10 or 100 * m[5] > 20 * m[0]}
    rows = after(0)
    assert {r["doc_id"] for r in rows} == good and not good & failed and len(good) > 0.7 * len(kept)
    assert all(r in kept for r in rows)

    expected = {d: t for d, _, _, t in plain_lines([(r["doc_id"], r["text"]) for r in rows])}
    rows = after(1)
    assert {r["doc_id"]: r["text"] for r in rows} == expected and all(r["n_chars"] == len(r["text"]) for r in rows)

    expected = {c for _, _, c in plain_components([(r["doc_id"], r["text"]) for r in rows])}
    before = rows
    rows = after(2)
    assert {r["doc_id"] for r in rows} == expected and len(rows) == len(expected) and all(r in before for r in rows)

    items = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    leaks = {r["doc_id"] for r in rows if any(i in r["text"] for i in items)}
    before = rows
    rows = after(3)
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in before} - leaks and all(r in before for r in rows)

    tokenizer = packing.read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    ids = {r["doc_id"]: expected_ids(tokenizer, r["text"]) for r in rows}
    check_pieces(corpus_pipeline.STAGES[4][1](spark, docs, SF_DIR).collect(), ids)
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, SF_DIR).select("doc_id").collect()} == set(ids)


def test_the_pipeline_on_odd_rows(spark, tmp_path):
    """Nulls, empty texts, repeated rows, extra columns with the operators' names, and no rows at all."""
    text = " ".join(f"word{i}" for i in range(30))
    rows = [(1, text, "s", 5, "x", 1), (1, text, "s", 5, "x", 1), (2, None, None, None, None, None), (3, "", "s", 0, "x", 2),
            (None, text + " more of it", None, 1, "y", 3), (4, text.upper(), "t", 9, "z", 4), (5, "w " * 50_000, "s", 1, "x", 1)]
    schema = "doc_id long, text string, source string, n_chars int, kept string, matches int"
    spark.read.parquet(f"{SF_DIR}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == ["doc_id", "text", "source", "n_chars", "kept", "matches"], name
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
        assert {p["doc_id"] for p in pieces} == ({1, 4, None} if n else set())  # 4 has lost its line, but stays
