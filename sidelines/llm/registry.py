"""The queries over texts and pages by name, ``name -> (spark, sf_dir) -> DataFrame``, and the same in DuckDB's SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sidelines.llm import (chat, decontamination, embedding_dedup, line_dedup, packing, pii, prefix_trie, quality_rules,
                           simhash, token_counts, url_filters, warc, whitening)
from sidelines.llm.sql import ORACLES
from sidelines.session import new_folder

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

# The lists that the queries use; hosts without a rule are allowed.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow")]


def query(build: Query) -> Query:
    _QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_line_dedup(spark, sf_dir):
    """Two deliveries, the second one looked up in the filters of the first."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = line_dedup.LineIndex(spark, new_folder(spark, "lines"))
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    for delivery in range(2):
        index.insert(documents.filter(half == delivery))
    kept = index.clean(documents)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query
def op2_packing(spark, sf_dir):
    tokenizer = packing.read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer)


@query
def op3_url_filters(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, url_filters.RULES_SCHEMA)
    return url_filters.judge(table(spark, sf_dir, "pages"), rules).drop("url")


@query
def op4_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_token_counts(spark, sf_dir):
    vocabulary = token_counts.vocabulary_of(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), **vocabulary).drop("text")


@query
def op6_warc(spark, sf_dir):
    records = warc.archived(spark, table(spark, sf_dir, "pages"), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op7_quality_rules(spark, sf_dir):
    rows = quality_rules.judged(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), keep_text=False)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op8_chat_formatting(spark, sf_dir):
    return chat.formatted(table(spark, sf_dir, "conversations"))


@query
def op9_decontamination(spark, sf_dir):
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op10_pii(spark, sf_dir):
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    counts = [F.size(kind).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.listed(*pii.KINDS), 256).alias("base_sha256"),
                        pii.listed(*pii.KINDS, *pii.TERM_KINDS).alias("spans"))


@query
def op11_whitening(spark, sf_dir):
    """A deviation that a long can't hold is null; the operator's own column is a decimal."""
    found = whitening.whitened(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


@query
def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query
def op13_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
