"""A corpus from raw documents to packed sequences: each stage is one of the operators, over what the last one kept.

Every stage but the last returns documents with the columns that it got. Rows and columns that an operator does not look
at stay as they are; null and empty texts, null ids, repeated rows and empty tables are treated as each operator states.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sidelines.llm import decontamination, line_dedup, packing, quality_rules, simhash
from sidelines.llm.common import beside_row, row_with
from sidelines.session import new_folder, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule, or whose host is rejected, go."""
    return quality_rules.good_documents(docs)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a smaller doc_id holds too are taken out; ``n_chars``, where there is one, follows the text. A document
    that loses all of its lines stays, with an empty text."""
    rows = beside_row(docs, doc_id=F.col("doc_id"), text=F.col("text"))
    index = line_dedup.LineIndex(spark, new_folder(spark, "lines"))
    index.insert(rows)
    text = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        text["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return row_with(index.clean(rows), docs.columns, **text)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints are linked, that of the smallest doc_id stays."""
    return simhash.one_of_each(docs, shingle=3, radius=2)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as sequences of 2048 tokens. The workers have other stages' memory to bear, so they keep fewer words."""
    tokenizer = packing.read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(docs, tokenizer, most_words=50_000)


STAGES = [("quality_rules", good_quality), ("line_dedup", without_repeated_lines),
          ("simhash_near_dedup", without_near_copies), ("decontamination", without_benchmarks), ("packing", packed)]

# The fingerprints and the tokens can't be expressed in SQL: the tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result is written to the shared folder and read again for the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
