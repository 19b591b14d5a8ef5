"""Quality rules for documents, and verdicts over their hosts: failure rates, shrunk by a prior fitted to all hosts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sidelines.llm.common import beside_row, row_with
from sidelines.session import written

WINDOW = 5
SYMBOLS = "#*$%&|<>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where it is used inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeated_words(hashes: Column) -> Column:
    """Words in windows (given by their hashes, in order) that occur twice or more."""
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    again = _let(placed, lambda s: F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])))
    places = F.sort_array(F.transform(again, lambda x: x["i"]))
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("words"))
    return F.aggregate(places, start, lambda a, p: F.struct(
        p.alias("last"), (a["words"] + F.least(F.lit(WINDOW), p - a["last"])).alias("words")), lambda a: a["words"])


def with_measures(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with the measures that the rules read: ``m`` is a struct of longs, all zero for a null text.

    ``n_words``, ``word_chars`` (characters in words), ``n_symbols``, ``n_lines`` (with a word), ``n_dup_lines`` (equal to
    an earlier one), ``n_repeat_words`` (in windows of five words that the text has twice or more).
    """
    rows = rows.withColumn("_t", F.coalesce(F.col(text), F.lit("")))
    rows = rows.withColumn("_flat", F.translate("_t", "\t\n\x0b\x0c\r", " " * 5))
    rows = rows.withColumn("_words", F.array_remove(F.split("_flat", " "), ""))
    # The least window starts at 1; without enough words the array is empty.
    starts = F.when(F.size("_words") >= WINDOW, F.sequence(F.lit(1), F.size("_words") - (WINDOW - 1))).otherwise(
        F.array().cast("array<int>"))
    words = F.col("_words")
    rows = rows.withColumn("_windows", F.transform(starts, lambda i: F.xxhash64(
        *[F.get(words, i + (k - 1)) for k in range(WINDOW)])))
    lines = F.filter(F.split("_t", "\n"), lambda line: F.btrim(line, F.lit(" \t\x0b\x0c\r")) != "")
    rows = rows.withColumn("_lines", lines)
    repeats = F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), _repeated_words(F.col("_windows")))
    measures = {
        "n_words": F.size("_words"),
        "word_chars": F.length(F.replace("_flat", F.lit(" "), F.lit(""))),
        "n_symbols": F.length("_t") - F.length(F.translate("_t", SYMBOLS, "")),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.coalesce(repeats, F.lit(0)),
    }
    packed = F.struct(*[m.cast("long").alias(name) for name, m in measures.items()])
    return rows.withColumn("m", packed).drop("_t", "_flat", "_words", "_windows", "_lines")


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def rule_failed(m: Column) -> Column:
    """Any of the rules: the base, over a symbol for ten words, over half of the lines repeated, odd word lengths."""
    return (base_failed(m) | (10 * m["n_symbols"] > m["n_words"]) | (2 * m["n_dup_lines"] > m["n_lines"])
            | (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 15 * m["n_words"]))


def host_rates(rows: DataFrame) -> DataFrame:
    """``rows(host, failed)`` to ``(host, n_docs, n_failed, rate)``, the rate shrunk by an empirical beta prior.

    The prior's mean is the failure rate of all documents; its weight in documents follows from how far the hosts' rates
    scatter beyond what chance gives hosts of their sizes, and lies between 2 and 1000. A host of few documents thus gets
    nearly the common rate, a large one its own. Counts are combined before the shuffle, so a host with most of
    the rows is one row per task.
    """
    hosts = rows.groupBy("host").agg(F.count("*").alias("n_docs"), F.count_if("failed").alias("n_failed"))
    docs, own = F.sum("n_docs"), F.col("n_failed") / F.col("n_docs")
    sums = hosts.agg(docs.alias("n"), (F.sum("n_failed") / docs).alias("mean"), F.count("*").alias("hosts"),
                     (F.sum(F.col("n_failed") * own) / docs).alias("square"))
    noise = F.col("mean") * (1 - F.col("mean"))
    between = F.col("square") - F.col("mean") * F.col("mean") - F.col("hosts") * noise / F.col("n")
    weight = F.when(between > 0, F.greatest(F.lit(2.0), F.least(F.lit(1000.0), noise / between - 1))).otherwise(1000.0)
    prior = sums.select(F.struct("mean", weight.alias("weight"))).scalar()
    return (hosts.withColumn("prior", prior)
            .select("host", "n_docs", "n_failed", ((F.col("n_failed") + F.col("prior.mean") * F.col("prior.weight"))
                                                   / (F.col("n_docs") + F.col("prior.weight"))).alias("rate")))


def judged(documents: DataFrame, host: str = "source", text: str = "text", max_rate: float = 0.5,
           keep_text: bool = True) -> DataFrame:
    """``documents`` with the measures, ``base_failed``, ``rule_failed``, ``host_rate`` and ``kept``.

    A document stays if it fails no rule itself and its host is not rejected: the host's shrunk failure rate is at most
    ``max_rate``. A null host is a host of its own; a null or empty text has no words and fails. All rows and columns
    stay (``keep_text=False`` leaves the text out); columns of the results' names are replaced. The measured rows and then
    the hosts are written, so that Spark knows how many hosts there are before it joins them back to the documents: few
    are broadcast, many are shuffled, where adaptive execution can split a host with most of the documents.
    """
    rows = with_measures(beside_row(documents, _text=F.col(text), _host=F.col(host)), "_text").drop("_text")
    columns = documents.columns
    if not keep_text:
        rows = rows.withColumn("_row", F.col("_row").dropFields(text))
        columns = [c for c in columns if c != text]
    # a flag beside the host, as null equals nothing in a join
    rows = rows.withColumn("_host", F.struct(F.col("_host").isNull().alias("none"), F.coalesce("_host", F.lit("")).alias("name")))
    rows = written(rows.withColumn("_failed", rule_failed(F.col("m"))), "measured")
    rates = written(host_rates(rows.select(F.col("_host").alias("host"), F.col("_failed").alias("failed"))), "hosts")
    found = rows.join(rates.select(F.col("host").alias("_host"), "rate"), "_host")
    m = F.col("m")
    names = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    return row_with(found, columns, **{n: m[n] for n in names}, base_failed=base_failed(m), rule_failed=F.col("_failed"),
                    host_rate=F.col("rate"), kept=~F.col("_failed") & (F.col("rate") <= max_rate))


def good_documents(documents: DataFrame, host: str = "source", text: str = "text", max_rate: float = 0.5) -> DataFrame:
    """The kept rows of ``documents``, with its columns."""
    rows = judged(beside_row(documents, host=F.col(host), text=F.col(text)), "host", "text", max_rate, keep_text=False)
    return row_with(rows.filter("kept"), documents.columns)
