"""Block and allow lists over URLs, matched by hashes of host suffixes and path prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sidelines.llm.common import ascii_lower, beside_row, row_with

RULES_SCHEMA = "rule_host string, rule_path string, rule_verdict string"
PREFIX_CHARS = 8


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for a null or a text without ``://``."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, url.substr(start + 3, F.length(url)))
    host = ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _rule_keys(rules: DataFrame) -> DataFrame:
    """Each rule under the hash of its host and its path up to the last slash."""
    folder = F.regexp_extract("rule_path", r"(?s)^.*/", 0)
    return (rules.dropna().select("*", F.sha2(F.concat("rule_host", folder), 256).alias("rule_digest"))
            .select("*", F.left("rule_digest", F.lit(PREFIX_CHARS)).alias("prefix")))


def _expressions(host: Column, path: Column, labels: Column, folders: Column) -> Column:
    """The host's suffixes of up to so many labels with the path's prefixes of up to so many folders."""
    suffixes = F.transform(F.sequence(F.lit(1), labels),
                           lambda k: F.call_function("substring_index", host, F.lit("."), -k))
    prefixes = F.transform(F.sequence(F.lit(0), folders), lambda k: F.when(k == 0, F.lit("")).otherwise(
        F.concat(F.call_function("substring_index", path, F.lit("/"), k), F.lit("/"))))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Every row of ``pages(page_id, url)`` with host, path, the rule that decides and its verdict.

    A rule ``(rule_host, rule_path, rule_verdict)`` fits its host and all subdomains if the path starts with the rule's. Of
    several the longest decides, host and path together; then the longer host, then the block. Every URL is expanded
    to host suffixes and path prefixes; these meet the rules in a join on the first 8 hex digits of a SHA-256, and the
    whole digest, the rest of the path and the precedence decide. The join is broadcast if Spark sees that the rules are
    small, and else shuffled, where adaptive execution splits a common host.

    Null URLs and URLs without ``://`` have an empty host and path and get the default verdict. Repeated rows stay,
    rules with a null are skipped, no rules or no pages give defaults or no rows. Only ``page_id`` and ``url`` are kept;
    ``judged_rows`` keeps every column.
    """
    host, path = url_parts(F.col("url"))
    keys = _rule_keys(rules.select("rule_host", "rule_path", "rule_verdict"))
    limits = rules.dropna()
    labels = limits.select(F.coalesce(F.max(_count(F.col("rule_host"), ".") + 1), F.lit(1))).scalar()
    folders = limits.select(F.coalesce(F.max(_count(F.col("rule_path"), "/")), F.lit(0))).scalar()
    parts = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    # No longer than the longest of the rules: nothing longer can match.
    parts = parts.select("*", F.least(_count(F.col("host"), ".") + 1, labels).alias("labels"),
                         F.least(_count(F.col("path"), "/"), folders).alias("folders"))
    # The null stands for the row itself: it matches nothing and is counted once.
    found = parts.select("*", F.explode(F.concat(F.array(F.lit(None).cast("string")),
                                                 _expressions(*map(F.col, ("host", "path", "labels", "folders"))))).alias("e"))
    digest = F.sha2("e", 256)
    apart = F.concat(F.lit("-"), F.pmod(F.xxhash64("page_id", "url"), F.lit(4096)).cast("string"))
    found = (found.select("*", digest.alias("digest"))
             .withColumn("prefix", F.coalesce(F.left("digest", F.lit(PREFIX_CHARS)), apart)))
    fits = (F.col("digest") == F.col("rule_digest")) & F.startswith("path", F.col("rule_path"))
    rule = F.concat("rule_host", "rule_path")
    hit = F.when(fits, F.struct(F.length(rule).alias("chars"), F.length("rule_host").alias("host_chars"),
                                (F.col("rule_verdict") == "block").alias("blocks"), rule.alias("rule"),
                                F.col("rule_verdict").alias("verdict")))
    best = (found.join(keys, "prefix", "left").select("page_id", "url", F.col("e").isNull().alias("itself"), hit.alias("hit"))
            .filter("itself or hit is not null").groupBy("page_id", "url")
            .agg(F.max("hit").alias("hit"), F.count_if("itself").cast("int").alias("copies")))
    each = best.select("*", F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
    return each.select("page_id", "url", host.alias("host"), path.alias("path"), F.col("hit.rule").alias("rule"),
                       F.coalesce("hit.verdict", F.lit(default)).alias("verdict"))


def judged_rows(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``pages`` with ``rule`` and ``verdict`` by their ``url``; every other column stays."""
    urls = pages.select("url").distinct().select(F.lit(None).cast("long").alias("page_id"), "url")
    verdicts = judge(urls, rules, default).select(F.col("url").alias("of"), "rule", "verdict")
    rows = beside_row(pages, _url=F.col("url"))
    joined = rows.join(verdicts, F.col("_url").eqNullSafe(F.col("of")))
    return row_with(joined, pages.columns, rule=F.col("rule"), verdict=F.col("verdict"))
