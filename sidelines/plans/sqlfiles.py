"""Run files of SQL statements over registered views and preview their results."""

from __future__ import annotations

import re
from collections.abc import Iterator
from pathlib import Path

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from sidelines.sources.warehouse import preview


# What a semicolon or a comment mark can be part of, and what it can be.
_TOKEN = re.compile(r"""
    (?P<literal> '(?:[^'\\]|\\.)*' | "(?:[^"\\]|\\.)*" | `[^`]*` )
  | (?P<comment> --[^\n]* | /\*.*?\*/ )
  | (?P<end> ; )
  | (?P<other> . )""", re.VERBOSE | re.DOTALL)


def statements(text: str) -> list[str]:
    """The statements of a file, without comments. Inside of a literal or a quoted name nothing is a mark."""
    found = [""]
    for token in _TOKEN.finditer(text):
        if token.lastgroup == "end":
            found.append("")
        else:
            found[-1] += " " if token.lastgroup == "comment" else token.group()
    return [statement for statement in map(str.strip, found) if statement]


def run_text(spark: SparkSession, text: str) -> Iterator[tuple[int, DataFrame | None, str | None]]:
    """(number, result, error) of each statement; a statement that fails does not stop the others."""
    for number, statement in enumerate(statements(text), start=1):
        try:
            yield number, spark.sql(statement), None
        except PySparkException as error:
            yield number, None, str(error)


def run_files(spark: SparkSession, folder: str, only: str | None = None) -> None:
    """Print the first rows of every statement of the folder's SQL files, in the order of their names."""
    for path in sorted(Path(folder).glob("*.sql")):
        if only is not None and path.name != only:
            continue
        print(f"== {path.name}")
        for number, result, error in run_text(spark, path.read_text()):
            print(f"-- statement {number}")
            try:
                if result is None:
                    print(f"skipped: {error}")
                else:
                    preview(result).show(truncate=False)
            except PySparkException as late:
                print(f"skipped: {late}")
