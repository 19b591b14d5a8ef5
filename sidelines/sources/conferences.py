"""Conference and division of every team abbreviation, relocated franchises included."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Abbreviation, conference, division.
TEAM_CONFERENCES = """
ATL,East,Southeast
BOS,East,Atlantic
BKN,East,Atlantic
NJN,East,Atlantic
CHA,East,Southeast
CHH,East,Southeast
CHI,East,Central
CLE,East,Central
DAL,West,Southwest
DEN,West,Northwest
DET,East,Central
GSW,West,Pacific
HOU,West,Southwest
IND,East,Central
LAC,West,Pacific
LAL,West,Pacific
MEM,West,Southwest
VAN,West,Southwest
MIA,East,Southeast
MIL,East,Central
MIN,West,Northwest
NOP,West,Southwest
NOH,West,Southwest
NOK,West,Southwest
NYK,East,Atlantic
OKC,West,Northwest
SEA,West,Northwest
ORL,East,Southeast
PHI,East,Atlantic
PHX,West,Pacific
POR,West,Northwest
SAC,West,Pacific
SAS,West,Southwest
TOR,East,Atlantic
UTA,West,Northwest
WAS,East,Southeast
"""


def rows() -> list[list[str]]:
    return [line.split(",") for line in TEAM_CONFERENCES.split()]


def conference_lookup(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(rows(), "abbreviation string, conference string, division string")
