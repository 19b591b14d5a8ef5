import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sidelines.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
           # on a few rows compiling a plan takes longer than running it; the oracle check runs compiled plans
           "spark.sql.codegen.wholeStage": "false", "spark.ui.showConsoleProgress": "false",
           "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
           "spark.sql.streaming.stateStore.providerClass":
               "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["month", "quarter"])
def history_block(spark, request):
    """Cut histories into other blocks than years."""
    spark.conf.set("spark.sidelines.historyBlock", request.param)
    yield request.param
    spark.conf.unset("spark.sidelines.historyBlock")


def rows(df, *order):
    """The rows as sorted tuples."""
    found = [tuple(r) for r in df.select(*(order or df.columns)).collect()]
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))
