import subprocess
import sys
import time
from pathlib import Path

import pytest

from sidelines import session


class Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class Spark:
    """Only what ``shared_dir`` asks of a session."""

    def __init__(self, app, master="local[2]", **conf):
        self.conf = Conf(conf)
        self.sparkContext = type("Context", (), {"applicationId": app, "master": master})


@pytest.fixture
def unmade(monkeypatch):
    monkeypatch.setattr(session, "_removed_at_exit", lambda application, folder: folder)


def test_the_cluster_names_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == f"{named}/sidelines-{spark.sparkContext.applicationId}"


def test_each_application_has_a_folder_of_its_own(unmade):
    assert session.shared_dir(Spark("a", **{"spark.checkpoint.dir": "hdfs://x/shared/"})) == "hdfs://x/shared/sidelines-a"


def test_a_folder_is_made_up_only_for_local_sessions(unmade):
    made = session.shared_dir(Spark("b"))
    assert made == session.shared_dir(Spark("b")) and made != session.shared_dir(Spark("c"))
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            session.shared_dir(Spark("b", master))


def test_the_folder_goes_when_the_driver_ends(tmp_path):
    code = """
from sidelines import session
spark = session.get_session("ends", "local[1]", **{"spark.checkpoint.dir": "file://%s", "spark.ui.showConsoleProgress": "false"})
assert session.written(spark.range(3), "t").count() == 3
""" % tmp_path
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parents[1], timeout=120)
    for _ in range(40):  # the JVM ends after Python does
        if not list(tmp_path.glob("sidelines-*")):
            return
        time.sleep(0.5)
    raise AssertionError("the folder is still there")


def test_written_tables_keep_rows_and_schema(spark):
    df = spark.range(5).selectExpr("id", "cast(null as string) as s")
    back = session.written(df, "t")
    assert back.dtypes == df.dtypes and back.count() == 5
