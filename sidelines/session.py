"""Session defaults and the shared folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# How long a block of an entity's history is: year, quarter or month. Results do not depend on it.
HISTORY_BLOCK = "spark.sidelines.historyBlock"

_DEFAULTS = {HISTORY_BLOCK: "year"}


def get_session(app: str = "sidelines", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; a cluster may override any of them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def setting(spark: SparkSession, key: str) -> str:
    return spark.conf.get(key, _DEFAULTS[key])


@functools.cache
def _folder_for_tests(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="sidelines-checkpoints-")


@functools.cache
def _removed_at_exit(application_id: str, folder: str) -> str:
    """Make ``folder`` and have it removed when the driver's JVM ends."""
    context = SparkSession.active().sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(context._jsc.hadoopConfiguration())
    store.mkdirs(path)
    store.deleteOnExit(path)
    return folder


def shared_dir(spark: SparkSession) -> str:
    """This application's part of the folder that all executors reach; it goes when the application ends.

    Only a local session that names none (tests) gets one made up: elsewhere the executors would write to their own
    disks, where nobody finds it.
    """
    application = spark.sparkContext.applicationId
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        named = _folder_for_tests(application)
    return _removed_at_exit(application, f"{named.rstrip('/')}/sidelines-{application}")


def remove_folder(spark: SparkSession, folder: str) -> None:
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def move_folder(spark: SparkSession, folder: str, to: str) -> None:
    """Let ``folder`` take the place of ``to``, which is removed."""
    context = spark.sparkContext
    paths = context._jvm.org.apache.hadoop.fs
    store = paths.Path(folder).getFileSystem(context._jsc.hadoopConfiguration())
    store.delete(paths.Path(to), True)
    if not store.rename(paths.Path(folder), paths.Path(to)):
        raise OSError(f"{folder} is complete, but could not be moved to {to}")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder's name, used by nothing else, below ``shared_dir``."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
