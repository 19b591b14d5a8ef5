"""Incremental ingestion and monitoring.

Each job reads what has arrived since the last run (``availableNow``) or runs on; progress is kept in the
checkpoint folder given by the caller.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sidelines.operators.keyed import first_per_key
from sidelines.plans import loaders
from sidelines.plans.monitoring import quality_metrics
from sidelines.schemas import GAME_PREDICTIONS
from sidelines.session import written
from sidelines.sources import files
from sidelines.sources.snapshots import SnapshotTable

_BATCH = T.StructField("batch", T.IntegerType())
_HASH = "hash_of_key"
_KEY_BUCKETS = 64  # of the keys that first_deliveries has stored
_CONTEST_BUCKETS = 16


def read_landed_stream(spark: SparkSession, path: str, schema: T.StructType,
                       files_per_batch: int = 100, counts: Collection[str] = ()) -> DataFrame:
    """Landed JSON rows as they arrive, so many files in a batch at most."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
    return files.from_lines(lines, schema, counts)


def ingest_box_scores(box: DataFrame, tables: loaders.WarehouseTables, checkpoint: str) -> StreamingQuery:
    """Landed box-score rows into the keyed table. A batch that is delivered again is skipped."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        # a new checkpoint counts its batches from 0 again, so the number alone does not name a batch
        delivery = f"{checkpoint}#{batch_id}"
        if not tables["player_game_stats"].has_delivery(delivery):
            loaders.upsert_box(tables, files.canonical_box(batch), delivery, delivery)

    return (box.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def ingest_landing(spark: SparkSession, landing: str, tables: loaders.WarehouseTables, checkpoint: str,
                   on_change: Callable[[DataFrame], None] | None = None, files_per_batch: int = 1000) -> StreamingQuery:
    """Everything that has landed since the last run, each file once: the file source keeps the progress.

    A file's kind is the folder below ``landing`` that it lies in. ``on_change`` gets the ids of the contests that a batch
    concerned. A batch that is delivered again writes the same rows again.
    """
    kinds = {"header": (files.HEADER_FEED, ()), "line_score": (files.LINE_SCORE_FEED, ()),
             "box": (files.BOX_FEED, files.BOX_COUNTS), "tracking": (files.TRACKING_FEED, files.TRACKING_COLUMNS)}
    kind = F.regexp_extract(F.col("_metadata.file_path"), f"/({'|'.join(kinds)})/(?:{files.DAY}=[^/]*/)?[^/]*$", 1)

    def apply(batch: DataFrame, batch_id: int) -> None:
        staged = written(batch, "landed")
        rows = [files.from_lines(staged.filter(F.col("kind") == name), *how) for name, how in kinds.items()]
        changed = loaders.take_in(tables, *rows, f"{checkpoint}#{batch_id}")
        if on_change:
            on_change(changed)

    lines = (spark.readStream.option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch)
             .text(landing).select("value", kind.alias("kind")))
    return _each_batch(lines, checkpoint, apply)


def _each_batch(stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def first_deliveries(stream: DataFrame, keys: list[str], event_time: str, path: str, checkpoint: str) -> StreamingQuery:
    """Append the first delivery of each key to the table at ``path``, however late and in however many batches it comes.

    A batch keeps its earliest row of each key that no other batch has stored. Its folder carries its number, so that a
    batch that is delivered again replaces itself; below it rows lie by a hash of their key, and a batch reads only the
    hashes that it has itself.
    """
    hashed = F.pmod(F.xxhash64(*keys), F.lit(_KEY_BUCKETS)).cast("int")

    def apply(batch: DataFrame, batch_id: int) -> None:
        first = first_per_key(batch, keys, [F.col(event_time).asc_nulls_last(), F.xxhash64(*batch.columns)])
        first = written(first.select(*batch.columns, hashed.alias(_HASH)), "first")
        kept = first
        if batch_id:
            touched = [r[0] for r in first.select(_HASH).distinct().collect()]
            layout = T.StructType([*batch.schema.fields, _BATCH, T.StructField(_HASH, T.IntegerType())])
            stored = batch.sparkSession.read.schema(layout).parquet(path).filter(F.col(_HASH).isin(touched))
            kept = first.join(stored.filter(F.col("batch") < batch_id).select(*keys), keys, "left_anti")
        (kept.select(*batch.columns, _HASH).hint("rebalance", F.col(_HASH)).write.mode("overwrite").partitionBy(_HASH)
         .parquet(f"{path}/batch={batch_id}"))

    return _each_batch(stream, checkpoint, apply)


def weekly_quality(scored: DataFrame, event_time: str, path: str, checkpoint: str) -> StreamingQuery:
    """Store each batch's counts and means per model and week (Monday to Sunday); ``weekly_metrics_of`` adds them up.

    Nothing is late: a row that comes after its week has been reported corrects it.
    """
    week = F.date_trunc("week", event_time).cast("date").alias("week_start")

    def apply(batch: DataFrame, batch_id: int) -> None:
        (batch.filter(F.col("actual_label").isNotNull()).groupBy("model_version_id", week).agg(*quality_metrics())
         .write.mode("overwrite").parquet(f"{path}/batch={batch_id}"))

    return _each_batch(scored, checkpoint, apply)


def weekly_metrics_of(parts: DataFrame) -> DataFrame:
    """Accuracy, log loss and Brier score per model and week from the parts that batches stored."""
    n = F.sum("n_predictions")
    means = [(F.sum(F.col(c) * F.col("n_predictions")) / n).alias(c) for c in ("accuracy", "log_loss", "brier_score")]
    return parts.groupBy("model_version_id", "week_start").agg(n.alias("n_predictions"), *means)


def label_predictions(predictions: DataFrame, outcomes: DataFrame, delay: str, horizon: str) -> DataFrame:
    """Predictions joined with the outcomes that arrive within ``horizon`` after them.

    Both sides have a watermark and the join bounds their distance, so old state is dropped.
    """
    p = predictions.withWatermark("predicted_at", delay).alias("p")
    o = (outcomes.select(F.col("game_id").alias("outcome_game_id"), "decided_at", "home_win")
         .withWatermark("decided_at", delay).alias("o"))
    near = ((F.col("game_id") == F.col("outcome_game_id"))
            & (F.col("decided_at") >= F.col("predicted_at"))
            & (F.col("decided_at") <= F.col("predicted_at") + F.expr(f"INTERVAL {horizon}")))
    return (p.join(o, near)
            .withColumn("actual_label", F.coalesce("actual_label", "home_win"))
            .select("game_id", "model_version_id", "predicted_home_win_prob", "predicted_label", "actual_label",
                    "predicted_at", "decided_at"))


class LateLabels:
    """Predictions with the outcomes of their contests, whichever comes first and however late the other is.

    Three keyed tables below ``root``: predictions and outcomes as they came, and ``labelled``. A batch reads and rewrites
    only the contests it concerns, from the first two tables, so that neither the order nor the number of batches matters,
    and one that is delivered again changes nothing. A prediction keeps a label that it came with; of several copies of a
    key the earliest counts, of equally early ones the first by content. Rows without a contest are left out. With
    ``horizon`` an outcome counts only if it was decided no earlier than the prediction and within that time.
    """

    KEYS = ("game_id", "model_version_id")
    PREDICTION = T.StructType([f for f in GAME_PREDICTIONS.fields if f.name != "predicted_home_win_prob"]
                              + [T.StructField("predicted_home_win_prob", T.DoubleType())])
    OUTCOME = T.StructType([T.StructField("game_id", T.StringType()), T.StructField("decided_at", T.TimestampType()),
                            T.StructField("home_win", T.BooleanType())])

    def __init__(self, spark: SparkSession, root: str, horizon: str | None = None):
        def table(name: str, schema: T.StructType, keys: Sequence[str]) -> SnapshotTable:
            return SnapshotTable(spark, f"{root.rstrip('/')}/{name}", schema, keys, buckets=_CONTEST_BUCKETS, bucket_by=["game_id"])

        self.predictions = table("predictions", self.PREDICTION, self.KEYS)
        self.outcomes = table("outcomes", self.OUTCOME, ["game_id"])
        self.labelled = table("labelled", self.PREDICTION, self.KEYS)
        self.horizon = horizon

    def follow(self, predictions: DataFrame, outcomes: DataFrame, checkpoint: str) -> StreamingQuery:
        """Take in everything that has arrived on both streams since the last run."""
        both = (predictions.select(*self.PREDICTION.names).withColumn("_decided", F.lit(False))
                .unionByName(outcomes.select(*self.OUTCOME.names).withColumn("_decided", F.lit(True)), allowMissingColumns=True))
        return _each_batch(both, checkpoint, lambda batch, _: self.take_in(batch))

    def take_in(self, batch: DataFrame) -> None:
        rows = written(batch.filter(F.col("game_id").isNotNull()), "late-labels")
        contests = rows.select("game_id").distinct()
        self._keep_earliest(self.predictions, rows.filter(~F.col("_decided")), "predicted_at")
        self._keep_earliest(self.outcomes, rows.filter("_decided"), "decided_at")
        asked = self.predictions.read_where(contests).join(contests, "game_id", "left_semi")
        known = self.outcomes.read_where(contests)
        counts = F.lit(True)
        if self.horizon:
            counts = F.col("decided_at").between(F.col("predicted_at"), F.col("predicted_at") + F.expr(f"INTERVAL {self.horizon}"))
        label = F.coalesce("actual_label", F.when(counts, F.col("home_win")))
        self.labelled.upsert(asked.join(known, "game_id", "left").withColumn("actual_label", label).select(*self.PREDICTION.names))
        for table in (self.predictions, self.outcomes, self.labelled):
            table.compact()

    @staticmethod
    def _keep_earliest(table: SnapshotTable, rows: DataFrame, when: str) -> None:
        columns = table.schema.names
        both = rows.select(*columns).unionByName(
            table.read_where(rows).join(rows.select(*table.keys).distinct(), table.keys, "left_semi"))
        order = [F.col(when).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in columns]]
        # staged, since the table that is read is the one that is written
        table.upsert(written(first_per_key(both, table.keys, order), "earliest"))


def append_to(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write an append-mode result as Parquet and stop when everything present has been read."""
    return (df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start())
