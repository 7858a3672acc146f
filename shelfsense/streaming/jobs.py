"""Structured Streaming jobs.

* ``score_stream``: JSON request files -> contract check -> scorer ->
  Parquet sink; rows failing the contract go to a quarantine sink in the
  same ``foreachBatch`` (one micro-batch, two writes, idempotent per batch id
  through the batch-id partition column).
* ``label_count_stream``: predictions with an event time -> watermark ->
  tumbling-window counts per label, update mode, each batch's updates
  written under their batch id; the latest row per (window, label) is the
  running result, equal to the batch group-by once drained. Rows behind the
  watermark go to a side table.

Both run with ``Trigger.AvailableNow`` and keep state and offsets in a
checkpoint folder, so a restarted job resumes where it stopped.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfsense.config import REQUEST_FIELDS
from shelfsense.operators.scoring import validate_requests
from shelfsense.operators.selection import written

REQUEST_JSON_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("store_id", "product_id", "dt")]
    + [T.StructField(api, T.StringType()) for api, _, _ in REQUEST_FIELDS])


def score_stream(spark: SparkSession, src: str, out: str, quarantine: str, checkpoint: str,
                 scorer: Callable[[DataFrame], DataFrame], keep=("store_id", "product_id", "dt"),
                 max_files_per_trigger: int | None = None, with_batch: bool = False):
    """Score all request files that are there; ``with_batch`` hands the batch id to the scorer, too."""
    reader = spark.readStream.schema(REQUEST_JSON_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    requests = reader.json(src)
    checked = validate_requests(requests, keep=list(keep))

    def sink(batch: DataFrame, batch_id: int) -> None:
        b = batch.withColumn("batch_id", F.lit(batch_id)).persist()   # checked once for both outputs
        valid = b.filter("is_valid").drop("is_valid", "error_columns")
        good = scorer(valid, batch_id) if with_batch else scorer(valid)
        good.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("batch_id").parquet(out)
        (b.filter(~F.col("is_valid")).withColumn("errors", F.concat_ws(",", "error_columns"))
          .drop("error_columns").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy("batch_id").parquet(quarantine))
        b.unpersist()

    q = (checked.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


class PinnedModels:
    """Which model version every batch is scored with.

    ``current`` names the version for a batch that has none yet; the choice is written before the batch is
    scored, so a batch that is run again after a failure is scored by the same version even
    if ``current`` has moved on in between.
    """

    def __init__(self, spark: SparkSession, folder: str, current: Callable[[], str], load: Callable[[str], PipelineModel]):
        self.spark, self.folder, self.current, self.load = spark, folder, current, load
        self._loaded: dict[str, PipelineModel] = {}

    def pins(self) -> DataFrame:
        return self.spark.read.schema("version string, batch_id int").parquet(self.folder)

    def version(self, batch_id: int) -> str:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/batch_id={batch_id}/_SUCCESS")
        if path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return self.pins().filter(F.col("batch_id") == batch_id).first()["version"]
        version = self.current()
        (self.spark.createDataFrame([(version,)], "version string").coalesce(1)
         .write.mode("overwrite").parquet(f"{self.folder}/batch_id={batch_id}"))
        return version

    def model(self, batch_id: int) -> tuple[str, PipelineModel]:
        version = self.version(batch_id)
        if version not in self._loaded:
            self._loaded[version] = self.load(version)
        return version, self._loaded[version]


def score_model_stream(spark: SparkSession, src: str, out: str, quarantine: str, checkpoint: str, models: PinnedModels,
                       score: Callable[[PipelineModel, DataFrame], DataFrame], keep=("store_id", "product_id", "dt"),
                       max_files_per_trigger: int | None = None):
    """``score_stream`` with saved models: every batch by the version pinned to it, named in ``model_version``."""
    def scorer(batch: DataFrame, batch_id: int) -> DataFrame:
        version, model = models.model(batch_id)
        return score(model, batch).withColumn("model_version", F.lit(version))

    return score_stream(spark, src, out, quarantine, checkpoint, scorer, keep, max_files_per_trigger, with_batch=True)


#: Rows of an event or request file: one task reads it, so a batch has more files than there are cores where rows are many.
FILE_ROWS = 250_000


def write_in_time_order(events: DataFrame, path: str, time_col: str, chunks: int, files: int | None = None,
                        order: Sequence[int] | None = None) -> int:
    """Event files in ``chunks`` runs of days, each run written after the one before.

    A file stream takes files by modification time, so ``files`` at a trigger
    (returned; by default one per ``FILE_ROWS`` rows of a run) make one batch of each run and no batch goes
    back in time - unless ``order`` says in which order the runs are written.
    """
    events = written(events, "event-rows")   # counted, bounded and dealt from there
    day = F.to_date(time_col)
    if files is None:
        files = max(1, -(-events.count() // (chunks * FILE_ROWS)))
    lo, hi = events.agg(F.min(day), F.max(day)).first()
    span = ((hi - lo).days if lo is not None else 0) // chunks + 1
    run = F.coalesce(F.floor(F.datediff(day, F.lit(lo)) / span), F.lit(0)) if lo is not None else F.lit(0)
    for i in order if order is not None else range(chunks):
        part = events.filter(run == i)
        part.repartition(files).write.mode("append").parquet(path)
    return files


def label_count_stream(spark: SparkSession, src: str, schema: T.StructType, out: str, checkpoint: str,
                       time_col: str = "event_time", label_col: str = "prediction_label",
                       window: str = "7 days", delay: str = "1 day",
                       max_files_per_trigger: int | None = None, late: str | None = None):
    """Window counts; with ``late`` also a table of the rows that came too late for them.

    Both outputs are written by batch id, so a replayed batch replaces itself.
    A row is late when its window ended before the watermark that the batch before
    began with (the largest event time of the batches before that, less ``delay``):
    the rule by which the state drops it.
    The second query reads the same files in the same batches; counted and late
    rows make up the input (rows without an event time are late too).
    """
    def reader():
        r = spark.readStream.schema(schema)
        return (r.option("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger else r).parquet(src)

    counts = (reader().withWatermark(time_col, delay)
              .groupBy(F.window(time_col, window).alias("w"), F.col(label_col))
              .agg(F.count(F.lit(1)).alias("n")))

    def by_batch(df: DataFrame, path: str) -> None:
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))

    def sink(batch: DataFrame, batch_id: int) -> None:
        by_batch(batch.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                              label_col, "n", F.lit(batch_id).alias("batch_id")), out)

    q = (counts.writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if late is None:
        return q
    marks = f"{late}-watermarks"

    def sink_late(batch: DataFrame, batch_id: int) -> None:
        seen = spark.read.schema("largest timestamp, batch_id int").parquet(marks) if batch_id else None
        before = seen.filter(F.col("batch_id") < batch_id - 1).agg(F.max("largest")).first()[0] if seen else None
        mark = F.lit(before).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        end = F.window(time_col, window).end
        behind = batch.withColumn("window_end", end) if before is not None else batch.withColumn(
            "window_end", F.lit(None).cast("timestamp"))
        is_late = F.col("window_end") <= mark if before is not None else F.lit(False)
        nulls = batch.filter(F.col(time_col).isNull()).withColumn("window_end", F.lit(None).cast("timestamp"))
        by_batch(behind.filter(is_late).unionByName(nulls).withColumn("batch_id", F.lit(batch_id)), late)
        by_batch(batch.agg(F.max(time_col).alias("largest")).withColumn("batch_id", F.lit(batch_id)), marks)

    ql = (reader().writeStream.foreachBatch(sink_late).option("checkpointLocation", f"{checkpoint}-late")
          .trigger(availableNow=True).start())
    ql.awaitTermination()
    return q


def late_rows(spark: SparkSession, late: str, schema: T.StructType) -> DataFrame:
    """The rows that came too late (an empty table where no batch had one)."""
    full = T.StructType([*schema.fields, T.StructField("window_end", T.TimestampType()),
                         T.StructField("batch_id", T.IntegerType())])
    return spark.read.schema(full).parquet(late)


def latest_counts(spark: SparkSession, out: str, label_col: str = "prediction_label") -> DataFrame:
    """Latest update per (window, label) from the update log."""
    log = spark.read.parquet(out)
    w = Window.partitionBy("window_start", label_col).orderBy(F.desc("batch_id"))
    return (log.withColumn("__r", F.row_number().over(w)).where("__r = 1")
               .drop("__r", "batch_id"))
