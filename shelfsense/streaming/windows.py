"""Window counts in append mode with late rows aside, from one stateful query.

Every (window, label, shard) is a group with its count in the state store and a timer at its
window's end. A row whose window has ended before the watermark is given out as a late row
at once; when the timer fires, the closed window is given out with its count and its state
goes. Both kinds share one append-mode output, so nothing is ever written twice or taken back.

Spark drops rows behind its own watermark before a stateful operator sees them. To see
them, the clock column is the event time moved ``SHIFT`` ahead and its watermark's delay is
``HORIZON`` instead of the wanted one: the operator itself takes the difference off again.
A row would have to be ``HORIZON`` older than the newest to be dropped.

A window of one label may hold most of all rows: ``shards`` deals its rows by file and place to several groups,
and the readers add these up.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

DAY_MS = 86_400_000
#: How far the clock column is ahead of the event time; the delay of its watermark.
SHIFT, HORIZON = dt.timedelta(days=73_000), dt.timedelta(days=36_500)
SHARDS = 8
OUT = "kind string, start_ms bigint, end_ms bigint, label string, shard int, n bigint, event_ms bigint"
NO_TIME = -(1 << 60)


def window_stream(spark: SparkSession, src: str, schema: T.StructType, out: str, checkpoint: str,
                  time_col: str = "event_time", label_col: str = "prediction_label", window: str = "7 days",
                  delay: dt.timedelta = dt.timedelta(days=1), max_files_per_trigger: int | None = None, shards: int = SHARDS):
    """Run the query over all files that are there; a restart goes on from the checkpoint.

    ``out`` has rows of kind ``window`` (closed: start, end, label, shard, n) and ``late`` (one per late row, with its
    event time; rows without an event time are late). Open windows are in the state: ``open_windows``.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    ahead = int(SHIFT.total_seconds()) * 1000
    lead = ahead - int((HORIZON - delay).total_seconds()) * 1000   # clock watermark = event watermark + lead
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("place")   # the same in every attempt
    rows = (reader.parquet(src).select("*", place).withColumn("clock", F.col(time_col) + F.expr(f"INTERVAL {SHIFT.days} DAYS"))
            .withWatermark("clock", f"{HORIZON.days} days"))
    size = int(pd.Timedelta(window).total_seconds()) * 1000
    at = F.unix_millis(F.col(time_col))
    label = F.col(label_col).cast("string")
    rows = rows.select("clock", F.coalesce(at - F.pmod(at, F.lit(size)), F.lit(NO_TIME)).alias("start_ms"), label.alias("label"),
                       F.pmod("place", F.lit(shards)).cast("int").alias("shard"),
                       F.coalesce(at, F.lit(NO_TIME)).alias("event_ms"))

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        start_ms, label, shard = int(key[0]), key[1], int(key[2])
        end_ms = start_ms + size
        line = lambda kind, n, at=None: (kind, start_ms, end_ms, label, shard, n, at)
        found = []
        if state.hasTimedOut:
            found.append(line("window", int(state.get[0])))
            state.remove()
        else:
            over = start_ms == NO_TIME or end_ms <= state.getCurrentWatermarkMs() - lead
            count = int(state.get[0]) if state.exists else 0
            for part in parts:
                if over:
                    found += [line("late", 1, int(x) if x != NO_TIME else None) for x in part["event_ms"]]
                else:
                    count += len(part)
            if not over:
                state.update((count,))
                state.setTimeoutTimestamp(end_ms + lead)
            elif count:   # rows came in the very batch in which the window closes: a call with rows takes the timer off
                found.append(line("window", count))
                state.remove()
        names = [f.split()[0] for f in OUT.split(", ")]
        yield pd.DataFrame(found, columns=names).astype({"event_ms": "Int64"})

    counted = rows.groupBy("start_ms", "label", "shard").applyInPandasWithState(
        step, OUT, "n bigint", "append", GroupStateTimeout.EventTimeTimeout)
    q = (counted.writeStream.outputMode("append").format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def _timed(rows: DataFrame) -> DataFrame:
    return rows.select(F.timestamp_millis("start_ms").alias("window_start"), F.timestamp_millis("end_ms").alias("window_end"),
                       F.col("label").alias("prediction_label"), "n")


def _summed(rows: DataFrame) -> DataFrame:
    return _timed(rows).groupBy("window_start", "window_end", "prediction_label").agg(F.sum("n").alias("n"))


def closed_windows(spark: SparkSession, out: str) -> DataFrame:
    """Final counts of the windows that the watermark has passed."""
    return _summed(spark.read.schema(OUT).parquet(out).filter("kind = 'window'"))


def late_events(spark: SparkSession, out: str) -> DataFrame:
    """One row per late event: its window (null without an event time), label and event time."""
    late = spark.read.schema(OUT).parquet(out).filter("kind = 'late'")
    timed = F.col("start_ms") != NO_TIME
    return late.select(F.when(timed, F.timestamp_millis("start_ms")).alias("window_start"),
                       F.when(timed, F.timestamp_millis("end_ms")).alias("window_end"),
                       F.col("label").alias("prediction_label"), F.timestamp_millis("event_ms").alias("event_time"))


def open_windows(spark: SparkSession, checkpoint: str, window: str = "7 days") -> DataFrame:
    """Counts so far of the windows that are still open, read from the state store."""
    size = int(pd.Timedelta(window).total_seconds()) * 1000
    state = spark.read.format("statestore").load(checkpoint)
    rows = state.select("key.start_ms", (F.col("key.start_ms") + size).alias("end_ms"), "key.label",
                        F.col("value.groupState.n").alias("n"))
    return _summed(rows)
