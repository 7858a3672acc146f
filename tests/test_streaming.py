from conftest import SF_SMALL
from shelfsense.plans import catalog
from shelfsense.session import scratch_path
from shelfsense.streaming import jobs as stream


def test_window_counts_equal_batch(spark):
    got = sorted(map(tuple, catalog.stream_label_counts(spark, SF_SMALL)
                     .select("window_start", "prediction_label", "n").collect()))
    from pyspark.sql import functions as F
    ev = catalog._prediction_table(spark, SF_SMALL).select(F.col("dt").cast("timestamp").alias("t"), "prediction_label")
    batch = (ev.groupBy(F.window("t", "7 days").start.alias("w"), "prediction_label").count())
    assert got == sorted(map(tuple, batch.collect()))


def test_stream_scoring_equals_batch_and_restarts_idempotently(spark):
    req = catalog._requests(spark, SF_SMALL)
    src, out, bad, ck = (scratch_path(spark, n) for n in ("s", "o", "q", "c"))
    req.write.json(src)
    scorer = lambda b: b
    stream.score_stream(spark, src, out, bad, ck, scorer)
    stream.score_stream(spark, src, out, bad, ck, scorer)   # restart: nothing new
    n_ok, n_bad = spark.read.parquet(out).count(), spark.read.parquet(bad).count()
    assert n_ok + n_bad == req.count()
    assert n_bad == req.where("Units_Sold_Lag1 is null").count()


def _events(spark, days):
    import datetime as dt
    return spark.createDataFrame([(dt.datetime(2024, 1, 1) + dt.timedelta(days=d), "a") for d in days],
                                 "event_time timestamp, prediction_label string")


def test_rows_behind_the_watermark_are_counted_aside(spark):
    src, out, late, ck = (scratch_path(spark, n) for n in ("ev", "cnt", "late", "ck"))
    batches = [[0, 1, 2, 20], [3, 21, 22], [1, 40, 4], [41, 42]]     # days; several go far back
    for days in batches:
        _events(spark, days).coalesce(1).write.mode("append").parquet(src)
    schema = _events(spark, [0]).schema
    stream.label_count_stream(spark, src, schema, out, ck, max_files_per_trigger=1, late=late)
    counted = sum(r.n for r in stream.latest_counts(spark, out).collect())
    n_late = stream.late_rows(spark, late, schema).count()
    assert counted + n_late == sum(map(len, batches)) and n_late == 2


def test_files_in_time_order_lose_nothing(spark):
    src, out, late, ck = (scratch_path(spark, n) for n in ("ev", "cnt", "late", "ck"))
    ev = _events(spark, [(7 * i) % 60 for i in range(200)])
    files = stream.write_in_time_order(ev, src, "event_time", 5)
    stream.label_count_stream(spark, src, ev.schema, out, ck, max_files_per_trigger=files, late=late)
    assert sum(r.n for r in stream.latest_counts(spark, out).collect()) == 200
    assert stream.late_rows(spark, late, ev.schema).count() == 0
    assert spark.read.parquet(out).select("batch_id").distinct().count() >= 3
