"""Preparation saved with a model, run registry, pinned models, append-mode windows, fits of each kind."""

import datetime as dt

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfsense.operators import models as mdl
from shelfsense.operators.prepare import UNKNOWN, RequestPreparer, RequestPreparerModel
from shelfsense.operators.registry import RunRegistry
from shelfsense.plans import base, catalog, serving
from shelfsense.session import scratch_path
from shelfsense.streaming import jobs, windows


def test_preparer_fills_gaps_with_train_medians_and_reloads(spark):
    train = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (10.0, "a"), (None, None)], "x double, k string")
    model = RequestPreparer(numericCols=["x"], categoricalCols=["k"]).fit(train)
    path = scratch_path(spark, "preparer")
    model.write().save(path)
    loaded = RequestPreparerModel.load(path)
    asked = spark.createDataFrame([("3", "a", 1), ("", "z", 2), ("n/a", None, 3), ("NaN", "b", 4), ("Infinity", "a", 5)], "x string, k string, n int")
    got = sorted(map(tuple, loaded.transform(asked).select("n", "x", "k").collect()))
    assert got == [(1, 3.0, "a"), (2, 2.0, UNKNOWN), (3, 2.0, UNKNOWN), (4, 2.0, "b"), (5, 2.0, "a")]
    with pytest.raises(ValueError, match="request field"):
        loaded.transform(asked.drop("x"))


def test_registry_is_idempotent_by_run(spark):
    reg = RunRegistry(spark, scratch_path(spark, "reg"))
    schema = "split string, accuracy double, precision_macro double, recall_macro double, f1_macro double"
    table = lambda f1: spark.createDataFrame([(s, 0.5, 0.5, 0.5, f1) for s in ("train", "val", "test")], schema)
    reg.log("one", "A", table(0.4), {"depth": 3}, {"type": "a"})
    reg.log("two", "B", table(0.6), artifact="somewhere")
    reg.log("one", "A", table(0.5), {"depth": 4}, {"type": "a"})
    assert reg.runs().count() == 2 * 3 * 4
    assert reg.runs().filter("run_id = 'one'").select("params").first()[0] == {"depth": "4"}
    assert reg.best()["run_id"] == "two" and reg.best()["artifact"] == "somewhere"
    with pytest.raises(ValueError, match="no saved model"):
        reg.load("one")


def _events(spark, days):
    rows = [(None if d is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=d), "a") for d in days]
    return spark.createDataFrame(rows, "event_time timestamp, prediction_label string")


def test_append_windows_closed_open_and_late(spark):
    src, out, ck = (scratch_path(spark, n) for n in ("ev", "win", "ck"))
    schema = _events(spark, [0]).schema
    for days in ([0, 1, 2, 20], [3, 21, 22], [1, 40, 4, None], [41, 42]):
        _events(spark, days).coalesce(1).write.mode("append").parquet(src)
    windows.window_stream(spark, src, schema, out, ck, max_files_per_trigger=1)
    windows.window_stream(spark, src, schema, out, ck, max_files_per_trigger=1)   # a restart adds nothing
    day = lambda r: (r.window_start - dt.datetime(2024, 1, 1)).days
    assert {day(r): r.n for r in windows.closed_windows(spark, out).collect()} == {-4: 3, 17: 3}
    assert {day(r): r.n for r in windows.open_windows(spark, ck).collect()} == {38: 3}
    late = windows.late_events(spark, out).collect()
    assert sorted((r.event_time - dt.datetime(2024, 1, 1)).days for r in late if r.event_time) == [1, 3, 4] and len(late) == 4


def test_a_batch_keeps_the_model_version_it_was_pinned_to(spark):
    now = ["v1"]
    pinned = jobs.PinnedModels(spark, scratch_path(spark, "pins"), lambda: now[0], lambda v: f"model {v}")
    assert pinned.model(0) == ("v1", "model v1")
    now[0] = "v2"
    again = jobs.PinnedModels(spark, pinned.folder, lambda: now[0], lambda v: f"model {v}")
    assert again.model(0) == ("v1", "model v1") and again.model(1) == ("v2", "model v2")
    assert {r.batch_id: r.version for r in again.pins().collect()} == {0: "v1", 1: "v2"}


SMALL = [mdl.ModelSpec("Logistic Regression", "logistic", {"maxIter": 20}), mdl.ModelSpec("Random Forest", "forest",
         {"numTrees": 3, "maxDepth": 3, "seed": 42}), mdl.ModelSpec("Boosted trees", "boosting", {"maxIter": 2, "maxDepth": 3})]


def test_each_kind_fits_is_ranked_and_reloads(spark):
    frame = base.split_frame(spark, SF_SMALL)
    path, reg = scratch_path(spark, "models"), RunRegistry(spark, scratch_path(spark, "runs"))
    ranked, models = mdl.train_and_compare(frame, SMALL, path, reg)
    rows = ranked.collect()
    assert reg.runs().count() == 3 * 3 * 4 and reg.best()["run_id"] == rows[0].run_id
    assert reg.best()["artifact"] == f"{path}/{rows[0].run_id}"
    assert sorted(r.model_name for r in rows) == sorted(models) and [r.val_f1_macro for r in rows] == sorted((r.val_f1_macro for r in rows), reverse=True)
    data = mdl.model_input(frame).filter("split = 'val'")
    for r in rows:
        loaded = PipelineModel.load(f"{path}/{r.run_id}")
        a, b = (mdl.predict(m, data).select("row_id", "prediction").collect() for m in (models[r.model_name], loaded))
        assert sorted(a) == sorted(b)


def test_baseline_comparison_runs(spark):
    row = catalog.baseline_comparison(spark, SF_SMALL).first()
    assert 0 < row.model_f1 < 1 and 0 < row.rule_f1 < 1 and row.gain_pp == pytest.approx((row.model_f1 - row.rule_f1) * 100)


def test_a_rare_class_keeps_its_rows_in_a_bounded_fit(spark):
    assert mdl.class_quotas({0: 100_000, 1: 900_000, 2: 40}, 100_000) == {0: 9_996, 1: 89_963, 2: 40}
    assert mdl.class_quotas({0: 10_000_000, 1: 10_000}, 100_000) == {0: 98_000, 1: 2_000}
    assert sum(mdl.class_quotas({0: 1000, 1: 7, 2: 5}, 30).values()) <= 30


def test_streamed_model_rows_equal_the_batch_job(spark):
    r = serving.stream_model_scoring(spark, SF_SMALL).first()
    assert r.n_rows > 1000 and r.versions == 1 and r.batches == 2
    assert r.changed == r.bad_sums == r.bad_labels == r.bad_names == 0


def test_unknown_and_null_categories_give_no_indicator(spark):
    from shelfsense.operators import encode as enc
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    df = spark.createDataFrame([(1, "a"), (2, "c"), (3, None), (4, "z")], "n int, k string")
    assert sorted(map(tuple, enc.active_indicators(df, train, ["k"]).select("n", "column", "level").collect())) == [(2, "k", "c")]
    stage, names = enc.indicator_sql(enc.first_dropped_levels(train, ["k"]))
    assert stage.transform(df).select(*names).filter(F.greatest(*names).isNull()).isEmpty()
