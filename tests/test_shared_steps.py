"""Steps that many queries share: rows are built once, ranks and moments don't take rows apart, numbers aren't read as text."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfsense.operators import booster as bst
from shelfsense.operators import models, selection, stats
from shelfsense.operators.prepare import RequestPreparer
from shelfsense.operators.resample import smote
from shelfsense.session import scratch_path
from shelfsense.streaming import jobs


def never(*args, **kw):
    raise AssertionError("the rows are taken apart")


def test_ranks_without_groups_come_from_batches(spark, monkeypatch):
    values = [1e300, -1e300, 0.0, -0.0, 5.0, 5.0, 5.0, None, float("nan"), 1e-300, 7.25, -3.0]
    df = spark.createDataFrame([(v, 1.5) for v in values], "x double, same double").repartition(3)
    monkeypatch.setattr(selection, "to_long", never)
    got = {(r["column"], r.prob): r.value for r in selection.select_ranks(df, ["x", "same"], [0.0, 0.3, 0.5, 1.0]).collect()}
    own = [v for v in values if v is not None and v == v]
    for p in (0.0, 0.3, 0.5, 1.0):
        assert got["x", p] == pytest.approx(np.percentile(own, p * 100)) and got["same", p] == 1.5
    assert selection.select_ranks(df.limit(0), ["x"], [0.5]).isEmpty()
    assert selection.select_ranks(df, ["x"], [0.5], rank_of=lambda n, p: n * 0 + 99).isEmpty()


def test_moments_of_all_columns_come_from_whole_rows(spark, monkeypatch):
    df = spark.createDataFrame([(1.0, None), (3.0, float("nan")), (8.0, None)], "x double, gaps double")
    monkeypatch.setattr(stats, "to_long", never)
    got = {r["column"]: r for r in stats.describe(df, ["x", "gaps"]).collect()}
    assert (got["x"]["count"], got["x"]["mean"], got["x"]["p50"], got["x"]["max"]) == (3, 4.0, 3.0, 8.0)
    assert got["gaps"]["count"] == 0 and got["gaps"]["p50"] is None
    assert stats.describe(df.limit(0), ["x"]).isEmpty()


def test_numbers_are_not_read_as_text(spark):
    df = spark.createDataFrame([(1.0, 2), (float("nan"), None), (float("inf"), 4)], "x double, n bigint")
    model = RequestPreparer(numericCols=["x", "n"], categoricalCols=[]).fit(df)
    out = model.transform(df)
    assert "trim" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, out.collect())) == [(1.0, 2.0), (1.0, 3.0), (1.0, 4.0)]


def counting(spark, rows, schema):
    """A table and how often one of its rows was built."""
    seen = spark.sparkContext.accumulator(0)

    def look(r):
        seen.add(1)
        return r

    return spark.createDataFrame(spark.sparkContext.parallelize(rows, 3).map(look), schema), seen


def test_events_are_built_once(spark):
    rows = [(dt.datetime(2020, 1, 1 + i % 20), "a") for i in range(60)]
    events, seen = counting(spark, rows, "event_time timestamp, prediction_label string")
    path = scratch_path(spark, "events")
    assert jobs.write_in_time_order(events, path, "event_time", 4) == 1
    assert seen.value == 60 and spark.read.parquet(path).count() == 60


def test_predictions_are_made_once_for_all_metrics(spark):
    pred, seen = counting(spark, [("train", 1.0, models.CLASS_NAMES[1])] * 5, "split string, label double, prediction_label string")
    assert models.split_metrics(pred).first()["accuracy"] == 1.0
    assert seen.value == 5


def test_fits_of_one_bound_share_a_sample(spark, monkeypatch):
    calls = []

    def stop(train, spec):
        raise RuntimeError("fitted")

    monkeypatch.setattr(models, "model_input", lambda frame: frame)
    monkeypatch.setattr(models, "bounded_rows", lambda train, n, *a: calls.append(n) or train)
    monkeypatch.setattr(models, "FITTERS", dict.fromkeys(models.FITTERS, stop))
    frame = spark.createDataFrame([("train", 0.0)], "split string, label double")
    with pytest.raises(RuntimeError, match="fitted"):
        models.train_and_compare(frame)
    assert calls == [100_000]


def test_scored_trees_are_complete(spark):
    """Leaves above the last level are drawn down to it, so that scoring takes the same steps for every row."""
    t = bst.Tree.empty(2)
    t.feature[0], t.cut[0], t.value[1], t.value[2] = 0, 0, -1.0, 0.5
    t.feature[2], t.cut[2], t.value[5], t.value[6] = 1, 1, 2.0, 3.0
    model = bst.SoftmaxBoosterModel([np.array([1.5]), np.array([0.5, 2.5])], [[t, bst.Tree.empty(2)]], 2)
    _, node, value, _, _ = model._arrays()
    assert (node[:, :3] >= 0).all() and value[0, 3:].tolist() == [-1.0, 0.0, 2.0, 3.0]
    df = spark.createDataFrame([(1.0, 9.0), (2.0, 0.0), (2.0, 3.0)], "x double, y double")
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    rows = model.transform(VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(df)).select(
        vector_to_array("probability").alias("p")).collect()
    assert [r.p[0] for r in rows] == pytest.approx([1 / (1 + np.exp(-s)) for s in (-1.0, 2.0, 3.0)])


def test_neighbours_categories_are_not_taken_apart(spark):
    rows = [(f"a{i}", "a", float(i), "u", None) for i in range(30)]
    rows += [(f"b{i}", "b", float(i), "v" if i % 3 else "w", None if i % 3 else "z") for i in range(12)]
    df = spark.createDataFrame(rows, "row_id string, label string, x double, k string, l string")
    out = smote(df, "label", ["x"], ["k", "l"], id_col="row_id")
    assert "__kv" not in out._jdf.queryExecution().optimizedPlan().toString()
    syn = out.filter("synthetic")
    assert syn.count() == 18 and {(r.k, r.l) for r in syn.collect()} == {("v", None)}
    assert syn.filter(F.col("x") > 11).isEmpty()


def test_split_frame_writes_only_the_columns_asked_for(spark):
    from shelfsense.plans import base
    whole = base.split_frame(spark, "/root/testdata/sf0.001")
    cols = ["store_id", "product_id", "dt", "split", "region", "days_of_stock", "sales_velocity"]
    some = base.split_frame(spark, "/root/testdata/sf0.001", columns=["region"])
    assert some.columns == cols and spark.read.parquet(*some.inputFiles()).columns == cols
    assert sorted(some.collect()) == sorted(whole.select(*cols).collect())


def test_active_indicators_of_two_columns_are_compiled(spark):
    from shelfsense.operators import encode as enc
    rows = [(1, "a", "x"), (2, "b", "x"), (3, "c", None), (4, None, "y"), (5, "new", "y")]
    df = spark.createDataFrame(rows, "n int, k string, m string")
    got = enc.active_indicators(df, df.filter("n in (1, 2, 4) and k is not null or m = 'y' and k = 'new'"), ["k", "m"])
    assert sorted(map(tuple, got.select("n", "column", "level").collect())) == [
        (2, "k", "b"), (4, "m", "y"), (5, "k", "new"), (5, "m", "y")]
    assert "lambdafunction" not in got._jdf.queryExecution().toString()
    one = df.filter("n = 1")
    assert enc.active_indicators(df, one, ["k", "m"]).collect() == []
