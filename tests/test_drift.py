import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from shelfsense.operators import drift


def test_half_split_is_exact_across_the_middle_day(spark):
    rows = [(dt.date(2020, 1, 1 + d), f"s{i}") for d in range(3) for i in range(5)]   # 15 rows
    df = spark.createDataFrame(rows, "dt date, s string")
    h = {(r.dt.day, r.s): r.half for r in drift.half_split(df, "dt", ["s"]).collect()}
    ref = sorted(k for k, v in h.items() if v == "reference")
    assert len(ref) == 7 and ref == sorted([(1, f"s{i}") for i in range(5)] + [(2, "s0"), (2, "s1")])


def test_pvalues():
    assert drift.chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)
    assert drift.chi2_sf(0.0, 3) == pytest.approx(1.0)
    assert drift.ks_pvalue(0.0, 100, 100) == 1.0
    assert 0.0 < drift.ks_pvalue(0.2, 100, 100) < 0.05


def test_statistics_on_shifted_sample(spark):
    ref = [float(i % 50) for i in range(2000)]
    cur = [float(i % 50) + 10 for i in range(2000)]
    rows = [(dt.date(2020, 1, 1), i, v) for i, v in enumerate(ref)] + \
           [(dt.date(2020, 1, 2), i, v) for i, v in enumerate(cur)]
    df = spark.createDataFrame(rows, "dt date, i int, x double")
    rep = drift.drift_report(df, ["x"], [], "dt", ["i"]).first()
    # W1 between uniform{0..49} and its shift by 10 is 10; std of the reference
    std = math.sqrt(sum((v - 24.5) ** 2 for v in ref) / len(ref))
    assert rep.stat_test == "wasserstein" and rep.statistic == pytest.approx(10 / std, rel=1e-9)
    assert rep.drift_detected and rep.dataset_drift


def test_half_split_keeps_rows_without_a_day(spark):
    rows = [(None, "a"), (None, "b"), (dt.date(2020, 1, 1), "a"), (dt.date(2020, 1, 1), "b"), (dt.date(2020, 1, 2), "a"),
            (dt.date(2020, 1, 3), "a"), (dt.date(2020, 1, 3), "b")]
    got = drift.half_split(spark.createDataFrame(rows, "dt date, s string"), "dt", ["s"]).collect()
    assert len(got) == 7
    assert sorted((str(r.dt), r.s) for r in got if r.half == "reference") == [("2020-01-01", "a"), ("None", "a"), ("None", "b")]


def test_the_test_is_a_parameter(spark):
    rows = [(dt.date(2020, 1, 1 + i // 200), i, float(i % 40), "y" if i % 10 < (2 if i < 200 else 5) else "n") for i in range(400)]
    df = spark.createDataFrame(rows, "dt date, i int, x double, flag string")
    got = {(r["column"], r.stat_test): r for r in drift.all_statistics(df, ["x"], ["flag"], "dt", ["i"]).collect()}
    assert set(got) == {("x", t) for t in ("ks", "wasserstein", "jensenshannon", "chisquare")} | {
        ("flag", t) for t in ("jensenshannon", "chisquare", "z")}
    z = (0.5 - 0.2) / math.sqrt(0.35 * 0.65 * (1 / 200 + 1 / 200))
    assert got["flag", "z"].statistic == pytest.approx(z) and got["flag", "z"].p_value == pytest.approx(math.erfc(z / math.sqrt(2)))
    assert got["flag", "z"].drift_detected and got["flag", "chisquare"].drift_detected and not got["x", "ks"].drift_detected
    assert got["x", "ks"].statistic == 0 and got["x", "ks"].p_value == 1
    one = drift.statistics_table(df, ["x"], ["flag"], "dt", ["i"], {"flag": "z", "x": "ks"})
    assert {r["column"]: r.stat_test for r in one.collect()} == {"x": "ks", "flag": "z"}
    with pytest.raises(ValueError, match="needs numbers"):
        drift.statistics_table(df, ["x"], ["flag"], "dt", ["i"], {"flag": "ks"})


def test_normal_tail_against_a_table():
    for z, p in ((0.0, 1.0), (1.0, 0.317311), (1.959964, 0.05), (2.575829, 0.01), (-3.290527, 0.001)):
        assert drift.normal_two_sided(z) == pytest.approx(p, abs=1e-6)


def test_a_hot_day_is_numbered_by_ranges(spark):
    df = spark.range(5000).select(F.lit(dt.date(2020, 1, 1)).alias("dt"), (F.col("id") * 7919 % 5003).alias("i")).repartition(6)
    got = drift.half_split(df, "dt", ["i"])
    assert "Window" not in got._jdf.queryExecution().toString()
    ref = sorted(r.i for r in got.filter("half = 'reference'").collect())
    assert ref == sorted(r.i for r in df.collect())[:2500]
    assert drift.half_split(df.limit(0), "dt", ["i"]).count() == 0
