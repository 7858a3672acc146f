from conftest import SF_SMALL
from shelfsense.operators import profile as prof
from shelfsense.operators import sampling as smp
from shelfsense.plans import base


def test_empty_filter_gives_no_rows(spark):
    df = base.panel(spark, SF_SMALL)
    assert prof.filter_panel(df, [], ["ASIA"], ["S1"]).count() == 0


def test_duplicates_keep_all_copies(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, "y"), (3, "y"), (3, "y")], "a int, b string")
    assert prof.duplicate_rows(df).count() == 5


def test_missing_values_counts_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    r = prof.missing_values(df).first()
    assert r.n_missing == 2


def test_series_sample_exact_size(spark):
    df = base.panel(spark, SF_SMALL)
    n = df.select("store_id", "product_id").distinct().count()
    s = smp.sample_series(df, 0.3, 42)
    assert s.select("store_id", "product_id").distinct().count() == round(0.3 * n)
    assert sorted(map(tuple, s.collect())) == sorted(map(tuple, smp.sample_series(df, 0.3, 42).collect()))
