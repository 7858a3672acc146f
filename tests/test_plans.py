import re

from conftest import SF_SMALL
from shelfsense.plans import base, catalog


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_and_label_plans_stay_in_the_jvm(spark):
    txt = plan_text(base.labelled(spark, SF_SMALL))
    assert "PythonUDF" not in txt and "BatchEvalPython" not in txt and "ArrowEvalPython" not in txt


def test_one_exchange_feeds_all_series_windows(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        txt = base.features(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # the panel aggregate shuffles once on its group key (after map-side partial
    # aggregation); every window then shares one exchange on the series key
    series = re.compile(r"Exchange hashpartitioning\(store_id#\d+, product_id#\d+, \d+\)")
    assert len(series.findall(txt)) == 1, txt
    assert "Exchange rangepartitioning" not in txt


def test_partition_invariance(spark):
    results = []
    for n in (1, 4, 16):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        results.append(sorted(map(tuple, catalog.risk_share_by_region(spark, SF_SMALL).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] == results[2]


def _shuffles(df):
    import re
    return len(re.findall(r"\bExchange hashpartitioning", df._jdf.queryExecution().executedPlan().toString()))


def test_panel_features_and_target_need_one_shuffle(spark):
    from shelfsense.plans import base
    df = base.labelled(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert _shuffles(df) == 1 and plan.count("+- Window ") <= 5


def test_split_frame_and_drift_rows_are_read_back_not_built_again(spark):
    from shelfsense.plans import base, catalog
    df = base.split_frame(spark, "/root/testdata/sf0.001")
    assert "lineitem" not in "".join(df.inputFiles()) and _shuffles(df) == 0
    want = base.lab.fill_train_median(base.lab.split_column(base.labelled(spark, "/root/testdata/sf0.001")))
    assert df.columns == want.columns and df.exceptAll(want).isEmpty() and want.exceptAll(df).isEmpty()
    z = catalog.standardized_features(spark, "/root/testdata/sf0.001")
    assert _shuffles(z) == 0
