from conftest import panel_rows
from shelfsense.config import RiskParams
from shelfsense.operators import features as feat
from shelfsense.operators import labels as lab


def test_precedence_visible_when_thresholds_cross(spark):
    # stock 5 < demand 2 * 3 (stockout) and 5 > 2 * 2 and sold 0 < 2 * 0.8 (overstock)
    df = feat.clean_demand(panel_rows(spark, [("A", "P", 0, 5, 0, 0, 2.0)]))
    p = RiskParams(theta_low=3, theta_high=2)
    over = lab.current_label(df, p, "pipeline").first().risk_label_current
    stock = lab.current_label(df, p, "stage1").first().risk_label_current
    assert over == "Overstock Risk" and stock == "Stockout Risk"


def test_next_day_target_drops_tail(spark):
    rows = [("A", "P", d, 10, 0, 0, 1.0) for d in range(5)]
    df = lab.current_label(feat.clean_demand(panel_rows(spark, rows)), variant="stage1")
    assert lab.next_day_target(df, 1).count() == 4
    assert lab.next_day_target(df, 2).count() == 3


def test_split_and_leakage(spark):
    import datetime as dt
    rows = [("A", "P", d, 10, 0, 0, 1.0) for d in range(3)]
    df = lab.split_column(panel_rows(spark, rows), RiskParams(cutoff_val="2020-01-02", cutoff_test="2020-01-03"))
    assert [r.split for r in df.orderBy("dt").collect()] == ["train", "val", "test"]
    lab.assert_no_leakage(df, RiskParams(cutoff_val="2020-01-02", cutoff_test="2020-01-03"))
    assert dt.date(2020, 1, 1) == df.orderBy("dt").first().dt


def test_train_median_fill(spark):
    df = spark.createDataFrame([("train", 1.0, 4.0), ("train", 3.0, None), ("train", None, 2.0),
                                ("val", None, None)],
                               "split string, days_of_stock double, sales_velocity double")
    out = lab.fill_train_median(df).collect()
    assert out[3].days_of_stock == 2.0 and out[3].sales_velocity == 3.0
