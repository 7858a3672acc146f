import random

from hypothesis import given, settings, strategies as st

from conftest import panel_rows
from shelfsense.operators import features as feat


def loop_balance(levels, sold, ordered):
    inv = [float(levels[0])]
    for i in range(1, len(levels)):
        inv.append(max(inv[-1] - sold[i - 1] + ordered[i - 1], 0.0))
    return inv


def test_balance_matches_sequential_loop_on_random_series(spark):
    rng = random.Random(7)
    rows, expect = [], {}
    for s in range(30):
        n = rng.randint(1, 60)
        lv = [rng.randint(-5, 80) for _ in range(n)]
        so = [rng.randint(0, 40) for _ in range(n)]
        od = [rng.choice([0, 0, 10, 25, 60]) for _ in range(n)]
        exp = loop_balance(lv, so, od)
        for d in range(n):
            rows.append((f"S{s}", "P", d, lv[d], so[d], od[d], 5.0))
            expect[(f"S{s}", d)] = exp[d]
    df = feat.reconstruct_inventory(panel_rows(spark, rows))
    got = {(r.store_id, r.dt.toordinal()): r.inventory_reconstructed for r in df.collect()}
    base = min(k[1] for k in got)
    got = {(k[0], k[1] - base): v for k, v in got.items()}
    assert got == expect


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(-3, 30), st.integers(0, 30), st.integers(0, 30)), min_size=1, max_size=25))
def test_balance_property(spark, series):
    rows = [("S", "P", d, lv, so, od, 1.0) for d, (lv, so, od) in enumerate(series)]
    got = [r.inventory_reconstructed for r in
           feat.reconstruct_inventory(panel_rows(spark, rows)).orderBy("dt").collect()]
    assert got == loop_balance([s[0] for s in series], [s[1] for s in series], [s[2] for s in series])


def test_floor_hit_then_refill_and_negative_first_level(spark):
    rows = [("A", "P", 0, 10, 30, 0, 1.0), ("A", "P", 1, 0, 0, 25, 1.0), ("A", "P", 2, 0, 0, 0, 1.0),
            ("B", "P", 0, -4, 0, 0, 1.0), ("B", "P", 1, 0, 0, 0, 1.0)]
    out = {(r.store_id, r.dt.day): r.inventory_reconstructed
           for r in feat.reconstruct_inventory(panel_rows(spark, rows)).collect()}
    assert out[("A", 1)] == 10.0 and out[("A", 2)] == 0.0 and out[("A", 3)] == 25.0
    assert out[("B", 1)] == -4.0 and out[("B", 2)] == 0.0


def test_short_series_are_dropped_by_the_full_window(spark):
    rows = []
    for name, n in (("n1", 1), ("n7", 7), ("n8", 8), ("n9", 9)):
        rows += [(name, "P", d, 20, 1, 1, 2.0) for d in range(n)]
    counts = {r.store_id: r["count"] for r in
              feat.series_features(panel_rows(spark, rows)).groupBy("store_id").count().collect()}
    assert counts == {"n8": 1, "n9": 2}


def test_feature_guards(spark):
    # sold 0 and demand -5: days of stock falls back to stock / 1; stock 0: ratios 0
    rows = [("A", "P", d, 10, 0, 0, -5.0) for d in range(9)]
    rows += [("Z", "P", 0, 0, 0, 0, 1.0)] + [("Z", "P", d, 0, 3, 3, 1.0) for d in range(1, 9)]
    f = {r.store_id: r for r in feat.series_features(panel_rows(spark, rows)).where("dt = date'2020-01-08'").collect()}
    assert f["A"].days_of_stock == 10.0 and f["A"].demand_forecast_clean == 1.0
    assert f["Z"].sales_velocity == 0.0 and f["Z"].order_to_inventory == 0.0
    assert f["Z"].inventory_change_pct == 0.0


def test_flat_variant_fills_lags_with_self(spark):
    rows = [("A", "P", d, 10 + d, 2, 0, 4.0) for d in range(3)]
    out = feat.flat_features(panel_rows(spark, rows)).orderBy("dt").collect()
    assert out[0].inventory_lag1 == 10.0 and out[0].rolling7_inventory == 10.0
    assert out[2].rolling7_inventory == 11.0 and out[2].order_to_inventory == 4.0 / 12


def test_missing_flow_breaks_the_rest_of_the_series(spark):
    df = panel_rows(spark, [("A", "P", d, 10, 1, 0, 1.0) for d in range(4)])
    from pyspark.sql import functions as F
    df = df.withColumn("units_sold", F.when(F.dayofmonth("dt") == 2, None).otherwise(F.col("units_sold")))
    got = [r.inventory_reconstructed for r in feat.reconstruct_inventory(df).orderBy("dt").collect()]
    assert got == [10.0, 9.0, None, None]
