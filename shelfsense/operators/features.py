"""Per-series window features.

All windows share one specification, partition by (store, product) ordered by
day, so Spark plans a single ``Exchange hashpartitioning(store_id,
product_id)`` and one sort that feeds every ``Window`` node. The panel holds
one row per series and day (duplicates are merged on read), so a window
partition is bounded by the number of days in the data, however large the
table grows; the work spreads over the number of series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfsense.config import SERIES_KEYS, TIME_COL
from shelfsense.functions.columns import clip_lower, safe_div


def series_window(keys=SERIES_KEYS, order=TIME_COL):
    return Window.partitionBy(*keys).orderBy(order)


def clean_demand(df: DataFrame) -> DataFrame:
    """``demand_forecast_clean`` = demand forecast clipped below at 1."""
    return df.withColumn("demand_forecast_clean", clip_lower("demand_forecast", 1))


def reconstruct_inventory(df: DataFrame, level: str = "inventory_level", sold: str = "units_sold",
                          ordered: str = "units_ordered", out: str = "inventory_reconstructed",
                          keys=SERIES_KEYS, order=TIME_COL) -> DataFrame:
    """Running stock balance floored at zero, without a sequential loop.

    inv_0 = first level; inv_t = max(inv_{t-1} - sold_{t-1} + ordered_{t-1}, 0).
    With cum_t = inv_0 + sum_{i<t}(ordered_i - sold_i) the recurrence has the
    closed form inv_t = cum_t - least(0, min_{1<=k<=t} cum_k) for t >= 1, so
    two running window aggregates over one sort replace the loop. Integer
    inputs keep ``cum`` exact in ``bigint``.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    delta = (F.col(ordered) - F.col(sold)).cast("bigint")
    tmp_rn, tmp_cum, tmp_gap = "__rn", "__cum", "__gap"
    # A missing flow breaks the running balance for the rest of the series
    # (the sequential loop turns into NaN from there on); sum() would skip it.
    gap = F.sum(F.when(delta.isNull(), 1).otherwise(0)).over(before)
    # One select: what doesn't depend on another window result is computed in one pass over the sorted rows.
    first = df.select(
        "*", F.coalesce(gap, F.lit(0)).alias(tmp_gap), F.row_number().over(w).alias(tmp_rn),
        (F.first(F.col(level).cast("bigint")).over(upto)
         + F.coalesce(F.sum(delta).over(before), F.lit(0).cast("bigint"))).alias(tmp_cum))
    out_df = (first
              .withColumn(out, F.when(F.col(tmp_rn) == 1, F.col(level).cast("bigint"))
                          .otherwise(F.col(tmp_cum) - F.least(
                              F.lit(0).cast("bigint"),
                              F.min(F.when(F.col(tmp_rn) > 1, F.col(tmp_cum))).over(upto)))
                          .cast("double"))
              .withColumn(out, F.when(F.col(tmp_gap) == 0, F.col(out)))
              .drop(tmp_rn, tmp_cum, tmp_gap))
    return out_df


def series_features(df: DataFrame, keys=SERIES_KEYS, order=TIME_COL,
                    drop_incomplete: bool = True) -> DataFrame:
    """The eleven per-series features (variant ``series``).

    Lags and the trailing 7-row mean look only at earlier rows of the same
    series; the first 7 rows of every series have no full window and are
    dropped when ``drop_incomplete``.
    """
    if "demand_forecast_clean" not in df.columns:
        df = clean_demand(df)
    if "inventory_reconstructed" not in df.columns:
        df = reconstruct_inventory(df, keys=keys, order=order)
    w = Window.partitionBy(*keys).orderBy(order)
    prev7 = w.rowsBetween(-7, -1)
    inv = F.col("inventory_reconstructed")
    inv_long = inv.cast("bigint")
    out = (df
           .select("*", F.lag(inv, 1).over(w).alias("inventory_lag1"),
                   F.lag(F.col("units_sold").cast("double"), 1).over(w).alias("units_sold_lag1"),
                   F.when(F.count(inv_long).over(prev7) == 7, F.avg(inv_long).over(prev7)).alias("rolling7_inventory"))
           .withColumn("inventory_change", inv - F.col("inventory_lag1"))
           .withColumn("inventory_change_pct", safe_div("inventory_change", "inventory_lag1", 0.0))
           .withColumn("days_of_stock", F.coalesce(
               safe_div(inv, "units_sold"), inv / F.col("demand_forecast_clean")))
           .withColumn("inventory_vs_rolling7", inv - F.col("rolling7_inventory"))
           .withColumn("sales_velocity", safe_div("units_sold", inv, 0.0))
           .withColumn("coverage_ratio", inv / F.col("demand_forecast_clean"))
           .withColumn("forecast_error", F.col("units_sold") - F.col("demand_forecast"))
           .withColumn("order_to_inventory", safe_div("units_ordered", inv, 0.0)))
    if drop_incomplete:
        out = out.na.drop(subset=["inventory_lag1", "rolling7_inventory"])
    return out


def flat_features(df: DataFrame, keys=SERIES_KEYS, order=TIME_COL) -> DataFrame:
    """Feature variant ``flat`` of the interactive predictor, built per series.

    Raw stock and raw (unclipped) demand; lags filled with the current value;
    rolling mean over the current and 6 earlier rows with partial windows;
    every division gap becomes 0; velocity and order ratio are taken against
    the forecast. Built per series (an unpartitioned window would be a single
    task and depend on file order).
    """
    w = Window.partitionBy(*keys).orderBy(order)
    inv = F.col("inventory_level").cast("double")
    sold = F.col("units_sold").cast("double")
    fore = F.col("demand_forecast")
    return (df
            .withColumn("inventory_lag1", F.coalesce(F.lag(inv, 1).over(w), inv))
            .withColumn("units_sold_lag1", F.coalesce(F.lag(sold, 1).over(w), sold))
            .withColumn("rolling7_inventory",
                        F.avg(F.col("inventory_level")).over(w.rowsBetween(-6, Window.currentRow)))
            .withColumn("inventory_change", inv - F.col("inventory_lag1"))
            .withColumn("inventory_change_pct", safe_div("inventory_change", "inventory_lag1", 0.0))
            .withColumn("inventory_vs_rolling7", inv - F.col("rolling7_inventory"))
            .withColumn("days_of_stock", safe_div(inv, sold, 0.0))
            .withColumn("sales_velocity", safe_div(sold, fore, 0.0))
            .withColumn("coverage_ratio", safe_div(inv, fore, 0.0))
            .withColumn("forecast_error", sold - fore)
            .withColumn("order_to_inventory", safe_div(fore, inv, 0.0)))


def inv_demand_ratio(df: DataFrame) -> DataFrame:
    """Stock over clipped demand (raw stock)."""
    if "demand_forecast_clean" not in df.columns:
        df = clean_demand(df)
    return df.withColumn("inv_demand_ratio",
                         F.col("inventory_level") / F.col("demand_forecast_clean"))
