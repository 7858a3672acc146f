"""Risk labels, next-day targets and the temporal split.

Label variants (pick by name, the column names are the same):

* ``reconstructed`` - reconstructed stock vs clipped demand, Overstock written
  last, next-day target (the variant the trained models use).
* ``stage1``  - raw stock vs clipped demand, Stockout wins, next-day target.
* ``pipeline`` - raw stock vs clipped demand, Overstock last, next-day target.
* ``explorer`` - raw stock vs *unclipped* demand, Stockout wins, same day.
* ``ratio``   - coverage / days-of-stock rule on the flat features, same day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfsense.config import (MEDIAN_FILL_COLS, SERIES_KEYS, TIME_COL, RiskParams)
from shelfsense.functions.columns import ratio_label, rule_label
from shelfsense.operators.features import clean_demand

VARIANTS = {
    # name: (stock column, demand column, precedence, next-day shift)
    "reconstructed": ("inventory_reconstructed", "demand_forecast_clean", "overstock", True),
    "stage1": ("inventory_level", "demand_forecast_clean", "stockout", True),
    "pipeline": ("inventory_level", "demand_forecast_clean", "overstock", True),
    "explorer": ("inventory_level", "demand_forecast", "stockout", False),
}


def current_label(df: DataFrame, params: RiskParams = RiskParams(), variant: str = "reconstructed",
                  out: str = "risk_label_current") -> DataFrame:
    if variant == "ratio":
        return df.withColumn(out, ratio_label("coverage_ratio", "days_of_stock"))
    stock, demand, precedence, _ = VARIANTS[variant]
    if demand == "demand_forecast_clean" and demand not in df.columns:
        df = clean_demand(df)
    if variant == "reconstructed":
        precedence = params.precedence
    return df.withColumn(out, rule_label(stock, demand, "units_sold", params.theta_low,
                                         params.theta_high, params.sales_vel, precedence))


def next_day_target(df: DataFrame, drop_tail: int = 1, keys=SERIES_KEYS, order=TIME_COL,
                    src: str = "risk_label_current", out: str = "risk_label") -> DataFrame:
    """Target = tomorrow's current label; the last ``drop_tail`` rows of each
    series have no (repeatable) target and are dropped."""
    w = Window.partitionBy(*keys).orderBy(order)
    df = df.withColumn(out, F.lead(src, 1).over(w))
    if drop_tail <= 1:
        return df.na.drop(subset=[out])
    has_tail = F.lead(F.col(order), drop_tail).over(w).isNotNull()
    return df.withColumn("__keep", has_tail).filter("__keep").drop("__keep")


def label(df: DataFrame, params: RiskParams = RiskParams(), variant: str = "reconstructed") -> DataFrame:
    """Current label and, for shifted variants, the next-day target."""
    df = current_label(df, params, variant)
    if variant in ("explorer", "ratio"):
        return df.withColumn("risk_label", F.col("risk_label_current"))
    return next_day_target(df, params.drop_tail)


def split_column(df: DataFrame, params: RiskParams = RiskParams(), time_col: str = TIME_COL) -> DataFrame:
    """train < cutoff_val <= val < cutoff_test <= test."""
    t = F.col(time_col)
    return df.withColumn(
        "split",
        F.when(t < F.to_date(F.lit(params.cutoff_val)), "train")
         .when(t < F.to_date(F.lit(params.cutoff_test)), "val")
         .otherwise("test"))


def train_medians(df: DataFrame, cols=MEDIAN_FILL_COLS) -> dict[str, float | None]:
    """Exact medians of the train split for the columns that need filling
    (fit step; k numbers reach the driver).

    One cheap aggregate counts the gaps first; the distributed exact-quantile
    pass runs only for columns that have any, over the train rows.
    """
    from shelfsense.operators.stats import exact_quantiles

    gaps = df.agg(*[F.sum((F.col(c).isNull() | F.isnan(c)).cast("long")).alias(c) for c in cols]).first()
    need = [c for c in cols if gaps[c]]
    med = {c: None for c in cols}
    if need:
        train = df.filter(F.col("split") == "train")
        row = exact_quantiles(train, need, [0.5]).collect()
        med.update({c: (row[0][f"{c}_q0"] if row else None) for c in need})
    return med


def fill_train_median(df: DataFrame, cols=MEDIAN_FILL_COLS, medians: dict | None = None) -> DataFrame:
    """Fill nulls with the exact median of the train split, for every split.

    The medians are fitted once (one distributed exact-quantile pass, no
    per-group value buffer) and applied as literals, so the output plan does
    not carry the fitting sub-plan.
    """
    medians = medians if medians is not None else train_medians(df, cols)
    for c in cols:
        if medians.get(c) is not None:
            v = F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(F.col(c))
            df = df.withColumn(c, F.coalesce(v, F.lit(float(medians[c]))))
    return df


def leakage_check(df: DataFrame, params: RiskParams = RiskParams(), time_col: str = TIME_COL) -> DataFrame:
    """Per split: rows, first and last day, and whether it respects the cut-offs.

    Returns one row per split with ``ok``; use :func:`assert_no_leakage` to raise.
    """
    cv, ct = F.to_date(F.lit(params.cutoff_val)), F.to_date(F.lit(params.cutoff_test))
    t = F.col(time_col)
    g = df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"),
                                F.min(t).alias("min_dt"), F.max(t).alias("max_dt"))
    ok = (F.when(F.col("split") == "train", F.col("max_dt") < cv)
          .when(F.col("split") == "val", (F.col("min_dt") >= cv) & (F.col("max_dt") < ct))
          .otherwise(F.col("min_dt") >= ct))
    return g.withColumn("ok", ok)


def assert_no_leakage(df: DataFrame, params: RiskParams = RiskParams()) -> None:
    bad = leakage_check(df, params).filter(~F.col("ok")).limit(1).collect()
    if bad:
        raise AssertionError(f"temporal leakage in split {bad[0]['split']}")
