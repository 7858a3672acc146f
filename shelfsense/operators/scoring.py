"""Batch scoring under an input contract, label decoding, prediction logs
and cold-start feature rows.

The request contract (16 fields, API names) is checked per row with column
expressions: missing fields fail fast by schema; every numeric field goes
through ``try_cast``; integer fields must be whole numbers; optional range
rules add more checks. Valid rows go to the model, invalid rows to a
quarantine table that names the failing fields. ``mode="reject_batch"``
restores the all-or-nothing rule of a single request.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.config import CLASS_NAMES, REQUEST_FIELDS
from shelfsense.functions.columns import decode_label


class ContractError(ValueError):
    pass


def check_fields(df: DataFrame, fields=REQUEST_FIELDS) -> None:
    missing = [api for api, _, _ in fields if api not in df.columns]
    if missing:
        raise ContractError(f"request table lacks the fields {', '.join(missing)}")


def validate_requests(df: DataFrame, fields=REQUEST_FIELDS, ranges: dict | None = None,
                      keep: Sequence[str] = ()) -> DataFrame:
    """Typed model columns + ``error_columns`` (array of failing API names)
    + ``is_valid``. Input columns may be strings or numbers."""
    check_fields(df, fields)
    ranges = ranges or {}
    typed, errors = [], []
    for api, ours, typ in fields:
        raw = F.col(f"`{api}`")
        if typ == "string":
            val = raw.cast("string")
            bad = val.isNull()
        else:
            d = F.expr(f"try_cast(trim(cast(`{api}` as string)) as double)")
            bad = d.isNull() | F.isnan(d) | (F.abs(d) == float("inf"))
            if typ == "bigint":
                bad = bad | (d != F.floor(d))
                val = F.when(~bad, F.floor(d).cast("bigint"))
            else:
                val = F.when(~bad, d)
        if api in ranges:
            lo, hi = ranges[api]
            bad = bad | (val < lo) | (val > hi)
        typed.append(val.alias(ours))
        errors.append(F.when(bad, F.lit(api)))
    err = F.filter(F.array(*errors), lambda x: x.isNotNull())
    return df.select(*keep, *typed, err.alias("error_columns")) \
             .withColumn("is_valid", F.size("error_columns") == 0)


def split_valid(checked: DataFrame, mode: str = "quarantine"):
    """(valid, quarantine). ``reject_batch`` raises if any row is invalid."""
    valid = checked.filter("is_valid").drop("error_columns", "is_valid")
    bad = checked.filter(~F.col("is_valid"))
    if mode == "reject_batch":
        first = bad.select("error_columns").limit(1).collect()
        if first:
            raise ContractError(f"request rejected, fields out of contract: {', '.join(first[0]['error_columns'])}")
    elif mode != "quarantine":
        raise ValueError(f"unknown mode {mode!r}")
    return valid, bad


def to_request_frame(df: DataFrame, fields=REQUEST_FIELDS, keep: Sequence[str] = ()) -> DataFrame:
    """Model-named columns -> API-named columns (the edge rename)."""
    return df.select(*keep, *[F.col(ours).alias(api) for api, ours, _ in fields])


def decode_predictions(df: DataFrame, code_col: str = "prediction", class_names=CLASS_NAMES,
                       out: str = "prediction_label") -> DataFrame:
    return df.withColumn(out, decode_label(code_col, class_names))


def encode_labels(df: DataFrame, label_col: str, class_names=CLASS_NAMES, out: str = "code") -> DataFrame:
    """Class name -> code by the fixed class order (null when unknown)."""
    names = F.array(*[F.lit(n) for n in class_names])
    return df.withColumn(out, (F.array_position(names, F.col(label_col)) - 1).cast("int")) \
             .withColumn(out, F.when(F.col(out) >= 0, F.col(out)))


def prediction_log(scored: DataFrame, run_id: str, code_col: str = "prediction",
                   fields=REQUEST_FIELDS, keep: Sequence[str] = ()) -> DataFrame:
    """Flat log: request fields (API names) + run id + code + label."""
    out = to_request_frame(scored, fields, keep=list(keep) + [code_col])
    out = (out.withColumn("model_run_id", F.lit(run_id))
              .withColumn("prediction_encoded", F.col(code_col).cast("int"))
              .withColumn("prediction_label", decode_label("prediction_encoded")))
    return out if code_col == "prediction_encoded" else out.drop(code_col)


def round_half_even(c, digits: int):
    """Round the scaled binary value to the nearest whole number, ties to even."""
    c = F.col(c) if isinstance(c, str) else c
    p = float(10 ** digits)
    return F.rint(c * p) / p


def cold_start_rows(snap: DataFrame, cat_levels: dict[str, list[str]] | None = None) -> DataFrame:
    """Full flat-feature rows from an 8-field snapshot (stock, sold, forecast,
    price, competitor price, discount, category, seasonality).

    Lag = 1.1 x stock, sold lag = 0.95 x sold, rolling mean = 1.05 x stock,
    ratios guarded to 0, fixed region North and weather Sunny, holiday 0;
    category codes from ``cat_levels`` (alphabetical), unknown -> 0.
    """
    inv = F.col("inventory_level").cast("double")
    sold = F.col("units_sold").cast("double")
    fore = F.col("demand_forecast").cast("double")
    r = round_half_even
    inv_lag1 = r(inv * 1.1, 2)
    out = snap.select(
        "*",
        inv_lag1.alias("inventory_lag1"),
        r(sold * 0.95, 2).alias("units_sold_lag1"),
        r(inv * 1.05, 2).alias("rolling7_inventory"),
        r(inv - inv_lag1, 2).alias("inventory_change"),
        F.when(inv_lag1 != 0, r(r(inv - inv_lag1, 2) / inv_lag1, 4)).otherwise(0.0).alias("inventory_change_pct"),
        r(inv - r(inv * 1.05, 2), 2).alias("inventory_vs_rolling7"),
        F.when(sold > 0, r(inv / F.when(sold > 0, sold), 2)).otherwise(0.0).alias("days_of_stock"),
        F.when(fore > 0, r(sold / F.when(fore > 0, fore), 3)).otherwise(0.0).alias("sales_velocity"),
        F.when(fore > 0, r(inv / F.when(fore > 0, fore), 3)).otherwise(0.0).alias("coverage_ratio"),
        r(sold - fore, 2).alias("forecast_error"),
        F.when(inv > 0, r(fore / F.when(inv > 0, inv), 3)).otherwise(0.0).alias("order_to_inventory"),
        F.lit("North").alias("region_fixed"), F.lit("Sunny").alias("weather_fixed"),
        F.lit(0).alias("holiday_flag"),
    )
    for c, levels in (cat_levels or {}).items():
        src = {"region": "region_fixed", "weather_condition": "weather_fixed"}.get(c, c)
        names = F.array(*[F.lit(v) for v in levels])
        pos = F.array_position(names, F.col(src))
        out = out.withColumn(f"{c}_enc", F.when(pos > 0, (pos - 1).cast("int")).otherwise(F.lit(0)))
    return out
