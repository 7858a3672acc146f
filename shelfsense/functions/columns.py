"""Column expressions shared by the operators (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfsense.config import CLASS_NAMES, OVERSTOCK, SAFE, STOCKOUT


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip_lower(c, lower: float) -> Column:
    """``clip(lower=...)`` that keeps nulls null (``greatest`` would not)."""
    c = _c(c)
    return F.when(c < lower, F.lit(float(lower))).otherwise(c.cast("double"))


def clip_upper(c, upper: float) -> Column:
    c = _c(c)
    return F.when(c > upper, F.lit(float(upper))).otherwise(c.cast("double"))


def clip_between(c, lower: float, upper: float) -> Column:
    return clip_upper(clip_lower(c, lower), upper)


def safe_div(num, den, fill=None) -> Column:
    """``num / den`` with a zero denominator treated as missing; optional fill.

    Spark 4 runs with ANSI mode on, where a double divided by zero raises, so
    the zero is turned into null before dividing.
    """
    q = _c(num).cast("double") / F.nullif(_c(den).cast("double"), F.lit(0.0))
    return q if fill is None else F.coalesce(q, fill if isinstance(fill, Column) else F.lit(float(fill)))


def nan_to_null(c) -> Column:
    """NaN is a value in Spark (sorted highest, poisons avg); make it null."""
    c = _c(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def isin_or_false(c, values: Iterable) -> Column:
    """Membership; an empty selection matches no row."""
    values = list(values)
    return _c(c).isin(values) if values else F.lit(False)


def rule_label(stock, demand, sold, theta_low: float, theta_high: float,
               sales_vel: float, precedence: str = "overstock") -> Column:
    """Three-class threshold rule.

    Stockout when stock < demand * theta_low; Overstock when stock >
    demand * theta_high and sold < demand * sales_vel; else Safe. When both
    hold, ``precedence`` decides.
    """
    stock, demand, sold = _c(stock), _c(demand), _c(sold)
    is_stockout = stock < demand * F.lit(float(theta_low))
    is_overstock = (stock > demand * F.lit(float(theta_high))) & (sold < demand * F.lit(float(sales_vel)))
    if precedence == "overstock":
        return F.when(is_overstock, OVERSTOCK).when(is_stockout, STOCKOUT).otherwise(SAFE)
    if precedence == "stockout":
        return F.when(is_stockout, STOCKOUT).when(is_overstock, OVERSTOCK).otherwise(SAFE)
    raise ValueError(f"precedence must be 'overstock' or 'stockout', got {precedence!r}")


def ratio_label(coverage, days_of_stock) -> Column:
    """Coverage / days-of-stock rule; first matching condition wins."""
    cov, dos = _c(coverage), _c(days_of_stock)
    return (F.when((cov < 0.2) | (dos < 3), STOCKOUT)
            .when((cov > 2.0) & (dos > 30), OVERSTOCK)
            .otherwise(SAFE))


def decode_label(code, class_names=CLASS_NAMES) -> Column:
    """Code -> class name; a code outside the list becomes its own text."""
    code = _c(code)
    names = F.array(*[F.lit(n) for n in class_names])
    in_range = (code >= 0) & (code < len(class_names))
    return F.when(in_range, F.element_at(names, (code + 1).cast("int"))).otherwise(code.cast("string"))
