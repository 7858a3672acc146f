"""Profiling and exploration: shape, distinct values, missing values,
duplicates, value counts, cross tabs, breakdowns, top rows."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfsense.config import CLASS_NAMES, SERIES_KEYS, TIME_COL
from shelfsense.functions.columns import isin_or_false


NUMERIC_TYPES = ("long", "integer", "double", "float", "short", "byte", "decimal")


def columns_of_type(df: DataFrame, kind: str) -> list[str]:
    """Column names by type family: ``numeric``, ``string``, ``boolean``, ``date``."""
    fam = {"numeric": NUMERIC_TYPES, "string": ("string",), "boolean": ("boolean",),
           "date": ("date", "timestamp", "timestamp_ntz")}[kind]
    return [f.name for f in df.schema.fields if f.dataType.typeName() in fam]


def drop_checked(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``drop`` that fails on a missing name (Spark ignores it silently)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*cols)


def head(df: DataFrame, n: int = 5, order: Sequence[str] = (*SERIES_KEYS, TIME_COL)) -> DataFrame:
    """First ``n`` rows under a total order (TakeOrderedAndProject, n rows per task)."""
    return df.orderBy(*order).limit(n)


def shape_summary(df: DataFrame, time_col: str = TIME_COL) -> DataFrame:
    """Rows, first/last day, distinct stores and products, numeric column count."""
    numeric = len(columns_of_type(df, "numeric"))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(time_col).alias("start_dt"),
        F.max(time_col).alias("end_dt"), F.countDistinct("store_id").alias("n_stores"),
        F.countDistinct("product_id").alias("n_products"),
    ).withColumn("n_numeric_cols", F.lit(numeric))


def missing_values(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null (and NaN) count and percent per column, from one aggregate pass."""
    cols = list(cols or df.columns)
    types = dict(df.dtypes)

    def missing(c):
        m = F.col(c).isNull()
        if types[c] in ("double", "float"):
            m = m | F.isnan(c)
        return F.sum(m.cast("long")).alias(c)

    wide = df.agg(F.count(F.lit(1)).alias("__n"), *[missing(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_missing")) for c in cols])
    return (wide.select("__n", F.explode(pairs).alias("p"))
                .select("p.column", "p.n_missing",
                        (F.col("p.n_missing").cast("double") * 100.0 / F.col("__n").cast("double"))
                        .alias("pct_missing")))


def duplicate_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """All copies of rows that occur more than once over ``cols`` (keep=False).

    A grouped count (map-side combined) finds the duplicated keys; a null-safe
    semi join brings back every copy. No window holds a whole group.
    """
    cols = list(cols or df.columns)
    dups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").drop("__n")
    cond = [df[c].eqNullSafe(dups[c]) for c in cols]
    return df.join(dups, cond, "left_semi")


def value_counts(df: DataFrame, col: str, group: Sequence[str] = ()) -> DataFrame:
    """Counts and percent of each non-null value (within ``group``)."""
    g = list(group)
    counts = df.where(F.col(col).isNotNull()).groupBy(*g, col).agg(F.count(F.lit(1)).alias("n"))
    if g:
        total = F.sum("n").over(Window.partitionBy(*g))
        return counts.withColumn("pct", F.col("n").cast("double") * 100.0 / total.cast("double"))
    # no group: the total is a one-row aggregate, never a window over all values
    tot = counts.agg(F.sum("n").alias("__t"))
    return (counts.crossJoin(F.broadcast(tot))
                  .withColumn("pct", F.col("n").cast("double") * 100.0 / F.col("__t").cast("double"))
                  .drop("__t"))


def label_counts(df: DataFrame, label: str = "risk_label", group: Sequence[str] = (),
                 classes: Sequence[str] = CLASS_NAMES) -> DataFrame:
    """One column per class with its count; a class absent from a group is 0."""
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_total"),
        *[F.sum(F.when(F.col(label) == c, 1).otherwise(0)).alias(_slug(c)) for c in classes])


def crosstab(df: DataFrame, row: str | Sequence[str], label: str = "risk_label",
             classes: Sequence[str] = CLASS_NAMES) -> DataFrame:
    """``row`` x class counts (pivot with a fixed value list, zeros kept)."""
    rows = [row] if isinstance(row, str) else list(row)
    return (df.groupBy(*rows).pivot(label, list(classes)).count().na.fill(0, list(classes))
              .select(*rows, *[F.col(f"`{c}`").alias(_slug(c)) for c in classes]))


def subgroup_breakdown(df: DataFrame, by: str, label: str = "risk_label",
                       classes: Sequence[str] = CLASS_NAMES) -> DataFrame:
    """Per group: count and percent of each class within the group."""
    agg = label_counts(df, label, [by], classes)
    out = agg
    for c in classes:
        s = _slug(c)
        out = out.withColumn(f"{s}_pct", F.when(F.col("n_total") > 0,
                                               F.col(s).cast("double") * 100.0 / F.col("n_total")).otherwise(0.0))
    return out


def filter_panel(df: DataFrame, categories: Sequence[str], regions: Sequence[str],
                 stores: Sequence[str] | None = None) -> DataFrame:
    """Three membership filters; an empty selection in any of them gives no rows.

    Without ``stores`` all of them are selected, however many the data has.
    """
    chosen = F.col("store_id").isNotNull() if stores is None else isin_or_false("store_id", stores)
    return df.filter(isin_or_false("category", categories) & isin_or_false("region", regions) & chosen)


def top_recent(df: DataFrame, n: int = 200, cols: Sequence[str] | None = None) -> DataFrame:
    """The ``n`` most recent rows (ties broken by store, product): a
    TakeOrderedAndProject, no global sort."""
    out = df.orderBy(F.col(TIME_COL).desc(), *SERIES_KEYS).limit(n)
    return out.select(*cols) if cols else out


def rows_affected(df: DataFrame) -> DataFrame:
    """Rows with negative demand and with demand below 1."""
    d = F.col("demand_forecast")
    return df.agg(F.sum((d < 0).cast("long")).alias("n_demand_negative"),
                  F.sum((d < 1).cast("long")).alias("n_demand_below_1"),
                  F.count(F.lit(1)).alias("n_rows"))


def reconstruction_summary(df: DataFrame) -> DataFrame:
    """Mean and min of the reconstructed stock and its share of zero days,
    next to the raw level."""
    r = F.col("inventory_reconstructed")
    return df.agg(F.avg("inventory_level").alias("mean_level"),
                  F.avg(r).alias("mean_reconstructed"), F.min(r).alias("min_reconstructed"),
                  (F.sum((r == 0).cast("long")).cast("double") * 100.0 / F.count(F.lit(1)))
                  .alias("pct_zero_reconstructed"))


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact distinct count per column (nulls ignored), long form."""
    wide = df.agg(*[F.countDistinct(c).alias(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_distinct")) for c in cols])
    return wide.select(F.explode(pairs).alias("p")).select("p.*")


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Every distinct non-null value per column as (column, value) rows: a
    distributed distinct, never an array collected into one task."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                      for c in cols])
    return (df.select(F.explode(pairs).alias("p")).select("p.*")
              .where(F.col("value").isNotNull()).distinct())


def _slug(label: str) -> str:
    return label.split()[0].lower()
