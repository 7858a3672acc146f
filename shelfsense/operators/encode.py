"""Categorical encoding and scaling.

* ordinal codes in alphabetical order, fitted on train, unseen is an error;
* one-hot with all levels (unknown -> all zeros) for the tree models;
* one-hot with the *first* level dropped (unknown -> all zeros) for the
  linear model, as explicit indicator columns;
* standardisation with the *population* std (Spark's StandardScaler uses the
  sample std), constant column -> divide by 1.

Fitting collects only per-level names (bounded by the cardinality of a
category) or k means/stds to the driver; the transforms are plain column
expressions, wrapped as ``SQLTransformer`` stages so they live in a saved
``PipelineModel``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ordinal_indexer(cols: Sequence[str], suffix: str = "_idx", invalid: str = "error") -> StringIndexer:
    return StringIndexer(inputCols=list(cols), outputCols=[c + suffix for c in cols],
                         stringOrderType="alphabetAsc", handleInvalid=invalid)


def fit_ordinal(train: DataFrame, cols: Sequence[str]):
    """StringIndexerModel with alphabetical codes fitted on ``train`` (on its distinct levels: counts don't matter here)."""
    return ordinal_indexer(cols).fit(train.select(*cols).distinct())


def apply_ordinal(df: DataFrame, model, cols: Sequence[str], suffix: str = "_enc") -> DataFrame:
    """Integer codes ``{c}_enc``; raises on a value unseen at fit time."""
    out = model.transform(df)
    for c in cols:
        out = out.withColumn(c + suffix, F.col(c + "_idx").cast("int")).drop(c + "_idx")
    return out


def onehot_all_levels(cols: Sequence[str]):
    """Stages for one-hot with every train level; unknown -> all-zero vector.

    The indexer puts unknowns in the extra last bucket, which ``dropLast``
    removes, so only train levels get a slot.
    """
    idx = StringIndexer(inputCols=list(cols), outputCols=[c + "_ix" for c in cols],
                        stringOrderType="alphabetAsc", handleInvalid="keep")
    ohe = OneHotEncoder(inputCols=[c + "_ix" for c in cols], outputCols=[c + "_oh" for c in cols],
                        dropLast=True, handleInvalid="error")
    return [idx, ohe], [c + "_oh" for c in cols]


def first_dropped_levels(train: DataFrame, cols: Sequence[str]) -> dict[str, list[str]]:
    """Train levels 2..n of every column, alphabetical (level 1 is dropped)."""
    model = fit_ordinal(train, cols)
    return {c: list(labels)[1:] for c, labels in zip(cols, model.labelsArray)}


def indicator_sql(levels: dict[str, list[str]]) -> tuple[SQLTransformer, list[str]]:
    """0/1 indicator columns for the given levels; anything else, null too, is all zeros."""
    exprs, names = [], []
    for c, vals in levels.items():
        for i, v in enumerate(vals):
            name = f"{c}__oh{i + 1}"
            lit = v.replace("'", "''")
            exprs.append(f"CAST(`{c}` <=> '{lit}' AS DOUBLE) AS `{name}`")
            names.append(name)
    stmt = "SELECT *" + "".join(", " + e for e in exprs) + " FROM __THIS__"
    return SQLTransformer(statement=stmt), names


def fit_population_scaler(train: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Train mean and population std per column (one aggregate, k numbers)."""
    row = train.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                    *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)]).collect()[0]
    out = {}
    for i, c in enumerate(cols):
        s = row[f"s_{i}"]
        out[c] = (float(row[f"m_{i}"]), float(s) if s not in (None, 0.0) else 1.0)
    return out


def scaler_sql(params: dict[str, tuple[float, float]], suffix: str = "_z") -> tuple[SQLTransformer, list[str]]:
    exprs = [f"(CAST(`{c}` AS DOUBLE) - ({m!r})) / ({s!r}) AS `{c}{suffix}`" for c, (m, s) in params.items()]
    return (SQLTransformer(statement="SELECT *, " + ", ".join(exprs) + " FROM __THIS__"),
            [c + suffix for c in params])


def standardize(df: DataFrame, train: DataFrame, cols: Sequence[str], suffix: str = "_z") -> DataFrame:
    """z-scores with train mean / population std, by the stage the models use."""
    stage, _ = scaler_sql(fit_population_scaler(train, cols), suffix)
    return stage.transform(df)


def active_indicators(df: DataFrame, train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long form of the first-level-dropped one-hot: one (column, level) row
    per active indicator, by the stage the models use. Levels: train values; the alphabetically
    first is the dropped reference; unknown and null values activate nothing."""
    levels = first_dropped_levels(train, cols)
    stage, names = indicator_sql(levels)
    # One struct per column, null where nothing is active: plain expressions that Spark compiles, unlike a lambda over all levels.
    told, at = [], 0
    for c, vals in levels.items():
        on = [F.when(F.col(f"`{n}`") == 1.0, F.struct(F.lit(c).alias("column"), F.lit(v).alias("level")))
              for n, v in zip(names[at:], vals)]
        told += [F.coalesce(*on)] if on else []
        at += len(vals)
    if not told:
        told = [F.lit(None).cast("struct<column:string,level:string>")]
    long = stage.transform(df).select(*df.columns, F.explode(F.array(*told)).alias("__p"))
    return long.filter(F.col("__p").isNotNull()).select(*df.columns, "__p.*")
