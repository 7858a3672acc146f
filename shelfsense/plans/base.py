"""Shared plan prefixes: panel -> features -> labels -> split."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession

from shelfsense.config import MEDIAN_FILL_COLS, SERIES_KEYS, TIME_COL, RiskParams
from shelfsense.operators import features as feat
from shelfsense.operators import labels as lab
from shelfsense.operators.selection import written
from shelfsense.sources.tables import retail_daily


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail_daily(spark, sf_dir)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.series_features(panel(spark, sf_dir))


def labelled(spark: SparkSession, sf_dir: str, params: RiskParams = RiskParams(),
             variant: str = "reconstructed") -> DataFrame:
    return lab.label(features(spark, sf_dir), params, variant)


def split_frame(spark: SparkSession, sf_dir: str, params: RiskParams = RiskParams(),
                columns: Sequence[str] | None = None) -> DataFrame:
    """Labelled rows with ``split`` and train-median fills (modelling input).

    Written once: medians, encoders, scalers, fits and the result itself read the written
    rows, and none of them builds panel and windows again. With ``columns`` only these are written, beside
    the keys, ``split`` and the columns that are filled."""
    df = lab.split_column(labelled(spark, sf_dir, params), params)
    if columns is not None:
        df = df.select(*dict.fromkeys([*SERIES_KEYS, TIME_COL, "split", *columns, *MEDIAN_FILL_COLS]))
    return lab.fill_train_median(written(df, "split-frame"))
