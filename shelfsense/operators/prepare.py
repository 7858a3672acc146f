"""Preprocessing that is saved with the model: typed fields, train medians, known levels.

``RequestPreparer`` is fitted on the train rows and learns the exact median of every numeric
input and the levels of every categorical one. Its model takes requests as they arrive - API names,
text values, gaps - or tables in the model's own column names, and gives the model's input: numbers, gaps
filled with the train medians, categories as text where they are known and as the
``UNKNOWN`` level where they are null or were never seen. As the first stage of a ``PipelineModel`` it makes a
reloaded model accept raw requests and score them as the model in memory does.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsense.config import CATEGORICAL_FEATURES, NUMERICAL_FEATURES, REQUEST_FIELDS
from shelfsense.operators.selection import select_ranks

#: The level of categories that are missing or were not seen in training.
UNKNOWN = "(unknown)"
#: Request field of every model column.
API_NAMES = {ours: api for api, ours, _ in REQUEST_FIELDS}


class _PreparerParams(Params):
    numericCols = Param(Params._dummy(), "numericCols", "numeric inputs", TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "categorical inputs", TypeConverters.toListString)

    def numeric(self) -> list[str]:
        return self.getOrDefault("numericCols")

    def categorical(self) -> list[str]:
        return self.getOrDefault("categoricalCols")


def source(df: DataFrame, column: str) -> Column:
    """The model column, or the request field that feeds it."""
    name = column if column in df.columns else API_NAMES.get(column, column)
    if name not in df.columns:
        raise ValueError(f"neither {column!r} nor its request field is in the table")
    return F.col(f"`{name}`")


def number(c: Column, kind: str = "string") -> Column:
    """A finite number, or null for gaps, text that is none, NaN and infinities. Columns that are numbers aren't read as text."""
    d = c.cast("double") if kind in ("double", "bigint", "int") else F.trim(c.cast("string")).try_cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != float("inf")), d)


def numeric_input(df: DataFrame, column: str) -> Column:
    """The model column (or its request field) as a finite number or null."""
    name = column if column in df.columns else API_NAMES.get(column, column)
    return number(source(df, column), df.schema[name].dataType.simpleString() if name in df.columns else "string")


class RequestPreparer(Estimator, _PreparerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns medians and levels from the rows it is fitted on."""

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None):
        super().__init__()
        self._setDefault(numericCols=list(NUMERICAL_FEATURES), categoricalCols=list(CATEGORICAL_FEATURES))
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> RequestPreparerModel:
        nums, cats = self.numeric(), self.categorical()
        typed = dataset.select(*[numeric_input(dataset, c).alias(c) for c in nums],
                               *[source(dataset, c).cast("string").alias(c) for c in cats])
        found = {r["column"]: r["value"] for r in select_ranks(typed, nums, [0.5]).collect()}   # one row per column
        levels = typed.agg(*[F.sort_array(F.collect_set(c)).alias(c) for c in cats]).first() if cats else None
        model = RequestPreparerModel()
        # A column without any value is filled with 0.
        model._set(medians=[float(found.get(c, 0.0)) for c in nums],
                   levels=[len(levels[c]) for c in cats], levelNames=[v for c in cats for v in levels[c]])
        return self._copyValues(model)


class RequestPreparerModel(Model, _PreparerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Requests to model input; other columns stay, the request fields themselves go."""

    medians = Param(Params._dummy(), "medians", "fill values of the numeric inputs", TypeConverters.toListFloat)
    levels = Param(Params._dummy(), "levels", "how many of levelNames belong to each category", TypeConverters.toListInt)
    levelNames = Param(Params._dummy(), "levelNames", "known levels, category by category", TypeConverters.toListString)

    def known(self) -> dict[str, list[str]]:
        out, at = {}, 0
        for c, n in zip(self.categorical(), self.getOrDefault("levels")):
            out[c], at = self.getOrDefault("levelNames")[at:at + n], at + n
        return out

    def _transform(self, dataset: DataFrame) -> DataFrame:
        nums, known = self.numeric(), self.known()
        new = {c: F.coalesce(numeric_input(dataset, c), F.lit(m)) for c, m in zip(nums, self.getOrDefault("medians"))}
        for c, names in known.items():
            v = source(dataset, c).cast("string")
            new[c] = F.when(v.isin(names), v).otherwise(F.lit(UNKNOWN)) if names else F.lit(UNKNOWN)
        used = {API_NAMES.get(c) for c in new}
        rest = [F.col(f"`{c}`") for c in dataset.columns if c not in new and c not in used]
        return dataset.select(*rest, *[v.alias(c) for c, v in new.items()])


def filled(df: DataFrame) -> Column:
    """How many numeric inputs of a request row are gaps."""
    gaps = [numeric_input(df, c).isNull().cast("int") for c in NUMERICAL_FEATURES]
    return sum(gaps[1:], gaps[0])
