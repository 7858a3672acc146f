"""Run registry: parameters, tags, metrics and the saved model of every training run.

One folder per run, so logging a run again replaces it and adds nothing. A run is one
row per (split, metric) with its model name, its parameters and tags as maps, and the path of its
saved model. The best run is looked up in the table, and its model is loaded from there.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

RUNS = ("model string, params map<string,string>, tags map<string,string>, split string, metric string, value double, "
        "artifact string, run_id string")
METRICS = ("accuracy", "precision_macro", "recall_macro", "f1_macro")
#: Best first: by validation F1, then recall, precision, accuracy.
ORDER = (("val", "f1_macro"), ("val", "recall_macro"), ("val", "precision_macro"), ("val", "accuracy"))


class RunRegistry:
    """Runs under one folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def log(self, run_id: str, model: str, metrics: DataFrame, params: Mapping = (), tags: Mapping = (),
            artifact: str | None = None, names: Sequence[str] = METRICS) -> None:
        """Write a run from a table of metrics, one row per split and one column per metric."""
        def text_map(d):
            pairs = [x for k, v in sorted(dict(d).items()) for x in (F.lit(str(k)), F.lit(str(v)))]
            return F.create_map(*pairs) if pairs else F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))

        values = F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names]))
        rows = metrics.select("split", values.alias("m")).select(
            F.lit(model).alias("model"), text_map(params).alias("params"), text_map(tags).alias("tags"), "split", "m.metric",
            "m.value", F.lit(artifact).cast("string").alias("artifact"))
        # A run has a handful of rows: one file.
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/run_id={run_id}")

    def runs(self) -> DataFrame:
        """One row per run, split and metric."""
        return self.spark.read.schema(RUNS).parquet(self.folder)

    def wide(self) -> DataFrame:
        """One row per run: ``{split}_{metric}`` columns."""
        pick = [F.max(F.when((F.col("split") == s) & (F.col("metric") == m), F.col("value"))).alias(f"{s}_{m}")
                for s in ("train", "val", "test") for m in METRICS]
        return self.runs().groupBy("run_id", "model", "artifact").agg(*pick)

    def best(self, order: Sequence[tuple[str, str]] = ORDER) -> Row:
        """The best run by ``order`` (descending; ties by model name, then run id)."""
        keys = [F.desc_nulls_last(f"{s}_{m}") for s, m in order]
        row = self.wide().orderBy(*keys, "model", "run_id").first()
        if row is None:
            raise ValueError("the registry has no runs")
        return row

    def load(self, run_id: str) -> PipelineModel:
        """The saved model of a run."""
        path = self.runs().filter((F.col("run_id") == run_id) & F.col("artifact").isNotNull()).select("artifact").first()
        if path is None:
            raise ValueError(f"run {run_id!r} has no saved model")
        return PipelineModel.load(path[0])
