"""Classification metric algebra on Spark: class weights, confusion matrix
over a fixed class list, row-normalised matrix, per-class precision / recall
/ F1 / support, accuracy, macro and weighted averages (zero division -> 0).

Everything is derived from the long confusion table (group..., actual,
predicted, n): a grouped count with map-side combine, so the input size only
matters for that one aggregate.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfsense.config import CLASS_NAMES


def class_frame(spark: SparkSession, classes: Sequence[str] = CLASS_NAMES, name: str = "cls") -> DataFrame:
    return spark.createDataFrame([(i, c) for i, c in enumerate(classes)], f"{name}_code int, {name} string")


def class_weights(df: DataFrame, label: str = "risk_label", group: Sequence[str] = ()) -> DataFrame:
    """Balanced weights n / (k * n_c), k = classes present."""
    g = list(group)
    counts = df.groupBy(*g, label).agg(F.count(F.lit(1)).alias("n_class"))
    w = Window.partitionBy(*g)
    return (counts
            .withColumn("n_total", F.sum("n_class").over(w))
            .withColumn("k", F.count(F.lit(1)).over(w))
            .withColumn("weight", F.col("n_total").cast("double")
                        / (F.col("k").cast("double") * F.col("n_class").cast("double"))))


def with_class_weight(df: DataFrame, weights: DataFrame, label: str = "risk_label",
                      out: str = "weight") -> DataFrame:
    """Attach each row's class weight (a k-row table, broadcast)."""
    return df.join(F.broadcast(weights.select(label, F.col("weight").alias(out))), label, "left")


def confusion(df: DataFrame, actual: str, predicted: str, group: Sequence[str] = (),
              classes: Sequence[str] = CLASS_NAMES) -> DataFrame:
    """(group..., actual, predicted, n) over the full class x class grid."""
    g = list(group)
    spark = df.sparkSession
    counts = (df.groupBy(*g, F.col(actual).alias("actual"), F.col(predicted).alias("predicted"))
                .agg(F.count(F.lit(1)).alias("n")))
    grid = (class_frame(spark, classes, "actual").select("actual")
            .crossJoin(class_frame(spark, classes, "predicted").select("predicted")))
    if g:
        grid = df.select(*g).distinct().crossJoin(F.broadcast(grid))
    return (grid.join(counts, g + ["actual", "predicted"], "left")
                .select(*g, "actual", "predicted", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def normalise_rows(conf: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Share of each actual class going to each prediction; empty row -> 0."""
    tot = F.sum("n").over(Window.partitionBy(*group, "actual"))
    return conf.withColumn("share", F.coalesce(F.col("n").cast("double") / F.nullif(tot, F.lit(0)).cast("double"),
                                               F.lit(0.0)))


def per_class(conf: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """precision, recall, f1, support per (group, class) from the confusion table."""
    g = list(group)
    as_actual = conf.groupBy(*g, F.col("actual").alias("cls")).agg(
        F.sum("n").alias("support"),
        F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)).alias("tp"))
    as_pred = conf.groupBy(*g, F.col("predicted").alias("cls")).agg(F.sum("n").alias("n_pred"))
    j = as_actual.join(as_pred, g + ["cls"], "full").na.fill(0, ["support", "tp", "n_pred"])
    d = lambda a, b: F.coalesce(F.col(a).cast("double") / F.nullif(F.col(b), F.lit(0)).cast("double"),
                                F.lit(0.0))
    return j.select(
        *g, "cls", "support", "tp", "n_pred",
        d("tp", "n_pred").alias("precision"), d("tp", "support").alias("recall"),
        F.coalesce((2.0 * F.col("tp").cast("double"))
                   / F.nullif(F.col("support") + F.col("n_pred"), F.lit(0)).cast("double"),
                   F.lit(0.0)).alias("f1"))


def summary(conf: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """accuracy, macro and weighted precision / recall / F1 per group."""
    g = list(group)
    pc = per_class(conf, g)
    sup = F.col("support").cast("double")
    return pc.groupBy(*g).agg(
        (F.sum("tp").cast("double") / F.sum("support").cast("double")).alias("accuracy"),
        F.avg("precision").alias("precision_macro"), F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"),
        (F.sum(F.col("precision") * sup) / F.sum(sup)).alias("precision_weighted"),
        (F.sum(F.col("recall") * sup) / F.sum(sup)).alias("recall_weighted"),
        (F.sum(F.col("f1") * sup) / F.sum(sup)).alias("f1_weighted"),
        F.sum("support").alias("n_rows"))


def metric_table(pred: DataFrame, actual: str, predicted: str, group: Sequence[str] = (),
                 classes: Sequence[str] = CLASS_NAMES) -> DataFrame:
    return summary(confusion(pred, actual, predicted, group, classes), group)
