"""Three classifiers on Spark ML, evaluated on all splits in one transform
each, compared and ranked; models saved as ``PipelineModel``.

* logistic: first-level-dropped one-hot + population-std scaling, optional
  SMOTE on the transformed matrix, multinomial logistic regression with
  balanced weights (``regParam = 1 / sum(weights)`` is the L2 strength of a
  C = 1 penalty written per unit weight).
* forest: optional SMOTENC on the raw columns, one-hot with all levels,
  random forest (300 trees, depth 10, leaf >= 10, sqrt features, seed 42).
* boosting: one-hot with all levels, histogram-boosted trees with a softmax
  loss and balanced weights (``booster.SoftmaxBooster``; 300 rounds, depth 6,
  step 0.05, 80 % of rows and features, seed 42).
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack, nullcontext
from dataclasses import dataclass, field, replace
from typing import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.config import CATEGORICAL_FEATURES, CLASS_NAMES, NUMERICAL_FEATURES
from shelfsense.functions.columns import decode_label
from shelfsense.operators import encode as enc
from shelfsense.operators import metrics as met
from shelfsense.operators.booster import SoftmaxBooster
from shelfsense.operators.registry import RunRegistry
from shelfsense.operators.resample import smote
from shelfsense.operators.sampling import lowest_hashes
from shelfsense.operators.selection import held as held_rows
from shelfsense.operators.selection import written


@dataclass(frozen=True)
class ModelSpec:
    name: str
    kind: str                      # logistic | forest | boosting
    params: dict = field(default_factory=dict)
    resample: bool = True
    #: Neighbour search of the resampling: "projected" (linear in the rows) or "exact".
    search: str = "projected"
    #: Labelled rows to fit on at most (every class in proportion, lowest seeded hashes); None: all, as in every query.
    fit_rows: int | None = None


DEFAULT_SPECS = [
    ModelSpec("Logistic Regression", "logistic", {"maxIter": 2000}),
    ModelSpec("Random Forest", "forest", {"numTrees": 300, "maxDepth": 10, "minInstancesPerNode": 10,
                                          "featureSubsetStrategy": "sqrt", "seed": 42}),
    ModelSpec("Boosted trees", "boosting", {"maxIter": 300, "maxDepth": 6, "stepSize": 0.05, "subsample": 0.8,
                                            "colsample": 0.8, "seed": 42}, resample=False),
]
#: The same for trials on at most 100,000 labelled rows; no query uses them.
TRIAL_SPECS = [replace(s, fit_rows=100_000) for s in DEFAULT_SPECS]


def model_input(df: DataFrame, label: str = "risk_label") -> DataFrame:
    """Feature columns + ``label`` code (alphabetical class order) + row id.

    The leakage list is dropped with a presence check first, then the model
    columns are selected in their fixed order.
    """
    from shelfsense.config import DROP_COLS
    from shelfsense.operators.profile import drop_checked

    names = F.array(*[F.lit(n) for n in CLASS_NAMES])
    keyed = df.withColumn("__row_id", F.concat_ws("|", "store_id", "product_id", F.col("dt").cast("string")))
    keyed = keyed.withColumn("__label", F.col(label))
    df = drop_checked(keyed, DROP_COLS).withColumnRenamed("__label", label)
    return df.select(
        F.col("__row_id").alias("row_id"),
        *NUMERICAL_FEATURES, *CATEGORICAL_FEATURES, *([c for c in ("split",) if c in df.columns]),
        (F.array_position(names, F.col(label)) - 1).cast("double").alias("label"))


def with_balanced_weight(train: DataFrame) -> tuple[DataFrame, float]:
    """Balanced class weight per row as a literal map lookup (k classes), and
    the weight total (equal to the row count)."""
    w = met.class_weights(train, "label").collect()      # one row per class
    lookup = F.create_map(*[x for r in w for x in (F.lit(r["label"]), F.lit(float(r["weight"])))])
    total = float(sum(r["n_class"] for r in w))
    return train.withColumn("weight", lookup[F.col("label")]), total


def _fit_logistic(train: DataFrame, spec: ModelSpec) -> PipelineModel:
    levels = enc.first_dropped_levels(train, CATEGORICAL_FEATURES)
    oh, oh_cols = enc.indicator_sql(levels)
    sc, z_cols = enc.scaler_sql(enc.fit_population_scaler(train, NUMERICAL_FEATURES))
    asm = VectorAssembler(inputCols=z_cols + oh_cols, outputCol="features")
    prep = PipelineModel(stages=[oh, sc, asm])
    x = prep.transform(train).select("row_id", "label", "features")
    held = []
    if spec.resample:
        arr = x.select("row_id", "label", vector_to_array("features").alias("fa"))
        x = (smote(arr, "label", ["fa"], id_col="row_id", held=held, search=spec.search)
             .select("row_id", "label", array_to_vector("fa").alias("features")))
    cached = sized_for_fit(x, train)   # weights pass + all optimiser passes
    x, wsum = with_balanced_weight(cached)
    for h in held:                                     # the resampled rows are cached now
        h.unpersist()
    lr = LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight",
                            family="multinomial", standardization=False,
                            regParam=1.0 / wsum, elasticNetParam=0.0,
                            maxIter=spec.params.get("maxIter", 2000),
                            tol=spec.params.get("tol", 1e-6))
    try:
        return PipelineModel(stages=[oh, sc, asm, lr.fit(x)])
    finally:
        cached.unpersist()


#: Bytes of assembled features per partition of a cached training table; small tables still use every core.
FIT_PARTITION_BYTES = 16 << 20


def sized_for_fit(df: DataFrame, raw: DataFrame | None = None) -> DataFrame:
    """The training rows, cached and counted, in a partition per core or as many as their bytes need.

    ``raw`` has the categorical columns where ``df`` has them assembled already."""
    levels = sum(r for r in (df if raw is None else raw).agg(*[F.approx_count_distinct(c) for c in CATEGORICAL_FEATURES]).first())
    size = df.count() * 8 * (len(NUMERICAL_FEATURES) + levels)
    cores = df.sparkSession.sparkContext.defaultParallelism
    out = df.repartition(max(cores, -(-size // FIT_PARTITION_BYTES))).persist(StorageLevel.MEMORY_AND_DISK)
    out.count()
    return out


def _tree_stages():
    stages, oh_cols = enc.onehot_all_levels(CATEGORICAL_FEATURES)
    asm = VectorAssembler(inputCols=list(NUMERICAL_FEATURES) + oh_cols, outputCol="features")
    return stages + [asm]


def _fit_forest(train: DataFrame, spec: ModelSpec) -> PipelineModel:
    x, held = train, []
    if spec.resample:
        x = smote(train.select("row_id", "label", *[F.col(c).cast("double").alias(c) for c in NUMERICAL_FEATURES],
                               *CATEGORICAL_FEATURES),
                  "label", NUMERICAL_FEATURES, CATEGORICAL_FEATURES, id_col="row_id", held=held, search=spec.search)
    x = sized_for_fit(x)   # indexer fit + tree passes
    for h in held:                                 # the resampled rows are cached now
        h.unpersist()
    # maxMemoryInMB only sets how many tree nodes share one pass over the data
    rf = RandomForestClassifier(featuresCol="features", labelCol="label", maxMemoryInMB=1024,
                                cacheNodeIds=True, **spec.params)
    try:
        return Pipeline(stages=_tree_stages() + [rf]).fit(x)
    finally:
        x.unpersist()


def _fit_boosting(train: DataFrame, spec: ModelSpec) -> PipelineModel:
    x, _ = with_balanced_weight(train)   # the rows are held or written: the booster keeps what it needs of them
    booster = SoftmaxBooster(weightCol="weight", idCol="row_id", **spec.params)
    return Pipeline(stages=_tree_stages() + [booster]).fit(x)


FITTERS = {"logistic": _fit_logistic, "forest": _fit_forest, "boosting": _fit_boosting}


#: Rows a class keeps at least in a bounded fit (all, if it has fewer).
CLASS_FLOOR = 2_000


def class_quotas(counts: dict, rows: int, floor: int = CLASS_FLOOR) -> dict:
    """How many rows of every class a sample of ``rows`` has: its share, but at least the floor (all rows of a smaller class).

    The floor is at most half of an equal share, so the bound holds; what small classes get beyond their
    share is taken from what the others have above the floor.
    """
    total, floor = sum(counts.values()), min(floor, rows // (2 * len(counts)))
    share = {c: rows * n // total for c, n in counts.items()}
    quota = {c: max(share[c], min(n, floor)) for c, n in counts.items()}
    over = sum(quota.values()) - rows
    if over > 0:
        spare = {c: max(0, q - floor) for c, q in quota.items()}
        whole = sum(spare.values())
        quota = {c: q - -(-over * spare[c] // whole) for c, q in quota.items()}
    return quota


def bounded_rows(train: DataFrame, rows: int | None, seed: int = 42, floor: int = CLASS_FLOOR) -> DataFrame:
    """All rows, or a stratified seeded sample where there are more than ``rows``.

    Every class keeps at least ``floor`` rows (all if it has fewer); what the floors
    leave of the bound is shared in proportion. So a rare class neither vanishes nor
    falls under what resampling needs.
    """
    if rows is None:
        return train
    counts = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}   # one row per class
    if sum(counts.values()) <= rows:
        return train
    return lowest_hashes(train, "label", class_quotas(counts, rows, floor), seed, ["row_id"])


def fit_input(train: DataFrame, rows: int | None):
    """The rows of a fit, as a context: all of them as they are (they grow with the data, so ``train`` should be a written
    table or held), or a held sample, as a fit reads it many times."""
    return nullcontext(train) if rows is None else held_rows(bounded_rows(train, rows))


def fit(train: DataFrame, spec: ModelSpec) -> PipelineModel:
    with fit_input(train, spec.fit_rows) as rows:
        return FITTERS[spec.kind](rows, spec)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds ``prediction`` (int code) and ``prediction_label``."""
    out = model.transform(df).withColumn("prediction", F.col("prediction").cast("int"))
    return out.withColumn("prediction_label", decode_label("prediction"))


def split_metrics(pred: DataFrame, group: Sequence[str] = ("split",)) -> DataFrame:
    """accuracy / macro P R F1 per split from one transform of all splits."""
    p = pred.withColumn("actual", decode_label(F.col("label").cast("int")))
    # Written: several tables are made of the predictions, which are made once.
    p = written(p.select(*group, "actual", "prediction_label"), "predictions")
    return met.metric_table(p, "actual", "prediction_label", list(group))


def metrics_row(model_name: str, run_id: str, metrics: DataFrame) -> DataFrame:
    """One wide row: model_name, run_id, {split}_{accuracy,precision_macro,...}."""
    names = ["accuracy", "precision_macro", "recall_macro", "f1_macro"]
    wide = metrics.groupBy().pivot("split", ["train", "val", "test"]).agg(
        *[F.first(n).alias(n) for n in names])
    return wide.select(F.lit(model_name).alias("model_name"), F.lit(run_id).alias("run_id"),
                       *[F.col(f"{s}_{n}") for s in ("train", "val", "test") for n in names])


def rank_models(results: DataFrame) -> DataFrame:
    """Best first: val F1, then recall, precision, accuracy (all descending)."""
    return results.orderBy(F.desc("val_f1_macro"), F.desc("val_recall_macro"),
                           F.desc("val_precision_macro"), F.desc("val_accuracy"), "model_name")


def train_and_compare(frame: DataFrame, specs: Sequence[ModelSpec] = TRIAL_SPECS,
                      save_dir: str | None = None, registry: RunRegistry | None = None):
    """Fit each spec on the train split, score all splits once, return
    (ranked metrics table, {name: model}). The fits don't depend on each other
    and run side by side; specs of one bound share one held sample, specs without a bound read all train rows. ``frame`` should be a
    written table: it is read, not kept, as its rows grow with the data. With ``save_dir`` the models are saved under their run ids; with ``registry``
    every run is logged there: parameters, tags, metrics of all splits, place of the model."""
    data = model_input(frame)
    train = data.filter("split = 'train'")
    rows, models = [], {}
    with ExitStack() as stack:
        samples = {n: stack.enter_context(fit_input(train, n)) for n in {s.fit_rows for s in specs}}
        for n, sample in samples.items():
            if n is not None:
                sample.count()
        with ThreadPoolExecutor(len(specs)) as pool:
            fitted = list(pool.map(lambda spec: FITTERS[spec.kind](samples[spec.fit_rows], spec), specs))
        for spec, model in zip(specs, fitted):
            run_id = uuid.uuid4().hex
            table = split_metrics(predict(model, data))
            if registry is not None:
                table = table.sparkSession.createDataFrame(table.collect(), table.schema)   # a row per split, read twice
            rows.append(metrics_row(spec.name, run_id, table))
            models[spec.name] = model
            path = f"{save_dir}/{run_id}" if save_dir else None
            if path:
                model.write().overwrite().save(path)
            if registry is not None:
                registry.log(run_id, spec.name, table, {**spec.params, "n_classes": len(CLASS_NAMES),
                                                        "numerical_features": ",".join(NUMERICAL_FEATURES),
                                                        "categorical_features": ",".join(CATEGORICAL_FEATURES)},
                             {"model_type": spec.kind}, path)
        out = rows[0]
        for r in rows[1:]:
            out = out.unionByName(r)
        ranked = rank_models(out).cache()
        ranked.count()
    return ranked, models
