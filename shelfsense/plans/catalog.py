"""Registered queries: name -> f(spark, sf_dir) -> DataFrame.

Every query reads the driver tables (through the daily panel Spark derives
from them) over their whole extent.
"""

from __future__ import annotations

from typing import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfsense.config import (CATEGORICAL_FEATURES, CLASS_NAMES, MONITOR_NUMERIC, NUMERICAL_FEATURES,
                               REQUEST_FIELDS, SCENARIOS, SERIES_KEYS, RiskParams)
from shelfsense.functions.columns import decode_label, ratio_label
from shelfsense.operators import drift as drf
from shelfsense.operators import encode as enc
from shelfsense.operators import features as feat
from shelfsense.operators import labels as lab
from shelfsense.operators import metrics as met
from shelfsense.operators import models as mdl
from shelfsense.operators import profile as prof
from shelfsense.operators import sampling as smp
from shelfsense.operators import scoring as scr
from shelfsense.operators.registry import RunRegistry
from shelfsense.operators import stats
from shelfsense.operators.selection import written
from shelfsense.plans import base
from shelfsense.session import scratch_path
from shelfsense.sources import files as io
from shelfsense.streaming import jobs as stream

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


def _share(df: DataFrame, group: list[str], label: str = "risk_label") -> DataFrame:
    """Count per (group, label) and percent within the group."""
    counts = df.groupBy(*group, label).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(*group)) if group else F.sum("n").over(Window.partitionBy())
    return counts.withColumn("pct", F.col("n").cast("double") * 100.0 / total.cast("double"))


# --- minimum slice ------------------------------------------------------------

@query("risk_share_by_region")
def risk_share_by_region(spark, sf_dir):
    """Share of next-day risk classes by region (scan, joins, both window
    kinds, CASE, aggregation)."""
    return _share(base.labelled(spark, sf_dir), ["region"])


# --- sources / panel ----------------------------------------------------------

@query("retail_daily")
def retail_daily_q(spark, sf_dir):
    return base.panel(spark, sf_dir)


# --- features -----------------------------------------------------------------

@query("features_series")
def features_series(spark, sf_dir):
    return base.features(spark, sf_dir)


@query("labels_reconstructed")
def labels_reconstructed(spark, sf_dir):
    return base.labelled(spark, sf_dir).select(
        "store_id", "product_id", "dt", "risk_label_current", "risk_label")


# --- helpers --------------------------------------------------------------------


FEATURE_11 = ["inventory_lag1", "units_sold_lag1", "rolling7_inventory", "inventory_change",
              "inventory_change_pct", "days_of_stock", "inventory_vs_rolling7", "sales_velocity",
              "coverage_ratio", "forecast_error", "order_to_inventory"]
KEYS = SERIES_KEYS + ["dt"]


def r6(c):
    """Round a float result whose last bits depend on summation order."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _round_cols(df: DataFrame, cols) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, r6(c))
    return df


# --- label variants ---------------------------------------------------------------

@query("labels_stage1")
def labels_stage1(spark, sf_dir):
    """Raw stock, clipped demand, Stockout wins, next-day target (no feature drop)."""
    df = lab.label(feat.clean_demand(base.panel(spark, sf_dir)), variant="stage1")
    return df.select(*KEYS, "risk_label_current", "risk_label")


@query("labels_pipeline")
def labels_pipeline(spark, sf_dir):
    """Raw stock, clipped demand, Overstock written last, after the feature drop."""
    df = lab.label(base.features(spark, sf_dir), variant="pipeline")
    return df.select(*KEYS, "risk_label_current", "risk_label")


@query("labels_explorer")
def labels_explorer(spark, sf_dir):
    """Raw stock vs unclipped demand, Stockout first, same-day label."""
    df = lab.label(base.panel(spark, sf_dir), variant="explorer")
    return df.select(*KEYS, "risk_label")


@query("labels_reconstructed_tail2")
def labels_reconstructed_tail2(spark, sf_dir):
    """The doubled next-day shift: the last two rows of every series go."""
    df = base.labelled(spark, sf_dir, RiskParams(drop_tail=2))
    return df.select(*KEYS, "risk_label_current", "risk_label")


@query("features_flat")
def features_flat(spark, sf_dir):
    """Flat feature variant with the coverage / days-of-stock label."""
    df = lab.label(feat.flat_features(base.panel(spark, sf_dir)), variant="ratio")
    return df.select(*KEYS, "inventory_level", "units_sold", "demand_forecast", *FEATURE_11, "risk_label")


@query("labelled_splits")
def labelled_splits(spark, sf_dir):
    """Temporal split and train-median fill of days of stock / sales velocity."""
    return base.split_frame(spark, sf_dir).select(
        *KEYS, "split", "days_of_stock", "sales_velocity", "risk_label")


@query("split_sizes")
def split_sizes(spark, sf_dir):
    """Rows and day span per split, with the leakage check."""
    df = lab.split_column(base.labelled(spark, sf_dir))
    return lab.leakage_check(df)


@query("scenario_shares")
def scenario_shares(spark, sf_dir):
    """Three threshold scenarios in one pass (3-row scenario table, broadcast
    cross join), class counts with zeros and percent, pivoted per scenario."""
    sc = spark.createDataFrame(SCENARIOS, "scenario string, theta_low double, theta_high double, sales_vel double")
    df = base.features(spark, sf_dir).select("inventory_reconstructed", "demand_forecast_clean", "units_sold")
    x = df.crossJoin(F.broadcast(sc))
    stock, dem = F.col("inventory_reconstructed"), F.col("demand_forecast_clean")
    cur = (F.when((stock > dem * F.col("theta_high")) & (F.col("units_sold") < dem * F.col("sales_vel")),
                  "Overstock Risk")
           .when(stock < dem * F.col("theta_low"), "Stockout Risk").otherwise("Safe Zone"))
    x = x.withColumn("risk_label_current", cur)
    counts = prof.label_counts(x, "risk_label_current", ["scenario", "theta_low", "theta_high", "sales_vel"])
    for c in ("overstock", "safe", "stockout"):
        counts = counts.withColumn(f"{c}_pct", F.col(c).cast("double") * 100.0 / F.col("n_total").cast("double"))
    return counts


# --- profiling ----------------------------------------------------------------------

@query("shape_summary")
def shape_summary(spark, sf_dir):
    return prof.shape_summary(base.panel(spark, sf_dir))


@query("distinct_counts")
def distinct_counts(spark, sf_dir):
    return prof.distinct_counts(base.panel(spark, sf_dir), ["store_id", "product_id"] + CATEGORICAL_FEATURES)


@query("distinct_values")
def distinct_values(spark, sf_dir):
    return prof.distinct_values(base.panel(spark, sf_dir), ["store_id", "product_id"] + CATEGORICAL_FEATURES)


@query("missing_values")
def missing_values(spark, sf_dir):
    """Missing values per column right after feature creation (before the drop)."""
    df = feat.series_features(base.panel(spark, sf_dir), drop_incomplete=False)
    return prof.missing_values(df)


@query("duplicate_rows")
def duplicate_rows(spark, sf_dir):
    """All copies of repeated (region, category, day, holiday) rows."""
    df = base.panel(spark, sf_dir).select("region", "category", "dt", "holiday_promotion")
    return prof.duplicate_rows(df)


@query("label_value_counts")
def label_value_counts(spark, sf_dir):
    return prof.value_counts(base.labelled(spark, sf_dir), "risk_label")


@query("crosstab_dims")
def crosstab_dims(spark, sf_dir):
    """Category / Region / Seasonality x next-day class (stage-1 labels)."""
    df = lab.label(feat.clean_demand(base.panel(spark, sf_dir)), variant="stage1")
    dims = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value"))
                     for d in ("category", "region", "seasonality")])
    long = df.select("risk_label", F.explode(dims).alias("x")).select("risk_label", "x.*")   # one pass for all three
    return prof.crosstab(long, ["dimension", "value"])


@query("subgroup_breakdown")
def subgroup_breakdown(spark, sf_dir):
    """Counts and % within each region (explorer labels)."""
    return prof.subgroup_breakdown(lab.label(base.panel(spark, sf_dir), variant="explorer"), "region")


@query("explorer_top200")
def explorer_top200(spark, sf_dir):
    """Membership filters over all stores, then the 200 most recent rows."""
    df = lab.label(base.panel(spark, sf_dir), variant="explorer")
    df = prof.filter_panel(df, ["SIZED", "PROMO"], ["AMERICA", "ASIA", "EUROPE"])
    return prof.top_recent(df, 200, ["dt", "store_id", "product_id", "category", "region",
                                     "inventory_level", "units_sold", "demand_forecast", "risk_label"])


@query("rows_affected")
def rows_affected(spark, sf_dir):
    return prof.rows_affected(base.panel(spark, sf_dir))


@query("reconstruction_summary")
def reconstruction_summary(spark, sf_dir):
    return prof.reconstruction_summary(feat.reconstruct_inventory(base.panel(spark, sf_dir)))


@query("summary_stats")
def summary_stats(spark, sf_dir):
    """count, mean, std, min, quartiles, max of the model's numeric inputs."""
    out = stats.describe(base.features(spark, sf_dir), NUMERICAL_FEATURES)
    return _round_cols(out, ["mean", "std", "p25", "p50", "p75"])


@query("ratio_quantiles")
def ratio_quantiles(spark, sf_dir):
    """Stock / clipped demand at 0, 20, 40, 60, 80, 100 %."""
    df = feat.inv_demand_ratio(base.panel(spark, sf_dir))
    out = stats.quantiles_long(df, ["inv_demand_ratio"], [0.0, 0.2, 0.4, 0.6, 0.8, 1.0])
    return _round_cols(out.select("prob", "value"), ["value"])


@query("median_by_class")
def median_by_class(spark, sf_dir):
    """Median coverage ratio and days of stock per next-day class."""
    out = stats.quantiles_long(base.labelled(spark, sf_dir), ["coverage_ratio", "days_of_stock"],
                               [0.5], ["risk_label"])
    return _round_cols(out.select("risk_label", "column", F.col("value").alias("median")), ["median"])


@query("correlation_matrix")
def correlation_matrix(spark, sf_dir):
    out = stats.correlation_matrix(base.features(spark, sf_dir), FEATURE_11)
    return _round_cols(out, ["corr"])


@query("vif")
def vif_q(spark, sf_dir):
    """Of the train split, as the model sees it."""
    out = stats.vif(base.split_frame(spark, sf_dir).filter("split = 'train'"), NUMERICAL_FEATURES)
    return out.withColumn("vif", F.round("vif", 4))


@query("histogram_units_sold")
def histogram_units_sold(spark, sf_dir):
    return stats.histogram(base.panel(spark, sf_dir), "units_sold", 40)


@query("histogram_ratio")
def histogram_ratio(spark, sf_dir):
    """Stock / demand ratio clipped at 20, 100 bins."""
    return stats.histogram(feat.inv_demand_ratio(base.panel(spark, sf_dir)), "inv_demand_ratio", 100, upper=20)


@query("boxplot_stats")
def boxplot_stats(spark, sf_dir):
    out = stats.boxplot_stats(base.panel(spark, sf_dir), ["inventory_level", "units_sold", "demand_forecast"])
    return _round_cols(out, ["q1", "median", "q3", "iqr", "lo_fence", "hi_fence"])


# --- weights and metric algebra --------------------------------------------------------

@query("class_weights")
def class_weights(spark, sf_dir):
    df = lab.split_column(base.labelled(spark, sf_dir)).filter("split = 'train'")
    return met.class_weights(df)


@query("weighted_train_rows")
def weighted_train_rows(spark, sf_dir):
    """Each train row with its balanced class weight (dict lookup as a join)."""
    df = lab.split_column(base.labelled(spark, sf_dir)).filter("split = 'train'")
    return met.with_class_weight(df, met.class_weights(df)).select(*KEYS, "risk_label", "weight")


def _rule_predictions(spark, sf_dir):
    """Stage-1 labels; today's rule label is the prediction of tomorrow's."""
    df = lab.label(feat.clean_demand(base.panel(spark, sf_dir)), variant="stage1")
    return lab.split_column(df).withColumnRenamed("risk_label_current", "prediction_label")


@query("rule_baseline_confusion")
def rule_baseline_confusion(spark, sf_dir):
    conf = met.confusion(_rule_predictions(spark, sf_dir), "risk_label", "prediction_label", ["split"])
    return met.normalise_rows(conf, ["split"])


@query("rule_baseline_per_class")
def rule_baseline_per_class(spark, sf_dir):
    conf = met.confusion(_rule_predictions(spark, sf_dir), "risk_label", "prediction_label", ["split"])
    return met.per_class(conf, ["split"])


@query("rule_baseline_metrics")
def rule_baseline_metrics(spark, sf_dir):
    out = met.metric_table(_rule_predictions(spark, sf_dir), "risk_label", "prediction_label", ["split"])
    return _round_cols(out, ["precision_macro", "recall_macro", "f1_macro", "precision_weighted",
                             "recall_weighted", "f1_weighted"])


# --- encoding ----------------------------------------------------------------------------


@query("encoded_categories")
def encoded_categories(spark, sf_dir):
    """Alphabetical ordinal codes fitted on train, applied to every split."""
    df = base.split_frame(spark, sf_dir, columns=CATEGORICAL_FEATURES)
    model = enc.fit_ordinal(df.filter("split = 'train'"), CATEGORICAL_FEATURES)
    out = enc.apply_ordinal(df, model, CATEGORICAL_FEATURES)
    return out.select(*KEYS, "split", *[c + "_enc" for c in CATEGORICAL_FEATURES])


@query("onehot_first_dropped")
def onehot_first_dropped(spark, sf_dir):
    """Active indicators of the first-level-dropped one-hot, long form."""
    df = base.split_frame(spark, sf_dir, columns=CATEGORICAL_FEATURES)
    out = enc.active_indicators(df, df.filter("split = 'train'"), CATEGORICAL_FEATURES)
    return out.select(*KEYS, "column", "level")


@query("standardized_features")
def standardized_features(spark, sf_dir):
    """z-scores of the numeric inputs with train mean and population std."""
    df = base.split_frame(spark, sf_dir, columns=NUMERICAL_FEATURES)
    out = enc.standardize(df, df.filter("split = 'train'"), NUMERICAL_FEATURES)
    zs = [c + "_z" for c in NUMERICAL_FEATURES]
    return _round_cols(out.select(*KEYS, "split", *zs), zs)


# --- scoring contract --------------------------------------------------------------------

def _requests(spark, sf_dir):
    """Score requests as they arrive (API names, text values) for every day
    of every series, including each series' first day (no sales history)."""
    df = feat.series_features(base.panel(spark, sf_dir), drop_incomplete=False)
    req = scr.to_request_frame(df, keep=KEYS)
    return req.select(*KEYS, *[F.col(c).cast("string").alias(c) for c in req.columns if c not in KEYS])


@query("score_contract")
def score_contract(spark, sf_dir):
    """Per request: typed model columns, failing fields and validity."""
    checked = scr.validate_requests(_requests(spark, sf_dir), keep=KEYS)
    return checked.withColumn("errors", F.concat_ws(",", "error_columns")).drop("error_columns")


@query("score_quarantine_counts")
def score_quarantine_counts(spark, sf_dir):
    """Valid vs quarantined request counts per failing-field set."""
    checked = scr.validate_requests(_requests(spark, sf_dir), keep=KEYS)
    return (checked.withColumn("errors", F.concat_ws(",", "error_columns"))
                   .groupBy("is_valid", "errors").agg(F.count(F.lit(1)).alias("n")))


@query("label_decode")
def label_decode(spark, sf_dir):
    """Code -> class name with out-of-range codes kept as text; codes come
    from the rule prediction shifted by the day of month (-1 .. 3)."""
    df = scr.encode_labels(_rule_predictions(spark, sf_dir), "prediction_label", out="code")
    df = df.withColumn("code", F.col("code") + F.dayofmonth("dt") % 3 - 1)
    return scr.decode_predictions(df, "code", out="decoded").select(*KEYS, "code", "decoded")


@query("cold_start_rows")
def cold_start_rows(spark, sf_dir):
    """Full feature rows built from 8-field snapshots of every panel row."""
    snap = base.panel(spark, sf_dir).select(
        *KEYS, "inventory_level", "units_sold", "demand_forecast", "price", "competitor_pricing",
        "discount", "category", "seasonality")
    panel = base.panel(spark, sf_dir)
    fitted = enc.ordinal_indexer(CATEGORICAL_FEATURES).fit(panel)   # levels: category cardinality
    levels = {c: list(lv) for c, lv in zip(CATEGORICAL_FEATURES, fitted.labelsArray)}
    out = scr.cold_start_rows(snap, levels)
    return out.drop("competitor_pricing", "price", "discount", "category", "seasonality",
                    "region_fixed", "weather_fixed")


# --- prediction log, monitoring and drift ------------------------------------------------


REQ_NUM = [api for api, _, t in REQUEST_FIELDS if t != "string"]
REQ_CAT = [api for api, _, t in REQUEST_FIELDS if t == "string"]
#: The prediction code is a number with few values, compared by its shares.
DRIFT_TESTS = {"prediction_encoded": "jensenshannon"}


def _prediction_table(spark, sf_dir, also=()):
    """Scored requests: every feature row with the rule prediction of its
    next-day class, in the flat prediction-log layout (and columns ``also``)."""
    df = lab.current_label(base.features(spark, sf_dir), variant="pipeline", out="pred_label")
    df = scr.encode_labels(df, "pred_label", out="prediction")
    return scr.prediction_log(df, "rule-baseline", "prediction", keep=[*KEYS, *also])


@query("prediction_log")
def prediction_log_q(spark, sf_dir):
    return _prediction_table(spark, sf_dir)


@query("monitor_prediction_counts")
def monitor_prediction_counts(spark, sf_dir):
    """Row count, counts per prediction code and per label (long form)."""
    log = _prediction_table(spark, sf_dir)
    fields = F.array(F.struct(F.lit("rows").alias("field"), F.lit(None).cast("string").alias("value")),
                     *[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value"))
                       for c in ("prediction_encoded", "prediction_label")])
    return (log.select(F.explode(fields).alias("x")).groupBy("x.field", "x.value")
            .agg(F.count(F.lit(1)).alias("n")))


@query("monitor_missing")
def monitor_missing(spark, sf_dir):
    return prof.missing_values(_prediction_table(spark, sf_dir))


@query("monitor_numeric_summary")
def monitor_numeric_summary(spark, sf_dir):
    """describe() of the monitored numeric columns that exist in the log."""
    log = _prediction_table(spark, sf_dir)
    api = {ours: a for a, ours, _ in REQUEST_FIELDS}
    cols = [api[c] for c in MONITOR_NUMERIC if api.get(c) in log.columns]
    return _round_cols(stats.describe(log, cols), ["mean", "std", "p25", "p50", "p75"])


@query("drift_halves")
def drift_halves(spark, sf_dir):
    """Reference / current halves by (day, store, product) order."""
    h = drf.half_split(_prediction_table(spark, sf_dir), "dt", ["store_id", "product_id"])
    return h.groupBy("half").agg(F.count(F.lit(1)).alias("n"), F.min("dt").alias("min_dt"),
                                 F.max("dt").alias("max_dt"))


@query("drift_statistics")
def drift_statistics(spark, sf_dir):
    """Per column: chosen test and its statistic (KS D, Wasserstein / std,
    Jensen-Shannon distance or chi-square)."""
    st = drf.statistics_table(_prediction_table(spark, sf_dir), REQ_NUM + ["prediction_encoded"],
                              REQ_CAT + ["prediction_label"], "dt", ["store_id", "product_id"], DRIFT_TESTS)
    return _round_cols(st, ["statistic"])


@query("drift_report")
def drift_report_q(spark, sf_dir):
    return drf.drift_report(_prediction_table(spark, sf_dir), REQ_NUM + ["prediction_encoded"],
                            REQ_CAT + ["prediction_label"], "dt", ["store_id", "product_id"], DRIFT_TESTS)


@query("drift_all_statistics")
def drift_all_statistics(spark, sf_dir):
    """Every test of every column: KS, Wasserstein, Jensen-Shannon, chi-square, and z of the two-valued holiday flag."""
    log = _prediction_table(spark, sf_dir, also=["holiday_promotion"])
    out = drf.all_statistics(log, REQ_NUM + ["prediction_encoded"], REQ_CAT + ["prediction_label", "holiday_promotion"], "dt",
                             ["store_id", "product_id"])
    # The flag of a chi-square test needs the tail of its distribution and is not compared with SQL.
    flag = F.when(F.col("stat_test") != "chisquare", F.col("drift_detected"))
    return _round_cols(out.withColumn("drift_detected", flag).drop("p_value", "threshold"), ["statistic"])


# --- sources and sinks (write, then read back) ------------------------------------------


@query("csv_roundtrip")
def csv_roundtrip(spark, sf_dir):
    """Panel written as CSV with the original header names, read back with a
    declared schema and date parsing, duplicates merged on read."""
    path = scratch_path(spark, "retail-csv")
    io.write_retail_csv(base.panel(spark, sf_dir), path)
    return io.read_retail_csv(spark, path)


@query("split_parquet_roundtrip")
def split_parquet_roundtrip(spark, sf_dir):
    """Splits written partitioned by ``split``; reading ``val`` prunes the others."""
    path = scratch_path(spark, "splits")
    io.write_splits(base.split_frame(spark, sf_dir).select(*KEYS, *NUMERICAL_FEATURES, *CATEGORICAL_FEATURES,
                                                           "risk_label", "split"), path)
    return io.read_splits(spark, path, "val")


@query("prediction_log_json")
def prediction_log_json(spark, sf_dir):
    """Nested JSON-lines prediction log (struct input, array predictions)
    written and read back with a declared schema, flattened per prediction."""
    j = _prediction_table(spark, sf_dir, also=["inventory_level"])
    input_struct = F.struct(*[
        (F.col("inventory_level") if n == "Inventory_Level" else F.col(n)).cast(t.simpleString()).alias(n)
        for n, t in io.LOG_INPUT_FIELDS])
    lines = j.select(F.to_json(F.struct(
        F.date_format(F.col("dt").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        input_struct.alias("input"),
        F.array(F.col("prediction_encoded")).alias("prediction"),
        F.array(F.col("prediction_label")).alias("prediction_label"))).alias("value"))
    path = scratch_path(spark, "prediction-log")
    lines.write.mode("overwrite").option("compression", "gzip").text(path)
    return io.read_prediction_log_json(spark, path)


@query("label_classes_roundtrip")
def label_classes_roundtrip(spark, sf_dir):
    """Class list of the labelled data written as JSON metadata and read back."""
    names = [r[0] for r in base.labelled(spark, sf_dir).select("risk_label").distinct()
             .orderBy("risk_label").collect()]   # at most the class vocabulary
    path = scratch_path(spark, "label-classes")
    io.write_label_classes(spark, path, names)
    back = io.read_label_classes(spark, path)
    return spark.createDataFrame(list(enumerate(back)), "code int, class_name string")


@query("run_metrics_table")
def run_metrics_table(spark, sf_dir):
    """Run-metrics sink: one row per (run, model, split, metric), appended."""
    m = rule_baseline_metrics(spark, sf_dir)
    names = ["accuracy", "precision_macro", "recall_macro", "f1_macro"]
    long = m.select("split", F.explode(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names])).alias("p"))
    runs = long.select(F.lit("rule-baseline").alias("run_id"), F.lit("Rule").alias("model"), "split",
                       "p.metric", F.round("p.value", 6).alias("value"))
    path = scratch_path(spark, "runs")
    runs.write.mode("append").parquet(path)
    return spark.read.parquet(path).filter(F.col("run_id") == "rule-baseline")


@query("report_tables_csv")
def report_tables_csv(spark, sf_dir):
    """Monitoring count table written as a CSV report and read back."""
    path = scratch_path(spark, "report")
    io.write_table(monitor_prediction_counts(spark, sf_dir), path, "csv", single_file=True)
    return spark.read.schema("field string, value string, n bigint").option("header", True).csv(path)


# --- sampling ------------------------------------------------------------------------------


@query("series_sample")
def series_sample(spark, sf_dir):
    """All rows of 30 % of the (store, product) series, chosen by seeded hash."""
    return smp.sample_series(base.panel(spark, sf_dir), 0.3, seed=42)


@query("stratified_split")
def stratified_split(spark, sf_dir):
    """80 / 20 split inside every next-day class by seeded hash."""
    df = base.labelled(spark, sf_dir).withColumn(
        "row_id", F.concat_ws("|", "store_id", "product_id", F.col("dt").cast("string")))
    return smp.stratified_split(df, "risk_label", 0.8, 42).select(*KEYS, "risk_label", "is_train")


# --- streaming -------------------------------------------------------------------------------


@query("stream_scoring")
def stream_scoring(spark, sf_dir):
    """Request files -> streaming contract check -> coverage / days-of-stock
    scorer -> Parquet sink (invalid rows to quarantine)."""
    src, out, bad, ck = (scratch_path(spark, n) for n in ("req-src", "scored", "quarantine", "ck-score"))
    _requests(spark, sf_dir).write.mode("overwrite").option("compression", "gzip").json(src)
    stream.score_stream(spark, src, out, bad, ck,
                        lambda b: b.withColumn("prediction_label", ratio_label("coverage_ratio", "days_of_stock")))
    res = spark.read.parquet(out)
    return res.select(F.col("store_id"), F.col("product_id"), F.to_date("dt").alias("dt"),
                      *[ours for _, ours, _ in REQUEST_FIELDS], "prediction_label")


def _count_events(spark, sf_dir, chunks: int = 4):
    """The predictions as event files in order of time, counted over several batches."""
    src, out, late, ck = (scratch_path(spark, n) for n in ("events", "win-counts", "late", "ck-count"))
    ev = _prediction_table(spark, sf_dir).select(
        F.col("dt").cast("timestamp").alias("event_time"), "prediction_label")
    files = stream.write_in_time_order(ev, src, "event_time", chunks)
    stream.label_count_stream(spark, src, ev.schema, out, ck, max_files_per_trigger=files, late=late)
    return stream.latest_counts(spark, out), stream.late_rows(spark, late, ev.schema)


@query("stream_label_counts")
def stream_label_counts(spark, sf_dir):
    """Watermarked 7-day tumbling-window counts per predicted label, over four batches."""
    return _count_events(spark, sf_dir)[0]


@query("stream_late_rows")
def stream_late_rows(spark, sf_dir):
    """Events counted and events behind the watermark (none: the files are in order of time)."""
    counts, late = _count_events(spark, sf_dir)
    return (counts.agg(F.sum("n").alias("counted"))
            .crossJoin(late.agg(F.count(F.lit(1)).alias("late"))))   # one row each


# --- models (Spark ML) -------------------------------------------------------------------------


def _fit_and_rank(spark, sf_dir, specs):
    ranked, _ = mdl.train_and_compare(base.split_frame(spark, sf_dir), specs)
    return ranked


def _resampled(spark, sf_dir, cats):
    """Train rows and what SMOTE (without ``cats``) or SMOTENC makes of them."""
    from shelfsense.operators.resample import smote
    train = mdl.model_input(base.split_frame(spark, sf_dir)).filter("split = 'train'")
    train = train.select("row_id", "label", *[F.col(c).cast("double").alias(c) for c in NUMERICAL_FEATURES], *cats)
    return train, smote(train, "label", NUMERICAL_FEATURES, cats, id_col="row_id")


def _resample_counts(spark, sf_dir, cats):
    """Per class: original and synthetic rows, and three counts that must be 0 -
    originals that changed, numbers outside the class's range (an interpolation
    can't leave it), categories the class doesn't have."""
    train, out = _resampled(spark, sf_dir, cats)
    names = [*NUMERICAL_FEATURES, *cats]
    content = F.xxhash64(*names)
    originals = (out.filter("NOT synthetic").select("row_id", content.alias("h")).alias("o")
                 .join(train.select("row_id", "label", content.alias("h")).alias("t"), "row_id", "right")
                 .groupBy("label").agg(F.sum((~F.col("o.h").eqNullSafe(F.col("t.h"))).cast("bigint")).alias("changed")))
    ranges = train.groupBy("label").agg(
        *[F.min(c).alias(f"lo_{c}") for c in NUMERICAL_FEATURES], *[F.max(c).alias(f"hi_{c}") for c in NUMERICAL_FEATURES],
        *[F.collect_set(c).alias(f"in_{c}") for c in cats])          # one row per class
    tol = 1e-9
    outside = [((F.col(c) < F.col(f"lo_{c}") - tol * F.abs(f"lo_{c}")) | (F.col(c) > F.col(f"hi_{c}") + tol * F.abs(f"hi_{c}")))
               .cast("bigint") for c in NUMERICAL_FEATURES]
    strange = [(~F.array_contains(f"in_{c}", F.col(c))).cast("bigint") for c in cats] or [F.lit(0).cast("bigint")]
    checked = out.join(F.broadcast(ranges), "label").groupBy("label").agg(
        F.sum((~F.col("synthetic")).cast("bigint")).alias("n_original"),
        F.sum(F.col("synthetic").cast("bigint")).alias("n_synthetic"),
        F.sum(sum(outside[1:], outside[0])).alias("outside"), F.sum(sum(strange[1:], strange[0])).alias("strange"))
    return checked.join(originals, "label").select(decode_label(F.col("label").cast("int")).alias("risk_label"),
                                                   "n_original", "n_synthetic", "changed", "outside", "strange")


@query("smote_class_counts")
def smote_class_counts(spark, sf_dir):
    return _resample_counts(spark, sf_dir, [])


@query("smotenc_class_counts")
def smotenc_class_counts(spark, sf_dir):
    return _resample_counts(spark, sf_dir, list(CATEGORICAL_FEATURES))


@query("model_logistic")
def model_logistic(spark, sf_dir):
    """One-hot (first level dropped) + population scaling + SMOTE +
    balanced multinomial logistic regression; accuracy / macro P R F1 per split."""
    return _fit_and_rank(spark, sf_dir, [mdl.DEFAULT_SPECS[0]])


@query("model_forest")
def model_forest(spark, sf_dir):
    """SMOTENC + one-hot + random forest (300 trees, depth 10, leaf >= 10)."""
    return _fit_and_rank(spark, sf_dir, [mdl.DEFAULT_SPECS[1]])


@query("model_boosting")
def model_boosting(spark, sf_dir):
    """One-hot + one-vs-rest boosted trees (300 rounds, depth 6, balanced weights)."""
    return _fit_and_rank(spark, sf_dir, [mdl.DEFAULT_SPECS[2]])


@query("model_selection")
def model_selection(spark, sf_dir):
    """All three models, ranked by val F1, recall, precision, accuracy and logged in a run registry; the best run
    is looked up there, its model loaded back, and must reproduce its val predictions."""
    frame = base.split_frame(spark, sf_dir)
    registry = RunRegistry(spark, scratch_path(spark, "registry"))
    ranked, models = mdl.train_and_compare(frame, mdl.DEFAULT_SPECS, scratch_path(spark, "models"), registry)
    best = {"run_id": registry.best()["run_id"], "model_name": registry.best()["model"]}
    if best["run_id"] != ranked.first()["run_id"]:
        raise AssertionError("the registry's best run is the first of the ranking")
    loaded = registry.load(best["run_id"])
    data = mdl.model_input(frame).filter("split = 'val'")
    a = mdl.predict(models[best["model_name"]], data).select("row_id", F.col("prediction").alias("p1"))
    b = mdl.predict(loaded, data).select("row_id", F.col("prediction").alias("p2"))
    same = a.join(b, "row_id").agg(F.sum((F.col("p1") != F.col("p2")).cast("long")).alias("d")).first()["d"]
    w = Window.orderBy(F.desc("val_f1_macro"), F.desc("val_recall_macro"), F.desc("val_precision_macro"),
                       F.desc("val_accuracy"), "model_name")   # three rows
    return (ranked.withColumn("rank", F.row_number().over(w))
                  .withColumn("is_best", F.col("rank") == 1)
                  .withColumn("reload_mismatches", F.when(F.col("rank") == 1, F.lit(same))))


@query("model_scoring")
def model_scoring(spark, sf_dir):
    """Requests -> contract -> saved-and-loaded logistic model -> decoded
    labels, confidence and per-class probabilities -> prediction log."""
    frame = base.split_frame(spark, sf_dir)
    data = mdl.model_input(frame)
    model = mdl.fit(data.filter("split = 'train'"), mdl.DEFAULT_SPECS[0])
    path = scratch_path(spark, "scoring-model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    valid, _ = scr.split_valid(scr.validate_requests(_requests(spark, sf_dir), keep=KEYS))
    scored = mdl.predict(loaded, valid)
    probs = vector_to_array("probability")
    scored = (scored.withColumn("confidence", F.array_max(probs))
                    .withColumn("probabilities", F.map_from_arrays(
                        F.array(*[F.lit(c) for c in CLASS_NAMES]), F.transform(probs, lambda p: F.round(p, 4)))))
    return scr.prediction_log(scored, path.rsplit("/", 1)[-1], "prediction",
                              keep=[*KEYS, "confidence", "probabilities"])


@query("baseline_comparison")
def baseline_comparison(spark, sf_dir):
    """Stage-1 logistic model (raw numbers + ordinal codes, balanced) vs the
    rule baseline on val: weighted F1 and the gain in percentage points."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    df = _rule_predictions(spark, sf_dir)     # stage-1 labels, split, rule prediction
    names = F.array(*[F.lit(n) for n in CLASS_NAMES])
    df = (df.withColumn("label", (F.array_position(names, F.col("risk_label")) - 1).cast("double"))
          .withColumn("holiday", F.col("holiday_promotion").cast("int")))
    cats = [c + "_idx" for c in CATEGORICAL_FEATURES]
    num = ["inventory_level", "units_sold", "demand_forecast", "price", "discount", "competitor_pricing", "holiday"]
    # Written once, with the columns in use: weights, indexers, the solver and both metrics read these rows.
    df = written(df.select(*num, *CATEGORICAL_FEATURES, "label", "risk_label", "prediction_label", "split"), "stage1-rows")
    train = df.filter("split = 'train'")
    w = met.class_weights(train, "label").select("label", "weight")
    train = met.with_class_weight(train, w, "label")
    pipe = Pipeline(stages=[enc.ordinal_indexer(CATEGORICAL_FEATURES, invalid="error"),
                            VectorAssembler(inputCols=num + cats, outputCol="features"),
                            LogisticRegression(family="multinomial", weightCol="weight", maxIter=1000,
                                               regParam=1.0 / max(1, train.count()), standardization=False)])
    model = pipe.fit(train)
    val = df.filter("split = 'val'")
    pred = model.transform(val).withColumn("model_label",
                                           decode_label(F.col("prediction").cast("int")))
    lr = met.metric_table(pred, "risk_label", "model_label").select(F.col("f1_weighted").alias("model_f1"))
    rule = met.metric_table(val, "risk_label", "prediction_label").select(F.col("f1_weighted").alias("rule_f1"))
    return lr.crossJoin(rule).withColumn("gain_pp", (F.col("model_f1") - F.col("rule_f1")) * 100.0)


@query("prediction_log_csv")
def prediction_log_csv(spark, sf_dir):
    """Flat prediction log written as CSV and read back with its schema."""
    from pyspark.sql import types as T
    path = scratch_path(spark, "predictions-csv")
    _prediction_table(spark, sf_dir).write.mode("overwrite").option("header", True).csv(path)
    keys = T.StructType([T.StructField("store_id", T.StringType()), T.StructField("product_id", T.StringType()),
                         T.StructField("dt", T.DateType())])
    return io.read_prediction_csv(spark, path, keys)


@query("panel_head")
def panel_head(spark, sf_dir):
    """First five rows of the panel in (store, product, day) order."""
    return prof.head(base.panel(spark, sf_dir), 5)
