"""File sources and sinks: CSV panel, split Parquet, prediction logs, label
metadata and report tables. Schemas are always declared, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfsense.config import CLASS_NAMES, RAW_COLUMNS, SERIES_KEYS, TIME_COL

_RAW_TYPES = {
    "dt": T.DateType(), "store_id": T.StringType(), "product_id": T.StringType(),
    "category": T.StringType(), "region": T.StringType(), "inventory_level": T.LongType(),
    "units_sold": T.LongType(), "units_ordered": T.LongType(), "demand_forecast": T.DoubleType(),
    "price": T.DoubleType(), "discount": T.LongType(), "weather_condition": T.StringType(),
    "holiday_promotion": T.StringType(), "competitor_pricing": T.DoubleType(),
    "seasonality": T.StringType(),
}

RAW_SCHEMA = T.StructType([T.StructField(orig, _RAW_TYPES[ours], True) for orig, ours in RAW_COLUMNS])


def header_names(spark: SparkSession, path: str) -> list[str]:
    """Column names in the order of the files' header, blanks trimmed."""
    return [c.strip() for c in spark.read.option("header", True).option("inferSchema", False).csv(path).columns]


def schema_by_name(names: list[str], fields: dict[str, T.DataType], what: str) -> T.StructType:
    """The declared types in the order of ``names``; unknown, missing or repeated names are errors."""
    unknown, missing = sorted(set(names) - set(fields)), sorted(set(fields) - set(names))
    if unknown or missing or len(set(names)) < len(names):
        raise ValueError(f"{what}: columns do not fit the declared ones; unknown {unknown}, missing {missing}, "
                         f"header {names}")
    return T.StructType([T.StructField(n, fields[n], True) for n in names])


def strip_header(df: DataFrame) -> DataFrame:
    """Trim blanks around column names."""
    return df.toDF(*[c.strip() for c in df.columns])


def read_retail_csv(spark: SparkSession, path: str, merge_duplicates: bool = True,
                    date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Daily panel CSV (original header names, in any order, blanks around them
    allowed) -> snake_case typed frame. Columns are bound by name.

    ``Holiday/Promotion`` may be 0/1 or true/false. NaN becomes null. With
    ``merge_duplicates`` a repeated (store, product, day) is merged into one
    row (flows summed, stock and competitor price maxed, price and attributes
    minimal), which also bounds every series to one row per day.
    """
    schema = schema_by_name(header_names(spark, path), {orig: _RAW_TYPES[ours] for orig, ours in RAW_COLUMNS}, path)
    raw = (spark.read.schema(schema).option("header", True).option("enforceSchema", True)
           .option("dateFormat", date_format).option("mode", "FAILFAST").csv(path))
    df = raw.select(*[F.col(f"`{orig}`").alias(ours) for orig, ours in RAW_COLUMNS])
    hp = F.lower(F.trim(F.col("holiday_promotion")))
    df = df.withColumn("holiday_promotion", F.when(hp.isin("1", "true", "1.0"), True)
                       .when(hp.isin("0", "false", "0.0"), False))
    for c in ("demand_forecast", "price", "competitor_pricing"):
        df = df.withColumn(c, F.when(F.isnan(c), None).otherwise(F.col(c)))
    if not merge_duplicates:
        return df
    keys = SERIES_KEYS + [TIME_COL]
    return df.groupBy(*keys).agg(
        F.min("category").alias("category"), F.min("region").alias("region"),
        F.min("weather_condition").alias("weather_condition"),
        F.min("seasonality").alias("seasonality"),
        F.max("inventory_level").alias("inventory_level"),
        F.sum("units_sold").alias("units_sold"), F.sum("units_ordered").alias("units_ordered"),
        F.sum("demand_forecast").alias("demand_forecast"), F.min("price").alias("price"),
        F.max("discount").alias("discount"), F.max("competitor_pricing").alias("competitor_pricing"),
        F.max("holiday_promotion").alias("holiday_promotion"),
    ).select(*[ours for _, ours in RAW_COLUMNS])


def write_retail_csv(df: DataFrame, path: str) -> None:
    """Write the panel with the original header names (one file per partition)."""
    out = df.select(*[F.col(ours).alias(orig) for orig, ours in RAW_COLUMNS])
    out = out.withColumn("Holiday/Promotion", F.col("Holiday/Promotion").cast("int"))
    out.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)


def write_splits(df: DataFrame, path: str) -> None:
    """Parquet sink partitioned by ``split`` (later reads prune partitions);
    rows are sorted by series and day inside each file."""
    (df.sortWithinPartitions(*SERIES_KEYS, TIME_COL)
       .write.mode("overwrite").partitionBy("split").parquet(path))


def read_splits(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if split is None else df.filter(F.col("split") == split)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", single_file: bool = False) -> None:
    """Report / metrics sink. ``single_file`` only for tables known to be tiny."""
    w = (df.coalesce(1) if single_file else df).write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)


# --- prediction log ------------------------------------------------------------

LOG_INPUT_FIELDS = [
    ("Inventory_Level", T.DoubleType()), ("Units_Sold", T.DoubleType()),
    ("Units_Ordered", T.DoubleType()), ("Price", T.DoubleType()), ("Discount", T.DoubleType()),
    ("Units_Sold_Lag1", T.DoubleType()), ("Inventory_Change_Pct", T.DoubleType()),
    ("Days_of_Stock", T.DoubleType()), ("Sales_Velocity", T.DoubleType()),
    ("Coverage_Ratio", T.DoubleType()), ("Forecast_Error", T.DoubleType()),
    ("Order_to_Inventory", T.DoubleType()), ("Category", T.StringType()),
    ("Region", T.StringType()), ("Weather_Condition", T.StringType()),
    ("Seasonality", T.StringType()),
]

PREDICTION_LOG_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("input", T.StructType([T.StructField(n, t) for n, t in LOG_INPUT_FIELDS])),
    T.StructField("prediction", T.ArrayType(T.IntegerType())),
    T.StructField("prediction_label", T.ArrayType(T.StringType())),
])


def read_prediction_log_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines log (one request per line, arrays of predictions) -> one row
    per prediction with the request fields flattened."""
    raw = spark.read.schema(PREDICTION_LOG_SCHEMA).json(path)
    z = F.explode(F.arrays_zip(F.col("prediction").alias("p"), F.col("prediction_label").alias("l")))
    return (raw.select(F.to_timestamp("timestamp").alias("ts"), "input.*", z.alias("pz"))
               .select("*", F.col("pz.p").alias("prediction_encoded"),
                       F.col("pz.l").alias("prediction_label"))
               .drop("pz"))


def write_label_classes(spark: SparkSession, path: str, class_names=CLASS_NAMES) -> None:
    spark.createDataFrame([(list(class_names),)], "class_names array<string>") \
        .coalesce(1).write.mode("overwrite").json(path)


def read_label_classes(spark: SparkSession, path: str) -> list[str]:
    """Accepts ``{"class_names": [...]}`` lines or a bare JSON list."""
    txt = spark.read.text(path)
    parsed = txt.select(
        F.coalesce(F.from_json("value", "class_names array<string>").getField("class_names"),
                   F.from_json("value", "array<string>")).alias("names")).where("names is not null")
    row = parsed.limit(1).collect()
    if not row:
        raise ValueError("label class file holds no class list")
    return list(row[0]["names"])


# --- flat prediction log (CSV) ----------------------------------------------------

def prediction_csv_schema() -> T.StructType:
    from shelfsense.config import REQUEST_FIELDS
    typ = {"double": T.DoubleType(), "bigint": T.LongType(), "string": T.StringType()}
    return T.StructType([T.StructField(api, typ[t]) for api, _, t in REQUEST_FIELDS] + [
        T.StructField("model_run_id", T.StringType()), T.StructField("prediction_encoded", T.IntegerType()),
        T.StructField("prediction_label", T.StringType())])


def read_prediction_csv(spark: SparkSession, path: str, extra: T.StructType | None = None) -> DataFrame:
    """Flat prediction log written by the scoring job, with its declared schema
    (``extra`` fields first, e.g. keys), bound by header name. A missing path is
    the caller's check."""
    fields = (list(extra.fields) if extra else []) + list(prediction_csv_schema().fields)
    schema = schema_by_name(header_names(spark, path), {f.name: f.dataType for f in fields}, path)
    return spark.read.schema(schema).option("header", True).csv(path).select(*[f.name for f in fields])
