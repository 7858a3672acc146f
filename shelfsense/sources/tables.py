"""Driver tables and the daily store x product panel built from them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def retail_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (store, product, day), derived from the TPC-H-like tables.

    store = supplier, product = part type, region = supplier region: the
    number of series grows with the data.
    Quantities stay integral so ratios are single correctly rounded divisions.

    Plan: lineitem is scanned once with only the 9 columns used; nation (25
    rows) and region (5 rows) are fixed-size dimensions and are broadcast;
    supplier and part grow with the data, so their joins are left to the
    planner (broadcast only below ``autoBroadcastJoinThreshold`` or when AQE
    measures them small at run time, otherwise a shuffle join). The joined rows
    are dealt by (store, product) before the group-by, which then needs no
    shuffle of its own, nor do the windows over a series: lineitem has hardly two
    rows of a (store, product, day), so sums before the shuffle would save nothing.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")

    # Fact-to-dimension joins one at a time, each against a plain scan, so the
    # planner's size estimates stay meaningful (a join's static estimate is
    # the product of its inputs, which would make the fact side look smaller).
    d = F.to_date("l_shipdate")
    qty = F.col("l_quantity")
    joined = (li.join(supplier, li.l_suppkey == supplier.s_suppkey)
              .join(F.broadcast(nation), F.col("s_nationkey") == nation.n_nationkey)
              .join(F.broadcast(region), F.col("n_regionkey") == region.r_regionkey)
              .join(part, li.l_partkey == part.p_partkey)
              .select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("store_id"), F.col("p_type").alias("product_id"),
                      F.col("r_name").alias("region"), d.alias("dt"), qty,
                      "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"))

    # Dealt by series at once: the day's sums and every window over a series need no further shuffle. The windows cost
    # more than their bytes tell, so the number of tasks is not left to a partition size in bytes.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    agg = joined.repartition(tasks, "store_id", "product_id").groupBy("store_id", "product_id", "region", "dt").agg(
        F.sum(qty * (F.lit(1) + F.round(F.col("l_tax") * 100).cast("int") % 4))
         .cast("bigint").alias("inventory_level"),
        F.sum(F.when(F.col("l_linestatus") == "F", qty).otherwise(0)).cast("bigint").alias("units_sold"),
        F.sum(F.when(F.col("l_linestatus") == "O", qty).otherwise(0)).cast("bigint").alias("units_ordered"),
        (F.sum(F.when(F.col("l_returnflag") == "N", qty).otherwise(0)) - 2).cast("double")
         .alias("demand_forecast"),
        F.min(F.col("l_extendedprice") / qty).alias("price"),
        F.max(F.round(F.col("l_discount") * 100)).cast("bigint").alias("discount"),
        F.max(F.col("l_extendedprice") / qty).alias("competitor_pricing"),
    )
    day = F.dayofmonth("dt")
    month = F.month("dt")
    return agg.select(
        "store_id", "product_id", "dt",
        F.when(F.col("product_id").isin("SMALL", "MEDIUM", "LARGE"), "SIZED")
         .when(F.col("product_id") == "PROMO", "PROMO").otherwise("GENERAL").alias("category"),
        "region",
        F.when(day % 4 == 0, "Sunny").when(day % 4 == 1, "Rainy")
         .when(day % 4 == 2, "Cloudy").otherwise("Snowy").alias("weather_condition"),
        F.when(month.isin(12, 1, 2), "Winter").when(month.isin(3, 4, 5), "Spring")
         .when(month.isin(6, 7, 8), "Summer").otherwise("Autumn").alias("seasonality"),
        "inventory_level", "units_sold", "units_ordered", "demand_forecast", "price",
        "discount", "competitor_pricing",
        (day <= 3).alias("holiday_promotion"),
    )
