import pytest
from pyspark.sql import functions as F

from shelfsense.operators import encode as enc
from shelfsense.session import scratch_path
from shelfsense.sources import files as io

HEADER = ("Date,Store ID,Product ID,Category,Region,Inventory Level,Units Sold,Units Ordered,"
          "Demand Forecast,Price,Discount,Weather Condition,Holiday/Promotion,Competitor Pricing,Seasonality")


def write_text(spark, lines):
    path = scratch_path(spark, "csv-in")
    spark.createDataFrame([(l,) for l in lines], "value string").coalesce(1).write.text(path)
    return path


def test_csv_read_merges_duplicate_days(spark):
    path = write_text(spark, [HEADER,
                              "2022-01-01,S1,P1,Toys,North,100,5,0,10.5,9.99,5,Sunny,1,10.0,Winter",
                              "2022-01-01,S1,P1,Toys,North,90,3,2,1.5,9.49,0,Sunny,0,11.0,Winter",
                              "2022-01-02,S1,P1,Toys,North,95,4,0,NaN,9.99,5,Rainy,0,10.0,Winter"])
    df = io.read_retail_csv(spark, path).orderBy("dt").collect()
    assert len(df) == 2
    assert (df[0].inventory_level, df[0].units_sold, df[0].units_ordered) == (100, 8, 2)
    assert df[0].holiday_promotion is True and df[1].demand_forecast is None


def test_strip_header(spark):
    df = spark.createDataFrame([(1, 2)], "` a ` int, `b  ` int")
    assert io.strip_header(df).columns == ["a", "b"]


def test_label_class_file_accepts_both_layouts(spark):
    p1 = write_text(spark, ['{"class_names": ["Overstock Risk", "Safe Zone", "Stockout Risk"]}'])
    p2 = write_text(spark, ['["x", "y"]'])
    assert io.read_label_classes(spark, p1) == ["Overstock Risk", "Safe Zone", "Stockout Risk"]
    assert io.read_label_classes(spark, p2) == ["x", "y"]


def test_unseen_category_is_an_error_and_one_hot_unknown_is_zero(spark):
    train = spark.createDataFrame([("a",), ("b",)], "category string")
    other = spark.createDataFrame([("c",)], "category string")
    model = enc.fit_ordinal(train, ["category"])
    with pytest.raises(Exception):
        enc.apply_ordinal(other, model, ["category"]).collect()
    from pyspark.ml import Pipeline
    stages, cols = enc.onehot_all_levels(["category"])
    fitted = Pipeline(stages=stages).fit(train)
    vec = fitted.transform(other).select(cols[0]).first()[0]
    assert vec.size == 2 and vec.numNonzeros() == 0
    ind, names = enc.indicator_sql(enc.first_dropped_levels(train, ["category"]))
    row = ind.transform(other).first()
    assert names == ["category__oh1"] and row["category__oh1"] == 0.0


def test_csv_columns_are_bound_by_name(spark):
    path = write_text(spark, [" Units Sold , Inventory Level," + ",".join(
        c for c in HEADER.split(",") if c not in ("Units Sold", "Inventory Level")),
        "5,100,2022-01-01,S1,P1,Toys,North,0,10.5,9.99,5,Sunny,1,10.0,Winter"])
    row = io.read_retail_csv(spark, path).first()
    assert (row.units_sold, row.inventory_level, row.category) == (5, 100, "Toys")


@pytest.mark.parametrize("header", [HEADER.replace("Price", "Cost", 1), HEADER + ",Extra", HEADER.replace(",Seasonality", "")])
def test_csv_with_unknown_or_missing_columns_is_an_error(spark, header):
    with pytest.raises(ValueError, match="columns do not fit"):
        io.read_retail_csv(spark, write_text(spark, [header, "x"]))
