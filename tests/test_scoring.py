import pytest

from shelfsense.config import REQUEST_FIELDS
from shelfsense.operators import scoring as scr

SAMPLE = {"Inventory_Reconstructed": "120.0", "Units_Sold": "35", "Units_Ordered": "40", "Price": "19.99",
          "Discount": "10", "Units_Sold_Lag1": "30.0", "Inventory_Change_Pct": "0.08",
          "Days_of_Stock": "12.0", "Sales_Velocity": "2.9", "Coverage_Ratio": "1.4",
          "Forecast_Error": "3.5", "Order_to_Inventory": "0.33", "Category": "Electronics",
          "Region": "North", "Weather_Condition": "Sunny", "Seasonality": "Summer"}


def frame(spark, rows):
    cols = [api for api, _, _ in REQUEST_FIELDS]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], ", ".join(f"{c} string" for c in cols))


def test_valid_request(spark):
    out = scr.validate_requests(frame(spark, [SAMPLE])).first()
    assert out.is_valid and out.units_sold == 35 and out.price == 19.99


def test_invalid_fields_are_named(spark):
    bad = dict(SAMPLE, Units_Sold="3.5", Price="abc", Days_of_Stock=None)
    out = scr.validate_requests(frame(spark, [SAMPLE, bad])).orderBy("is_valid").collect()
    assert out[0].error_columns == ["Units_Sold", "Price", "Days_of_Stock"]
    valid, quarantine = scr.split_valid(scr.validate_requests(frame(spark, [SAMPLE, bad])))
    assert valid.count() == 1 and quarantine.count() == 1
    with pytest.raises(scr.ContractError):
        scr.split_valid(scr.validate_requests(frame(spark, [SAMPLE, bad])), mode="reject_batch")


def test_missing_columns_fail_fast(spark):
    df = frame(spark, [SAMPLE]).drop("Price", "Region")
    with pytest.raises(scr.ContractError, match="Price"):
        scr.validate_requests(df)


def test_range_rule(spark):
    df = frame(spark, [dict(SAMPLE, Discount="150")])
    out = scr.validate_requests(df, ranges={"Discount": (0, 100)}).first()
    assert out.error_columns == ["Discount"]


def test_decode_out_of_range(spark):
    df = spark.createDataFrame([(0,), (2,), (3,), (-1,)], "prediction int")
    got = [r.prediction_label for r in scr.decode_predictions(df).collect()]
    assert got == ["Overstock Risk", "Stockout Risk", "3", "-1"]


def test_cold_start_row(spark):
    snap = spark.createDataFrame([(100, 20, 10.0, "PROMO", "Winter")],
                                 "inventory_level bigint, units_sold bigint, demand_forecast double, "
                                 "category string, seasonality string")
    r = scr.cold_start_rows(snap, {"category": ["GENERAL", "PROMO"], "region": ["AFRICA"]}).first()
    assert r.inventory_lag1 == 110.0 and r.units_sold_lag1 == 19.0 and r.days_of_stock == 5.0
    assert r.category_enc == 1 and r.region_enc == 0
