import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from shelfsense.session import get_spark
    s = get_spark("local[*]", app="shelfsense-tests", shuffle_partitions=8,
                  conf={"spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def panel_rows(spark, rows, with_meta=True):
    """rows: (store, product, day_index, level, sold, ordered, demand)."""
    import datetime as dt
    base = dt.date(2020, 1, 1)
    data = [(s, p, base + dt.timedelta(days=d), "GENERAL", "AFRICA", "Sunny", "Winter", int(lv), int(so),
             int(od), float(de), 1.0, 0, 1.0, False) for s, p, d, lv, so, od, de in rows]
    return spark.createDataFrame(data, (
        "store_id string, product_id string, dt date, category string, region string, "
        "weather_condition string, seasonality string, inventory_level bigint, units_sold bigint, "
        "units_ordered bigint, demand_forecast double, price double, discount bigint, "
        "competitor_pricing double, holiday_promotion boolean"))
