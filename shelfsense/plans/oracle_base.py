"""DuckDB SQL building blocks for the correctness oracle.

These CTEs restate the semantics independently of the Spark code: the stock
balance is a recursive CTE that walks each series day by day (the brute-force
loop), where the Spark plan uses the window closed form.
"""

RETAIL_DAILY = """
retail_daily AS (
SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS store_id, p_type AS product_id, CAST(l_shipdate AS DATE) AS dt,
  CASE WHEN p_type IN ('SMALL','MEDIUM','LARGE') THEN 'SIZED'
       WHEN p_type = 'PROMO' THEN 'PROMO' ELSE 'GENERAL' END AS category,
  r_name AS region,
  CASE day(CAST(l_shipdate AS DATE)) % 4 WHEN 0 THEN 'Sunny' WHEN 1 THEN 'Rainy'
       WHEN 2 THEN 'Cloudy' ELSE 'Snowy' END AS weather_condition,
  CASE WHEN month(CAST(l_shipdate AS DATE)) IN (12,1,2) THEN 'Winter'
       WHEN month(CAST(l_shipdate AS DATE)) IN (3,4,5) THEN 'Spring'
       WHEN month(CAST(l_shipdate AS DATE)) IN (6,7,8) THEN 'Summer' ELSE 'Autumn' END AS seasonality,
  CAST(sum(l_quantity * (1 + CAST(round(l_tax*100) AS INT) % 4)) AS BIGINT) AS inventory_level,
  CAST(sum(CASE WHEN l_linestatus='F' THEN l_quantity ELSE 0 END) AS BIGINT) AS units_sold,
  CAST(sum(CASE WHEN l_linestatus='O' THEN l_quantity ELSE 0 END) AS BIGINT) AS units_ordered,
  CAST(sum(CASE WHEN l_returnflag='N' THEN l_quantity ELSE 0 END) - 2 AS DOUBLE) AS demand_forecast,
  min(l_extendedprice / l_quantity) AS price,
  CAST(max(round(l_discount*100)) AS BIGINT) AS discount,
  max(l_extendedprice / l_quantity) AS competitor_pricing,
  day(CAST(l_shipdate AS DATE)) <= 3 AS holiday_promotion
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
GROUP BY s_suppkey, p_type, r_name, CAST(l_shipdate AS DATE)
)"""

CLEAN = """
rd_clean AS (
  SELECT *, CASE WHEN demand_forecast < 1 THEN 1.0::DOUBLE ELSE demand_forecast END AS demand_forecast_clean
  FROM retail_daily
),
rd_num AS (
  SELECT *, row_number() OVER (PARTITION BY store_id, product_id ORDER BY dt) AS rn FROM rd_clean
),
recon_loop AS (
  SELECT store_id, product_id, rn, CAST(inventory_level AS DOUBLE) AS inv, units_sold, units_ordered
  FROM rd_num WHERE rn = 1
  UNION ALL
  SELECT n.store_id, n.product_id, n.rn,
         greatest(r.inv - r.units_sold + r.units_ordered, 0.0), n.units_sold, n.units_ordered
  FROM recon_loop r JOIN rd_num n
    ON n.store_id = r.store_id AND n.product_id = r.product_id AND n.rn = r.rn + 1
),
recon AS (
  SELECT d.* EXCLUDE (rn), l.inv AS inventory_reconstructed
  FROM rd_num d JOIN recon_loop l USING (store_id, product_id, rn)
)"""

FEATURES = """
feat_raw AS (
  SELECT *,
    lag(inventory_reconstructed) OVER w AS inventory_lag1,
    CAST(lag(units_sold) OVER w AS DOUBLE) AS units_sold_lag1,
    CASE WHEN count(inventory_reconstructed) OVER w7 = 7
         THEN avg(inventory_reconstructed) OVER w7 END AS rolling7_inventory
  FROM recon
  WINDOW w AS (PARTITION BY store_id, product_id ORDER BY dt),
         w7 AS (PARTITION BY store_id, product_id ORDER BY dt ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
),
features AS (
  SELECT *,
    inventory_reconstructed - inventory_lag1 AS inventory_change,
    coalesce((inventory_reconstructed - inventory_lag1) / nullif(inventory_lag1, 0), 0.0) AS inventory_change_pct,
    coalesce(inventory_reconstructed / nullif(CAST(units_sold AS DOUBLE), 0),
             inventory_reconstructed / demand_forecast_clean) AS days_of_stock,
    inventory_reconstructed - rolling7_inventory AS inventory_vs_rolling7,
    coalesce(units_sold / nullif(inventory_reconstructed, 0), 0.0) AS sales_velocity,
    inventory_reconstructed / demand_forecast_clean AS coverage_ratio,
    units_sold - demand_forecast AS forecast_error,
    coalesce(units_ordered / nullif(inventory_reconstructed, 0), 0.0) AS order_to_inventory
  FROM feat_raw
  WHERE inventory_lag1 IS NOT NULL AND rolling7_inventory IS NOT NULL
)"""


def rule_sql(stock: str, demand: str, tl="1.2", th="4.5", sv="0.8", precedence="overstock") -> str:
    so = f"{stock} < {demand} * {tl}::DOUBLE"
    ov = f"({stock} > {demand} * {th}::DOUBLE AND units_sold < {demand} * {sv}::DOUBLE)"
    if precedence == "overstock":
        return (f"CASE WHEN {ov} THEN 'Overstock Risk' WHEN {so} THEN 'Stockout Risk' "
                f"ELSE 'Safe Zone' END")
    return (f"CASE WHEN {so} THEN 'Stockout Risk' WHEN {ov} THEN 'Overstock Risk' "
            f"ELSE 'Safe Zone' END")


LABELLED = """
lab_cur AS (
  SELECT *, """ + rule_sql("inventory_reconstructed", "demand_forecast_clean") + """ AS risk_label_current
  FROM features
),
labelled AS (
  SELECT * FROM (
    SELECT *, lead(risk_label_current) OVER (PARTITION BY store_id, product_id ORDER BY dt) AS risk_label
    FROM lab_cur) WHERE risk_label IS NOT NULL
)"""


def with_ctes(*parts: str) -> str:
    return "WITH RECURSIVE " + ",".join(parts)
