"""DuckDB statements equal in meaning to the registered queries."""

from __future__ import annotations

from shelfsense.plans.oracle_base import (CLEAN, FEATURES, LABELLED, RETAIL_DAILY, rule_sql,
                                          with_ctes)

ORACLE: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    ORACLE[name] = text


_FEAT = with_ctes(RETAIL_DAILY, CLEAN, FEATURES)
_LAB = with_ctes(RETAIL_DAILY, CLEAN, FEATURES, LABELLED)

sql("risk_share_by_region", _LAB + """
SELECT region, risk_label, n, CAST(n AS DOUBLE) * 100.0 / CAST(sum(n) OVER (PARTITION BY region) AS DOUBLE) AS pct
FROM (SELECT region, risk_label, count(*) AS n FROM labelled GROUP BY region, risk_label)""")

sql("retail_daily", with_ctes(RETAIL_DAILY) + " SELECT * FROM retail_daily")

sql("features_series", _FEAT + " SELECT * FROM features")

sql("labels_reconstructed", _LAB +
    " SELECT store_id, product_id, dt, risk_label_current, risk_label FROM labelled")

# --- label variants ------------------------------------------------------------------

_STAGE1 = with_ctes(RETAIL_DAILY, CLEAN) + """,
s1 AS (SELECT *, """ + rule_sql("inventory_level", "demand_forecast_clean", precedence="stockout") + """ AS risk_label_current FROM rd_clean),
stage1 AS (SELECT * FROM (SELECT *, lead(risk_label_current) OVER (PARTITION BY store_id, product_id ORDER BY dt) AS risk_label FROM s1) WHERE risk_label IS NOT NULL)
"""
sql("labels_stage1", _STAGE1 + " SELECT store_id, product_id, dt, risk_label_current, risk_label FROM stage1")

sql("labels_pipeline", _FEAT + """,
p AS (SELECT *, """ + rule_sql("inventory_level", "demand_forecast_clean") + """ AS risk_label_current FROM features)
SELECT store_id, product_id, dt, risk_label_current, risk_label FROM (
  SELECT *, lead(risk_label_current) OVER (PARTITION BY store_id, product_id ORDER BY dt) AS risk_label FROM p)
WHERE risk_label IS NOT NULL""")

sql("labels_explorer", with_ctes(RETAIL_DAILY) + """
SELECT store_id, product_id, dt, """ + rule_sql("inventory_level", "demand_forecast", precedence="stockout")
    + """ AS risk_label FROM retail_daily""")

sql("labels_reconstructed_tail2", _FEAT + """,
c AS (SELECT *, """ + rule_sql("inventory_reconstructed", "demand_forecast_clean") + """ AS risk_label_current FROM features),
s AS (SELECT *, lead(risk_label_current) OVER w AS risk_label, lead(dt, 2) OVER w AS dt2
      FROM c WINDOW w AS (PARTITION BY store_id, product_id ORDER BY dt))
SELECT store_id, product_id, dt, risk_label_current, risk_label FROM s WHERE dt2 IS NOT NULL""")

sql("features_flat", with_ctes(RETAIL_DAILY) + """,
f0 AS (
  SELECT *,
    coalesce(lag(CAST(inventory_level AS DOUBLE)) OVER (PARTITION BY store_id, product_id ORDER BY dt),
             CAST(inventory_level AS DOUBLE)) AS inventory_lag1,
    coalesce(lag(CAST(units_sold AS DOUBLE)) OVER (PARTITION BY store_id, product_id ORDER BY dt),
             CAST(units_sold AS DOUBLE)) AS units_sold_lag1,
    avg(inventory_level) OVER (PARTITION BY store_id, product_id ORDER BY dt
                               ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling7_inventory
  FROM retail_daily),
f1 AS (
  SELECT *, inventory_level - inventory_lag1 AS inventory_change,
    coalesce((inventory_level - inventory_lag1) / nullif(inventory_lag1, 0), 0.0) AS inventory_change_pct,
    inventory_level - rolling7_inventory AS inventory_vs_rolling7,
    coalesce(inventory_level / nullif(CAST(units_sold AS DOUBLE), 0), 0.0) AS days_of_stock,
    coalesce(units_sold / nullif(demand_forecast, 0), 0.0) AS sales_velocity,
    coalesce(inventory_level / nullif(demand_forecast, 0), 0.0) AS coverage_ratio,
    units_sold - demand_forecast AS forecast_error,
    coalesce(demand_forecast / nullif(CAST(inventory_level AS DOUBLE), 0), 0.0) AS order_to_inventory
  FROM f0)
SELECT store_id, product_id, dt, inventory_level, units_sold, demand_forecast, inventory_lag1,
  units_sold_lag1, rolling7_inventory, inventory_change, inventory_change_pct, days_of_stock,
  inventory_vs_rolling7, sales_velocity, coverage_ratio, forecast_error, order_to_inventory,
  CASE WHEN coverage_ratio < 0.2 OR days_of_stock < 3 THEN 'Stockout Risk'
       WHEN coverage_ratio > 2.0 AND days_of_stock > 30 THEN 'Overstock Risk'
       ELSE 'Safe Zone' END AS risk_label
FROM f1""")

SPLIT = """,
split_lab AS (
  SELECT *, CASE WHEN dt < DATE '2000-02-01' THEN 'train' WHEN dt < DATE '2001-02-01' THEN 'val'
                 ELSE 'test' END AS split FROM labelled),
med AS (SELECT quantile_cont(days_of_stock, 0.5) AS m_dos, quantile_cont(sales_velocity, 0.5) AS m_sv
        FROM split_lab WHERE split = 'train'),
filled AS (
  SELECT s.* REPLACE (coalesce(days_of_stock, m_dos) AS days_of_stock,
                      coalesce(sales_velocity, m_sv) AS sales_velocity)
  FROM split_lab s CROSS JOIN med)
"""
_SPLIT = _LAB + SPLIT

sql("labelled_splits", _SPLIT +
    " SELECT store_id, product_id, dt, split, days_of_stock, sales_velocity, risk_label FROM filled")

sql("split_sizes", _SPLIT + """
SELECT split, count(*) AS n_rows, min(dt) AS min_dt, max(dt) AS max_dt,
  CASE WHEN split = 'train' THEN max(dt) < DATE '2000-02-01'
       WHEN split = 'val' THEN min(dt) >= DATE '2000-02-01' AND max(dt) < DATE '2001-02-01'
       ELSE min(dt) >= DATE '2001-02-01' END AS ok
FROM split_lab GROUP BY split""")

sql("scenario_shares", _FEAT + """,
sc(scenario, theta_low, theta_high, sales_vel) AS (VALUES
  ('Scenario 1', 1.2::DOUBLE, 4.5::DOUBLE, 0.8::DOUBLE),
  ('Scenario 2', 1.0::DOUBLE, 1.5::DOUBLE, 0.5::DOUBLE),
  ('Scenario 3', 1.6::DOUBLE, 2.4::DOUBLE, 0.7::DOUBLE)),
x AS (
  SELECT scenario, theta_low, theta_high, sales_vel,
    CASE WHEN inventory_reconstructed > demand_forecast_clean * theta_high
              AND units_sold < demand_forecast_clean * sales_vel THEN 'Overstock Risk'
         WHEN inventory_reconstructed < demand_forecast_clean * theta_low THEN 'Stockout Risk'
         ELSE 'Safe Zone' END AS l
  FROM features CROSS JOIN sc),
c AS (
  SELECT scenario, theta_low, theta_high, sales_vel, count(*) AS n_total,
    sum(CASE WHEN l = 'Overstock Risk' THEN 1 ELSE 0 END) AS overstock,
    sum(CASE WHEN l = 'Safe Zone' THEN 1 ELSE 0 END) AS safe,
    sum(CASE WHEN l = 'Stockout Risk' THEN 1 ELSE 0 END) AS stockout
  FROM x GROUP BY ALL)
SELECT *, CAST(overstock AS DOUBLE) * 100.0 / CAST(n_total AS DOUBLE) AS overstock_pct,
  CAST(safe AS DOUBLE) * 100.0 / CAST(n_total AS DOUBLE) AS safe_pct,
  CAST(stockout AS DOUBLE) * 100.0 / CAST(n_total AS DOUBLE) AS stockout_pct
FROM c""")

# --- profiling ---------------------------------------------------------------------------

_RD = with_ctes(RETAIL_DAILY)
sql("shape_summary", _RD + """
SELECT count(*) AS n_rows, min(dt) AS start_dt, max(dt) AS end_dt,
  count(DISTINCT store_id) AS n_stores, count(DISTINCT product_id) AS n_products, 7 AS n_numeric_cols
FROM retail_daily""")

_CATS = ["store_id", "product_id", "category", "region", "weather_condition", "seasonality"]
sql("distinct_counts", _RD + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(DISTINCT {c}) AS n_distinct FROM retail_daily" for c in _CATS))
sql("distinct_values", _RD + " " + " UNION ".join(
    f"SELECT DISTINCT '{c}' AS column, CAST({c} AS VARCHAR) AS value FROM retail_daily WHERE {c} IS NOT NULL"
    for c in _CATS))

_FEAT_ALL_COLS = ["store_id", "product_id", "dt", "category", "region", "weather_condition",
                  "seasonality", "inventory_level", "units_sold", "units_ordered", "demand_forecast",
                  "price", "discount", "competitor_pricing", "holiday_promotion", "demand_forecast_clean",
                  "inventory_reconstructed", "inventory_lag1", "units_sold_lag1", "rolling7_inventory",
                  "inventory_change", "inventory_change_pct", "days_of_stock", "inventory_vs_rolling7",
                  "sales_velocity", "coverage_ratio", "forecast_error", "order_to_inventory"]
_FEAT_NOFILTER = FEATURES.replace(
    "WHERE inventory_lag1 IS NOT NULL AND rolling7_inventory IS NOT NULL", "")


def _missing(c: str) -> str:
    dbl = c not in ("store_id", "product_id", "dt", "category", "region", "weather_condition",
                    "seasonality", "inventory_level", "units_sold", "units_ordered", "discount",
                    "holiday_promotion")
    cond = f"({c} IS NULL OR isnan({c}))" if dbl else f"{c} IS NULL"
    return (f"SELECT '{c}' AS column, sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS n_missing, "
            f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / CAST(count(*) AS DOUBLE) "
            f"AS pct_missing FROM features")


sql("missing_values", with_ctes(RETAIL_DAILY, CLEAN, _FEAT_NOFILTER) + " "
    + " UNION ALL ".join(_missing(c) for c in _FEAT_ALL_COLS))

sql("duplicate_rows", _RD + """
SELECT region, category, dt, holiday_promotion FROM (
  SELECT region, category, dt, holiday_promotion,
    count(*) OVER (PARTITION BY region, category, dt, holiday_promotion) AS c
  FROM retail_daily) WHERE c > 1""")

sql("label_value_counts", _LAB + """
SELECT risk_label, n, CAST(n AS DOUBLE) * 100.0 / CAST(sum(n) OVER () AS DOUBLE) AS pct
FROM (SELECT risk_label, count(*) AS n FROM labelled WHERE risk_label IS NOT NULL GROUP BY risk_label)""")

sql("crosstab_dims", _STAGE1 + " " + " UNION ALL ".join(f"""
SELECT {d} AS value, sum(CASE WHEN risk_label = 'Overstock Risk' THEN 1 ELSE 0 END) AS overstock,
  sum(CASE WHEN risk_label = 'Safe Zone' THEN 1 ELSE 0 END) AS safe,
  sum(CASE WHEN risk_label = 'Stockout Risk' THEN 1 ELSE 0 END) AS stockout, '{d}' AS dimension
FROM stage1 GROUP BY {d}""" for d in ("category", "region", "seasonality")))

_EXPL = with_ctes(RETAIL_DAILY) + """,
expl AS (SELECT *, """ + rule_sql("inventory_level", "demand_forecast", precedence="stockout") + """ AS risk_label
         FROM retail_daily)
"""
sql("subgroup_breakdown", _EXPL + """
SELECT region, n_total, overstock, safe, stockout,
  CASE WHEN n_total > 0 THEN CAST(overstock AS DOUBLE) * 100.0 / n_total ELSE 0.0 END AS overstock_pct,
  CASE WHEN n_total > 0 THEN CAST(safe AS DOUBLE) * 100.0 / n_total ELSE 0.0 END AS safe_pct,
  CASE WHEN n_total > 0 THEN CAST(stockout AS DOUBLE) * 100.0 / n_total ELSE 0.0 END AS stockout_pct
FROM (SELECT region, count(*) AS n_total,
        sum(CASE WHEN risk_label = 'Overstock Risk' THEN 1 ELSE 0 END) AS overstock,
        sum(CASE WHEN risk_label = 'Safe Zone' THEN 1 ELSE 0 END) AS safe,
        sum(CASE WHEN risk_label = 'Stockout Risk' THEN 1 ELSE 0 END) AS stockout
      FROM expl GROUP BY region)""")

sql("explorer_top200", _EXPL + """
SELECT dt, store_id, product_id, category, region, inventory_level, units_sold, demand_forecast, risk_label
FROM expl
WHERE category IN ('SIZED', 'PROMO') AND region IN ('AMERICA', 'ASIA', 'EUROPE')
ORDER BY dt DESC, store_id, product_id LIMIT 200""")

sql("rows_affected", _RD + """
SELECT sum(CASE WHEN demand_forecast < 0 THEN 1 ELSE 0 END) AS n_demand_negative,
  sum(CASE WHEN demand_forecast < 1 THEN 1 ELSE 0 END) AS n_demand_below_1, count(*) AS n_rows
FROM retail_daily""")

sql("reconstruction_summary", with_ctes(RETAIL_DAILY, CLEAN) + """
SELECT avg(inventory_level) AS mean_level, avg(inventory_reconstructed) AS mean_reconstructed,
  min(inventory_reconstructed) AS min_reconstructed,
  CAST(sum(CASE WHEN inventory_reconstructed = 0 THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / count(*)
    AS pct_zero_reconstructed
FROM recon""")

_NUM = ["inventory_reconstructed", "units_sold", "units_ordered", "price", "discount",
        "units_sold_lag1", "inventory_change_pct", "days_of_stock", "sales_velocity",
        "coverage_ratio", "forecast_error", "order_to_inventory"]
sql("summary_stats", _FEAT + " " + " UNION ALL ".join(f"""
SELECT '{c}' AS column, count(v) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std,
  min(v) AS min, round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS p50,
  round(quantile_cont(v, 0.75), 6) AS p75, max(v) AS max
FROM (SELECT CAST({c} AS DOUBLE) AS v FROM features)""" for c in _NUM))

_RATIO = with_ctes(RETAIL_DAILY) + """,
ratio AS (SELECT inventory_level / CASE WHEN demand_forecast < 1 THEN 1.0::DOUBLE ELSE demand_forecast END
          AS inv_demand_ratio FROM retail_daily)
"""
sql("ratio_quantiles", _RATIO + """
SELECT prob, round(value, 6) AS value FROM (
  SELECT unnest([0.0, 0.2, 0.4, 0.6, 0.8, 1.0]::DOUBLE[]) AS prob, unnest(qs) AS value
  FROM (SELECT quantile_cont(inv_demand_ratio, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]::DOUBLE[]) AS qs FROM ratio))""")

sql("median_by_class", _LAB + """
SELECT risk_label, 'coverage_ratio' AS column, round(quantile_cont(coverage_ratio, 0.5), 6) AS median
FROM labelled GROUP BY risk_label
UNION ALL
SELECT risk_label, 'days_of_stock' AS column, round(quantile_cont(days_of_stock, 0.5), 6) AS median
FROM labelled GROUP BY risk_label""")

_F11 = ["inventory_lag1", "units_sold_lag1", "rolling7_inventory", "inventory_change",
        "inventory_change_pct", "days_of_stock", "inventory_vs_rolling7", "sales_velocity",
        "coverage_ratio", "forecast_error", "order_to_inventory"]
sql("correlation_matrix", _FEAT + " " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM features"
    for a in _F11 for b in _F11))


def _hist(src: str, col: str, bins: int) -> str:
    return f"""
b AS (SELECT min({col}) AS lo, max({col}) AS hi FROM {src} WHERE {col} IS NOT NULL),
c AS (SELECT CASE WHEN hi = lo THEN 0 ELSE least(CAST(floor(({col} - lo) / ((hi - lo) / {bins})) AS INT), {bins - 1}) END AS bin,
             count(*) AS n
      FROM {src}, b WHERE {col} IS NOT NULL GROUP BY 1),
g AS (SELECT CAST(range AS INT) AS bin FROM range({bins}))
SELECT g.bin, lo + g.bin * ((hi - lo) / {bins}) AS bin_lo, lo + (g.bin + 1) * ((hi - lo) / {bins}) AS bin_hi,
  coalesce(c.n, 0) AS n
FROM g CROSS JOIN b LEFT JOIN c ON g.bin = c.bin"""


sql("histogram_units_sold", _RD + "," + _hist("(SELECT CAST(units_sold AS DOUBLE) AS x FROM retail_daily)", "x", 40))
sql("histogram_ratio", _RATIO + "," + _hist(
    "(SELECT CASE WHEN inv_demand_ratio > 20 THEN 20.0::DOUBLE ELSE inv_demand_ratio END AS x FROM ratio)", "x", 100))

sql("boxplot_stats", _RD + """,
long AS (SELECT 'inventory_level' AS "column", CAST(inventory_level AS DOUBLE) AS v FROM retail_daily
         UNION ALL SELECT 'units_sold', CAST(units_sold AS DOUBLE) FROM retail_daily
         UNION ALL SELECT 'demand_forecast', demand_forecast FROM retail_daily),
q AS (SELECT "column", quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
             quantile_cont(v, 0.75) AS q3 FROM long GROUP BY "column"),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_fence, q3 + 1.5 * (q3 - q1) AS hi_fence FROM q)
SELECT f."column", round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(iqr, 6) AS iqr,
  round(lo_fence, 6) AS lo_fence, round(hi_fence, 6) AS hi_fence,
  min(CASE WHEN v BETWEEN lo_fence AND hi_fence THEN v END) AS whisker_lo,
  max(CASE WHEN v BETWEEN lo_fence AND hi_fence THEN v END) AS whisker_hi,
  sum(CASE WHEN v BETWEEN lo_fence AND hi_fence THEN 0 ELSE 1 END) AS n_outliers
FROM long JOIN f USING ("column")
GROUP BY f."column", q1, median, q3, iqr, lo_fence, hi_fence""")

# --- weights and metric algebra ----------------------------------------------------------

_CW = _SPLIT + """,
cw AS (SELECT risk_label, count(*) AS n_class FROM split_lab WHERE split = 'train' GROUP BY risk_label),
cw2 AS (SELECT risk_label, n_class, sum(n_class) OVER () AS n_total, count(*) OVER () AS k FROM cw)
"""
sql("class_weights", _CW + """
SELECT risk_label, n_class, n_total, k,
  CAST(n_total AS DOUBLE) / (CAST(k AS DOUBLE) * CAST(n_class AS DOUBLE)) AS weight FROM cw2""")

sql("weighted_train_rows", _CW + """
SELECT s.store_id, s.product_id, s.dt, s.risk_label,
  CAST(n_total AS DOUBLE) / (CAST(k AS DOUBLE) * CAST(n_class AS DOUBLE)) AS weight
FROM split_lab s JOIN cw2 USING (risk_label) WHERE s.split = 'train'""")

_RULE = _STAGE1 + """,
rp AS (SELECT *, risk_label_current AS prediction_label,
         CASE WHEN dt < DATE '2000-02-01' THEN 'train' WHEN dt < DATE '2001-02-01' THEN 'val'
              ELSE 'test' END AS split FROM stage1),
cls(c) AS (VALUES ('Overstock Risk'), ('Safe Zone'), ('Stockout Risk')),
grid AS (SELECT s.split, a.c AS actual, p.c AS predicted FROM (SELECT DISTINCT split FROM rp) s, cls a, cls p),
cnt AS (SELECT split, risk_label AS actual, prediction_label AS predicted, count(*) AS n FROM rp GROUP BY ALL),
conf AS (SELECT g.split, g.actual, g.predicted, coalesce(c.n, 0) AS n FROM grid g
         LEFT JOIN cnt c USING (split, actual, predicted)),
pa AS (SELECT split, actual AS cls, sum(n) AS support, sum(CASE WHEN actual = predicted THEN n ELSE 0 END) AS tp
       FROM conf GROUP BY split, actual),
pp AS (SELECT split, predicted AS cls, sum(n) AS n_pred FROM conf GROUP BY split, predicted),
pc AS (SELECT split, cls, support, tp, n_pred,
         coalesce(CAST(tp AS DOUBLE) / CAST(nullif(n_pred, 0) AS DOUBLE), 0.0) AS precision,
         coalesce(CAST(tp AS DOUBLE) / CAST(nullif(support, 0) AS DOUBLE), 0.0) AS recall,
         coalesce(2.0 * CAST(tp AS DOUBLE) / CAST(nullif(support + n_pred, 0) AS DOUBLE), 0.0) AS f1
       FROM pa JOIN pp USING (split, cls))
"""
sql("rule_baseline_confusion", _RULE + """
SELECT split, actual, predicted, n,
  coalesce(CAST(n AS DOUBLE) / CAST(nullif(sum(n) OVER (PARTITION BY split, actual), 0) AS DOUBLE), 0.0) AS share
FROM conf""")
sql("rule_baseline_per_class", _RULE + " SELECT * FROM pc")
sql("rule_baseline_metrics", _RULE + """
SELECT split, CAST(sum(tp) AS DOUBLE) / CAST(sum(support) AS DOUBLE) AS accuracy,
  round(avg(precision), 6) AS precision_macro, round(avg(recall), 6) AS recall_macro,
  round(avg(f1), 6) AS f1_macro,
  round(sum(precision * support) / sum(support), 6) AS precision_weighted,
  round(sum(recall * support) / sum(support), 6) AS recall_weighted,
  round(sum(f1 * support) / sum(support), 6) AS f1_weighted,
  sum(support) AS n_rows
FROM pc GROUP BY split""")

# --- encoding ------------------------------------------------------------------------------

_CATS4 = ["category", "region", "weather_condition", "seasonality"]
sql("encoded_categories", _SPLIT + "," + ",".join(f"""
c_{c} AS (SELECT {c}, CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS INT) AS {c}_enc
          FROM (SELECT DISTINCT {c} FROM filled WHERE split = 'train'))""" for c in _CATS4) + """
SELECT store_id, product_id, dt, split, """ + ", ".join(f"{c}_enc" for c in _CATS4) + """
FROM filled """ + " ".join(f"JOIN c_{c} USING ({c})" for c in _CATS4))

sql("onehot_first_dropped", _SPLIT + """,
long AS (""" + " UNION ALL ".join(
    f"SELECT store_id, product_id, dt, split, '{c}' AS \"column\", {c} AS level FROM filled" for c in _CATS4) + """),
known AS (SELECT "column", level FROM (
  SELECT DISTINCT "column", level FROM long WHERE split = 'train')
  QUALIFY level <> min(level) OVER (PARTITION BY "column"))
SELECT store_id, product_id, dt, "column", level FROM long SEMI JOIN known USING ("column", level)""")

_NUM12 = ["inventory_reconstructed", "units_sold", "units_ordered", "price", "discount",
          "units_sold_lag1", "inventory_change_pct", "days_of_stock", "sales_velocity",
          "coverage_ratio", "forecast_error", "order_to_inventory"]
sql("standardized_features", _SPLIT + """,
st AS (SELECT """ + ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}, stddev_pop(CAST({c} AS DOUBLE)) AS s_{c}"
                             for c in _NUM12) + """ FROM filled WHERE split = 'train')
SELECT store_id, product_id, dt, split, """ + ", ".join(
    f"round((CAST({c} AS DOUBLE) - m_{c}) / CASE WHEN s_{c} IS NULL OR s_{c} = 0 THEN 1.0 ELSE s_{c} END, 6) AS {c}_z"
    for c in _NUM12) + " FROM filled CROSS JOIN st")

# --- scoring contract ----------------------------------------------------------------------

_REQ = [("Inventory_Reconstructed", "inventory_reconstructed", "double"),
        ("Units_Sold", "units_sold", "bigint"), ("Units_Ordered", "units_ordered", "bigint"),
        ("Price", "price", "double"), ("Discount", "discount", "bigint"),
        ("Units_Sold_Lag1", "units_sold_lag1", "double"),
        ("Inventory_Change_Pct", "inventory_change_pct", "double"),
        ("Days_of_Stock", "days_of_stock", "double"), ("Sales_Velocity", "sales_velocity", "double"),
        ("Coverage_Ratio", "coverage_ratio", "double"), ("Forecast_Error", "forecast_error", "double"),
        ("Order_to_Inventory", "order_to_inventory", "double"), ("Category", "category", "string"),
        ("Region", "region", "string"), ("Weather_Condition", "weather_condition", "string"),
        ("Seasonality", "seasonality", "string")]


def _bad(ours: str, typ: str) -> str:
    if typ == "string":
        return f"{ours} IS NULL"
    if typ == "bigint":
        return f"({ours} IS NULL OR CAST({ours} AS DOUBLE) <> floor(CAST({ours} AS DOUBLE)))"
    return f"({ours} IS NULL OR isnan({ours}) OR isinf({ours}))"


_CHECKED = with_ctes(RETAIL_DAILY, CLEAN, _FEAT_NOFILTER) + """,
checked AS (
  SELECT store_id, product_id, dt, """ + ", ".join(
    f"CASE WHEN {_bad(o, t)} THEN NULL ELSE "
    + (f"CAST({o} AS VARCHAR)" if t == "string" else f"CAST({o} AS {'BIGINT' if t == 'bigint' else 'DOUBLE'})")
    + f" END AS {o}" for _, o, t in _REQ) + """,
    concat_ws(',', """ + ", ".join(f"CASE WHEN {_bad(o, t)} THEN '{a}' END" for a, o, t in _REQ) + """) AS errors
  FROM features)
"""
sql("score_contract", _CHECKED + " SELECT *, errors = '' AS is_valid FROM checked")
sql("score_quarantine_counts", _CHECKED + """
SELECT errors = '' AS is_valid, errors, count(*) AS n FROM checked GROUP BY ALL""")

sql("label_decode", _RULE + """
SELECT store_id, product_id, dt, code,
  CASE WHEN code >= 0 AND code < 3 THEN ['Overstock Risk', 'Safe Zone', 'Stockout Risk'][code + 1]
       ELSE CAST(code AS VARCHAR) END AS decoded
FROM (SELECT store_id, product_id, dt,
        CAST(CASE prediction_label WHEN 'Overstock Risk' THEN 0 WHEN 'Safe Zone' THEN 1
                                   WHEN 'Stockout Risk' THEN 2 END + day(dt) % 3 - 1 AS INT) AS code
      FROM rp)""")


def _round(x: str, d: int) -> str:
    p = f"{10 ** d}.0::DOUBLE"
    return f"(round_even(({x}) * {p}, 0) / {p})"


_INV, _SOLD, _FORE = "CAST(inventory_level AS DOUBLE)", "CAST(units_sold AS DOUBLE)", "demand_forecast"
_LAG = _round(f"{_INV} * 1.1", 2)
_R7 = _round(f"{_INV} * 1.05", 2)
sql("cold_start_rows", _RD + """,
lv AS (SELECT * FROM """ + " CROSS JOIN ".join(f"""
  (SELECT list({c} ORDER BY {c}) AS lv_{c} FROM (SELECT DISTINCT {c} FROM retail_daily))""" for c in _CATS4) + """)
SELECT store_id, product_id, dt, inventory_level, units_sold, demand_forecast,
  """ + _LAG + """ AS inventory_lag1,
  """ + _round(f"{_SOLD} * 0.95", 2) + """ AS units_sold_lag1,
  """ + _R7 + """ AS rolling7_inventory,
  """ + _round(f"{_INV} - {_LAG}", 2) + """ AS inventory_change,
  CASE WHEN """ + _LAG + " <> 0 THEN " + _round(_round(f"{_INV} - {_LAG}", 2) + " / " + _LAG, 4) + """ ELSE 0.0 END AS inventory_change_pct,
  """ + _round(f"{_INV} - {_R7}", 2) + """ AS inventory_vs_rolling7,
  CASE WHEN """ + _SOLD + " > 0 THEN " + _round(f"{_INV} / {_SOLD}", 2) + """ ELSE 0.0 END AS days_of_stock,
  CASE WHEN """ + _FORE + " > 0 THEN " + _round(f"{_SOLD} / {_FORE}", 3) + """ ELSE 0.0 END AS sales_velocity,
  CASE WHEN """ + _FORE + " > 0 THEN " + _round(f"{_INV} / {_FORE}", 3) + """ ELSE 0.0 END AS coverage_ratio,
  """ + _round(f"{_SOLD} - {_FORE}", 2) + """ AS forecast_error,
  CASE WHEN """ + _INV + " > 0 THEN " + _round(f"{_FORE} / {_INV}", 3) + """ ELSE 0.0 END AS order_to_inventory,
  0 AS holiday_flag,
  CAST(coalesce(list_position(lv_category, category) - 1, 0) AS INT) AS category_enc,
  CAST(coalesce(list_position(lv_region, 'North') - 1, 0) AS INT) AS region_enc,
  CAST(coalesce(list_position(lv_weather_condition, 'Sunny') - 1, 0) AS INT) AS weather_condition_enc,
  CAST(coalesce(list_position(lv_seasonality, seasonality) - 1, 0) AS INT) AS seasonality_enc
FROM retail_daily CROSS JOIN lv""")

# --- prediction log, monitoring and drift ----------------------------------------------------

_PRED = _FEAT + """,
pl AS (
  SELECT store_id, product_id, dt, inventory_reconstructed AS Inventory_Reconstructed,
    units_sold AS Units_Sold, units_ordered AS Units_Ordered, price AS Price, discount AS Discount,
    units_sold_lag1 AS Units_Sold_Lag1, inventory_change_pct AS Inventory_Change_Pct,
    days_of_stock AS Days_of_Stock, sales_velocity AS Sales_Velocity, coverage_ratio AS Coverage_Ratio,
    forecast_error AS Forecast_Error, order_to_inventory AS Order_to_Inventory, category AS Category,
    region AS Region, weather_condition AS Weather_Condition, seasonality AS Seasonality,
    'rule-baseline' AS model_run_id,
    CAST(CASE """ + rule_sql("inventory_level", "demand_forecast_clean") + """
      WHEN 'Overstock Risk' THEN 0 WHEN 'Safe Zone' THEN 1 ELSE 2 END AS INT) AS prediction_encoded,
    """ + rule_sql("inventory_level", "demand_forecast_clean") + """ AS prediction_label
  FROM features)
"""
sql("prediction_log", _PRED + " SELECT * FROM pl")

sql("monitor_prediction_counts", _PRED + """
SELECT 'rows' AS field, CAST(NULL AS VARCHAR) AS value, count(*) AS n FROM pl
UNION ALL SELECT 'prediction_encoded', CAST(prediction_encoded AS VARCHAR), count(*) FROM pl GROUP BY prediction_encoded
UNION ALL SELECT 'prediction_label', prediction_label, count(*) FROM pl GROUP BY prediction_label""")

_PL_COLS = ["store_id", "product_id", "dt", "Inventory_Reconstructed", "Units_Sold", "Units_Ordered",
            "Price", "Discount", "Units_Sold_Lag1", "Inventory_Change_Pct", "Days_of_Stock",
            "Sales_Velocity", "Coverage_Ratio", "Forecast_Error", "Order_to_Inventory", "Category",
            "Region", "Weather_Condition", "Seasonality", "model_run_id", "prediction_encoded",
            "prediction_label"]
_PL_DBL = {"Inventory_Reconstructed", "Price", "Units_Sold_Lag1", "Inventory_Change_Pct", "Days_of_Stock",
           "Sales_Velocity", "Coverage_Ratio", "Forecast_Error", "Order_to_Inventory"}


def _pl_missing(c: str) -> str:
    cond = f"({c} IS NULL OR isnan({c}))" if c in _PL_DBL else f"{c} IS NULL"
    return (f"SELECT '{c}' AS \"column\", sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS n_missing, "
            f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / CAST(count(*) AS DOUBLE) "
            f"AS pct_missing FROM pl")


sql("monitor_missing", _PRED + " " + " UNION ALL ".join(_pl_missing(c) for c in _PL_COLS))

_MON = ["Inventory_Reconstructed", "Units_Sold", "Units_Ordered", "Price", "Discount", "Units_Sold_Lag1",
        "Inventory_Change_Pct", "Days_of_Stock", "Sales_Velocity", "Coverage_Ratio", "Forecast_Error",
        "Order_to_Inventory"]
sql("monitor_numeric_summary", _PRED + " " + " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count(v) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std,
  min(v) AS min, round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS p50,
  round(quantile_cont(v, 0.75), 6) AS p75, max(v) AS max
FROM (SELECT CAST({c} AS DOUBLE) AS v FROM pl)""" for c in _MON))

_HALVES = _PRED + """,
h AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY dt, store_id, product_id) <= floor(count(*) OVER () / 2)
                     THEN 'reference' ELSE 'current' END AS half FROM pl)
"""
sql("drift_halves", _HALVES + " SELECT half, count(*) AS n, min(dt) AS min_dt, max(dt) AS max_dt FROM h GROUP BY half")

_DNUM = ["Inventory_Reconstructed", "Units_Sold", "Units_Ordered", "Price", "Discount", "Units_Sold_Lag1",
         "Inventory_Change_Pct", "Days_of_Stock", "Sales_Velocity", "Coverage_Ratio", "Forecast_Error",
         "Order_to_Inventory", "prediction_encoded"]
_DCAT = ["Category", "Region", "Weather_Condition", "Seasonality", "prediction_label"]
sql("drift_statistics", _HALVES + """,
long AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS col, 'num' AS kind, CAST({c} AS DOUBLE) AS v_num, CAST(NULL AS VARCHAR) AS v_cat, half FROM h"
    for c in _DNUM) + " UNION ALL " + " UNION ALL ".join(
    f"SELECT '{c}', 'cat', CAST(NULL AS DOUBLE), CAST({c} AS VARCHAR), half FROM h" for c in _DCAT) + """),
vc AS (SELECT col, kind, v_num, v_cat, sum(CASE WHEN half = 'reference' THEN 1 ELSE 0 END) AS n_ref,
         sum(CASE WHEN half = 'current' THEN 1 ELSE 0 END) AS n_cur
       FROM long WHERE v_num IS NOT NULL OR v_cat IS NOT NULL GROUP BY ALL),
tot AS (SELECT col, kind, sum(n_ref) AS total_ref, sum(n_cur) AS total_cur, count(*) AS n_unique FROM vc GROUP BY ALL),
run AS (SELECT vc.col, v_num, n_ref, n_cur, total_ref, total_cur,
          abs(sum(n_ref) OVER w / total_ref - sum(n_cur) OVER w / total_cur) AS fdiff,
          lead(v_num) OVER (PARTITION BY vc.col ORDER BY v_num) AS next_v
        FROM vc JOIN tot USING (col) WHERE vc.kind = 'num'
        WINDOW w AS (PARTITION BY vc.col ORDER BY v_num ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
nums AS (SELECT col, max(fdiff) AS ks_d,
           sum(CASE WHEN next_v IS NOT NULL THEN fdiff * (next_v - v_num) ELSE 0.0 END) AS wasserstein
         FROM run GROUP BY col),
mref AS (SELECT col, sum(n_ref * v_num) / sum(n_ref) AS mean FROM vc WHERE kind = 'num' GROUP BY col),
sref AS (SELECT col, sqrt(sum(n_ref * (v_num - mean) * (v_num - mean)) / sum(n_ref)) AS std_ref
         FROM vc JOIN mref USING (col) GROUP BY col),
sh0 AS (SELECT vc.col, n_ref, n_cur, total_ref, total_cur,
          CASE WHEN n_ref = 0 THEN 0.0001 ELSE n_ref / total_ref END AS p0,
          CASE WHEN n_cur = 0 THEN 0.0001 ELSE n_cur / total_cur END AS q0
        FROM vc JOIN tot USING (col)),
sh AS (SELECT *, p0 / sum(p0) OVER (PARTITION BY col) AS p, q0 / sum(q0) OVER (PARTITION BY col) AS q FROM sh0),
dist AS (SELECT col, sqrt(greatest(0.0, 0.5 * sum(p * ln(p / ((p + q) / 2))) + 0.5 * sum(q * ln(q / ((p + q) / 2)))))
                AS js_distance,
           sum(CASE WHEN n_ref * (total_cur / total_ref) > 0
                    THEN (n_cur - n_ref * (total_cur / total_ref)) * (n_cur - n_ref * (total_cur / total_ref)) / (n_ref * (total_cur / total_ref))
                    WHEN n_cur > 0 THEN 'inf'::DOUBLE ELSE 0.0 END) AS chi2
         FROM sh GROUP BY col),
st AS (SELECT t.col, t.kind, total_ref, total_cur, n_unique,
         CASE WHEN total_ref <= 1000 AND t.kind = 'num' AND n_unique > 5 THEN 'ks'
              WHEN total_ref <= 1000 THEN 'chisquare'
              WHEN t.kind = 'num' AND n_unique > 5 THEN 'wasserstein' ELSE 'jensenshannon' END AS stat_test,
         ks_d, wasserstein / CASE WHEN std_ref > 0 THEN std_ref ELSE 1.0 END AS wn, js_distance, chi2
       FROM tot t LEFT JOIN nums USING (col) LEFT JOIN sref USING (col) LEFT JOIN dist USING (col))
SELECT col AS "column", kind, total_ref, total_cur, n_unique, stat_test,
  round(CASE stat_test WHEN 'ks' THEN ks_d WHEN 'chisquare' THEN chi2 WHEN 'wasserstein' THEN wn
        ELSE js_distance END, 6) AS statistic
FROM st""")

# --- sources and sinks ---------------------------------------------------------------------------

sql("csv_roundtrip", with_ctes(RETAIL_DAILY) + " SELECT * FROM retail_daily")

sql("split_parquet_roundtrip", _SPLIT + """
SELECT store_id, product_id, dt, """ + ", ".join(_NUM12) + """, category, region, weather_condition,
  seasonality, risk_label, split FROM filled WHERE split = 'val'""")

sql("prediction_log_json", _PRED + """
SELECT CAST(p.dt AS TIMESTAMP) AS ts, CAST(f.inventory_level AS DOUBLE) AS Inventory_Level,
  CAST(p.Units_Sold AS DOUBLE) AS Units_Sold, CAST(p.Units_Ordered AS DOUBLE) AS Units_Ordered,
  p.Price AS Price, CAST(p.Discount AS DOUBLE) AS Discount, p.Units_Sold_Lag1 AS Units_Sold_Lag1,
  p.Inventory_Change_Pct AS Inventory_Change_Pct, p.Days_of_Stock AS Days_of_Stock,
  p.Sales_Velocity AS Sales_Velocity, p.Coverage_Ratio AS Coverage_Ratio, p.Forecast_Error AS Forecast_Error,
  p.Order_to_Inventory AS Order_to_Inventory, p.Category AS Category, p.Region AS Region,
  p.Weather_Condition AS Weather_Condition, p.Seasonality AS Seasonality, p.prediction_encoded,
  p.prediction_label
FROM pl p JOIN features f USING (store_id, product_id, dt)""")

sql("label_classes_roundtrip", _LAB + """
SELECT CAST(row_number() OVER (ORDER BY risk_label) - 1 AS INT) AS code, risk_label AS class_name
FROM (SELECT DISTINCT risk_label FROM labelled)""")

sql("run_metrics_table", _RULE + """,
m AS (SELECT split, CAST(sum(tp) AS DOUBLE) / CAST(sum(support) AS DOUBLE) AS accuracy,
        round(avg(precision), 6) AS precision_macro, round(avg(recall), 6) AS recall_macro,
        round(avg(f1), 6) AS f1_macro FROM pc GROUP BY split)
SELECT 'rule-baseline' AS run_id, 'Rule' AS model, split, metric, round(value, 6) AS value FROM m
UNPIVOT (value FOR metric IN (accuracy, precision_macro, recall_macro, f1_macro))""")

sql("report_tables_csv", ORACLE["monitor_prediction_counts"])

sql("stream_scoring", _CHECKED + """
SELECT store_id, product_id, dt, """ + ", ".join(o for _, o, _ in _REQ) + """,
  CASE WHEN coverage_ratio < 0.2 OR days_of_stock < 3 THEN 'Stockout Risk'
       WHEN coverage_ratio > 2.0 AND days_of_stock > 30 THEN 'Overstock Risk' ELSE 'Safe Zone' END
    AS prediction_label
FROM checked WHERE errors = ''""")

sql("stream_label_counts", _PRED + """
SELECT time_bucket(INTERVAL '7 days', CAST(dt AS TIMESTAMP), TIMESTAMP '1970-01-01') AS window_start,
  time_bucket(INTERVAL '7 days', CAST(dt AS TIMESTAMP), TIMESTAMP '1970-01-01') + INTERVAL '7 days' AS window_end,
  prediction_label, count(*) AS n
FROM pl GROUP BY ALL""")

sql("prediction_log_csv", _PRED + " SELECT * FROM pl")
sql("panel_head", _RD + " SELECT * FROM retail_daily ORDER BY store_id, product_id, dt LIMIT 5")

sql("stream_late_rows", _PRED + " SELECT count(*) AS counted, 0 AS late FROM pl")

# --- seeded choices: 52 bits of an md5, the lowest win ------------------------------------


def _hash52(parts: str, seed: int) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', {parts}, '{seed}')), 1, 13) AS BIGINT)"


sql("series_sample", _RD + """,
pairs AS (SELECT *, row_number() OVER (ORDER BY """ + _hash52("store_id, product_id", 42) + """) AS r, count(*) OVER () AS n
          FROM (SELECT DISTINCT store_id, product_id FROM retail_daily))
SELECT d.* FROM retail_daily d SEMI JOIN (SELECT * FROM pairs WHERE r <= round(0.3::DOUBLE * n)) p
  ON d.store_id = p.store_id AND d.product_id = p.product_id""")

sql("stratified_split", _LAB + """
SELECT store_id, product_id, dt, risk_label,
  row_number() OVER (PARTITION BY risk_label ORDER BY """ + _hash52(
    "concat_ws('|', store_id, product_id, CAST(dt AS VARCHAR))", 42) + """)
    <= floor(0.8::DOUBLE * count(*) OVER (PARTITION BY risk_label)) AS is_train
FROM labelled""")

for _name in ("smote_class_counts", "smotenc_class_counts"):
    sql(_name, _SPLIT + """
SELECT risk_label, count(*) AS n_original, max(count(*)) OVER () - count(*) AS n_synthetic,
  0 AS changed, 0 AS outside, 0 AS strange
FROM filled WHERE split = 'train' GROUP BY risk_label""")
