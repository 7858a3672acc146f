"""DuckDB statements of the queries in ``serving`` and of the full drift table."""

from __future__ import annotations

from shelfsense.plans import oracle as o
from shelfsense.plans.oracle import ORACLE, sql

_MODEL_COLS = [ours for _, ours, _ in o._REQ]

sql("requests_filled", o._SPLIT + """,
m AS (SELECT quantile_cont(days_of_stock, 0.5) AS dos, quantile_cont(sales_velocity, 0.5) AS sv, quantile_cont(price, 0.5) AS pr
      FROM filled WHERE split = 'train'),
lv AS (SELECT DISTINCT region AS known FROM filled WHERE split = 'train'),
g AS (SELECT *, day(dt) % 7 = 3 AS a, day(dt) % 5 = 2 AS b, day(dt) % 11 = 4 AS c FROM features)
SELECT store_id, product_id, dt, a::BIGINT + b::BIGINT + c::BIGINT AS n_gaps,
  CASE WHEN a THEN dos ELSE days_of_stock END AS days_of_stock,
  CASE WHEN b THEN sv ELSE sales_velocity END AS sales_velocity,
  CASE WHEN c THEN pr ELSE price END AS price,
  CASE WHEN day(dt) IN (13, 14) OR known IS NULL THEN '(unknown)' ELSE region END AS region
FROM g CROSS JOIN m LEFT JOIN lv ON known = region""")

# Variance inflation: the diagonal of the inverse correlation matrix, inverted in place one column at a time.
_N = len(o._NUM12)
_AT = "a[k + 1][k + 1]"
sql("vif", o._SPLIT + """,
x AS (SELECT """ + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in o._NUM12) + """ FROM filled WHERE split = 'train'),
m AS (SELECT [""" + ", ".join("[" + ", ".join(f"corr({a}, {b})" for b in o._NUM12) + "]" for a in o._NUM12) + """] AS r,
  [""" + ", ".join(f"avg({c}) / stddev_pop({c})" for c in o._NUM12) + f"""] AS z FROM x),
inv(k, a) AS (SELECT 0, r FROM m UNION ALL
  SELECT k + 1, list_transform(range(1, {_N + 1}), lambda i: list_transform(range(1, {_N + 1}), lambda j:
    CASE WHEN i = k + 1 AND j = k + 1 THEN 1 / {_AT} WHEN i = k + 1 THEN a[i][j] / {_AT} WHEN j = k + 1 THEN -a[i][j] / {_AT}
         ELSE a[i][j] - a[i][k + 1] * a[k + 1][j] / {_AT} END)) FROM inv WHERE k < {_N}),
done AS (SELECT a, z FROM inv, m WHERE k = {_N})
SELECT 'const' AS feature, round(1 + list_sum(list_transform(range(1, {_N + 1}), lambda i: z[i] * list_sum(
  list_transform(range(1, {_N + 1}), lambda j: a[i][j] * z[j])))), 4) AS vif FROM done
""" + "".join(f"UNION ALL SELECT '{c}', round(a[{i + 1}][{i + 1}], 4) FROM done " for i, c in enumerate(o._NUM12)))

_NONE = "0 AS bad_sums, 0 AS bad_labels, 0 AS bad_names"
sql("requests_scored_after_reload", o._FEAT + f" SELECT count(*) AS n_rows, {_NONE}, 0 AS changed FROM features")
sql("model_properties", o._SPLIT + f" SELECT split, count(*) AS n_rows, {_NONE}, 0 AS changed FROM filled GROUP BY split")
sql("stream_model_scoring", o._CHECKED + f"""
SELECT count(*) AS n_rows, {_NONE}, 1 AS versions, 2 AS batches, 0 AS changed FROM checked WHERE errors = ''""")

sql("smote_neighbour_recall", o._SPLIT + """,
c AS (SELECT risk_label, count(*) AS n FROM filled WHERE split = 'train' GROUP BY risk_label)
SELECT risk_label, 5 * n AS n_neighbours, true AS recall_at_least_90 FROM c WHERE n < (SELECT max(n) FROM c)""")

sql("model_confusion_support", o._SPLIT + """
SELECT s.split, cls AS actual, count(risk_label) AS support, CASE WHEN count(risk_label) > 0 THEN 1.0 ELSE 0.0 END AS shares
FROM (SELECT DISTINCT split FROM filled) s
CROSS JOIN (SELECT unnest(['Overstock Risk', 'Safe Zone', 'Stockout Risk']) AS cls)
LEFT JOIN filled f ON f.split = s.split AND f.risk_label = cls GROUP BY ALL""")

_TAGS = {"run-a": "again", "run-b": "second"}
sql("run_registry", " UNION ALL ".join(f"""
SELECT '{r}' AS run_id, model, 'theta_high=4.5,theta_low=1.2' AS params, 'model_type=rule,note={note}' AS tags, split, metric, value
FROM ({ORACLE["run_metrics_table"]})""" for r, note in _TAGS.items()))

sql("stream_append_windows", ORACLE["stream_label_counts"])

_RANGES = {"discount": (0, 8), "sales_velocity": (0, 1), "units_sold": (0, 100)}


def _out(ours: str, typ: str) -> str:
    bad = o._bad(ours, typ)
    return f"({bad} OR {ours} < {_RANGES[ours][0]} OR {ours} > {_RANGES[ours][1]})" if ours in _RANGES else bad


sql("score_contract_ranges", o.with_ctes(o.RETAIL_DAILY, o.CLEAN, o._FEAT_NOFILTER) + """
SELECT errors = '' AS is_valid, errors, count(*) AS n
FROM (SELECT concat_ws(',', """ + ", ".join(f"CASE WHEN {_out(c, t)} THEN '{a}' END" for a, c, t in o._REQ) + """) AS errors
      FROM features) GROUP BY ALL""")

sql("histogram_days_of_stock", o._FEAT + """,
x AS (SELECT least(greatest(days_of_stock, 0.0), 30.0) AS v FROM features),
e AS (SELECT min(v) AS lo, max(v) AS hi FROM x),""" + o._hist("x", "v", 50).lstrip())

sql("model_columns", o._SPLIT + """,
n AS (SELECT 12 + """ + " + ".join(f"count(DISTINCT {c})" for c in o._CATS4) + """ AS n_features FROM filled WHERE split = 'train')
SELECT split, n_features::INT AS n_features, count(*) AS n_rows FROM filled, n GROUP BY ALL""")

sql("report_tables", o._PRED + """
SELECT 'codes' AS report, prediction_encoded::VARCHAR AS item, count(*)::DOUBLE AS value FROM pl GROUP BY ALL
UNION ALL SELECT 'labels', prediction_label, count(*)::DOUBLE FROM pl GROUP BY ALL
UNION ALL """ + " UNION ALL ".join(f"SELECT 'missing', \"column\", n_missing::DOUBLE FROM ({o._pl_missing(c)})" for c in o._PL_COLS)
    + " UNION ALL " + " UNION ALL ".join(f"SELECT 'numbers', '{c}', round(quantile_cont({c}::DOUBLE, 0.5), 6) FROM pl" for c in o._MON))


def _all_drift() -> str:
    """Every statistic of every column, from the parts of the drift statement."""
    parts = ORACLE["drift_statistics"].split(",\nst AS (SELECT")[0]
    parts = parts.replace("SELECT store_id, product_id, dt, inventory_reconstructed AS",
                          "SELECT store_id, product_id, dt, holiday_promotion, inventory_reconstructed AS", 1)
    last = "SELECT 'prediction_label', 'cat', CAST(NULL AS DOUBLE), CAST(prediction_label AS VARCHAR), half FROM h"
    flag = last.replace("prediction_label", "holiday_promotion")
    assert last in parts
    parts = parts.replace(last, f"{last} UNION ALL {flag}")
    lam = "((en + 0.12 + 0.11 / en) * value)"
    p_ks = (f"CASE WHEN {lam} < 0.001 THEN 1.0 ELSE list_sum(list_transform(range(1, 101), "
            f"lambda j: 2 * CASE WHEN j % 2 = 1 THEN 1 ELSE -1 END * exp(-2.0 * j * j * {lam} * {lam}))) END")
    return parts + f""",
top AS (SELECT col, max_by(n_ref, coalesce(v_cat, v_num::VARCHAR)) AS r, max_by(n_cur, coalesce(v_cat, v_num::VARCHAR)) AS c
        FROM vc GROUP BY col HAVING count(*) = 2),
every AS (
  SELECT col, 'ks' AS stat_test, ks_d AS value FROM nums
  UNION ALL SELECT col, 'wasserstein', wasserstein / CASE WHEN std_ref > 0 THEN std_ref ELSE 1.0 END FROM nums JOIN sref USING (col)
  UNION ALL SELECT col, 'jensenshannon', js_distance FROM dist
  UNION ALL SELECT col, 'chisquare', chi2 FROM dist
  UNION ALL SELECT col, 'z', (c / total_cur - r / total_ref) / sqrt((r + c) / (total_ref + total_cur)
      * (1 - (r + c) / (total_ref + total_cur)) * (1.0 / total_ref + 1.0 / total_cur)) FROM top JOIN tot USING (col))
SELECT col AS "column", kind, total_ref AS n_reference, total_cur AS n_current, stat_test, round(value, 6) AS statistic,
  CASE stat_test WHEN 'chisquare' THEN NULL WHEN 'z' THEN abs(value) > 1.959963984540054
       WHEN 'ks' THEN {p_ks} < 0.05 ELSE value >= 0.1 END AS drift_detected
FROM (SELECT *, sqrt(total_ref * total_cur / (total_ref + total_cur)) AS en FROM every JOIN tot USING (col))"""


sql("drift_all_statistics", _all_drift())
