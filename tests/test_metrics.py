import pytest

from shelfsense.config import CLASS_NAMES
from shelfsense.operators import metrics as met

# Published validation confusion matrices (rows actual, columns predicted, class order
# Overstock, Safe, Stockout) and the metrics they imply.
GOLDEN = {
    "XGBoost": ([[193, 480, 53], [1235, 2834, 684], [265, 1026, 5530]],
                (0.695691, 0.549798, 0.557609, 0.542652)),
    "Random Forest": ([[317, 332, 77], [1821, 2113, 819], [343, 833, 5645]],
                      (0.656504, 0.545130, 0.569597, 0.522946)),
    "Logistic": ([[359, 270, 97], [2080, 1711, 962], [356, 583, 5882]],
                 (0.646504, 0.547730, 0.572270, 0.508805)),
}


def conf_frame(spark, model, m):
    rows = [(model, CLASS_NAMES[i], CLASS_NAMES[j], m[i][j]) for i in range(3) for j in range(3)]
    return spark.createDataFrame(rows, "model string, actual string, predicted string, n bigint")


@pytest.mark.parametrize("model", list(GOLDEN))
def test_golden_metrics_from_confusion(spark, model):
    m, (acc, p, r, f1) = GOLDEN[model]
    s = met.summary(conf_frame(spark, model, m), ["model"]).first()
    assert s.accuracy == pytest.approx(acc, abs=1e-6)
    assert s.precision_macro == pytest.approx(p, abs=1e-6)
    assert s.recall_macro == pytest.approx(r, abs=1e-6)
    assert s.f1_macro == pytest.approx(f1, abs=1e-6)
    assert s.n_rows == 12300


def test_absent_class_gives_zero_not_error(spark):
    df = spark.createDataFrame([("Safe Zone", "Safe Zone"), ("Stockout Risk", "Safe Zone")], "a string, p string")
    conf = met.confusion(df, "a", "p")
    assert conf.count() == 9
    pc = {r.cls: r for r in met.per_class(conf).collect()}
    assert pc["Overstock Risk"].precision == 0.0 and pc["Stockout Risk"].f1 == 0.0
    norm = {(r.actual, r.predicted): r.share for r in met.normalise_rows(conf).collect()}
    assert norm[("Overstock Risk", "Safe Zone")] == 0.0


def test_balanced_weights(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 2, "risk_label string")
    w = {r.risk_label: r.weight for r in met.class_weights(df).collect()}
    assert w == {"a": 8 / (2 * 6), "b": 8 / (2 * 2)}
