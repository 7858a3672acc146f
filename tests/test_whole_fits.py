"""Every query that fits a model fits it on all labelled train rows."""

import pytest

from shelfsense.operators import models as mdl
from shelfsense.plans import base, catalog, serving

SF = "/root/testdata/sf0.001"
ROWS = 100_500


class Fitted(Exception):
    pass


@pytest.mark.parametrize("query", [catalog.model_logistic, catalog.model_forest, catalog.model_boosting, catalog.model_selection,
                                   catalog.model_scoring, serving.model_properties])
def test_fits_see_all_train_rows(spark, monkeypatch, query):
    def look(train, spec):
        raise Fitted(train.count(), spec.fit_rows)

    frame = spark.range(ROWS + 7).selectExpr("concat('r', id) AS row_id", "cast(id % 3 AS double) AS label",
                                             f"if(id < {ROWS}, 'train', 'val') AS split")
    monkeypatch.setattr(base, "split_frame", lambda *a, **k: frame)
    monkeypatch.setattr(mdl, "model_input", lambda df: df)
    monkeypatch.setattr(mdl, "FITTERS", dict.fromkeys(mdl.FITTERS, look))
    with pytest.raises(Fitted) as seen:
        query(spark, SF)
    assert seen.value.args == (ROWS, None)


def test_a_new_spec_has_no_bound():
    assert mdl.ModelSpec("any", "forest").fit_rows is None and all(s.fit_rows is None for s in mdl.DEFAULT_SPECS)
