import __spark_entry__ as E


def test_entry_returns_rows(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"region", "risk_label", "n", "pct"}


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
