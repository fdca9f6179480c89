import __spark_entry__ as E


def test_entry_runs_on_smoke_tables(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 3 and set(df.columns) >= {"type", "readings", "failure_rate"}


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 75
