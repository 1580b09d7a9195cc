import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert {"class", "precision", "recall", "f_measure", "name"} <= set(df.columns)


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_roundtrip_partition_pruning(spark):
    from lexiflow.plans.catalog import q_feature_roundtrip
    from tests.conftest import SF001
    rows = {r["split"]: r for r in q_feature_roundtrip(spark, SF001).collect()}
    assert set(rows) == {"train", "test", "val"}
    assert sum(r["n_rows"] for r in rows.values()) == 200
