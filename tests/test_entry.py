import __spark_entry__


def test_entry_runs(spark):
    got = __spark_entry__.entry(spark)
    assert got.count() > 0 and got.columns


def test_every_oracle_has_its_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
