import __spark_entry__ as e


def test_names_match():
    assert set(e.oracle_sql()) <= set(e.queries())
