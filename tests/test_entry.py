"""The driver's entry: names, SQL for the names only, and a query next to its SQL."""

import __spark_entry__ as entry


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {"label_counts", "macro_f1", "cost_rollup"} <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
