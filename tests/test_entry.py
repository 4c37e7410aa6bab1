"""The registered queries and the smoke query."""

import __spark_entry__ as entry_points


def test_entry_gives_rows(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
