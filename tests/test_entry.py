"""Driver contract: entry smoke check and every registered query runs."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL


def test_entry_has_rows_and_stable_schema(spark):
    a = E.entry(spark)
    b = E.entry(spark)
    assert a.schema == b.schema
    assert a.count() > 0


def test_every_query_has_an_oracle_or_is_rows_only():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    own = {n for n in q if n != "pipeline" and not (n[:2] == "op" and n[2].isdigit())}
    assert own <= set(s)


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_runs_at_smallest_scale(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert df.count() >= 0
    assert len(set(df.columns)) == len(df.columns)
