import pytest

import __spark_entry__ as entry

from .oracle import compare, connect

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, con, sf, name):
    assert compare(spark, con, sf, name, entry.queries()[name], ORACLES[name]) == ""


def test_rows_only_queries_run(spark, sf):
    for name in ("record_markdown", "html_to_text", "html_fields"):
        assert entry.queries()[name](spark, sf).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
