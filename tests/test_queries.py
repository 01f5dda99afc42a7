"""Every registered query against the same question in SQL."""

import compare
import pytest

import __spark_entry__ as entry_points

QUERIES = entry_points.queries()
SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return compare.database(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, con, name):
    got = compare.spark_rows(QUERIES[name](spark, small))
    if name in SQL:
        assert got == compare.sql_rows(con, SQL[name])
    else:
        assert got[1]


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["day", "series", "v"]


def test_rows_per_file_counts_all_rows(spark, small, con):
    rows = QUERIES["rows_per_file"](spark, small).collect()
    assert sum(r.rows for r in rows) == con.execute("SELECT count(*) FROM lineitem").fetchone()[0]
