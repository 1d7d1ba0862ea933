"""Every registered query against DuckDB, on whole tables: rows, columns and types."""

import pytest
from compare import differences, loose_type, oracle

from lendscape.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_same_result_as_sql(spark, con, name):
    q = QUERIES[name]
    df, expected = q.run(spark, SF), con.sql(q.sql)
    assert {c: loose_type(t) for c, t in df.dtypes} == {
        c: loose_type(str(t)) for c, t in zip(expected.columns, expected.types)
    }
    assert differences(df, con, q.sql) is None


def test_every_query_has_sql():
    assert [n for n, q in QUERIES.items() if q.sql is None] == []
