"""Every registered query against its DuckDB SQL at sf0.01."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF01
from tests.oracle_compare import compare, duck

SQL = {k: v for k, v in E.oracle_sql().items() if k not in E.LLM_QUERIES}
NAMES = sorted(SQL)


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF01)
    ok, msg = compare(df, con, SQL[name])
    assert ok, f"{name}: {msg}"


def test_every_query_has_oracle_or_is_listed():
    no_sql = set(E.queries()) - set(SQL) - set(E.LLM_QUERIES)
    assert no_sql <= set(E.ROWS_ONLY), no_sql
