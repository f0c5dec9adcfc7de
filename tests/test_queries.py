"""Every query with a SQL twin against DuckDB; the others for rows and schema."""

import pytest

from pennant import queries
from tests.compare import same


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_twin(spark, sf, name):
    same(queries.QUERIES[name](spark, sf), queries.ORACLE_SQL[name], sf)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL)))
def test_rows(spark, sf, name):
    df = queries.QUERIES[name](spark, sf)
    assert df.columns and df.count() > 0
