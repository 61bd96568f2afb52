import pytest

from tabulith.plans.registry import QUERIES
from tests.conftest import DATA
from tests.oracle import compare


@pytest.mark.parametrize("name", [k for k, (_, sql) in QUERIES.items() if sql])
def test_matches_sql(spark, name):
    query, sql = QUERIES[name]
    compare(spark, query, sql, DATA / "sf0.001")
