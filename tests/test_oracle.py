"""Every query with a SQL check gives the rows DuckDB gives; the others give rows."""

import pytest

from millrace.catalog import CHECKS, QUERIES
from oracle import DATA, check

FOLDER = f"{DATA}/sf0.001"
pytest.importorskip("duckdb")


@pytest.mark.parametrize("key", sorted(CHECKS))
def test_matches_sql(spark, key):
    _, _, fault = check(spark, key, QUERIES[key], CHECKS[key], FOLDER)
    assert not fault
