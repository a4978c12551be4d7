"""Every registered query against its SQL on the smallest given tables."""

from pathlib import Path

import pytest

from checks.compare import compare, duck
from checks.duck_sql import SQL
from checks.spark_queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    if not Path(SF_DIR).exists():
        pytest.fail(f"the given tables are needed in {SF_DIR}")
    return duck(SF_DIR)


def test_only_seeded_queries_lack_sql():
    assert set(QUERIES) - set(SQL) == {"embed", "kmeans", "cluster"}
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    assert compare(spark, connection, name, SF_DIR).startswith(("ok", "rows only"))
