"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry
from pressmill.catalog import ORACLE, QUERIES
from tests.oracle import compare, connect

# Long fits are tested on their own.
SLOW = {"train_multi_seed"}


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, connection, sf_dir, name):
    assert compare(spark, connection, sf_dir, QUERIES[name], ORACLE[name]) is None


def test_only_training_has_no_sql():
    assert set(QUERIES) - set(ORACLE) == SLOW


def test_entry(spark):
    result = entry(spark)
    assert result.count() == 22
    sizes = {r["split"]: r["count"] for r in result.groupBy("split").count().collect()}
    assert sizes == {"train": 17, "val": 2, "test": 3}
