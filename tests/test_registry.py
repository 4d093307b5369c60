import oracle_check
import pytest

import __spark_entry__
from larder.workload.registry import REGISTRY

SF = "/root/testdata/sf0.001"
QUERIES, SQL = __spark_entry__.queries(), __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def oracle():
    return oracle_check.connect(SF)


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", SQL)
def test_query_agrees_with_its_oracle(spark, oracle, name):
    assert oracle_check.differences(QUERIES[name](spark, SF), oracle, SQL[name]) == []


@pytest.mark.parametrize("sf_dir", [SF, "/root/testdata/sf0.01"])
def test_no_comparison_is_empty(sf_dir):
    connection = oracle_check.connect(sf_dir)
    rows = {n: connection.execute(f"select count(*) from ({q.sql})").fetchone()[0] for n, q in REGISTRY.items()}
    assert [name for name, n in rows.items() if n == 0] == []


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
