import pytest

from check_oracle import compare, connect
from sparkprep.plans.oracle import ORACLE
from sparkprep.plans.queries import QUERIES

WITHOUT_SQL = {"quality_report"}


@pytest.fixture(scope="module")
def database(data_dir="/root/testdata/sf0.001"):
    return connect(data_dir)


def test_every_query_has_sql_or_a_reason():
    assert set(QUERIES) - set(ORACLE) == WITHOUT_SQL and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, database, data, name):
    assert compare(spark, database, data, name) == ""


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_query_runs(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0
