import pytest

import __spark_entry__ as contract
from layerkit.workload import ORACLES, QUERIES
from layerkit.workload.inputs import SCHEMAS, table
from tests.oracle import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.columns == ["country", "state_province", "city", "brewery_type", "total_breweries"]
    assert df.count() > 0


def test_declared_schemas_are_those_of_the_files(spark):
    for name in SCHEMAS:
        found = spark.read.parquet(f"{SF}/{name}.parquet").schema
        assert table(spark, SF, name).schema.simpleString() == found.simpleString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_oracle(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, ORACLES[name]) is None
