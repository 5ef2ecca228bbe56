from pyspark.sql import types as T

from layerkit import presets
from layerkit.contract import Contract, drift_report, missing_report
from tests.conftest import rows

VISIT = Contract.of_strings(["id", "n", "nested", "absent"], ["id"])


def test_projection_drops_extras_and_fills_absent(spark):
    df = spark.createDataFrame([(1, True, {"k": 1.5}, "x")], "id int, n boolean, nested map<string,double>, extra string")
    out = VISIT.project(df)
    assert out.columns == ["id", "n", "nested", "absent"]
    assert all(f.dataType == T.StringType() for f in out.schema)
    assert rows(out) == [("1", "true", '{"k":1.5}', None)]


def test_preset_contract_has_the_lineage_columns():
    assert len(presets.CONTRACT.columns) == 16
    assert presets.CONTRACT.raw_schema.names[-3:] == ["_source", "_ingestion_ts", "_ingestion_date"]
    assert presets.CONTRACT.raw_schema["_ingestion_date"].dataType == T.StringType()


def test_drift_and_missing_reports(spark):
    df = spark.createDataFrame([("1", None, "x"), ("2", "y", None)], "id string, odd string, n string")
    assert rows(drift_report(df, VISIT)) == [("odd", 1)]
    assert rows(missing_report(df, VISIT.columns)) == [("absent", 2), ("nested", 2)]
    assert rows(missing_report(df, ["id"])) == []
    assert rows(drift_report(df.drop("odd"), VISIT)) == []


def test_lineage_columns_are_not_drift(spark):
    df = spark.createDataFrame([("1", "s")], "id string, _source string")
    assert VISIT.unexpected(df.columns) == []
    assert VISIT.missing(df.columns) == ["n", "nested", "absent"]
