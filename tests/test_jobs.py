import json

import pytest

from layerkit import jobs
from layerkit.plans.layers import Layers, create, refresh
from tests.conftest import rows


def test_tasks_run_one_after_another(spark, schema, tmp_path, folder):
    (tmp_path / "p.json").write_text(json.dumps([{"id": "1", "name": "ann", "country": "x"}]))
    common = ["--schema", schema, "--landing", str(tmp_path), "--clean-buckets", "2", "--agg-buckets", "1"]

    def run(task, *more):
        return jobs.main([task, *common, *more], spark)

    run("ingest", "--as-of", "2024-01-01T00:00:00")
    run("rebuild-clean")
    run("rebuild-agg")
    run("daily", "--as-of", "2024-01-02T00:00:00")
    assert spark.table(f"{schema}.raw").count() == 2
    run("fold")  # from here on the base alone is the whole of clean
    assert rows(spark.table(f"{schema}.clean").select("id", "name", "_ingestion_date")) == [("1", "Ann", "2024-01-02")]
    assert run("quality") is False
    with pytest.raises(RuntimeError):
        run("quality", "--must-pass")
    run("stream", "--checkpoint", folder)
    run("weekly", "--as-of", "2024-06-01T00:00:00")
    assert run("expire") == {"2024-06-01": 1}


def test_arguments_are_checked():
    for argv in (["daily", "--schema", "s"], ["stream", "--schema", "s"], ["nope", "--schema", "s"]):
        with pytest.raises(SystemExit):
            jobs.parse(argv)


def test_layers_may_live_in_different_schemas(spark, schema, tmp_path):
    names = {"raw": f"{schema}_r.log", "clean": f"{schema}_c.entities", "agg": f"{schema}_a.counts"}
    layers = Layers(schema=schema, names=names, clean_buckets=2, agg_buckets=1)
    create(spark, layers)
    refresh(spark, layers)
    assert spark.table(f"{schema}_c.entities").count() == 0
    assert spark.table(f"{schema}_a.counts").count() == 0
    assert layers.quarantine == f"{schema}_r.log_quarantine"
