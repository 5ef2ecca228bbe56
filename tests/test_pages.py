import json
import os
from datetime import datetime, timedelta, timezone

import pytest

from layerkit.contract import Contract
from layerkit.sources.pages import CORRUPT, add_lineage, broken_pages, good_records, load_pages, utc
from tests.conftest import at, rows

CONTRACT = Contract.of_strings(["id", "name", "extra"], ["id"])
PAGES = [
    json.dumps([{"id": "1", "name": "a", "unknown": 3}, {"id": "2"}]),
    '[{"id": 7, "name": true, "extra": {"k": 1.50}}]',
    "[]",
    '[{"id": "8", "na',
]


@pytest.fixture(params=["per_file", "per_line"])
def pages(request, spark, tmp_path):
    if request.param == "per_file":
        for i, body in enumerate(PAGES, 1):
            (tmp_path / f"page-{i:05}.json").write_text(body)
    else:
        (tmp_path / "pages.json").write_text("\n".join(PAGES))
    return load_pages(spark, str(tmp_path), CONTRACT, page_per_line=request.param == "per_line")


def test_records_follow_the_contract(pages):
    good = good_records(pages)
    assert good.columns == ["id", "name", "extra"]
    assert rows(good) == [("1", "a", None), ("2", None, None), ("7", "true", '{"k": 1.50}')]


def test_broken_pages_are_set_aside(pages):
    assert rows(broken_pages(pages)) == [(PAGES[3],)]
    assert len(pages.collect()) == 4


def test_one_clock_for_moment_and_day(spark):
    late = datetime(2024, 1, 1, 23, 30, tzinfo=timezone(timedelta(hours=-2)))
    row = add_lineage(spark.range(1), "src", late).selectExpr("*", "cast(_ingestion_ts AS string) t").first()
    assert row["_source"] == "src"
    assert row["_ingestion_date"] == "2024-01-02"
    assert row["t"] == "2024-01-02 01:30:00"
    assert utc(datetime(2024, 1, 1)) == at(1)


def test_page_files_are_listed_not_parsed_on_the_driver(spark, tmp_path):
    os.makedirs(tmp_path / "landing")
    (tmp_path / "landing" / "p.json").write_text(PAGES[0])
    df = load_pages(spark, str(tmp_path / "landing"), CONTRACT)
    assert df.columns == ["id", "name", "extra", CORRUPT]
