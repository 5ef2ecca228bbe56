"""Queries beside the SQL that must give the same rows."""

import pytest

from layerkit.llm import ORACLES, QUERIES
from tests.oracle import connect, difference

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["op4_substring_dedup", "op6_embedding_near_dedup", "quality_counts", "url_given_rules"])
def test_query_matches_its_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None
