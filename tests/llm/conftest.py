from __future__ import annotations

import pytest

from layerkit.llm.common import importable


@pytest.fixture(autouse=True)
def workers(spark):
    importable(spark)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def odd(spark):
    """Nulls, empty, blank, long and repeated texts, ties, and columns named like those operators make."""
    rows = [
        (1, "the cat sat on the mat and the cat sat on the mat", "en", None, 1),
        (1, "the cat sat on the mat and the cat sat on the mat", "en", None, 1),
        (2, None, None, "s", None),
        (3, "", "en", "s", 0),
        (4, " \n\t ", "fr", "s", 4),
        (None, "le chat est là", "fr", "s", 14),
        (5, "x" * 30_000, None, "s", 1),
        (6, "de la " * 8_000, "fr", "s", 1),
        (7, "日本語 ﬁ 😀 \x00 ▁", "ja", "s", 1),
        (8, "12 34 #$%", "en", "s", 1),
    ]
    extra = ["row", "key", "h", "fp", "k1", "piece", "n_words", "kept", "label", "slot", "_t"]
    frame = spark.createDataFrame(rows, DOCS)
    return frame.selectExpr("*", *[f"'x' as `{c}`" for c in extra])


@pytest.fixture
def nothing(odd):
    return odd.filter("false")
