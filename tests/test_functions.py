
from layerkit.functions import predicates as p
from layerkit.functions.text import standardize, to_number
from tests.conftest import rows


def names(df, failing):
    return sorted(r["lat"] or "" for r in df.filter(failing).collect())


def test_title_case_splits_on_spaces_only(edge):
    first = standardize(edge.filter("id = 'a' AND ts = 1 AND day = '2024-01-01'"), {"name": "title", "type": "lower"})
    row = first.first()
    assert (row["name"], row["type"]) == ("O'fallon San-juan", "micro")


def test_standardize_is_one_projection_and_idempotent(edge):
    forms = {"name": "title", "type": "lower", "state": "upper", "lat": "string"}
    once = standardize(edge, forms)
    assert once.columns == edge.columns
    assert rows(standardize(once, forms)) == rows(once)


def test_numbers_parse_tolerantly(edge):
    parsed = {r["lat"]: r["n"] for r in edge.withColumn("n", to_number("lat")).collect()}
    assert parsed["45.0"] == 45.0 and parsed["n/a"] is None and parsed[""] is None
    assert parsed["45d"] == 45.0  # a suffix the cast accepts


def test_missing_with_and_without_blank(edge):
    assert edge.filter(p.missing("id")).count() == 2
    assert edge.filter(p.missing("id", blank=True)).count() == 3
    assert edge.filter(p.any_missing(["name", "type"])).count() == 2


def test_not_castable_ignores_null_and_blank(edge):
    assert names(edge, p.not_castable("lat")) == ["n/a"]


def test_out_of_range_counts_nan(edge):
    assert names(edge, p.out_of_range("lat", -90, 90)) == ["91", "NaN"]
    assert names(edge, p.out_of_range("lat", low=1)) == ["0"]


def test_null_passes_set_and_canonical(edge):
    assert [r["type"] for r in edge.filter(p.not_in_set("type", ["micro", "large", "MICRO"])).collect()] == ["bar"]
    assert [r["type"] for r in edge.filter(p.not_canonical("type", "lower")).collect()] == ["MICRO"]


def test_predicates_stay_expressions(edge):
    plan = edge.filter(p.not_canonical("type", "lower"))._jdf.queryExecution().toString()
    assert "Python" not in plan
