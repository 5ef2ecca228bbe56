"""The entity data model: record contract, text forms, group keys and layer checks."""

from __future__ import annotations

from layerkit.contract import Contract
from layerkit.quality.rules import (
    Canonical,
    Castable,
    HasColumns,
    InRange,
    InSet,
    MinRows,
    NoExtraColumns,
    NotMissing,
    Rule,
    Unique,
)

# Record fields, text forms, group keys, allowed types, limits,
# and the names of the checks below.
FIELDS = (
    "id",
    "name",
    "brewery_type",
    "address_1",
    "address_2",
    "address_3",
    "city",
    "state_province",
    "postal_code",
    "country",
    "longitude",
    "latitude",
    "phone",
    "website_url",
    "state",
    "street",
)
TEXT_FORMS = {
    "country": "upper",
    "name": "title",
    "city": "title",
    "state_province": "title",
    "brewery_type": "lower",
    "latitude": "string",
    "longitude": "string",
}
GROUPS = ("country", "state_province", "city", "brewery_type")
MEASURE = "total_breweries"
TYPES = (
    "micro",
    "regional",
    "brewpub",
    "large",
    "contract",
    "planning",
    "proprietor",
    "closed",
)
RETENTION_DAYS = 60

CONTRACT = Contract.of_strings(FIELDS, keys=("id",))

_PARSED = {"latitude": "lat_num", "longitude": "lon_num"}


def raw_rules() -> list[Rule]:
    return [
        NotMissing("completeness_id", ("id",), blank=True),
        NotMissing("completeness_name", ("name",), blank=True),
        Unique("uniqueness_id_snapshot", ("id", "_ingestion_date")),
        NotMissing("freshness_ingestion_date", ("_ingestion_date",)),
        NoExtraColumns("schema_drift", tuple(CONTRACT.raw_schema.names)),
        MinRows("non_empty_batch", 1),
    ]


def clean_rules() -> list[Rule]:
    return [
        Unique("uniqueness_id", ("id",)),
        NotMissing("completeness_name", ("name",)),
        NotMissing("completeness_city", ("city",)),
        NotMissing("completeness_country", ("country",)),
        Castable("valid_geolocation_cast", ("latitude", "longitude"), shown_as=_PARSED),
        InRange(
            "valid_geolocation_range",
            {"latitude": (-90, 90), "longitude": (-180, 180)},
            shown_as=_PARSED,
        ),
        InSet("valid_brewery_type", "brewery_type", TYPES),
        Canonical("standardized_country_format", "country", "upper"),
    ]


def agg_rules() -> list[Rule]:
    return [
        InRange("valid_positive_counts", {MEASURE: (0, None)}),
        NotMissing("completeness_grouping_keys", ("country", "city", "brewery_type")),
        Canonical("standardized_country_format", "country", "upper"),
        HasColumns("structural_keys_present", (*GROUPS, MEASURE)),
    ]
