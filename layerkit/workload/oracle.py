"""SQL text of the same inputs, for the engine that checks the results."""

from __future__ import annotations

from layerkit import presets
from layerkit.workload.inputs import CUT

FIELDS = list(presets.FIELDS)
STAMP = "strftime(_ingestion_ts, '%Y-%m-%d %H:%M:%S.%f') AS _ingestion_ts"
RAW_COLUMNS = ", ".join([*FIELDS, "_source", STAMP, "_ingestion_date"])
GROUPS = ", ".join(presets.GROUPS)

RECORDS = """
records AS (
  SELECT CASE WHEN o_totalprice < 1500 THEN NULL WHEN o_totalprice > 499000 THEN ''
              ELSE CAST(o_custkey AS VARCHAR) END AS id,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
              WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN ''
              ELSE 'o''FALLON san-juan ' || c_name END AS name,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'MICRO' WHEN '2-HIGH' THEN 'Brewpub'
              WHEN '3-MEDIUM' THEN 'LARGE' WHEN '4-NOT SPECIFIED' THEN 'TapRoom' END AS brewery_type,
         'Lot ' || o_orderstatus AS address_1,
         CAST(NULL AS VARCHAR) AS address_2, CAST(NULL AS VARCHAR) AS address_3,
         CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '4-NOT SPECIFIED' THEN NULL
              ELSE 'old TOWN ' || lower(c_mktsegment) END AS city,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE n_name END AS state_province,
         CAST(o_custkey AS VARCHAR) AS postal_code,
         lower(r_name) AS country,
         CAST(CAST(floor(c_acctbal / 20) AS BIGINT) - 200 AS VARCHAR) AS longitude,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'n/a'
              WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN ''
              ELSE CAST(CAST(floor(o_totalprice / 2000) AS BIGINT) - 110 AS VARCHAR) END AS latitude,
         '+' || CAST(o_custkey AS VARCHAR) AS phone,
         CAST(NULL AS VARCHAR) AS website_url,
         n_name AS state,
         'Lot ' || o_orderstatus AS street,
         o_orderkey, o_orderdate, o_totalprice, o_orderpriority
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""

RAW = f"""{RECORDS},
raw AS (
  SELECT {", ".join(FIELDS)},
         'orders' AS _source,
         o_orderdate + to_microseconds(o_orderkey) AS _ingestion_ts,
         CASE WHEN o_orderpriority = '5-LOW' AND o_totalprice < 5000 THEN NULL
              ELSE strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') END AS _ingestion_date
  FROM records
)"""

IS_OLD = f"coalesce(_ingestion_date <= '{CUT}', true)"
IS_NEW = f"_ingestion_date > '{CUT}'"
NEWEST = "_ingestion_date DESC NULLS LAST, _ingestion_ts DESC NULLS LAST"


def title(column: str) -> str:
    words = f"list_transform(string_split({column}, ' '), lambda w: upper(w[1]) || lower(w[2:]))"
    return f"array_to_string({words}, ' ')"


def form_of(column: str) -> str:
    form = presets.TEXT_FORMS.get(column)
    if form == "title":
        return title(column)
    return f"{form}({column})" if form in ("upper", "lower") else column


def standard(column: str) -> str:
    shaped = form_of(column)
    return column if shaped == column else f"{shaped} AS {column}"


STANDARD = ", ".join(standard(c) for c in [*FIELDS, "_source", "_ingestion_ts", "_ingestion_date"])


def curated(name: str, source: str, where: str = "true", order: str = NEWEST) -> str:
    return f"""
{name} AS (
  SELECT {STANDARD}
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {order}) AS _n
        FROM {source} WHERE {where})
  WHERE _n = 1
)"""


CLEAN = f"{RAW},{curated('clean', 'raw')}"
COUNTS = f"SELECT {GROUPS}, count(*) AS total_breweries"
AGG = f"{CLEAN}, agg AS ({COUNTS} FROM clean GROUP BY ALL)"
OLD_NEW = f"{RAW},{curated('old', 'raw', IS_OLD)},{curated('new', 'raw', IS_NEW)}"
