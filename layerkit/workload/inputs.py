"""The given tables read as a raw log: every order is one sighting of its customer.

Months are the load batches. Customers recur across months and move between
types and places, so the log has duplicate keys, late changes, null and blank
values, unreadable and out-of-range coordinates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit import presets
from layerkit.contract import Contract
from layerkit.functions.text import standardize
from layerkit.operators.aggregate import group_count
from layerkit.operators.dedupe import latest_per_key
from layerkit.session import scratch_dir

BATCH = "_ingestion_date"
CUT = "2000-12-01"


# Declared, so that opening a table reads no footer.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer and place. Catalyst broadcasts a side only if its size allows."""
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customer = table(spark, sf_dir, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))


def record_columns() -> list[Column]:
    """The contract's record columns over a sighting."""
    price, status, priority = F.col("o_totalprice"), F.col("o_orderstatus"), F.col("o_orderpriority")
    lot = F.concat(F.lit("Lot "), status)
    none = F.lit(None).cast("string")
    values = {
        "id": F.when(price < 1500, none).when(price > 499000, "").otherwise(F.col("o_custkey").cast("string")),
        "name": F.when((status == "P") & (priority == "5-LOW"), none)
        .when((status == "F") & (priority == "5-LOW"), "")
        .otherwise(F.concat(F.lit("o'FALLON san-juan "), F.col("c_name"))),
        "brewery_type": F.when(priority == "1-URGENT", "MICRO")
        .when(priority == "2-HIGH", "Brewpub")
        .when(priority == "3-MEDIUM", "LARGE")
        .when(priority == "4-NOT SPECIFIED", "TapRoom"),
        "address_1": lot,
        "address_2": none,
        "address_3": none,
        "city": F.when((status == "O") & (priority == "4-NOT SPECIFIED"), none).otherwise(
            F.concat(F.lit("old TOWN "), F.lower("c_mktsegment"))
        ),
        "state_province": F.when(F.col("c_acctbal") < 0, none).otherwise(F.col("n_name")),
        "postal_code": F.col("o_custkey").cast("string"),
        "country": F.lower("r_name"),
        "longitude": (F.floor(F.col("c_acctbal") / 20) - 200).cast("string"),
        "latitude": F.when((status == "P") & (priority == "1-URGENT"), "n/a")
        .when((status == "F") & (priority == "1-URGENT"), "")
        .otherwise((F.floor(price / 2000) - 110).cast("string")),
        "phone": F.concat(F.lit("+"), F.col("o_custkey").cast("string")),
        "website_url": none,
        "state": F.col("n_name"),
        "street": lot,
    }
    return [values[name].alias(name) for name in presets.FIELDS]


def load_columns() -> list[Column]:
    """Lineage of a sighting: the moment of the order, and its month as the batch."""
    moment = F.timestamp_micros(F.unix_micros(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey"))
    undated = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_totalprice") < 5000)
    month = F.date_format(F.trunc("o_orderdate", "month"), "yyyy-MM-dd")
    return [
        F.lit("orders").alias("_source"),
        moment.alias("_ingestion_ts"),
        F.when(~undated, month).alias(BATCH),
    ]


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sightings(spark, sf_dir).select(*record_columns(), *load_columns())


def curated(rows: DataFrame) -> DataFrame:
    """Clean rows of the log; an order's moment is unique, so the order columns never tie."""
    contract: Contract = presets.CONTRACT
    newest = latest_per_key(rows, contract.keys, contract.order, settle=())
    return standardize(newest, presets.TEXT_FORMS)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curated(raw(spark, sf_dir))


def agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_count(clean(spark, sf_dir), presets.GROUPS, presets.MEASURE)


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as files, so that several checks derive them once."""
    folder = scratch_dir(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def plain(df: DataFrame) -> DataFrame:
    """Timestamps as text, so that results compare alike on every engine."""
    stamps = [f.name for f in df.schema if f.dataType.typeName().startswith("timestamp")]
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in stamps})


def landed_pages(df: DataFrame, page: str) -> DataFrame:
    """Rows as response bodies, one JSON array per line; `page` numbers a bounded run of rows."""
    fields = [c for c in df.columns if c != page]
    record = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    body = F.concat(F.lit("["), F.array_join(F.collect_list(record), ","), F.lit("]"))
    return df.groupBy(page).agg(body.alias("value")).select("value")
