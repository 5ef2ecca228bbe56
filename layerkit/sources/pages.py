"""Landed JSON pages: contract read, quarantine of broken ones, lineage columns."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.contract import Contract

CORRUPT = "_corrupt_record"

# A record in broken JSON: braces that match, two deep, text in quotes skipped; never tried twice.
_QUOTED = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_RECORD = rf'\{{(?:[^{{}}"]++|{_QUOTED}|\{{(?:[^{{}}"]++|{_QUOTED})*+\}}){{0,2000}}+\}}'
# Text up to a bare number, and the number.
_NUMBER = rf'\G((?:[^"0-9\-]++|{_QUOTED})*+)(-?[0-9][0-9.eE+\-]*+)'


def load_pages(
    spark: SparkSession, path: str, contract: Contract, page_per_line: bool = True
) -> DataFrame:
    """Records of landed pages under the contract, plus the text of broken pages.

    A page is a JSON array of records, or one record. It is kept or set aside as
    a whole: land one record per line where a broken one must not take others
    with it. Unknown fields are dropped (see unexpected_fields), absent ones are null and values of string fields keep their JSON text. Pages
    stored one per line split across tasks; page_per_line=False reads each file
    as one page, for small files only.
    """
    schema = T.StructType([*contract.schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", str(not page_per_line).lower())
        .json(path)
    )


def read_lines(spark: SparkSession, path: str, page_per_line: bool = True) -> DataFrame:
    """Landed pages as text, column `value`."""
    return spark.read.option("wholetext", str(not page_per_line).lower()).text(path)


def split_records(lines: DataFrame, contract: Contract) -> DataFrame:
    """Records of pages read as text, plus the text of what isn't a record; a broken one doesn't take others with it.

    A page that is whole is split by the parser. One that isn't is split at
    matching braces, and what lies between them, or the page where there are
    none, is set aside as well. Columns are those of load_pages: the contract's,
    and the broken text. Blank pages give nothing, nor do nulls in a list.
    Unlike the file reader the parser writes bare numbers anew (1.50 as 1.5), so
    where all columns are text they are put in quotes first, save in records
    that hold lists or records.
    """
    value, corrupt = F.col("value"), T.StructField(CORRUPT, T.StringType())
    page = F.trim(value, F.lit(" \t\r\n"))
    listed = page.startswith("[")
    whole = F.from_json(value, "array<string>")
    between = F.regexp_replace(value, _RECORD, "")
    left = F.when(F.length(F.regexp_replace(between, r"[\[\],\s]", "")) > 0, between)
    torn = F.concat(F.regexp_extract_all("value", F.lit(_RECORD), F.lit(0)), F.array(left))
    # What a list of records holds is cut out by braces too, as the parser would write its numbers anew.
    cut = F.regexp_extract_all("value", F.lit(_RECORD), F.lit(0))
    exact = whole.isNotNull() & (F.size(cut) == F.size(F.filter(whole, lambda t: t.startswith("{"))))
    others = F.filter(whole, lambda t: ~t.startswith("{"))
    texts = (
        F.when(~listed, F.array(value))
        .when(exact, F.concat(cut, others))
        .when(whole.isNotNull(), whole)
        .otherwise(torn)
    )
    text = F.col("_text")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    quoted = F.regexp_replace(text, _NUMBER, r'$1"$2"')
    flat = ~F.regexp_replace(text, _QUOTED, "").rlike(r"\[|\{[^{]*\{")
    spelt = F.when(flat, quoted).otherwise(text) if _all_text(contract) else text
    record = F.from_json(spelt, T.StructType([*contract.schema.fields, corrupt]), options)
    is_record = F.trim(text, F.lit(" \t\r\n")).startswith("{")
    other = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in contract.schema], text.alias(CORRUPT))
    rows = lines.filter(F.length(page) > 0).select(F.explode(texts).alias("_text")).filter("_text is not null")
    parsed = rows.select(F.when(is_record, record).otherwise(other).alias("r"), "_text").select("r.*", "_text")
    return parsed.withColumn(CORRUPT, F.when(F.col(CORRUPT).isNotNull(), F.col("_text"))).drop("_text")


def _all_text(contract: Contract) -> bool:
    return all(isinstance(f.dataType, T.StringType) for f in contract.schema)


def unexpected_fields(
    spark: SparkSession, path: str, contract: Contract, page_per_line: bool = True
) -> DataFrame:
    """Fields of landed records that the contract doesn't know: name, and the records that fill it.

    The contract read never sees them, so the pages are read as text and only
    the names of their fields are kept.
    """
    return unexpected_of(read_lines(spark, path, page_per_line), contract)


def unexpected_of(pages: DataFrame, contract: Contract) -> DataFrame:
    """The same of pages that were read as text."""
    page = F.ltrim("value", F.lit(" \t\r\n"))
    records = F.when(
        page.startswith("["), F.from_json("value", "array<map<string,string>>")
    ).otherwise(F.array(F.from_json("value", "map<string,string>")))
    record = pages.select(F.explode(records).alias("record"))
    filled = record.select(F.explode("record").alias("unexpected_column", "value")).filter("value is not null")
    return (
        filled.filter(~F.col("unexpected_column").isin(contract.columns))
        .groupBy("unexpected_column")
        .agg(F.count(F.lit(1)).alias("filled_rows"))
    )


def good_records(pages: DataFrame) -> DataFrame:
    return pages.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def broken_pages(pages: DataFrame) -> DataFrame:
    """The text of broken pages. The JSON reader refuses to read that column alone."""
    other = F.col(pages.columns[0]).cast("string")
    return pages.filter(F.col(CORRUPT).isNotNull()).select(F.coalesce(CORRUPT, other).alias(CORRUPT))


def utc(moment: datetime) -> datetime:
    """A naive moment is taken as UTC."""
    return moment.replace(tzinfo=timezone.utc) if moment.tzinfo is None else moment.astimezone(timezone.utc)


def add_lineage(df: DataFrame, source: str, as_of: datetime) -> DataFrame:
    """Source tag, load time and load date, all from one clock reading."""
    moment = utc(as_of)
    return df.withColumns(
        {
            "_source": F.lit(source),
            "_ingestion_ts": F.lit(moment),
            "_ingestion_date": F.lit(moment.strftime("%Y-%m-%d")),
        }
    )
