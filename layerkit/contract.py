"""Declared column contracts: read schema, projection and column drift."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINEAGE = T.StructType(
    [
        T.StructField("_source", T.StringType()),
        T.StructField("_ingestion_ts", T.TimestampType()),
        T.StructField("_ingestion_date", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Contract:
    """Columns of a record, the key that identifies it and the columns that date it."""

    schema: T.StructType
    keys: tuple[str, ...]
    order: tuple[str, ...] = ("_ingestion_date", "_ingestion_ts")

    @staticmethod
    def of_strings(names: Iterable[str], keys: Iterable[str], **kwargs) -> Contract:
        fields = [T.StructField(n, T.StringType()) for n in names]
        return Contract(T.StructType(fields), tuple(keys), **kwargs)

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def raw_schema(self) -> T.StructType:
        """Record columns followed by the lineage columns."""
        return T.StructType(self.schema.fields + LINEAGE.fields)

    def project(self, df: DataFrame) -> DataFrame:
        """Keep the declared columns in order: extras go, absent ones become null."""
        return df.select(*[_conform(df, field) for field in self.schema])

    def unexpected(self, columns: Iterable[str]) -> list[str]:
        """Columns outside the contract and its lineage."""
        return sorted(set(columns) - set(self.raw_schema.names))

    def missing(self, columns: Iterable[str]) -> list[str]:
        """Contract columns that are absent."""
        present = set(columns)
        return [name for name in self.columns if name not in present]


def _conform(df: DataFrame, field: T.StructField) -> Column:
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType).alias(field.name)
    value = F.col(f"`{field.name}`")
    nested = isinstance(df.schema[field.name].dataType, (T.StructType, T.ArrayType, T.MapType))
    if nested and isinstance(field.dataType, T.StringType):
        return F.to_json(value).alias(field.name)
    return value.cast(field.dataType).alias(field.name)


def drift_report(df: DataFrame, contract: Contract) -> DataFrame:
    """Each column outside the contract with the number of rows that fill it."""
    extra = contract.unexpected(df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(f"`{c}`").alias(c) for c in extra])
    rows = [
        F.struct(F.lit(c).alias("unexpected_column"), F.col(f"`{c}`").alias("filled_rows"))
        for c in extra
    ]
    return _explode(counts, rows, "unexpected_column: string, filled_rows: bigint")


def missing_report(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Each required column that is absent with the number of rows lacking it."""
    present = set(df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("_rows"))
    rows = [
        F.struct(F.lit(c).alias("missing_column"), F.col("_rows").alias("affected_rows"))
        for c in required
        if c not in present
    ]
    return _explode(counts, rows, "missing_column: string, affected_rows: bigint")


def _explode(counts: DataFrame, rows: list[Column], fields: str) -> DataFrame:
    array = F.array(*rows).cast(f"array<struct<{fields}>>")
    return counts.select(F.explode(array).alias("row")).select("row.*")
