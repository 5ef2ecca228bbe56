"""Catalog tables on plain Parquet: append, overwrite, key-bucketed rewrite, guards.

Tables carry the table option partitionOverwriteMode=dynamic, so an insert
overwrite replaces only the partitions it writes, moves them in place after all
tasks are done, and may read the table it writes. One writer per table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from layerkit.operators.dedupe import latest_per_key

BUCKET = "_bucket"
BUCKETS = "layerkit.buckets"  # table property: the bucket number rows were placed with
WHOLE = "layerkit.whole"  # table property: false while buckets are being replaced


def ensure_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{where}")


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_by: Iterable[str] = (),
    path: str | None = None,
) -> None:
    """Create a Parquet table unless it is there: empty, or over the files of a folder."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = ", ".join(f"`{c}`" for c in partition_by)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        "OPTIONS ('partitionOverwriteMode' = 'dynamic')" + (f" PARTITIONED BY ({by})" if by else "")
        + (f" LOCATION '{quoted(path)}'" if path else "")
    )


def quoted(text: str) -> str:
    """Text as it stands between single quotes in SQL."""
    return text.replace("\\", "\\\\").replace("'", "\\'")


def require_table(spark: SparkSession, name: str, hint: str) -> DataFrame:
    """The table, or an error that says what to run first."""
    finish_refresh(spark, name)
    if not spark.catalog.tableExists(name):
        raise LookupError(f"table {name} not found: {hint}")
    return spark.table(name)


def append(df: DataFrame, name: str, replace_partitions: bool = False) -> None:
    """Insert rows by column name; optionally replace the partitions they fall in."""
    if replace_partitions:
        _require_dynamic(df.sparkSession, name)
    columns = df.sparkSession.table(name).columns
    df.select(*columns).write.insertInto(name, overwrite=replace_partitions)


def local_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few rows of the driver as a frame of one partition, without a job or a literal for each value."""
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    arrow = to_arrow_schema(schema)
    arrays = [pa.array(list(values), f.type) for values, f in zip(columns, arrow, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema).coalesce(1)


def _require_dynamic(spark: SparkSession, name: str) -> None:
    """Refuse a table whose overwrite would also remove the partitions not written."""
    if get_property(spark, name, "option.partitionOverwriteMode") != "dynamic":
        raise ValueError(f"{name} lacks the table option partitionOverwriteMode=dynamic")


def gather(df: DataFrame, batch: str) -> DataFrame:
    """Bring the rows of a batch together before a write that spans many batches.

    Small batches share a task and a hot one is split over several, so neither
    tiny files nor one overlong task arise. A load of one batch needs none of it.
    """
    return df.hint("rebalance", batch)


def append_snapshot(df: DataFrame, path: str, batch: str, replace_batch: bool = False) -> None:
    """Add a snapshot to a Parquet log partitioned by batch."""
    writer = df.write.partitionBy(batch)
    if replace_batch:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.parquet(path)


def scan_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet log under its declared schema; filters on the batch prune folders."""
    return spark.read.schema(schema).parquet(path)


def full_refresh(df: DataFrame, name: str, partition_by: Iterable[str] = ()) -> None:
    """Replace a table with new contents and their schema.

    The rows are written once, into a new folder, so the plan may read the
    table it replaces and a failed job leaves the old table as it was. Then the
    catalog is pointed at them: first under the name with `__next`, then under
    the name itself. A run that breaks off between the two is finished by
    `finish_refresh`, which every refresh and guard calls.
    """
    spark = df.sparkSession
    finish_refresh(spark, name)
    by = list(partition_by)
    path = f"{_schema_folder(spark, name)}/{name.rpartition('.')[2]}__{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    _register(spark, f"{name}__next", df.schema, by, path)
    _point(spark, name, df.schema, by, path)


def finish_refresh(spark: SparkSession, name: str) -> None:
    """Finish a full refresh that wrote all its rows but broke off while the catalog changed."""
    waiting = f"{name}__next"
    if spark.catalog.tableExists(waiting):
        _point(spark, name, spark.table(waiting).schema, _partition_columns(spark, waiting), _folder(spark, waiting))


def _point(spark: SparkSession, name: str, schema: T.StructType, by: list[str], path: str) -> None:
    """Let the name stand for the folder; the folder it stood for goes."""
    old = _folder(spark, name) if spark.catalog.tableExists(name) else path
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    _register(spark, name, schema, by, path)
    if old != path:
        folder = spark._jvm.org.apache.hadoop.fs.Path(old)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    spark.sql(f"DROP TABLE IF EXISTS {name}__next")


def _register(spark: SparkSession, name: str, schema: T.StructType, by: list[str], path: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    ensure_table(spark, name, schema, by, path)
    if by:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def _described(spark: SparkSession, what: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE {what}").collect()
    return {row[0]: row[1] for row in rows}


def _schema_folder(spark: SparkSession, name: str) -> str:
    schema = name.rpartition(".")[0] or spark.catalog.currentDatabase()
    return _described(spark, f"SCHEMA {schema}")["Location"].rstrip("/")


def _folder(spark: SparkSession, name: str) -> str:
    return _described(spark, f"TABLE EXTENDED {name}")["Location"]


def _partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def batches(spark: SparkSession, name: str, batch: str, undated: bool = False) -> DataFrame:
    """The batches of a table partitioned by batch, from the catalog: no file is opened.

    With `undated` the rows without a batch, where there are some, count as a null batch.
    """
    value = F.regexp_extract("partition", f"^{batch}=(.*)$", 1)
    listed = spark.sql(f"SHOW PARTITIONS {name}").select(F.nullif(value, F.lit("__HIVE_DEFAULT_PARTITION__")).alias(batch))
    named = listed if undated else listed.filter(F.col(batch).isNotNull())
    # Folder names escape some characters as %XX, and no others.
    return named.select(F.try_url_decode(F.replace(batch, F.lit("+"), F.lit("%2B"))).alias(batch))


def drop_batches(
    spark: SparkSession, name: str, batch: str, doomed: Callable[[DataFrame], DataFrame]
) -> list[str]:
    """Drop whole batch partitions chosen by `doomed`; no row is read or rewritten.

    The list of batches comes from the catalog and holds one value per batch.
    Raises if one that should have gone is still there.
    """
    values = sorted(row[batch] for row in doomed(batches(spark, name, batch)).collect())
    drop_listed(spark, name, batch, values)
    return values


def drop_listed(spark: SparkSession, name: str, batch: str, values: list[str]) -> None:
    """Drop the partitions of the batches listed, as `drop_batches` does."""
    _drop_partitions(spark, name, [f"{batch} = '{quoted(value)}'" for value in values])
    left = {row[batch] for row in batches(spark, name, batch).collect()} & set(values) if values else set()
    if left:
        raise RuntimeError(f"{name} still holds the batches {sorted(left)}")


def expire_rows(
    spark: SparkSession, name: str, batch: str, day: Column, before: date, last_day: Callable[[Column], Column] = F.last_day
) -> dict[str, list[str]]:
    """Delete the rows dated before a day from a table whose batches span several days.

    `day` dates a row; a batch is named by the first day of its span, and
    `last_day` gives the last one, a month's by default. Batches that end before
    the day are dropped unread, those that straddle it are rewritten, and no
    other is touched. Rows and batches without a readable date stay. Gives the
    batches dropped and rewritten.
    """
    _require_dynamic(spark, name)
    first, bound = F.try_to_date(F.col(batch), "yyyy-MM-dd"), F.lit(before)
    spans = batches(spark, name, batch).select(batch, (last_day(first) < bound).alias("over"), (first < bound).alias("begun"))
    late = spans.filter("begun").collect()
    whole = sorted(r[batch] for r in late if r["over"])
    torn = sorted(r[batch] for r in late if not r["over"])
    _drop_partitions(spark, name, [f"{batch} = '{quoted(value)}'" for value in whole])
    if torn:
        seen = Observation()
        kept = spark.table(name).filter(F.col(batch).isin(torn)).filter(~F.coalesce(day < bound, F.lit(False)))
        append(kept.observe(seen, F.collect_set(batch).alias("left")), name, replace_partitions=True)
        emptied = sorted(set(torn) - set(seen.get["left"]))
        _drop_partitions(spark, name, [f"{batch} = '{quoted(value)}'" for value in emptied])
    return {"dropped": whole, "rewritten": torn}


def _drop_partitions(spark: SparkSession, name: str, specs: list[str]) -> None:
    if specs:
        parts = ", ".join(f"PARTITION ({spec})" for spec in specs)
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {parts}")


@dataclass(frozen=True)
class KeyedTable:
    """A Parquet table with one row per key, partitioned by a hash bucket of the key.

    Hashing spreads unique keys evenly, so buckets have like sizes; choose the
    number so that one bucket holds a few hundred MB.
    """

    name: str
    keys: tuple[str, ...]
    buckets: int = 16

    def exists(self, spark: SparkSession) -> bool:
        finish_refresh(spark, self.name)
        return spark.catalog.tableExists(self.name)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._current(spark).drop(BUCKET)

    def _current(self, spark: SparkSession) -> DataFrame:
        """The table as it is now, also when another session rewrote it."""
        spark.catalog.refreshTable(self.name)
        return spark.table(self.name)

    def with_bucket(self, df: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        return df.withColumn(BUCKET, bucket)

    def slice(self, spark: SparkSession, touched: list[int]) -> DataFrame:
        """The rows of some buckets, bucket column included; other folders are not read."""
        self._require_buckets(spark)
        table = self._current(spark)
        return table if len(touched) == self.buckets else table.filter(F.col(BUCKET).isin(touched))

    def _require_buckets(self, spark: SparkSession) -> None:
        made_with = get_property(spark, self.name, BUCKETS)
        if made_with != str(self.buckets):
            raise ValueError(f"{self.name} was built with {made_with} buckets, not {self.buckets}: rebuild it")

    def rebuild(self, df: DataFrame) -> None:
        """Replace all rows; a changed schema or bucket number replaces the table's too."""
        spark = df.sparkSession
        placed = gather(self.with_bucket(df), BUCKET)
        if self.exists(spark):
            self.mark_whole(spark, False)
        if self.exists(spark) and _types(spark.table(self.name)) != _types(placed):
            full_refresh(placed, self.name, [BUCKET])
        else:
            ensure_table(spark, self.name, placed.schema, [BUCKET])
            _require_dynamic(spark, self.name)
            self._overwrite(placed, None)
        set_property(spark, self.name, BUCKETS, str(self.buckets))
        self.mark_whole(spark, True)

    def write_buckets(self, placed: DataFrame, replaced: Iterable[int]) -> None:
        """Overwrite the replaced buckets; rows are best clustered by bucket.

        The move of many folders is not one atomic step, so the table counts as
        broken until it is done.
        """
        spark = placed.sparkSession
        _require_dynamic(spark, self.name)
        self.mark_whole(spark, False)
        self._overwrite(placed, set(replaced))
        self.mark_whole(spark, True)

    def mark_whole(self, spark: SparkSession, whole: bool) -> None:
        set_property(spark, self.name, WHOLE, str(whole).lower())

    def is_whole(self, spark: SparkSession) -> bool:
        """False after a write that broke off; rebuild the table then."""
        return get_property(spark, self.name, WHOLE) != "false"

    def _overwrite(self, placed: DataFrame, replaced: set[int] | None) -> None:
        """Write buckets and drop those of `replaced` (None: all) that got no row."""
        spark = placed.sparkSession
        written = Observation()
        columns = spark.table(self.name).columns
        rows = placed.select(*columns).observe(written, F.collect_set(BUCKET).alias("buckets"))
        rows.write.insertInto(self.name, overwrite=True)
        stored = {
            int(row["partition"].split("=")[1])
            for row in spark.sql(f"SHOW PARTITIONS {self.name}").collect()
        }
        emptied = (stored if replaced is None else stored & replaced) - set(written.get["buckets"])
        _drop_partitions(spark, self.name, [f"{BUCKET} = {b}" for b in sorted(emptied)])


PART = "_part"


@dataclass(frozen=True)
class MergedTable(KeyedTable):
    """A keyed table as a base and numbered parts beside it, read as one.

    An upsert adds a part and leaves the base alone. A part may hold a row only
    if it is newer than what the table had for its key, so a reader takes the
    newest row of the parts and, for all other keys, the base: the base is never
    shuffled for it, and parts are as small as what has changed since the last
    fold. `order` and `settle` say which row of a key is the newest.
    """

    order: tuple[str, ...] = ()
    settle: tuple[str, ...] = ()

    @property
    def parts(self) -> str:
        return f"{self.name}__parts"

    def part_numbers(self, spark: SparkSession) -> list[int]:
        """The parts, from the catalog."""
        if not spark.catalog.tableExists(self.parts):
            return []
        return sorted(int(r[PART]) for r in batches(spark, self.parts, PART).collect())

    def read(self, spark: SparkSession) -> DataFrame:
        return self.with_buckets(spark).drop(BUCKET)

    def with_buckets(self, spark: SparkSession, touched: list[int] | None = None) -> DataFrame:
        """The rows as readers see them, with their bucket; of some buckets alone where they are given."""
        base = self._current(spark) if touched is None else self.slice(spark, touched)
        if not self.part_numbers(spark):
            return base
        changed = self.changed(spark)
        if touched is not None:
            changed = changed.filter(F.col(BUCKET).isin(touched))
        keys = changed.select(BUCKET, *self.keys).alias("s")
        same = [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in (BUCKET, *self.keys)]
        return base.alias("t").join(keys, same, "left_anti").unionByName(changed)

    def changed(self, spark: SparkSession) -> DataFrame:
        """The newest row of each key that a part holds: that of its last part, so no column needs to be compared."""
        spark.catalog.refreshTable(self.parts)
        columns = self._current(spark).columns
        rows = spark.table(self.parts).select(*columns, PART)
        return latest_per_key(rows, [BUCKET, *self.keys], [PART], settle=()).select(*columns)

    def add_part(self, df: DataFrame) -> None:
        """Write rows, newer than what the table has for their keys, as the next part."""
        spark = df.sparkSession
        self._require_buckets(spark)
        placed = self.with_bucket(df)
        number = max(self.part_numbers(spark), default=0) + 1
        schema = T.StructType([*placed.schema.fields, T.StructField(PART, T.IntegerType())])
        ensure_table(spark, self.parts, schema, [PART])
        append(placed.withColumn(PART, F.lit(number)), self.parts)

    def fold(self, spark: SparkSession, staged: str | None = None) -> None:
        """Bring the parts into the base; buckets without a change are not touched.

        While buckets move the parts stay, so what is read stays the same. With
        `staged` the new rows are written down first, under that name, for a
        base that nothing else could restore.
        """
        if not self.part_numbers(spark):
            return
        touched = sorted(r[BUCKET] for r in spark.table(self.parts).select(BUCKET).distinct().collect())
        rows = self.with_buckets(spark, touched)
        if staged:
            full_refresh(rows, staged)
            rows = spark.table(staged)
        self.write_buckets(rows.repartition(BUCKET), touched)
        if staged:
            spark.sql(f"DROP TABLE IF EXISTS {staged}")

    def rebuild(self, df: DataFrame) -> None:
        spark = df.sparkSession
        placed = gather(self.with_bucket(df), BUCKET)
        if self.exists(spark):
            self.mark_whole(spark, False)
        if self.exists(spark) and _types(spark.table(self.name)) != _types(placed):
            full_refresh(placed, self.name, [BUCKET])
            self.mark_whole(spark, False)
        else:
            ensure_table(spark, self.name, placed.schema, [BUCKET])
            _require_dynamic(spark, self.name)
            self._overwrite(placed, None)
        set_property(spark, self.name, BUCKETS, str(self.buckets))
        self._drop_parts(spark)
        self.mark_whole(spark, True)

    def write_buckets(self, placed: DataFrame, replaced: Iterable[int]) -> None:
        """Overwrite buckets with rows that hold what the parts changed in them; then the parts go."""
        spark = placed.sparkSession
        _require_dynamic(spark, self.name)
        self.mark_whole(spark, False)
        self._overwrite(placed, set(replaced))
        self._drop_parts(spark)
        self.mark_whole(spark, True)

    def _drop_parts(self, spark: SparkSession) -> None:
        spark.sql(f"DROP TABLE IF EXISTS {self.parts}")


def set_property(spark: SparkSession, name: str, key: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{key}' = '{value}')")


def get_property(spark: SparkSession, name: str, key: str) -> str | None:
    shown = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return shown.get(key)


def _types(df: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema}
