"""The layered tables and the jobs that fill them.

raw    append log of records, partitioned by load date
clean  newest standardised row per key
agg    rows of clean counted per group
audit  status of every quality check, with samples of failing rows
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit import presets
from layerkit.contract import Contract
from layerkit.functions.text import standardize
from layerkit.operators.aggregate import apply_delta, group_count, row_counts, tracked_delta
from layerkit.operators.dedupe import can_order, latest_per_key
from layerkit.operators.incremental import new_rows, read_watermark
from layerkit.operators.retention import expired
from layerkit.operators.upsert import same_key, upsert_tracking
from layerkit.quality.evaluate import check_status, error_records, repeated_keys, verdict
from layerkit.quality.log import audit_rows, ensure_log_tables, error_rows, log
from layerkit.quality.rules import Rule
from layerkit.quality.states import merged_status, refresh_states
from layerkit.sources.pages import (
    CORRUPT,
    add_lineage,
    broken_pages,
    good_records,
    load_pages,
    split_records,
    unexpected_fields,
    utc,
)
from layerkit.sources.tables import (
    BUCKET,
    KeyedTable,
    MergedTable,
    append,
    batches,
    drop_listed,
    ensure_schema,
    ensure_table,
    finish_refresh,
    full_refresh,
    gather,
    get_property,
    local_rows,
    require_table,
    set_property,
)

BATCH = "_ingestion_date"
MOMENT = "_ingestion_ts"
CUT = "layerkit.cut"  # property of raw: retention has dropped batches
LEDGER = T.StructType(
    [
        T.StructField("load", T.StringType()),
        T.StructField("step", T.StringType()),  # begun, done or expired
        T.StructField("_source", T.StringType()),
        T.StructField(BATCH, T.StringType()),
        T.StructField("newest", T.TimestampType()),
        T.StructField("row_count", T.LongType()),
    ]
)
MERGED = T.StructType([T.StructField("load", T.StringType()), T.StructField(BATCH, T.StringType())])
UNLISTED = "unlisted"  # stands for a load that the ledger doesn't know
REPLACED = "layerkit.replaced"  # property of clean: days whose raw rows were replaced after it was built


@dataclass(frozen=True)
class Layers:
    """Table names, data model and rules of one set of layers."""

    schema: str
    names: Mapping[str, str] = field(default_factory=dict)  # layer -> table, where not schema.layer
    source: str = "pages"
    contract: Contract = presets.CONTRACT
    text_forms: Mapping[str, str] = field(default_factory=lambda: presets.TEXT_FORMS)
    groups: tuple[str, ...] = presets.GROUPS
    measure: str = presets.MEASURE
    raw_rules: Callable[[], list[Rule]] = presets.raw_rules
    clean_rules: Callable[[], list[Rule]] = presets.clean_rules
    agg_rules: Callable[[], list[Rule]] = presets.agg_rules
    retention_days: int = presets.RETENTION_DAYS
    drop_null_keys: bool = False
    clean_buckets: int = 16
    agg_buckets: int = 4
    full_snapshots: bool = False  # every load holds all keys, so raw alone can rebuild clean
    sample_rows: int = 50  # failing rows logged per check
    fold_after: int = 64  # parts beside clean's base before a merge folds them in

    def table(self, layer: str) -> str:
        return self.names.get(layer, f"{self.schema}.{layer}")

    @property
    def raw(self) -> str:
        return self.table("raw")

    @property
    def quarantine(self) -> str:
        return f"{self.raw}_quarantine"

    @property
    def drift(self) -> str:
        """Fields that were landed but are not in the contract, per load."""
        return f"{self.raw}_drift"

    @property
    def clean(self) -> MergedTable:
        name, contract = self.table("clean"), self.contract
        return MergedTable(name, contract.keys, self.clean_buckets, tuple(contract.order), self.settle)

    @property
    def settle(self) -> tuple[str, ...]:
        """What settles rows of a key with the same order columns: the groups first, then the rest.

        With the groups first, a pass over keys and groups alone finds the same
        groups as one over whole rows, and any split into merges gives the rows
        that a rebuild gives.
        """
        contract = self.contract
        known = [*contract.keys, *contract.order, *self.groups]
        rest = [f.name for f in contract.raw_schema if f.name not in known and can_order(f.dataType)]
        return (*self.groups, *rest)

    @property
    def agg(self) -> KeyedTable:
        return KeyedTable(self.table("agg"), self.groups, self.agg_buckets)

    @property
    def ledger(self) -> str:
        """The loads of raw, written down when they come in, see `loads`."""
        return f"{self.raw}_loads"

    @property
    def merged(self) -> str:
        """The loads that clean holds."""
        return f"{self.table('clean')}__loads"

    @property
    def quality_schema(self) -> str:
        """Where dq_audit and dq_errors live."""
        return self.names.get("quality", self.schema)


def create(spark: SparkSession, layers: Layers) -> None:
    """Schemas and raw tables, where absent."""
    for name in (layers.raw, layers.clean.name, layers.agg.name):
        ensure_schema(spark, name.rpartition(".")[0])
    ensure_table(spark, layers.raw, layers.contract.raw_schema, [BATCH])
    ensure_table(spark, layers.quarantine, _quarantine_schema(), [BATCH])
    ensure_table(spark, layers.drift, _drift_schema(), [BATCH])
    ensure_table(spark, layers.ledger, LEDGER)


def _quarantine_schema():
    return Contract.of_strings([CORRUPT], keys=()).raw_schema


def _drift_schema():
    return Contract.of_strings(["unexpected_column", "filled_rows"], keys=()).raw_schema


def ingest(
    spark: SparkSession,
    layers: Layers,
    landing: str,
    as_of: datetime,
    page_per_line: bool = True,
    replace_day: bool = False,
) -> None:
    """Append landed pages to raw; what isn't a record goes to the quarantine table.

    The broken pages are counted while the good records are written, so the
    landing folder is read again only when there are some. Their good records
    are appended as well, see split_records. Fields outside the
    contract are counted per load in the drift table. A load that raw
    already has is refused; replace_day puts this one in place of all loads of
    its day, and clean is rebuilt by the next refresh.
    """
    create(spark, layers)
    _admit(spark, layers, as_of, replace_day)
    pages = load_pages(spark, landing, layers.contract, page_per_line)
    seen = Observation()
    watched = pages.observe(seen, F.count(CORRUPT).alias("broken"))
    load = _land(layers, add_lineage(good_records(watched), layers.source, as_of), as_of, replace_day)
    if seen.get["broken"]:
        torn = split_records(broken_pages(pages).withColumnRenamed(CORRUPT, "value"), layers.contract)
        _land(layers, add_lineage(good_records(torn), layers.source, as_of), as_of, more_of=load)
        append(add_lineage(broken_pages(torn), layers.source, as_of), layers.quarantine, replace_day)
    extra = unexpected_fields(spark, landing, layers.contract, page_per_line)
    found = extra.withColumn("filled_rows", F.col("filled_rows").cast("string"))
    append(add_lineage(found.coalesce(1), layers.source, as_of), layers.drift, replace_day)


def ingest_frame(
    layers: Layers, df: DataFrame, as_of: datetime, replace_day: bool = False
) -> None:
    """Append the rows of any frame to raw, projected to the contract, by the rules of `ingest`."""
    create(df.sparkSession, layers)
    _admit(df.sparkSession, layers, as_of, replace_day)
    _land(layers, add_lineage(layers.contract.project(df), layers.source, as_of), as_of, replace_day)


def _land(
    layers: Layers, rows: DataFrame, as_of: datetime, replace_day: bool = False, more_of: str | None = None
) -> str:
    """Append the rows of one load. The ledger has it before raw does, and its row count after; gives its name."""
    spark, moment, load = rows.sparkSession, utc(as_of), f"{more_of}+" if more_of else uuid.uuid4().hex
    day = moment.strftime("%Y-%m-%d")
    if replace_day:
        known = spark.table(layers.ledger)
        if not known.filter(F.col(BATCH) == day).isEmpty():
            full_refresh(known.filter(~F.col(BATCH).eqNullSafe(day)), layers.ledger)
    _note(spark, layers, [(load, "begun", layers.source, day, moment, None)])
    seen = Observation()
    append(rows.observe(seen, F.count(F.lit(1)).alias("rows")), layers.raw, replace_day)
    _note(spark, layers, [(load, "done", layers.source, day, moment, seen.get["rows"])])
    return load


def ingest_batch(
    layers: Layers, pages: DataFrame, files: list[str], as_of: datetime, load: str, merge: bool = False
) -> None:
    """Append a micro-batch of loaded pages, which came from `files`, as the load of that name.

    A load that raw has whole is not appended again, and one that broke off goes
    on under the moment it began with. Broken pages are split as in `ingest`.
    With `merge` clean and agg take its rows as they are at hand, see merge_load.
    """
    spark = pages.sparkSession
    create(spark, layers)
    entries = spark.table(layers.ledger).filter(F.col("load") == load).select("step", F.unix_micros("newest").alias("at"))
    known = {r["step"]: r["at"] for r in entries.collect()}
    if "done" in known and not merge:
        return
    moment = datetime.fromtimestamp(known["begun"] / 1e6, timezone.utc) if known else utc(as_of)
    day = moment.strftime("%Y-%m-%d")
    if not known:
        _note(spark, layers, [(load, "begun", layers.source, day, moment, None)])

    def missing(table: str) -> bool:
        """Whether a table has nothing of this load yet."""
        of_load = (F.col(BATCH) == day) & (F.col(MOMENT) == F.lit(moment)) & (F.col("_source") == layers.source)
        return not known or spark.table(table).filter(of_load).isEmpty()

    def traced(df: DataFrame) -> DataFrame:
        return add_lineage(df, layers.source, moment)

    torn = split_records(broken_pages(pages).withColumnRenamed(CORRUPT, "value"), layers.contract).persist()
    good, seen = good_records(pages).unionByName(good_records(torn)), Observation()
    try:
        if "done" not in known:
            if missing(layers.raw):
                append(traced(good.observe(seen, F.count(F.lit(1)).alias("rows"))), layers.raw)
                count = seen.get["rows"]
            else:
                count = good.count()
            if missing(layers.quarantine):
                append(gather(traced(broken_pages(torn)), BATCH), layers.quarantine)
            if missing(layers.drift):
                extra = unexpected_fields(spark, files, layers.contract)
                append(traced(extra.withColumn("filled_rows", F.col("filled_rows").cast("string")).coalesce(1)), layers.drift)
            _note(spark, layers, [(load, "done", layers.source, day, moment, count)])
        if merge:
            merge_load(spark, layers, traced(good), load)
    finally:
        torn.unpersist()


def append_load(layers: Layers, rows: DataFrame) -> None:
    """Append rows that carry their lineage columns, of any number of batches, as one load.

    Their batches and counts are found first, by a pass over two narrow columns.
    """
    spark, load = rows.sparkSession, uuid.uuid4().hex
    create(spark, layers)
    stats = rows.groupBy(BATCH).agg(F.max(MOMENT).alias("newest"), F.count(F.lit(1)).alias("n"))
    entries = [(load, "begun", layers.source, r[BATCH], r["newest"], r["n"]) for r in stats.collect()]
    _note(spark, layers, entries)
    append(gather(rows, BATCH) if len(entries) > 1 else rows, layers.raw)


def _note(spark: SparkSession, layers: Layers, entries: list[tuple]) -> None:
    if entries:
        append(local_rows(spark, [_with_zone(e) for e in entries], LEDGER), layers.ledger)


def _with_zone(entry: tuple) -> tuple:
    """Moments with a time zone; those that came from a frame have the driver's."""
    return tuple(v.astimezone(timezone.utc) if isinstance(v, datetime) else v for v in entry)


def loads(spark: SparkSession, layers: Layers) -> DataFrame:
    """One row per load and batch: load, batch, newest moment, row_count (null where the load broke off)."""
    return _entries(spark, layers).groupBy("load", BATCH).agg(F.max("newest").alias("newest"), F.max("row_count").alias("row_count"))


def _entries(spark: SparkSession, layers: Layers) -> DataFrame:
    """The ledger as it is now, without what has expired."""
    ensure_table(spark, layers.ledger, LEDGER)
    spark.catalog.refreshTable(layers.ledger)
    return spark.table(layers.ledger).filter("step != 'expired'")


def _admit(spark: SparkSession, layers: Layers, as_of: datetime, replace_day: bool) -> None:
    """Refuse a load that raw has, or note that its day is being replaced."""
    moment = utc(as_of)
    day = moment.strftime("%Y-%m-%d")
    of_day = spark.table(layers.raw).filter(F.col(BATCH) == day)
    if replace_day:
        if layers.clean.exists(spark) and not of_day.isEmpty():
            days = {*_replaced(spark, layers), day}
            set_property(spark, layers.clean.name, REPLACED, ",".join(sorted(days)))
        return
    same = (F.col(MOMENT) == F.lit(moment)) & (F.col("_source") == layers.source)
    if not of_day.filter(same).isEmpty():
        raise ValueError(f"{layers.raw} already has a load of {layers.source} as of {moment}: use replace_day")


def _replaced(spark: SparkSession, layers: Layers) -> list[str]:
    return [d for d in (get_property(spark, layers.clean.name, REPLACED) or "").split(",") if d]


def curate(df: DataFrame, layers: Layers) -> DataFrame:
    """Newest standardised row per key; ties are settled the way merge_rows settles them."""
    contract = layers.contract
    rows = standardize(df.select(*contract.raw_schema.names), layers.text_forms)
    if layers.drop_null_keys:
        rows = rows.dropna(subset=list(contract.keys))
    return latest_per_key(rows, contract.keys, contract.order, layers.settle)


def rebuild_clean(spark: SparkSession, layers: Layers) -> None:
    """Clean from the whole of raw, its parts folded in.

    Where retention has cut raw, the rows that clean has stay in the running,
    save those of days replaced since; they are written down before clean is
    overwritten, so a crash loses none, and the next run goes on from them and
    from all that raw has by then. If there is no whole clean to take them
    from, this raises; with full_snapshots raw alone is enough. A key whose
    older loads have expired and whose newest one is replaced without it is gone.
    """
    clean, kept = layers.clean, f"{layers.clean.name}__rebuilt"
    held = pending_and_merged(spark, layers)  # before raw is read: what comes in meanwhile is merged later
    rows = spark.table(layers.raw)
    if get_property(spark, layers.raw, CUT) == "true" and not layers.full_snapshots:
        replaced = F.coalesce(F.col(BATCH).isin(_replaced(spark, layers)), F.lit(False))
        begun = _exists(spark, kept)
        if not begun and not (clean.exists(spark) and clean.is_whole(spark)):
            raise RuntimeError(f"{clean.name} is not whole and {layers.raw} no longer has all loads")
        had = spark.table(kept) if begun else clean.read(spark)
        curated = curate(rows.unionByName(had.select(*rows.columns).filter(~replaced)), layers)
        if not begun:
            full_refresh(curated, kept)
            curated = spark.table(kept)
    else:
        curated = curate(rows, layers)
    if layers.agg.exists(spark):
        layers.agg.mark_whole(spark, False)
    clean.rebuild(curated)
    set_property(spark, clean.name, REPLACED, "")
    full_refresh(local_rows(spark, held, MERGED), layers.merged)
    spark.sql(f"DROP TABLE IF EXISTS {kept}")
    spark.sql(f"DROP TABLE IF EXISTS {clean.name}__merged")


def start_clean(spark: SparkSession, layers: Layers) -> None:
    """An empty clean table that holds no load yet."""
    layers.clean.rebuild(curate(spark.table(layers.raw).limit(0), layers))
    full_refresh(local_rows(spark, [], MERGED), layers.merged)


def _exists(spark: SparkSession, name: str) -> bool:
    finish_refresh(spark, name)
    return spark.catalog.tableExists(name)


def pending_and_merged(spark: SparkSession, layers: Layers) -> list[tuple]:
    """(load, batch) of all that raw holds now, one entry per load and batch."""
    listed = [r[BATCH] for r in batches(spark, layers.raw, BATCH, undated=True).collect()]
    noted = _entries(spark, layers).select("load", BATCH).collect()  # a few rows per load
    held = set(listed)
    entries = list(dict.fromkeys((r["load"], r[BATCH]) for r in noted if r[BATCH] in held))
    known = {batch for _, batch in entries}
    return entries + [(UNLISTED, batch) for batch in listed if batch not in known]


def unmerged(spark: SparkSession, layers: Layers, taken: str | None = None) -> list[tuple]:
    """(load, batch) of the loads that clean, or another table of taken ones, doesn't hold.

    Raw isn't read: its ledger and its folders are.

    A batch that was appended past the ledger counts as one load when it is new.
    """
    held = pending_and_merged(spark, layers)
    taken = taken or layers.merged
    if not _exists(spark, taken):
        return held
    spark.catalog.refreshTable(taken)
    known = {(r["load"], r[BATCH]) for r in spark.table(taken).collect()}
    return [entry for entry in held if entry not in known]


def rebuild_agg(spark: SparkSession, layers: Layers) -> None:
    require_table(spark, layers.clean.name, "run rebuild_clean first")
    layers.agg.rebuild(group_count(layers.clean.read(spark), layers.groups, layers.measure))


def merge_rows(
    spark: SparkSession, layers: Layers, rows: DataFrame, delete_missing: bool = False
) -> None:
    """Upsert raw rows into clean and carry the change over to agg.

    Rows newer than what clean has for their key are written as a part beside
    its base, which is neither shuffled nor rewritten: of it the keys, order and
    group columns are read to find them. The count change of each group is
    written down before. agg stays marked as broken from the part's write to its
    own, see repair. delete_missing drops keys absent from rows, which must then
    be a full snapshot; that rewrites clean.
    """
    if delete_missing:
        return _replace_rows(spark, layers, rows)
    clean, agg = layers.clean, layers.agg
    staged = [f"{clean.name}__batch", f"{agg.name}__delta"]
    seen = Observation()
    won = _newer(layers, clean.with_buckets(spark), curate(rows, layers))
    watched = won.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if("_tie").alias("ties"))
    watched.write.mode("overwrite").saveAsTable(staged[0])
    if seen.get["rows"]:
        batch = spark.table(staged[0])
        newer = batch.filter("not _tie")
        delta = tracked_delta(newer.withColumn("_sighted", F.lit(True)), layers.groups, layers.measure)
        delta, moved = _stage(delta, staged[1], agg)
        part = newer.drop("_before", "_tie")
        if seen.get["ties"]:
            tied = batch.filter("_tie").drop("_before", "_tie")
            part = part.unionByName(_settled(layers, clean.with_buckets(spark), tied))
        agg.mark_whole(spark, False)
        clean.add_part(part)
        _apply(spark, layers, delta, moved)
        agg.mark_whole(spark, True)
    for name in staged:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    if len(clean.part_numbers(spark)) >= layers.fold_after:
        fold_clean(spark, layers)


def _newer(layers: Layers, old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of `new` that aren't older than the old row of their key, by order and groups.

    Adds `_before`, the old row's groups (null for a new key), and `_tie`. Both
    sides hold a key once.
    """
    keys, order, groups = layers.contract.keys, layers.contract.order, layers.groups

    def mark(side: str):
        return F.struct(*[F.col(f"{side}.{c}") for c in [*order, *groups]])

    slim = old.select(*dict.fromkeys([*keys, *order, *groups]), F.lit(True).alias("_had"))
    met = new.alias("s").join(slim.alias("t"), same_key(keys), "left")
    had = F.col("t._had").isNotNull()
    tie = F.coalesce(had & (mark("s") == mark("t")), F.lit(False))
    before = F.when(had, F.struct(*[F.col(f"t.{g}").alias(g) for g in groups]))
    return met.filter(~had | (mark("s") >= mark("t"))).select("s.*", before.alias("_before"), tie.alias("_tie"))


def _settled(layers: Layers, old: DataFrame, tied: DataFrame) -> DataFrame:
    """Those of the tied rows that beat the old row of their key by the other columns. Both sides hold a key once."""
    keys = layers.contract.keys

    def mark(side: str):
        return F.struct(*[F.col(f"{side}.{c}") for c in [*layers.contract.order, *layers.settle]])

    met = tied.alias("s").join(old.alias("t"), same_key(keys))
    return met.filter(mark("s") > mark("t")).select("s.*")


def fold_clean(spark: SparkSession, layers: Layers) -> None:
    """Bring the parts of clean into its base, rewriting the buckets they fall in."""
    cut = get_property(spark, layers.raw, CUT) == "true"
    layers.clean.fold(spark, f"{layers.clean.name}__merged" if cut else None)


def _replace_rows(spark: SparkSession, layers: Layers, rows: DataFrame) -> None:
    """Clean as a full snapshot leaves it: every bucket is rewritten, keys that it lacks go."""
    clean, agg, contract = layers.clean, layers.agg, layers.contract
    staged = [f"{clean.name}__batch", f"{agg.name}__delta", f"{clean.name}__merged"]
    batch, _ = _stage(curate(rows, layers), staged[0], clean)
    old = clean.with_buckets(spark)
    keys = [BUCKET, *contract.keys]

    def meet(columns: list[str], cluster_by: str | None = None) -> DataFrame:
        settle = [c for c in layers.settle if c in columns]
        sides = old.select(*columns), batch.select(*columns)
        return upsert_tracking(*sides, keys, contract.order, layers.groups, settle, cluster_by)

    slim = meet(list(dict.fromkeys([*keys, *contract.order, *layers.groups])))
    delta, moved = _stage(tracked_delta(slim, layers.groups, layers.measure, True), staged[1], agg)
    kept = meet(old.columns, BUCKET).filter("_sighted").select(*old.columns)
    if get_property(spark, layers.raw, CUT) == "true":
        full_refresh(kept, staged[2])
        kept = spark.table(staged[2])
    agg.mark_whole(spark, False)
    clean.write_buckets(kept, range(clean.buckets))
    _apply(spark, layers, delta, moved)
    agg.mark_whole(spark, True)
    for name in staged:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _stage(df: DataFrame, name: str, like: KeyedTable) -> tuple[DataFrame, list[int]]:
    """Write an intermediate result once and go on from there.

    Also gives the buckets it falls in, at most one integer per bucket.
    """
    seen = Observation()
    placed = like.with_bucket(df).observe(seen, F.collect_set(BUCKET).alias("buckets"))
    placed.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name), sorted(seen.get["buckets"])


def _apply(spark: SparkSession, layers: Layers, delta: DataFrame, touched: list[int]) -> None:
    if touched:
        keys = [BUCKET, *layers.groups]
        totals = apply_delta(layers.agg.slice(spark, touched), delta, keys, layers.measure)
        layers.agg.write_buckets(totals.repartition(BUCKET), touched)


def refresh(
    spark: SparkSession,
    layers: Layers,
    since: str = "load",
    delete_missing: bool = False,
) -> None:
    """Bring clean and agg up to date with raw, reading only what is not yet merged.

    since="load" takes the batches that are new, late or have grown since they
    were merged, "day" the newest merged batch and later ones, "next_day" only
    later ones. With delete_missing the newest batch is taken as a full
    snapshot.
    """
    if repair(spark, layers):
        return
    log_rows = spark.table(layers.raw)
    pending = unmerged(spark, layers)
    if delete_missing:
        newest = read_watermark(batches(spark, layers.raw, BATCH), BATCH)
        fresh = log_rows.filter(F.col(BATCH) == newest)
    elif since == "load":
        if not pending:
            return
        days = {batch for _, batch in pending}
        undated = F.lit(None in days) & F.col(BATCH).isNull()
        fresh = log_rows.filter(F.col(BATCH).isin([d for d in days if d is not None]) | undated)
    elif since in ("day", "next_day"):
        fresh = new_rows(log_rows, BATCH, read_watermark(spark.table(layers.merged), BATCH), strict_day=since == "next_day")
    else:
        raise ValueError(f"since must be load, day or next_day, not {since!r}")
    merge_rows(spark, layers, fresh, delete_missing)
    if (since == "load" or delete_missing) and pending:
        append(local_rows(spark, pending, MERGED), layers.merged)


def merge_load(spark: SparkSession, layers: Layers, rows: DataFrame, load: str) -> None:
    """Merge a load of raw from its rows at hand, unless clean holds it.

    Raw, whose batch may have many loads, isn't read for it. What else is not
    merged is left to `refresh`.
    """
    if repair(spark, layers):
        return
    pending = [entry for entry in unmerged(spark, layers) if entry[0] == load]
    if pending:
        merge_rows(spark, layers, rows)
        append(local_rows(spark, pending, MERGED), layers.merged)


def repair(spark: SparkSession, layers: Layers) -> bool:
    """Build what is absent, was left broken by a crash, or lost a replaced day; True if clean is new from raw."""
    clean, merged = layers.clean, f"{layers.clean.name}__merged"
    if clean.exists(spark) and not clean.is_whole(spark) and _exists(spark, merged):
        rows = spark.table(merged)
        clean.write_buckets(rows, [r[BUCKET] for r in rows.select(BUCKET).distinct().collect()])
        spark.sql(f"DROP TABLE {merged}")
    renew = (
        not clean.exists(spark)
        or not clean.is_whole(spark)
        or bool(_replaced(spark, layers))
        or not _exists(spark, layers.merged)
    )
    if renew:
        rebuild_clean(spark, layers)
    if renew or not layers.agg.exists(spark) or not layers.agg.is_whole(spark):
        rebuild_agg(spark, layers)
    return renew


def run_daily(
    spark: SparkSession, layers: Layers, landing: str, as_of: datetime, replace_day: bool = False, **options
) -> None:
    """Ingest, then merge the new rows into clean and agg. Run a day again with replace_day."""
    ingest(spark, layers, landing, as_of, replace_day=replace_day)
    refresh(spark, layers, **options)


def run_weekly(
    spark: SparkSession,
    layers: Layers,
    landing: str,
    as_of: datetime,
    must_pass: bool = False,
    replace_day: bool = False,
) -> bool:
    """Ingest, rebuild clean and agg, check quality, expire old raw batches."""
    ingest(spark, layers, landing, as_of, replace_day=replace_day)
    rebuild_clean(spark, layers)
    rebuild_agg(spark, layers)
    passed = run_quality(spark, layers, as_of, must_pass)
    expire_raw(spark, layers, as_of)
    return passed


def _with_drift(spark: SparkSession, layers: Layers) -> DataFrame:
    """Raw, with an empty column for every field that its loads had outside the contract.

    So checks of the columns see what was landed, not only what was kept.
    """
    rows = spark.table(layers.raw)
    held = batches(spark, layers.raw, BATCH)
    seen = spark.table(layers.drift).join(held, BATCH, "left_semi").select("unexpected_column").distinct()
    extra = [r[0] for r in seen.collect() if r[0] not in rows.columns]
    return rows.withColumns({name: F.lit(None).cast("string") for name in sorted(extra)})


def run_quality(
    spark: SparkSession, layers: Layers, as_of: datetime, must_pass: bool = False
) -> bool:
    """Check all layers, log status and error records, and return the verdict.

    Failing rows are looked up only for checks that failed. Repeated keys are
    found once, for both the status and the samples.
    """
    audit, errors = ensure_log_tables(spark, layers.quality_schema)
    at = utc(as_of)
    order = (*layers.contract.keys, BATCH)
    checked = {
        "raw": (_with_drift(spark, layers), layers.raw_rules(), order),
        "clean": (layers.clean.read(spark), layers.clean_rules(), order),
        "agg": (layers.agg.read(spark), layers.agg_rules(), layers.groups),
    }
    repeated = {
        name: {rule: keys.persist() for rule, keys in repeated_keys(df, rules).items()}
        for name, (df, rules, _) in checked.items()
    }
    status = _union(
        [check_status(df, rules, name, repeated=repeated[name]) for name, (df, rules, _) in checked.items()]
    ).persist()
    try:
        log(audit_rows(status, at, layers.sample_rows), audit)
        failed = {(r["layer"], r["check_name"]) for r in status.filter("not status").collect()}
        passed = verdict(status).first()["passed"]
        samples = []
        for name, (df, rules, by) in checked.items():
            broken = [r for r in rules if (name, r.name) in failed]
            if broken:
                samples.append(error_records(df, broken, name, by, limit=layers.sample_rows, repeated=repeated[name]))
        if samples:
            log(error_rows(_union(samples), at), errors)
    finally:
        for frame in [status, *(keys for found in repeated.values() for keys in found.values())]:
            frame.unpersist()
    if must_pass and not passed:
        raise RuntimeError(f"quality checks failed: {sorted(failed)}")
    return passed


def run_raw_checks(spark: SparkSession, layers: Layers) -> DataFrame:
    """Status of the raw checks, counted in the loads that came since the last run and kept for the others."""
    states, checked = f"{layers.raw}_states", f"{layers.raw}_states__loads"
    pending = unmerged(spark, layers, checked)
    days = {batch for _, batch in pending}
    refresh_states(spark, states, layers.raw, _with_drift(spark, layers), layers.raw_rules(), "raw", BATCH, days)
    if pending:
        ensure_table(spark, checked, MERGED)
        append(local_rows(spark, pending, MERGED), checked)
    spark.catalog.refreshTable(states)
    return merged_status(spark.table(states), layers.raw_rules(), "raw", BATCH)


def expire_raw(spark: SparkSession, layers: Layers, as_of: datetime) -> dict[str, int]:
    """Drop raw batches past the retention age; gives the rows that each of them had.

    The ledger knows the counts; only a batch that it doesn't know is counted.
    """
    late = expired(BATCH, utc(as_of).date(), layers.retention_days)
    doomed = sorted(r[BATCH] for r in batches(spark, layers.raw, BATCH).filter(late).collect())
    if not doomed:
        return {}
    ensure_table(spark, layers.ledger, LEDGER)
    noted: dict[str, dict] = {}
    for r in spark.table(layers.ledger).filter(F.col(BATCH).isin(doomed)).collect():  # a few rows per load
        steps = noted.setdefault(r[BATCH], {})
        if steps.get(r["load"]) is None:
            steps[r["load"]] = r["row_count"]
    noted = {batch: list(steps.values()) for batch, steps in noted.items()}
    counts = {batch: sum(ns) for batch, ns in noted.items() if None not in ns}
    unknown = [batch for batch in doomed if batch not in counts]
    if unknown:
        found = row_counts(spark.table(layers.raw).filter(F.col(BATCH).isin(unknown)), BATCH)
        counts |= {r[BATCH]: r["row_count"] for r in found.collect()}
    set_property(spark, layers.raw, CUT, "true")
    drop_listed(spark, layers.raw, BATCH, doomed)
    gone = {name: counts.get(name, 0) for name in doomed}
    _note(spark, layers, [(uuid.uuid4().hex, "expired", layers.source, b, None, -n) for b, n in gone.items() if b not in unknown])
    return gone


def _union(frames: list[DataFrame]) -> DataFrame:
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    return union
