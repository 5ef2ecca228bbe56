"""Evaluate rules: status of every check in one pass, and samples of failing rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerkit.operators.dedupe import duplicate_keys, orderable
from layerkit.operators.sample import first_per_group
from layerkit.quality.rules import (
    Fresh,
    HasColumns,
    MinRows,
    NoExtraColumns,
    Rule,
    RowRule,
    Unique,
)


def repeated_keys(df: DataFrame, rules: Iterable[Rule]) -> dict[str, DataFrame]:
    """What breaks each Unique rule. Cache it to share one count per key between status and samples."""
    return {r.name: duplicate_keys(df, r.keys) for r in rules if isinstance(r, Unique)}


def check_status(
    df: DataFrame,
    rules: Iterable[Rule],
    layer: str,
    by: str | None = None,
    repeated: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """One row per check: layer, check_name, status, failed_rows, total_rows.

    All row and table rules share one scan and one aggregate. Each Unique rule
    adds a count per key; its failed_rows are the repeated keys. With `by` each
    batch is judged on its own and the batch column leads the result.
    """
    rules = list(rules)
    batch = [by] if by else []
    parts = []
    shared = [r for r in rules if not isinstance(r, Unique)]
    if shared:
        measures = [_failed_rows(df, r).alias(f"_{i}") for i, r in enumerate(shared)]
        counted = df.groupBy(*batch).agg(F.count(F.lit(1)).alias("total_rows"), *measures)
        checks = F.array(
            *[_check(r.name, F.col(f"_{i}"), _absent(df, r)) for i, r in enumerate(shared)]
        )
        parts.append(counted.select(*batch, F.explode(checks).alias("c"), "total_rows"))
    for rule in rules:
        if isinstance(rule, Unique) and repeated is not None and not by:
            total = df.agg(F.count(F.lit(1))).scalar().alias("total_rows")
            counted = repeated[rule.name].agg(F.count(F.lit(1)).alias("_failed"))
            parts.append(counted.select(_check(rule.name, F.col("_failed"), False).alias("c"), total))
        elif isinstance(rule, Unique):
            keys = list(dict.fromkeys([*batch, *rule.keys]))
            sizes = df.groupBy(*keys).count()
            counted = sizes.groupBy(*batch).agg(
                F.count_if(F.col("count") > 1).alias("_failed"),
                F.coalesce(F.sum("count"), F.lit(0)).alias("total_rows"),
            )
            check = _check(rule.name, F.col("_failed"), False)
            parts.append(counted.select(*batch, check.alias("c"), "total_rows"))
    status = reduce(DataFrame.unionByName, parts)
    return status.select(*batch, F.lit(layer).alias("layer"), "c.*", "total_rows")


def _check(name: str, failed: Column, absent: bool) -> Column:
    ok = F.lit(False) if absent else failed == 0
    return F.struct(
        F.lit(name).alias("check_name"), ok.alias("status"), failed.cast("bigint").alias("failed_rows")
    )


def _absent(df: DataFrame, rule: Rule) -> bool:
    return isinstance(rule, RowRule) and not set(rule.needs) <= set(df.columns)


def _failed_rows(df: DataFrame, rule: Rule) -> Column:
    """Aggregate that is zero when the rule holds."""
    if isinstance(rule, RowRule):
        return F.count(F.lit(1)) if _absent(df, rule) else F.count_if(rule.fails())
    if isinstance(rule, MinRows):
        return F.when(F.count(F.lit(1)) < rule.rows, 1).otherwise(0)
    if isinstance(rule, Fresh):
        newest = F.max(F.try_to_date(F.col(rule.column).cast("string"), "yyyy-MM-dd"))
        bound = F.date_sub(F.lit(rule.as_of), rule.max_age)
        return F.when(newest >= bound, 0).otherwise(1)
    if isinstance(rule, (NoExtraColumns, HasColumns)):
        offending = F.lit(len(rule.offending(df.columns)))
        return F.coalesce(F.max(offending), offending)
    raise TypeError(f"unknown rule {rule!r}")


def error_records(
    df: DataFrame,
    rules: Iterable[Rule],
    layer: str,
    order: Iterable[str],
    by: str | None = None,
    limit: int = 50,
    keep_nulls: bool = True,
    repeated: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """The first failing rows of each check as JSON: layer, check_name, error_record.

    One scan serves all row rules; rows are cut per task before they are
    shuffled and turned into JSON last. A Unique rule shows the repeated keys
    with their counts, a column rule the offending column names.
    """
    rules, order = list(rules), list(order)
    batch = [by] if by else []
    options = {"ignoreNullFields": str(not keep_nulls).lower()}
    parts = []
    row_rules = [r for r in rules if isinstance(r, RowRule) and not _absent(df, r)]
    if row_rules:
        failing = F.array_compact(F.array(*[F.when(r.fails(), F.lit(r.name)) for r in row_rules]))
        names = df.columns
        # the plain filter reaches the scan, which can then skip row groups without failures
        hits = df.filter(reduce(or_, [r.fails() for r in row_rules])).withColumn("_check", F.explode(failing))
        ties = [c for c in orderable(df, names) if c not in order]
        cut = first_per_group(hits, [*batch, "_check"], [*order, *ties], limit)
        record = F.to_json(F.struct(*names), options)
        for rule in row_rules:
            if rule.evidence():
                shown = [value.alias(name) for name, value in rule.evidence().items()]
                wide = F.to_json(F.struct(*names, *shown), options)
                record = F.when(F.col("_check") == rule.name, wide).otherwise(record)
        parts.append(cut.select(*batch, F.col("_check").alias("check_name"), record.alias("error_record")))
    for rule in rules:
        if isinstance(rule, Unique):
            keys = list(dict.fromkeys([*batch, *rule.keys]))
            if by:
                cut = first_per_group(duplicate_keys(df, keys), batch, keys, limit)
            else:
                known = repeated[rule.name] if repeated is not None else duplicate_keys(df, keys)
                cut = known.orderBy(*keys).limit(limit)
            record = F.to_json(F.struct(*rule.keys, "count"), options)
            parts.append(cut.select(*batch, F.lit(rule.name).alias("check_name"), record.alias("error_record")))
        if isinstance(rule, (NoExtraColumns, HasColumns)) and not by:
            record = F.to_json(F.struct(rule.reported_as)).alias("error_record")
            parts.append(_column_names(df, rule).select(F.lit(rule.name).alias("check_name"), record))
    if not parts:
        empty = df.limit(0).select(*batch, F.lit("").alias("check_name"), F.lit("").alias("error_record"))
        parts.append(empty)
    errors = reduce(DataFrame.unionByName, parts)
    return errors.select(*batch, F.lit(layer).alias("layer"), "check_name", "error_record")


def failing_rows(df: DataFrame, rule: Rule) -> DataFrame:
    """All that breaks one rule: whole rows with their evidence, repeated keys, or column names."""
    if isinstance(rule, RowRule):
        return df.filter(rule.fails()).withColumns(rule.evidence())
    if isinstance(rule, Unique):
        return duplicate_keys(df, rule.keys)
    if isinstance(rule, (NoExtraColumns, HasColumns)):
        return _column_names(df, rule)
    return df.limit(0)


def _column_names(df: DataFrame, rule: NoExtraColumns | HasColumns) -> DataFrame:
    names = F.array(*[F.lit(c) for c in rule.offending(df.columns)]).cast("array<string>")
    return df.sparkSession.range(1).select(F.explode(names).alias(rule.reported_as))


def check_layer(
    df: DataFrame, rules: Iterable[Rule], layer: str = ""
) -> tuple[bool, dict[str, bool], dict[str, DataFrame]]:
    """Verdict, status of each check, and a lazy frame of what breaks it.

    The status pass runs once and brings one row per rule to the driver.
    """
    rules = list(rules)
    checks = {r["check_name"]: r["status"] for r in check_status(df, rules, layer).collect()}
    return all(checks.values()), checks, {rule.name: failing_rows(df, rule) for rule in rules}


def verdicts(status: DataFrame) -> DataFrame:
    """The verdict of each layer, and of all of them together."""
    rolled = status.rollup("layer").agg(F.bool_and("status").alias("passed"))
    return rolled.select(F.coalesce("layer", F.lit("all")).alias("layer"), "passed")


def verdict(status: DataFrame) -> DataFrame:
    """One row: did every check pass."""
    return status.agg(F.bool_and("status").alias("passed"))
