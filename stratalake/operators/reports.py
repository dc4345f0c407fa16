"""What cleaning discards, and what the raw data looks like."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.rules import acceptable, broken_rules, is_null, is_zero
from stratalake.functions.typed import nulled_by_cast, typed_columns
from stratalake.operators.keys import COPIES, tally, total
from stratalake.spec import SOURCE_FILE, DatasetSpec

RULES = ("negative_amount", "bad_interval", "out_of_range")
REASONS = (*RULES, "null_predicate", "duplicate_key", "kept")
# A row's outcome as bits: one per broken rule, one for "accepted".
_BIT = {name: 1 << at for at, name in enumerate((*RULES, "accepted"))}


def rows_by_file(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy(SOURCE_FILE).count().orderBy(SOURCE_FILE)


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with two digits; NULL when there is nothing to share."""
    return F.round(100.0 * part / F.nullif(whole, F.lit(0)), 2)


def diagnostic_counts(bronze: DataFrame, spec: DatasetSpec) -> list[Column]:
    """Aggregates over bronze: rows, rows per broken rule (these overlap), rows accepted."""
    at = typed_columns(bronze, spec)
    return [
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(rule.holds(at)).alias(rule.name) for rule in broken_rules(spec)],
        F.count_if(acceptable(spec, at)).alias("accepted"),
        nulled_by_cast(bronze, spec).alias("nulled_by_cast"),
    ]


def diagnostics(bronze: DataFrame, spec: DatasetSpec) -> DataFrame:
    """One row, one pass, no shuffle of data rows."""
    return bronze.agg(*diagnostic_counts(bronze, spec))


def outcomes(bronze: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Rows counted by outcome, and accepted rows also by business key.

    Rejected rows get a NULL key, which folds them into a handful of groups per
    task before the shuffle; only distinct accepted keys move. The outcome comes
    last in the grouping, as groups are sorted by its first column on a spill.
    """
    at = typed_columns(bronze, spec)
    accepted = F.coalesce(acceptable(spec, at), F.lit(False))
    conditions = {rule.name: rule.holds(at) for rule in broken_rules(spec)}
    conditions["accepted"] = accepted
    bits = [F.when(cond, _BIT[name]).otherwise(0) for name, cond in conditions.items()]
    return (
        bronze.select(
            reduce(lambda left, right: left.bitwiseOR(right), bits).alias("outcome"),
            *[F.when(accepted, at[name]).alias(name) for name in spec.key],
        )
        .groupBy(*spec.key, "outcome")
        .agg(F.count(F.lit(1)).alias(COPIES))
    )


def _has(name: str) -> Column:
    return F.col("outcome").bitwiseAND(_BIT[name]) != 0


def _rows_where(cond: Column) -> Column:
    return total(F.when(cond, F.col(COPIES)))


def discard_report(bronze: DataFrame, spec: DatasetSpec) -> DataFrame:
    """One row: rows per broken rule, duplicates, rows kept and their share."""
    kept = F.count_if(_has("accepted"))
    counts = outcomes(bronze, spec).agg(
        total(F.col(COPIES)).alias("total"),
        *[_rows_where(_has(name)).alias(name) for name in RULES],
        (_rows_where(_has("accepted")) - kept).alias("duplicates"),
        kept.alias("kept"),
    )
    return counts.withColumn("kept_pct", percent(F.col("kept"), F.col("total")))


def reject_reasons(bronze: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Rows by the first reason that stopped them. The rows add up to bronze."""
    kept = F.count_if(_has("accepted"))
    sums: dict[str, Column] = {}
    undecided = F.lit(True)
    for name in RULES:
        sums[name] = _rows_where(undecided & _has(name))
        undecided = undecided & ~_has(name)
    sums["null_predicate"] = _rows_where(F.col("outcome") == 0)
    sums["duplicate_key"] = _rows_where(_has("accepted")) - kept
    sums["kept"] = kept
    counts = outcomes(bronze, spec).agg(*[sums[name].alias(name) for name in REASONS])
    return as_rows(counts, REASONS, "reason", "rows")


def as_rows(counts: DataFrame, names: Sequence[str], label: str, value: str) -> DataFrame:
    """Turns the columns of a one-row frame into rows."""
    pairs = [F.struct(F.lit(name).alias(label), F.col(name).alias(value)) for name in names]
    return counts.select(F.inline(F.array(*pairs)))


def profile(bronze: DataFrame, spec: DatasetSpec) -> DataFrame:
    """One row of findings about raw data, each count with its share of all rows."""
    negative, bad_interval, out_of_range = broken_rules(spec)
    findings = (
        negative,
        is_zero(spec.amount, "zero_amount"),
        is_null(spec.counted, "null_count"),
        is_zero(spec.counted, "zero_count"),
        bad_interval,
        out_of_range,
    )
    facts = tally(bronze, typed_columns(bronze, spec), spec.key, findings, span=spec.starts)
    counted = [*[rule.name for rule in findings], "duplicate_keys"]
    return facts.select(
        F.col("rows").alias("total"),
        *counted,
        *[percent(F.col(name), F.col("rows")).alias(f"{name}_pct") for name in counted],
        "first_start",
        "last_start",
    )
