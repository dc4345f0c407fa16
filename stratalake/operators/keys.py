"""Business-key uniqueness, alone and together with row rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.rules import Columns, Rule

COPIES = "copies"


def total(count: Column) -> Column:
    """Sum of counts; zero when there is nothing to add."""
    return F.coalesce(F.sum(count), F.lit(0)).cast("bigint")


def surplus() -> Column:
    """Aggregate over key groups: rows beyond one per key."""
    return total(F.col(COPIES) - 1)


def duplicate_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: how many rows exceed one per key.

    Equal keys are counted before the shuffle, so only distinct keys move.
    """
    groups = df.groupBy(*key).agg(F.count(F.lit(1)).alias(COPIES))
    return groups.agg(surplus().alias("duplicate_keys"))


def tally(
    df: DataFrame,
    at: Columns,
    key: Sequence[str],
    rules: Sequence[Rule],
    span: str | None = None,
) -> DataFrame:
    """One row: rows, duplicates, rows meeting each rule; one scan, one shuffle.

    A rule decided by the key alone is judged once per distinct key and weighted
    by the copies, so it adds nothing to what is shuffled. Other rules are
    counted per key before the shuffle. ``span`` adds a column's extremes.
    """
    on_key = [rule for rule in rules if set(rule.columns) <= set(key)]
    on_row = [rule for rule in rules if rule not in on_key]
    extremes = {"first_start": F.min, "last_start": F.max} if span else {}
    groups = df.groupBy(*[at[name].alias(name) for name in key]).agg(
        F.count(F.lit(1)).alias(COPIES),
        *[F.count_if(rule.holds(at)).alias(rule.name) for rule in on_row],
        *[pick(at[span]).alias(name) for name, pick in extremes.items() if span not in key],
    )
    keys = {name: F.col(name) for name in key}
    counts = {rule.name: total(F.when(rule.holds(keys), F.col(COPIES))) for rule in on_key}
    counts |= {rule.name: total(F.col(rule.name)) for rule in on_row}
    return groups.agg(
        total(F.col(COPIES)).alias("rows"),
        surplus().alias("duplicate_keys"),
        *[counts[rule.name].alias(rule.name) for rule in rules],
        *[pick(span if span in key else name).alias(name) for name, pick in extremes.items()],
    )
