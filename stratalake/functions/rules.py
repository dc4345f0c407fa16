"""Row rules shared by cleaning, reporting and auditing."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column

from stratalake.functions.times import moment
from stratalake.spec import DatasetSpec

Columns = Mapping[str, Column]


@dataclass(frozen=True)
class Rule:
    """A condition worth counting, and the columns that decide it."""

    name: str
    columns: tuple[str, ...]
    holds: Callable[[Columns], Column]


def broken_rules(spec: DatasetSpec) -> tuple[Rule, ...]:
    """Conditions a clean row must not meet, in the order they are reported.

    They overlap, and a NULL operand meets none of them.
    """

    def out_of_range(at: Columns) -> Column:
        begin = at[spec.starts]
        return (begin < moment(spec.lower)) | (begin >= moment(spec.upper))

    return (
        Rule("negative_amount", (spec.amount,), lambda at: at[spec.amount] < 0),
        Rule(
            "bad_interval",
            (spec.starts, spec.ends),
            lambda at: at[spec.starts] >= at[spec.ends],
        ),
        Rule("out_of_range", (spec.starts,), out_of_range),
    )


def acceptable(spec: DatasetSpec, at: Columns) -> Column:
    """What cleaning keeps. A NULL operand makes this NULL, so a filter drops the row."""
    begin = at[spec.starts]
    in_range = (begin >= moment(spec.lower)) & (begin < moment(spec.upper))
    return (at[spec.amount] >= 0) & (begin < at[spec.ends]) & in_range


def is_null(column: str, name: str | None = None) -> Rule:
    return Rule(name or f"{column}_nulls", (column,), lambda at: at[column].isNull())


def is_zero(column: str, name: str) -> Rule:
    return Rule(name, (column,), lambda at: at[column] == 0)


def outside(column: str, low: int, high: int) -> Rule:
    """Present and beyond the inclusive limits; NULL is never outside."""
    return Rule(f"{column}_range", (column,), lambda at: ~at[column].between(low, high))
