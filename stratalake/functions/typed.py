"""Required columns in their conformed types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.times import utc_wall_clock
from stratalake.spec import DatasetSpec


# Types that a text with a decimal point still has to reach.
WHOLE_NUMBERS = ("tinyint", "smallint", "int", "bigint")
# A number as text: sign, digits before and after the point, exponent; blanks and controls around it.
_NUMBER = r"^([+-]?)(?=\.?[0-9])([0-9]*)\.?([0-9]*)(?:[eE]([+-]?[0-9]+))?$"
_AROUND = r"^[\x00-\x20\x7f]+|[\x00-\x20\x7f]+$"
# More digits than a whole number can have, and an exponent that moves the point beyond any text kept.
_DIGITS, _FAR = 19, 100_000_000


def field_types(df: DataFrame) -> dict[str, T.DataType]:
    """Column types by lower-case name, as column lookup ignores case."""
    return {field.name.lower(): field.dataType for field in df.schema.fields}


def _whole_part(column: Column) -> Column:
    """The whole part of a number written as text, digit by digit; NULL if it is no number.

    The point is moved by the exponent inside the text, so no digit passes through a double. A
    number with more digits than any whole-number type is NULL.
    """
    text = F.trim(F.regexp_replace(column, _AROUND, ""))
    part = {name: F.regexp_extract(text, _NUMBER, at) for at, name in enumerate(("sign", "whole", "fraction", "exponent"), 1)}
    digits = F.concat(part["whole"], part["fraction"])
    beyond = F.when(F.startswith(part["exponent"], F.lit("-")), -_FAR).otherwise(_FAR)
    exponent = F.coalesce(part["exponent"].try_cast("int"), beyond)
    exponent = F.when(part["exponent"] == "", 0).otherwise(F.greatest(F.least(exponent, F.lit(_FAR)), F.lit(-_FAR)))
    point = F.length(part["whole"]) + exponent
    value = F.regexp_replace(digits, "^0+", "")
    size = point - (F.length(digits) - F.length(value))  # digits before the point, without leading zeros
    before = F.when((size <= 0) | (value == ""), "0").when(size <= _DIGITS, F.rpad(F.left(value, size), size, "0"))
    return F.when(text.rlike(_NUMBER), F.concat(part["sign"], before))


def coerce(column: Column, actual: T.DataType, target: str) -> Column:
    """``column`` as ``target``; a value that does not fit becomes NULL.

    Text becomes a whole number by its own digits: exactly where it is whole, else cut.

    A column that already has the type is returned untouched, which keeps
    comparisons on it eligible for the Parquet scan.
    """
    if actual.simpleString() == target:
        return column
    if target == "timestamp_ntz" and isinstance(actual, T.TimestampType):
        return utc_wall_clock(column)
    cast = column.try_cast(target)
    if isinstance(actual, T.StringType) and target in WHOLE_NUMBERS:
        # A delivery of doubles that met one of text arrives as "1.0", and one of booleans as "true".
        written = F.when(F.lower(F.trim(column)).isin("true", "false"), column.try_cast("boolean"))
        return F.coalesce(cast, _whole_part(column).try_cast(target), written.try_cast(target))
    return cast


def wall_clock(df: DataFrame, name: str) -> Column:
    """A time column as ``timestamp_ntz``, however the session reads stored times."""
    return coerce(F.col(name), field_types(df)[name.lower()], "timestamp_ntz")


def typed_columns(df: DataFrame, spec: DatasetSpec) -> dict[str, Column]:
    present = field_types(df)
    return {
        name: coerce(F.col(name), present[name.lower()], target)
        for name, target in spec.columns
    }


def nulled_by_cast(df: DataFrame, spec: DatasetSpec) -> Column:
    """Aggregate: how many values a conforming cast turns into NULL."""
    present = field_types(df)
    counts = [
        F.count_if(F.col(name).isNotNull() & cast.isNull())
        for name, cast in typed_columns(df, spec).items()
        if present[name.lower()].simpleString() != spec.types[name]
    ]
    return sum(counts, F.lit(0).cast("bigint"))
