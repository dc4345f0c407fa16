"""Union of frames whose schemas drifted apart."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.nested import fitted
from stratalake.functions.typed import field_types

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)
# Digits needed to hold any value of a whole-number type.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_MAX_DIGITS = 38


def _common_decimal(kinds: Sequence[T.DataType]) -> T.DataType:
    shapes = [
        (kind.precision, kind.scale)
        if isinstance(kind, T.DecimalType)
        else (_DIGITS[type(kind)], 0)
        for kind in kinds
    ]
    scale = max(scale for _, scale in shapes)
    digits = max(precision - scale for precision, scale in shapes) + scale
    # Beyond that no number type keeps every digit; text does, as for other disagreements.
    return T.DecimalType(digits, scale) if digits <= _MAX_DIGITS else T.StringType()


def _common_fields(kinds: Sequence[T.StructType]) -> T.StructType:
    """All fields by name, without regard to case, in first spelling and order."""
    seen: dict[str, tuple[str, list[T.DataType]]] = {}
    for kind in kinds:
        for field in kind:
            seen.setdefault(field.name.lower(), (field.name, []))[1].append(field.dataType)
    return T.StructType([T.StructField(name, common_type(types)) for name, types in seen.values()])


def _common_key(kinds: Sequence[T.DataType]) -> T.DataType:
    """Type of map keys: as other values, but text where a wider type could merge two keys."""
    kind = common_type(kinds)
    differ = len({each.simpleString() for each in kinds}) > 1
    return T.StringType() if differ and isinstance(kind, _FLOATING) else kind


def common_type(kinds: Sequence[T.DataType]) -> T.DataType:
    """Type that holds all of ``kinds``, inside structs, arrays and maps as well.

    Chosen here because the type a plain union picks depends on ANSI mode:
    an INT meeting a STRING becomes BIGINT there and fails on the first word.
    """
    kinds = [kind for kind in kinds if not isinstance(kind, T.NullType)] or [T.NullType()]
    if len({kind.simpleString() for kind in kinds}) == 1:
        return kinds[0]
    if all(isinstance(kind, _WHOLE) for kind in kinds):
        return max(kinds, key=lambda kind: _WHOLE.index(type(kind)))
    if all(isinstance(kind, (*_WHOLE, T.DecimalType)) for kind in kinds):
        return _common_decimal(kinds)
    if all(isinstance(kind, (*_WHOLE, *_FLOATING, T.DecimalType)) for kind in kinds):
        return T.DoubleType()
    if all(isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) for kind in kinds):
        return T.TimestampNTZType()
    if all(isinstance(kind, T.StructType) for kind in kinds):
        return _common_fields(kinds)
    if all(isinstance(kind, T.ArrayType) for kind in kinds):
        return T.ArrayType(common_type([kind.elementType for kind in kinds]))
    if all(isinstance(kind, T.MapType) for kind in kinds):
        keys, values = ([getattr(kind, part) for kind in kinds] for part in ("keyType", "valueType"))
        return T.MapType(_common_key(keys), common_type(values))
    return T.StringType()


def common_types(frames: Sequence[DataFrame]) -> dict[str, T.DataType]:
    seen: dict[str, list[T.DataType]] = {}
    for frame in frames:
        for name, kind in field_types(frame).items():
            seen.setdefault(name, []).append(kind)
    return {name: common_type(kinds) for name, kinds in seen.items()}


def unify(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name: absent columns and fields are NULL, differing types are widened.

    Names match without regard to case and keep their first spelling.
    """
    target = common_types(frames)

    def aligned(frame: DataFrame) -> DataFrame:
        columns = []
        for field in frame.schema.fields:
            column = fitted(F.col(f"`{field.name}`"), field.dataType, target[field.name.lower()])
            columns.append(column.alias(field.name))
        return frame.select(columns)

    return reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True),
        [aligned(frame) for frame in frames],
    )
