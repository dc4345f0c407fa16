"""Values in a wider type, inside structs, arrays and maps as well."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.typed import coerce

_NESTED = (T.StructType, T.ArrayType, T.MapType)
# Times as UTC whatever the session zone, and no field left out.
_JSON = {"timeZone": "UTC", "ignoreNullFields": "false"}


def _fields(column: Column, actual: T.StructType, target: T.StructType) -> Column:
    own = {field.name.lower(): field for field in actual}

    def value(field: T.StructField) -> Column:
        known = own.get(field.name.lower())
        if known is None:
            return F.lit(None).cast(field.dataType)
        return fitted(column.getField(known.name), known.dataType, field.dataType)

    made = F.struct(*[value(field).alias(field.name) for field in target])
    return F.when(column.isNotNull(), made)


def fitted(column: Column, actual: T.DataType, target: T.DataType) -> Column:
    """``column`` as ``target``, a type that ``common_type`` chose.

    Fields a struct lacks are NULL; a NULL struct, array or map stays NULL. Where nested values
    have to become text they are written as JSON.
    """
    if actual.simpleString() == target.simpleString():
        return column
    if isinstance(actual, T.StructType) and isinstance(target, T.StructType):
        return _fields(column, actual, target)
    if isinstance(actual, T.ArrayType) and isinstance(target, T.ArrayType):
        return F.transform(column, lambda x: fitted(x, actual.elementType, target.elementType))
    if isinstance(actual, T.MapType) and isinstance(target, T.MapType):
        keys = F.transform(F.map_keys(column), lambda x: fitted(x, actual.keyType, target.keyType))
        values = F.transform(F.map_values(column), lambda x: fitted(x, actual.valueType, target.valueType))
        return F.map_from_arrays(keys, values)
    if isinstance(actual, _NESTED) and isinstance(target, T.StringType):
        return F.to_json(column, _JSON)
    return coerce(column, actual, target.simpleString())
