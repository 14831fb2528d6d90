"""Canonical JSON: keys in alphabetical order at every level, nulls kept."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _has_struct(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_struct(kind.elementType)
    return isinstance(kind, T.StructType)


def sorted_fields(value: Column, kind: T.DataType) -> Column:
    """The same value with struct fields in alphabetical order at every level."""
    if isinstance(kind, T.StructType):
        rebuilt = F.struct(*[sorted_fields(value[f.name], f.dataType).alias(f.name)
                             for f in sorted(kind.fields, key=lambda f: f.name)])
        return F.when(value.isNotNull(), rebuilt)
    if isinstance(kind, T.ArrayType) and _has_struct(kind):
        return F.transform(value, lambda v: sorted_fields(v, kind.elementType))
    return value


def canonical_json(value: Column, kind: T.DataType) -> Column:
    """JSON text as it is exported and hashed; maps and open values are sorted where they are made."""
    return F.to_json(sorted_fields(value, kind), {"ignoreNullFields": "false"})
