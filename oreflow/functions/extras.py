"""Fields beyond a listed type, at any depth."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def merged(listed: T.DataType, found: T.DataType) -> T.DataType:
    """The listed type, with the found fields that it lacks after its own, in nested structs and arrays too.

    Where the two differ in kind the listed one counts. Names are compared without regard to case.
    """
    if isinstance(listed, T.StructType) and isinstance(found, T.StructType):
        others = {f.name.lower(): f for f in found.fields}
        fields = []
        for f in listed.fields:
            other = others.pop(f.name.lower(), None)
            kind = f.dataType if other is None else merged(f.dataType, other.dataType)
            fields.append(T.StructField(f.name, kind, f.nullable))
        return T.StructType([*fields, *others.values()])
    if isinstance(listed, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(merged(listed.elementType, found.elementType))
    return listed


def listed_part(value: Column, kind: T.DataType, listed: T.DataType) -> Column:
    """The value with the listed fields alone."""
    if kind == listed:
        return value
    if isinstance(listed, T.StructType):
        own = {f.name: f.dataType for f in kind.fields}
        parts = [listed_part(value[f.name], own[f.name], f.dataType).alias(f.name) for f in listed.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(listed, T.ArrayType):
        return F.transform(value, lambda item: listed_part(item, kind.elementType, listed.elementType))
    return value


def _has_more(kind: T.DataType, listed: T.DataType) -> bool:
    if isinstance(listed, T.StructType):
        own = {f.name: f.dataType for f in listed.fields}
        return any(f.name not in own or _has_more(f.dataType, own[f.name]) for f in kind.fields)
    return isinstance(listed, T.ArrayType) and _has_more(kind.elementType, listed.elementType)


def other_part(value: Column, kind: T.DataType, listed: T.DataType) -> Column | None:
    """The value with what the listed type leaves out, null where there is nothing; None if there cannot be any.

    Elements of an array keep their places, so that they can be put beside the listed ones.
    """
    if not _has_more(kind, listed):
        return None
    if isinstance(listed, T.ArrayType):
        there = F.exists(value, lambda item: other_part(item, kind.elementType, listed.elementType).isNotNull())
        items = F.transform(value, lambda item: other_part(item, kind.elementType, listed.elementType))
        return F.when(there, items)
    own, parts = {f.name: f.dataType for f in listed.fields}, []
    for f in kind.fields:
        part = value[f.name] if f.name not in own else other_part(value[f.name], f.dataType, own[f.name])
        if part is not None:
            parts.append(part.alias(f.name))
    there = reduce(or_, [part.isNotNull() for part in parts])
    return F.when(there, F.struct(*parts))
