"""A stable key for a nested record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Full precision, so that two records that differ in a microsecond get two keys.
_JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _has(kind: T.DataType, wanted: tuple[type, ...]) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has(f.dataType, wanted) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has(kind.elementType, wanted)
    return isinstance(kind, wanted)


def _positive_zero(value: Column, kind: T.DataType) -> Column:
    """Rewrite -0.0 as 0.0 at any depth: equal as values, so they must be equal as text."""
    if not _has(kind, (T.DoubleType, T.FloatType)):
        return value
    if isinstance(kind, T.StructType):
        parts = [_positive_zero(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: _positive_zero(item, kind.elementType))
    return F.when(value == 0, F.lit(0.0).cast(kind)).otherwise(value)


def record_key(df: DataFrame, payload: str) -> Column:
    """SHA-256 over the record's JSON text; null for a null record.

    Equal keys mean equal structs: null fields count as equal, a null record matches nothing.
    """
    kind = df.schema[payload].dataType
    if _has(kind, (T.MapType,)):
        raise TypeError(f"{payload}: maps have no equality; use an array of key/value structs")
    text = F.to_json(_positive_zero(F.col(payload), kind), _JSON_OPTIONS)
    return F.unhex(F.sha2(text, 256))
