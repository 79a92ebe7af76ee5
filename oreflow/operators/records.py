"""From raw documents to bronze rows, and from bronze rows to typed columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.functions import as_date, record_key
from oreflow.functions.extras import listed_part, other_part
from oreflow.schemas import BATCH, EXTRA, INGEST_DATE, RECORD_KEY, STATUS, STEP
from oreflow.settings import NEW


def explode_records(raw: DataFrame, array_col: str, alias: str) -> DataFrame:
    """One row per record. Documents with a null or empty array give none."""
    return raw.select(F.explode(array_col).alias(alias))


def stamp(
    records: DataFrame,
    payload: str,
    datasource: str,
    batch_ts: dt.datetime | None = None,
    batch: str | None = None,
    listed: Sequence[str] | T.StructType | None = None,
) -> DataFrame:
    """Add source, ingest time, status ``new``, record key, ingest date and batch.

    Pass ``batch_ts`` to make a rerun give the same rows; the batch is named after it if it has no name.
    ``listed`` are the fields that the payload keeps: names, or a type, which lists the fields of nested structs as
    well. What is beyond them, at any depth, goes to ``extra`` as JSON text, null if the record has no such
    value, and counts for the record key. In it the elements of an array keep their places.
    """
    now = F.current_timestamp() if batch_ts is None else F.lit(batch_ts.isoformat(" ")).cast("timestamp")
    value, extra, kind = F.col(payload), F.lit(None).cast("string"), records.schema[payload].dataType
    if listed is not None:
        if not isinstance(listed, T.StructType):
            listed = T.StructType([kind[name] for name in listed])
        more = other_part(value, kind, listed)
        value = listed_part(value, kind, listed)
        extra = extra if more is None else F.to_json(more)
    name = F.date_format(now, "yyyyMMdd'T'HHmmss.SSSSSS") if batch is None else F.lit(batch)
    return records.select(
        F.lit(datasource).alias("datasource"),
        now.alias("ingesttime"),
        value.alias(payload),
        extra.alias(EXTRA),
        record_key(records, payload).alias(RECORD_KEY),
        F.to_date(now).alias(INGEST_DATE),
        name.alias(BATCH),
        F.lit(NEW).alias(STATUS),
        F.lit("0").alias(STEP),
    )


def flatten(
    bronze: DataFrame,
    payload: str,
    fields: Sequence[str],
    date_fields: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """The payload's fields as columns, the named ones cast to date.

    ``keep`` names bronze columns to carry along, such as the payload itself.
    """

    def column(name):
        value = F.col(f"{payload}.{name}")
        return (as_date(value) if name in date_fields else value).alias(name)

    return bronze.select(*keep, *map(column, fields))


def explode_nested(
    df: DataFrame,
    path: str,
    fields: Sequence[str] | None = None,
    keep: Sequence[str] = (),
    alias: str = "item",
) -> DataFrame:
    """One row per element of a nested array, with columns of the parent kept on request.

    With ``fields`` the element's fields become columns; without, the element stays whole. Several
    columns of one element come from one explode, so the parent is read and repeated once.
    """
    rows = df.select(*keep, F.explode(F.col(path)).alias(alias))
    return rows if fields is None else rows.select(*keep, *[F.col(f"{alias}.{f}") for f in fields])
