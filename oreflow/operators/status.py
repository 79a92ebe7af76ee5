"""Merging an outcome back into the rows it came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.schemas import RECORD_KEY


def one_per_key(source: DataFrame, key: str, *outcome: Column) -> DataFrame:
    """One row per key, to be joined to a side on which one key may hold much of the data.

    The key's hash is a second grouping column, so that the join does not reuse this shuffle but
    makes its own over the few rows left. Spark splits a hot key's partition only between two plain
    shuffles; an aggregate in between would send all rows of that key to one task.
    """
    spread = source.withColumn("spread", F.xxhash64(key))
    if not outcome:
        return spread.select(key, "spread").distinct().drop("spread")
    return spread.groupBy(key, "spread").agg(*outcome).drop("spread")


def merge_status(
    target: DataFrame, source: DataFrame, key: str = RECORD_KEY, status: str | None = None
) -> DataFrame:
    """Target rows, with the status of the matching source row where there is one.

    Matched rows are updated, all copies of them; unmatched target rows stay; unmatched source rows
    are ignored. ``status`` is one status for the whole source; without it each source row brings
    its own. The source is reduced to one row per key before the shuffle, so the result always has
    the target's row count, and the join is left outer, so Spark may split a hot key's target rows.
    """
    if status is not None:
        outcome = one_per_key(source, key).withColumn("new_status", F.lit(status))
    else:
        outcome = one_per_key(source, key, F.max("status").alias("new_status"))
    merged = target.join(outcome, key, "left")
    return merged.withColumn("status", F.coalesce("new_status", "status")).select(*target.columns)
