"""Reads of the layered tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_status(spark: SparkSession, table: str, status: str) -> DataFrame:
    """Rows of a table that stand at the given load status, read from that status's partitions alone."""
    return spark.table(table).filter(F.col("status") == status)


def read_location(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A layer's files, always with their known schema: an all-null partition column has none."""
    return spark.read.schema(schema).parquet(path)


def location_of(spark: SparkSession, table: str) -> str:
    """The folder a table is registered at."""
    found = location_if_any(spark, table)
    if found is None:
        raise LookupError(f"{table} has no folder")
    return found


def location_if_any(spark: SparkSession, table: str) -> str | None:
    """The folder a table is registered at; none for a view."""
    row = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first()
    return row and row["data_type"]


def _bare(path: str) -> str:
    scheme, _, rest = path.rpartition(":")
    return (rest if scheme == "file" else path).replace("///", "/").rstrip("/")


def table_at(spark: SparkSession, path: str, database: str = "default") -> str:
    """Name of the table whose rows live under a layer's folder.

    One look-up in the catalog, whatever the number of tables: it alone knows which of a layer's run folders is
    current.
    """
    for row in spark.sql(f"SHOW TABLE EXTENDED IN {database} LIKE '*'").collect():
        facts = dict(line.split(": ", 1) for line in row["information"].splitlines() if ": " in line)
        place = None if row["isTemporary"] or facts.get("Type") == "VIEW" else facts.get("Location")
        if place is not None and f"{_bare(place)}/".startswith(f"{_bare(path)}/"):
            return f"{database}.{row['tableName']}"
    raise LookupError(f"no table of {database} is registered under {path}")
