"""All writes: external Parquet tables whose files are never changed in place.

New rows are appended to a table. Rows that a step replaces are written as partitions of their own, in the
table's folder, before the old partitions and their files go. A rewrite of a whole table goes to a new run
folder, and the catalog is pointed at it only when the write has finished, so a failed job leaves the table
as it was. One writer per table at a time. Tables outlive the session where the catalog does.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterable, Sequence
from contextlib import contextmanager, nullcontext
from urllib.parse import unquote

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.functions.files import delete_folder, folders
from oreflow.schemas import require_shape, shape
from oreflow.sources.tables import location_of

# Steps that write several tables at once change the catalog one after the other.
CATALOG = threading.RLock()
# A quarter smaller than Spark's default codec, written and read in the same time.
CODEC = "zstd"
# Files that a task keeps open at once, where each task has rows of few partitions; it sorts what is beyond them.
OPEN_FILES = 4


def table_exists(spark: SparkSession, table: str) -> bool:
    """Whether the table is there. One that a lost driver left under its other name gets its own back."""
    if spark.catalog.tableExists(table):
        return True
    if spark.catalog.tableExists(f"{table}__before"):
        spark.sql(f"ALTER TABLE {table}__before RENAME TO {table}")
        return True
    return False


def run_folder(path: str) -> str:
    return f"{path.rstrip('/')}/run-{uuid.uuid4().hex}"


def _text(value) -> str:
    """A SQL string literal."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _type(kind: T.DataType) -> str:
    """A type as SQL text, with the names of nested fields quoted."""
    if isinstance(kind, T.StructType):
        names = [f"`{f.name.replace('`', '``')}`: {_type(f.dataType)}" for f in kind.fields]
        return f"struct<{', '.join(names)}>"
    if isinstance(kind, T.ArrayType):
        return f"array<{_type(kind.elementType)}>"
    if isinstance(kind, T.MapType):
        return f"map<{_type(kind.keyType)}, {_type(kind.valueType)}>"
    return kind.simpleString()


def register(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    location: str,
    partition_by: Sequence[str] = (),
    empty: bool = False,
) -> None:
    """(Re)create the external table over a folder, with its partitions. Drops no files.

    ``empty`` says that nothing has been written there yet. The table is made ready under another name and
    then renamed. The old one is there until then, and again if that fails.
    """
    columns = ", ".join(f"`{f.name.replace('`', '``')}` {_type(f.dataType)}" for f in schema.fields)
    parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    kind = f"USING parquet OPTIONS (compression {_text(CODEC)})"
    new, before = f"{table}__new", f"{table}__before"
    there = table_exists(spark, table)
    for name in (new, before):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {new} ({columns}) {kind} {parts} LOCATION {_text(location)}")
    if partition_by and not empty:
        spark.sql(f"MSCK REPAIR TABLE {new}")
    if there:
        spark.sql(f"ALTER TABLE {table} RENAME TO {before}")
    try:
        spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    except BaseException:
        if there:
            spark.sql(f"ALTER TABLE {before} RENAME TO {table}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {before}")


def partitions(spark: SparkSession, table: str) -> list[dict[str, str | None]]:
    """The table's partitions, from the catalog: column names and values as text, null as None."""
    found = []
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        pairs = [part.split("=", 1) for part in row[0].split("/")]
        found.append({c: None if v in ("__HIVE_DEFAULT_PARTITION__", "null") else unquote(v) for c, v in pairs})
    return found


def drop_partitions(spark: SparkSession, table: str, which: Callable[[dict], bool]) -> int:
    """Remove partitions with their files: the folder first, so that what is left half done holds no rows."""
    place = location_of(spark, table)
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect() if table_exists(spark, table) else []
    gone = [(row[0], p) for row, p in zip(rows, partitions(spark, table), strict=True) if which(p)]
    for folder, _ in gone:
        delete_folder(spark, f"{place}/{folder}")
    for k in range(0, len(gone), 100):
        specs = []
        for _, p in gone[k : k + 100]:
            values = [f"`{c}` = {'null' if v is None else _text(v)}" for c, v in p.items()]
            specs.append(f"PARTITION ({', '.join(values)})")
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(specs)}")
    if gone:
        spark.catalog.refreshTable(table)
    return len(gone)


def free_unused(spark: SparkSession, table: str, path: str) -> list[str]:
    """Delete the run folders of a layer that the table no longer names, and return them.

    Only folders right under ``path`` that ``run_folder`` named, never any other. To be called when nobody
    reads an older state of the table.
    """
    current = location_of(spark, table).rstrip("/").rsplit("/", 1)[-1]
    gone = [f for f in folders(spark, path) if f.rsplit("/", 1)[-1] != current and f.rsplit("/", 1)[-1].startswith("run-")]
    for folder in gone:
        delete_folder(spark, folder)
    return gone


def _spread(df: DataFrame, partition_by: Sequence[str], one_value: bool) -> DataFrame:
    """Bring a partition's rows together, so that not every task writes a file for every partition.

    A rebalance splits a partition value that holds much of the data over several tasks. With one
    value per batch there is nothing to gather, and no shuffle.
    """
    return df.hint("rebalance", *partition_by) if partition_by and not one_value else df


@contextmanager
def _unsorted(spark: SparkSession):
    """Writes within it keep a file open for each of a task's first partitions instead of sorting its rows."""
    option = "spark.sql.maxConcurrentOutputFileWriters"
    was = spark.conf.get(option)
    spark.conf.set(option, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(option, was)


def batch_writer(
    df: DataFrame,
    partition_by: str | Sequence[str],
    exclude: Sequence[str] = (),
    mode: str = "overwrite",
    one_value: bool = False,
) -> DataFrameWriter:
    """A Parquet writer for a folder, partitioned, without the excluded columns."""
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    rows = _spread(df.drop(*exclude), cols, one_value)
    return rows.write.format("parquet").option("compression", CODEC).mode(mode).partitionBy(*cols)


def append_rows(
    df: DataFrame,
    table: str,
    schema: T.StructType,
    path: str,
    partition_by: Sequence[str] = (),
    one_value: bool = False,
) -> None:
    """Add rows to the table, created under ``path`` if need be. Raises on a schema difference.

    ``one_value`` says that the whole batch falls into one partition, as with an ingest date.
    """
    spark = df.sparkSession
    require_shape(df.schema, schema, table)
    if not table_exists(spark, table):
        register(spark, table, schema, run_folder(path), partition_by, empty=True)
    require_shape(spark.table(table).schema, schema, table)
    insert_rows(df, table, partition_by, one_value)


def insert_rows(df: DataFrame, table: str, partition_by: Sequence[str] = (), one_value: bool = False) -> None:
    """Append to a table that is there, columns by name. The rows may be read from other partitions of it.

    With ``one_value`` a task has few partitions' rows and writes them as they come: whole rows are not sorted by
    partition first, which would spill where a task reads much.
    """
    spark = df.sparkSession
    rows = _spread(df, partition_by, one_value).select(*spark.table(table).columns)
    with _unsorted(spark) if one_value and partition_by else nullcontext():
        rows.write.mode("append").insertInto(table)


def write_snapshot(
    df: DataFrame,
    table: str,
    schema: T.StructType,
    path: str,
    partition_by: Sequence[str] = (),
    one_value: bool = False,
) -> None:
    """Replace the table's rows, and its schema if that has changed.

    The plan may read the table it replaces: the old files stay where they are.
    """
    spark = df.sparkSession
    require_shape(df.schema, schema, table)
    folder = run_folder(path)
    rows = _spread(df.select(*schema.fieldNames()), partition_by, one_value)
    with _unsorted(spark) if one_value and partition_by else nullcontext():
        rows.write.option("compression", CODEC).partitionBy(*partition_by).parquet(folder)
    with CATALOG:
        if not partition_by and table_exists(spark, table):
            if shape(spark.table(table).schema) == shape(schema):
                spark.sql(f"ALTER TABLE {table} SET LOCATION {_text(folder)}")
                return
        register(spark, table, schema, folder, partition_by)


def replace_partitions(
    df: DataFrame, table: str, partition_col: str, values: Iterable, sort_by: Sequence[str] = ()
) -> None:
    """Swap whole partitions for new rows; the table's other partitions are not touched.

    ``df`` must hold every row those partitions should have, and may read them. A listed partition of
    which it holds none goes. Within a file rows are ordered by ``sort_by``.
    """
    spark, wanted = df.sparkSession, {None if value is None else str(value) for value in values}
    require_shape(df.schema, spark.table(table).schema, table)
    rows = _spread(df, [partition_col], one_value=len(wanted) == 1).sortWithinPartitions(partition_col, *sort_by)
    there = {row[0] for row in df.select(F.col(partition_col).cast("string")).distinct().collect()}
    mode = "spark.sql.sources.partitionOverwriteMode"
    was = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")  # as an option of the write, Spark would not let it read the table
    try:
        rows.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(mode, was)
    drop_partitions(spark, table, lambda p: p[partition_col] in wanted - there)
    spark.catalog.refreshTable(table)
