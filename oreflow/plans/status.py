"""Status changes of the bronze table. Rows that change move to partitions of their own.

The new partitions of a change enter the catalog when its write has finished; after that the old ones go. A
run that stops in between leaves both. What it left is put right by ``undo_unfinished`` before the next change, so
every change may be run again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.functions.files import delete_folder, read_text, write_text
from oreflow.operators import merge_status, one_per_key
from oreflow.schemas import BATCH, BRONZE_PARTS, RECORD_KEY, STATUS, STEP
from oreflow.settings import NEW, QUARANTINED
from oreflow.sinks.sketches import BITMAP, has_bit, may_hold, place_column, place_of, run_of
from oreflow.sinks.tables import drop_partitions, insert_rows, partitions, table_exists
from oreflow.sources.tables import location_of

# What a step appends to the name of a row's step: loaded from new, repaired from quarantined.
LOAD, REPAIR = "l", "r"
# Where a merge says what it is about to do, in the table's folder.
INTENT = "_merge.json"
# Bitmaps of changed rows, of 4 kB and for up to ``BITMAP`` rows each, that every task gets whole. More are joined by
# a shuffle.
MOST_MAPS = 16_384
MAP = ["file", "file2", "bitmap"]


def at_status(spark: SparkSession, table: str, status: str) -> list[dict]:
    """The table's partitions that stand at a status. Reads the catalog only."""
    return [part for part in partitions(spark, table) if part[STATUS] == status]


def stale_places(table: DataFrame, source: DataFrame, status: str, key: str = RECORD_KEY) -> DataFrame:
    """Partitions with a row that matches a source row and has another status.

    The source is made one row per key by an aggregate whose partitions the join does not reuse, so the
    table's side is shuffled once, unaggregated, and a hot key in it can be split.
    """
    stale = table.filter(F.col(STATUS) != status).select(key, place_column().alias("place"))
    return stale.join(one_per_key(source, key), key, "left_semi").select("place").distinct()


def _numbered(rows: DataFrame) -> DataFrame:
    """The rows with the bitmap of their file, and the bit in it, that stands for each. A file's path is two hashes."""
    path, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    return rows.select(
        "*", F.xxhash64(path).alias("file"), F.xxhash64(path, F.lit(7)).alias("file2"),
        F.floor(row / BITMAP).alias("bitmap"), (row % BITMAP).alias("bit"),
    )


def _changes(rows: DataFrame, source: DataFrame, key: str, status: str) -> DataFrame:
    """Which rows of the table's files a merge gives another status, as bitmaps. Keys are shuffled, and no payload."""
    narrow = _numbered(rows).select(key, STATUS, *MAP, "bit")
    changed = merge_status(narrow.filter(F.col(STATUS) != status), source, key, status).filter(F.col(STATUS) == status)
    return changed.groupBy(*MAP).agg(F.bitmap_construct_agg("bit").alias("bits"))


def _with_status(rows: DataFrame, changes: DataFrame, status: str) -> DataFrame:
    """The rows, with the status for those that the bitmaps name. Few bitmaps go to the rows, which stay in their order."""
    maps = F.broadcast(changes) if changes.count() <= MOST_MAPS else changes
    marked = _numbered(rows).join(maps, MAP, "left")
    new = F.when(has_bit(F.col("bits"), F.col("bit")), status).otherwise(F.col(STATUS))
    return marked.withColumn(STATUS, new).select(*rows.columns)


def undo_unfinished(spark: SparkSession, bronze: str, silver: str | None = None) -> None:
    """Put right what a step left that was cut short. Reads the catalog and one small file.

    A merge that has written all its rows is finished, else what it wrote goes. Of a batch that was brought in
    again only the last run counts. Rows that a step moved while their old partition is still there go,
    in silver too, and so do rows of runs that bronze no longer has: the step will be run again.
    """
    if not table_exists(spark, bronze):
        return
    note = f"{location_of(spark, bronze).rstrip('/')}/{INTENT}"
    intent = read_text(spark, note)
    if intent is not None:
        left = json.loads(intent)
        if read_text(spark, f"{note}.{left['mark']}") is not None:
            drop_partitions(spark, bronze, lambda part: place_of(part) in set(left["places"]))
        else:
            drop_partitions(spark, bronze, lambda part: (part[STEP] or "").endswith(left["mark"]))
        delete_folder(spark, f"{note}.rows-{left['mark']}")
        delete_folder(spark, note)
        delete_folder(spark, f"{note}.{left['mark']}")
    there = partitions(spark, bronze)
    last: dict[str | None, int] = {}
    for part in there:
        last[part[BATCH]] = max(last.get(part[BATCH], 0), run_of(part[STEP]) or 0)

    def superseded(part: dict) -> bool:
        run = run_of(part[STEP])
        return run is not None and part[BATCH] in last and run < last[part[BATCH]]

    open_at = {(p[BATCH], p[STEP] + {NEW: LOAD, QUARANTINED: REPAIR}[p[STATUS]]) for p in there if p[STATUS] in (NEW, QUARANTINED)}

    def unfinished(part: dict) -> bool:
        return superseded(part) or (part[BATCH], part[STEP]) in open_at

    if any(map(unfinished, there)):
        drop_partitions(spark, bronze, unfinished)
    if silver is not None and table_exists(spark, silver):
        if any(unfinished(part) or part[BATCH] not in last for part in partitions(spark, silver)):
            drop_partitions(spark, silver, lambda part: unfinished(part) or part[BATCH] not in last)


def update_status(
    spark: SparkSession, table: str, source: DataFrame, status: str, key: str = RECORD_KEY
) -> bool:
    """Merge one status into the table for every row that matches a row of ``source``, all copies of it.

    ``source`` is any DataFrame with the key column; it may be derived from the table itself. A first,
    narrow pass finds the partitions that change, a second one their rows; these partitions alone are rewritten, by
    tasks that read them and shuffle nothing. With few keys, sketches of the
    batches' keys tell which of them the first pass need not read. Returns whether any row changed.

    What the merge will replace is noted in the table's folder before it writes, and noted again when it has
    written; so after a stop the next call finishes it or takes it back, and then merges.
    """
    undo_unfinished(spark, table)
    rows = spark.table(table)
    some = rows
    if key == RECORD_KEY:
        held = may_hold(spark, table, source, [p for p in partitions(spark, table) if p[STATUS] != status])
        if held is not None:
            some = rows.filter(place_column().isin([place_of(p) for p in held])) if held else rows.limit(0)
    places = [row[0] for row in stale_places(some, source, status, key).collect()]
    if places:
        note = f"{location_of(spark, table).rstrip('/')}/{INTENT}"
        mark = f"u{uuid.uuid4().hex[:12]}"
        write_text(spark, note, json.dumps({"mark": mark, "places": places}))
        here, found = rows.filter(place_column().isin(places)), f"{note}.rows-{mark}"
        changes = _changes(here, source, key, status)
        changes.write.option("compression", "zstd").parquet(found)
        merged = _with_status(here, spark.read.schema(changes.schema).parquet(found), status)
        run = F.regexp_extract(STEP, r"^\d+", 0)
        insert_rows(merged.withColumn(STEP, F.concat(run, F.lit(mark))), table, BRONZE_PARTS, one_value=True)
        write_text(spark, f"{note}.{mark}", "written")
        drop_partitions(spark, table, lambda part: place_of(part) in set(places))
        delete_folder(spark, found)
        delete_folder(spark, note)
        delete_folder(spark, f"{note}.{mark}")
    return bool(places)


def settle(
    spark: SparkSession,
    table: str,
    from_status: str,
    outcome: Column,
    mark: str,
    key: str = RECORD_KEY,
    seen: Callable[[DataFrame], DataFrame] | None = None,
    before_old_go: Callable[[set[tuple[str, str]]], None] | None = None,
) -> bool:
    """Give every row at ``from_status`` its outcome. Rows of other statuses are neither read nor changed.

    The rows are read once and written as partitions of their batch's next step, whose name is the old one's and
    ``mark``; then the old partitions go. What a run that was cut short left of that step is replaced, so
    the step may be run again. A null outcome leaves a row's status as it is, and so does a null
    record, which has no key; a partition in which no row changes stays. Nothing is shuffled.

    ``seen`` may wrap the rows that are read, to count them. ``before_old_go`` is called between the two writes
    with the batches and steps just written: what it does is done again if the run is lost before the old
    partitions have gone.
    """
    moved = at_status(spark, table, from_status)
    if not moved:
        return False
    steps = {(part[BATCH], part[STEP] + mark) for part in moved}
    drop_partitions(spark, table, lambda part: (part[BATCH], part[STEP]) in steps)
    rows = spark.table(table).filter(F.col(STATUS) == from_status)
    rows = rows if seen is None else seen(rows)
    decided = F.coalesce((outcome != from_status) & F.col(key).isNotNull(), F.lit(False))
    # its tasks read one batch each, mostly, and write a file for each status: no shuffle is needed
    settled = rows.withColumn("settled", F.when(decided, outcome).otherwise(F.col(STATUS)))
    settled = settled.withColumn(STATUS, F.col("settled")).withColumn(STEP, F.concat(STEP, F.lit(mark)))
    insert_rows(settled.drop("settled"), table, BRONZE_PARTS, one_value=True)
    changed = {(p[BATCH], p[STEP]) for p in partitions(spark, table) if p[STATUS] != from_status} & steps
    if steps - changed:
        drop_partitions(spark, table, lambda part: (part[BATCH], part[STEP]) in steps - changed)
    if changed:
        if before_old_go is not None:
            before_old_go(changed)
        old = {place_of(part) for part in moved if (part[BATCH], part[STEP] + mark) in changed}
        drop_partitions(spark, table, lambda part: place_of(part) in old)
    return bool(changed)
