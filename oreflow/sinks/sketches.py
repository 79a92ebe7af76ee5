"""Sketches of the keys that each batch of the bronze table holds, so that a small merge need not read them all.

A sketch is a Bloom filter with two bits a key and sixteen bits of room, kept as bitmaps of 32,768 bits: the
aggregate that makes it is Spark's own, combines on the map side and has no bound on a batch's size. A batch's rows
keep their keys whatever happens to them, so it is sketched once, when it comes in. Sketches lie in a folder of
the table that table reads do not see, one folder for each run of a batch. Batches without a sketch are
always read, so sketches save reading and decide nothing.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.functions.files import delete_folder, folders
from oreflow.schemas import BATCH, BRONZE_PARTS, RECORD_KEY, STEP
from oreflow.sinks.tables import partitions
from oreflow.sources.tables import location_of

BITMAP = 32_768
# Bits for each key, and keys of a merge up to which sketches are asked.
ROOM, MOST_KEYS = 16, 2000


def place_column() -> Column:
    """Where a row stands, from partition columns alone, so that a filter on it prunes."""
    return F.concat_ws("/", *[F.col(c).cast("string") for c in BRONZE_PARTS])


def place_of(part: dict) -> str:
    return "/".join(str(part[c]) for c in BRONZE_PARTS)


def run_of(step: str | None) -> int | None:
    """The number of the run that brought a batch in, which its steps' names begin with."""
    number = re.match(r"\d+", step or "")
    return int(number[0]) if number else None


def _name(part: dict) -> str:
    """The sketch of a partition: that of its batch and run."""
    return hashlib.md5(f"{part[BATCH]}/{run_of(part[STEP])}".encode()).hexdigest()


def _folder(spark: SparkSession, table: str) -> str:
    return f"{location_of(spark, table).rstrip('/')}/_keys"


def _positions(room: Column, key: str) -> Column:
    return F.array(F.pmod(F.xxhash64(key), room), F.pmod(F.xxhash64(key, F.lit(1)), room))


def has_bit(bits: Column, bit: Column) -> Column:
    """Whether a bitmap has a bit."""
    byte = F.conv(F.hex(F.substring(bits, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.pow(F.lit(2), bit % 8).cast("int")) > 0


def sketch_run(spark: SparkSession, table: str, batch: str, run: int, rows: DataFrame, n: int) -> None:
    """Sketch the ``n`` rows of a run of a batch. Sketches of runs that the table no longer has go."""
    base, mine = _folder(spark, table), _name({BATCH: batch, STEP: str(run)})
    room = F.lit(max(BITMAP, 1 << (ROOM * max(n, 1) - 1).bit_length())).cast("long")
    bits = rows.filter(F.col(RECORD_KEY).isNotNull()).select(F.explode(_positions(room, RECORD_KEY)).alias("bit"))
    maps = bits.groupBy(room.alias("room"), F.floor(F.col("bit") / BITMAP).alias("bitmap"))
    maps = maps.agg(F.bitmap_construct_agg(F.col("bit") % BITMAP).alias("bits")).sortWithinPartitions("bitmap")
    maps.write.mode("overwrite").option("compression", "zstd").parquet(f"{base}/at={mine}")
    current = {f"at={_name(part)}" for part in partitions(spark, table)}
    for folder in folders(spark, base):
        if folder.rsplit("/", 1)[-1] not in current:
            delete_folder(spark, folder)


def may_hold(spark: SparkSession, table: str, source: DataFrame, parts: Sequence[dict]) -> list[dict] | None:
    """Those of the partitions that may hold a key of the source; None if it has too many keys to ask.

    What is asked for is at most ``MOST_KEYS`` keys, and of the sketches only the bitmaps that their bits fall into.
    """
    keys = source.select(RECORD_KEY).filter(F.col(RECORD_KEY).isNotNull()).distinct()
    asked = [row[0] for row in keys.limit(MOST_KEYS + 1).collect()]
    if len(asked) > MOST_KEYS:
        return None
    if not asked:
        return []
    base = _folder(spark, table)
    there = {folder.rsplit("=", 1)[-1]: folder for folder in folders(spark, base)}
    known = sorted({_name(part) for part in parts} & set(there))
    if not known:
        return list(parts)
    schema = "room long, bitmap long, bits binary, at string"
    sketches = spark.read.schema(schema).option("basePath", base).parquet(*[there[name] for name in known])
    rooms = sketches.select("room").distinct()
    bits = spark.createDataFrame([(bytes(k),) for k in asked], f"{RECORD_KEY} binary").crossJoin(F.broadcast(rooms))
    bits = bits.select(RECORD_KEY, "room", F.posexplode(_positions(F.col("room"), RECORD_KEY)).alias("which", "bit"))
    bits = bits.withColumn("bitmap", F.floor(F.col("bit") / BITMAP)).withColumn("bit", (F.col("bit") % BITMAP).cast("int"))
    wanted = [row[0] for row in bits.select("bitmap").distinct().limit(257).collect()]
    if len(wanted) <= 256:  # a filter that reaches the files
        sketches = sketches.filter(F.col("bitmap").isin(wanted))
    hits = sketches.join(F.broadcast(bits), ["room", "bitmap"]).filter(has_bit(F.col("bits"), F.col("bit")))
    found = hits.groupBy("at", RECORD_KEY).agg(F.count_distinct("which").alias("n")).filter("n = 2")
    held = {row[0] for row in found.select("at").distinct().collect()}
    return [part for part in parts if _name(part) in held or _name(part) not in there]
