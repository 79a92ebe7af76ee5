"""Which raw files have been read: found by path, size and time, and by their lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def listed_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``path``, ``length`` and ``modified`` of every raw file. Reads no content."""
    files = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths))
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def with_digest(spark: SparkSession, files: DataFrame) -> DataFrame:
    """The files with ``lines`` and ``digest``, which tell their content whatever their name and time.

    A digest is made of sums over the lines' hashes, so a file that splits is shared by many tasks. It does
    not see the order of lines.
    """
    paths = [row["path"] for row in files.select("path").collect()]
    if not paths:
        return files.withColumn("lines", F.lit(0).cast("long")).withColumn("digest", F.lit(""))
    text = spark.read.text(paths).select(F.col("_metadata.file_path").alias("uri"), "value")
    one, two = F.xxhash64("value"), F.xxhash64("value", F.lit(7))
    sums = text.groupBy("uri").agg(
        F.count("*").alias("lines"), F.sum(one.cast("decimal(38,0)")).alias("s"), F.bit_xor(two).alias("x")
    )
    sums = sums.select("uri", "lines", F.concat_ws("/", F.col("s").cast("string"), F.hex("x")).alias("digest"))
    # the listing's paths are plain, the reader's are urls
    plain = F.regexp_replace(F.url_decode(F.replace("uri", F.lit("+"), F.lit("%2B"))), "^([a-z0-9]+):/+", "$1:/")
    sums = sums.withColumn("bare", plain).drop("uri")
    bare = F.regexp_replace("path", "^([a-z0-9]+):/+", "$1:/")
    found = files.withColumn("bare", bare).join(sums, "bare", "left").drop("bare")
    return found.withColumns({
        "lines": F.coalesce("lines", F.lit(0).cast("long")), "digest": F.coalesce("digest", F.lit("empty")),
    })


def arrived(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """The listed files that the ledger does not have with this path, size and time."""
    return files.join(ledger.select("path", "length", "modified"), ["path", "length", "modified"], "left_anti")


def not_copies(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Of files with a digest, those whose lines no file of the ledger has; of equal ones the first by path."""
    first = files.groupBy("lines", "digest").agg(F.min("path").alias("path"))
    return first.join(ledger.select("lines", "digest"), ["lines", "digest"], "left_anti").select("path")
