"""Raw JSON files."""

from __future__ import annotations

import codecs
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.functions.extras import merged
from oreflow.functions.files import read_start
from oreflow.schemas import CORRUPT, SOURCE_FILE


def read_json_batch(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | None = None,
    multiline: bool = True,
    modified_after: str | None = None,
) -> DataFrame:
    """Read a folder, or a list of paths, of JSON documents; of them, the files changed after a time.

    With a schema the files are read once; without one Spark makes an extra pass to infer it. A
    multi-line document cannot be split, so each file is one task: keep files moderate, or write
    JSON Lines and pass ``multiline=False``, which Spark splits freely.
    """
    reader = spark.read.option("multiLine", multiline).option("columnNameOfCorruptRecord", CORRUPT)
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after)
    if schema is not None:
        if CORRUPT not in schema.fieldNames():
            schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.schema(schema)
    if not isinstance(paths, str) and not list(paths):  # no files, no rows
        empty = spark.createDataFrame([], schema or T.StructType([T.StructField(CORRUPT, T.StringType())]))
        return empty.withColumn(SOURCE_FILE, F.lit(None).cast("string"))
    paths = paths if isinstance(paths, str) else list(paths)
    return reader.json(paths).select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))


def with_extra_fields(
    spark: SparkSession,
    paths: str | Sequence[str],
    array_col: str,
    listed: T.StructType,
    multiline: bool = True,
    modified_after: str | None = None,
) -> T.StructType:
    """The listed record type with the fields that records in the files have beyond it, at any depth.

    One pass over the files, as for any inferred schema. Names that differ by case alone are refused, as
    Spark could not tell them apart.
    """
    try:
        found = read_json_batch(spark, paths, None, multiline, modified_after).schema
    except AnalysisException as nothing:
        if nothing.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return listed
    kind = next((f.dataType for f in found.fields if f.name == array_col), None)
    if not isinstance(kind, T.ArrayType) or not isinstance(kind.elementType, T.StructType):
        return listed
    return merged(listed, kind.elementType)


def is_rejected(array_col: str) -> Column:
    """A document of which nothing, or not everything, could be read.

    The size test is always true. It is there because Spark refuses a query over raw files that
    needs no column but the corrupt one, such as a count of the rejects.
    """
    return F.col(CORRUPT).isNotNull() & (F.coalesce(F.array_size(array_col), F.lit(0)) >= 0)


def split_rejects(raw: DataFrame, array_col: str) -> tuple[DataFrame, DataFrame]:
    """Documents with records, and a report of the documents that were not read in full.

    ``unparsed`` documents gave no records. ``partial`` ones hold a value of the wrong type: their
    records are all kept, with that value null, so they appear on both sides.
    """
    if CORRUPT not in raw.columns:  # an inferred schema has the column only after a bad document
        raw = raw.withColumn(CORRUPT, F.lit(None).cast("string"))
    reason = F.when(F.col(array_col).isNull(), "unparsed").otherwise("partial")
    rejects = raw.filter(is_rejected(array_col)).select(
        SOURCE_FILE, reason.alias("reason"), F.col(CORRUPT).alias("record")
    )
    return raw.filter(F.col(array_col).isNotNull()), rejects


def raw_files(spark: SparkSession, path: str) -> DataFrame:
    """Every raw file with its size and time. Reads no content."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "length", "modificationTime")


def peek_raw(spark: SparkSession, path: str, n: int = 65536) -> DataFrame:
    """The first ``n`` characters of the first raw file, of which no more than that is read."""
    first = raw_files(spark, path).agg(F.min("path")).first()[0]
    if first is None:
        raise FileNotFoundError(f"no files under {path}")
    text = codecs.getincrementaldecoder("utf-8")("replace").decode(read_start(spark, first, 4 * n))
    return spark.range(1).select(F.lit(text[:n]).alias("value"))
