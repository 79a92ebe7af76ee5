"""Files and folders in whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def read_start(spark: SparkSession, path: str, n: int) -> bytes:
    """At most the first ``n`` bytes of a file's content: of one whose name says that it is compressed, unpacked."""
    system, place = _opened(spark, path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    codec = hadoop.io.compress.CompressionCodecFactory(system.getConf()).getCodec(place)
    stream = system.open(place)
    if codec is not None:
        stream = codec.createInputStream(stream)
    try:
        return bytes(stream.readNBytes(n))
    finally:
        stream.close()


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it; no error if it is not there."""
    system, place = _opened(spark, path)
    system.delete(place, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """The folders right in a folder; none if it is not there."""
    system, place = _opened(spark, path)
    if not system.exists(place):
        return []
    return [str(item.getPath().toString()) for item in system.listStatus(place) if item.isDirectory()]


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; none if it is not there."""
    system, place = _opened(spark, path)
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Make a small file. Its text is written under another name first, so that it is never there in part."""
    system, place = _opened(spark, f"{path}.tmp")
    stream = system.create(place, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    system.rename(place, _opened(spark, path)[1])
