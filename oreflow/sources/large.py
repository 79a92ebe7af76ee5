"""Multi-line JSON documents too large for one task, split at their records by many.

A document is an object whose one array field holds the records. Its text is read in pieces that end at a closing
brace, in as many blocks as the file has, and each block is walked through in order by one task. Whether a block
begins within a string and how deep it is nested are sums over the blocks before, for which documents of more than
one block are read a first time. So no task holds more than a block, no text is shuffled but that of records that
reach over the end of a block, and only a row or two for each block are ordered as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oreflow.functions.files import delete_folder

BLOCK = ["uri", "start"]
SUMS = "uri string, start long, quotes long, outside long, within long"
# ``kind``: a ``record`` that lies within a block, a ``part`` of one at the begin (0) or end (1) of a block, or
# ``other``, an object beside the records. ``ends`` and ``other`` are what a part's last brace would end.
PARTS = "uri string, start long, kind string, place int, ends boolean, other boolean, value binary"


def _walks():
    """The walk that sums a block up and the one that gives its records, over pieces of any number of blocks.

    Both are nested, so that they travel to the executors by value: they need not have this package.
    """

    def blocks(batches):
        """The batches cut at the blocks: which block, whether it begins, its pieces."""
        import numpy as np
        import pyarrow.compute as pc

        here = None
        for batch in batches:
            uri, start, n = batch.column("uri"), batch.column("start"), batch.num_rows
            if n == 0:
                continue
            other = pc.or_(pc.not_equal(uri[1:], uri[:-1]), pc.not_equal(start[1:], start[:-1]))
            cuts = [0, *(np.flatnonzero(other.to_numpy(zero_copy_only=False)) + 1).tolist(), n]
            for a, b in zip(cuts, cuts[1:]):
                at = (uri[a].as_py(), start[a].as_py())
                yield at, at != here, batch.slice(a, b - a)
                here = at

    def nesting(values, odd):
        """For each piece: its quotes, by how much it nests with its brace, the same had it begun on the other side
        of a quote, and whether its brace stands outside strings. ``odd``: the first one begins in a string."""
        import numpy as np
        import pyarrow as pa

        kind = np.int64 if pa.types.is_large_binary(values.type) else np.int32
        ends = np.frombuffer(values.buffers()[1], kind)[values.offset : values.offset + len(values) + 1].astype(np.int64)
        text = np.zeros(0, np.uint8) if ends[0] == ends[-1] else np.frombuffer(values.buffers()[2], np.uint8)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        quote, step = text == 34, ((text == 123) | (text == 91)).astype(np.int8) - (text == 93)
        slash = text == 92
        if slash.any():  # what follows an odd number of them is escaped; no escape reaches over a brace
            at = np.arange(len(text))
            first = np.repeat(ends[:-1], np.diff(ends))
            plain = np.maximum.accumulate(np.where(slash, -1, at))
            escaped = (at - np.maximum(np.append(-1, plain[:-1]), first - 1)) % 2 == 0
            quote, step = quote & ~escaped, np.where(escaped, 0, step)

        def totals(numbers):
            sums = np.append(0, np.cumsum(numbers, dtype=np.int64))
            return sums[ends[1:]] - sums[ends[:-1]]

        string = (np.cumsum(quote, dtype=np.int64) + odd) % 2 == 1
        quotes, every, here = totals(quote), totals(step), totals(np.where(string, 0, step))
        free = (np.cumsum(quotes) + odd) % 2 == 0
        return quotes, here - free, every - here - ~free, free

    def sums(batches):
        import pyarrow as pa

        def row(at, found):
            return pa.RecordBatch.from_pydict({
                "uri": [at[0]], "start": [at[1]], "quotes": [found[0]], "outside": [found[1]], "within": [found[2]],
            })

        here, found = None, [0, 0, 0]
        for at, begins, batch in blocks(batches):
            if begins:
                if here is not None:
                    yield row(here, found)
                here, found = at, [0, 0, 0]
            quotes, outside, within, _ = nesting(batch.column("value"), found[0] % 2)
            found = [n + int(more.sum()) for n, more in zip(found, (quotes, outside, within))]
        if here is not None:
            yield row(here, found)

    def records(batches):
        import numpy as np
        import pyarrow as pa

        schema = pa.schema([
            ("uri", pa.string()), ("start", pa.int64()), ("kind", pa.string()), ("place", pa.int32()),
            ("ends", pa.bool_()), ("other", pa.bool_()), ("value", pa.binary()),
        ])

        def rows(at, made):
            columns = [[at[0]] * len(made), [at[1]] * len(made), *map(list, zip(*made))]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        # the pieces since the last record, and what their last brace ends: of a document's last piece it is no brace
        here, left, ends, other = None, [], False, False
        odd = depth = 0
        for at, begins, batch in blocks(batches):
            if begins:
                if here is not None:
                    yield rows(here, [("part", 1, ends, other, b"}".join(left) + b"}")])
                here, left, ends, other, headed = at, [], False, False, False
                odd, depth = batch.column("odd")[0].as_py(), batch.column("depth")[0].as_py()
            values = batch.column("value")
            quotes, change, _, free = nesting(values, odd)
            depths = depth + np.cumsum(change)
            odd, depth = (odd + int(quotes.sum())) % 2, int(depths[-1])
            stops, beside, made, a = free & (depths == 2), free & (depths == 1), [], 0
            pieces = values.to_pylist()
            if other or beside[:-1].any():
                made.append(("other", 0, False, True, None))
            # a record that ended with the pieces before, then those that end here but for the last piece
            for b in [0] * ends + (np.flatnonzero(stops[:-1]) + 1).tolist():
                left.extend(pieces[a:b])
                made.append(("record" if headed else "part", 0, True, False, b"}".join(left) + b"}"))
                left, a, headed = [], b, True
            left.extend(pieces[a:])
            ends, other = bool(stops[-1]), bool(beside[-1])
            if made:
                yield rows(here, made)
        if here is not None:
            yield rows(here, [("part", 1, ends, other, b"}".join(left) + b"}")])

    return sums, records


@contextmanager
def _same_blocks(spark: SparkSession):
    """Files are cut into the same blocks by all reads within, also if executors come or go meanwhile."""
    option = "spark.sql.files.minPartitionNum"
    was = spark.conf.get(option, None)
    if was is None:
        spark.conf.set(option, str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(option)


def _pieces(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The pieces in their order, and whether their document has several blocks."""
    text = spark.read.option("lineSep", "}").text(paths if isinstance(paths, str) else list(paths))
    return text.select(
        F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_block_start").alias("start"),
        (F.col("_metadata.file_block_length") < F.col("_metadata.file_size")).alias("several"),
        F.col("value").cast("binary").alias("value"),
    )


def document_records(spark: SparkSession, paths: str | Sequence[str], array_col: str, folder: str) -> DataFrame:
    """``uri`` of the document and ``value``, the text of one record, for every record of the documents.

    The records' text is written to ``folder``, of records that reach over blocks in parts. Records
    keep their text, but for line ends between their parts. What is not a record is left out: the braces
    around, other fields of the document as long as they are no objects. Documents with such are refused, as
    their parts could not be told from records. A text that breaks off gives the records that end before.
    """
    sums, records = _walks()
    pieces = _pieces(spark, paths)
    blocks = pieces.filter("several").select(*BLOCK, "value").mapInArrow(sums, SUMS)
    earlier = Window.partitionBy("uri").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("odd", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    change = F.when(F.col("odd") == 1, F.col("within")).otherwise(F.col("outside"))
    blocks = blocks.withColumn("change", change).withColumn("depth", F.coalesce(F.sum("change").over(earlier), F.lit(0)))
    unknown = F.raise_error(F.lit("the blocks of a document have changed while it was read")).cast("long")
    begins = [F.coalesce(c, F.when(F.col("several"), unknown).otherwise(0)).alias(c) for c in ("odd", "depth")]
    pieces = pieces.join(F.broadcast(blocks.select(*BLOCK, "odd", "depth")), BLOCK, "left")
    with _same_blocks(spark):
        made = pieces.select(*BLOCK, *begins, "value").mapInArrow(records, PARTS)
        made.write.mode("overwrite").option("compression", "zstd").parquet(folder)
    made = spark.read.schema(PARTS).parquet(folder).withColumn("value", F.col("value").cast("string"))
    # the last piece of a document ends without a brace, or with the document's own
    final = (F.col("start") == F.max("start").over(Window.partitionBy("uri"))) & (F.col("place") == 1)
    parts = made.filter("kind = 'part'").withColumn("ends", F.col("ends") & ~final)
    beside = made.filter("kind = 'other'").select("uri").unionByName(
        made.filter("kind = 'part'").withColumn("final", final).filter("other AND NOT final").select("uri")
    )
    if not beside.isEmpty():
        raise ValueError(f"a document has other objects beside {array_col!r}")
    before = Window.partitionBy("uri").orderBy("start", "place").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("record", F.coalesce(F.sum(F.col("ends").cast("int")).over(before), F.lit(0)))
    parts = parts.groupBy("uri", "record").agg(
        F.array_sort(F.collect_list(F.struct("start", "place", "value"))).alias("parts"), F.max("ends").alias("whole")
    )
    joined = F.array_join("parts.value", "")
    first = F.regexp_extract(joined, rf'(?s)^\s*\{{.*?"{array_col}"\s*:\s*\[\s*(\{{.*)$', 1)

    def own(text):
        return F.regexp_replace(text, r"(?s)^[\s,]+", "")

    value = F.when((F.col("record") == 0) & (first != ""), first).otherwise(own(joined))
    within = made.filter("kind = 'record'").select("uri", own(F.col("value")).alias("value"))
    every = within.unionByName(parts.filter("whole").select("uri", value.alias("value")))
    return every.select("uri", F.regexp_replace("value", r"[\r\n]+", " ").alias("value"))


def split_documents(spark: SparkSession, paths: str | Sequence[str], array_col: str, folder: str) -> str:
    """Write the documents' records as JSON Lines, each a document of one record, and return the folder."""
    pieces = f"{folder}-pieces"
    records = document_records(spark, paths, array_col, pieces)
    line = F.concat(F.lit(f'{{"{array_col}": ['), "value", F.lit("]}"))
    records.select(line.alias("value")).write.mode("overwrite").text(folder, compression="gzip")
    delete_folder(spark, pieces)
    return folder
