"""What the operators share: words, hashes, and tables written between jobs."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What separates words, as a regular expression's character class.
GAP = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def shared_base(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, else the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base is None:
        base = spark.conf.get("spark.sql.warehouse.dir")
    return base.rstrip("/")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage: what comes after survives lost executors without running this part again,
    and a part that several jobs use runs once.
    """
    spark = df.sparkSession
    path = f"{shared_base(spark)}/oreflow-llm/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, whatever the number of uses inside lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words_of(text: Column) -> Column:
    """The text's words as an array; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{GAP}+"), "")


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) that depends on the parts alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(2**53))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scanned(
    rows: DataFrame,
    key: str,
    order: Sequence[str],
    element: Callable[[tuple], tuple],
    product: Callable[[tuple, tuple], tuple],
    given: Sequence[str],
    state: str,
) -> DataFrame:
    """Every row with the running product of its key's rows up to and with it, in order.

    ``element`` turns a row's ``given`` values into an element of a monoid, ``product`` multiplies two, and ``state``
    names and types their parts as columns. The key must not be null; rows that are equal in key and order
    stand in any order.

    Rows are dealt out in ranges of key and order, so a key that has most of all rows is shared by many tasks.
    Each task multiplies its own rows. What the first key of a range had in earlier ranges is a carry,
    one for each range, made on the driver and multiplied in by a second pass that shuffles nothing.
    """
    row, part, at = (fresh(rows, name) for name in ("scan_row", "scan_part", "scan_at"))
    made = T.StructType.fromDDL(state)
    names, kinds = made.fieldNames(), [_ARROW[f.dataType.typeName()] for f in made.fields]
    by = [key, *order, row]
    ranged = rows.withColumn(row, F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    ranged = ranged.drop(row).withColumn(part, F.spark_partition_id())

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, now, n = None, None, 0
        for batch in batches:
            out = []
            values = zip(batch.column(key).to_pylist(), *[batch.column(c).to_pylist() for c in given], strict=True)
            for k, *value in values:
                own = element(tuple(value))
                now, last = (own if k != last or now is None else product(now, own)), k
                out.append(now)
            columns = [pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)] if out else [
                pa.array([], kind) for kind in kinds
            ]
            where = pa.array(range(n, n + len(out)), pa.int64())
            n += len(out)
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns, where], [*batch.schema.names, *names, at])

    schema = T.StructType([*ranged.schema.fields, *made.fields, T.StructField(at, T.LongType())])
    local = written(ranged.mapInArrow(multiply, schema), "scan")
    ends = local.groupBy(part).agg(
        F.min_by(key, at).alias("first"), F.max_by(F.struct(key, *names), at).alias("last")
    )
    carries, before = {}, None
    for here in sorted(ends.collect(), key=lambda r: r[part]):
        end, total = here["last"][0], tuple(here["last"][1:])
        if before is not None and before[0] == here["first"]:
            carries[here[part]] = before
            if end == before[0]:
                total = product(before[1], total)
        before = (end, total)

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column(part).to_pylist()
            if any(p in carries for p in set(parts)):
                mine = zip(parts, batch.column(key).to_pylist(), *[batch.column(c).to_pylist() for c in names], strict=True)
                out = []
                for p, k, *value in mine:
                    first, earlier = carries.get(p, (None, None))
                    out.append(product(earlier, tuple(value)) if earlier is not None and first == k else value)
                for name, kind, column in zip(names, kinds, zip(*out, strict=True), strict=True):
                    batch = batch.set_column(batch.schema.names.index(name), name, pa.array(column, kind))
            yield batch

    done = local.mapInArrow(carry, schema) if carries else local
    return done.drop(part, at)


_ARROW = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "double": pa.float64()}
