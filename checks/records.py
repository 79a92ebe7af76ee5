"""Nested records built from the given tables, in Spark and in SQL.

One record per order, every 50th twice, with the order's parts as an array: values that are null,
blank, padded, negative or malformed are spread through it, so every rule and edge has its rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.operators import stamp
from oreflow.schemas import RECORD_FIELDS, bronze_of, struct
from oreflow.settings import shared_folder
from oreflow.sources import read_location

FLOOR = 100_000  # of the small record; the movie record's budget is ten times larger
PER_FILE = 5_000  # records per raw file: a multi-line document is held in memory as a whole

ITEM = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
REC = struct(
    id=T.LongType(),
    budget=T.DoubleType(),
    runtime=T.DoubleType(),
    created=T.StringType(),
    lang=T.StringType(),
    items=T.ArrayType(ITEM),
)
REC_FIELDS = REC.fieldNames()

# The same records for the SQL side. `created` is a timestamp here and ISO text in Spark.
REC_SQL = """it as (
  select l_orderkey k,
         list_sort(list({'id': l_partkey, 'name':
           case when p_partkey % 11 = 0 then '   ' when p_partkey % 13 = 0 then null
                else concat(' ', p_name, '  ') end})) items
  from lineitem join part on p_partkey = l_partkey group by l_orderkey),
one as (
  select o_orderkey id,
         case when o_orderkey % 97 = 0 then null else o_totalprice end budget,
         c_acctbal runtime, o_orderdate created, o_orderstatus lang, it.items,
         o_orderpriority priority, c_name customer, c_mktsegment segment
  from orders join customer on c_custkey = o_custkey left join it on it.k = o_orderkey),
rec as (select * from one union all select * from one where id % 50 = 0)"""

# The movie record's columns after flattening; URL and text fields are built from the keys.
MOVIE_SQL = """movie as (
  select concat('backdrop/', id) "BackdropUrl", budget * 10 "Budget", cast(null as varchar) "CreatedBy",
         cast(created as date) "CreatedDate", id "Id", concat('imdb/', id) "ImdbUrl",
         lang "OriginalLanguage", priority "Overview", concat('poster/', id) "PosterUrl",
         budget / 8 "Price", strftime(created, '%Y-%m-%d') "ReleaseDate", runtime "Revenue",
         cast(trunc(runtime) as bigint) "RunTime", segment "Tagline", customer "Title",
         concat('tmdb/', id) "TmdbUrl", cast(null as varchar) "UpdatedBy",
         case when id % 89 = 0 then null when id % 7 = 0 then null
              else cast(date_trunc('month', created) as date) end "UpdatedDate",
         items genres
  from rec)"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records' columns, dealt out by key, ``PER_FILE`` records to a partition.

    Orders and their parts meet in that many partitions, with short rows; arrays and texts are made behind the
    shuffle, of some thousand records at a time. So nothing wide is shuffled, and nothing is large enough to spill.
    """
    part, lineitem = _table(spark, sf_dir, "part"), _table(spark, sf_dir, "lineitem")
    orders, customer = _table(spark, sf_dir, "orders"), _table(spark, sf_dir, "customer")
    n = file_count(spark, sf_dir)
    name = (
        F.when(F.col("l_partkey") % 11 == 0, "   ")
        .when(F.col("l_partkey") % 13 == 0, None)
        .otherwise(F.concat(F.lit(" "), "p_name", F.lit("  ")))
    )
    item = F.struct(F.col("l_partkey").alias("id"), name.alias("name"))
    # an order's parts become one array, as a raw document holds them
    items = (
        lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select("l_orderkey", "l_partkey", "p_name")
        .repartition(n, "l_orderkey")
        .groupBy("l_orderkey")
        .agg(F.array_sort(F.collect_list(item)).alias("items"))
    )
    bought = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus", "o_orderpriority",
        "c_acctbal", "c_mktsegment", "c_name",
    )
    copies = F.when(F.col("id") % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        bought.repartition(n, "o_orderkey")
        .join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .withColumn("id", F.col("o_orderkey"))
        .withColumn("budget", F.when(F.col("id") % 97 != 0, F.col("o_totalprice")))
        .withColumn("created", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'0000'"))
        .withColumn("copy", F.explode(copies))
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One struct column ``rec`` per record."""
    cols = {
        "id": F.col("id"),
        "budget": F.col("budget"),
        "runtime": F.col("c_acctbal"),
        "created": F.col("created"),
        "lang": F.col("o_orderstatus"),
        "items": F.col("items"),
    }
    return _base(spark, sf_dir).select(F.struct(*[c.alias(n) for n, c in cols.items()]).alias("rec"))


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One struct column ``movie`` per record, with every raw field."""
    text = F.lit(None).cast("string")
    month = F.date_format(F.trunc("o_orderdate", "month"), "yyyy-MM-dd'T'HH:mm:ss")
    updated = F.when(F.col("id") % 89 == 0, "not a date").when(F.col("id") % 7 != 0, month)
    cols = {
        "BackdropUrl": F.concat(F.lit("backdrop/"), "id"),
        "Budget": F.col("budget") * 10,
        "CreatedBy": text,
        "CreatedDate": F.col("created"),
        "Id": F.col("id"),
        "ImdbUrl": F.concat(F.lit("imdb/"), "id"),
        "OriginalLanguage": F.col("o_orderstatus"),
        "Overview": F.col("o_orderpriority"),
        "PosterUrl": F.concat(F.lit("poster/"), "id"),
        "Price": F.col("budget") / 8,
        "ReleaseDate": F.substring("created", 1, 10),
        "Revenue": F.col("c_acctbal"),
        "RunTime": F.col("c_acctbal").cast("bigint"),
        "Tagline": F.col("c_mktsegment"),
        "Title": F.col("c_name"),
        "TmdbUrl": F.concat(F.lit("tmdb/"), "id"),
        "UpdatedBy": text,
        "UpdatedDate": updated,
        "genres": F.col("items"),
    }
    fields = [cols[name].cast(kind).alias(name) for name, kind in RECORD_FIELDS.items()]
    return _base(spark, sf_dir).select(F.struct(*fields).alias("movie"))


def write_documents(
    df: DataFrame, payload: str, path: str, files: int | None = None, compression: str = "none"
) -> None:
    """Write the records as that many multi-line JSON files, each holding one array; without a number, one file for
    each partition."""

    # nested, so that it travels to the executors by value: they need not have this package
    def enclose(batches):
        lead = f'{{"{payload}": [\n'
        for batch in batches:
            lines = []
            for text in batch.column(0).to_pylist():
                lines.append(lead + text)
                lead = ",\n"
            yield pa.RecordBatch.from_pydict({"value": lines})
        yield pa.RecordBatch.from_pydict({"value": ["]}" if lead[0] == "," else lead + "]}"]})

    text = F.to_json(payload, {"pretty": "true"}).alias("value")
    if files is not None:
        df = df.repartition(files, F.col(f"{payload}.{df.schema[payload].dataType.names[0]}"))
    df.select(text).mapInArrow(enclose, "value string").write.text(path, compression=compression)


def file_count(spark: SparkSession, sf_dir: str) -> int:
    """Grows with the data, so that no file outgrows a task."""
    return max(8, _table(spark, sf_dir, "orders").count() // PER_FILE)


_written: dict[tuple, str] = {}


def written(spark: SparkSession, key: str, sf_dir: str, write) -> str:
    """Run ``write(folder)`` once per session and data folder; later calls get the same folder."""
    at = (spark.sparkContext.applicationId, key, sf_dir)
    if at not in _written:
        folder = shared_folder(spark, key)
        write(folder)
        _written[at] = folder
    return _written[at]


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The small records as a stored bronze table's files, so that operators read Parquet."""

    def write(folder):
        stamp(records(spark, sf_dir), "rec", "orders").write.parquet(folder, compression="zstd")

    return read_location(spark, written(spark, "bronze", sf_dir, write), bronze_of("rec", REC))


def documents(spark: SparkSession, sf_dir: str, payload: str) -> str:
    """Folder of raw multi-line JSON files, compressed, holding the records under ``payload``."""
    build = {"rec": records, "movie": movies}[payload]

    def write(folder):
        write_documents(build(spark, sf_dir), payload, folder, compression="gzip")

    return written(spark, f"raw-{payload}", sf_dir, write)


RAW_REC = T.StructType([T.StructField("rec", T.ArrayType(REC))])
