"""One query per operator of the library, each with the SQL that must give the same rows.

Every query reads the given tables, or files written from them. Time columns are left out, because
they differ from run to run.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import records as R
from oreflow.functions import as_int, record_key
from oreflow.functions.files import write_text
from oreflow.operators import (
    budget_only,
    code_dimension,
    dimension,
    entity,
    explode_nested,
    explode_records,
    flatten,
    junction,
    merge_status,
    profile,
    repair,
    route,
    split,
    stamp,
    strict,
    verdict,
)
from oreflow.operators.marts import named_items
from oreflow.plans import (
    bronze_to_silver,
    build_marts,
    raw_to_bronze,
    rebuild_silver,
    repair_quarantined,
    update_marts,
    update_status,
)
from oreflow.schemas import BRONZE_PARTS, INGEST_DATE, RAW, RECORD_FIELDS, RECORD_KEY, SILVER, SILVER_PARTS, bronze_of, struct
from oreflow.settings import Settings, shared_folder
from oreflow.sinks import append_rows, batch_writer, register, write_snapshot
from oreflow.sources import peek_raw, raw_files, read_json_batch, read_location, read_status, split_rejects, table_at
from oreflow.sources.tables import location_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(sql: str):
    """Register a query under its function's name, with its SQL."""

    def add(build):
        QUERIES[build.__name__] = build
        ORACLES[build.__name__] = sql
        return build

    return add


def rec(body: str) -> str:
    return f"with {R.REC_SQL}\n{body}"


def movie(body: str) -> str:
    return f"with {R.REC_SQL},\n{R.MOVIE_SQL}\n{body}"


# The routes as SQL, for the small and for the movie record.
STRICT, BUDGET = "runtime >= 0 and budget >= 100000", "budget >= 100000"
MOVIE_STRICT = '"RunTime" >= 0 and "Budget" >= 1000000'


def flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(R.bronze(spark, sf_dir), "rec", R.REC_FIELDS, ["created"], keep=["rec", RECORD_KEY])


def rules(spark: SparkSession):
    return strict(R.FLOOR, "budget", "runtime")


def budget_rule(spark: SparkSession):
    return budget_only(R.FLOOR, "budget")


def quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split(flat(spark, sf_dir), rules(spark), "keep")[1]


def clean_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split(flat(spark, sf_dir), budget_rule(spark))[0]


SCALARS = ["id", "budget", "runtime", "created", "lang"]
SCALARS_SQL = "id, budget, runtime, cast(created as date) created, lang"


# ---- raw files -------------------------------------------------------------------------------


@check(rec(f"select {SCALARS_SQL}, cast(len(items) as bigint) n_items from rec"))
def json_envelope_roundtrip(spark, sf_dir):
    raw = read_json_batch(spark, R.documents(spark, sf_dir, "rec"), R.RAW_REC)
    rows = explode_records(raw, "rec", "rec")
    return flatten(rows, "rec", R.REC_FIELDS, ["created"]).select(
        *SCALARS, F.array_size("items").cast("bigint").alias("n_items")
    )


@check(rec(f"select {SCALARS_SQL} from rec"))
def json_inferred_schema(spark, sf_dir):
    raw = read_json_batch(spark, R.documents(spark, sf_dir, "rec"))
    return flatten(explode_records(raw, "rec", "rec"), "rec", SCALARS, ["created"])


@check(rec(f"select {SCALARS_SQL} from rec"))
def json_lines_roundtrip(spark, sf_dir):
    def write(folder):
        rows = R.records(spark, sf_dir).select(F.array("rec").alias("rec"))
        rows.write.json(folder, compression="gzip")

    folder = R.written(spark, "json-lines", sf_dir, write)
    raw = read_json_batch(spark, folder, R.RAW_REC, multiline=False)
    return flatten(explode_records(raw, "rec", "rec"), "rec", SCALARS, ["created"])


@check(rec("select count(*) n_records, cast(0 as bigint) n_rejects, cast(0 as bigint) n_unlisted from rec"))
def raw_file_provenance(spark, sf_dir):
    """Records per file, checked against the file listing and the rejects."""
    folder = R.documents(spark, sf_dir, "movie")
    raw, rejects = split_rejects(read_json_batch(spark, folder, RAW), "movie")
    read = raw.groupBy("source_file").agg(F.sum(F.array_size("movie").cast("bigint")).alias("n"))
    listed = raw_files(spark, folder).select(F.regexp_replace("path", "^file:/+", "/").alias("path"))
    read = read.withColumn("path", F.regexp_replace("source_file", "^file:/+", "/"))
    seen = read.join(listed.withColumn("listed", F.lit(1)), "path", "left")
    facts = seen.select("n", F.lit(0).alias("reject"), F.col("listed").isNull().cast("int").alias("unlisted"))
    facts = facts.union(rejects.select(F.lit(0), F.lit(1), F.lit(0)))
    totals = {"n": "n_records", "reject": "n_rejects", "unlisted": "n_unlisted"}
    return facts.agg(*[F.sum(c).alias(name) for c, name in totals.items()])


def broken_lines(spark, sf_dir) -> str:
    """JSON Lines in which every F record is cut off in the middle and every P budget is a word."""

    def write(folder):
        text = F.to_json(F.struct(F.array("rec").alias("rec")))
        line = (
            F.when(F.col("rec.lang") == "F", F.expr("left(text, cast(length(text) / 2 as int))"))
            .when(F.col("rec.lang") == "P", F.regexp_replace("text", '"budget":[0-9.E]+', '"budget":"unknown"'))
            .otherwise(F.col("text"))
        )
        lines = R.records(spark, sf_dir).withColumn("text", text).select(line.alias("value"))
        lines.write.text(folder, compression="gzip")

    return R.written(spark, "broken-lines", sf_dir, write)


@check(
    rec(
        """select case when lang = 'F' then 'unparsed' else 'partial' end reason, count(*) n
from rec where lang = 'F' or (lang = 'P' and budget is not null) group by 1"""
    )
)
def reject_report(spark, sf_dir):
    raw = read_json_batch(spark, broken_lines(spark, sf_dir), R.RAW_REC, multiline=False)
    return split_rejects(raw, "rec")[1].groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@check(
    rec(
        """select id, case when lang <> 'P' then budget end budget, runtime, lang, cast(len(items) as bigint) n_items
from rec where lang <> 'F'"""
    )
)
def records_of_broken_files(spark, sf_dir):
    raw = read_json_batch(spark, broken_lines(spark, sf_dir), R.RAW_REC, multiline=False)
    rows = explode_records(split_rejects(raw, "rec")[0], "rec", "rec").select("rec.*")
    return rows.select("id", "budget", "runtime", "lang", F.array_size("items").cast("bigint").alias("n_items"))


@check(rec("select id, 'orders' datasource, 'new' status, date '2024-05-06' p_ingestdate from rec"))
def stamp_bronze(spark, sf_dir):
    stamped = stamp(R.records(spark, sf_dir), "rec", "orders", dt.datetime(2024, 5, 6, 7, 8, 9))
    return stamped.select("rec.id", "datasource", "status", INGEST_DATE)


# ---- flatten and nested columns --------------------------------------------------------------


@check(rec(f"select {SCALARS_SQL} from rec"))
def flatten_records(spark, sf_dir):
    return flat(spark, sf_dir).select(*SCALARS)


@check(rec("select id, budget, runtime, lang from rec"))
def payload_star(spark, sf_dir):
    return R.bronze(spark, sf_dir).select("rec.*").drop("items", "created")


@check(
    movie(
        """select "BackdropUrl", "Budget", "CreatedDate", "Id", "ImdbUrl", "OriginalLanguage", "Overview",
  "PosterUrl", "Price", "ReleaseDate", "Revenue", "RunTime", "Tagline", "Title", "TmdbUrl", "UpdatedDate",
  cast(len(genres) as bigint) n_genres from movie"""
    )
)
def flatten_movies(spark, sf_dir):
    raw = read_json_batch(spark, R.documents(spark, sf_dir, "movie"), RAW)
    rows = flatten(
        explode_records(raw, "movie", "movie"), "movie", list(RECORD_FIELDS), ["CreatedDate", "UpdatedDate"]
    )
    return movie_scalars(rows)


def movie_scalars(rows: DataFrame) -> DataFrame:
    """A movie table's columns without the two that are always null, and genres as a count."""
    n_genres = F.array_size("genres").cast("bigint").alias("n_genres")
    cols = [c for c in RECORD_FIELDS if c not in ("CreatedBy", "UpdatedBy", "genres")]
    return rows.select(*cols, n_genres)


@check(rec("select u.i.id item_id, u.i.name item_name from rec, unnest(items) u(i)"))
def nested_path_explode(spark, sf_dir):
    items = explode_nested(R.bronze(spark, sf_dir), "rec.items", ["id", "name"])
    return items.toDF("item_id", "item_name")


@check(rec("select id, lang, u.i.id item_id from rec, unnest(items) u(i)"))
def explode_with_parent(spark, sf_dir):
    rows = explode_nested(flat(spark, sf_dir), "items", keep=["id", "lang"])
    return rows.select("id", "lang", F.col("item.id").alias("item_id"))


@check(
    rec(
        """select id, cast(len(items) as bigint) n_ids, cast(list_sum(list_transform(items, lambda x: x.id)) as bigint) sum_ids
from rec where items is not null"""
    )
)
def array_field(spark, sf_dir):
    rows = flat(spark, sf_dir).filter("items is not null").select("id", F.col("items.id").alias("ids"))
    total = F.aggregate("ids", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return rows.select("id", F.array_size("ids").cast("bigint").alias("n_ids"), total.alias("sum_ids"))


# ---- filters and routes ----------------------------------------------------------------------


@check(rec(f"select {SCALARS_SQL} from rec where {BUDGET}"))
def clean_budget_only(spark, sf_dir):
    return clean_side(spark, sf_dir).select(*SCALARS)


@check(rec(f"select {SCALARS_SQL} from rec where budget < 100000"))
def quarantine_budget_only(spark, sf_dir):
    return split(flat(spark, sf_dir), budget_rule(spark), "keep")[1].select(*SCALARS)


@check(rec(f"select {SCALARS_SQL} from rec where {STRICT}"))
def clean_strict(spark, sf_dir):
    return split(flat(spark, sf_dir), rules(spark))[0].select(*SCALARS)


@check(rec(f"select {SCALARS_SQL} from rec where budget < 100000 or runtime < 0"))
def quarantine_strict(spark, sf_dir):
    return quarantined(spark, sf_dir).select(*SCALARS)


@check(rec(f"select {SCALARS_SQL} from rec where ({STRICT}) is not true"))
def quarantine_with_unrouted(spark, sf_dir):
    return split(flat(spark, sf_dir), rules(spark))[1].select(*SCALARS)


@check(rec(f"select {SCALARS_SQL} from rec where ({STRICT}) is null"))
def unrouted(spark, sf_dir):
    return route(flat(spark, sf_dir), rules(spark), "keep").filter("route = 'unrouted'").select(*SCALARS)


@check(
    rec(
        f"""select case when {STRICT} then 'clean' when ({STRICT}) is null then 'unrouted' else 'quarantine' end route,
  count(*) n, sum(case when runtime < 0 then 1 else 0 end)::bigint n_negative from rec group by 1"""
    )
)
def route_counts(spark, sf_dir):
    routed = route(flat(spark, sf_dir), rules(spark), "keep")
    return routed.groupBy("route").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("runtime") < 0).alias("n_negative")
    )


@check(
    rec(
        f"""select count(*) n, count(*) filter (where {STRICT}) clean,
  count(*) filter (where not ({STRICT})) quarantine, count(*) filter (where ({STRICT}) is null) unrouted,
  count(*) filter (where runtime < 0) broken_runtime, count(*) filter (where budget < 100000) broken_budget,
  count(*) n_with_values from rec"""
    )
)
def profile_counts(spark, sf_dir):
    one = profile(flat(spark, sf_dir).select("rec", *SCALARS), rules(spark))
    renamed = {"broken_runtime_not_negative": "broken_runtime", "broken_budget_at_floor": "broken_budget"}
    return one.withColumnsRenamed(renamed)


@check(
    rec(
        """select count(*) n, count(budget) n_budget,
  count(*) filter (where budget is null and items is null) n_empty from rec"""
    )
)
def drop_all_null(spark, sf_dir):
    rows = flat(spark, sf_dir).select("budget", "items")
    facts = rows.select(F.lit(1).alias("n"), F.col("budget").isNotNull().cast("int").alias("b"))
    facts = facts.withColumn("gone", F.lit(1)).union(rows.dropna("all").select(F.lit(0), F.lit(0), F.lit(-1)))
    totals = {"n": "n", "b": "n_budget", "gone": "n_empty"}
    return facts.agg(*[F.sum(c).alias(name) for c, name in totals.items()])


@check(rec(f"select {SCALARS_SQL} from rec where budget is not null and runtime is not null"))
def drop_any_null(spark, sf_dir):
    return flat(spark, sf_dir).select(*SCALARS).dropna("any")


@check(
    rec(
        """select u.i.id id, trim(u.i.name) as name from rec, unnest(items) u(i)
where trim(u.i.name) <> '' and u.i.id is not null"""
    )
)
def blank_name_filter(spark, sf_dir):
    return named_items(flat(spark, sf_dir), "items")


# ---- distinct --------------------------------------------------------------------------------


@check(rec("select count(*) n from (select distinct id, budget, runtime, created, lang, items from rec)"))
def dedup_rows(spark, sf_dir):
    return flat(spark, sf_dir).drop("rec", RECORD_KEY).dropDuplicates().agg(F.count(F.lit(1)).alias("n"))


@check("select distinct lang code, 'English' as name from documents")
def document_languages(spark, sf_dir):
    return code_dimension(spark.read.parquet(f"{sf_dir}/documents.parquet"), "lang", "English")


# ---- status merge ----------------------------------------------------------------------------


def settled_source(spark, sf_dir) -> DataFrame:
    """The routed rows with the status each one should get; unrouted rows are left out."""
    routed = route(flat(spark, sf_dir), rules(spark), "keep").filter("route <> 'unrouted'")
    return routed.withColumn("status", F.when(F.col("route") == "clean", "loaded").otherwise("quarantined"))


STATUS_SQL = f"""case when {STRICT} then 'loaded' when ({STRICT}) is null then 'new' else 'quarantined' end"""


@check(rec(f"select {STATUS_SQL} status, count(*) n from rec group by 1"))
def status_after_merge(spark, sf_dir):
    merged = merge_status(R.bronze(spark, sf_dir), settled_source(spark, sf_dir))
    return merged.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@check(rec(f"select id, budget, {STATUS_SQL} status from rec"))
def struct_key_merge(spark, sf_dir):
    merged = merge_status(R.bronze(spark, sf_dir), settled_source(spark, sf_dir), key="rec")
    return merged.select("rec.id", "rec.budget", "status")


@check(rec(f"select id, budget, {STATUS_SQL} status from rec"))
def record_key_merge(spark, sf_dir):
    merged = merge_status(R.bronze(spark, sf_dir), settled_source(spark, sf_dir))
    return merged.select("rec.id", "rec.budget", "status")


@check(rec(f"select id, case when {STRICT} then 'loaded' else 'new' end status from rec"))
def merge_one_status(spark, sf_dir):
    clean = split(flat(spark, sf_dir), rules(spark))[0]
    merged = merge_status(R.bronze(spark, sf_dir), clean, status="loaded")
    return merged.select("rec.id", "status")


@check(rec("select count(*) n, count(distinct id) n_records, count(distinct id) n_keys from rec"))
def record_keys(spark, sf_dir):
    """Equal records share a key, different ones do not: once over each key, once over each struct."""
    rows = R.records(spark, sf_dir)
    keyed = rows.select("rec.id", "rec", record_key(rows, "rec").alias("k"))
    per_key = keyed.groupBy("k", "rec").agg(F.count(F.lit(1)).alias("c"), F.first("id").alias("id"))
    return per_key.agg(
        F.sum("c").alias("n"), F.count_distinct("id").alias("n_records"), F.count_distinct("k").alias("n_keys")
    )


# ---- repair ----------------------------------------------------------------------------------


@check(
    rec(
        """select id, case when budget >= 100000 then budget else 100000.0::double end budget,
  abs(cast(trunc(runtime) as bigint)) runtime from rec where budget < 100000 or runtime < 0"""
    )
)
def repair_rows(spark, sf_dir):
    fixed = repair(quarantined(spark, sf_dir), ["runtime"], {"budget": R.FLOOR})
    return fixed.select("id", "budget", "runtime")


@check(
    rec(
        """select distinct id, cast(trunc(budget) as int) budget, abs(cast(trunc(runtime) as int)) runtime
from rec where budget < 100000 or runtime < 0"""
    )
)
def repair_int_cast(spark, sf_dir):
    rows = quarantined(spark, sf_dir)
    budget, runtime = as_int(F.col("budget")), F.abs(as_int(F.col("runtime")))
    return rows.select("id", budget.alias("budget"), runtime.alias("runtime")).distinct()


@check(
    rec(
        """select id, case when budget >= 100000 then trunc(budget) else 100000.0::double end budget
from rec where budget < 100000 or runtime < 0"""
    )
)
def repair_whole_budget(spark, sf_dir):
    fixed = repair(quarantined(spark, sf_dir), floors={"budget": R.FLOOR}, whole_cols=["budget"])
    return fixed.select("id", "budget")


# ---- marts -----------------------------------------------------------------------------------

ITEMS_SQL = f"""select distinct u.i.id id, trim(u.i.name) as name from rec, unnest(items) u(i)
where {BUDGET} and trim(u.i.name) <> '' and u.i.id is not null"""
PAIRS_SQL = f"select distinct id record_id, u.i.id item_id from rec, unnest(items) u(i) where {BUDGET}"


@check(rec(ITEMS_SQL))
def item_dimension(spark, sf_dir):
    return dimension(clean_side(spark, sf_dir), "items")


@check(rec(f"{ITEMS_SQL} order by id, name"))
def sorted_dimension(spark, sf_dir):
    return dimension(clean_side(spark, sf_dir), "items").orderBy("id", "name")


@check(rec(PAIRS_SQL))
def record_item_junction(spark, sf_dir):
    return junction(clean_side(spark, sf_dir), "id", "items.id", "record_id", "item_id")


@check(
    rec(
        f"""select p.* from ({PAIRS_SQL}) p where item_id in (select id from ({ITEMS_SQL}))"""
    )
)
def junction_without_orphans(spark, sf_dir):
    clean = clean_side(spark, sf_dir)
    return junction(clean, "id", "items.id", "record_id", "item_id", within=dimension(clean, "items"))


@check(rec("select id record_id, u.i.id item_id from rec, unnest(items) u(i) order by 1, 2"))
def sorted_junction(spark, sf_dir):
    """Every record's item ids in order, copies included."""
    rows = explode_nested(flat(spark, sf_dir), "items.id", keep=["id"], alias="item_id")
    return rows.withColumnRenamed("id", "record_id").orderBy("record_id", "item_id")


@check(rec("select distinct id record_id, u.i.id item_id from rec, unnest(items) u(i) order by 1, 2"))
def sorted_distinct_junction(spark, sf_dir):
    pairs = junction(flat(spark, sf_dir), "id", "items.id", "record_id", "item_id")
    return pairs.orderBy("record_id", "item_id")


@check(rec(f"select distinct lang code, 'English' as name from rec where {BUDGET}"))
def language_dimension(spark, sf_dir):
    return code_dimension(clean_side(spark, sf_dir), "lang", "English")


@check(
    rec(
        f"""select c.code, m.name from (select distinct lang code from rec where {BUDGET}) c
left join (select o_orderstatus code, min(o_orderpriority) as name from orders
           where o_orderstatus <> 'P' group by 1) m on m.code = c.code"""
    )
)
def language_names(spark, sf_dir):
    """Names from a table that lacks one code on purpose: that code stays, without a name."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").filter("o_orderstatus <> 'P'")
    names = orders.groupBy(F.col("o_orderstatus").alias("code")).agg(F.min("o_orderpriority").alias("name"))
    return code_dimension(clean_side(spark, sf_dir), "lang", names)


@check(rec("select id, lang, budget, runtime, cast(created as date) created from rec"))
def movie_table(spark, sf_dir):
    return entity(flat(spark, sf_dir), ["id", "lang", "budget", "runtime", "created"])


# ---- tables ----------------------------------------------------------------------------------

FLAT = struct(
    id=T.LongType(), budget=T.DoubleType(), runtime=T.DoubleType(), created=T.DateType(), lang=T.StringType()
)


def database(spark: SparkSession) -> str:
    """A new, empty database in the shared folder."""
    folder = shared_folder(spark, "db")
    name = "oreflow_" + folder[-12:]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}'")
    return name


@check(rec(f"select {SCALARS_SQL} from rec"))
def partitioned_roundtrip(spark, sf_dir):
    folder = shared_folder(spark, "partitioned")
    batch_writer(flat(spark, sf_dir).select("rec", *SCALARS), "lang", exclude=["rec"]).save(folder)
    return read_location(spark, folder, FLAT).select(*SCALARS)


@check(rec(f"select {SCALARS_SQL}, case when {STRICT} then 'clean' else 'repaired' end side from rec"))
def append_batches(spark, sf_dir):
    table, path = f"{database(spark)}.silver", shared_folder(spark, "silver")
    schema = T.StructType([*FLAT.fields, T.StructField("side", T.StringType())])
    for side, rows in zip(("clean", "repaired"), split(flat(spark, sf_dir), rules(spark))):
        append_rows(rows.select(*SCALARS, F.lit(side).alias("side")), table, schema, path, ["lang"])
    return spark.sql(f"SELECT * FROM {table}")


@check(rec(f"select id, budget, lang, cast('x' as varchar) note from rec where {BUDGET}"))
def replace_schema(spark, sf_dir):
    table, path = f"{database(spark)}.movie", shared_folder(spark, "movie")
    write_snapshot(flat(spark, sf_dir).select(*SCALARS), table, FLAT, path)
    new = struct(id=T.LongType(), budget=T.DoubleType(), lang=T.StringType(), note=T.StringType())
    rows = spark.table(table).filter(F.col("budget") >= R.FLOOR)  # reads the table it replaces
    write_snapshot(rows.select("id", "budget", "lang", F.lit("x").alias("note")), table, new, path)
    return spark.table(table)


@check(rec(f"{PAIRS_SQL}"))
def rerun_is_not_doubled(spark, sf_dir):
    table, path = f"{database(spark)}.pairs", shared_folder(spark, "pairs")
    schema = struct(record_id=T.LongType(), item_id=T.LongType())
    pairs = junction(clean_side(spark, sf_dir), "id", "items.id", "record_id", "item_id")
    write_snapshot(pairs, table, schema, path)
    write_snapshot(pairs, table, schema, path)
    return spark.table(table)


@check(rec("select distinct lang code from rec"))
def sql_projection(spark, sf_dir):
    table = f"{database(spark)}.movie"
    write_snapshot(flat(spark, sf_dir).select(*SCALARS), table, FLAT, shared_folder(spark, "movie"))
    return spark.sql(f"SELECT lang AS code FROM {table}").distinct()


def bronze_table(spark, sf_dir) -> tuple[str, str, T.StructType]:
    """The small records as a registered bronze table of two ingest dates."""
    table, path = f"{database(spark)}.bronze", shared_folder(spark, "layer")
    schema = bronze_of("rec", R.REC)
    rows = R.bronze(spark, sf_dir)
    for day in (1, 2):
        batch = rows.filter(F.col("rec.lang") == "P" if day == 1 else F.col("rec.lang") != "P")
        stamped = stamp(batch, "rec", "orders", dt.datetime(2024, 1, day))
        append_rows(stamped, table, schema, path, BRONZE_PARTS, one_value=True)
    return table, path, schema


@check(
    rec(
        """select id, case when lang = 'P' then date '2024-01-01' else date '2024-01-02' end p_ingestdate
from rec where (budget < 100000 and lang = 'P') is not true"""
    )
)
def status_scan(spark, sf_dir):
    """Mark part of one day as quarantined, found by the layer's folder, then read what is still new."""
    table, path, _ = bronze_table(spark, sf_dir)
    low = spark.table(table).filter((F.col("rec.budget") < R.FLOOR) & (F.col("rec.lang") == "P"))
    update_status(spark, table_at(spark, path, table.split(".")[0]), low, "quarantined")
    return read_status(spark, table, "new").select("rec.id", INGEST_DATE)


@check(rec(f"select status, p_ingestdate, count(*) n from (select {STATUS_SQL} status, "
           "case when lang = 'P' then date '2024-01-01' else date '2024-01-02' end p_ingestdate from rec) "
           "group by 1, 2"))  # fmt: skip
def table_status_merge(spark, sf_dir):
    table, path, _ = bronze_table(spark, sf_dir)
    for status in ("loaded", "quarantined"):
        source = settled_source(spark, sf_dir).filter(F.col("status") == status)
        update_status(spark, table, source, status)
    return spark.table(table).groupBy("status", INGEST_DATE).agg(F.count(F.lit(1)).alias("n"))


@check(rec("select case when lang = 'P' then date '2024-01-01' else date '2024-01-02' end p_ingestdate, "
           f"{STATUS_SQL} status, count(*) n from rec group by 1, 2"))  # fmt: skip
def register_again(spark, sf_dir):
    """After status changes, drop a table and register its folder under another name, and once more under
    that one: the rows and their statuses are the folder's."""
    table, path, schema = bronze_table(spark, sf_dir)
    for status in ("loaded", "quarantined"):
        source = settled_source(spark, sf_dir).filter(F.col("status") == status)
        update_status(spark, table, source, status)
    folder = location_of(spark, table_at(spark, path, table.split(".")[0]))
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    for _ in range(2):
        register(spark, f"{table}_again", schema, folder, BRONZE_PARTS)
    return spark.sql(f"SELECT {INGEST_DATE}, status, count(*) AS n FROM {table}_again GROUP BY 1, 2")


# ---- whole runs, raw files to tables ---------------------------------------------------------


def run(spark: SparkSession, sf_dir: str, repaired: bool, **options) -> Settings:
    """A finished run over the movie files; the same one for every query that looks at it."""
    runs = {}

    def write(root):
        cfg = Settings(
            root=root, raw=R.documents(spark, sf_dir, "movie"), datasource="orders",
            database=database(spark), batch_ts=dt.datetime(2024, 1, 1), **options,
        )
        raw_to_bronze(spark, cfg)
        bronze_to_silver(spark, cfg)
        if repaired:
            repair_quarantined(spark, cfg)
        else:
            build_marts(spark, cfg)
        runs[root] = cfg

    label = "run-" + "-".join(["repaired" if repaired else "marts", *options])
    folder = R.written(spark, label, sf_dir, write)
    return _runs.setdefault(folder, runs.get(folder))


_runs: dict[str, Settings] = {}

MOVIE_COLS_SQL = """"BackdropUrl", "CreatedDate", "Id", "ImdbUrl", "OriginalLanguage", "Overview",
  "PosterUrl", "Price", "ReleaseDate", "Revenue", "Tagline", "Title", "TmdbUrl", "UpdatedDate",
  cast(len(genres) as bigint) n_genres"""


@check(movie(f'select "Budget", "RunTime", {MOVIE_COLS_SQL} from movie where {MOVIE_STRICT}'))
def run_master_silver(spark, sf_dir):
    cfg = run(spark, sf_dir, repaired=False)
    return movie_scalars(spark.sql(f"SELECT * FROM {cfg.table('silver')}"))


@check(movie(f'select "Budget", "RunTime", {MOVIE_COLS_SQL} from movie where "Budget" >= 1000000'))
def run_master_silver_budget_only(spark, sf_dir):
    cfg = run(spark, sf_dir, repaired=False, rules="budget_only")
    return movie_scalars(spark.table(cfg.table("silver")))


@check(
    movie(
        f"""select case when {MOVIE_STRICT} then 'loaded' else 'quarantined' end status,
  date '2024-01-01' p_ingestdate, count(*) n from movie group by 1"""
    )
)
def run_bronze_status(spark, sf_dir):
    cfg = run(spark, sf_dir, repaired=False)
    return spark.table(cfg.table("bronze")).groupBy("status", INGEST_DATE).agg(F.count(F.lit(1)).alias("n"))


@check(movie(f"select \"Id\", '{'{}'}' as status from movie where not ({MOVIE_STRICT})".format("quarantined")))
def run_kept_unrouted(spark, sf_dir):
    cfg = run(spark, sf_dir, repaired=False, unrouted="keep")
    return read_status(spark, cfg.table("bronze"), "quarantined").select("movie.Id", "status")


@check(
    movie(
        f"""select "Id", "Title", "Overview", "Tagline", "RunTime", "ReleaseDate", "CreatedDate", "Price",
  "Revenue", "Budget", "BackdropUrl", "ImdbUrl", "PosterUrl", "TmdbUrl", "UpdatedDate", "OriginalLanguage"
from movie where {MOVIE_STRICT}"""
    )
)
def run_movie_table(spark, sf_dir):
    return spark.table(run(spark, sf_dir, repaired=False).table("movie")).drop("CreatedBy", "UpdatedBy")


@check(
    movie(
        f"""select distinct u.i.id id, trim(u.i.name) as name from movie, unnest(genres) u(i)
where {MOVIE_STRICT} and trim(u.i.name) <> '' and u.i.id is not null"""
    )
)
def run_genre_dimension(spark, sf_dir):
    return spark.table(run(spark, sf_dir, repaired=False).table("genre"))


@check(movie(f"select distinct \"OriginalLanguage\" code, 'English' as name from movie where {MOVIE_STRICT}"))
def run_language_dimension(spark, sf_dir):
    return spark.table(run(spark, sf_dir, repaired=False).table("language"))


@check(
    movie(
        f"""select distinct "Id" movie_id, u.i.id genres_id from movie, unnest(genres) u(i)
where {MOVIE_STRICT} order by 1, 2"""
    )
)
def run_movie_genre_junction(spark, sf_dir):
    table = run(spark, sf_dir, repaired=False).table("movie_genre")
    return spark.sql(f"SELECT * FROM {table} ORDER BY 1, 2")


@check(
    movie(
        f"""select case when {MOVIE_STRICT} then "Budget" when "Budget" >= 1000000 then trunc("Budget")
            else 1000000.0::double end "Budget",
       abs("RunTime") "RunTime", {MOVIE_COLS_SQL} from movie"""
    )
)
def run_repaired_silver(spark, sf_dir):
    return movie_scalars(spark.table(run(spark, sf_dir, repaired=True).table("silver")))


@check(
    movie(
        f"""select case when {MOVIE_STRICT} then "Budget" when "Budget" >= 1000000 then trunc("Budget")
            else 1000000.0::double end "Budget",
       abs("RunTime") "RunTime", {MOVIE_COLS_SQL} from movie"""
    )
)
def run_partitioned_silver(spark, sf_dir):
    cfg = run(spark, sf_dir, repaired=True, silver_partition_by=("UpdatedDate",))
    return movie_scalars(spark.table(cfg.table("silver")).select(*SILVER.fieldNames()))


@check(movie("select 'loaded' status, count(*) n, cast(0 as bigint) n_quarantined from movie"))
def run_status_after_repair(spark, sf_dir):
    bronze = spark.table(run(spark, sf_dir, repaired=True).table("bronze"))
    return bronze.groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "quarantined").alias("n_quarantined")
    )


def fresh(spark, sf_dir, day=1, **where) -> Settings:
    """A run that has not begun, over the movie files, which are written only if it names no others."""
    if "raw" not in where:
        where["raw"] = R.documents(spark, sf_dir, "movie")
    return Settings(datasource="orders", batch_ts=dt.datetime(2024, 1, day), **where)


@check(movie("select 'new' status, count(*) n, count(distinct \"Id\") n_records from movie"))
def run_twice_with_reset(spark, sf_dir):
    cfg = fresh(spark, sf_dir, root=shared_folder(spark, "reset"), database=database(spark))
    raw_to_bronze(spark, cfg)
    raw_to_bronze(spark, cfg, reset=True)
    return spark.table(cfg.table("bronze")).groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("movie.Id").alias("n_records")
    )


@check(
    movie(
        f"""select case when {MOVIE_STRICT} or d.p_ingestdate = date '2024-01-01' then 'loaded' else 'quarantined' end status,
  d.p_ingestdate, count(*) n
from movie, (values (date '2024-01-01'), (date '2024-01-02')) d(p_ingestdate) group by 1, 2"""
    )
)
def run_same_records_again(spark, sf_dir):
    """A second delivery of records already repaired: the first one's stay loaded, as silver has them."""
    where = {"root": shared_folder(spark, "again"), "database": database(spark)}
    for day in (1, 2):
        cfg = fresh(spark, sf_dir, day, **where)
        raw_to_bronze(spark, cfg)
        bronze_to_silver(spark, cfg)
        if day == 1:
            repair_quarantined(spark, cfg)
    return spark.table(cfg.table("bronze")).groupBy("status", INGEST_DATE).agg(F.count(F.lit(1)).alias("n"))


def agreement(spark, cfg: Settings) -> DataFrame:
    """Rows of each record: loaded in bronze, in silver, and in silver rebuilt."""

    def count(rows, name):
        return rows.groupBy("Id").agg(F.count(F.lit(1)).alias(name))

    loaded = count(read_status(spark, cfg.table("bronze"), "loaded").select("movie.Id"), "n_loaded")
    silver = spark.read.parquet(location_of(spark, cfg.table("silver")))
    silver = count(silver.select("Id"), "n_silver")
    rebuild_silver(spark, cfg)
    rebuilt = count(spark.table(cfg.table("silver")).select("Id"), "n_rebuilt")
    return loaded.join(silver, "Id", "full").join(rebuilt, "Id", "full").na.fill(0)


TWICE_SQL = movie('select "Id", 2 * count(*) n_loaded, 2 * count(*) n_silver, 2 * count(*) n_rebuilt from movie group by 1')


@check(TWICE_SQL)
def run_repaired_then_delivered_again(spark, sf_dir):
    """Records repaired on the first day come again on the second, and are repaired again."""
    where = {"root": shared_folder(spark, "twice"), "database": database(spark)}
    for day in (1, 2):
        cfg = fresh(spark, sf_dir, day, **where)
        raw_to_bronze(spark, cfg)
        bronze_to_silver(spark, cfg)
        repair_quarantined(spark, cfg)
    return agreement(spark, cfg)


@check(TWICE_SQL)
def run_delivered_again_before_repair(spark, sf_dir):
    """Records come again while the first ones are quarantined, and repair runs before the second load."""
    where = {"root": shared_folder(spark, "early"), "database": database(spark)}
    for day in (1, 2):
        cfg = fresh(spark, sf_dir, day, **where)
        raw_to_bronze(spark, cfg)
        if day == 2:
            repair_quarantined(spark, cfg)
        bronze_to_silver(spark, cfg)
    repair_quarantined(spark, cfg)
    return agreement(spark, cfg)


@check(movie(f"""select case when {MOVIE_STRICT} then 'loaded' else 'quarantined' end status, count(*) n,
  max(s.n_silver) n_silver from movie, (select count(*) n_silver from movie where {MOVIE_STRICT}) s group by 1"""))  # fmt: skip
def rerun_of_a_batch(spark, sf_dir):
    """Both steps twice for one batch, as after a scheduler's retry: nothing is doubled."""
    where = {"root": shared_folder(spark, "rerun"), "database": database(spark)}
    cfg = fresh(spark, sf_dir, batch="one", **where)
    raw_to_bronze(spark, cfg)
    bronze_to_silver(spark, cfg)
    raw_to_bronze(spark, cfg)
    bronze_to_silver(spark, cfg)
    bronze_to_silver(spark, cfg)
    n_silver = spark.table(cfg.table("silver")).count()
    bronze = spark.table(cfg.table("bronze")).groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return bronze.withColumn("n_silver", F.lit(n_silver).cast("long"))


@check(movie("""select "Id", "Title" || '/' || "Id" as studio, 2 as n_keys from movie group by all"""))
def unlisted_fields(spark, sf_dir):
    """Raw files whose records carry a field beyond the listed ones, or two values of it: both are kept."""

    def write(folder):
        value = F.concat_ws("/", F.col("movie.Title"), F.col("movie.Id"))
        both = F.explode(F.array(value, F.lit("other"))).alias("studio")
        rows = R.movies(spark, sf_dir).select("movie", both)
        rows = rows.select(F.col("movie").withField("Studio", F.col("studio")).alias("movie"))
        rows.select(F.array("movie").alias("movie")).write.json(folder, compression="gzip")

    where = {"root": shared_folder(spark, "extra"), "database": database(spark)}
    cfg = fresh(spark, sf_dir, raw=R.written(spark, "raw-extra", sf_dir, write), multiline=False, **where)
    raw_to_bronze(spark, cfg)
    rows = spark.table(cfg.table("bronze"))
    rows = rows.select("movie.Id", "record_key", F.get_json_object("extra", "$.Studio").alias("studio"))
    keys = rows.groupBy("Id").agg(F.count_distinct("record_key").cast("int").alias("n_keys"))
    return rows.filter("studio <> 'other'").select("Id", "studio").distinct().join(keys, "Id")


@check(movie('select "Id", count(*) n, count(*) n_keys from movie group by 1'))
def incremental_raw(spark, sf_dir):
    """Two sets of raw files, each a list of paths, in two runs: every record is counted once."""
    where = {"root": shared_folder(spark, "sets"), "database": database(spark)}
    files = raw_files(spark, R.documents(spark, sf_dir, "movie")).orderBy("path").select("path").collect()
    paths = [row["path"] for row in files]
    for day, some in ((1, paths[::2]), (2, paths[1::2])):
        cfg = replace(fresh(spark, sf_dir, day, **where), raw=some)
        raw_to_bronze(spark, cfg)
    late = replace(cfg, modified_after="2999-01-01T00:00:00", batch="late")
    raw_to_bronze(spark, late)  # no file is that new
    rows = spark.table(cfg.table("bronze"))
    return rows.groupBy("movie.Id").agg(F.count(F.lit(1)).alias("n"), F.count("record_key").alias("n_keys"))


@check(movie("select 0 as n_rejects, count(*) n from movie"))
def rejects_after_reset(spark, sf_dir):
    """A broken file, then a reset with good ones: its reject is gone."""
    cfg = fresh(spark, sf_dir, root=shared_folder(spark, "rejects"), database=database(spark))
    broken = shared_folder(spark, "broken")
    spark.range(1).select(F.lit('{"movie": [{"Id": 1')).write.text(broken)
    raw_to_bronze(spark, replace(cfg, raw=broken))
    assert spark.table(cfg.table("rejects")).count() == 1
    raw_to_bronze(spark, cfg, reset=True)
    n_rejects = spark.table(cfg.table("rejects")).count()
    return spark.table(cfg.table("bronze")).agg(F.lit(n_rejects).alias("n_rejects"), F.count(F.lit(1)).alias("n"))


@check(movie("select 1 n_rows, true starts, true in_bounds, 4000 most"))
def raw_peek(spark, sf_dir):
    """The first characters of the first raw file, and no more of it."""
    rows = peek_raw(spark, R.documents(spark, sf_dir, "movie"), 4000)
    starts = F.bool_and(F.col("value").startswith('{"movie": [')).alias("starts")
    n = F.length("value")
    return rows.agg(F.count(F.lit(1)).cast("int").alias("n_rows"), starts, F.bool_and((n > 100) & (n <= 4000)).alias("in_bounds"),
                    F.lit(4000).alias("most"))


@check(movie("select count(*) n, true one_time, true in_the_run, true same_day, true one_batch from movie"))
def stamped_now(spark, sf_dir):
    """Without a batch time the run's clock counts: one time for all rows, between its start and its end."""
    cfg = replace(fresh(spark, sf_dir, root=shared_folder(spark, "now"), database=database(spark)), batch_ts=None)
    clock = spark.range(1).select(F.current_timestamp().cast("double"))
    start = clock.first()[0]
    raw_to_bronze(spark, cfg)
    end = spark.range(1).select(F.current_timestamp().cast("double")).first()[0]
    time = F.col("ingesttime").cast("double")
    return spark.table(cfg.table("bronze")).agg(
        F.count(F.lit(1)).alias("n"),
        (F.count_distinct("ingesttime") == 1).alias("one_time"),
        ((F.min(time) >= start) & (F.max(time) <= end)).alias("in_the_run"),
        F.bool_and(F.col(INGEST_DATE) == F.to_date("ingesttime")).alias("same_day"),
        (F.count_distinct("batch") == 1).alias("one_batch"),
    )


@check(
    movie(
        f"""select case when {MOVIE_STRICT} then "Budget" when "Budget" >= 1000000 then trunc("Budget")
            else 1000000.0::double end "Budget",
       abs("RunTime") "RunTime", {MOVIE_COLS_SQL} from movie"""
    )
)
def run_rebuilt_silver(spark, sf_dir):
    """Silver got its rows twice, as after a step that was cut short; bronze knows better."""
    cfg = fresh(spark, sf_dir, root=shared_folder(spark, "rebuild"), database=database(spark))
    raw_to_bronze(spark, cfg)
    bronze_to_silver(spark, cfg)
    repair_quarantined(spark, cfg)
    append_rows(spark.table(cfg.table("silver")), cfg.table("silver"), SILVER, cfg.path("silver"), SILVER_PARTS)
    rebuild_silver(spark, cfg)
    return movie_scalars(spark.table(cfg.table("silver")))


@check(movie("""select distinct "Id", u.i.id genre_id, 's' || "Id" as slug, 2 as n_keys from movie, unnest(genres) u(i)"""))
def unlisted_nested_fields(spark, sf_dir):
    """Records with a field beyond the listed ones inside an array of structs: kept, in place, and part of the key."""

    def write(folder):
        value = F.concat(F.lit("s"), F.col("movie.Id"))
        rows = R.movies(spark, sf_dir).select("movie", F.explode(F.array(value, F.lit("other"))).alias("slug"))
        genres = F.transform("movie.genres", lambda genre: genre.withField("slug", F.col("slug")))
        lines = rows.select(F.array(F.col("movie").withField("genres", genres)).alias("movie"))
        lines.write.json(folder, compression="gzip")

    where = {"root": shared_folder(spark, "nested"), "database": database(spark)}
    cfg = fresh(spark, sf_dir, raw=R.written(spark, "raw-nested", sf_dir, write), multiline=False, **where)
    raw_to_bronze(spark, cfg)
    more = F.from_json("extra", "genres array<struct<slug string>>")["genres"]
    rows = spark.table(cfg.table("bronze")).withColumn("more", more)
    items = rows.select("movie.Id", F.explode(F.arrays_zip("movie.genres", "more")).alias("item"))
    items = items.select("Id", F.col("item.genres.id").alias("genre_id"), F.col("item.more.slug").alias("slug"))
    keys = rows.select("movie.Id", RECORD_KEY).groupBy("Id").agg(F.count_distinct(RECORD_KEY).cast("int").alias("n_keys"))
    return items.filter("slug <> 'other'").distinct().join(keys, "Id")


@check(movie(f"""select case when {MOVIE_STRICT} then 'loaded' else 'quarantined' end status, count(*) n,
  max(s.n_silver) n_silver, true failed from movie, (select count(*) n_silver from movie where {MOVIE_STRICT}) s group by 1"""))  # fmt: skip
def load_after_failure(spark, sf_dir):
    """A loaded batch is delivered again with a file that cannot be read: the run fails, both layers stay."""
    cfg = fresh(spark, sf_dir, batch="one", root=shared_folder(spark, "failing"), database=database(spark))
    raw_to_bronze(spark, cfg)
    bronze_to_silver(spark, cfg)
    broken = f"{shared_folder(spark, 'raw-broken')}/a.json.gz"
    write_text(spark, broken, "not compressed")
    failed = False
    try:
        raw_to_bronze(spark, replace(cfg, raw=broken, extra_fields="ignore"))
    except Exception:  # whatever the reader raises
        failed = True
    bronze_to_silver(spark, cfg)
    n_silver = spark.table(cfg.table("silver")).count()
    bronze = spark.table(cfg.table("bronze")).groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return bronze.withColumns({"n_silver": F.lit(n_silver).cast("long"), "failed": F.lit(failed)})


def in_thirds(spark, sf_dir, label) -> list[Settings]:
    """The movie files as three batches of one feed."""
    files = raw_files(spark, R.documents(spark, sf_dir, "movie")).orderBy("path").select("path").collect()
    where = {"root": shared_folder(spark, label), "database": database(spark)}
    paths = [row["path"] for row in files]
    return [replace(fresh(spark, sf_dir, k + 1, batch=f"b{k}", **where), raw=paths[k::3]) for k in range(3)]


@check(movie(f"""select 'movie' mart, cast("Id" as varchar) a, "Title" b, count(*) n from movie where {MOVIE_STRICT} group by all
union all select 'genre', cast(id as varchar), name, count(distinct 1) from (select u.i.id, trim(u.i.name) as name
  from movie, unnest(genres) u(i) where {MOVIE_STRICT}) where name <> '' and id is not null group by all
union all select 'language', "OriginalLanguage", 'English', count(distinct 1) from movie where {MOVIE_STRICT} group by all
union all select 'movie_genre', cast("Id" as varchar), cast(u.i.id as varchar), count(distinct 1)
  from movie, unnest(genres) u(i) where {MOVIE_STRICT} group by all"""))  # fmt: skip
def marts_by_batch(spark, sf_dir):
    """Marts brought up to date after each of three batches, of which the second is delivered twice."""
    one, two, three = in_thirds(spark, sf_dir, "by-batch")
    for cfg in (one, two, three, two):
        raw_to_bronze(spark, cfg)
        bronze_to_silver(spark, cfg)
        update_marts(spark, cfg)
    rows = None
    for name, a, b in (("movie", "Id", "Title"), ("genre", "id", "name"), ("language", "code", "name"),
                       ("movie_genre", "movie_id", "genres_id")):
        mart = spark.table(cfg.table(name)).select(F.lit(name).alias("mart"), F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b"))
        rows = mart if rows is None else rows.unionByName(mart)
    return rows.groupBy("mart", "a", "b").agg(F.count(F.lit(1)).alias("n"))


@check(movie('select "Id", count(*) n, count(distinct "Id") n_ids from movie group by 1'))
def ledger_of_files(spark, sf_dir):
    """Runs over a growing set of files, a file sent again under another name among them: each record counts once."""
    files = raw_files(spark, R.documents(spark, sf_dir, "movie")).orderBy("path").select("path").collect()
    paths, again = [row["path"] for row in files], shared_folder(spark, "again")
    spark.read.text(paths[0]).coalesce(1).write.text(again)
    where = {"root": shared_folder(spark, "ledger"), "database": database(spark), "ledger": True}
    for day, some in ((1, paths[::2]), (2, paths), (3, [*paths, again])):
        cfg = replace(fresh(spark, sf_dir, day, **where), raw=some)
        raw_to_bronze(spark, cfg)
    rows = spark.table(cfg.table("bronze"))
    return rows.groupBy("movie.Id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("movie.Id").alias("n_ids"))


@check(movie("""select "Id", "Title", "Budget", cast(len(genres) as bigint) n_genres, count(*) n from movie group by all"""))
def split_documents(spark, sf_dir):
    """The raw documents split at their records by many tasks, and loaded."""
    cfg = fresh(spark, sf_dir, root=shared_folder(spark, "split"), database=database(spark), split=True)
    raw_to_bronze(spark, cfg)
    rows = spark.table(cfg.table("bronze")).select("movie.Id", "movie.Title", "movie.Budget", F.size("movie.genres").cast("long").alias("n_genres"))
    return rows.withColumn("n_genres", F.when(F.col("n_genres") >= 0, F.col("n_genres"))).groupBy("Id", "Title", "Budget", "n_genres").agg(
        F.count(F.lit(1)).alias("n")
    )


@check(movie(f"""select case when "Id" in (select distinct "Id" from movie order by 1 limit 2) then 'quarantined'
  when {MOVIE_STRICT} then 'loaded' else 'quarantined' end status, count(*) n from movie group by 1"""))
def merge_of_few_keys(spark, sf_dir):
    """Two records of three settled batches are quarantined by key: sketches say which partitions to look into."""
    for cfg in in_thirds(spark, sf_dir, "few-keys"):
        raw_to_bronze(spark, cfg)
        bronze_to_silver(spark, cfg)
    table = spark.table(cfg.table("bronze"))
    two = [row[0] for row in table.select("movie.Id").distinct().orderBy("Id").limit(2).collect()]
    update_status(spark, cfg.table("bronze"), table.filter(F.col("movie.Id").isin(two)), "quarantined")
    return spark.table(cfg.table("bronze")).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


# ---- what a user looks at --------------------------------------------------------------------


@check(movie("""select 'documents and records' what, count(*) n from movie
union all select 'clean', count(*) from movie where """ + MOVIE_STRICT + """
union all select 'quarantine', count(*) from movie where not (""" + MOVIE_STRICT + ")"))  # fmt: skip
def cached_batch(spark, sf_dir):
    """A raw batch that is parsed once, kept, and used for several counts."""
    raw = read_json_batch(spark, R.documents(spark, sf_dir, "movie"), RAW)
    batch = explode_records(raw, "movie", "movie").persist(StorageLevel.MEMORY_AND_DISK)
    rows = flatten(batch, "movie", ["Budget", "RunTime"])
    n = F.count(F.lit(1)).alias("n")
    sides = [("clean", split(rows, strict(), "keep")[0]), ("quarantine", split(rows, strict(), "keep")[1])]
    found = batch.agg(n).select(F.lit("documents and records").alias("what"), "n")
    for what, side in sides:
        found = found.unionByName(side.agg(n).select(F.lit(what).alias("what"), "n"))
    return found


@check(movie('select "Id", "Title", "Budget" from movie order by "Budget" desc nulls last, "Id", "Title" limit 20'))
def shown_rows(spark, sf_dir):
    """What ``show`` prints of a table: its first rows in an order, the limit being the point."""
    rows = flatten(explode_records(read_json_batch(spark, R.documents(spark, sf_dir, "movie"), RAW), "movie", "movie"), "movie", ["Id", "Title", "Budget"])
    rows.show(20, truncate=False)
    return rows.orderBy(F.desc_nulls_last("Budget"), "Id", "Title").limit(20)


@check(movie("""select 'Budget' as name, 'double' as type, count("Budget") n from movie
union all select 'CreatedDate', 'date', count("CreatedDate") from movie union all select 'Id', 'bigint', count("Id") from movie
union all select 'RunTime', 'bigint', count("RunTime") from movie union all select 'Title', 'string', count("Title") from movie
union all select 'genres', 'array<struct<id:bigint,name:string>>', count(genres) from movie"""))  # fmt: skip
def schema_report(spark, sf_dir):
    """What ``printSchema`` prints of a flattened batch, with the values of each column counted."""
    raw = explode_records(read_json_batch(spark, R.documents(spark, sf_dir, "movie"), RAW), "movie", "movie")
    rows = flatten(raw, "movie", ["Budget", "CreatedDate", "Id", "RunTime", "Title", "genres"], ["CreatedDate"])
    rows.printSchema()
    columns = [F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"), F.count(f.name).alias("n")) for f in rows.schema.fields]
    return rows.agg(F.array(*columns).alias("columns")).select(F.inline("columns"))


@check(movie("""select a."Id", a."Title", count(*) n from movie a join movie b on a."Id" = b."Id" and b."Budget" < 1000000 group by 1, 2"""))
def aliased_relations(spark, sf_dir):
    """One table twice under two names, joined on columns of both."""
    raw = explode_records(read_json_batch(spark, R.documents(spark, sf_dir, "movie"), RAW), "movie", "movie")
    rows = flatten(raw, "movie", ["Id", "Title", "Budget"])
    low = rows.alias("quarantine").filter("quarantine.Budget < 1000000")
    pairs = rows.alias("bronze").join(low, F.expr("bronze.Id = quarantine.Id"))
    return pairs.groupBy("bronze.Id", "bronze.Title").agg(F.count(F.lit(1)).alias("n"))


# ---- flagship --------------------------------------------------------------------------------


@check(
    movie(
        f"""select case when {MOVIE_STRICT} then 'loaded' else 'quarantined' end status, count(*) n,
  count(distinct "Id") n_records, min("CreatedDate") first_created, max("CreatedDate") last_created
from movie group by 1"""
    )
)
def load_report(spark, sf_dir):
    """Raw files to routed records in one plan, with no table in between."""
    raw = read_json_batch(spark, R.documents(spark, sf_dir, "movie"), RAW)
    rows = flatten(
        explode_records(raw, "movie", "movie"),
        "movie",
        ["Id", "Budget", "RunTime", "CreatedDate"],
        ["CreatedDate"],
    )
    status = F.when(verdict(strict()) == "clean", "loaded").otherwise("quarantined")
    return rows.groupBy(status.alias("status")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("Id").alias("n_records"),
        F.min("CreatedDate").alias("first_created"),
        F.max("CreatedDate").alias("last_created"),
    )
