"""What the physical plans must look like for the jobs to hold at scale."""

import datetime as dt
import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import oreflow.plans.status as status_plans
from oreflow.operators import dimension, flatten, junction, merge_status, split, stamp, strict
from oreflow.plans import settle, update_status
from oreflow.plans.status import stale_places
from oreflow.schemas import BRONZE_PARTS, bronze_of, struct
from oreflow.sinks import append_rows, batch_writer, write_snapshot

RECORD = struct(
    Id=T.LongType(), Budget=T.DoubleType(), RunTime=T.LongType(), Overview=T.StringType(),
    genres=T.ArrayType(struct(id=T.LongType(), name=T.StringType())),
)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(text: str) -> list[str]:
    return re.findall(r"ReadSchema: (\S+)", text)


@contextmanager
def conf(spark, **options):
    keys = {k.replace("__", "."): v for k, v in options.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def movies(spark, n, hot=0):
    """n different records and ``hot`` copies of one more."""
    ids = spark.range(n + hot).select(F.least("id", F.lit(n)).alias("id"))
    fields = [
        F.col("id").alias("Id"), (F.col("id") % 7 * 400000.0).alias("Budget"), (F.col("id") % 5 - 1).alias("RunTime"),
        F.lit("long text").alias("Overview"),
        F.array(F.struct((F.col("id") % 9).alias("id"), F.lit(" x ").alias("name"))).alias("genres"),
    ]
    return ids.select(F.struct(*fields).alias("movie"))


@pytest.fixture
def bronze(spark, database, tmp_path):
    table, path = f"{database}.bronze", str(tmp_path / "bronze")
    schema = bronze_of("movie", RECORD)
    for day in (1, 2):
        rows = stamp(movies(spark, 40 * day), "movie", "here", dt.datetime(2024, 1, day))
        append_rows(rows, table, schema, path, BRONZE_PARTS, one_value=True)
    return table, path


def test_filters_and_columns_reach_the_scan(spark, bronze):
    flat = flatten(spark.table(bronze[0]), "movie", RECORD.fieldNames())
    clean, bad = split(flat.select("Id", "Budget", "RunTime"), strict(), "keep")
    text = plan(clean)
    assert "GreaterThanOrEqual(movie.RunTime,0)" in text and "GreaterThanOrEqual(movie.Budget,1000000.0)" in text
    assert read_columns(text) == ["struct<movie:struct<Id:bigint,Budget:double,RunTime:bigint>>"]
    assert "Or(LessThan(movie.RunTime,0),LessThan(movie.Budget,1000000.0))" in plan(bad)


def test_marts_read_only_the_array_and_shuffle_once(spark, bronze):
    flat = flatten(spark.table(bronze[0]), "movie", RECORD.fieldNames())
    pairs, names = plan(junction(flat, "Id", "genres.id")), plan(dimension(flat, "genres"))
    assert read_columns(pairs) == ["struct<movie:struct<Id:bigint,genres:array<struct<id:bigint>>>>"]
    assert read_columns(names) == ["struct<movie:struct<genres:array<struct<id:bigint,name:string>>>>"]
    for text in (pairs, names):
        assert text.count("Exchange hashpartitioning") == 1 and text.count("HashAggregate") == 2


def test_stamping_and_ingest_do_not_shuffle(spark):
    assert "Exchange" not in plan(stamp(movies(spark, 10), "movie", "here"))


def test_settling_a_batch_moves_no_payload(spark, bronze, monkeypatch):
    table, _ = bronze
    written = []
    real = status_plans.insert_rows

    def spy(df, *args, **kwargs):
        written.append(plan(df))
        real(df, *args, **kwargs)

    monkeypatch.setattr(status_plans, "insert_rows", spy)
    outcome = F.when(F.col("movie.Budget") >= 1e6, "loaded").otherwise("quarantined")
    assert settle(spark, table, "new", outcome, "l")
    text = written.pop()
    assert "Exchange" not in text and "Join" not in text
    assert spark.table(table).filter("status = 'new'").count() == 0


def test_a_status_read_opens_only_that_status(spark, bronze):
    text = plan(spark.table(bronze[0]).filter("status = 'new'").select("record_key"))
    assert re.search(r"PartitionFilters: \[[^\]]*\(status#\d+ = new\)", text)


def test_the_look_up_shuffles_the_table_once_and_splits_a_hot_key(spark):
    with conf(spark, **SKEW):
        rows = stamp(movies(spark, 20000, hot=10000).repartition(8), "movie", "here", dt.datetime(2024, 1, 1))
        # copies compress to nothing in a shuffle, so their places tell them apart
        rows = rows.withColumn("batch", F.sha2((F.monotonically_increasing_id() % 5000).cast("string"), 512))
        places = stale_places(rows, rows.filter("movie.Id >= 19999"), "loaded")
        found = places.collect()
        assert 1 < len(found) <= 5000
        text = plan(places).split("Initial Plan")[0]
        assert "SortMergeJoin(skew=true)" in text and text.count("LeftSemi") == 1


def test_a_merge_writes_few_files_a_partition(spark, database, tmp_path):
    table, path = f"{database}.bronze", str(tmp_path / "bronze")
    schema = bronze_of("movie", RECORD)
    for day in range(1, 7):
        rows = stamp(movies(spark, 200).coalesce(1), "movie", "here", dt.datetime(2024, 1, day))
        append_rows(rows, table, schema, path, BRONZE_PARTS, one_value=True)
    options = dict(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
                   spark__sql__shuffle__partitions="16")
    with conf(spark, **options):
        source = spark.table(table).filter("movie.Id % 2 = 0").select("record_key").distinct()
        assert update_status(spark, table, source, "loaded")
    found = spark.table(table)
    assert {r[0]: r[1] for r in found.groupBy("status").count().collect()} == {"loaded": 600, "new": 600}
    assert len(found.inputFiles()) <= 6 * 2 * 3


def test_a_merge_shuffles_no_payload(spark, bronze, monkeypatch):
    table, _ = bronze
    written, real = [], status_plans.insert_rows

    def spy(df, *args, **kwargs):
        written.append((plan(df), kwargs.get("one_value", False)))
        real(df, *args, **kwargs)

    monkeypatch.setattr(status_plans, "insert_rows", spy)
    monkeypatch.setattr(status_plans, "BITMAP", 8)
    options = dict(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    before = {tuple(r) for r in spark.table(table).select("movie.Id", "p_ingestdate").collect()}
    # no source, few bitmaps, and more of them than every task is to get
    for most, where, status in ((99, "Id < 0", "loaded"), (99, "Id % 3 = 0", "loaded"), (0, "Id % 2 = 0", "quarantined")):
        monkeypatch.setattr(status_plans, "MOST_MAPS", most)
        source = movies(spark, 80).select("movie", "movie.Id").filter(where)
        source = stamp(source, "movie", "here").select("record_key")
        with conf(spark, **options):
            assert update_status(spark, table, source, status) == (where != "Id < 0")
    assert len(written) == 2 and all(one_value for _, one_value in written)
    assert "Exchange hashpartitioning" not in written[0][0] and "SortMergeJoin" not in written[0][0]
    got = spark.table(table).select("movie.Id", "p_ingestdate", "status").collect()
    assert {(r[0], r[1]) for r in got} == before and len(got) == 120
    assert all(r[2] == ("quarantined" if r[0] % 2 == 0 else "loaded" if r[0] % 3 == 0 else "new") for r in got)


SKEW = dict(
    spark__sql__autoBroadcastJoinThreshold="-1",
    spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    spark__sql__adaptive__advisoryPartitionSizeInBytes="20k",
    spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="40k",
    spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
)


@pytest.mark.parametrize("key, status", [("record_key", "loaded"), ("record_key", None), ("movie", "loaded")])
def test_merge_splits_a_record_that_holds_a_third_of_all_rows(spark, key, status):
    with conf(spark, **SKEW):
        target = stamp(movies(spark, 20000, hot=10000).repartition(8), "movie", "here")
        source = target.filter("movie.Id >= 19999").withColumn("status", F.lit("loaded"))
        # copies compress to nothing in a shuffle, so a column tells them apart
        target = target.withColumn("noise", F.sha2(F.monotonically_increasing_id().cast("string"), 512))
        merged = merge_status(target, source, key, status).select("movie.Id", "noise", "status")
        merged = merged.sortWithinPartitions("status")
        rows = merged.collect()
        assert len(rows) == 30000 and sum(r["status"] == "loaded" for r in rows) == 10001
        assert "skew=true" in plan(merged)


def test_junction_splits_an_item_that_holds_a_third_of_all_pairs(spark):
    item = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).cast("bigint")
    rows = spark.range(60000).select("id", F.array(F.struct(item.alias("id"))).alias("genres"))
    known = spark.range(30000).select("id", F.lit("x").alias("name"))
    with conf(spark, **SKEW):
        pairs = junction(rows, "id", "genres.id", within=known)
        kept = {(r[0], r[1]) for r in pairs.collect()}
        assert len(kept) == 20000 + 20000 and (0, 1) in kept
        assert "skew=true" in plan(pairs)


def test_a_partition_that_holds_most_rows_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(60000).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 4).cast("string")).alias("p"))
    with conf(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="50k"):
        batch_writer(rows.repartition(6), "p").save(str(tmp_path / "o"))
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "o").glob("p=*")}
    assert files["p=hot"] > 1 and max(n for name, n in files.items() if name != "p=hot") <= 2
    assert spark.read.parquet(str(tmp_path / "o")).count() == 60000


def test_snapshot_of_an_unpartitioned_table_does_not_shuffle(spark, database, tmp_path, monkeypatch):
    seen, df = [], spark.range(10)
    real = type(df).write

    def spy(self):
        seen.append(plan(self))
        return real.fget(self)

    monkeypatch.setattr(type(df), "write", property(spy))
    write_snapshot(df, f"{database}.t", struct(id=T.LongType()), str(tmp_path / "t"))
    assert seen and all("Exchange" not in text for text in seen)
