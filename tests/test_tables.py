"""Table writes: appends, snapshots, partition swaps."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.schemas import struct
from oreflow.sinks import append_rows, batch_writer, drop_partitions, register, replace_partitions, write_snapshot
from oreflow.sources import read_location, table_at
from oreflow.sources.tables import location_of

AB = struct(a=T.LongType(), b=T.StringType())


def rows(spark, table):
    return sorted((tuple(r) for r in spark.table(table).collect()), key=str)


@pytest.fixture
def frame(spark):
    return spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], AB)


def test_append_adds_and_matches_columns_by_name(spark, database, tmp_path, frame):
    table = f"{database}.t"
    append_rows(frame, table, AB, str(tmp_path / "t"), ["b"])
    append_rows(frame.select("b", "a"), table, AB, str(tmp_path / "t"), ["b"])
    assert rows(spark, table) == sorted([(1, "x"), (2, "y"), (3, None)] * 2, key=str)


@pytest.mark.parametrize(
    "change", [lambda d: d.drop("b"), lambda d: d.withColumn("c", F.lit(1)), lambda d: d.withColumn("a", F.lit("1"))]
)
def test_append_refuses_another_schema(spark, database, tmp_path, frame, change):
    table = f"{database}.t"
    append_rows(frame, table, AB, str(tmp_path / "t"))
    with pytest.raises(ValueError, match="schema differs"):
        append_rows(change(frame), table, AB, str(tmp_path / "t"))
    assert spark.table(table).count() == 3


def test_snapshot_replaces_rows_and_may_read_its_own_table(spark, database, tmp_path, frame):
    table = f"{database}.t"
    write_snapshot(frame, table, AB, str(tmp_path / "t"))
    write_snapshot(spark.table(table).filter("a < 3"), table, AB, str(tmp_path / "t"))
    assert rows(spark, table) == [(1, "x"), (2, "y")]


@pytest.mark.parametrize("parts", [(), ("b",)])
def test_snapshot_replaces_the_schema(spark, database, tmp_path, frame, parts):
    table = f"{database}.t"
    write_snapshot(frame, table, AB, str(tmp_path / "t"), parts)
    assert rows(spark, table) == [(1, "x"), (2, "y"), (3, None)]
    new = struct(z=T.DoubleType())
    write_snapshot(spark.table(table).select((F.col("a") / 2).alias("z")), table, new, str(tmp_path / "t"))
    assert rows(spark, table) == [(0.5,), (1.0,), (1.5,)]


def test_failed_write_leaves_the_table(spark, database, tmp_path, frame):
    table = f"{database}.t"
    write_snapshot(frame, table, AB, str(tmp_path / "t"))
    broken = frame.withColumn("a", F.raise_error(F.lit("broken")).cast("bigint"))
    with pytest.raises(Exception, match="broken"):
        write_snapshot(broken, table, AB, str(tmp_path / "t"))
    assert len(rows(spark, table)) == 3


def test_partition_column_without_values_keeps_its_type(spark, database, tmp_path):
    schema = struct(a=T.LongType(), d=T.DateType())
    df = spark.createDataFrame([(1, None), (2, None)], schema)
    append_rows(df, f"{database}.t", schema, str(tmp_path / "t"), ["d"])
    assert rows(spark, f"{database}.t") == [(1, None), (2, None)]
    batch_writer(df, "d").save(str(tmp_path / "plain"))
    back = read_location(spark, str(tmp_path / "plain"), schema)
    assert dict(back.dtypes)["d"] == "date" and back.count() == 2


def test_batch_writer_drops_columns(spark, tmp_path, frame):
    df = frame.withColumn("payload", F.lit(1))
    batch_writer(df, "b", exclude=["payload", "absent"]).save(str(tmp_path / "o"))
    batch_writer(df, "b", exclude=["payload"], mode="append").save(str(tmp_path / "o"))
    back = spark.read.parquet(str(tmp_path / "o"))
    assert sorted(back.columns) == ["a", "b"] and back.count() == 6


def test_only_the_named_partitions_are_swapped(spark, database, tmp_path):
    schema = struct(a=T.LongType(), p=T.StringType())
    table, path = f"{database}.t", str(tmp_path / "t")
    df = spark.createDataFrame([(1, "x"), (2, "y's"), (3, "z")], schema)
    append_rows(df, table, schema, path, ["p"])
    before = set(spark.table(table).inputFiles())
    assert all(".zstd." in file for file in before)
    part = spark.table(table).filter("p = 'x'").withColumn("a", F.col("a") + 10)
    replace_partitions(part, table, "p", ["x"])
    assert rows(spark, table) == [(11, "x"), (2, "y's"), (3, "z")]
    after = set(spark.table(table).inputFiles())
    assert len(before & after) == 2
    append_rows(df, table, schema, path, ["p"])
    assert spark.table(table).count() == 6 and spark.table(table).filter("p = 'x'").count() == 2
    replace_partitions(spark.table(table).filter("a = 11"), table, "p", ["x", "y's"])
    assert rows(spark, table) == [(11, "x"), (3, "z"), (3, "z")]
    register(spark, table, schema, location_of(spark, table), ["p"])
    assert rows(spark, table) == [(11, "x"), (3, "z"), (3, "z")]
    assert drop_partitions(spark, table, lambda part: part["p"] == "z") == 1
    assert rows(spark, table) == [(11, "x")]


def test_a_table_is_found_by_its_folder(spark, database, tmp_path, frame):
    write_snapshot(frame, f"{database}.one", AB, str(tmp_path / "one"))
    register(spark, f"{database}.two", AB, str(tmp_path / "it's"))
    assert table_at(spark, str(tmp_path / "one"), database) == f"{database}.one"
    assert table_at(spark, f"file:{tmp_path}/it's/", database) == f"{database}.two"
    with pytest.raises(LookupError):
        table_at(spark, str(tmp_path / "on"), database)


def test_a_table_is_found_beside_views(spark, database, tmp_path, frame):
    write_snapshot(frame, f"{database}.t", AB, str(tmp_path / "t"))
    spark.sql(f"CREATE VIEW {database}.a_view AS SELECT 1 AS x")
    assert table_at(spark, str(tmp_path / "t"), database) == f"{database}.t"


def test_nested_names_are_quoted(spark, database, tmp_path):
    inner = T.StructType([T.StructField("a b", T.LongType()), T.StructField("c-d", T.ArrayType(struct(e=T.StringType())))])
    schema = T.StructType([T.StructField("s", inner)])
    df = spark.createDataFrame([((1, [("x",)]),)], schema)
    append_rows(df, f"{database}.t", schema, str(tmp_path / "t"))
    assert spark.table(f"{database}.t").select("s.`a b`", "s.`c-d`.e").collect() == [(1, ["x"])]


@pytest.mark.parametrize("at", range(1, 8))
def test_a_failure_while_registering_leaves_the_table(spark, database, tmp_path, frame, monkeypatch, at):
    table = f"{database}.t"
    write_snapshot(frame, table, AB, str(tmp_path / "t"), ["b"])
    before, real, calls = rows(spark, table), type(spark).sql, []

    def broken(self, text, *args, **kwargs):
        if text.startswith(("CREATE TABLE", "DROP", "MSCK", "ALTER")):
            calls.append(text)
            if len(calls) == at:
                raise ZeroDivisionError
        return real(self, text, *args, **kwargs)

    with monkeypatch.context() as lost:
        lost.setattr(type(spark), "sql", broken)
        try:
            write_snapshot(frame.filter("a < 3"), table, AB, str(tmp_path / "t"), ["b"])
            failed = False
        except ZeroDivisionError:
            failed = True
    assert failed == (len(calls) >= at)
    assert rows(spark, table) in (before, before[:2]) and (failed or rows(spark, table) == before[:2])
    write_snapshot(frame.filter("a < 3"), table, AB, str(tmp_path / "t"), ["b"])
    assert rows(spark, table) == [(1, "x"), (2, "y")]


def test_a_table_left_under_its_other_name_comes_back(spark, database, tmp_path, frame):
    table = f"{database}.t"
    write_snapshot(frame, table, AB, str(tmp_path / "t"))
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}__before")
    append_rows(frame, table, AB, str(tmp_path / "t"))
    assert spark.table(table).count() == 6


def test_rows_of_few_partitions_are_not_sorted_before_a_write(spark, database, tmp_path, monkeypatch):
    """More partitions than files are kept open for, in one task, also arrive; the session's setting comes back."""
    option, table, seen = "spark.sql.maxConcurrentOutputFileWriters", f"{database}.t", []
    insert, was = DataFrameWriter.insertInto, spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")

    def watched(self, *args, **kwargs):
        seen.append(int(spark.conf.get(option)))
        return insert(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "insertInto", watched)
    rows_ = spark.range(70).coalesce(1).select("id", (F.col("id") % 7).cast("string").alias("p"))
    schema = struct(id=T.LongType(), p=T.StringType())
    append_rows(rows_, table, schema, str(tmp_path / "t"), ["p"], one_value=True)
    append_rows(rows_, table, schema, str(tmp_path / "t"), ["p"])
    assert seen[0] > 1 and seen[1] == int(was) == int(spark.conf.get(option))
    found = spark.table(table).groupBy("id", "p").count()
    assert found.filter("count = 2 AND id % 7 = int(p)").count() == 70


def test_a_snapshot_of_one_value_is_not_shuffled(spark, database, tmp_path):
    rows_ = spark.range(0, 40, 1, 4).select("id", F.lit("a").alias("p"))
    write_snapshot(rows_, f"{database}.t", struct(id=T.LongType(), p=T.StringType()), str(tmp_path / "t"), ["p"], one_value=True)
    assert spark.table(f"{database}.t").count() == 40 and len(spark.table(f"{database}.t").inputFiles()) == 4
