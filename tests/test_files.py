"""Raw files: good, broken and odd ones."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from checks import records as R
from checks.queries import QUERIES
from checks.records import write_documents
from oreflow.operators import explode_records
from oreflow.schemas import RAW
from oreflow.sources import peek_raw, raw_files, read_json_batch, split_rejects


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    good = {"movie": [{"Id": 1, "Budget": 1.5, "genres": [{"id": 7, "name": "a"}]}, {"Id": 2}]}
    (folder / "a.json").write_text(json.dumps(good, indent=2))
    (folder / "b.json").write_text('{"movie": [{"Id": 3, "Budget": "abc"}, {"Id": 4}]}')
    (folder / "c.json").write_text('{"movie": [{"Id": 5}, {"Id": 6')
    (folder / "d.json").write_text('{"movie": null}')
    (folder / "e.json").write_text('{"movie": []}')
    return str(folder)


def ids(df):
    return sorted(r[0] for r in explode_records(df, "movie", "m").select("m.Id").collect())


def test_rejects_are_reported_and_the_rest_is_kept(spark, raw):
    records, rejects = split_rejects(read_json_batch(spark, raw, RAW), "movie")
    assert ids(records) == [1, 2, 3, 4]
    found = {r["source_file"].rsplit("/", 1)[1]: (r["reason"], r["record"]) for r in rejects.collect()}
    assert {f: reason for f, (reason, _) in found.items()} == {"b.json": "partial", "c.json": "unparsed"}
    assert found["c.json"][1] == '{"movie": [{"Id": 5}, {"Id": 6'
    assert rejects.count() == 2


def test_paths_may_be_a_list(spark, raw):
    assert ids(read_json_batch(spark, [f"{raw}/a.json", f"{raw}/b.json"], RAW)) == [1, 2, 3, 4]


def test_inferred_schema(spark, raw):
    df = read_json_batch(spark, [f"{raw}/a.json"])
    assert ids(df) == [1, 2]
    records, rejects = split_rejects(df, "movie")
    assert ids(records) == [1, 2] and rejects.count() == 0


def test_json_lines(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"movie":[{"Id":1}]}\n{"movie":[{"Id":2}\n{"movie":[{"Id":3}]}\n')
    df = read_json_batch(spark, str(tmp_path / "x.json"), RAW, multiline=False)
    records, rejects = split_rejects(df, "movie")
    assert ids(records) == [1, 3]
    assert [r["record"] for r in rejects.collect()] == ['{"movie":[{"Id":2}']


def test_listing_reads_no_content(spark, raw):
    files = raw_files(spark, raw)
    assert sorted(r["path"].rsplit("/", 1)[1] for r in files.collect()) == [f"{c}.json" for c in "abcde"]
    assert "content:" not in files._jdf.queryExecution().executedPlan().toString()


def test_peek(spark, raw, tmp_path):
    assert peek_raw(spark, raw, 5).first()[0] == '{\n  "'
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        peek_raw(spark, str(tmp_path / "none"))


@pytest.mark.parametrize("files", [1, 3, 9])
def test_written_documents_are_one_array_per_file(spark, tmp_path, files):
    df = spark.range(5).select(F.struct(F.col("id").alias("Id"), F.lit('a"b\n').alias("Title")).alias("movie"))
    write_documents(df, "movie", str(tmp_path / "out"), files)
    found = [json.loads(p.read_text()) for p in (tmp_path / "out").glob("part-*")]
    assert sorted(r["Id"] for doc in found for r in doc["movie"]) == [0, 1, 2, 3, 4]
    assert ids(read_json_batch(spark, str(tmp_path / "out"), RAW)) == [0, 1, 2, 3, 4]


def test_peek_of_a_compressed_file(spark, tmp_path):
    (tmp_path / "a.json.gz").write_bytes(gzip.compress('{"movie": ["é"]}'.encode()))
    assert peek_raw(spark, str(tmp_path)).first()[0] == '{"movie": ["é"]}'
    assert peek_raw(spark, str(tmp_path), 13).first()[0] == '{"movie": ["é'


@pytest.fixture
def tables(spark, tmp_path):
    """Orders of two customers, one order without parts, a part in many orders, an order that comes twice."""
    folder = tmp_path / "tables"

    def write(name, rows):
        rows.write.parquet(f"{folder}/{name}.parquet")

    day = F.lit("2024-01-02").cast("timestamp").alias("o_orderdate")
    order = [F.lit(1e5).alias("o_totalprice"), day, F.lit("F").alias("o_orderstatus"), F.lit("1-URGENT").alias("o_orderpriority")]
    orders = spark.range(1, 121).union(spark.range(3, 4))
    write("orders", orders.select(F.col("id").alias("o_orderkey"), (F.col("id") % 2).alias("o_custkey"), *order))
    write("customer", spark.range(2).select(
        F.col("id").alias("c_custkey"), F.lit(5.5).alias("c_acctbal"), F.lit("X").alias("c_mktsegment"),
        F.concat(F.lit("C"), "id").alias("c_name")))
    write("part", spark.range(1, 4).select(F.col("id").alias("p_partkey"), F.concat(F.lit("p"), "id").alias("p_name")))
    lines = spark.range(1, 120).crossJoin(spark.range(1, 4).toDF("part"))
    write("lineitem", lines.select(F.col("id").alias("l_orderkey"), F.col("part").alias("l_partkey")))
    return str(folder)


def test_records_are_dealt_out_before_they_are_made(spark, tables, monkeypatch):
    monkeypatch.setattr(R, "PER_FILE", 10)
    rows = R.movies(spark, tables)
    exchanges = [x for x in rows._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange" in x]
    assert exchanges and not any("array_sort" in x or "struct" in x for x in exchanges)
    assert rows.rdd.getNumPartitions() == 12
    found = {}
    for row in rows.select("movie.Id", "movie.Title", "movie.genres").collect():
        found.setdefault(row["Id"], []).append((row["Title"], row["genres"] and [tuple(g) for g in row["genres"]]))
    parts = [(1, " p1  "), (2, " p2  "), (3, " p3  ")]
    assert {k: len(v) for k, v in found.items() if len(v) > 1} == {3: 2, 50: 2, 100: 2}
    assert found[120] == [("C0", None)] and len(found) == 120
    assert all(v[0] == (f"C{k % 2}", parts) for k, v in found.items() if k < 120)


def test_raw_documents_are_compressed_and_shuffled_once(spark, tables, monkeypatch):
    monkeypatch.setattr(R, "PER_FILE", 10)
    folder = R.documents(spark, tables, "movie")
    files = [row["path"] for row in raw_files(spark, folder).collect()]
    assert len(files) == 12 and all(path.endswith(".gz") for path in files)
    assert len(ids(read_json_batch(spark, folder, RAW))) == 123


@pytest.mark.parametrize("name, ids", [("unlisted_fields", range(1, 121)), ("unlisted_nested_fields", range(1, 120))])
def test_documents_that_a_query_does_not_read_are_not_written(spark, tables, monkeypatch, name, ids):
    def documents(*_):
        raise AssertionError(f"{name} reads files of its own")

    monkeypatch.setattr(R, "documents", documents)
    rows = QUERIES[name](spark, tables).collect()
    assert {row["Id"] for row in rows} == set(ids) and {row["n_keys"] for row in rows} == {2}
