"""Edge rows, one operator at a time."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.functions import as_date, as_int, magnitude, record_key, whole
from oreflow.operators import (
    budget_only,
    code_dimension,
    dimension,
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
)
from oreflow.schemas import BRONZE, RECORD, shape, struct

ITEMS = T.ArrayType(struct(id=T.LongType(), name=T.StringType()))


def test_dates_and_numbers(spark):
    df = spark.createDataFrame(
        [("2021-04-03T16:51:30.1633333",), ("not a date",), (None,)], "t string"
    ).select(as_date(F.col("t")))
    assert [r[0] for r in df.collect()] == [dt.date(2021, 4, 3), None, None]
    df = spark.createDataFrame([(3e9,), (2.7,), (-2.7,), (None,), (1e300,)], "x double")
    rows = df.select(as_int(F.col("x")), whole(F.col("x")), magnitude(F.col("x"))).collect()
    assert [tuple(r) for r in rows] == [
        (None, 3e9, 3_000_000_000), (2, 2.0, 2), (-2, -2.0, 2), (None, None, None), (None, 1e300, None),
    ]
    smallest = spark.createDataFrame([(-(2**63),), (-(2**63) + 1,)], "x bigint")
    assert [r[0] for r in smallest.select(magnitude(F.col("x"))).collect()] == [None, 2**63 - 1]


def test_explode_drops_documents_without_records(spark):
    df = spark.createDataFrame([([1, 2],), ([],), (None,), ([None],)], "movie array<int>")
    assert sorted(explode_records(df, "movie", "m").collect(), key=str) == [(1,), (2,), (None,)]


def test_stamp_gives_the_bronze_schema(spark):
    rows = spark.createDataFrame([], struct(movie=RECORD))
    stamped = stamp(rows, "movie", "here")
    assert shape(stamped.schema) == shape(BRONZE)
    nullable = {f.name: f.nullable for f in stamped.schema}
    assert [c for c, n in nullable.items() if n] == ["movie", "extra", "record_key"]


def test_stamp_is_repeatable_with_a_batch_time(spark):
    rows = spark.createDataFrame([((1.0,),)], "movie struct<Budget:double>")
    at = dt.datetime(2024, 2, 29, 23, 59, 59, 123456)
    one = stamp(rows, "movie", "here", at).first()
    assert (one["ingesttime"], one["p_ingestdate"], one["status"]) == (at, dt.date(2024, 2, 29), "new")


def test_flatten_names_ignore_case(spark):
    df = spark.createDataFrame([((1, "2020-01-02"),)], "movie struct<RunTime:bigint,CreatedDate:string>")
    row = flatten(df, "movie", ["runtime", "CreatedDate"], ["CreatedDate"]).first()
    assert tuple(row) == (1, dt.date(2020, 1, 2))


def test_explode_nested_keeps_the_parent(spark):
    df = spark.createDataFrame([(1, [(7, "a"), (8, None)]), (2, [])], struct(k=T.LongType(), items=ITEMS))
    assert sorted(map(tuple, explode_nested(df, "items", ["id", "name"], ["k"]).collect())) == [
        (1, 7, "a"), (1, 8, None),
    ]


EDGE = [  # budget, runtime, strict side, budget-only side
    (999_999.99, 5, "quarantine", "quarantine"),
    (1_000_000.0, 5, "clean", "clean"),
    (2_000_000.0, -5, "quarantine", "clean"),
    (None, 5, "unrouted", "unrouted"),
    (None, -5, "quarantine", "unrouted"),
    (2_000_000.0, None, "unrouted", "clean"),
    (5.0, None, "quarantine", "quarantine"),
    (None, None, "unrouted", "unrouted"),
]


@pytest.fixture
def edge(spark):
    rows = [(i, b, r) for i, (b, r, *_) in enumerate(EDGE)]
    return spark.createDataFrame(rows, "i int, Budget double, RunTime bigint")


@pytest.mark.parametrize("side, rules", [(2, strict), (3, budget_only)])
def test_routes(edge, side, rules):
    expected = [row[side] for row in EDGE]
    kept = route(edge, rules(), "keep").orderBy("i")
    assert [r["route"] for r in kept.collect()] == expected
    default = route(edge, rules()).orderBy("i")
    assert [r["route"] for r in default.collect()] == [e.replace("unrouted", "quarantine") for e in expected]
    for unrouted in ("keep", "quarantine"):
        good, bad = split(edge, rules(), unrouted)
        routes = [r["route"] for r in route(edge, rules(), unrouted).orderBy("i").collect()]
        assert sorted(r["i"] for r in good.collect()) == [i for i, r in enumerate(routes) if r == "clean"]
        assert sorted(r["i"] for r in bad.collect()) == [i for i, r in enumerate(routes) if r == "quarantine"]
    counts = profile(edge.drop("i"), rules()).first()
    assert counts["n"] == counts["clean"] + counts["quarantine"] + counts["unrouted"] == len(EDGE)
    assert counts["n_with_values"] == len(EDGE) - 1


def test_unknown_option_is_refused(edge):
    with pytest.raises(ValueError):
        route(edge, strict(), "drop")


def test_repair(edge):
    rows = repair(edge, ["RunTime"], {"Budget": 1_000_000}, ["Budget"]).orderBy("i").collect()
    assert all(r["Budget"] >= 1_000_000 for r in rows)
    assert [r["RunTime"] for r in rows] == [5, 5, 5, 5, 5, None, None, None]
    assert rows[2]["Budget"] == 2_000_000.0
    assert dict(repair(edge, ["RunTime"], {"Budget": 1}, ["Budget"]).dtypes)["Budget"] == "double"


def test_floor_survives_integer_overflow(spark):
    df = spark.createDataFrame([(3e9,)], "Budget double")
    assert repair(df, floors={"Budget": 1_000_000}, whole_cols=["Budget"]).first()[0] == 3e9


PAYLOAD = "movie struct<Id:bigint,Budget:double,genres:array<struct<id:bigint,name:string>>>"


def test_merge_updates_every_copy_and_keeps_the_row_count(spark):
    rows = [((1, None, [(1, None)]), "new")] * 3 + [((2, 5.0, None), "new"), (None, "new"), (None, "new")]
    target = spark.createDataFrame(rows, f"{PAYLOAD}, status string")
    source = spark.createDataFrame(
        [((1, None, [(1, None)]),), ((1, None, [(1, None)]),), ((9, 9.0, []),), (None,)], PAYLOAD
    )
    got = merge_status(target, source, "movie", "loaded")
    assert got.columns == target.columns
    assert sorted((r["movie"] and r["movie"]["Id"] or 0, r["status"]) for r in got.collect()) == [
        (0, "new"), (0, "new"), (1, "loaded"), (1, "loaded"), (1, "loaded"), (2, "new"),
    ]
    keyed = lambda df: df.withColumn("record_key", record_key(df, "movie"))
    by_key = merge_status(keyed(target), keyed(source), status="loaded").drop("record_key")
    assert sorted(map(str, by_key.collect())) == sorted(map(str, got.collect()))


def test_merge_takes_the_sources_own_status(spark):
    target = spark.createDataFrame([("a", "new"), ("b", "new"), ("c", "new")], "record_key string, status string")
    source = spark.createDataFrame([("a", "loaded"), ("a", "loaded"), ("b", "quarantined")], target.schema)
    got = merge_status(target, source).collect()
    assert sorted(map(tuple, got)) == [("a", "loaded"), ("b", "quarantined"), ("c", "new")]


def test_maps_are_refused_as_keys(spark):
    df = spark.createDataFrame([], "movie struct<m:map<string,int>>")
    with pytest.raises(TypeError):
        record_key(df, "movie")


def test_timestamps_keep_their_microseconds_in_the_key(spark):
    stamps = ["2024-01-01 00:00:00.000001", "2024-01-01 00:00:00.000002"]
    df = spark.createDataFrame([(s,) for s in stamps], "s string")
    kinds = [F.col("s").cast(kind).alias(kind) for kind in ("timestamp", "timestamp_ntz")]
    df = df.select(F.struct(*kinds).alias("m"))
    assert df.select(record_key(df, "m").alias("k")).distinct().count() == 2


doubles = st.one_of(st.none(), st.sampled_from([0.0, -0.0, 1.0, 0.1, 1e21, float("nan"), float("inf")]))
items = st.one_of(
    st.none(),
    st.lists(st.one_of(st.none(), st.tuples(st.sampled_from([None, 1]), st.sampled_from([None, "", '"']))), max_size=2),
)
payloads = st.one_of(st.none(), st.tuples(st.sampled_from([None, 0, 1]), doubles, items))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(payloads, min_size=20, max_size=40))
def test_keys_are_equal_exactly_when_records_are(spark, rows):
    df = spark.createDataFrame([(r,) for r in rows], PAYLOAD)
    df = df.withColumn("k", record_key(df, "movie"))
    a, b = df.toDF("ma", "ka"), df.toDF("mb", "kb")
    same, same_key = F.col("ma").eqNullSafe(F.col("mb")), F.col("ka").eqNullSafe(F.col("kb"))
    assert a.join(b, same != same_key).count() == 0


def test_dimension_and_junction(spark):
    rows = [
        (1, [(1, " Drama "), (2, "  "), (3, None), (None, "Lost"), (1, "Drama")]),
        (1, [(1, "Drama")]),
        (2, [(1, "Play"), (2, "")]),
        (3, []),
        (4, None),
    ]
    df = spark.createDataFrame(rows, struct(Id=T.LongType(), genres=ITEMS))
    names = dimension(df, "genres")
    assert sorted(map(tuple, names.collect())) == [(1, "Drama"), (1, "Play")]
    pairs = junction(df, "id", "genres.id")
    assert pairs.columns == ["movie_id", "genres_id"]
    assert set(map(tuple, pairs.collect())) == {(1, 1), (1, 2), (1, 3), (1, None), (2, 1), (2, 2)}
    assert pairs.count() == 6
    kept = junction(df, "id", "genres.id", within=names)
    assert sorted(map(tuple, kept.collect())) == [(1, 1), (2, 1)]


def test_tabs_are_not_trimmed(spark):
    df = spark.createDataFrame([([(1, "\t"), (2, " x\t")],)], struct(genres=ITEMS))
    assert sorted(map(tuple, dimension(df, "genres").collect())) == [(1, "\t"), (2, "x\t")]


def test_code_names(spark):
    df = spark.createDataFrame([("en",), ("fr",), ("en",), (None,)], "lang string")
    assert sorted(map(tuple, code_dimension(df, "lang", "English").collect()), key=str) == [
        ("en", "English"), ("fr", "English"), (None, "English"),
    ]
    names = spark.createDataFrame([("fr", "French"), ("de", "German")], "code string, name string")
    assert sorted(map(tuple, code_dimension(df, "lang", names).collect()), key=str) == [
        ("en", None), ("fr", "French"), (None, None),
    ]
