"""Whole runs over small hand-written files."""

import datetime as dt
import json
import random
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import oreflow.plans.status as status_plans
from oreflow import Settings
from oreflow.operators import stamp
from oreflow.plans import (
    bronze_to_silver,
    build_marts,
    raw_to_bronze,
    rebuild_silver,
    repair_quarantined,
    settle,
    update_status,
)
from oreflow.plans.counting import Counted
from oreflow.schemas import BRONZE, BRONZE_PARTS, MOVIE_COLUMNS, SILVER, shape, struct
from oreflow.sinks import append_rows, free_unused
from oreflow.sources.tables import location_of

GOOD = {
    "Id": 1, "Title": "One", "Budget": 2e6, "RunTime": 90, "OriginalLanguage": "en",
    "CreatedDate": "2021-04-03T16:51:30.1633333", "genres": [{"id": 1, "name": " Drama "}, {"id": 2, "name": " "}],
}
AT_FLOOR = {"Id": 2, "Budget": 1e6, "RunTime": 0, "OriginalLanguage": "fr", "genres": [{"id": 1, "name": "Play"}]}
CHEAP = {"Id": 3, "Budget": 10.5, "RunTime": 80, "genres": [{"id": 9, "name": "Low"}]}
BACKWARDS = {"Id": 4, "Budget": 3e9 + 0.5, "RunTime": -70, "CreatedDate": "soon"}
NO_BUDGET = {"Id": 5, "RunTime": 60, "genres": []}
NO_RUNTIME = {"Id": 6, "Budget": 5e6}
ALL = [GOOD, AT_FLOOR, CHEAP, BACKWARDS, NO_BUDGET, NO_RUNTIME]


class Run:
    def __init__(self, spark, database, root):
        self.spark, self.database, self.root, self.files = spark, database, root, 0

    def settings(self, day=1, **options):
        when = dt.datetime(2024, 1, day)
        return Settings(
            root=str(self.root), raw=str(self.root / f"raw-{self.files}"), datasource="here",
            database=self.database, batch_ts=when, **options,
        )

    def ingest(self, *documents, day=1, reset=False, **options):
        self.files += 1
        folder = self.root / f"raw-{self.files}"
        folder.mkdir()
        for i, movies in enumerate(documents):
            text = movies if isinstance(movies, str) else json.dumps({"movie": movies}, indent=1)
            (folder / f"{i}.json").write_text(text)
        self.cfg = self.settings(day, **options)
        return raw_to_bronze(self.spark, self.cfg, reset)

    def table(self, layer):
        return self.spark.table(self.cfg.table(layer))

    def rows(self, layer, *cols):
        return sorted((tuple(r) for r in self.table(layer).select(*cols).collect()), key=str)

    def statuses(self):
        return Counter((r[0], r[1]) for r in self.table("bronze").select("movie.Id", "status").collect())


@pytest.fixture
def run(spark, database, tmp_path):
    return Run(spark, database, tmp_path)


def test_a_full_run(run, spark):
    assert run.ingest(ALL, [GOOD, CHEAP]) == {"documents": 2, "rejected": 0, "records": 8}
    assert shape(run.table("bronze").schema) == shape(BRONZE)
    assert set(run.statuses()) == {(i, "new") for i in range(1, 7)}

    report = bronze_to_silver(spark, run.cfg)
    assert report["n"] == 8 == report["clean"] + report["quarantine"] + report["unrouted"]
    assert (report["clean"], report["quarantine"], report["unrouted"]) == (3, 3, 2)
    assert shape(run.table("silver").schema) == shape(SILVER)
    assert run.rows("silver", "Id", "CreatedDate") == [(1, dt.date(2021, 4, 3))] * 2 + [(2, None)]
    assert run.statuses() == {
        (1, "loaded"): 2, (2, "loaded"): 1, (3, "quarantined"): 2,
        (4, "quarantined"): 1, (5, "quarantined"): 1, (6, "quarantined"): 1,
    }

    build_marts(spark, run.cfg)
    assert tuple(run.table("movie").columns) == MOVIE_COLUMNS
    assert run.rows("movie", "Id") == [(1,), (1,), (2,)]
    assert run.rows("genre", "id", "name") == [(1, "Drama"), (1, "Play")]
    assert run.rows("language", "code", "name") == [("en", "English"), ("fr", "English")]
    assert run.rows("movie_genre", "movie_id", "genres_id") == [(1, 1), (1, 2), (2, 1)]

    assert repair_quarantined(spark, run.cfg) == 0
    assert {status for _, status in run.statuses()} == {"loaded"}
    assert run.rows("silver", "Id", "Budget", "RunTime")[3:] == [
        (3, 1e6, 80), (3, 1e6, 80), (4, 3e9, 70), (5, 1e6, 60), (6, 5e6, None),
    ]
    before = [run.rows(t, "*") for t in ("silver", "movie", "genre", "language", "movie_genre")]
    assert bronze_to_silver(spark, run.cfg)["n"] == 0 and repair_quarantined(spark, run.cfg) == 0
    assert run.rows("silver", "*") == before[0]
    build_marts(spark, run.cfg)
    build_marts(spark, run.cfg)
    assert run.rows("genre", "*") == before[2] and run.rows("movie_genre", "*") == before[4]
    assert len(run.rows("movie", "Id")) == 8


def test_batches_add_up_and_leave_other_days_alone(run, spark):
    run.ingest([GOOD], day=1)
    bronze_to_silver(spark, run.cfg)
    first = {f for f in run.table("bronze").inputFiles()}
    run.ingest([AT_FLOOR, CHEAP], day=2)
    bronze_to_silver(spark, run.cfg)
    assert first < set(run.table("bronze").inputFiles())
    assert run.rows("bronze", "movie.Id", "status", "p_ingestdate") == [
        (1, "loaded", dt.date(2024, 1, 1)), (2, "loaded", dt.date(2024, 1, 2)),
        (3, "quarantined", dt.date(2024, 1, 2)),
    ]
    assert run.rows("silver", "Id") == [(1,), (2,)]


def test_a_repaired_record_that_comes_again(run, spark):
    run.ingest([CHEAP, GOOD], day=1)
    bronze_to_silver(spark, run.cfg)
    repair_quarantined(spark, run.cfg)
    run.ingest([CHEAP, AT_FLOOR], day=2)
    bronze_to_silver(spark, run.cfg)
    # the copy from the first day stays loaded: its row is in silver
    assert run.statuses() == {(1, "loaded"): 1, (2, "loaded"): 1, (3, "loaded"): 1, (3, "quarantined"): 1}
    assert run.rows("silver", "Id") == [(1,), (2,), (3,)]
    repair_quarantined(spark, run.cfg)
    once = run.rows("silver", "*")
    assert run.rows("silver", "Id") == [(1,), (2,), (3,), (3,)]
    rebuild_silver(spark, run.cfg)
    assert run.rows("silver", "*") == once


def test_repair_leaves_copies_that_are_still_new(run, spark):
    run.ingest([CHEAP], day=1)
    bronze_to_silver(spark, run.cfg)
    run.ingest([CHEAP, GOOD], day=2)
    assert repair_quarantined(spark, run.cfg) == 0
    assert run.statuses() == {(3, "loaded"): 1, (3, "new"): 1, (1, "new"): 1}
    bronze_to_silver(spark, run.cfg)
    assert run.statuses() == {(3, "loaded"): 1, (3, "quarantined"): 1, (1, "loaded"): 1}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_settling_at_random(run, spark, seed):
    """Random copies of a few records at random statuses and days, null records among them."""
    rand = random.Random(seed)
    cfg = run.settings()
    table, path = cfg.table("bronze"), cfg.path("bronze")
    payload = BRONZE["movie"].dataType
    records = [None] + [{"Id": i, "Budget": rand.choice([None, 5.0, 2e6])} for i in range(6)]
    for day in (1, 2, 3, 4):
        movies = [(rand.choice(records), rand.choice(["new", "new", "loaded", "quarantined"])) for _ in range(6)]
        rows = spark.createDataFrame(movies, struct(movie=payload, status=T.StringType()))
        for status in ("new", "loaded", "quarantined"):
            part = stamp(rows.filter(F.col("status") == status), "movie", "here", dt.datetime(2024, 1, day))
            append_rows(part.withColumn("status", F.lit(status)), table, BRONZE, path, BRONZE_PARTS, True)

    def facts():
        rows = spark.table(table).select("movie.Id", "movie.Budget", "status", "p_ingestdate")
        return Counter(tuple(r) for r in rows.collect())

    for at, mark in (("new", "l"), ("quarantined", "r")):
        rules = F.when(F.col("movie.Budget") >= 1e6, "loaded").when(F.col("movie.Budget") < 1e6, "quarantined")
        expected = Counter()
        for (key, budget, status, day), n in facts().items():
            if status == at and key is not None:
                good = "loaded" if budget is None or budget >= 1e6 else "quarantined"
                status = "loaded" if at == "quarantined" else status if budget is None else good
            expected[key, budget, status, day] += n
        settle(spark, table, at, rules if at == "new" else F.lit("loaded"), mark)
        assert facts() == expected
        assert not settle(spark, table, at, rules if at == "new" else F.lit("loaded"), mark)


def test_a_batch_writes_only_its_own_rows(run, spark, monkeypatch):
    run.ingest([{**GOOD, "Id": i} for i in range(20)], day=1, batch="a")
    bronze_to_silver(spark, run.cfg)
    place = location_of(spark, run.cfg.table("bronze")).removeprefix("file:")
    written = []
    real = status_plans.insert_rows
    monkeypatch.setattr(status_plans, "insert_rows", lambda df, *a, **k: (written.append(df.count()), real(df, *a, **k)))
    before = set(run.table("bronze").inputFiles())
    run.ingest([CHEAP], day=1, batch="b")
    bronze_to_silver(spark, run.cfg)
    after = set(run.table("bronze").inputFiles())
    assert written == [1] and before < after
    assert all(f"{place}/p_ingestdate=2024-01-01/batch=" in file for file in after)
    assert len(run.rows("bronze", "status")) == 21


def test_steps_may_be_run_again(run, spark, monkeypatch):
    """After the driver is lost between the two writes of a step, or before the old partitions go."""
    run.ingest([GOOD, CHEAP, NO_RUNTIME], day=1, unrouted="keep")
    for step in (bronze_to_silver, repair_quarantined):
        for lost in ("insert_rows", "drop_partitions"):
            with monkeypatch.context() as patch:
                real, calls = getattr(status_plans, lost), []

                def broken(*args, **kwargs):
                    calls.append(1)
                    if lost == "insert_rows" or len(calls) == 2:
                        raise ZeroDivisionError
                    return real(*args, **kwargs)

                patch.setattr(status_plans, lost, broken)
                with pytest.raises(ZeroDivisionError):
                    step(spark, run.cfg)
        step(spark, run.cfg)
        step(spark, run.cfg)
    assert run.statuses() == {(1, "loaded"): 1, (3, "loaded"): 1, (6, "new"): 1}
    assert run.rows("silver", "Id") == [(1,), (3,)]
    raw_to_bronze(spark, run.cfg)
    assert run.statuses() == {(1, "new"): 1, (3, "new"): 1, (6, "new"): 1}
    assert run.rows("silver", "Id") == []


def test_batches_may_have_odd_names(run, spark):
    for name in ("2024-05-01T10:00", "a/b='c' %25 é"):
        for _ in range(2):
            run.ingest([GOOD, CHEAP], batch=name)
            bronze_to_silver(spark, run.cfg)
            repair_quarantined(spark, run.cfg)
    assert run.rows("silver", "Id", "batch") == sorted(
        [(i, b) for i in (1, 3) for b in ("2024-05-01T10:00", "a/b='c' %25 é")], key=str
    )
    assert run.statuses() == {(1, "loaded"): 2, (3, "loaded"): 2}


def test_unlisted_fields_are_kept(run, spark):
    movies = [{**GOOD, "Studio": {"a": 1}}, {**GOOD, "Studio": {"a": 2}}, GOOD]
    run.ingest(movies, day=1)
    assert run.rows("bronze", "extra") == [('{"Studio":{"a":1}}',), ('{"Studio":{"a":2}}',), (None,)]
    assert run.table("bronze").select("record_key").distinct().count() == 3
    plain = {bytes(r[0]) for r in run.table("bronze").filter("extra is null").select("record_key").collect()}
    run.ingest([GOOD], day=2, extra_fields="ignore")
    assert plain >= {bytes(r[0]) for r in run.table("bronze").filter("p_ingestdate = '2024-01-02'").select("record_key").collect()}
    more = T.StructType([T.StructField("Studio", struct(a=T.LongType()))])
    run.ingest(movies[:1], day=3, record=more)
    assert len(run.rows("bronze", "extra")) == 5
    with pytest.raises(ValueError):
        run.ingest([GOOD], day=4, extra_fields="lose")


def test_update_status_by_key(run, spark):
    run.ingest([GOOD, CHEAP], day=1)
    run.ingest([GOOD, AT_FLOOR], day=2)
    run.ingest([NO_BUDGET], day=3)
    table = run.cfg.table("bronze")
    untouched = spark.table(table).filter("p_ingestdate = date '2024-01-03'").inputFiles()
    source = spark.table(table).filter("movie.Id = 1 and p_ingestdate = date '2024-01-01'")
    assert update_status(spark, table, source, "loaded")
    assert run.statuses() == {(1, "loaded"): 2, (2, "new"): 1, (3, "new"): 1, (5, "new"): 1}
    assert not update_status(spark, table, source, "loaded")
    assert spark.table(table).filter("p_ingestdate = date '2024-01-03'").inputFiles() == untouched


def test_options(run, spark):
    run.ingest(ALL, rules="budget_only", unrouted="keep")
    bronze_to_silver(spark, run.cfg)
    assert run.statuses() == {
        (1, "loaded"): 1, (2, "loaded"): 1, (3, "quarantined"): 1, (4, "loaded"): 1, (5, "new"): 1, (6, "loaded"): 1,
    }
    with pytest.raises(ValueError):
        bronze_to_silver(spark, run.settings(rules="none"))


def test_silver_partitioned_by_a_column_with_nulls(run, spark):
    dated = {**GOOD, "UpdatedDate": "2020-02-03"}
    run.ingest([dated, AT_FLOOR, CHEAP], silver_partition_by=("UpdatedDate",))
    bronze_to_silver(spark, run.cfg)
    repair_quarantined(spark, run.cfg)
    assert run.rows("silver", "Id", "UpdatedDate") == [(1, dt.date(2020, 2, 3)), (2, None), (3, None)]


def test_reset_replaces_bronze_and_rejects(run, spark):
    run.ingest([GOOD], '{"movie": [{"Id"', day=1)
    run.ingest([CHEAP], '{"movie": [{"Id": 8, "Bud', day=2, reset=True)
    assert run.statuses() == {(3, "new"): 1} and run.table("rejects").count() == 1
    run.ingest([CHEAP], day=3, reset=True)
    assert run.table("rejects").count() == 0


def test_cleanup_keeps_every_row(run, spark):
    for day in (1, 2, 3):
        run.ingest([GOOD, CHEAP], day=day, reset=day == 3)
        bronze_to_silver(spark, run.cfg)
        build_marts(spark, run.cfg)
    layers_of = ("bronze", "silver", "movie", "genre")
    before = [run.rows(layer, "*") for layer in layers_of]
    gone = [free_unused(spark, run.cfg.table(layer), run.cfg.path(layer)) for layer in layers_of]
    assert len(gone[0]) == 1 and len(gone[2]) == 2
    assert [run.rows(layer, "*") for layer in layers_of] == before
    assert run.settings().raw_path and (run.root / f"raw-{run.files}" / "0.json").exists()
    assert [free_unused(spark, run.cfg.table(layer), run.cfg.path(layer)) for layer in layers_of] == [[]] * 4


def test_rejects_have_the_date_of_their_batch(run, spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Kiritimati")
    try:
        for day, late in ((1, True), (2, False)):
            run.files += 1
            folder = run.root / f"raw-{run.files}"
            folder.mkdir()
            (folder / "a.json").write_text(json.dumps({"movie": [GOOD]}))
            (folder / "b.json").write_text('{"movie": [{"Id"')
            run.cfg = run.settings(day)
            run.cfg = replace(run.cfg, batch_ts=dt.datetime(2024, 1, day, 23, 59) if late else None)
            raw_to_bronze(spark, run.cfg)
        assert {r[0] for r in run.table("rejects").select("p_ingestdate").collect()} == {
            r[0] for r in run.table("bronze").select("p_ingestdate").collect()
        }
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_broken_files_are_reported_once_per_batch(run, spark):
    report = run.ingest([GOOD], '{"movie": [{"Id": 7, "Bud', '{"movie": [{"Id": 8, "Budget": []}, {"Id": 9, "Budget": 2e6}]}')
    assert (report["rejected"], report["records"]) == (2, 3)
    assert sorted(r["reason"] for r in run.table("rejects").collect()) == ["partial", "unparsed"]
    assert set(run.statuses()) == {(1, "new"), (8, "new"), (9, "new")}


def test_a_run_whose_counts_do_not_arrive(run, spark, monkeypatch):
    monkeypatch.setattr(Counted, "counts", lambda self: None)
    report = run.ingest([GOOD, CHEAP], '{"movie": [{"Id": 7, "Bud')
    assert report == {"documents": None, "rejected": None, "records": 2}
    assert run.table("rejects").count() == 1
    assert bronze_to_silver(spark, run.cfg) == {}
    assert run.statuses() == {(1, "loaded"): 1, (3, "quarantined"): 1}


def test_json_lines_run(run, spark):
    lines = "\n".join(json.dumps({"movie": [movie]}) for movie in (GOOD, CHEAP)) + '\n{"movie": [{"Id":'
    report = run.ingest(lines, multiline=False)
    assert report == {"documents": 3, "rejected": 1, "records": 2}
    assert [r["record"] for r in run.table("rejects").collect()] == ['{"movie": [{"Id":']
    bronze_to_silver(spark, run.cfg)
    assert run.rows("silver", "Id") == [(1,)]


def test_records_of_one_file_can_be_spread(run, spark):
    movies = [{**GOOD, "Id": i, "Overview": f"{i * 7919 % 104729}" * 20} for i in range(2000)]
    run.ingest(movies)
    assert len(run.table("bronze").inputFiles()) == 1
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "10k")
    try:
        assert run.ingest(movies, reset=True, spread=True)["records"] == 2000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    assert len(run.table("bronze").inputFiles()) > 2
    assert run.table("bronze").select("movie.Id").distinct().count() == 2000


def test_null_records_stay_new(run, spark):
    run.ingest('{"movie": [null]}', [GOOD])
    bronze_to_silver(spark, run.cfg)
    assert run.statuses() == {(None, "new"): 1, (1, "loaded"): 1}


def test_counts_that_never_arrive_are_not_counted_again(spark):
    df = spark.range(5)
    columns = [F.count(F.lit(1)).alias("n"), F.sum(F.lit(None).cast("int")).alias("nothing")]
    assert Counted(df, columns, patience=0.2).counts() is None
    counted = Counted(df, columns)
    assert counted.rows.filter("id < 2").count() == 2
    assert counted.counts() == {"n": 5, "nothing": 0}


def test_no_files_at_all(run, spark):
    assert run.ingest([])["records"] == 0
    assert bronze_to_silver(spark, run.cfg)["n"] == 0
    build_marts(spark, run.cfg)
    assert repair_quarantined(spark, run.cfg) == 0
    assert run.rows("genre", "*") == []
