"""Marts kept up by batch, against marts rebuilt."""

import random

import pytest
from pyspark.sql import functions as F

import oreflow.plans.marts as marts
from oreflow.plans import bronze_to_silver, build_marts, raw_to_bronze, repair_quarantined, update_marts, update_status
from oreflow.schemas import MOVIE_COLUMNS
from tests.test_plans import AT_FLOOR, CHEAP, GOOD, run  # noqa: F401

NAMES = ("movie", "genre", "language", "movie_genre")


def rows(run):
    return [run.rows(name, "*") for name in NAMES]


def rebuilt(run, spark):
    """What a whole rebuild gives; the kept marts stay as they are."""
    out = {}
    for name, mart in marts.marts_of(run.cfg).items():
        made = mart.rows(marts._source(spark, run.cfg, mart))
        out[name] = sorted((tuple(r) for r in made.collect()), key=str)
    return [out[name] for name in NAMES]


def test_marts_follow_the_batches(run, spark):
    rand = random.Random(3)

    def movies(n):
        genres = [{"id": i, "name": f"g{i}"} for i in range(8)] + [{"id": None, "name": "x"}, {"id": 9, "name": " "}]
        return [
            {**GOOD, "Id": rand.randrange(20), "Budget": rand.choice([2e6, 2e6, 5.0]), "genres": rand.choices(genres, k=2),
             "OriginalLanguage": rand.choice(["en", "fr", None])}
            for _ in range(n)
        ]

    for name in "abc":
        run.ingest(movies(8), batch=name)
        bronze_to_silver(spark, run.cfg)
        report = update_marts(spark, run.cfg)
        assert report == {n: [1, 0] for n in NAMES} and rows(run) == rebuilt(run, spark)
    assert tuple(run.table("movie").columns) == MOVIE_COLUMNS
    assert update_marts(spark, run.cfg) == {n: [0, 0] for n in NAMES}
    repair_quarantined(spark, run.cfg)
    update_marts(spark, run.cfg)
    assert rows(run) == rebuilt(run, spark) and len(run.rows("movie", "Id")) == 24
    # a batch comes again with other records: what only it had goes
    run.ingest(movies(3), batch="b")
    bronze_to_silver(spark, run.cfg)
    report = update_marts(spark, run.cfg)
    assert report["movie"][1] >= 1 and rows(run) == rebuilt(run, spark)
    source = run.table("bronze").filter("batch = 'a'").limit(4)
    source = spark.createDataFrame(source.select("record_key").collect(), "record_key binary")
    update_status(spark, run.cfg.table("bronze"), source, "quarantined")
    update_marts(spark, run.cfg)
    assert rows(run) == rebuilt(run, spark)
    # and both ways of building may be mixed
    want = rows(run)
    build_marts(spark, run.cfg)
    assert rows(run) == want
    update_marts(spark, run.cfg)
    assert rows(run) == want


@pytest.mark.parametrize("lost", ["append_rows", "location_of", "_show"])
def test_an_update_may_be_stopped_anywhere(run, spark, monkeypatch, lost):
    run.ingest([GOOD, CHEAP], batch="a")
    bronze_to_silver(spark, run.cfg)
    update_marts(spark, run.cfg)
    run.ingest([AT_FLOOR, GOOD], batch="b")
    bronze_to_silver(spark, run.cfg)
    real = getattr(marts, lost)

    def stop(*args, **kwargs):
        real(*args, **kwargs)
        raise ZeroDivisionError

    with monkeypatch.context() as patch:
        patch.setattr(marts, lost, stop)
        with pytest.raises(ZeroDivisionError):
            update_marts(spark, run.cfg)
    update_marts(spark, run.cfg)
    assert rows(run) == rebuilt(run, spark)
    assert update_marts(spark, run.cfg) == {n: [0, 0] for n in NAMES}


def test_an_update_reads_the_new_batch_alone(run, spark, monkeypatch):
    seen = []
    real = marts._source
    monkeypatch.setattr(marts, "_source", lambda *a: Spy(real(*a), seen))
    for name in "abcd":
        run.ingest([{**GOOD, "Id": ord(name)}], batch=name)
        bronze_to_silver(spark, run.cfg)
        update_marts(spark, run.cfg)
    assert seen == [1] * 16


class Spy:
    """Notes how many files a filtered source reads."""

    def __init__(self, df, seen):
        self.df, self.seen = df, seen

    def filter(self, condition):
        some = self.df.filter(condition)
        self.seen.append(len(set(some.select(F.input_file_name().alias("f")).distinct().toPandas()["f"])))
        return some


def test_nothing_loaded_gives_empty_marts(run, spark):
    run.ingest([])
    bronze_to_silver(spark, run.cfg)
    update_marts(spark, run.cfg)
    assert rows(run) == [[], [], [], []]
    raw_to_bronze(spark, run.cfg)
