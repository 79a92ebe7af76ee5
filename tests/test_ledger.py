"""Increments of raw files by a ledger."""

import json
import os
import shutil
from dataclasses import replace

import pytest

import oreflow.plans.layers as layers
from oreflow.plans import raw_to_bronze
from tests.test_plans import AT_FLOOR, CHEAP, GOOD, NO_BUDGET, run  # noqa: F401


class Feed:
    def __init__(self, run, spark):
        self.run, self.spark, self.folder = run, spark, run.root / "feed"
        self.folder.mkdir()

    def put(self, name, *movies, time=None, indent=1):
        file = self.folder / name
        file.write_text(json.dumps({"movie": list(movies)}, indent=indent))
        if time is not None:
            os.utime(file, (time, time))
        return file

    def load(self, batch, **options):
        self.run.cfg = replace(self.run.settings(batch=batch), raw=str(self.folder), ledger=True, **options)
        return raw_to_bronze(self.spark, self.run.cfg)

    def ids(self):
        return sorted(r[0] for r in self.run.table("bronze").select("movie.Id").collect())


@pytest.fixture
def feed(run, spark):
    return Feed(run, spark)


def test_late_files_are_read_and_files_sent_again_are_not(feed):
    first = feed.put("a b+c%.json", GOOD)
    feed.put("b.json", CHEAP)
    assert feed.load("1")["records"] == 2
    feed.put("late.json", AT_FLOOR, time=86400)  # its time is long before the first run
    os.utime(first)  # sent again: another time
    shutil.copy(feed.folder / "b.json", feed.folder / "again.json")  # and under another name
    assert feed.load("2")["records"] == 1
    assert feed.load("3") == {"documents": 0, "rejected": 0, "records": 0}
    assert feed.ids() == [1, 2, 3]
    feed.put("b.json", CHEAP, NO_BUDGET)  # another content under a known name
    assert feed.load("4")["records"] == 2 and feed.ids() == [1, 2, 3, 3, 5]


def test_a_run_that_fails_has_read_nothing(feed, monkeypatch):
    feed.put("a.json", GOOD)
    feed.load("1")
    feed.put("b.json", CHEAP)
    with monkeypatch.context() as patch:
        patch.setattr(layers, "stamp", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            feed.load("2")
    assert feed.load("3")["records"] == 1 and feed.ids() == [1, 3]


def test_a_batch_run_again_reads_its_files_again(feed):
    feed.put("a.json", GOOD)
    feed.load("1")
    feed.put("b.json", CHEAP)
    feed.load("2")
    assert feed.load("2")["records"] == 1 and feed.ids() == [1, 3]
    assert feed.load("1")["records"] == 1 and feed.ids() == [1, 3]
    assert feed.load("4")["records"] == 0


def test_lines_and_empty_files(feed):
    (feed.folder / "a.json").write_text("\n".join(json.dumps({"movie": [m]}) for m in (GOOD, CHEAP)))
    (feed.folder / "none.json").write_text("")
    assert feed.load("1", multiline=False)["records"] == 2
    (feed.folder / "none2.json").write_text("")
    assert feed.load("2", multiline=False)["records"] == 0 and feed.ids() == [1, 3]
