"""Large documents, split at their records."""

import gzip
import json
import random

import pytest

from oreflow.plans import bronze_to_silver
from oreflow.sources.large import document_records
from tests.test_plans import CHEAP, GOOD, run  # noqa: F401


def records(n, seed=0):
    rand = random.Random(seed)
    words = ['a"b', "}{", "][", "\\", '\\"', "é😀", "line\nbreak", "x}", "", '{"Id": 1}', "\\\\}", "tab\t", " "]
    return [
        {"Id": k, "Title": rand.choice(words) + rand.choice(words), "Overview": "".join(rand.choices(words, k=rand.randint(0, 6))),
         "genres": [{"id": i, "name": rand.choice(words)} for i in range(rand.randint(0, 3))], "more": {"deep": [[{}], {"}": []}]}}
        for k in range(n)
    ]


STYLES = {
    "compact": lambda r: json.dumps({"movie": r}, separators=(",", ":"), ensure_ascii=False),
    "pretty": lambda r: json.dumps({"movie": r}, indent=2, ensure_ascii=False),
    "escaped": lambda r: json.dumps({"movie": r}, indent=None),
    "fields": lambda r: json.dumps({"name": 'the "movie": [', "tags": ["}", 1], "movie": r, "rest": [1, "}"]}),
    "windows": lambda r: json.dumps({"movie": r}, indent=1).replace("\n", "\r\n"),
}


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("style", sorted(STYLES))
def test_records_are_those_of_the_document(spark, tmp_path, small_blocks, style):
    some = {f"{k} x.json": records(n, k) for k, n in enumerate((40, 1, 0, 25))}
    for name, rows in some.items():
        (tmp_path / name).write_text(STYLES[style](rows))
    assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 8
    got = document_records(spark, str(tmp_path), "movie", f"{tmp_path}-pieces").collect()
    values = sorted((json.loads(r["value"]) for r in got), key=str)
    assert values == sorted((m for rows in some.values() for m in rows), key=str)


def test_text_is_not_shuffled_but_at_the_ends_of_blocks(spark, tmp_path, small_blocks):
    """Whatever the batches that Arrow cuts a block into."""
    (tmp_path / "a.json").write_text(STYLES["pretty"](records(40, 5)))
    (tmp_path / "b.json.gz").write_bytes(gzip.compress(STYLES["compact"](records(30, 6)).encode()))
    blocks = spark.read.option("lineSep", "}").text(str(tmp_path)).select("_metadata.file_path", "_metadata.file_block_start").distinct().count()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = document_records(spark, str(tmp_path), "movie", f"{tmp_path}-pieces").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    values = sorted((json.loads(r["value"]) for r in got), key=str)
    assert values == sorted([*records(40, 5), *records(30, 6)], key=str)
    kinds = {r[0]: r[1] for r in spark.read.parquet(f"{tmp_path}-pieces").groupBy("kind").count().collect()}
    assert kinds["record"] > 40 and kinds["part"] <= 2 * blocks


def test_documents_that_break_off_give_their_records_so_far(spark, tmp_path, small_blocks):
    text = STYLES["pretty"](records(10, 3))
    (tmp_path / "a.json").write_text(text[: len(text) * 2 // 3])
    got = [json.loads(r["value"]) for r in document_records(spark, str(tmp_path), "movie", f"{tmp_path}-pieces").collect()]
    assert 4 <= len(got) < 10 and all(m in records(10, 3) for m in got)


def test_documents_with_other_objects_are_refused(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"about": {"n": 1}, "movie": [{"Id": 1}]}')
    with pytest.raises(ValueError, match="other objects"):
        document_records(spark, str(tmp_path), "movie", f"{tmp_path}-pieces")


def test_a_run_that_splits_its_documents(run, spark, small_blocks):
    movies = [{**GOOD, "Id": i, "Title": "} {", "genres": [{"id": 1, "name": "x", "slug": "}"}]} for i in range(50)]
    report = run.ingest([*movies, CHEAP], split=True)
    assert report["records"] == 51 and report["rejected"] == 0
    whole = run.rows("bronze", "movie.Id", "extra", "record_key")
    bronze_to_silver(spark, run.cfg)
    assert len(run.rows("silver", "Id")) == 50
    run.ingest([*movies, CHEAP], batch="whole", reset=True)
    assert run.rows("bronze", "movie.Id", "extra", "record_key") == whole
