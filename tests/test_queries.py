"""Every registered query against its SQL, and the agreed row counts."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import connect, differences
from checks.queries import ORACLES, QUERIES

SMALL = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
COUNTED = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert differences(spark, SMALL, name, con) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    rows = {r["status"]: r["n"] for r in entry(spark).collect()}
    assert set(rows) == {"loaded", "quarantined"} and all(rows.values())


ROWS = {
    "flatten_records": 15300,
    "clean_budget_only": 12168,
    "quarantine_budget_only": 2973,
    "clean_strict": 11167,
    "quarantine_strict": 3987,
    "unrouted": 146,
    "status_after_merge": 3,
    "repair_rows": 3987,
    "repair_int_cast": 3919,
    "item_dimension": 1678,
    "record_item_junction": 47489,
    "language_dimension": 3,
    "document_languages": 4,
    "sorted_junction": 61176,
    "json_envelope_roundtrip": 15300,
    "stamp_bronze": 15300,
    "struct_key_merge": 15300,
    "record_key_merge": 15300,
    "partitioned_roundtrip": 15300,
    "append_batches": 15300,
    "blank_name_filter": 51362,
    "movie_table": 15300,
}


@pytest.mark.parametrize("name", sorted(ROWS))
def test_row_count(spark, name):
    assert queries()[name](spark, COUNTED).count() == ROWS[name]


def test_profile_and_distinct_counts(spark):
    counts = queries()["profile_counts"](spark, COUNTED).first()
    assert (counts["n"], counts["n_with_values"]) == (15300, 15300)
    assert queries()["drop_all_null"](spark, COUNTED).first()["n_budget"] == 15141
    assert queries()["dedup_rows"](spark, COUNTED).first()["n"] == 15000
    by_status = {r["status"]: r["n"] for r in queries()["status_after_merge"](spark, COUNTED).collect()}
    assert by_status == {"loaded": 11167, "quarantined": 3987, "new": 146}
