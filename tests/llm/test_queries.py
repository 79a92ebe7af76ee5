"""The registered queries: against their SQL, over edge cases, empty tables, and again."""

import pytest

import checks.compare as compare
from oreflow.llm.queries import QUERIES
from oreflow.llm.sql import ORACLES
from tests.llm.conftest import SMALL

OTHERS = ("op4_html_extraction", "op8_url_filters", "op12_nearest_neighbours", "op13_conversation_trie")
DOCS = sorted(name for name in QUERIES if name not in OTHERS)
# Columns whose values follow from the number of a task, not from the rows.
FREE = {"op5_sequence_packing": ["sequence_id", "offset", "start", "length", "ids_crc32"]}


def rows(df, *drop):
    return sorted((str(r) for r in df.drop(*drop).collect()), key=str)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, monkeypatch, name):
    monkeypatch.setattr(compare, "QUERIES", QUERIES)
    monkeypatch.setattr(compare, "ORACLES", ORACLES)
    assert compare.differences(spark, SMALL, name, compare.connect(SMALL)) is None


@pytest.mark.parametrize("name", ["op10_quality_rules", "op11_merkle_manifest"])
def test_matches_sql_on_edge_cases(spark, edge_dir, name):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{edge_dir}/documents.parquet/*.parquet')")
    got = QUERIES[name](spark, edge_dir)
    con.execute(ORACLES[name])
    names = [d[0] for d in con.description]
    assert sorted(map(str, map(tuple, got.select(*names).collect()))) == sorted(map(str, con.fetchall()))


def test_quality_matches_sql_in_all_scripts(spark, tmp_path):
    """Texts in scripts without case or spaces, alone and mixed, near the limits of the rules on words' shape."""
    import duckdb
    import random

    rand = random.Random(6)
    scripts = [(97, 122), (65, 90), (0x430, 0x44F), (0x628, 0x63A), (0x5D0, 0x5EA), (0x915, 0x939), (0xAC00, 0xD7A3), (0x4E00, 0x9FA5),
               (0xE01, 0xE2E), (0x3041, 0x3096), (0x1000, 0x102A), (0xAA, 0xBA), (0x3000, 0x303F), (0x1F600, 0x1F64F), (48, 57)]
    texts = []
    for k in range(400):
        some = rand.sample(scripts, rand.randint(1, 3))
        longest = rand.choice([1, 3, 6, 30, 80])
        words = ["".join(chr(rand.randint(*rand.choice(some))) for _ in range(rand.randint(1, longest))) for _ in range(rand.randint(8, 40))]
        texts.append(rand.choice([" ", "\n"]).join(words))
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    got = QUERIES["op10_quality_rules"](spark, str(tmp_path))
    con.execute(ORACLES["op10_quality_rules"])
    names = [d[0] for d in con.description]
    theirs = sorted(map(str, con.fetchall()))
    assert sorted(map(str, map(tuple, got.select(*names).collect()))) == theirs
    assert 40 < sum("True)" in row for row in theirs) < 360


def test_measures_of_late_rules_are_taken_where_the_cascade_gets_to_them(spark):
    plan = QUERIES["op10_quality_rules"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    top, *below = plan.split("- Project")
    assert "Ll" in top and "Thai" in top and below and not any("Ll" in part or "Thai" in part for part in below)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, empty_dir, name):
    df = QUERIES[name](spark, empty_dir)
    assert df.columns and df.collect() == []


@pytest.mark.parametrize("name", DOCS)
def test_every_row_has_a_result_and_reruns_agree(spark, edge_dir, docs_of, name):
    first = QUERIES[name](spark, edge_dir)
    if name != "op5_sequence_packing":
        assert first.count() == len(docs_of)
    again = QUERIES[name](spark, edge_dir)
    assert rows(first, *FREE.get(name, [])) == rows(again, *FREE.get(name, []))
