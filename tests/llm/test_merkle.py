"""The Merkle manifest against plain trees."""

import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from oreflow.llm import merkle
from tests.llm.conftest import prose


def h(text):
    return sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row):
    return h("".join(field(row[c]) for c in merkle.FIELDS))


def tree(nodes):
    """The root, and every node's siblings level by level."""
    levels, ways = [nodes], [[] for _ in nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        for k in range(len(nodes)):
            at = k // 3 ** (len(levels) - 1)
            run = range(at // 3 * 3, min(at // 3 * 3 + 3, len(below)))
            ways[k].append(("".join(below[i] for i in run if i < at), "".join(below[i] for i in run if i > at)))
        levels.append([h("".join(below[k : k + 3])) for k in range(0, len(below), 3)])
    return levels[-1][0], ways


def plain(rows):
    """doc_id, leaf, subroot, root, proof of every row, sorted."""
    groups = {}
    for row in rows:
        groups.setdefault(row["source"], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        ordered = sorted(groups[name], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[name] = (ordered, *tree([leaf(r) for r in ordered]))
    root, above = tree([trees[name][1] for name in names])
    out = []
    for name, up in zip(names, above, strict=True):
        ordered, subroot, ways = trees[name]
        for row, way in zip(ordered, ways, strict=True):
            out.append((row["doc_id"], leaf(row), subroot, root, ",".join(f"{b}|{a}" for b, a in way + up)))
    return sorted(out, key=str)


def rows_of(spark, sizes):
    rand = random.Random(4)
    rows, k = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            k += 1
            rows.append((k * 7 % 1009, None if k % 11 == 0 else prose(k, rand.randint(0, 5)), "en", source, k))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(rows, schema).repartition(5)


@pytest.mark.parametrize("height", [1, 2, 8])
def test_proofs_are_those_of_plain_trees(spark, height):
    # small superblocks make trees of many layers out of few rows
    sizes = {"hot": 250, None: 10, "a": 1, "B": 3, "é": 9, "z": 28, "v": 27, "n": 2, "": 4}
    docs = rows_of(spark, sizes)
    got = merkle.manifest(docs, height=height)
    assert got.filter("NOT verified OR folded_root != root").count() == 0
    got = got.select("doc_id", "leaf", "subroot", "root", "proof").collect()
    assert sorted(map(tuple, got), key=str) == plain([r.asDict() for r in docs.collect()])


def test_edge_documents(spark, edge_docs):
    rows = [r.asDict() for r in edge_docs.select(*merkle.FIELDS).collect()]
    got = merkle.manifest(edge_docs)
    assert sorted(map(tuple, got.select("doc_id", "leaf", "subroot", "root", "proof").collect()), key=str) == plain(rows)
    assert got.schema["doc_id"].dataType == edge_docs.schema["doc_id"].dataType


def test_what_was_changed_is_found(spark, edge_docs):
    seen = F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    changed = F.coalesce((F.col("doc_id") % 2 == 0) & F.contains("text", F.lit("\n")), F.lit(False))
    proofs = merkle.manifest(edge_docs, changed={"text": seen})
    bad = {r["doc_id"] for r in proofs.filter("NOT verified").select("doc_id").collect()}
    assert bad and bad == {r["doc_id"] for r in edge_docs.filter(changed).select("doc_id").collect()}


def test_a_lone_leaf_and_no_leaves(spark, edge_docs, no_docs):
    one = merkle.manifest(edge_docs.filter("doc_id = 15").limit(1)).first()
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"] and one["proof"] == "" and one["verified"]
    assert merkle.manifest(no_docs).collect() == []
