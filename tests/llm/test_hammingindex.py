"""Nearest neighbours against all inner products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from oreflow.llm import hammingindex as index

QUERY = "id % 20 = 0"


def table(spark, rows, kind="float"):
    clash = "id string, rank string, score string, code string, part string"
    return spark.createDataFrame([(k, v, *["mine"] * 5) for k, v in rows], f"vec_id long, embedding array<{kind}>, {clash}").repartition(3)


def by_query(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def true(rows, k=20):
    """By query, ids and scores of the nearest among the usable rows, and the vectors."""
    fine = {}
    for key, v in rows:
        if key is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            fine[key] = min(fine.get(key, v), v)
    ids = np.array(sorted(fine))
    m = np.array([fine[i] for i in ids.tolist()])
    out = {}
    for at in np.flatnonzero(ids % 20 == 0):
        scores = m @ m[at]
        order = [i for i in np.lexsort((ids, -scores)) if i != at][:k]
        out[int(ids[at])] = [(int(ids[i]), float(scores[i])) for i in order]
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in near}) for q, near in want.items())
    return hits / sum(len(near) for near in want.values())


def random_rows(n, d, seed=0, lengths=False):
    rand = np.random.default_rng(seed)
    m = rand.normal(size=(n, d))
    m *= rand.uniform(0.2, 3, (n, 1)) / np.linalg.norm(m, axis=1, keepdims=True) if lengths else 1 / np.linalg.norm(m, axis=1, keepdims=True)
    return [(k, [float(np.float32(x)) for x in v]) for k, v in enumerate(m)]


@pytest.mark.parametrize("n, d, lengths", [(3000, 64, False), (1500, 24, True), (600, 100, False)])
def test_recall_and_exact_scores(spark, n, d, lengths):
    rows = random_rows(n, d, n, lengths)
    got, want = by_query(index.nearest(table(spark, rows), QUERY)), true(rows)
    assert got.keys() == want.keys() and recall(got, want) >= 0.9
    m = np.array([v for _, v in rows])
    for q, near in got.items():
        assert len(near) == 20 and q not in dict(near)
        assert all(math.isclose(s, float(m[q] @ m[i]), rel_tol=1e-12, abs_tol=1e-14) for i, s in near)
        assert near == sorted(near, key=lambda pair: (-pair[1], pair[0]))


def test_hot_vectors_and_ties(spark):
    """A third of the rows are one vector, a third nearly so: parts are split, ties go to the smaller key."""
    rows, rand = random_rows(1800, 16, 3), np.random.default_rng(1)
    one = rows[0][1]
    rows = [(k, one if k % 3 == 0 else [x + float(np.float32(rand.normal() * 1e-3)) for x in one] if k % 3 == 1 else v) for k, v in rows]
    got, want = by_query(index.nearest(table(spark, rows, "double"), QUERY)), true(rows)
    assert recall(got, want) >= 0.9
    assert [i for i, _ in got[60] if i % 3 == 0] == sorted(i for i, _ in got[60] if i % 3 == 0)


def test_parts_find_every_code_within_the_radius(spark):
    """Pigeonhole: nothing within the radius is missed, whatever the number of parts."""
    rows = random_rows(700, 16, 5)
    some = index.usable(table(spark, rows), "vec_id", "embedding")
    codes = index.learn(np.array([v for _, v in rows]), 1.0)
    encoded = index._encoded(some, codes, F.expr(QUERY), "<f4").persist()
    mine = {r["id"]: (np.uint64(r["code"] & (2**64 - 1)), np.uint64(r["asked"] & (2**64 - 1))) for r in encoded.collect()}
    for radius, rows_of_part in [(0, 64), (5, 40), (18, 8192), (30, 3), (64, 100)]:
        found = index._probed(encoded, radius, rows_of_part, 10**6, "<f4")
        got = {(r["query_id"], r["id"]) for r in found.collect()}
        want = {(q, i) for q in mine if q % 20 == 0 for i in mine if i != q and np.bitwise_count(mine[q][1] ^ mine[i][0]) <= radius}
        assert got == want


def test_radii_obey_the_pigeonhole():
    rand = random.Random(2)
    for _ in range(3000):
        apart = rand.getrandbits(64) & rand.getrandbits(64) & rand.getrandbits(64)
        reach = index.radii(apart.bit_count())
        assert any(((apart >> 16 * t) & 0xFFFF).bit_count() <= reach[t] for t in range(4))


def test_what_takes_no_part(spark):
    rows = random_rows(45, 8, 9)
    nan, inf = float("nan"), float("inf")
    odd = [(100, None), (120, [0.0] * 8), (140, [nan] + [1.0] * 7), (160, [inf] + [1.0] * 7), (180, [None] + [1.0] * 7), (200, []), (None, [1.0] * 8)]
    again = [rows[20], rows[20], (21, [9.0] * 8)]
    got, want = by_query(index.nearest(table(spark, rows + odd + again), QUERY)), true(rows + odd + again)
    assert got.keys() == want.keys() == {0, 20, 40}
    assert recall(got, want) >= 0.9
    few = by_query(index.nearest(table(spark, rows[:3] + odd), QUERY))
    assert [i for i, _ in few[0]] == [i for i, _ in true(rows[:3])[0]]  # all candidates, if fewer
    other = [(400, [1.0] * 9)]  # a vector of another length than most
    assert by_query(index.nearest(table(spark, rows + other), QUERY)).keys() == {0, 20, 40}
    for none in (rows[:1], odd, rows[1:19], []):
        assert index.nearest(table(spark, none), QUERY).collect() == []
