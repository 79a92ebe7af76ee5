"""The conversation trie against rebuilt texts."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from oreflow.llm import tries

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, pos string, depth string, prefix string, digest string"


def plain(rows):
    turns = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns[conv].append(((turn is not None, turn or 0, tie), (role, text)))
    own = {c: [t for _, t in sorted(some)] for c, some in turns.items()}
    rebuilt = {}
    for c in own:
        n = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(own.get(base, [])[:n] + own[c][n:])
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(list)
    for seq in members:
        if seq:
            children[seq[:-1]].append(seq)
    out = []
    for seq, convs in members.items():
        below = [s for s in members if s[: len(seq)] == seq]
        saved = sum((len(members[s]) - 1) * len(s[-1][1]) for s in below if s)
        ends = ",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(seq))
        parent = min(members[seq[:-1]]) if seq else None
        leaves = sum(s not in children for s in below)
        digest = sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(seq), parent, len(convs), len(children[seq]) if seq in children else 0, leaves, saved, digest))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


@pytest.fixture(scope="module")
def talks():
    """Few different turns, so that many prefixes are shared; ties, nulls, long and negative ids."""
    rand, rows = random.Random(8), []
    for c in [*range(0, 40), 100, 101, 105, 199, 250, 299, -3, -100, -205, 10**15 + 7]:
        for t in range(rand.choice([1, 1, 2, 3, 5, 8])):
            turn = None if rand.random() < 0.1 else t if rand.random() < 0.9 else 0
            role = rand.choice(["user", "user", "assistant", None, ""])
            rows.append((c, turn, role, rand.choice(["a", "a", "a", "bé😀", "", None, "u:x"])))
    rows += [(None, 0, "user", "lost"), rows[0], rows[0], (300, 0, "user", "x" * 5000), (301, None, None, None)]
    rows += [(c, 0, "user", "the same") for c in range(1000, 1100)]  # whole conversations that are equal
    return [(*r, "mine", "mine", "mine", "mine") for r in rows]


def test_trie_is_that_of_rebuilt_texts(spark, talks):
    df = spark.createDataFrame(talks, SCHEMA).repartition(4)
    assert got(tries.prefix_trie(df)) == plain(talks)


def test_long_conversations_are_shared_by_tasks(spark, talks, monkeypatch):
    monkeypatch.setattr(tries, "STRETCH", 16)
    rows = talks[:60] + [(c, t, "user", f"turn {t if t < 150 else (t, c)}") + ("",) * 4 for c in (700, 707, 708) for t in range(200)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert got(tries.prefix_trie(df)) == plain(rows)


def test_equal_fingerprints_of_different_prefixes_are_told_apart(spark, talks):
    df = spark.createDataFrame(talks, SCHEMA)
    turns = df.filter("conv_id is not null").select(
        "conv_id", "turn", tries.turn_digest(F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))).alias("digest"),
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
    )
    base = tries.multiplier(0, 7)
    scans = tries.prefixes(turns, base, 7)
    convs = tries.rebuilt(scans, tries.default_base, tries.default_head)
    assert tries.nodes_of(tries.entries(scans, convs, base, 7)).filter("NOT sound").count() > 0
    # a hash of seven values is seen to fail, and the answer is right all the same
    assert got(tries.prefix_trie(df, prime=7)) == plain(talks)


def test_turnless_conversations_end_at_the_root(spark):
    # the head of a missing base replaces all their turns
    ids = [c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 > 0][:3]
    rows = [(c, 0, "user", "x") for c in ids]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert got(tries.prefix_trie(df)) == plain(rows)
    assert len(plain(rows)) == 1 and plain(rows)[0][5] == 1
    assert tries.prefix_trie(df.limit(0)).collect() == []


def test_references_name_stored_turns(spark, talks):
    df = spark.createDataFrame(talks, SCHEMA)
    nodes = tries.prefix_trie(df).filter("depth > 0")
    stored = {(c, p) for c in {r[0] for r in talks} for p in range(1, 1 + sum(r[0] == c for r in talks))}
    assert {tuple(r) for r in nodes.select("ref_conv", "ref_pos").collect()} <= stored


def test_rows_of_a_hot_key_are_joined_once(spark):
    many = spark.range(5000).selectExpr("id", "if(id % 3 = 0, 7, id) as k")
    few = many.select("k").distinct().withColumn("v", F.col("k") * 2)
    joined = tries._with_unique(many, few, ["k"])
    assert joined.count() == 5000 and joined.filter("v != 2 * k").count() == 0


def test_digests_of_ends_in_pieces(spark):
    rows = [(1, bytes([k % 2]) * 16, k * 3) for k in range(3000)]
    df = spark.createDataFrame(rows, "depth long, print binary, conv_id long").repartition(6)
    want = {bytes([b]) * 16: sha256(",".join(str(k * 3) for k in range(b, 3000, 2)).encode()).hexdigest() for b in (0, 1)}
    assert {bytes(r["print"]): r["ends_sha256"] for r in tries.ends_digest(df).collect()} == want
