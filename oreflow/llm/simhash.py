"""SimHash near-duplicates by meet-in-the-middle ball hashing (operator 9).

Two fingerprints at most 4 bits apart have a value between them that is at most 2 bits from either. So
every fingerprint stands for all its variants within 2 bits, variants are dealt out by a hash, and
fingerprints that meet at a variant are neighbours.

The hash of a variant is linear: the hash of x with bits flipped is the hash of x, changed by the hash of
the flips. So a task that holds one value of the hash makes just those variants of a fingerprint that
belong to it, and only fingerprints travel: 8 bytes instead of 2,081 variants of 16.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import fresh, written

BITS = 64
# Variants that a task sorts at once.
AT_ONCE = 4_000_000
# Fingerprints that one task may hold, 32 MB; from more on, variants are dealt out finer.
HELD = 4_000_000


def simhash(text: str | None, width: int = 4) -> int:
    """The 64-bit fingerprint of a text, signed. Zero for a text without words or null.

    Words are separated by ASCII white space, A-Z lower-cased; the shingles are ``width`` words joined by a
    space, repeats included, or all words if there are fewer. A bit is 1 if more than half the
    shingles' XXH64 hashes (seed 42) have it.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - width + 1)
    starts, ends = starts[:n].tolist(), ends[len(words) - n :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for k in range(0, n, 65_536):
        cuts = zip(starts[k : k + 65_536], ends[k : k + 65_536], strict=True)
        hashes = np.array([digest(joined[a:b], 42) for a, b in cuts], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def simhashes(text: Column, width: int = 4) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t if isinstance(t, str) else None, width) for t in texts], dtype="int64")

    return of(text.cast("string"))


@lru_cache(maxsize=4)
def _flips(radius: int) -> np.ndarray:
    """All 64-bit words with at most ``radius`` bits set."""
    words, last = np.zeros(1, np.uint64), np.zeros(1, np.uint64)
    ones = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
    for _ in range(radius):
        last = np.unique((last[:, None] | ones).ravel())
        words = np.unique(np.concatenate([words, last]))
    return words


def _linear(values: np.ndarray, width: int) -> np.ndarray:
    """``width`` bits, each the parity of some bits of the value; linear over exclusive or."""
    out = np.zeros(len(values), np.uint64)
    random = np.random.default_rng(7)
    for k in range(width):
        mask = np.uint64(random.integers(0, 1 << 64, dtype=np.uint64))
        out |= (np.bitwise_count(values & mask).astype(np.uint64) & np.uint64(1)) << np.uint64(k)
    return out.astype(np.int64)


def _meetings(values: np.ndarray, radius: int, width: int, bucket: int) -> np.ndarray:
    """Links (higher, lower) of the values that meet at a variant whose hash is ``bucket``.

    All that meet at one variant are linked to the smallest of them, not to each other: they are all within
    twice the radius, so nothing is lost for what can be reached. Links that the others imply go.
    """
    fine = 0
    while len(values) * len(_flips(radius)) >> (width + fine) > AT_ONCE:
        fine += 1
    flips = _flips(radius)
    at_flip, at_value = _linear(flips, width + fine), _linear(values, width + fine)
    by = {h: flips[at_flip == h] for h in np.unique(at_flip).tolist()}
    groups = {h: values[at_value == h] for h in np.unique(at_value).tolist()}
    found = []
    for part in range(1 << fine):
        target = part << width | bucket
        ball, owner = [], []
        for h, some in groups.items():
            near = by.get(h ^ target)
            if near is not None:
                ball.append((some[:, None] ^ near).ravel())
                owner.append(np.repeat(some, len(near)))
        if not ball:
            continue
        ball, owner = np.concatenate(ball), np.concatenate(owner)
        order = np.argsort(ball)
        ball, owner = ball[order], owner[order]
        new = np.concatenate([[True], ball[1:] != ball[:-1]])
        if new.all():
            continue
        starts = np.flatnonzero(new)
        least = np.repeat(np.minimum.reduceat(owner, starts), np.diff(np.append(starts, len(ball))))
        pairs = np.stack([owner, least], 1)[owner != least]
        found.append(np.unique(pairs, axis=0))
    return _forest(np.unique(np.concatenate(found), axis=0)) if found else np.zeros((0, 2), np.uint64)


def _forest(pairs: np.ndarray) -> np.ndarray:
    """As many links as are needed to reach the same values: each to the smallest it can reach."""
    nodes, flat = np.unique(pairs, return_inverse=True)
    a, b = flat.reshape(-1, 2).T
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        if (label == before).all():
            break
    own = label != np.arange(len(nodes))
    return np.stack([nodes[own], nodes[label[own]]], 1)


def links(values: DataFrame, distance: int = 4) -> DataFrame:
    """Links ``src``, ``dst`` between distinct longs ``value`` that reach all pairs at most ``distance`` apart.

    The variants' hash has 64 values, each a task's part, or more once a task would hold over ``HELD``
    fingerprints.
    """
    radius = distance // 2
    if distance % 2:
        raise ValueError("the distance has to be even")
    n, width = values.count(), 6
    while width < 22 and n * min(1, len(_flips(radius)) / 2**width) > HELD:
        width += 1

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The values as bytes, one row for each part that has variants of them."""
        at_flip = np.unique(_linear(_flips(radius), width)).tolist()
        for batch in batches:
            some = batch["value"].to_numpy(np.int64).view(np.uint64)
            if len(at_flip) == 1 << width:
                rows = [(part, some.tobytes()) for part in range(1 << width)]
            else:
                at = _linear(some, width)
                rows = [(h ^ own, some[at == own].tobytes()) for own in np.unique(at).tolist() for h in at_flip]
            yield pd.DataFrame(rows, columns=["part", "packed"])

    def meet(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        packed = np.frombuffer(b"".join(frame["packed"]), np.uint64)
        found = _meetings(packed, radius, width, int(key[0])).view(np.int64)
        return pd.DataFrame({"src": found[:, 0], "dst": found[:, 1]})

    packed = values.select("value").mapInPandas(dealt, "part long, packed binary")
    return packed.groupBy("part").applyInPandas(meet, "src long, dst long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and the smallest node it can reach, ``root``, for every node that has a link.

    Large-star and small-star steps: links are moved to smaller and smaller neighbours until every node is
    linked to its root alone. The steps are joins and aggregates; each round is written.
    """
    edges = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    edges, before = written(edges.filter("src != dst").distinct(), "links"), None
    while True:
        facts = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")).alias("h"))
        now = tuple(facts.first())
        if now == before:
            return edges.select(F.col("src").alias("node"), F.col("dst").alias("root")).unionByName(
                edges.select(F.col("dst").alias("node"), F.col("dst").alias("root")).distinct()
            )
        before = now
        both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        # grouped by the node and its hash, so that the join deals out anew and can split a hot node
        least = both.groupBy("src", F.xxhash64("src").alias("h")).agg(F.min("dst").alias("low")).drop("h")
        low = F.least("src", "low").alias("dst")
        large = both.join(least, "src").filter("dst > src").select(F.col("dst").alias("src"), low)
        large = written(large.filter("src != dst").distinct(), "links")
        least = large.groupBy("src", F.xxhash64("src").alias("h")).agg(F.min("dst").alias("low")).drop("h")
        small = large.join(least, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        small = small.unionByName(least.select("src", F.col("low").alias("dst")))
        edges = written(small.filter("src != dst").distinct(), "links")


def groups(rows: DataFrame, distance: int = 4) -> DataFrame:
    """For rows of ``value`` and ``id``: each ``value``, the ``root`` of its group, and the group's smallest id.

    Equal values are one value here, however many rows have them; all pairs of different values at
    most ``distance`` bits apart are linked. ``component_id`` is null where all ids are.
    """
    values = written(rows.groupBy("value").agg(F.min("id").alias("id")), "values")
    found = components(links(values, distance))
    values = values.join(found.withColumnRenamed("node", "value"), "value", "left")
    values = values.withColumn("root", F.coalesce("root", "value"))
    smallest = values.groupBy("root", F.xxhash64("root").alias("h")).agg(F.min("id").alias("component_id")).drop("h")
    return values.join(smallest, "root").select("value", "root", "component_id")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, distance: int = 4
) -> DataFrame:
    """``key``, ``fingerprint`` (16 lower-case hex digits) and ``component_id`` of every row.

    Null texts and texts without words have the fingerprint zero and are linked like others. Repeated rows
    and keys stay. An empty table gives an empty one.
    """
    rows = written(docs.select(F.col(key).alias("id"), simhashes(F.col(text), width).alias("value")), "simhashes")
    digits = F.lpad(F.lower(F.hex("value")), 16, "0")
    joined = rows.join(groups(rows, distance), "value")
    return joined.select(F.col("id").alias(key), digits.alias("fingerprint"), "component_id")


def one_of_each(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, distance: int = 4
) -> DataFrame:
    """One document of every group, with the columns it came with: the one with the smallest key.

    Rows with one key count as different documents; of equal ones either stays. A row without a key stays
    only if its group has no other. Null texts and texts without words are one group, with others near
    the fingerprint zero. An empty table gives an empty one.
    """
    row, value, columns = fresh(docs, "row_key"), fresh(docs, "value"), docs.columns
    docs = docs.withColumns({row: F.monotonically_increasing_id(), value: simhashes(F.col(text), width)})
    docs = written(docs, "near-documents")
    tie = F.xxhash64(*[c for c, kind in docs.select(*columns).dtypes if "map<" not in kind])
    rows = docs.select(F.col(row).alias("row"), F.col(key).alias("id"), tie.alias("tie"), F.col(value).alias("value"))
    rows = written(rows, "near-rows")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "tie", "row"))
    kept = rows.join(groups(rows, distance), "value").groupBy("root").agg(first.alias("kept"))
    kept = kept.select(F.col("kept.row").alias(row))
    return docs.join(kept, row, "left_semi").select(*columns)
