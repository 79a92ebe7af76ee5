"""Nearest neighbours by multi-index hashing of learned binary codes (operator 12).

Vectors become 64-bit codes: a rotation learned on a sample turns the main directions so that their signs tell
most (iterative quantization). A code is split into four substrings of 16 bits, and each substring has an index
of its own. Two codes at most r bits apart have a substring in which they are at most floor(r / 4) apart, some
even less: so probing every index at its radius finds every code within r. What is found is ranked by the
inner product of the vectors themselves.

An index is dealt out in parts of neighbouring substring values, with a bounded number of rows each; a value that
has more rows has several parts. A query goes to the parts that hold a value it probes and streams past the
rows there. So memory is bounded by a part, whatever the number of queries.

The radius is measured, not guessed: a few queries are compared with all rows, and r is the number of bits
that holds the wanted share of their true neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.llm.common import uniform, written

BITS, TABLES = 64, 4
WIDTH = BITS // TABLES
VALUES = 1 << WIDTH
# Rows that codes are learned from, and queries that the radius is measured with, at most.
SAMPLE, PROBES = 4096, 64
# Share of the measured queries' true neighbours that the radius has to hold.
WANTED = 0.96
# Rows of a part, and pairs of a query and a row that a task looks at: the fewer rows, the more queries.
PART_ROWS, PART_PAIRS = 65_536, 2_000_000_000


@dataclass(frozen=True)
class Codes:
    """A learned rotation. ``norm`` is the longest vector's length."""

    norm: float
    mean: np.ndarray
    rotation: np.ndarray

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        """Rows on a sphere, by one more component, so that the nearest has the largest inner product."""
        scaled = vectors / self.norm
        rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", scaled, scaled)))
        return np.column_stack([scaled, rest])

    def rows(self, vectors: np.ndarray) -> np.ndarray:
        return _packed((self.lifted(vectors) - self.mean) @ self.rotation)

    def queries(self, vectors: np.ndarray) -> np.ndarray:
        """A query's length does not change its order of rows; it is put on the sphere."""
        scaled = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        return _packed((np.column_stack([scaled, np.zeros(len(scaled))]) - self.mean) @ self.rotation)


def _packed(projected: np.ndarray) -> np.ndarray:
    return np.packbits(projected > 0, axis=1).view(">u8").ravel().astype(np.uint64)


def learn(sample: np.ndarray, norm: float, rounds: int = 25) -> Codes:
    """Directions of the sample's largest variance, rotated until signs lose least. Short vectors get several
    rotations, until there are 64 bits."""
    codes = Codes(norm, np.zeros(sample.shape[1] + 1), np.zeros((sample.shape[1] + 1, BITS)))
    lifted = codes.lifted(sample)
    mean = lifted.mean(axis=0)
    centred = lifted - mean
    _, _, axes = np.linalg.svd(centred.T @ centred)
    axes = axes[:BITS].T
    projected, random = centred @ axes, np.random.default_rng(11)
    found = []
    for _ in range(-(-BITS // axes.shape[1])):
        turn, _ = np.linalg.qr(random.normal(size=(axes.shape[1], axes.shape[1])))
        for _ in range(rounds):
            left, _, right = np.linalg.svd(projected.T @ np.where(projected @ turn > 0, 1.0, -1.0))
            turn = left @ right
        found.append(axes @ turn)
    return Codes(norm, mean, np.concatenate(found, axis=1)[:, :BITS])


def substring(codes: np.ndarray, table: int) -> np.ndarray:
    return ((codes >> np.uint64(WIDTH * table)) & np.uint64(VALUES - 1)).astype(np.uint16)


def radii(radius: int) -> list[int]:
    """How far each substring has to be probed so that all codes within ``radius`` are found; -1 is not at all."""
    whole, rest = divmod(radius, TABLES)
    return [whole if table <= rest else whole - 1 for table in range(TABLES)]


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Which rows are the ``k`` best, in order: largest score, then smallest id."""
    some = np.arange(len(ids))
    if len(ids) > k:
        some = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    return some[np.lexsort((ids[some], -scores[some]))][:k]


class Part:
    """The rows of a part of one substring's index."""

    def __init__(self, table: int, ids: np.ndarray, codes: np.ndarray, vectors: np.ndarray):
        values = substring(codes, table)
        order = np.argsort(values, kind="stable")
        self.table, self.ids, self.codes, self.vectors = table, ids[order], codes[order], vectors[order]
        self.values, starts = np.unique(values[order], return_index=True)
        self.sizes = np.diff(np.append(starts, len(ids)))

    def search(self, query: int, code: np.uint64, vector: np.ndarray, radius: int, k: int):
        """Ids and scores of the query's best rows here. A code that an earlier index finds is left to it."""
        reach = radii(radius)
        mine = np.uint16((int(code) >> WIDTH * self.table) & (VALUES - 1))
        probed = np.bitwise_count(self.values ^ mine) <= reach[self.table]
        row = np.flatnonzero(np.repeat(probed, self.sizes))
        apart = self.codes[row] ^ code
        keep = (np.bitwise_count(apart) <= radius) & (self.ids[row] != query)
        for earlier in range(self.table):
            if reach[earlier] >= 0:
                keep &= np.bitwise_count(substring(apart, earlier)) > reach[earlier]
        row = row[keep]
        scores = np.einsum("ij,j->i", self.vectors[row], vector)
        best = _best(self.ids[row], scores, k)
        return self.ids[row[best]], scores[best]


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``id`` and ``vec`` (floats if they are, else doubles) of the rows that take part.

    These have a key and a vector without null, infinite or undefined components, not all zero, as long as
    most vectors are (the longer ones if two lengths are equally frequent). A key that stands several times counts
    once, with the smallest of its vectors.
    """
    value = F.col(vector)
    if rows.schema[vector].dataType != T.ArrayType(T.FloatType()):
        value = value.cast("array<double>")
    some = rows.select(F.col(key).cast("long").alias("id"), value.alias("vec"))
    value = F.col("vec")
    fine = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = some.filter(F.col("id").isNotNull() & fine & F.exists(value, lambda x: x != 0))
    some = written(some.groupBy("id").agg(F.min("vec").alias("vec")), "vectors")
    most = some.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return some.filter(F.size("vec") == (most["size"] if most else 0))


def _matrix(packed: list[bytes], kind: str) -> np.ndarray:
    """Vectors as doubles, from their bytes."""
    return np.frombuffer(b"".join(packed), kind).reshape(len(packed), -1).astype(np.float64)


def _encoded(some: DataFrame, codes: Codes, is_query: Column, bytes_kind: str) -> DataFrame:
    """Rows with their code, their code as a query, and their vector as bytes."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                vectors = np.stack(batch["vec"].to_numpy()).astype(np.float64)
                yield pd.DataFrame({
                    "id": batch["id"], "asks": batch["asks"], "code": codes.rows(vectors).view(np.int64),
                    "asked": codes.queries(vectors).view(np.int64),
                    "packed": [v.tobytes() for v in vectors.astype(bytes_kind)],
                })

    asking = some.select("id", F.coalesce(is_query, F.lit(False)).alias("asks"), "vec")
    return asking.mapInPandas(encode, "id long, asks boolean, code long, asked long, packed binary")


def true_neighbours(encoded: DataFrame, probes: list, k: int, bytes_kind: str) -> DataFrame:
    """Each probe's ``k`` nearest of all rows, ``rank``ed, and the distance in ``bits``. Probes are few."""
    ids = np.array([r["id"] for r in probes], np.int64)
    asked = np.array([r["asked"] for r in probes], np.int64).view(np.uint64)
    vectors = _matrix([bytes(r["packed"]) for r in probes], bytes_kind)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for batch in batches:
            if not len(batch):
                continue
            scores = vectors @ _matrix(batch["packed"].tolist(), bytes_kind).T
            rows, codes = batch["id"].to_numpy(np.int64), batch["code"].to_numpy(np.int64).view(np.uint64)
            found = [] if kept is None else [kept]
            for q, query in enumerate(ids):
                best = _best(rows, np.where(rows == query, -np.inf, scores[q]), k)
                best = best[rows[best] != query]
                bits = np.bitwise_count(asked[q] ^ codes[best]).astype(np.int32)
                found.append(pd.DataFrame({"query_id": query, "id": rows[best], "score": scores[q, best], "bits": bits}))
            every = pd.concat(found, ignore_index=True)
            rows, scores, none = every["id"].to_numpy(), every["score"].to_numpy(), np.zeros(0, np.int64)
            groups = every.groupby("query_id").indices.values()
            kept = every.iloc[np.concatenate([none, *[g[_best(rows[g], scores[g], k)] for g in groups]])]
        if kept is not None:
            yield kept

    found = encoded.mapInPandas(compare, "query_id long, id long, score double, bits int")
    return _ranked(found, "query_id", k)


def _ranked(found: DataFrame, by: str, k: int) -> DataFrame:
    order = Window.partitionBy(by).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _measured_radius(encoded: DataFrame, k: int, wanted: float, bytes_kind: str) -> int:
    """The least distance that holds the wanted share of some queries' true neighbours."""
    order = uniform(F.lit(5), "id")
    probes = encoded.filter("asks").orderBy(order, "id").limit(PROBES).collect()
    bits = np.sort([r["bits"] for r in true_neighbours(encoded, probes, k, bytes_kind).select("bits").collect()])
    return int(bits[min(len(bits) - 1, int(np.ceil(wanted * len(bits))) - 1)]) if len(bits) else 0


@dataclass(frozen=True)
class Deal:
    """Which parts hold which substring values: the first part of each value, and how many it has."""

    first: np.ndarray  # tables x values
    count: np.ndarray  # tables x values, 0 where no row has the value
    parts: int

    def table_of(self, part: int) -> int:
        return int(np.searchsorted(self.first[:, 0], part, "right") - 1)


def _dealt(encoded: DataFrame, rows_of_part: int) -> Deal:
    """Parts of neighbouring values, from the 4 x 65,536 counts of rows by value."""
    pairs = encoded.select(F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.shiftrightunsigned("code", WIDTH * t).bitwiseAND(F.lit(VALUES - 1)).alias("v"))
        for t in range(TABLES)
    ])).alias("p"))
    counts = np.zeros((TABLES, VALUES), np.int64)
    found = pairs.groupBy("p.t", "p.v").count().toArrow()
    counts[found["t"].to_numpy(), found["v"].to_numpy()] = found["count"].to_numpy()
    first, number = np.zeros((TABLES, VALUES), np.int32), np.zeros((TABLES, VALUES), np.int32)
    part = 0
    for t in range(TABLES):
        held = 0
        for v in range(VALUES):
            n = counts[t, v]
            if held and held + n > rows_of_part:
                part, held = part + 1, 0
            first[t, v], number[t, v] = part, -(-n // rows_of_part)
            if n > rows_of_part:  # this value alone, in parts of its own
                part, held = part + number[t, v], 0
            else:
                held += n
        part += 1
    return Deal(first, number, int(part))


def _send(encoded: DataFrame, deal: Deal, radius: int) -> DataFrame:
    """Every row to its part of each index, every query to each part that it has to probe."""
    reach = radii(radius)
    present = [np.flatnonzero(deal.count[t]) for t in range(TABLES)]
    first = [deal.first[t, present[t]] for t in range(TABLES)]
    # values that lie in one part, or in the same parts, are neighbours
    starts = [np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1]])) if len(f) else f for f in first]

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            codes = batch["code"].to_numpy(np.int64).view(np.uint64)
            ids = batch["id"].to_numpy(np.int64)
            salt = (ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            for t in range(TABLES):
                if reach[t] >= 0 and len(batch):
                    values = substring(codes, t)
                    parts = deal.first[t, values] + (salt % deal.count[t, values].astype(np.uint64)).astype(np.int32)
                    yield _message(parts, 0, batch, "code")
            asking = batch[batch["asks"]]
            asked = asking["asked"].to_numpy(np.int64).view(np.uint64)
            for start in range(0, len(asking), 64):
                some = asking.iloc[start : start + 64]
                for t in range(TABLES):
                    if reach[t] < 0 or not len(present[t]):
                        continue
                    near = np.bitwise_count(substring(asked[start : start + 64], t)[:, None] ^ present[t].astype(np.uint16))
                    q, group = np.nonzero(np.logical_or.reduceat(near <= reach[t], starts[t], axis=1))
                    at = starts[t][group]
                    sizes = deal.count[t, present[t][at]]
                    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                    yield _message(np.repeat(first[t][at], sizes) + within, 1, some.iloc[np.repeat(q, sizes)], "asked")

    return encoded.mapInPandas(send, "part int, kind int, id long, code long, packed binary")


def _message(parts: np.ndarray, kind: int, rows: pd.DataFrame, code: str) -> pd.DataFrame:
    return pd.DataFrame({"part": parts, "kind": kind, "id": rows["id"], "code": rows[code], "packed": rows["packed"]})


def _probed(encoded: DataFrame, radius: int, rows_of_part: int, k: int, bytes_kind: str) -> DataFrame:
    """The ``k`` best of every query among the rows whose codes are within ``radius``, and maybe less good ones."""
    deal = _dealt(encoded, rows_of_part)
    sent = _send(encoded, deal, radius)
    # a task for each part; rows come before queries
    tasks = max(1, min(deal.parts, 10_000))
    sent = sent.repartitionById(tasks, F.col("part") % tasks).sortWithinPartitions("part", "kind")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held, index = None, [], None
        for batch in batches:
            for part, rows in batch.groupby("part", sort=True):
                if part != now:
                    now, held, index = part, [], None
                for kind, some in rows.groupby("kind", sort=True):
                    facts = (
                        some["id"].to_numpy(np.int64), some["code"].to_numpy(np.int64).view(np.uint64),
                        _matrix(some["packed"].tolist(), bytes_kind),
                    )
                    if kind == 0:
                        held.append(facts)
                        continue
                    if index is None and held:
                        index = Part(deal.table_of(part), *[np.concatenate(c) for c in zip(*held, strict=True)])
                    if index is not None:
                        found = [(query, *index.search(query, code, v, radius, k)) for query, code, v in zip(*facts, strict=True)]
                        yield pd.DataFrame({
                            "query_id": np.repeat(facts[0], [len(row) for _, row, _ in found]),
                            "id": np.concatenate([row for _, row, _ in found]),
                            "score": np.concatenate([score for *_, score in found]),
                        })

    return _ranked(sent.mapInPandas(search, "query_id long, id long, score double"), "query_id", k)


def nearest(
    rows: DataFrame, is_query: Column | str, key: str = "vec_id", vector: str = "embedding", k: int = 20, wanted: float = WANTED
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``key`` and ``score`` of the ``k`` nearest rows found for each query.

    Queries are the rows for which ``is_query``, a condition over ``id``, is true; candidates are all rows but
    the query's own. Nearest is the largest inner product in double precision, ties to the smaller key.
    Every row is in the index; the search is approximate in that a neighbour whose code is further away
    than the radius is missed, and the radius is measured to hold ``wanted`` of them. A query that finds less than ``k``
    rows is asked again with a wider radius, up to all bits, so it has ``k`` neighbours, or all other rows.

    What takes no part: see ``usable``. Equal vectors are different rows, ordered by their key. No rows, or no
    queries, give no rows.
    """
    kind, is_query = rows.schema[key].dataType, F.expr(is_query) if isinstance(is_query, str) else is_query
    some = usable(rows, key, vector)
    lengths = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    facts = some.agg(F.count("*").alias("n"), F.max(lengths).alias("norm")).first()
    if not facts["n"] or some.filter(is_query).isEmpty():
        some = some.limit(0)
        return _named(some.select(
            F.col("id").alias("query_id"), F.lit(0).alias("rank"), "id", F.lit(0.0).alias("score")
        ), key, kind)
    order = uniform(F.lit(3), "id")
    sample = some.filter(order < 8 * SAMPLE / facts["n"]).orderBy(order, "id").limit(SAMPLE).select("vec").collect()
    codes = learn(np.array([r[0] for r in sample], np.float64), facts["norm"])
    bytes_kind = "<f4" if some.schema["vec"].dataType == T.ArrayType(T.FloatType()) else "<f8"
    encoded = written(_encoded(some, codes, is_query, bytes_kind), "codes")
    n_queries = encoded.filter("asks").count()
    rows_of_part = int(max(256, min(PART_ROWS, PART_PAIRS // max(1, n_queries))))
    radius, done = _measured_radius(encoded, k, wanted, bytes_kind), []
    asking = encoded
    while True:
        found = written(_probed(asking, radius, rows_of_part, k, bytes_kind), "found")
        full = min(k, facts["n"] - 1)
        enough = found.groupBy("query_id").count().filter(F.col("count") >= full).select("query_id")
        done.append(found.join(enough, "query_id", "left_semi"))
        short = asking.filter("asks").join(enough, F.col("id") == F.col("query_id"), "left_anti")
        if radius >= BITS or not full or short.isEmpty():
            break
        radius = min(BITS, radius + 8)
        again = short.select("id", F.lit(True).alias("again"))
        asking = written(encoded.join(again, "id", "left").select(
            "id", F.coalesce("again", F.lit(False)).alias("asks"), "code", "asked", "packed"
        ), "short")
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return _named(result, key, kind)


def _named(found: DataFrame, key: str, kind: T.DataType) -> DataFrame:
    return found.select(
        F.col("query_id").cast(kind), F.col("rank").cast("int"), F.col("id").cast(kind).alias(key), "score"
    )
