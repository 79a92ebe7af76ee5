"""Mixing sources to target weights (operator 2).

The words of a source are packed into blocks of a fixed length. Every output shard has the same number of
slots, whose sources are drawn by the target weights. A source's slots are numbered through and mapped
through a pseudorandom permutation of its block indices, one for each pass over the source, and joined
with the blocks by index.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.llm.common import GAP, WORD, fresh, let, uniform, written

# More sources than this are refused: one row for each is held on the driver and in every task.
MAX_SOURCES = 100_000


@dataclass(frozen=True)
class Policy:
    """``weights`` repeat over the sources by code point order, null last. The mix is ``share`` times the size of
    the input; no source, and no document, gives more than ``most`` times its size. ``block`` is a block's
    length in words, ``slots`` a shard's number of blocks, ``bucket_rows`` how many documents of a source are
    numbered in one task."""

    weights: Sequence[int] = (3, 1, 2)
    share: float = 1.5
    most: int = 2
    block: int = 64
    slots: int = 1 << 16
    bucket_rows: int = 2048
    seed: int = 42


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, policy: Policy) -> DataFrame:
    """Add ``target`` to a table of ``source``, ``source_size``: one row a source, few enough for one task.

    Weights share out ``share`` of all sizes. A source whose part is above ``most`` times its size stops there and
    the rest is shared again. Sources sorted by most * size / weight stop in that order, so the level at
    which sharing ends follows from running sums.
    """
    # a null sorts last, other names by code point: UTF-8 bytes have the same order
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    place = (F.row_number().over(by_name) - 1).cast("long")
    rows = sources.withColumn("place", place)
    weights = F.array(*[F.lit(float(w)) for w in policy.weights])
    rows = rows.withColumn("weight", F.get(weights, (F.col("place") % len(policy.weights)).cast("int")))
    rows = rows.withColumn("cap", F.lit(float(policy.most)) * F.col("source_size"))
    rows = rows.withColumn("stops", F.col("cap") / F.col("weight"))
    by_level = Window.orderBy("stops", "place")
    before, all_rows = by_level.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(all_rows) * policy.share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    rows = rows.withColumn("level", left / weight)
    # the first source that does not stop has the level of all after it; without one, all stop
    free = F.when(F.col("stops") >= F.col("level"), F.struct("stops", "place", "level"))
    level = F.min(free).over(all_rows)["level"]
    part = F.least(F.col("cap"), F.col("weight") * F.coalesce(level, F.lit(float("inf"))))
    return rows.withColumn("target", part).select("source", "rows", "source_size", "target", "place")


def permuted(index: Column, n: Column, key: Sequence[Column], rounds: int = 24) -> Column:
    """A pseudorandom permutation of 0 .. n-1 at ``index``, another for every ``key``.

    Swap-or-not: each round pairs every index with another and swaps the pair or not, by a hash bit of the
    larger. Each round is a bijection for any n, so no index is lost or met twice.
    """

    def swap(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*key, r), n) + n - x, n)
        bit = F.xxhash64(*key, r, F.greatest(x, other)).bitwiseAND(F.lit(1))
        return F.when(bit == 1, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), index, swap)


def numbered(rows: DataFrame, order: Sequence[str], sources: DataFrame, policy: Policy) -> DataFrame:
    """Add ``start``, the words of the row's source before it, and the source's columns.

    A source may hold a third of all rows, so its rows are numbered by buckets of a hash: sums within a
    bucket, then over the buckets before it.
    """
    most = sources.agg(F.max("rows")).first()[0] or 0
    buckets = max(1, math.ceil(most / policy.bucket_rows))
    known = sources.withColumnRenamed("source", "s")
    rows = rows.join(known, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("place", "bucket").agg(F.sum("size").alias("words"))
    base = F.coalesce(F.sum("words").over(before(Window.partitionBy("place").orderBy("bucket"))), F.lit(0))
    within = before(Window.partitionBy("place", "bucket").orderBy(*order))
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    rows = rows.join(sums.select("place", "bucket", base.alias("base")), ["place", "bucket"])
    return rows.withColumn("start", F.col("base") + F.col("inside")).drop("base", "inside", "bucket", "rows")


def drawn(sources: DataFrame, policy: Policy) -> DataFrame:
    """How often each block is taken: ``place`` of the source, ``block``, ``times``.

    A shard's expected counts are split in two. Their whole parts are given; the slots that are left
    are drawn one by one from the fractions, which makes their counts multinomial. So each shard has
    the expected mix but for those few slots, however small the corpus is.
    """
    spark = sources.sparkSession
    blocks = F.ceil(F.col("source_size") / policy.block).cast("long")
    slots = F.when(F.col("source_size") > 0, F.col("target") * blocks / F.col("source_size")).otherwise(0.0)
    rows = sources.select("place", blocks.alias("blocks"), slots.alias("slots"))
    facts = rows.agg(F.sum("slots").alias("slots"), F.count("*").alias("n")).first()
    if not facts["slots"]:
        return rows.select("place", F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("times")).limit(0)
    shards = math.ceil(facts["slots"] / policy.slots)
    each = math.ceil(facts["slots"] / shards)
    expected = F.col("slots") * (each / facts["slots"])
    rows = rows.withColumn("whole", F.floor(expected)).withColumn("part", expected - F.floor(expected))
    up_to = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = written(rows.withColumn("high", F.sum("part").over(up_to)), "mix-sources")
    sums = rows.agg(F.sum("whole").alias("whole"), F.max("high").alias("high")).first()
    rest = each - sums["whole"]
    # every free slot of every shard is a point on the line of fractions, found through cells of length 1
    point = uniform(F.lit(policy.seed), F.lit("slot"), F.col("id")) * sums["high"]
    free = spark.range(shards * rest).select(F.floor(F.col("id") / max(rest, 1)).alias("shard"), point.alias("x"))
    low = F.col("high") - F.col("part")
    cells = F.explode(F.sequence(F.floor(low), F.floor("high"))).alias("cell")
    cells = rows.filter("part > 0").select("place", low.alias("low"), "high", cells)
    hits = free.withColumn("cell", F.floor("x")).join(cells, "cell").filter("low <= x AND x < high")
    extra = hits.groupBy("shard", "place").agg(F.count("*").alias("extra"))
    places = F.explode(F.sequence(F.lit(0), F.lit(facts["n"] - 1))).alias("place")
    counts = spark.range(shards).select(F.col("id").alias("shard"), places).join(rows, "place")
    counts = counts.join(extra, ["shard", "place"], "left")
    counts = counts.withColumn("n", F.col("whole") + F.coalesce("extra", F.lit(0)))
    before = Window.partitionBy("place").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # one row's slots are many, so they are made in two steps with an exchange between them
    step = 4096
    parts = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / step))).alias("part")
    parts = counts.filter("n > 0").select("place", "blocks", "first", "n", parts)
    # a fixed number of partitions: adaptive execution would merge rows that are small only now
    parts = parts.repartition(max(1, math.ceil(shards * each / 100_000)), "place", "first", "part")
    last = F.least(F.col("n"), (F.col("part") + 1) * step) - 1
    slot = F.explode(F.sequence(F.col("first") + F.col("part") * step, F.col("first") + last)).alias("slot")
    taken = parts.select("place", "blocks", slot).filter(F.col("slot") < policy.most * F.col("blocks"))
    turn = F.floor(F.col("slot") / F.col("blocks"))
    index = permuted(F.col("slot") % F.col("blocks"), F.col("blocks"), [F.lit(policy.seed), F.col("place"), turn])
    return taken.select("place", index.alias("block")).groupBy("place", "block").agg(F.count("*").alias("times"))


def mix(rows: DataFrame, order: Sequence[str], policy: Policy = Policy()) -> DataFrame:
    """What the mix takes of every row of ``rows``, which has ``source``, ``size`` and the ``order`` columns.

    ``order`` has to tell rows apart, up to equal ones, whatever the partitions; then reruns agree. Adds
    ``source_size``, ``target``, ``taken`` (words, repeats counted) and ``pieces``: for each block that is
    taken, the row's words from ``first`` on, ``n`` of them, ``times`` times, in order. Rows of size 0
    give nothing; a null source is a source; an empty table gives an empty one.
    """
    rows = written(rows, "mix-rows")
    totals = rows.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size"))
    totals = written(totals, "mix-totals")
    if totals.count() > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sources = written(targets(totals, policy), "mix-targets")
    rows = written(numbered(rows, order, sources, policy), "mix-starts")
    end = F.col("start") + F.col("size")
    spans = F.explode(F.sequence(F.floor(F.col("start") / policy.block), F.floor((end - 1) / policy.block)))
    spans = rows.filter("size > 0").select("place", "start", "size", spans.alias("block"))
    first = F.greatest(F.col("block") * policy.block, F.col("start")) - F.col("start")
    n = F.least((F.col("block") + 1) * policy.block, end) - F.col("start") - first
    # a merge join by hint: Spark takes the spans for as small as the rows they are made from
    hits = spans.hint("merge").join(drawn(sources, policy), ["place", "block"])
    hits = hits.select("place", "start", F.struct(first.alias("first"), n.alias("n"), "times").alias("piece"))
    per_row = hits.groupBy("place", "start").agg(
        F.sum(F.col("piece.n") * F.col("piece.times")).alias("taken"),
        F.sort_array(F.collect_list("piece")).alias("pieces"),
    )
    # rows without words share their start with the row after them
    per_row = per_row.withColumn("some", F.lit(True))
    joined = rows.withColumn("some", F.col("size") > 0).join(per_row, ["place", "start", "some"], "left")
    return joined.withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long")).drop("place", "start", "some")


def mixed_documents(docs: DataFrame, text: str = "text", source: str = "source", policy: Policy = Policy()) -> DataFrame:
    """The mix as documents: for every time that blocks of a document are taken, one row of its taken words.

    A row has the columns of its document; its text is cut to the blocks taken at least that often, in
    order, with the white space after each word, and a column ``n_chars``, if there, is set to its length.
    Documents of which nothing is taken are not in the mix, nor are null texts and texts without words.
    Equal rows are documents of their own; a null source is a source; an empty table gives an empty one.
    """
    key, columns = fresh(docs, "row_key"), docs.columns
    others = [c for c, kind in docs.dtypes if "map<" not in kind]
    docs = written(docs.withColumn(key, F.monotonically_increasing_id()), "mix-documents")
    narrow = docs.select(
        F.col(key).alias("row"), F.xxhash64(*others).alias("tie"),
        F.col(source).cast("string").alias("source"), size_of(F.col(text)).alias("size"),
    )
    taken = mix(narrow, ["tie", "row"], policy).filter("taken > 0").select(F.col("row").alias(key), "pieces")
    pieces, turn = fresh(docs, "pieces"), fresh(docs, "turn")
    rows = docs.join(taken.withColumnRenamed("pieces", pieces), key)
    rows = rows.withColumn(turn, F.explode(F.sequence(F.lit(1), F.array_max(F.transform(pieces, lambda p: p["times"])))))
    tokens = F.split(F.regexp_replace(text, f"^{GAP}+", ""), f"(?<={GAP})(?=[^\\x20\\x09-\\x0D])")

    def cut(words: Column) -> Column:
        wanted = F.filter(pieces, lambda p: p["times"] >= F.col(turn))
        some = F.transform(wanted, lambda p: F.slice(words, (p["first"] + 1).cast("int"), p["n"].cast("int")))
        return F.array_join(F.flatten(some), "")

    rows = rows.withColumn(text, let(tokens, cut))
    if "n_chars" in columns:
        rows = rows.withColumn("n_chars", F.length(text).cast(dict(docs.dtypes)["n_chars"]))
    return rows.select(*columns)
