"""A Merkle manifest of a dataset by cogrouped subtree exchange (operator 11).

Each row is a leaf, each group of rows a tree, and the trees' roots are the leaves of one more tree. Three
consecutive nodes make a node of the next level; the last run of a level may have fewer. A superblock is
6,561 consecutive nodes, 3 to the 8th. First every superblock is reduced to its top; the tops are the nodes of
a table that is so much smaller, and so on up to the root. Then the way goes down again: a superblock
needs nothing from outside but the siblings of its top's ancestors. They and the superblock's nodes are
cogrouped, and one function reduces the block, joins the proofs and folds them.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import fresh, scanned, written

FAN = 3
# Levels of a superblock.
HEIGHT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf_of(values: Sequence[Column]) -> Column:
    """The digest of a row: each value as its UTF-8 byte count, a colon and the value, or ``-`` for null."""

    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


def _levels(nodes: list[str], block: int, height: int) -> list[list[str]]:
    """The nodes of a superblock, level by level up to its top.

    The first block of a tree goes up until one node remains: if it is not full, there is no other. Other blocks
    go up as many levels as a full one does, even if they hold a single node.
    """
    levels = [nodes]
    while len(levels[-1]) > 1 or (block and len(levels) <= height):
        below = levels[-1]
        levels.append([digest("".join(below[k : k + FAN])) for k in range(0, len(below), FAN)])
    return levels


def _siblings(nodes: list[str]) -> list[str]:
    """For every node, what stands in its run before it and after it: ``before|after``."""
    out = []
    for k in range(0, len(nodes), FAN):
        run = nodes[k : k + FAN]
        out += ["".join(run[:i]) + "|" + "".join(run[i + 1 :]) for i in range(len(run))]
    return out


def _paths(nodes: list[str], block: int, height: int, outer: str) -> list[str]:
    """For every node of a superblock, the siblings on its way to the root, level by level, comma-separated."""
    ways = [outer]
    for level in reversed(_levels(nodes, block, height)[:-1]):
        ways = [f"{own},{ways[i // FAN]}" if ways[i // FAN] else own for i, own in enumerate(_siblings(level))]
    return ways


def fold(leaf: str, path: str) -> str:
    """The root that a leaf and the siblings on its way give."""
    for level in path.split(",") if path else []:
        before, after = level.split("|")
        leaf = digest(before + leaf + after)
    return leaf


def _tops(nodes: DataFrame, height: int) -> DataFrame:
    """The top of every superblock, a node of the same tree."""

    def top(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        ordered = frame.sort_values("idx")["digest"].tolist()
        return pd.DataFrame({"tree": [key[0]], "idx": [key[1]], "digest": [_levels(ordered, key[1], height)[-1][0]]})

    blocks = nodes.select("tree", "idx", "digest", _block(height).alias("block")).groupBy("tree", "block")
    return blocks.applyInPandas(top, "tree string, idx long, digest string")


def _block(height: int) -> Column:
    return F.floor(F.col("idx") / FAN**height).cast("long")


def _layers(nodes: DataFrame, height: int) -> list[DataFrame]:
    """The nodes, the tops of their superblocks, and so on until every tree is one node."""
    layers = [nodes]
    while (layers[-1].agg(F.max("idx")).first()[0] or 0) > 0:
        layers.append(written(_tops(layers[-1], height), "tops"))
    return layers


def _down(layers: list[DataFrame], outer: DataFrame, height: int) -> DataFrame:
    """The way to the root for every node of the lowest layer, from the ways of the tops of the highest."""

    def expand(key: tuple, nodes: pd.DataFrame, outside: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("idx")
        ways = _paths(nodes["digest"].tolist(), key[1], height, outside["path"].iloc[0])
        facts = {name: outside[name].iloc[0] for name in ("subroot", "root")}
        return pd.DataFrame({"tree": nodes["tree"], "idx": nodes["idx"], "path": ways, **facts})

    for layer in reversed(layers):
        nodes = layer.select("tree", "idx", "digest", _block(height).alias("block")).groupBy("tree", "block")
        above = outer.withColumnRenamed("idx", "block").groupBy("tree", "block")
        schema = "tree string, idx long, path string, subroot string, root string"
        outer = written(nodes.cogroup(above).applyInPandas(expand, schema), "ways")
    return outer


def manifest(
    rows: DataFrame,
    key: str = "doc_id",
    group: str = "source",
    fields: Sequence[str] = FIELDS,
    changed: dict[str, Column] | None = None,
    height: int = HEIGHT,
) -> DataFrame:
    """``key``, ``group``, ``leaf``, ``subroot``, ``root``, ``proof``, ``folded_root`` and ``verified`` of every row.

    Leaves are digests of ``fields``. Within a group they ascend by key, null first, and rows with one key by
    their leaf; groups ascend as text, bytewise, null first. ``proof`` holds the siblings on the way to the
    root as ``before|after`` for each level, the levels separated by commas; a level of one node gives ``|``.

    ``changed`` replaces fields by other columns, a row as it was found when it is checked: ``folded_root`` is what
    that row's leaf and the proof give, and ``verified`` says whether it is the root. ``height`` is the number of
    levels of a superblock.

    Rows that stand twice are two leaves. Null keys and groups are leaves and a group like others. A table
    of one row has its leaf as root and an empty proof; an empty table gives an empty one.
    """
    key_type, group_type = rows.schema[key].dataType, rows.schema[group].dataType
    values, seen = [F.col(c) for c in fields], [(changed or {}).get(c, F.col(c)) for c in fields]
    found = leaf_of(seen) if changed else F.lit(None).cast("string")
    own = rows.select(
        F.coalesce(F.concat(F.lit("v"), F.col(group).cast("string")), F.lit("n")).alias("tree"),
        F.col(key).alias("id"), leaf_of(values).alias("digest"), found.alias("found"),
    )
    own = own.withColumn("found", F.when(F.col("found") != F.col("digest"), F.col("found")))
    leaves = written(_numbered(written(own, "leaves"), ["id", "digest"]), "numbered")

    trees = _layers(leaves, height)
    tops = trees[-1].select(F.lit("").alias("all"), F.col("tree").alias("of"), F.col("digest").alias("digest"))
    forest = written(_numbered(tops.withColumnRenamed("all", "tree"), ["of"]), "subroots")
    joint = _layers(forest, height)
    root = F.col("digest").alias("root")
    ways = joint[-1].select("tree", "idx", F.lit("").alias("path"), F.lit("").alias("subroot"), root)
    ways = _down(joint[:-1], ways, height)
    # both have a row for each group
    ways = forest.drop("tree").join(ways.drop("tree", "subroot"), "idx")
    ways = ways.select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("idx"), "path", F.col("digest").alias("subroot"), "root")
    ways = _down(trees[1:-1], ways, height)

    def finish(key: tuple, nodes: pd.DataFrame, outside: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("idx")
        paths = _paths(nodes["digest"].tolist(), key[1], height, outside["path"].iloc[0])
        found = nodes["found"].where(nodes["found"].notna(), nodes["digest"])
        root = outside["root"].iloc[0]
        folded = [fold(leaf, path) for leaf, path in zip(found, paths, strict=True)]
        return pd.DataFrame({
            "id": nodes["id"], "tree": nodes["tree"], "leaf": nodes["digest"], "subroot": outside["subroot"].iloc[0],
            "root": root, "proof": paths, "folded_root": folded, "verified": [f == root for f in folded],
        })

    # as text: pandas has no whole numbers beside nulls
    blocks = leaves.withColumn("id", F.col("id").cast("string")).withColumn("block", _block(height)).groupBy("tree", "block")
    schema = "id string, tree string, leaf string, subroot string, root string, proof string, folded_root string, verified boolean"
    done = blocks.cogroup(ways.withColumnRenamed("idx", "block").groupBy("tree", "block")).applyInPandas(finish, schema)
    grouped = F.when(F.startswith("tree", F.lit("v")), F.substring("tree", 2, 2**31 - 1))
    return done.select(
        F.col("id").cast(key_type).alias(key), grouped.cast(group_type).alias(group),
        "leaf", "subroot", "root", "proof", "folded_root", "verified",
    )


def _numbered(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """The nodes with ``idx``, their number in their tree from 0."""
    idx = fresh(nodes, "number")
    counted = scanned(nodes, "tree", order, lambda _: (1,), lambda a, b: (a[0] + b[0],), [], f"{idx} long")
    return counted.withColumn("idx", F.col(idx) - 1).drop(idx)


def proof_digest(proof: Column) -> Column:
    """The digest of a proof's siblings, level by level, left to right."""
    return F.sha2(F.regexp_replace(proof, "[|,]", "").cast("binary"), 256)
