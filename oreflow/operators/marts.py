"""Normalising the silver table into entity, dimension and junction tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.operators.records import explode_nested


def entity(silver: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The named columns in the given order; duplicate records stay."""
    return silver.select(*cols)


def named_items(df: DataFrame, path: str, id_col: str = "id", name_col: str = "name") -> DataFrame:
    """Every array element's id and trimmed name, without blank names and missing values."""
    items = explode_nested(df, path, [id_col, name_col])
    items = items.select(id_col, F.trim(name_col).alias(name_col))
    return items.where(F.col(name_col) != "").dropna("any")


def dimension(df: DataFrame, path: str, id_col: str = "id", name_col: str = "name") -> DataFrame:
    """The distinct id and name pairs of a nested array. Sort at read: order is not stored."""
    return named_items(df, path, id_col, name_col).distinct()


def code_dimension(df: DataFrame, code_col: str, names: DataFrame | str) -> DataFrame:
    """Distinct codes with a name: one constant, or looked up in a (code, name) table.

    Codes are made distinct before the look-up, so only as many rows are joined as there are codes,
    and Spark picks the join from the sizes it sees at run time.
    """
    codes = df.select(F.col(code_col).alias("code")).distinct()
    if isinstance(names, str):
        return codes.select("code", F.lit(names).alias("name"))
    return codes.join(names.select("code", "name"), "code", "left")


def junction(
    df: DataFrame,
    id_col: str,
    array_path: str,
    parent: str = "movie_id",
    child: str = "genres_id",
    within: DataFrame | None = None,
) -> DataFrame:
    """Distinct (record id, element id) pairs; an element without an id gives a null.

    ``array_path`` ends in the element's id field, as ``genres.id``. ``within`` is a dimension: pass
    it to drop pairs whose element it does not list.
    """
    array, field = array_path.rsplit(".", 1)
    ids = df.select(F.col(id_col).alias(parent), F.col(f"{array}.{field}").alias("ids"))
    pairs = ids.select(parent, F.explode("ids").alias(child)).distinct()
    if within is None:
        return pairs
    return pairs.join(within.select(F.col("id").alias(child)), child, "left_semi").select(parent, child)
