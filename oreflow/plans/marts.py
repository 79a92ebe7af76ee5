"""The mart tables, rebuilt as a whole or kept up by batch."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.functions.files import delete_folder
from oreflow.operators import code_dimension, dimension, entity, junction
from oreflow.operators.quality import clean
from oreflow.plans.layers import flat, rules_of
from oreflow.plans.status import undo_unfinished
from oreflow.schemas import (
    BRONZE_PARTS,
    GENRE,
    LANGUAGE,
    MOVIE,
    MOVIE_COLUMNS,
    MOVIE_GENRE,
    SILVER_PARTS,
    STATUS,
)
from oreflow.settings import LOADED, Settings
from oreflow.sinks import append_rows, drop_partitions, partitions, table_exists, write_snapshot
from oreflow.sinks.tables import CATALOG
from oreflow.sources import read_status
from oreflow.sources.tables import location_of

# The partition column of a mart that is kept up: which partition of silver or bronze a row came from.
ORIGIN = "origin"


@dataclass(frozen=True)
class Mart:
    """How a mart's rows follow from its layer's, and whether a row stands once however often it arises."""

    schema: T.StructType
    layer: str
    rows: Callable[[DataFrame], DataFrame]
    once: bool = True


def marts_of(cfg: Settings, language_names: DataFrame | str = "English") -> dict[str, Mart]:
    """Movie and language come from silver. Genre and junction come from the loaded bronze records that pass the
    rules as they arrived, so records loaded after repair are not among them."""

    def good(bronze: DataFrame) -> DataFrame:
        return clean(flat(bronze), rules_of(cfg))

    return {
        "movie": Mart(MOVIE, "silver", lambda rows: entity(rows, MOVIE_COLUMNS), once=False),
        "genre": Mart(GENRE, "bronze", lambda rows: dimension(good(rows), "genres")),
        "language": Mart(LANGUAGE, "silver", lambda rows: code_dimension(rows, "OriginalLanguage", language_names)),
        "movie_genre": Mart(MOVIE_GENRE, "bronze", lambda rows: junction(good(rows), "Id", "genres.id")),
    }


def _together(spark: SparkSession, cfg: Settings, marts: dict[str, Mart], write: Callable[[str], None]) -> None:
    """Four independent jobs: run together, one fills the executors another leaves idle."""
    with ThreadPoolExecutor(len(marts)) as pool:
        list(pool.map(inheritable_thread_target(spark)(write), marts))


def _source(spark: SparkSession, cfg: Settings, mart: Mart) -> DataFrame:
    return spark.table(cfg.table("silver")) if mart.layer == "silver" else read_status(spark, cfg.table("bronze"), LOADED)


def build_marts(spark: SparkSession, cfg: Settings, language_names: DataFrame | str = "English") -> None:
    """Rebuild the movie, genre, language and movie-genre tables from all that is loaded."""
    marts = marts_of(cfg, language_names)

    def write(name: str) -> None:
        table, mart = cfg.table(name), marts[name]
        with CATALOG:
            if _is_view(spark, table):
                spark.sql(f"DROP VIEW {table}")
        write_snapshot(mart.rows(_source(spark, cfg, mart)), table, mart.schema, cfg.path(name))

    _together(spark, cfg, marts, write)


def update_marts(spark: SparkSession, cfg: Settings, language_names: DataFrame | str = "English") -> dict[str, list[int]]:
    """Bring the four marts up to date with what is loaded; a run costs what has changed since the last one.

    Each mart is a view over a table whose partitions say which partition of silver or bronze their rows came
    from. Partitions that are new there are read and added. Movie drops the rows of those that have gone.
    Genre, language and junction hold a row once: of a new partition's rows those are added that are not there
    yet, and if a partition has gone, they are made anew, as nobody knows which of its rows others have too.

    May be repeated, after a stop as well: a partition counts as read when the catalog lists it. The stored rows
    of the distinct marts are scanned for those that come again; they are not shuffled if the new ones are few.
    Names of languages already there keep what they were; after a change of names use ``build_marts``.
    Returns how many partitions each mart has read and dropped.
    """
    undo_unfinished(spark, cfg.table("bronze"), cfg.table("silver"))
    marts, report = marts_of(cfg, language_names), {}
    origins = {
        "silver": _origins(partitions(spark, cfg.table("silver")), SILVER_PARTS),
        "bronze": _origins([p for p in partitions(spark, cfg.table("bronze")) if p[STATUS] == LOADED], BRONZE_PARTS),
    }

    def write(name: str) -> None:
        mart, table, want = marts[name], _parts(cfg, name), set(origins[marts[name].layer])
        there = table_exists(spark, table)
        have = {part[ORIGIN] for part in partitions(spark, table)} if there else set()
        new, gone = want - have, have - want
        again = mart.once and bool(gone)
        if again:
            new = want
        report[name] = [len(new), len(gone)]
        if gone and not again:
            with CATALOG:
                drop_partitions(spark, table, lambda part: part[ORIGIN] in gone)
        if new or not there:
            _add(spark, cfg, name, mart, new, replace=again or not there)
        with CATALOG:
            _show(spark, cfg, name, mart)

    _together(spark, cfg, marts, write)
    return report


def _parts(cfg: Settings, name: str) -> str:
    return f"{cfg.table(name)}_parts"


def _name_of(values: Sequence[str | None]) -> str:
    return hashlib.md5("/".join(str(v) for v in values).encode()).hexdigest()


def _origins(parts: Sequence[dict], columns: Sequence[str]) -> set[str]:
    return {_name_of([part[c] for c in columns]) for part in parts}


def _origin(columns: Sequence[str]) -> Column:
    return F.md5(F.concat_ws("/", *[F.col(c).cast("string") for c in columns]).cast("binary"))


def _add(spark: SparkSession, cfg: Settings, name: str, mart: Mart, new: set[str], replace: bool) -> None:
    """Add the rows of the new partitions and then list those that added none, so that they count as read."""
    table, schema = _parts(cfg, name), T.StructType([*mart.schema.fields, T.StructField(ORIGIN, T.StringType())])
    columns = SILVER_PARTS if mart.layer == "silver" else BRONZE_PARTS
    places = {_name_of([p[c] for c in columns]): p for p in partitions(spark, cfg.table(mart.layer))}
    # a filter on partition columns alone
    some = F.concat_ws("/", *[F.col(c).cast("string") for c in columns]).isin(
        ["/".join(str(places[origin][c]) for c in columns) for origin in sorted(new)]
    )
    source = _source(spark, cfg, mart).filter(some).withColumn(ORIGIN, _origin(columns))
    if mart.once:
        # the rows of all new partitions are made distinct together, and stand with one of them
        rows = mart.rows(source).withColumn(ORIGIN, F.lit(min(new, default="")))
        if not replace:
            stored = spark.table(table).alias("stored")
            same = reduce(and_, [F.col(f"new.{c}").eqNullSafe(F.col(f"stored.{c}")) for c in mart.schema.names])
            known = stored.join(rows.alias("new"), same, "left_semi").alias("stored")
            rows = rows.alias("new").join(known, same, "left_anti")
    else:
        rows = source.select(*[F.col(c) for c in mart.schema.names], ORIGIN)
    if replace:
        write_snapshot(rows, table, schema, cfg.path(f"{name}_parts"), [ORIGIN])
    else:
        place = location_of(spark, table).rstrip("/")
        for origin in new:  # what a run that was lost while it wrote may have left there
            delete_folder(spark, f"{place}/{ORIGIN}={origin}")
        append_rows(rows, table, schema, cfg.path(f"{name}_parts"), [ORIGIN])
    with CATALOG:
        rest = sorted(new - {part[ORIGIN] for part in partitions(spark, table)})
        for k in range(0, len(rest), 100):
            specs = " ".join(f"PARTITION ({ORIGIN} = '{origin}')" for origin in rest[k : k + 100])
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")


def _is_view(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType == "VIEW"


def _show(spark: SparkSession, cfg: Settings, name: str, mart: Mart) -> None:
    """The mart under its own name: the parts without their origin."""
    table = cfg.table(name)
    if spark.catalog.tableExists(table) and not _is_view(spark, table):
        spark.sql(f"DROP TABLE {table}")
    columns = ", ".join(f"`{c}`" for c in mart.schema.names)
    if not spark.catalog.tableExists(table):
        spark.sql(f"CREATE VIEW {table} AS SELECT {columns} FROM {_parts(cfg, name)}")
