"""The batch steps: raw to bronze, bronze to silver, and repair."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.functions.extras import merged
from oreflow.functions.files import delete_folder
from oreflow.operators import explode_records, flatten, repair, split, stamp, strict, verdict
from oreflow.operators import budget_only as budget_rule
from oreflow.operators.quality import CLEAN, QUARANTINE, Rule, counts
from oreflow.plans.counting import Counted
from oreflow.plans.status import LOAD, REPAIR, settle, undo_unfinished
from oreflow.schemas import (
    BATCH,
    BRONZE,
    BRONZE_PARTS,
    DATE_FIELDS,
    FILES,
    INGEST_DATE,
    RECORD,
    RECORD_FIELDS,
    REJECTS,
    SILVER,
    SILVER_PARTS,
    STEP,
)
from oreflow.settings import LOADED, NEW, QUARANTINED, Settings
from oreflow.sinks import append_rows, drop_partitions, table_exists, write_snapshot
from oreflow.sinks.sketches import run_of, sketch_run
from oreflow.sinks.tables import partitions
from oreflow.sources import read_json_batch, read_status, split_rejects, with_extra_fields
from oreflow.sources.json_files import is_rejected
from oreflow.sources.large import split_documents
from oreflow.sources.ledger import arrived, listed_files, not_copies, with_digest

PAYLOAD = "movie"
# Names that a partition cannot be told from a null or from another by.
NO_NAMES = ("", "null", "__HIVE_DEFAULT_PARTITION__")


def rules_of(cfg: Settings, prefix: str = "") -> list[Rule]:
    budget, runtime = f"{prefix}Budget", f"{prefix}RunTime"
    if cfg.rules == "budget_only":
        return budget_rule(cfg.floor, budget)
    if cfg.rules == "strict":
        return strict(cfg.floor, budget, runtime)
    raise ValueError(f"rules must be 'strict' or 'budget_only', not {cfg.rules!r}")


def flat(bronze: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return flatten(bronze, PAYLOAD, list(RECORD_FIELDS), DATE_FIELDS, keep)


def repaired(rows: DataFrame, cfg: Settings) -> DataFrame:
    return repair(rows, abs_cols=["RunTime"], floors={"Budget": cfg.floor}, whole_cols=["Budget"])


def run_time(spark: SparkSession, cfg: Settings) -> dt.datetime:
    """The one time of a run, in the session's time zone."""
    if cfg.batch_ts is not None:
        return cfg.batch_ts
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return dt.datetime.fromisoformat(spark.range(1).select(now).first()[0])


def unread_files(spark: SparkSession, cfg: Settings, batch: str, run: str) -> list[str]:
    """The raw files that no other batch has read, noted in the ledger as those of this run.

    A run's notes count from the moment on that bronze has its records; so a run that fails leaves none. Files
    that are copies of others are noted too, but not read. A batch that is run again may read its files again.
    """
    ledger, parts = cfg.table("raw_files"), [BATCH, STEP]
    files = listed_files(spark, cfg.raw_path)
    if cfg.modified_after is not None:
        files = files.filter(F.col("modified") > F.lit(cfg.modified_after).cast("timestamp"))
    if table_exists(spark, ledger):
        drop_partitions(spark, ledger, lambda part: (part[BATCH], part[STEP]) == (batch, run))
    bronze = cfg.table("bronze")
    there = partitions(spark, bronze) if table_exists(spark, bronze) else []
    runs = {f"{p[BATCH]}/{run_of(p[STEP])}" for p in there if p[BATCH] != batch and run_of(p[STEP]) is not None}
    known = spark.table(ledger) if table_exists(spark, ledger) else _none(spark, FILES)
    known = known.filter(F.concat_ws("/", BATCH, STEP).isin(sorted(runs)) if runs else F.lit(False))
    new = with_digest(spark, arrived(files, known))
    noted = new.withColumn(BATCH, F.lit(batch)).withColumn(STEP, F.lit(run))
    append_rows(noted, ledger, FILES, cfg.path("raw_files"), parts, one_value=True)
    mine = spark.table(ledger).filter((F.col(BATCH) == batch) & (F.col(STEP) == run))
    return [row["path"] for row in not_copies(mine, known).collect()]


def raw_schema(spark: SparkSession, cfg: Settings) -> T.StructType:
    """The raw documents' schema: the listed fields of a record and others at any depth, as the settings ask for."""
    if cfg.record is not None:
        record = merged(RECORD, cfg.record)
    elif cfg.extra_fields == "keep":
        record = with_extra_fields(spark, cfg.raw_path, PAYLOAD, RECORD, cfg.multiline, cfg.modified_after)
    elif cfg.extra_fields == "ignore":
        record = RECORD
    else:
        raise ValueError(f"extra_fields must be 'keep' or 'ignore', not {cfg.extra_fields!r}")
    return T.StructType([T.StructField(PAYLOAD, T.ArrayType(record))])


def raw_to_bronze(spark: SparkSession, cfg: Settings, reset: bool = False) -> dict:
    """Add the raw files' records to bronze as one batch; with ``reset``, replace all of bronze and its rejects.

    A batch of the same name is replaced, so a run may be repeated. The new rows are written as a run of their
    own, which the catalog gets to know when the write has finished; then the old ones go, and what silver had
    of them. A run that fails leaves both layers as they were; one that stops later is finished by the next step.
    A reset empties silver too, as bronze then has none of its records.

    Documents that cannot be read in full are counted on the way. Only if there are any, or their number did not
    arrive, does a second pass write them to the rejects table. Records are counted by the written files' footers.
    """
    now = run_time(spark, cfg)
    batch = cfg.batch or now.strftime("%Y%m%dT%H%M%S.%f")
    if batch in NO_NAMES:
        raise ValueError(f"a batch cannot be called {batch!r}")
    bronze, silver = cfg.table("bronze"), cfg.table("silver")
    undo_unfinished(spark, bronze, silver)
    there = partitions(spark, bronze) if table_exists(spark, bronze) else []
    run = 1 + max((run_of(part[STEP]) or 0 for part in there if part[BATCH] == batch), default=-1)
    if cfg.ledger:
        cfg = replace(cfg, raw=unread_files(spark, cfg, batch, str(run)), modified_after=None)
    pieces = f"{cfg.path('split')}/{batch_folder(batch)}-{run}"
    if cfg.split:
        paths = cfg.raw_path if cfg.modified_after is None else _changed_after(spark, cfg)
        if paths:
            paths = split_documents(spark, paths, PAYLOAD, pieces)
        cfg = replace(cfg, raw=paths, modified_after=None, multiline=False)
    schema = raw_schema(spark, cfg)
    raw = read_json_batch(spark, cfg.raw_path, schema, cfg.multiline, cfg.modified_after)
    documents = Counted(
        raw,
        [
            F.count(F.lit(1)).alias("documents"),
            F.count_if(is_rejected(PAYLOAD)).alias("rejected"),
            F.sum(F.coalesce(F.array_size(PAYLOAD), F.lit(0))).alias("records"),
        ],
    )
    records = explode_records(documents.rows, PAYLOAD, PAYLOAD)
    if cfg.spread:
        records = records.hint("rebalance")
    rows = stamp(records, PAYLOAD, cfg.datasource, now, batch, RECORD).withColumn(STEP, F.lit(str(run)))
    if reset:
        write_snapshot(rows, bronze, BRONZE, cfg.path("bronze"), BRONZE_PARTS, one_value=True)
    else:
        append_rows(rows, bronze, BRONZE, cfg.path("bronze"), BRONZE_PARTS, one_value=True)
        drop_partitions(spark, bronze, lambda part: part[BATCH] == batch and part[STEP] != str(run))
    if table_exists(spark, silver):  # what an earlier run of this batch had loaded
        drop_partitions(spark, silver, lambda part: reset or part[BATCH] == batch)
    mine = spark.table(bronze).filter((F.col(BATCH) == batch) & (F.col(STEP) == str(run)))
    report = documents.counts() or {"documents": None, "rejected": None}
    report["records"] = mine.count()
    sketch_run(spark, bronze, batch, run, mine, report["records"])
    if report["rejected"] != 0 or table_exists(spark, cfg.table("rejects")):
        rejects = split_rejects(raw, PAYLOAD)[1] if report["rejected"] != 0 else _none(spark, REJECTS)
        rejects = rejects.withColumn(INGEST_DATE, F.lit(now.date())).withColumn(BATCH, F.lit(batch))
        _add_batch(rejects, cfg, "rejects", REJECTS, [BATCH], batch, reset)
    if cfg.split:
        delete_folder(spark, pieces)
    return report


def batch_folder(batch: str) -> str:
    """A folder's name for a batch, whose own name may hold any sign."""
    return hashlib.md5(batch.encode()).hexdigest()


def _changed_after(spark: SparkSession, cfg: Settings) -> list[str]:
    files = listed_files(spark, cfg.raw_path)
    return [r["path"] for r in files.filter(F.col("modified") > F.lit(cfg.modified_after).cast("timestamp")).collect()]


def _none(spark: SparkSession, schema: T.StructType) -> DataFrame:
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(0).select(*columns)


def _add_batch(
    rows: DataFrame, cfg: Settings, layer: str, schema: T.StructType, parts: Sequence[str], batch: str, reset: bool
) -> None:
    spark, table = rows.sparkSession, cfg.table(layer)
    if reset:
        write_snapshot(rows, table, schema, cfg.path(layer), parts, one_value=True)
        return
    if table_exists(spark, table):
        drop_partitions(spark, table, lambda part: part[BATCH] == batch)
    append_rows(rows, table, schema, cfg.path(layer), parts, one_value=True)


def _load(cfg: Settings, rows: DataFrame, steps: set[tuple[str, str]]) -> None:
    """Add rows of these batches and steps to silver, instead of what is there of them."""
    spark, table = rows.sparkSession, cfg.table("silver")
    parts = [*SILVER_PARTS, *cfg.silver_partition_by]
    if table_exists(spark, table):
        drop_partitions(spark, table, lambda part: (part[BATCH], part[STEP]) in steps)
    append_rows(rows, table, SILVER, cfg.path("silver"), parts, one_value=not cfg.silver_partition_by)


def _loaded(spark: SparkSession, cfg: Settings, steps: set[tuple[str, str]]) -> DataFrame:
    """The loaded records among the rows that a step has just written, flat."""
    here = F.concat_ws("/", BATCH, STEP).isin(sorted(f"{batch}/{step}" for batch, step in steps))
    return flat(read_status(spark, cfg.table("bronze"), LOADED).filter(here), SILVER_PARTS)


def bronze_to_silver(spark: SparkSession, cfg: Settings) -> dict:
    """Settle every new row's status, and add the loaded ones to silver.

    The new rows are read once: routed, counted and written by status. Silver is filled from what was written,
    before the old rows go, so a run that is cut short is taken back by the next one and then done again.
    Returns the counts by route.
    """
    undo_unfinished(spark, cfg.table("bronze"), cfg.table("silver"))
    if not table_exists(spark, cfg.table("silver")):
        _load(cfg, _none(spark, SILVER), set())
    rules, batch = rules_of(cfg, f"{PAYLOAD}."), []
    route = verdict(rules, cfg.unrouted)
    outcome = F.when(route == CLEAN, LOADED).when(route == QUARANTINE, QUARANTINED)

    def seen(rows: DataFrame) -> DataFrame:
        batch.append(Counted(rows, counts(rules)))
        return batch[0].rows

    settle(
        spark, cfg.table("bronze"), NEW, outcome, LOAD, seen=seen,
        before_old_go=lambda steps: _load(cfg, _loaded(spark, cfg, steps), steps),
    )
    if not batch:  # nothing was new
        return spark.range(0).select(*[F.lit(None).alias(c) for c in ("Budget", "RunTime")]).agg(
            *counts(rules_of(cfg))
        ).first().asDict()
    return batch[0].counts() or {}


def repair_quarantined(spark: SparkSession, cfg: Settings) -> int:
    """Repair the quarantined records, add them to silver and mark them loaded.

    Returns how many records are still quarantined, which should be none. May be repeated, as the load.
    """
    bronze = cfg.table("bronze")
    undo_unfinished(spark, bronze, cfg.table("silver"))
    settle(
        spark, bronze, QUARANTINED, F.lit(LOADED), REPAIR,
        before_old_go=lambda steps: _load(cfg, repaired(_loaded(spark, cfg, steps), cfg), steps),
    )
    return read_status(spark, bronze, QUARANTINED).count()


def rebuild_silver(spark: SparkSession, cfg: Settings) -> None:
    """Replace silver by what bronze says is loaded: clean records as they are, the others repaired."""
    loaded = flat(read_status(spark, cfg.table("bronze"), LOADED), SILVER_PARTS)
    good, rest = split(loaded, rules_of(cfg))
    rows = good.unionByName(repaired(rest, cfg))
    parts = [*SILVER_PARTS, *cfg.silver_partition_by]
    # as in the load, tasks read one batch each, mostly: without further parts there is nothing to bring together
    one_value = not cfg.silver_partition_by
    write_snapshot(rows, cfg.table("silver"), SILVER, cfg.path("silver"), parts, one_value=one_value)
