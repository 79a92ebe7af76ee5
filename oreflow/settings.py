"""Where the layers live and which rules a run applies."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# Record statuses, the budget floor and the table names users query.
NEW, LOADED, QUARANTINED = "new", "loaded", "quarantined"
BUDGET_FLOOR = 1_000_000
TABLES = {
    "bronze": "movie_bronze",
    "silver": "master_silver",
    "movie": "movie_silver",
    "genre": "genres_silver",
    "language": "originalLanguage_silver",
    "movie_genre": "movieGenres_silver",
}


@dataclass(frozen=True)
class Settings:
    """One pipeline: a folder with a raw layer, and the tables built from it.

    ``root`` has to be a folder that every executor can reach. ``rules`` is ``strict`` (runtime and
    budget) or ``budget_only``. ``unrouted`` says what happens to rows no rule can decide, because a
    value is null: ``quarantine`` them or ``keep`` them as they are. ``spread`` shares the records of
    few or uneven raw files out over the cluster after parsing, for one shuffle of the batch; files
    that are many and alike do better without.

    ``raw`` is a folder or a list of paths, of which only files changed after ``modified_after`` are read.
    ``split`` is for multi-line documents too large for one task: a pass of its own splits them at their records, among
    many tasks, into JSON Lines under ``root``.
    With ``ledger`` the files that a run reads are kept in a table, and later runs read those alone that it lacks: late
    files with old times are read, and a file sent again, with the same lines under any name or time, is not.
    ``batch`` names the run's batch; a run of the same batch replaces it. Without a name it is called after
    the batch's time. ``extra_fields`` says what becomes of raw fields that are not listed: ``keep`` finds
    them by a pass over the raw files, ``ignore`` saves that pass for feeds known to have none. ``record``, the
    type of a raw record, names them without a pass.
    """

    root: str
    datasource: str
    database: str = "default"
    raw: str | Sequence[str] | None = None
    modified_after: str | None = None
    ledger: bool = False
    batch: str | None = None
    extra_fields: str = "keep"
    record: T.StructType | None = None
    multiline: bool = True
    spread: bool = False
    split: bool = False
    floor: float = BUDGET_FLOOR
    rules: str = "strict"
    unrouted: str = "quarantine"
    batch_ts: dt.datetime | None = None
    silver_partition_by: tuple[str, ...] = ()
    tables: dict[str, str] = field(default_factory=lambda: dict(TABLES))

    @property
    def raw_path(self) -> str | Sequence[str]:
        return f"{self.root}/raw" if self.raw is None else self.raw

    def table(self, layer: str) -> str:
        return f"{self.database}.{self.tables.get(layer, layer)}"

    def path(self, layer: str) -> str:
        return f"{self.root}/{layer}"


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name in the folder all executors share: ``spark.checkpoint.dir``, else the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/oreflow/{label}-{uuid.uuid4().hex}"
