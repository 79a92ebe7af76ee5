"""Times the library's steps on one data folder and prints one JSON line.

BENCH_SF_DIR names the folder, BENCH_CPUS the number of cores, BENCH_RUNS how often each step runs;
the median counts. Inputs (raw files, bronze) are written before the clock starts. The bytes each step
reads and shuffles and the rows it writes come from Spark's event log, in BENCH_EVENT_LOG or a temporary folder.
Three steps run after 3 and after 30 days of settled history: a small batch, the marts brought up to date, a merge
of one key. Each pair should take alike.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import tempfile
import time
from collections import Counter
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import queries as Q  # noqa: E402
from checks import records as R  # noqa: E402
from oreflow import Settings  # noqa: E402
from oreflow.operators import explode_records, profile, stamp, strict  # noqa: E402
from oreflow.plans import (  # noqa: E402
    bronze_to_silver, build_marts, raw_to_bronze, repair_quarantined, update_marts, update_status,
)
from oreflow.plans.layers import flat  # noqa: E402
from oreflow.schemas import BRONZE, BRONZE_PARTS, RAW, RECORD_KEY  # noqa: E402
from oreflow.settings import shared_folder  # noqa: E402
from oreflow.sinks import append_rows  # noqa: E402
from oreflow.sinks.sketches import sketch_run  # noqa: E402
from oreflow.sources import raw_files, read_json_batch  # noqa: E402

QUERIES = [
    "clean_strict", "quarantine_strict", "route_counts", "profile_counts", "struct_key_merge",
    "record_key_merge", "repair_rows", "item_dimension", "record_item_junction", "language_dimension",
    "movie_table", "blank_name_filter", "dedup_rows", "sorted_junction",
]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
    )
    log_dir = os.environ.get("BENCH_EVENT_LOG") or tempfile.mkdtemp(prefix="oreflow-bench-")
    log = {"enabled": "true", "dir": log_dir, "rolling.enabled": "false", "compress": "false"}
    for key, value in log.items():
        builder = builder.config(f"spark.eventLog.{key}", value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    raw_path = R.documents(spark, sf_dir, "movie")
    n_records = R.bronze(spark, sf_dir).count()

    def ingest():
        drain(explode_records(read_json_batch(spark, raw_path, RAW), "movie", "movie"))

    def ingest_and_stamp():
        drain(stamp(explode_records(read_json_batch(spark, raw_path, RAW), "movie", "movie"), "movie", "orders"))

    def flatten_and_profile():
        rows = explode_records(read_json_batch(spark, raw_path, RAW), "movie", "movie")
        drain(profile(flat(rows), strict()))

    steps = {
        "json_read_explode": ingest,
        "json_read_explode_stamp": ingest_and_stamp,
        "json_flatten_profile": flatten_and_profile,
        **{name: (lambda name=name: drain(Q.QUERIES[name](spark, sf_dir))) for name in QUERIES},
    }
    taken: dict[str, list[float]] = {}

    def clock(name, step):
        spark.sparkContext.setJobDescription(name)
        start = time.perf_counter()
        step()
        taken.setdefault(name, []).append(time.perf_counter() - start)
        spark.sparkContext.setJobDescription(None)

    for name, step in steps.items():
        step()  # warm up
        for _ in range(runs):
            clock(name, step)

    for attempt in range(runs + 1):
        cfg = Settings(
            root=shared_folder(spark, "bench"), raw=raw_path, datasource="orders",
            database=Q.database(spark), batch_ts=dt.datetime(2024, 1, 1),
        )
        if attempt == 1:
            for name in [n for n in taken if n.startswith("run_")]:
                del taken[name]  # the first round was the warm-up
        clock("run_raw_to_bronze", lambda: raw_to_bronze(spark, cfg))
        clock("run_bronze_to_silver", lambda: bronze_to_silver(spark, cfg))
        clock("run_build_marts", lambda: build_marts(spark, cfg))
        clock("run_repair", lambda: repair_quarantined(spark, cfg))
        assert spark.table(cfg.table("bronze")).filter(F.col("status") == "loaded").count() == n_records

    files = [row["path"] for row in raw_files(spark, raw_path).orderBy("path").limit(4).collect()]
    for days in (3, 30):
        cfg = Settings(
            root=shared_folder(spark, "history"), raw=files[:3], datasource="orders", database=Q.database(spark),
        )
        history(spark, cfg, days)
        for attempt in range(runs + 1):
            new = replace(cfg, raw=files[3:], batch_ts=dt.datetime(2024, 3, 1, attempt))

            def load(new=new):
                raw_to_bronze(spark, new)
                bronze_to_silver(spark, new)

            clock(f"run_new_batch_after_{days}_days", load)
            clock(f"run_update_marts_after_{days}_days", lambda: update_marts(spark, cfg))
        table = cfg.table("bronze")
        one = spark.table(table).filter("p_ingestdate = date '2024-03-01'").agg(F.min(RECORD_KEY))
        one = spark.createDataFrame([(bytes(one.first()[0]),)], f"{RECORD_KEY} binary")
        for attempt in range(runs + 1):
            status = ("quarantined", "loaded")[attempt % 2]
            clock(f"run_small_merge_after_{days}_days", lambda status=status: update_status(spark, table, one, status))
        for step in ("new_batch", "update_marts", "small_merge"):
            taken[f"run_{step}_after_{days}_days"].pop(0)

    medians = {name: round(statistics.median(times), 4) for name, times in taken.items()}
    result = {
        "metric": "total seconds, median per step",
        "value": round(sum(medians.values()), 3),
        "unit": "sec",
        "queries": medians,
        "records": n_records,
        "records_per_sec": {n: round(n_records / t) for n, t in medians.items() if t > 0},
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cpus": int(cpus),
    }
    app = spark.sparkContext.applicationId
    spark.stop()
    times = {n: runs + 1 if n.startswith("run_") else runs for n in medians}
    moved, rows, read = moved_by_step(f"{log_dir}/{app}")
    result["shuffle_bytes"] = {n: moved.get(n, 0) // times[n] for n in medians}
    result["bytes_read"] = {n: read.get(n, 0) // times[n] for n in medians}
    result["rows_written"] = {n: rows.get(n, 0) // times[n] for n in medians}
    print(json.dumps(result))


def history(spark, cfg: Settings, days: int) -> None:
    """Bronze with that many days of settled batches, written at once."""
    raw = read_json_batch(spark, cfg.raw_path, RAW)
    rows = stamp(explode_records(raw, "movie", "movie"), "movie", "orders", dt.datetime(2024, 1, 1), "day")
    day = F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("day")
    rows = rows.select("*", day).withColumn("p_ingestdate", F.date_add("p_ingestdate", F.col("day")))
    rows = rows.withColumn("batch", F.concat("batch", F.col("day").cast("string"))).withColumn("step", F.lit("0l"))
    status = F.when(F.col("movie.Budget") >= 1e6, "loaded").otherwise("quarantined")
    rows = rows.withColumn("status", status).drop("day")
    append_rows(rows, cfg.table("bronze"), BRONZE, cfg.path("bronze"), BRONZE_PARTS)
    for day in range(days):
        mine = spark.table(cfg.table("bronze")).filter(F.col("batch") == f"day{day}")
        sketch_run(spark, cfg.table("bronze"), f"day{day}", 0, mine, mine.count())


def moved_by_step(log: str) -> tuple[Counter, Counter, Counter]:
    """Shuffle bytes, rows written and bytes read per job description."""
    step_of, moved, rows, read = {}, Counter(), Counter(), Counter()
    with open(log) as events:
        for event in map(json.loads, events):
            if event["Event"] == "SparkListenerJobStart":
                name = event["Properties"].get("spark.job.description")
                step_of.update(dict.fromkeys(event["Stage IDs"], name))
            elif event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                metrics, step = event["Task Metrics"], step_of.get(event["Stage ID"])
                moved[step] += metrics["Shuffle Write Metrics"]["Shuffle Bytes Written"]
                rows[step] += metrics["Output Metrics"]["Records Written"]
                read[step] += metrics["Input Metrics"]["Bytes Read"]
    return moved, rows, read


if __name__ == "__main__":
    main()
