"""The nine datasets by name, and how to refresh them all."""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.plans import masters
from ledgerloom.plans.backlog import backlog
from ledgerloom.plans.invoicing import invoicing
from ledgerloom.sinks.tables import RETAINED, catalog_name, load
from ledgerloom.sources.erp import Tables
from ledgerloom.sources.scripts import checked_scripts, run_script

DATASETS: dict[str, Callable[[Tables], DataFrame]] = {
    "invoicing": invoicing,
    "order_backlog": backlog,
    "customers": masters.customers,
    "suppliers": masters.suppliers,
    "product_groups": masters.product_groups,
    "stores": masters.stores,
    "products": masters.products,
    "properties": masters.properties,
    "users": masters.users,
}

RUN_SCHEMA = "dataset string, succeeded boolean, records bigint, message string, seconds double"

Job = tuple[str, Callable[[], DataFrame | None]]


def refresh(
    spark: SparkSession, jobs: Iterable[Job], folder: str, run_log: str | None = None, parallel: int = 4,
    mode: str = "refresh", retain: int = RETAINED, batch: str | None = None,
) -> DataFrame:
    """Refresh one table per job; a failing job is reported and does not stop the others.

    Returns one row per job and adds them to the run log table when one is named. Jobs are
    independent, so a few of them are submitted at a time and share the cluster. With mode
    "append" rows are added to the tables instead, once per name of a `batch`. Jobs that lead to the same table are errors,
    all of them: none may overwrite what another one loads. An error's text is kept whole.
    """
    jobs = list(jobs)
    targets = Counter(catalog_name(name) for name, _ in jobs)

    def run(job: Job) -> tuple[str, bool, int, str, float]:
        name, build = job
        started = time.monotonic()
        try:
            if targets[catalog_name(name)] > 1:
                raise ValueError(f"{targets[catalog_name(name)]} jobs lead to the table {catalog_name(name)}")
            df = build()
            if df is None:
                return name, False, 0, "nothing to run", time.monotonic() - started
            done = load(df, name, folder, mode, retain, batch)
            did = "created" if done.created else "refreshed" if mode == "refresh" else "repeated" if done.repeated else "appended"
            return name, True, done.rows, did, time.monotonic() - started
        except Exception as error:  # noqa: BLE001 - reported per dataset
            return name, False, 0, f"{type(error).__name__}: {error}", time.monotonic() - started

    with ThreadPoolExecutor(parallel) as pool:
        runs = spark.createDataFrame(list(pool.map(run, jobs)), RUN_SCHEMA)
    if run_log:
        load(runs, run_log, folder, "append")
    return runs


def refresh_datasets(spark: SparkSession, tables: Tables, folder: str, names: Iterable[str] | None = None, **options) -> DataFrame:
    """Refresh the named datasets, all nine by default."""
    chosen = list(names) if names is not None else list(DATASETS)
    return refresh(spark, [(n, lambda n=n: DATASETS[n](tables)) for n in chosen], folder, **options)


def refresh_scripts(spark: SparkSession, found: DataFrame, folder: str, **options) -> DataFrame:
    """Refresh the target table of every valid script; invalid ones are reported as failed.

    Names and verdicts come to the driver first, then the text of one script at a time for each
    job that is running; results are written by the executors.
    """
    rows = checked_scripts(found).select("name", "table_name", "valid", "message").collect()

    def job(row) -> Job:
        def build() -> DataFrame | None:
            if not row["valid"]:
                raise ValueError(f"script is not valid: {row['message']}")
            return run_script(spark, found.where(F.col("name") == row["name"]).select("text").first()["text"])
        return row["table_name"], build

    return refresh(spark, [job(r) for r in rows], folder, **options)
