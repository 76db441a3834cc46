"""Stage tables: results that several parts of a report need, computed once.

A stage is written to the shared work folder and read back. Its consumers read the few rows that are left
instead of deriving them again, Spark plans them by the size that was written, and a lost
executor costs no more than the part since the last stage.

A stage also frees the disk of the shuffles below it (see session.SETTINGS), so a chain of joins over wide rows that is
cut by stages takes the disk of its widest part, not of its sum. A report whose rows fall into parts that do not need
each other is computed part by part (`staged_in_parts`): the stages of a part go when its rows are written, so on disk
are the rows of the parts before and the stages and shuffles of one part.

Keys are stages of one column set, each key once. A large table is reduced to the rows of such keys in two steps
below its first shuffle: the least and greatest key are a filter that reaches the scan and skips row groups of
tables stored in about the order of their keys, and a semi join whose keys are small enough is broadcast, or lets
Spark put a Bloom filter of the keys (see session.SETTINGS) under the exchange. So what is shuffled grows with
the keys, not with the history.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from dataclasses import dataclass
from typing import Any
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.joins import totals_by
from ledgerloom.session import work_folder

# Where stages are written now, if not straight to the work folder.
_FOLDER: ContextVar[str | None] = ContextVar("stage_folder", default=None)

# While a report is computed in parts: every part reads the whole facts, and a Bloom filter of its keys (2 MB, for some
# two million) keeps what other parts need below the exchange, for facts much smaller than those of session.SETTINGS.
# All filters of a plan travel with its tasks, so they are small and only put to facts of some size.
PART_SETTINGS = {
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "128MB",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "2000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": str(1 << 24),
}


def _stage_path(spark: SparkSession, name: str) -> str:
    return f"{_FOLDER.get() or work_folder(spark)}/{name}-{uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once."""
    spark = df.sparkSession
    path = _stage_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def at_once(*stages: Callable[[], Any]) -> list:
    """Results of stages that do not need each other, computed at the same time: small jobs leave no cores idle."""
    with ThreadPoolExecutor(len(stages)) as pool:
        return [x.result() for x in [pool.submit(copy_context().run, stage) for stage in stages]]


@contextmanager
def _writing_to(folder: str | None) -> Iterator[None]:
    before = _FOLDER.set(folder)
    try:
        yield
    finally:
        _FOLDER.reset(before)


@contextmanager
def freed(spark: SparkSession, name: str) -> Iterator[None]:
    """The files of all stages written inside go at the end. What is left is an empty table."""
    folder = _stage_path(spark, name)
    try:
        with _writing_to(folder):
            yield
    finally:
        spark.range(0).coalesce(1).write.mode("overwrite").parquet(folder)


def staged_alone(spark: SparkSession, compute: Callable[[], DataFrame], name: str) -> DataFrame:
    """What compute returns, staged; the stages that it wrote for that go."""
    outside = _FOLDER.get()
    with freed(spark, f"{name}_stages"):
        df = compute()
        with _writing_to(outside):
            return staged(df, name)


@contextmanager
def _settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def staged_in_parts(spark: SparkSession, parts: Sequence[Callable[[], DataFrame]], name: str) -> DataFrame:
    """The rows of all parts as one stage, computed one part after the other; each part's own stages go with it."""
    path = _stage_path(spark, name)
    with _settings(spark, PART_SETTINGS if len(parts) > 1 else {}):
        for part in parts:
            with freed(spark, f"{name}_stages"):
                df = part()
                schema = df.schema
                df.write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


@dataclass(frozen=True)
class Keys:
    """Different keys without a NULL, and the range of each of their columns."""

    rows: DataFrame
    count: int
    ranges: dict[str, tuple]


def staged_keys(df: DataFrame, columns: Mapping[str, str] | Sequence[str], name: str) -> Keys:
    """The different keys of df; columns: names in df, or name of the key -> name in df."""
    named = columns if isinstance(columns, Mapping) else {c: c for c in columns}
    known = df.selectExpr(*[f"`{source}` AS `{key}`" for key, source in named.items()]).dropna()
    once = totals_by(known, list(named), _n=F.count(F.lit(1))).drop("_n")
    seen = Observation()
    bounds = [f(key).alias(f"{at}_{key}") for key in named for at, f in (("least", F.min), ("greatest", F.max))]
    rows = staged(once.observe(seen, F.count(F.lit(1)).alias("count"), *bounds), name)
    found = seen.get
    return Keys(rows, found["count"], {key: (found[f"least_{key}"], found[f"greatest_{key}"]) for key in named})


def rows_of(df: DataFrame, keys: Keys, on: Mapping[str, str]) -> DataFrame:
    """Rows of df whose columns (left) hold one of the keys (right)."""
    if not keys.count:
        return df.where(F.lit(False))
    for column, key in on.items():
        df = df.where(F.col(column).between(*keys.ranges[key]))
    side = keys.rows.selectExpr(*[f"`{key}` AS `{column}`" for column, key in on.items()])
    return df.join(side, list(on), "left_semi")


def distinct_staged(df: DataFrame, name: str) -> DataFrame:
    """DISTINCT over wide rows that are mostly different already.

    The rows are staged with a digest. Only digests are grouped; rows whose digest no other row has stay where
    they are, and only the others are shuffled and compared as a whole. So the result is exact whatever the digest
    does, and a report without duplicates moves eight bytes a row.
    """
    if not df.columns:
        return df.distinct()
    return distinct_digested(staged(with_digest(df), name), name)


def with_digest(df: DataFrame) -> DataFrame:
    # The hash skips NULLs; the number behind each column tells which one was NULL.
    numbered = [x for i, c in enumerate(df.columns) for x in (F.col(f"`{c}`"), F.lit(i))]
    return df.withColumn("_digest", F.xxhash64(*numbered))


def distinct_digested(rows: DataFrame, name: str) -> DataFrame:
    """The different rows of a stage that was written with its digests."""
    repeated = staged_keys(totals_by(rows, ["_digest"], _rows=F.count(F.lit(1))).where("_rows > 1"), ["_digest"], f"{name}_repeated")
    if not repeated.count:
        return rows.drop("_digest")
    alone = rows.join(repeated.rows, ["_digest"], "left_anti").drop("_digest")
    once = rows_of(rows, repeated, {"_digest": "_digest"}).drop("_digest")
    return alone.unionByName(once.select(F.struct(*once.columns).alias("_row")).distinct().select("_row.*"))
