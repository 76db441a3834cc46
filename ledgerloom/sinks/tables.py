"""Target tables: full refresh that keeps the structure, append exactly once, versions to go back to, and a look at what is there.

A target is a view of its current version. A version is a table of its own whose partitions are batches, each
a folder that is written first and entered in the catalog afterwards, in one step: rows of a batch that is not
entered are never read, and a batch that is entered already is not entered again. So a load may be killed
anywhere and repeated, and a batch may come twice.

A refresh writes a new version and then points the view at it. Readers see the old rows or the new ones, never
an empty or half-loaded table, and a job that dies leaves the old rows. Of older versions the last
`retain` stay, to be read or to be gone back to; the others are emptied, so a table that is refreshed daily
for years takes the room of a few copies. Versions are named by the time they were begun.

With each batch the catalog keeps what was written: the number of rows and a checksum of their content that does not
depend on their order. `content_check` compares it with what is read back.

A name is one table, whatever characters it holds (see catalog_name). A name with a database is
given as a tuple (database, table).
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.joins import lookup
from ledgerloom.operators.quality import aligned, clean_name, clean_names

Name = str | tuple[str, str]
RETAINED = 3
#: The batch of a full refresh.
FIRST_BATCH = "refresh"
_VERSIONS, _CURRENT, _BATCH = "ledgerloom.versions", "ledgerloom.current", "ledgerloom.batch."


@dataclass(frozen=True)
class Load:
    """What one load did: rows handed over, counted while they were written; none if the batch was there already."""

    table: str
    rows: int
    created: bool
    repeated: bool = False


def catalog_name(name: Name) -> str:
    """The quoted name of a target. The catalog takes letters, digits and underscores only, so every
    other character is an underscore there; `p_my.report` is one table, not a table of a database."""
    parts = name if isinstance(name, tuple) else (name,)
    return ".".join(f"`{clean_name(part)}`" for part in parts)


def _text(value: str) -> str:
    """A SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def content_measures(columns: list[str]) -> list[Column]:
    """Number of rows, and two sums of 64-bit hashes of them: equal for equal rows in any order.

    The hash skips NULLs; the number behind each column tells which one was NULL.
    """
    numbered = [x for i, c in enumerate(columns) for x in (F.col(f"`{c}`"), F.lit(i))]
    sums = [F.coalesce(F.sum(F.xxhash64(F.lit(seed), *numbered).cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)")) for seed in (1, 2)]
    return [F.count(F.lit(1)).alias("rows"), sums[0].alias("sum1"), sums[1].alias("sum2")]


def table_exists(spark: SparkSession, name: Name) -> bool:
    return spark.catalog.tableExists(catalog_name(name))


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def version_tables(spark: SparkSession, name: Name) -> list[str]:
    """Quoted names of the tables of all versions that still hold rows, the latest last."""
    found = _properties(spark, catalog_name(name)).get(_VERSIONS)
    return found.split("\n") if found else []


def current_version(spark: SparkSession, name: Name) -> str:
    """The version table that the target shows."""
    shown = _properties(spark, catalog_name(name)).get(_CURRENT)
    if not shown:
        raise ValueError(f"{catalog_name(name)} is no target of this module; refresh it first")
    return shown


def _entries(spark: SparkSession, version: str) -> dict[str, list[str]]:
    """Per batch that was written to a version: folder, rows and the two sums."""
    return {k.removeprefix(_BATCH): v.split("\n") for k, v in _properties(spark, version).items() if k.startswith(_BATCH)}


def versions(spark: SparkSession, name: Name) -> list[str]:
    """Folders of the versions that still hold rows, the latest last."""
    return [next(iter(_entries(spark, version).values()))[0] for version in version_tables(spark, name)]


def batches(spark: SparkSession, version: str) -> list[str]:
    """The batches entered in a version table."""
    return [b for b in _entries(spark, version) if _entered(spark, version, b)]


def _entered(spark: SparkSession, version: str, batch: str) -> bool:
    return bool(spark.sql(f"SHOW PARTITIONS {version} PARTITION (`_batch` = {_text(batch)})").head(1))


def _written(df: DataFrame, version: str, batch: str, folder: str) -> int:
    """Write a batch and note what was written with the version; it is not read yet."""
    seen = Observation()
    df.observe(seen, *content_measures(df.columns)).write.parquet(folder)
    found = seen.get
    noted = "\n".join([folder, *(str(int(found[k])) for k in ("rows", "sum1", "sum2"))])
    df.sparkSession.sql(f"ALTER TABLE {version} SET TBLPROPERTIES ({_text(_BATCH + batch)} = {_text(noted)})")
    return found["rows"]


def _enter(spark: SparkSession, version: str, batch: str, folder: str) -> bool:
    """From now on the batch is read; False if one of its name is read already."""
    try:
        spark.sql(f"ALTER TABLE {version} ADD PARTITION (`_batch` = {_text(batch)}) LOCATION {_text(folder)}")
    except AnalysisException as error:
        if "PARTITIONS_ALREADY_EXIST" not in str(error):
            raise
        return False
    return True


def _show(spark: SparkSession, name: Name, version: str, all_versions: list[str]) -> None:
    """Point the target at a version, in one step. Naming the batch lets Spark size what it reads by the entered folders."""
    columns = ", ".join(f"`{c}`" for c in spark.table(version).columns if c != "_batch")
    known = "\n".join(all_versions)
    spark.sql(f"CREATE OR REPLACE VIEW {catalog_name(name)} TBLPROPERTIES ('{_VERSIONS}' = {_text(known)}, '{_CURRENT}' = {_text(version)}) "
              f"AS SELECT {columns} FROM {version} WHERE `_batch` IS NOT NULL")


def _adopted(spark: SparkSession, name: Name) -> None:
    """A plain table of the target's name keeps its rows under another one."""
    if table_exists(spark, name) and _CURRENT not in _properties(spark, catalog_name(name)):
        parts = name if isinstance(name, tuple) else (name,)
        spark.sql(f"ALTER TABLE {catalog_name(name)} RENAME TO {catalog_name((*parts[:-1], f'{parts[-1]}_before_{uuid4().hex[:8]}'))}")


def full_refresh(df: DataFrame, name: Name, folder: str, retain: int = RETAINED, batch: str = FIRST_BATCH) -> Load:
    """Replace all rows of a table; the first load creates it from the declared schema.

    Later loads keep the table's columns and types: rows are cast to them, and a column that is
    missing, or a value that its type would change, is an error instead of a silent change. The last `retain`
    versions stay, the new one among them, for readers that began before the switch.
    """
    if retain < 1:
        raise ValueError("at least the new version must be retained")
    spark, table = df.sparkSession, catalog_name(name)
    df = clean_names(df)
    exists = table_exists(spark, name)
    if exists:
        df = aligned(df, spark.table(table).schema)
    parts, stamp = name if isinstance(name, tuple) else (name,), f"{time.strftime('%Y%m%dt%H%M%S', time.gmtime())}_{uuid4().hex[:8]}"
    version = catalog_name((*parts[:-1], f"{parts[-1]}__v{stamp}"))
    path = f"{folder.rstrip('/')}/{table.replace('`', '')}/{stamp}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    spark.sql(f"CREATE TABLE {version} ({columns}, `_batch` string) USING parquet PARTITIONED BY (`_batch`) LOCATION {_text(path)}")
    try:
        rows = _written(df, version, batch, path)
    except Exception:
        spark.sql(f"DROP TABLE {version}")
        raise
    _enter(spark, version, batch, path)
    before = version_tables(spark, name) if exists else []
    _adopted(spark, name)
    _show(spark, name, version, [*before, version][-retain:])
    _emptied(spark, [*before, version][:-retain])
    return Load(table.replace("`", ""), rows, not exists)


def _emptied(spark: SparkSession, old: list[str]) -> None:
    for version in old:
        nothing = spark.createDataFrame([], spark.table(version).drop("_batch").schema)
        for folder, *_ in _entries(spark, version).values():
            nothing.coalesce(1).write.mode("overwrite").parquet(folder)
        spark.sql(f"DROP TABLE {version}")


def prepared(df: DataFrame, name: Name, batch: str) -> tuple[str, int]:
    """Write a batch for the current version without entering it: its folder and number of rows. Nothing reads it yet."""
    spark = df.sparkSession
    version = current_version(spark, name)
    rows = aligned(clean_names(df), spark.table(catalog_name(name)).schema)
    folder = f"{next(iter(_entries(spark, version).values()))[0]}-{uuid4().hex}"
    return folder, _written(rows, version, batch, folder)


def append(df: DataFrame, name: Name, batch: str | None = None) -> Load:
    """Add rows to an existing table, matched to its columns by name.

    With the name of a batch the rows are added once: a batch that was entered already changes nothing, and one
    that was written by a job that died before entering it is written again. Batches without a name are all different.
    """
    spark, table = df.sparkSession, catalog_name(name).replace("`", "")
    version, batch = current_version(spark, name), batch or uuid4().hex
    if _entered(spark, version, batch):
        return Load(table, 0, False, True)
    folder, rows = prepared(df, name, batch)
    entered = _enter(spark, version, batch, folder)
    return Load(table, rows if entered else 0, False, not entered)


def load(df: DataFrame, name: Name, folder: str, mode: str = "refresh", retain: int = RETAINED, batch: str | None = None) -> Load:
    """A full refresh, or with mode "append" rows added to what is there (the first load creates it)."""
    if mode not in ("refresh", "append"):
        raise ValueError(f"unknown mode {mode}")
    if mode == "append" and table_exists(df.sparkSession, name):
        return append(df, name, batch)
    return full_refresh(df, name, folder, retain, batch or FIRST_BATCH)


def version_rows(spark: SparkSession, name: Name, back: int = 0) -> DataFrame:
    """The rows of a version that still stands: the latest, or so many refreshes before it."""
    return spark.table(_version(spark, name, back)).where("`_batch` IS NOT NULL").drop("_batch")


def _version(spark: SparkSession, name: Name, back: int) -> str:
    kept = version_tables(spark, name)
    if not 0 <= back < len(kept):
        raise ValueError(f"{catalog_name(name)} has {len(kept)} versions")
    return kept[-1 - back]


def roll_back(spark: SparkSession, name: Name, back: int = 1) -> str:
    """Show an earlier version again; it becomes the latest, and the next refresh goes on from there."""
    chosen, kept = _version(spark, name, back), version_tables(spark, name)
    _show(spark, name, chosen, [*(v for v in kept if v != chosen), chosen])
    return chosen


def content_check(spark: SparkSession, name: Name) -> DataFrame:
    """Per batch of the current version: rows written and read back, and whether count and content agree."""
    version = current_version(spark, name)
    entered = [(b, *map(int, e[1:2]), *e[2:]) for b, e in _entries(spark, version).items() if _entered(spark, version, b)]
    written = spark.createDataFrame(entered, "batch string, rows_written bigint, written1 string, written2 string")
    rows = spark.table(version)
    read = rows.groupBy(F.struct("_batch").alias("of")).agg(*content_measures([c for c in rows.columns if c != "_batch"])).select("of._batch", "rows", "sum1", "sum2")
    met = lookup(written, read, {"batch": "_batch"}, {"rows": "rows", "sum1": "sum1", "sum2": "sum2"})
    found = [F.coalesce(F.col(c).cast("decimal(30,0)"), F.lit(0).cast("decimal(30,0)")).cast("string") for c in ("sum1", "sum2")]
    n = F.coalesce("rows", F.lit(0)).cast("bigint")
    return met.select("batch", "rows_written", n.alias("rows_read"), (n == F.col("rows_written")).alias("count_consistent"),
                      ((found[0] == F.col("written1")) & (found[1] == F.col("written2"))).alias("content_consistent"))


def table_info(spark: SparkSession, name: Name) -> DataFrame:
    """One row per column of a table, with the table's row count on each."""
    rows = spark.table(catalog_name(name))
    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("column_type"))
        for i, f in enumerate(rows.schema, start=1)
    ]
    return rows.agg(F.count(F.lit(1)).alias("row_count")).select("row_count", F.inline(F.array(*entries)))
