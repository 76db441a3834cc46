"""Reading from and writing to relational databases over JDBC.

The functions only put Spark's own options together; the database drivers come from the
cluster. Credentials are passed in `connection` (url, user, password, driver) by the caller.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

FETCH_ROWS = 10_000
BATCH_ROWS = 1_000
TIMEOUT_SECONDS = 300


def query_options(sql: str, fetch_rows: int = FETCH_ROWS, timeout: int = TIMEOUT_SECONDS) -> dict[str, str]:
    """Options of a whole-query read: one connection, rows fetched in blocks."""
    return {"query": sql.strip().rstrip(";"), "fetchsize": str(fetch_rows), "queryTimeout": str(timeout)}


def table_options(
    table: str, column: str, lower: object, upper: object, partitions: int,
    fetch_rows: int = FETCH_ROWS, timeout: int = TIMEOUT_SECONDS,
) -> dict[str, str]:
    """Options of a partitioned table read: one range of `column` per partition."""
    if partitions < 1:
        raise ValueError("partitions must be positive")
    return {
        "dbtable": table, "partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
        "numPartitions": str(partitions), "fetchsize": str(fetch_rows), "queryTimeout": str(timeout),
    }


def write_options(table: str, batch_rows: int = BATCH_ROWS, partitions: int = 16) -> dict[str, str]:
    """Options of a load: rows per insert batch, and at most `partitions` open connections."""
    return {"dbtable": table, "batchsize": str(batch_rows), "numPartitions": str(partitions), "truncate": "true"}


def read_query(spark: SparkSession, connection: Mapping[str, str], sql: str) -> DataFrame | None:
    """Result of a query run by the database; None for an empty text."""
    if not sql.strip():
        return None
    return spark.read.format("jdbc").options(**connection, **query_options(sql)).load()


def histogram_query(table: str, column: str, slices: int) -> str:
    """Query for the greatest value and the number of rows of each of `slices` slices of about as many rows, by value."""
    return (f"SELECT slice, MAX({column}) AS up_to, COUNT(*) AS n FROM "
            f"(SELECT {column}, NTILE({slices}) OVER (ORDER BY {column}) AS slice FROM {table} WHERE {column} IS NOT NULL) k GROUP BY slice")


def _literal(value: object) -> str:
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def split_predicates(column: str, histogram: Sequence[tuple[object, int]], partitions: int) -> list[str]:
    """One predicate per partition, from (greatest value, rows) of ascending slices of a column.

    Slices are put together to ranges of about the same number of rows, whatever the values are; a value
    that many rows share is in one range, alone if it fills one. Rows without a value are a range of their own, the
    last. Every row meets exactly one predicate.
    """
    if partitions < 1:
        raise ValueError("partitions must be positive")
    merged: dict = {}
    for value, rows in histogram:
        merged[value] = merged.get(value, 0) + rows
    total, bounds, filled = sum(merged.values()), [], 0
    values = sorted(merged)
    for value, following in zip(values, values[1:]):
        filled += merged[value]
        # A range ends where it is nearer to its share than it would be with the next slice.
        if 2 * filled + merged[following] > 2 * total / partitions:
            bounds.append(value)
            filled = 0
    lows = [None, *bounds]
    ranges = []
    for low, high in zip(lows, [*bounds, None]):
        parts = [f"{column} > {_literal(low)}" if low is not None else "", f"{column} <= {_literal(high)}" if high is not None else ""]
        ranges.append(" AND ".join(p for p in parts if p) or f"{column} IS NOT NULL")
    return [*ranges, f"{column} IS NULL"]


def read_table(
    spark: SparkSession, connection: Mapping[str, str], table: str, column: str, partitions: int, slices_each: int = 8,
) -> DataFrame:
    """A table (or a query in brackets with a name) read in parallel over ranges of a column.

    The ranges come from a histogram that the database makes, a few rows per partition.
    """
    found = read_query(spark, connection, histogram_query(table, column, partitions * slices_each)).collect()
    predicates = split_predicates(column, [(r["up_to"], r["n"]) for r in found], partitions)
    options = {k: v for k, v in connection.items() if k != "url"} | {"fetchsize": str(FETCH_ROWS), "queryTimeout": str(TIMEOUT_SECONDS)}
    return spark.read.jdbc(connection["url"], table, predicates=predicates, properties=options)


def catalog_query(owner: str) -> str:
    """Query for name and kind of an owner's objects, for operators.quality.access_check."""
    quoted = owner.upper().replace("'", "''")
    return f"SELECT object_name AS name, object_type AS kind FROM all_objects WHERE owner = '{quoted}'"


def catalog_objects(spark: SparkSession, connection: Mapping[str, str], owner: str) -> DataFrame:
    """Name and kind of the objects of an owner in the source database."""
    return read_query(spark, connection, catalog_query(owner)).selectExpr("name", "kind")


def load_table(df: DataFrame, connection: Mapping[str, str], table: str, refresh: bool = True, **options: int) -> None:
    """Load a table: refresh empties it first and keeps its structure, else rows are added.

    Emptying and inserting are two transactions of the database; where readers must never see
    the gap, refresh a parquet table instead (see ledgerloom.sinks.tables).
    """
    writer = df.write.format("jdbc").options(**connection, **write_options(table, **options))
    writer.mode("overwrite" if refresh else "append").save()
