"""Registry of queries with the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name; sql is the equivalent query over the given tables."""

    def register(function: Query) -> Query:
        name = function.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: portable(function(spark, sf_dir))
        if sql:
            ORACLE_SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def portable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and days as ISO text, so two engines' results compare as they are."""
    shown = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd")
        shown.append(column.alias(field.name))
    return df.select(*shown)


def portable_sql(sql: str, doubles: str = "", days: str = "") -> str:
    """The same for a check query: names of its decimal and day columns, space separated."""
    shown = [f"CAST({c} AS DOUBLE) AS {c}" for c in doubles.split()]
    shown += [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in days.split()]
    return f"SELECT * REPLACE ({', '.join(shown)}) FROM ({sql}) AS shown"
