"""Datasets given as SQL script files: find, check and run them.

Scripts are read as a DataFrame of (path, name, text, size); names, checks and cleaning are
column expressions on it. A script's own query is plain Spark SQL over registered views.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.text import (
    IGNORED_NAMES,
    SCRIPT_SUFFIXES,
    reference_patterns,
    scrubbed,
    selected_name,
    target_name,
    uncommented,
)
from ledgerloom.operators.quality import references, validated


def scripts(
    spark: SparkSession, folder: str, suffixes: Sequence[str] = SCRIPT_SUFFIXES,
    ignored: Sequence[str] = IGNORED_NAMES, prefix: str = "", suffix: str = "",
) -> DataFrame:
    """Scripts of a folder that are selected by name, in name order, with their target table."""
    listed = spark.createDataFrame([(name,) for name in _file_names(spark, folder)], "name string")
    # Other files of the folder are not opened.
    only = f"*{{{','.join(suffixes)}}}"
    texts = spark.read.format("binaryFile").option("pathGlobFilter", only).load(folder).select(
        F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), F.decode("content", "UTF-8").alias("text"))
    chosen = listed.where(selected_name("name", suffixes, ignored)).join(texts, "name", "left")
    return chosen.select(
        "name", target_name("name", prefix, suffix).alias("table_name"), F.coalesce("text", F.lit("")).alias("text"),
    ).orderBy("name")


def _file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, as Spark lists it: rows skip files of no bytes, which a check must report."""
    listed = spark.read.format("binaryFile").load(folder).inputFiles()
    return [unquote(path.rpartition("/")[2]) for path in listed]


def checked_scripts(found: DataFrame) -> DataFrame:
    """The scripts with validity, message and size, as a dry run reports them."""
    return validated(found, "text", "SELECT")


def script_references(found: DataFrame, owner: str) -> DataFrame:
    """Different objects of an owner that the scripts name, by kind, in upper case."""
    plain = found.select(F.upper(uncommented("text")).alias("text"))
    return references(plain, "text", reference_patterns(owner.upper()))


def run_script(spark: SparkSession, text: str) -> DataFrame | None:
    """Result of one script's query; None when nothing is left after cleaning."""
    cleaned = spark.range(1).select(scrubbed(F.lit(text)).alias("sql")).first()["sql"].rstrip(";").strip()
    return spark.sql(cleaned) if cleaned else None
