"""Column names and profiles, record checks, reference and run reports.

Each check is one aggregate or one pass over the rows; per-column results are turned into rows
from the single aggregated row, so the number of columns does not add scans.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import code_label
from ledgerloom.functions.text import contains_word
from ledgerloom.operators.joins import lookup, totals_by

# Declared source types and what they are stored as.
TYPE_MAP = {
    "NUMBER": "NUMERIC", "INTEGER": "INTEGER", "INT": "INTEGER", "FLOAT": "REAL", "BINARY_FLOAT": "REAL",
    "BINARY_DOUBLE": "DOUBLE PRECISION", "VARCHAR2": "VARCHAR", "CHAR": "CHAR", "NCHAR": "CHAR", "NVARCHAR2": "VARCHAR",
    "CLOB": "TEXT", "NCLOB": "TEXT", "DATE": "TIMESTAMP", "TIMESTAMP": "TIMESTAMP",
    "TIMESTAMP WITH TIME ZONE": "TIMESTAMPTZ", "TIMESTAMP WITH LOCAL TIME ZONE": "TIMESTAMPTZ",
    "BLOB": "BYTEA", "RAW": "BYTEA", "LONG RAW": "BYTEA", "ROWID": "VARCHAR(18)", "UROWID": "VARCHAR(4000)",
}

# Target types of inferred column types.
INFERRED_TYPES = {
    "string": "TEXT", "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE PRECISION",
    "float": "REAL", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "date": "TIMESTAMP",
    "interval day to second": "INTERVAL", "binary": "BYTEA",
}


def inferred_type(data_type: T.DataType) -> str:
    """Target type of a Spark type; TEXT for anything not listed."""
    if isinstance(data_type, T.DecimalType):
        return "NUMERIC"
    return INFERRED_TYPES.get(data_type.simpleString(), "TEXT")


def clean_name(name: str) -> str:
    return re.sub(r"[^a-zA-Z0-9_]", "_", name.lower().strip())


def clean_names(df: DataFrame) -> DataFrame:
    """Lower-case column names of letters, digits and underscores; two equal ones are an error."""
    names = [clean_name(c) for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"column names collide after cleaning: {sorted({n for n in names if names.count(n) > 1})}")
    return df.toDF(*names)


_WHOLE_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def _digits(kind: T.DataType) -> tuple[int, int] | None:
    """Digits before and behind the point that a number type holds exactly; None for other types."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (6, 0) if isinstance(kind, T.FloatType) else (15, 0)
    return (_WHOLE_DIGITS[kind.simpleString()], 0) if kind.simpleString() in _WHOLE_DIGITS else None


def type_change(stored: T.DataType, incoming: T.DataType) -> str:
    """How an incoming type stands to the stored one: same, narrower (every value fits), wider (some may not), or other."""
    if stored == incoming:
        return "same"
    have, come = _digits(stored), _digits(incoming)
    if have and come:
        whole_only = isinstance(incoming, T.IntegralType) or isinstance(incoming, T.DecimalType)
        return "narrower" if whole_only and come[0] <= have[0] and come[1] <= have[1] else "wider"
    times = (T.TimestampType, T.TimestampNTZType)
    if isinstance(stored, T.DateType) and isinstance(incoming, times):
        return "wider"
    if isinstance(stored, times) and isinstance(incoming, T.DateType):
        return "narrower"
    return "other"


def _kept(column: Column, incoming: T.DataType, stored: T.DataType) -> Column:
    """Whether a value is the same after it was cast to a stored type that may not hold it."""
    cast = column.try_cast(stored)
    return column.isNull() | F.coalesce(cast.cast(incoming) == column, F.lit(False))


def aligned(df: DataFrame, target: T.StructType, names: Sequence[str] | None = None) -> DataFrame:
    """Rename by position to `names`, then keep the target's columns in its order and types.

    A number or a time that its target type would round, cut or not hold is an error. Columns that the target
    does not have are left out (`schema_drift` names them).
    """
    if names is not None:
        if len(names) != len(df.columns):
            raise ValueError(f"{len(df.columns)} columns do not fit {len(names)} names")
        df = df.toDF(*names)
    incoming = {f.name: f.dataType for f in df.schema}
    missing = [f.name for f in target if f.name not in incoming]
    if missing:
        raise ValueError(f"columns missing for the target: {missing}")

    def fitted(field: T.StructField) -> Column:
        column, cast = F.col(f"`{field.name}`"), F.col(f"`{field.name}`").cast(field.dataType)
        if type_change(field.dataType, incoming[field.name]) != "wider":
            return cast.alias(field.name)
        message = F.concat(F.lit(f"{field.name} does not fit {field.dataType.simpleString()}: "), column.cast("string"))
        lost = F.raise_error(message).cast(field.dataType)
        return F.when(_kept(column, incoming[field.name], field.dataType), cast).otherwise(lost).alias(field.name)

    return df.select(*[fitted(f) for f in target])


def schema_drift(df: DataFrame, stored: T.StructType, declared: T.StructType | None = None) -> DataFrame:
    """One row per column of incoming rows, of the stored table and of its declaration: the types, what has changed
    (added, lost, or see type_change), and how many incoming values the stored type would change."""
    declared = stored if declared is None else declared
    types = [{f.name: f.dataType for f in schema} for schema in (declared, stored, df.schema)]
    columns = list(dict.fromkeys([*types[1], *types[2], *types[0]]))
    measures, shown = {}, {}
    for name in columns:
        of_declared, have, come = (t.get(name) for t in types)
        change = "lost" if come is None else "added" if have is None else type_change(have, come)
        texts = {"declared_type": of_declared, "stored_type": have, "incoming_type": come}
        shown[name] = {k: F.lit(t.simpleString() if t is not None else None).cast("string") for k, t in texts.items()} | {"change": F.lit(change)}
        differs = ~_kept(F.col(f"`{name}`"), come, have) if change == "wider" else F.lit(False)
        measures[name] = {"changed_values": F.count_if(differs)}
    return _per_column(df, measures, shown)


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles, for readers that expect floating point."""
    decimals = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({name: F.col(f"`{name}`").cast("double") for name in decimals})


def _per_column(df: DataFrame, measures: Mapping[str, Mapping[str, Column]], shown: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """One row per column from one aggregate: measures[column][name] -> shown[column][name]."""
    aggregates = [c.alias(f"{i}_{m}") for i, ms in enumerate(measures.values()) for m, c in ms.items()]
    entries = []
    for i, (column, ms) in enumerate(measures.items()):
        fields = {"column_name": F.lit(column), **shown.get(column, {}), **{m: F.col(f"{i}_{m}") for m in ms}}
        entries.append(F.struct(*[c.alias(n) for n, c in fields.items()]))
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))


def _width(longest: Column) -> Column:
    return F.least(F.greatest(longest, F.lit(50)) * 2, F.lit(4000))


def varchar_widths(df: DataFrame) -> DataFrame:
    """Longest text and a VARCHAR width with room, per text column."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    longest = {c: {"longest": F.max(F.length(F.col(f"`{c}`"))).cast("bigint")} for c in texts}
    return _per_column(df, longest, {}).withColumn("width", _width(F.col("longest")))


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: source and target type, longest text and a width with room, NULLs, and how many
    values are numbers."""
    measures, shown = {}, {}
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        is_text = isinstance(field.dataType, T.StringType)
        shown[field.name] = {
            "source_type": F.lit(field.dataType.simpleString()), "target_type": F.lit(inferred_type(field.dataType)),
        }
        measures[field.name] = {
            "longest": F.max(F.length(column)).cast("bigint") if is_text else F.max(F.lit(None).cast("bigint")),
            "nulls": F.count_if(column.isNull()),
            "numbers": F.count_if(column.try_cast("double").isNotNull()) if is_text or isinstance(field.dataType, T.NumericType)
            else F.count_if(F.lit(False)),
        }
    widths = F.when(F.col("source_type") == "string", _width(F.coalesce("longest", F.lit(0))))
    return _per_column(df, measures, shown).withColumn("width", widths.cast("bigint"))


def mapped_types(df: DataFrame, declared: str, name: str) -> DataFrame:
    """Add the target type of a declared source type; NULL for a type that is not mapped.

    The map is short and fixed, so it is an expression: a join would shuffle the rows by a
    handful of type names.
    """
    return df.withColumn(name, code_label(declared, TYPE_MAP))


def validated(df: DataFrame, text: str, keyword: str) -> DataFrame:
    """Add `message` (the first rule that fails, or 'ok'), `valid` and `size_kb` of a text column."""
    column = F.col(text)
    message = (
        F.when(column.isNull(), "missing").when(column == "", "empty").when(column.rlike(r"^\s*$"), "blank")
        .when(~contains_word(column, keyword), "no keyword").otherwise("ok")
    )
    size = F.bround(F.octet_length(column) / F.lit(1024.0), 2)
    return df.withColumns({"message": message, "size_kb": size}).withColumn("valid", F.col("message") == "ok")


def validation_report(df: DataFrame, text: str, keyword: str) -> DataFrame:
    """Per message the number of texts and their total size."""
    return validated(df, text, keyword).groupBy("message", "valid").agg(
        F.count(F.lit(1)).alias("texts"), F.sum(F.coalesce(F.col("size_kb").cast("decimal(18,2)"), F.lit(0))).alias("size_kb"))


def invalid_texts(df: DataFrame, text: str, keyword: str) -> DataFrame:
    """The rows whose text is not valid, with the message and size instead of the text."""
    return validated(df, text, keyword).where(~F.col("valid")).drop(text, "valid")


def missing_fields(df: DataFrame, required: Sequence[str], name: str) -> DataFrame:
    """Add the names of required columns that are NULL or empty, as ordered text; '' when complete."""
    found = F.array_compact(F.array(*[
        F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), F.lit(c)) for c in required]))
    return df.withColumn(name, F.array_join(found, ";"))


def references(df: DataFrame, text: str, patterns: Mapping[str, Sequence[str]]) -> DataFrame:
    """Different (kind, name) pairs found in a text column; the first group of a pattern is the name."""
    def found(kind: str, pattern: str) -> Column:
        # Repeats within one text go first, so a text that names one object a million times sends
        # one row. Done on the plain names: for structs the same function compares all pairs.
        names = F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1)))
        return F.transform(names, lambda name: F.struct(F.lit(kind).alias("kind"), name.alias("name")))

    entries = [found(kind, pattern) for kind, listed in patterns.items() for pattern in listed]
    return df.select(F.inline(F.concat(*entries))).distinct()


# Kinds of catalog objects, the one that wins first.
KIND_ORDER = ["TABLE", "VIEW", "FUNCTION", "PROCEDURE", "PACKAGE"]


#: What sinks.tables adds to a name for the tables behind it.
VERSION_SUFFIX = re.compile(r"__v\d{8}t\d{6}_[0-9a-f]{8}$")


def catalog_objects(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Name and kind of the tables, views and functions that the session's catalog has in a database.

    A target of sinks.tables is a table; the versions behind it are not listed.
    """
    listed = spark.catalog.listTables(database)
    targets = {VERSION_SUFFIX.sub("", t.name) for t in listed if VERSION_SUFFIX.search(t.name)}
    tables = [(t.name, "VIEW" if ("VIEW" in t.tableType.upper() or t.isTemporary) and t.name not in targets else "TABLE")
              for t in listed if not VERSION_SUFFIX.search(t.name)]
    functions = [(f.name, "FUNCTION") for f in spark.catalog.listFunctions(database)]
    return spark.createDataFrame(tables + functions, "name string, kind string").distinct()


def access_check(refs: DataFrame, catalog: DataFrame) -> DataFrame:
    """For each reference whether the catalog (name, kind) has it, and as what kind.

    Names are the same in any case: scripts are read in upper case, catalogs may be in lower case.
    The kind that is first in KIND_ORDER is the lowest number, so one minimum per name finds it.
    """
    rank = F.array_position(F.array(*[F.lit(k) for k in KIND_ORDER]), F.col("kind"))
    objects = catalog.where(F.col("kind").isin(KIND_ORDER)).select(F.lower("name").alias("name"), rank.alias("rank"))
    known = totals_by(objects, ["name"], rank=F.min("rank"))
    found = lookup(refs.withColumn("same", F.lower("name")), known, {"same": "name"}, {"rank": "rank"})
    found = found.withColumn("found_type", code_label("rank", {i: k for i, k in enumerate(KIND_ORDER, 1)}))
    return found.select(
        F.col("name").alias("object_name"), F.col("kind").alias("requested_type"),
        F.col("found_type").isNotNull().alias("has_access"), "found_type")


def access_report(checked: DataFrame) -> DataFrame:
    """Per requested kind: references in total, accessible and missing, and the verdict; 'all' for all kinds."""
    report = checked.rollup("requested_type").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("has_access")).alias("accessible"),
        F.count_if(~F.col("has_access")).alias("missing"), F.grouping("requested_type").alias("_all"),
    )
    kind = F.when(F.col("_all") == 1, "all").otherwise(F.col("requested_type"))
    return report.withColumn("requested_type", kind).drop("_all").withColumn("complete", F.col("missing") == 0)


def missing_objects(checked: DataFrame) -> DataFrame:
    """The references that the catalog does not have, as rows."""
    return checked.where(~F.col("has_access")).select("requested_type", "object_name")


def run_totals(runs: DataFrame) -> DataFrame:
    """Totals of a run from its rows (dataset, succeeded, records, seconds)."""
    ok = F.col("succeeded")
    return runs.agg(
        F.count_if(ok).alias("processed"), F.count(F.lit(1)).alias("total"),
        F.coalesce(F.sum(F.when(ok, F.col("records"))), F.lit(0)).alias("records"), F.count_if(~ok).alias("errors"),
        F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("seconds"),
    ).withColumns({
        "success": F.col("errors") == 0,
        "success_rate": F.coalesce(F.try_divide(F.col("processed") * F.lit(100.0), F.col("total")), F.lit(0.0)),
    })
