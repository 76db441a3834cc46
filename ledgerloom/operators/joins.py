"""Joins, totals and top-1 picks that stay balanced when one key holds a large part of the rows.

Two rules run through this module:

* Whatever feeds a join as "one row per key" is aggregated first, with Spark's map-side
  partial aggregation, so a hot key leaves each task as a single row.
* Those aggregates group by a struct of the keys. The aggregate's partitioning is then not
  reused by the join, the join gets shuffle stages of its own on both sides, and AQE can split
  the hot partition of the large side at run time. Grouping by the bare keys would put the
  aggregate straight under the join, a shape AQE leaves unsplit.

No broadcast hint is used: Spark broadcasts a side only when its measured size is under
spark.sql.autoBroadcastJoinThreshold and falls back to a shuffled join beyond it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import ratio


def totals_by(df: DataFrame, keys: Sequence[str], **aggregates: Column) -> DataFrame:
    """One row per key combination with the named aggregates, ready to be joined back."""
    grouped = df.groupBy(F.struct(*keys).alias("_keys"))
    return grouped.agg(*[c.alias(n) for n, c in aggregates.items()]).select("_keys.*", *aggregates)


def lookup(
    df: DataFrame, other: DataFrame, on: Mapping[str, str], take: Mapping[str, Column | str],
    how: str = "left",
) -> DataFrame:
    """Join `other` on left column -> other column, adding only the named columns.

    `take` maps the new name to a column of `other`. Reading just keys and taken columns keeps
    the scan of `other` narrow, and renaming makes it safe to look the same table up twice.
    """
    plain = {name: c for name, c in take.items() if isinstance(c, str)}
    other = other.withColumns({f"_{name}": c for name, c in take.items() if name not in plain})
    sources = {**on, **{name: plain.get(name, f"_{name}") for name in take}}
    side = other.selectExpr(*[f"`{source}` AS `{name}`" for name, source in sources.items()])
    return df.join(side, list(on), how)


def has_match(df: DataFrame, other: DataFrame, on: Mapping[str, str], name: str) -> DataFrame:
    """Add a boolean telling whether `other` has a row with the same keys (EXISTS)."""
    keys = list(on.values())
    found = totals_by(other.select(*keys), keys, _found=F.lit(True))
    joined = lookup(df, found, on, {name: "_found"})
    return joined.withColumn(name, F.coalesce(name, F.lit(False)))


def matching(df: DataFrame, other: DataFrame, on: Mapping[str, str], keep: bool = True) -> DataFrame:
    """Rows whose keys occur in `other` (semi join), or with keep=False those that do not (anti)."""
    keys = list(on.values())
    found = totals_by(other.select(*keys), keys, _found=F.lit(True))
    found = found.selectExpr(*[f"`{name}` AS `{left}`" for left, name in on.items()])
    return df.join(found, list(on), "left_semi" if keep else "left_anti")


def share_of_total(
    df: DataFrame, keys: Sequence[str], value: str, name: str, empty_as_zero: bool = False,
) -> DataFrame:
    """value over the total of its key group.

    NULL for a zero total and for a NULL key, which matches no group. With empty_as_zero a
    missing value counts as 0 in the numerator too; in the total it always does.
    """
    filled = F.coalesce(F.col(value), F.lit(0))
    totals = totals_by(df.select(*keys, value), keys, _total=F.sum(filled))
    joined = lookup(df, totals, {k: k for k in keys}, {"_total": "_total"})
    top = filled if empty_as_zero else F.col(value)
    return joined.withColumn(name, ratio(top, "_total")).drop("_total")


#: What one packed word holds: a whole number below this.
_WORD = 10 ** 38
_DAY_MICROS = 86_400_000_000


def _whole(number: int) -> Column:
    return F.lit(str(number)).cast("decimal(38,0)")


def _coded(column: Column, kind: T.DataType) -> tuple[Column, int] | None:
    """An order-preserving whole number from 0 for the values of a type, and how many values there are; None for other types."""
    wide = "decimal(38,0)"
    if isinstance(kind, T.BooleanType):
        return column.cast("int").cast(wide), 2
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        half = 1 << (8 * {"tinyint": 1, "smallint": 2, "int": 4, "bigint": 8}[kind.simpleString()] - 1)
        return column.cast(wide) + _whole(half), 2 * half
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        most = 10 ** kind.precision
        # The unscaled value: multiplied within a type that holds every digit.
        return (column.cast(f"decimal({kind.precision + kind.scale},{kind.scale})") * _whole(10 ** kind.scale)).cast(wide) + _whole(most), 2 * most
    first = dt.date(1, 1, 1).toordinal() - dt.date(1970, 1, 1).toordinal()
    days = dt.date(9999, 12, 31).toordinal() - dt.date(1, 1, 1).toordinal() + 1
    if isinstance(kind, T.DateType):
        return (F.unix_date(column) - F.lit(first)).cast(wide), days
    if isinstance(kind, T.TimestampNTZType):
        day = (F.unix_date(column.cast("date")) - F.lit(first)).cast("bigint") * F.lit(_DAY_MICROS)
        seconds = (F.hour(column) * 3600 + F.minute(column) * 60).cast("bigint") * F.lit(1_000_000)
        return (day + seconds + (F.date_part(F.lit("SECOND"), column) * 1_000_000).cast("bigint")).cast(wide), days * _DAY_MICROS
    if isinstance(kind, T.TimestampType):
        return (F.unix_micros(column) - F.lit(first * _DAY_MICROS)).cast(wide), days * _DAY_MICROS
    return None


def packed_order(columns: Sequence[tuple[Column, T.DataType]]) -> list[tuple[Column, bool]]:
    """Columns as few order-preserving words, the first counting most, NULL as the greatest of each column.

    Numbers, amounts and days are packed, several to a word (a decimal of 38 digits; a receipt time and a
    number of 64 bits fill one). Other types are a word of their own that is not packed (False).
    """
    words: list[tuple[Column, bool]] = []
    room = 0
    for column, kind in columns:
        coded = _coded(column, kind)
        if coded is None:
            words.append((column, False))
            room = 0
            continue
        code, values = coded
        filled = F.coalesce(code, _whole(values))
        if room >= values + 1:
            # One step of a word is as much as all values of the column.
            words[-1] = ((words[-1][0] * _whole(values + 1)).cast("decimal(38,0)") + filled).cast("decimal(38,0)"), True
            room //= values + 1
        else:
            words.append((filled.cast("decimal(38,0)"), True))
            room = _WORD // (values + 1)
    return words


def latest_by(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], **values: Column | str,
) -> DataFrame:
    """The named values of the last row per key, ordered by `order` with NULL as the greatest.

    Give enough order columns to make the choice unique; of rows that agree in all of them, the
    greatest of each value is taken. The order columns are packed into words. Per word, a hash aggregate with one
    row per key and task finds the greatest among the rows that the words before have left, and the
    rows meet all of these maxima at the end. So the input is never sorted, a hot key is combined before
    each shuffle and split in each join, and df is read once per word and once more, whatever the number of
    order columns. The greatest of a text (no packed word) is found by sorting, as everywhere in Spark.
    """
    def column(c: Column | str) -> Column:
        return F.col(c) if isinstance(c, str) else c

    named = df.select(F.struct(*keys).alias("_key"), *[column(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      *[column(c).alias(f"_v_{n}") for n, c in values.items()])
    words = packed_order([(F.col(f"_o{i}"), named.schema[f"_o{i}"].dataType) for i in range(len(order))])
    ranks = [f"_w{i}" for i in range(len(words))]
    rows = named.select("_key", *[w.alias(r) for (w, _), r in zip(words, ranks)], *[f"_v_{n}" for n in values])
    best, found = rows, []
    for rank, (_, packed) in zip(ranks, words):
        # NULL is a value of its own where the word is not packed.
        top = {f"_t{rank}": F.max(rank), **({} if packed else {f"_n{rank}": F.max(F.col(rank).isNull())})}
        carried = {c: F.max(c) for c in found}
        tops = totals_by(best, ["_key"], **top, **carried)
        found += list(top)
        met = lookup(rows, tops, {"_key": "_key"}, {c: c for c in found}, "inner")
        same = [F.when(F.col(f"_n{r}"), F.col(r).isNull()).otherwise(F.col(r) == F.col(f"_t{r}")) if f"_n{r}" in found else F.col(r) == F.col(f"_t{r}")
                for r in ranks[: ranks.index(rank) + 1]]
        best = met.where(reduce(lambda a, b: a & b, same))
    return totals_by(best, ["_key"], **{n: F.max(f"_v_{n}") for n in values}).select("_key.*", *values)


def distinct_rows(df: DataFrame) -> DataFrame:
    """DISTINCT over a wide row, as one struct key.

    The same rows come out; with dozens of separate grouping columns the generated aggregation
    code grows past what the JVM compiles, with one key it stays small.
    """
    return df.select(F.struct(*df.columns).alias("_row")).distinct().select("_row.*")


def distinct_union(*frames: DataFrame) -> DataFrame:
    """UNION: all rows of frames with the same columns, duplicates removed once at the end."""
    return reduce(lambda a, b: a.unionByName(b), frames).distinct()


def padded_union(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; a column a frame lacks is a typed NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def total_order(df: DataFrame, *by: Column | str) -> DataFrame:
    """Global sort by `by`, ties broken by the remaining columns.

    The tie-break also lets the range partitioner cut through a value that many rows share.
    """
    named = {c for c in by if isinstance(c, str)}
    return df.orderBy(*by, *[c for c in df.columns if c not in named])
