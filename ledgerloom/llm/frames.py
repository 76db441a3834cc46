"""Shared plumbing: columns computed per batch of texts, shared folders, null rules.

Everywhere in this package a null text counts as an empty one, rows are kept one for one
(repeated rows stay repeated), an empty table gives an empty result with the same columns, and a
computed column replaces an input column of the same name.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import apply_settings, work_folder

#: Bytes of text that one step over arrays handles; a longer text is a step of its own.
STEP_BYTES = 1 << 21


def session(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on: small Arrow batches, as texts can be very long."""
    apply_settings(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return session(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share."""
    return f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, path: str | None = None, **options: str) -> DataFrame:
    """The same rows, written to the shared folder and read back: lineage ends here. options: those of the Parquet writer."""
    path = path or shared_path(df.sparkSession, name)
    df.write.parquet(path, **options)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, path: str) -> None:
    """Free the disk of an intermediate table that nothing reads any more: it is overwritten without rows."""
    spark.range(0).write.mode("overwrite").parquet(path)


def steps(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about STEP_BYTES of text each."""
    column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_string())
    if not len(column):
        return
    lengths = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(lengths) // STEP_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(column)]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def with_computed(df: DataFrame, ddl: str, compute: Callable[..., Sequence], text: str = "text",
                  also: Sequence[str] = (), keep: Sequence[str] | None = None) -> DataFrame:
    """df with the columns of the DDL; compute maps the texts (and the other columns named) to one array per column.

    keep names the columns of df to return, if not all are wanted.
    """
    added = T.StructType.fromDDL(ddl)
    new = {c.lower() for c in added.names}
    fields = [f for f in df.schema.fields if f.name.lower() not in new and (keep is None or f.name in keep)]
    needed = [c for c in df.columns if c in {text, *also, *(f.name for f in fields)}]
    schema, names = T.StructType(fields + added.fields), [f.name for f in fields + added.fields]
    own = [needed.index(f.name) for f in fields]

    def run(batches):
        for batch in batches:
            for part in steps(batch, text):
                found = compute(*(part.column(part.schema.get_field_index(c)) for c in (text, *also)))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in own), *(x if isinstance(x, pa.Array) else pa.array(x) for x in found)], names=names)

    return df.select([F.col(f"`{c}`") for c in needed]).mapInArrow(run, schema)


def set_aside(df: DataFrame) -> tuple[DataFrame, dict[str, str], Callable[[DataFrame], DataFrame]]:
    """df with columns c0, c1, ..., the new name of each, and what gives rows their own columns back.

    So an operator's columns cannot clash with columns that only pass through.
    """
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    renamed = df.select([F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return renamed, names, lambda found: found.select([F.col(n).alias(c) for c, n in names.items()])


def texts_of(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the id and the text, null as empty."""
    return df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def least_hashed(df: DataFrame, column: str, rows: int) -> DataFrame:
    """At most `rows` different rows, those of the least hash of a column: a sample that stays the same.

    Rows without a value are left out. Only about as many rows as are wanted are sorted: the rest is left
    out by the hash alone.
    """
    df = df.filter(F.col(column).isNotNull()).distinct()
    n, top = df.count(), 1 << 32
    place = F.pmod(F.xxhash64(column), F.lit(top))
    if n > rows:
        share = (rows + 6 * rows ** 0.5 + 50) / n
        df = df.filter(place < int(min(1.0, share) * top))
    return df.orderBy(place, *df.columns).limit(rows)


def learning_row(doc_id: str = "doc_id"):
    """Rows that a model may learn labels from; the rest are held out."""
    return ~held_out(doc_id)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))
