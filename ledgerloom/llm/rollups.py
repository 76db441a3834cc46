"""Token counts kept as rollups: batches of changes add signed deltas to totals.

A change holds what a document was counted as before and after: an insert has no `before`, a delete
no `after`, a revised count or a document that moved to another source, language or tokenizer
version has both. Totals are additive, so a batch is summed per group before it is shuffled, and a
third of all rows in one group is one row per task.

A batch is committed once: its deltas are appended under a new attempt, then the attempt is entered
in the table of commits. Readers count one entered attempt of each batch, so a batch that is sent
again, by a job that was cut off or by two jobs at a time, changes nothing.

Null source, language or version is a group of its own. A missing count is zero. Changes without
`before` and `after` say nothing. An empty batch is committed and changes nothing. Groups whose
documents have all gone are not shown.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GROUP = ("source", "lang", "version")
_DELTAS = "batch string, attempt string, source string, lang string, version string, d_docs long, d_tokens long"
_COMMITS = "batch string, attempt string"


class RollupStore:
    """Totals by source, language and tokenizer version in a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        for part, ddl in (("deltas", _DELTAS), ("commits", _COMMITS)):
            spark.createDataFrame([], ddl).write.mode("append").parquet(f"{folder}/{part}")

    def _read(self, part: str, ddl: str) -> DataFrame:
        return self.spark.read.schema(ddl).parquet(f"{self.folder}/{part}")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch of changes (`before`, `after`: structs of GROUP and n_tokens); False if it is in already."""
        if not self._read("commits", _COMMITS).filter(F.col("batch") == batch).isEmpty():
            return False
        attempt = uuid.uuid4().hex
        deltas = signed(changes).groupBy(*GROUP).agg(F.sum("d_docs").alias("d_docs"), F.sum("d_tokens").alias("d_tokens"))
        deltas.select(F.lit(batch).alias("batch"), F.lit(attempt).alias("attempt"), "*").write.mode("append").parquet(f"{self.folder}/deltas")
        self.spark.createDataFrame([(batch, attempt)], _COMMITS).write.mode("append").parquet(f"{self.folder}/commits")
        return True

    def totals(self) -> DataFrame:
        """GROUP, n_docs, n_tokens over all committed batches."""
        counted = self._read("commits", _COMMITS).groupBy("batch").agg(F.min("attempt").alias("attempt"))
        sums = self._read("deltas", _DELTAS).join(counted, ["batch", "attempt"], "left_semi").groupBy(*GROUP).agg(
            F.sum("d_docs").alias("n_docs"), F.sum("d_tokens").alias("n_tokens"))
        return sums.filter((F.col("n_docs") != 0) | (F.col("n_tokens") != 0))


def signed(changes: DataFrame) -> DataFrame:
    """A change's rows: plus one document where it is now, minus one where it was."""

    def side(name, sign):
        return F.when(F.col(name).isNotNull(), F.struct(
            *[F.col(name)[g].cast("string").alias(g) for g in GROUP], F.lit(sign).cast("long").alias("d_docs"),
            (F.lit(sign) * F.coalesce(F.col(name)["n_tokens"], F.lit(0)).cast("long")).alias("d_tokens")))

    sides = changes.select(F.explode(F.array(side("after", 1), side("before", -1))).alias("side"))
    return sides.filter(F.col("side").isNotNull()).select("side.*")


def counted(source: str, lang: str, version: str, n_tokens: str):
    """A document's place and count, for `before` or `after`."""
    return F.struct(F.col(source).cast("string").alias("source"), F.col(lang).cast("string").alias("lang"),
                    F.lit(version).alias("version"), F.col(n_tokens).cast("long").alias("n_tokens"))


def no_side():
    return F.lit(None).cast("struct<source: string, lang: string, version: string, n_tokens: long>")
