"""Repeated lines across documents: levelled sorted runs of line hashes, merge-anti-joined batch by batch.

A line's key is the line with ASCII white space stripped at both ends and A-Z lower-cased; keys of fewer than
`min_chars` code points are never looked at. A key found in `min_docs` documents or more is common: all
its lines go, except those of the largest doc_id that holds it.

The store keeps runs: bucketed tables sorted by hash, with the number of documents and the largest id per line. A
new batch of documents is reduced to one row per line and anti-joined, bucket by bucket, with each run: a line
that a run already settles (common there, kept by no smaller id) adds nothing; the others become a
run of the lowest level. FAN runs of a level are merged into one run of the next, counts added up and ids
maximised, so a batch meets a few runs per level. Counts add and ids maximise in any order, hence batches may
come in any order too, as long as all rows of one document are in one batch.

Line hashes are two 64-bit hashes of other seeds; a document's text is known by two more, so that the
numbers of its dropped lines, no texts, are what is sent back to it. Lines are cut and hashed once and stored by batch.

Null and empty texts are one empty line, which is never dropped. Rows of one doc_id count as one document, and
all of them keep the lines that this id keeps. Rows without id are no document of their own: they are not counted and
lose every common line. A line repeated within a text goes or stays with all its copies. A text that loses every line
is empty; a text that loses none is untouched (null stays null). Texts are split whole at any length; an empty
table stays empty. All other columns pass through under their own names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.frames import set_aside, shared_path, stored

MIN_CHARS, MIN_DOCS = 40, 5
#: Runs of one level that are merged into a run of the next; batches that a whole table is dealt into.
FAN, BATCHES = 3, 4

_WHITE = " \t\n\v\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KEY, _TEXT = ["h1", "h2"], ["t1", "t2"]


def lines_of(text: Column) -> Column:
    """The lines of a text; null and empty: one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hashes(value: Column) -> tuple[Column, Column]:
    return F.xxhash64(value), F.xxhash64(F.lit(1), value)


def _folded(text: Column) -> Column:
    """A-Z lower-cased; texts of ASCII alone take the quicker way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def long_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, text hashes, line number and line hashes of every line whose key is long enough."""
    column = F.col(text)
    lines = docs.select(F.col(doc_id).alias("doc_id"), *(h.alias(n) for n, h in zip(_TEXT, _hashes(column))),
                        F.posexplode(F.split(_folded(column), "\n", -1)).alias("line_no", "line"))
    key = F.btrim("line", F.lit(_WHITE))
    keyed = lines.select("doc_id", *_TEXT, "line_no", key.alias("key")).filter(F.char_length("key") >= min_chars)
    return keyed.select("doc_id", *_TEXT, "line_no", *(h.alias(n) for n, h in zip(_KEY, _hashes(F.col("key")))))


def counted(lines: DataFrame) -> DataFrame:
    """One row per line: in how many documents it stands (`docs`) and the largest id of them (`keeper`)."""
    once = lines.filter("doc_id IS NOT NULL").groupBy(*_KEY, "doc_id").agg(F.lit(1).alias("one"))
    return once.groupBy(*_KEY).agg(F.count("doc_id").alias("docs"), F.max("doc_id").alias("keeper"))


class LineRuns:
    """Sorted runs of line hashes by level; new batches are added, full levels merged."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fan: int = FAN):
        self.spark, self.min_docs, self.fan = spark, min_docs, fan
        self.levels: list[list[str]] = [[]]
        # As many buckets as a shuffle has partitions: a batch meets the runs without moving either again.
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # A union of bucketed scans counts as bucketed itself, but Spark 4.1 puts their batches one after the other:
        # rows of one line then stay in different tasks. Such unions are shuffled instead.
        spark.conf.set("spark.sql.unionOutputPartitioning", "false")

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def _written(self, rows: DataFrame, level: int) -> str:
        name = f"line_run_{level}_{uuid.uuid4().hex}"
        rows.write.bucketBy(self.buckets, *_KEY).sortBy(*_KEY).option("path", shared_path(self.spark, name)).saveAsTable(name, format="parquet")
        return name

    def add(self, lines: DataFrame) -> None:
        """Enter a batch: one row per line that no run settles."""
        own = counted(lines)
        for run in self.runs():
            held = run.select(*(F.col(k).alias(f"r_{k}") for k in _KEY), F.col("docs").alias("r_docs"), F.col("keeper").alias("r_keeper"))
            same = (F.col("h1") == F.col("r_h1")) & (F.col("h2") == F.col("r_h2"))
            own = own.join(held, same & (F.col("r_docs") >= self.min_docs) & (F.col("r_keeper") >= F.col("keeper")), "left_anti")
        self.levels[0].append(self._written(own, 0))
        self._compact()

    def _compact(self) -> None:
        for level, names in enumerate(self.levels):
            if len(names) < self.fan:
                return
            if level + 1 == len(self.levels):
                self.levels.append([])
            merged = self._written(self._merged([self.spark.table(n) for n in names]), level + 1)
            self.levels[level + 1].append(merged)
            self.levels[level] = []
            for name in names:
                self.spark.sql(f"DROP TABLE {name}")

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        rows = runs[0]
        for run in runs[1:]:
            rows = rows.unionByName(run)
        return rows.groupBy(*_KEY).agg(F.sum("docs").alias("docs"), F.max("keeper").alias("keeper"))

    def common(self) -> DataFrame:
        """Hashes and keeper of the lines found in min_docs documents or more."""
        return self._merged(self.runs()).filter(F.col("docs") >= self.min_docs).select(*_KEY, "keeper")

    def drop(self) -> None:
        """Forget the runs; their files stay in the shared folder."""
        for name in (n for level in self.levels for n in level):
            self.spark.sql(f"DROP TABLE {name}")
        self.levels = [[]]


def common_lines(lines: DataFrame, batches: int = BATCHES, min_docs: int = MIN_DOCS, fan: int = FAN) -> DataFrame:
    """Common lines of stored `lines` (with a column `batch`), entered batch after batch."""
    store = LineRuns(lines.sparkSession, min_docs, fan)
    for batch in range(batches):
        store.add(lines.filter(F.col("batch") == batch))
    found = stored(store.common(), "common_lines")
    store.drop()
    return found


def without_common_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                         min_docs: int = MIN_DOCS, batches: int = BATCHES, fan: int = FAN) -> DataFrame:
    """docs with the texts that are left, and the numbers of lines before and of lines dropped (n_lines, n_dropped)."""
    renamed, names, back = set_aside(docs.drop("n_lines", "n_dropped"))
    own_id, own_text = names[doc_id], F.col(names[text])
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")
    path = shared_path(docs.sparkSession, "lines")
    long_lines(renamed, own_id, names[text], min_chars).withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    lines = docs.sparkSession.read.schema(
        f"doc_id {renamed.schema[own_id].dataType.simpleString()}, t1 long, t2 long, line_no int, h1 long, h2 long, batch int").parquet(path)
    common = common_lines(lines, batches, min_docs, fan)
    dropped = lines.join(common, _KEY).filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    per_text = dropped.groupBy(F.struct("doc_id", *_TEXT).alias("of")).agg(F.array_sort(F.collect_set("line_no")).alias("gone"))
    here = renamed.withColumn("of", F.struct(F.col(own_id).alias("doc_id"), *(h.alias(n) for n, h in zip(_TEXT, _hashes(own_text)))))
    met = here.join(per_text, here["of"].eqNullSafe(per_text["of"]), "left").select(*renamed.columns, "gone")
    cut = met.withColumn("lines", lines_of(own_text))
    n_gone = F.coalesce(F.size("gone"), F.lit(0))
    # What is left lies between the dropped lines: one slice before each, one after the last.
    starts = F.concat(F.array(F.lit(0)), F.transform("gone", lambda g: g + 1))
    ends = F.concat("gone", F.array(F.size("lines")))
    left = F.array_join(F.flatten(F.filter(F.transform(
        F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda x: F.slice("lines", x["a"] + 1, x["b"] - x["a"])), lambda x: F.size(x) > 0)), "\n")
    kept = cut.select(*(F.when(n_gone > 0, left).otherwise(F.col(c)).alias(c) if c == names[text] else F.col(c) for c in renamed.columns),
                      F.size("lines").cast("long").alias("n_lines"), n_gone.cast("long").alias("n_dropped"))
    return kept.select(*(F.col(n).alias(c) for c, n in names.items()), "n_lines", "n_dropped")
