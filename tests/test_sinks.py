"""Targets that can be loaded again, checked and gone back from; drift before a load; ranges of a table read in parallel."""

import datetime as dt
import random
from decimal import Decimal as D
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import ledgerloom
from ledgerloom.operators.quality import aligned, catalog_objects, schema_drift
from ledgerloom.plans import registry
from ledgerloom.sinks import tables
from ledgerloom.sinks.tables import append, batches, content_check, current_version, full_refresh, load, roll_back, version_rows, version_tables
from ledgerloom.sources import jdbc, scripts


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_a_batch_that_comes_twice_is_added_once(rows, spark, tmp_path):
    assert load(rows("id int", (1,)), "o_twice", str(tmp_path), "append", batch="monday").created
    assert load(rows("id int", (1,)), "o_twice", str(tmp_path), "append", batch="monday").repeated
    first = append(rows("id int", (2,)), "o_twice", "it's \\ tuesday")
    again = append(rows("id int", (2,)), "o_twice", "it's \\ tuesday")
    assert (first.rows, first.repeated, again.rows, again.repeated) == (1, False, 0, True)
    assert append(rows("id int", (2,)), "o_twice").rows == append(rows("id int", (2,)), "o_twice").rows == 1
    assert ids(spark.table("o_twice")) == [1, 2, 2, 2]
    assert sorted(batches(spark, current_version(spark, "o_twice")))[-2:] == ["it's \\ tuesday", "monday"]


def test_a_job_killed_between_writing_and_entering_leaves_right_rows(rows, spark, tmp_path, monkeypatch):
    full_refresh(rows("id int", (1,)), "o_killed", str(tmp_path))

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(tables, "_enter", killed)
    with pytest.raises(KeyboardInterrupt):
        append(rows("id int", (2,)), "o_killed", "b")
    with pytest.raises(KeyboardInterrupt):
        full_refresh(rows("id int", (9,)), "o_killed", str(tmp_path))
    monkeypatch.undo()
    assert ids(spark.table("o_killed")) == [1], "what was written is not read"
    assert append(rows("id int", (2,)), "o_killed", "b").rows == 1 and append(rows("id int", (2,)), "o_killed", "b").repeated
    assert ids(spark.table("o_killed")) == [1, 2]
    assert all(r["count_consistent"] and r["content_consistent"] for r in content_check(spark, "o_killed").collect())


def test_a_job_killed_while_writing_leaves_the_old_rows(rows, spark, tmp_path):
    full_refresh(rows("id int", (1,)), "o_writing", str(tmp_path))
    broken = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("id").cast("int")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        append(broken, "o_writing", "b")
    assert ids(spark.table("o_writing")) == [1]
    append(rows("id int", (5,)), "o_writing", "b")
    assert ids(spark.table("o_writing")) == [1, 5]


def test_two_writers_of_one_batch(rows, spark, tmp_path):
    """Both wrote before either entered: the second entry changes nothing."""
    full_refresh(rows("id int", (1,)), "o_race", str(tmp_path))
    version = current_version(spark, "o_race")
    folders = [tables.prepared(rows("id int", (2,)), "o_race", "b")[0] for _ in range(2)]
    assert [tables._enter(spark, version, "b", f) for f in folders] == [True, False]
    assert ids(spark.table("o_race")) == [1, 2]


def test_runs_with_a_batch_are_repeated_safely(rows, spark, tmp_path):
    for message in ("created", "repeated"):
        runs = registry.refresh(spark, [("o_run", lambda: rows("id int", (1,), (2,)))], str(tmp_path), mode="append", batch="day 1").collect()
        assert (runs[0].succeeded, runs[0].message) == (True, message)
    assert spark.table("o_run").count() == 2


def test_content_check_finds_a_changed_value(rows, spark, tmp_path):
    data = rows("id int, t string, d decimal(10,2), x double", (1, "a", D("1.50"), None), (2, None, None, 0.5), (2, None, None, 0.5))
    full_refresh(data, "o_content", str(tmp_path))
    append(data, "o_content", "more")
    assert {tuple(r)[1:] for r in content_check(spark, "o_content").collect()} == {(3, 3, True, True)}
    (folder, *_) = tables._entries(spark, current_version(spark, "o_content"))["more"]
    data.withColumn("t", F.when(F.col("id") == 1, "b")).write.mode("overwrite").parquet(folder)
    spark.catalog.refreshTable(current_version(spark, "o_content"))
    found = {r["batch"]: tuple(r)[1:] for r in content_check(spark, "o_content").collect()}
    assert found == {"refresh": (3, 3, True, True), "more": (3, 3, True, False)}
    # a value that moves to another column, or a row that is lost
    data.select("id", F.lit(None).cast("string").alias("t"), "d", F.col("t").isNotNull().cast("double").alias("x")).limit(2).write.mode("overwrite").parquet(folder)
    spark.catalog.refreshTable(current_version(spark, "o_content"))
    assert {r["batch"]: tuple(r)[1:] for r in content_check(spark, "o_content").collect()}["more"] == (3, 2, False, False)
    full_refresh(data.limit(0), "o_nothing", str(tmp_path))
    assert [tuple(r)[1:] for r in content_check(spark, "o_nothing").collect()] == [(0, 0, True, True)]


def test_versions_are_read_and_gone_back_to(rows, spark, tmp_path):
    for k in range(4):
        full_refresh(rows("id int", (k,)), "o_back", str(tmp_path))
    assert [ids(version_rows(spark, "o_back", n)) for n in range(3)] == [[3], [2], [1]]
    with pytest.raises(ValueError, match="3 versions"):
        version_rows(spark, "o_back", 3)
    roll_back(spark, "o_back", 2)
    assert ids(spark.table("o_back")) == [1]
    append(rows("id int", (10,)), "o_back")
    assert ids(spark.table("o_back")) == [1, 10]
    full_refresh(rows("id int", (7,)), "o_back", str(tmp_path))
    assert ids(spark.table("o_back")) == [7] and [ids(version_rows(spark, "o_back", n)) for n in range(3)] == [[7], [1, 10], [3]]
    assert len(version_tables(spark, "o_back")) == 3


def test_emptied_versions_lose_their_appended_batches_too(rows, spark, tmp_path):
    full_refresh(rows("id int", (1,)), "o_old", str(tmp_path))
    append(rows("id int", (2,)), "o_old", "b")
    folders = [e[0] for e in tables._entries(spark, current_version(spark, "o_old")).values()]
    for k in (3, 4):
        full_refresh(rows("id int", (k,)), "o_old", str(tmp_path), retain=1)
    assert len(folders) == 2 and [spark.read.schema("id int").parquet(f).count() for f in folders] == [0, 0]


def test_a_folder_with_an_apostrophe(rows, spark, tmp_path):
    folder = tmp_path / "it's here"
    full_refresh(rows("id int", (1,)), "o_quote", str(folder))
    full_refresh(rows("id int", (2,)), "o_quote", str(folder))
    append(rows("id int", (3,)), "o_quote", "b")
    assert ids(spark.table("o_quote")) == [2, 3]


def test_a_plain_table_keeps_its_rows_under_another_name(rows, spark, tmp_path):
    rows("id int", (1,)).write.option("path", str(tmp_path / "plain")).saveAsTable("o_plain")
    with pytest.raises(ValueError, match="refresh it first"):
        append(rows("id int", (2,)), "o_plain")
    full_refresh(rows("id bigint", (2,)), "o_plain", str(tmp_path))
    assert ids(spark.table("o_plain")) == [2] and spark.table("o_plain").schema["id"].dataType == T.IntegerType()
    (kept,) = [t.name for t in spark.catalog.listTables() if t.name.startswith("o_plain_before_")]
    assert ids(spark.table(kept)) == [1]


def test_the_planner_knows_the_size_of_a_target(rows, spark, tmp_path):
    full_refresh(rows("id int", (1,), (2,)), "o_sized", str(tmp_path))
    joined = spark.range(1_000_000).join(spark.table("o_sized"), "id")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().sparkPlan().toString()
    assert spark.table("o_sized").columns == ["id"]
    kinds = {r["name"]: r["kind"] for r in catalog_objects(spark).collect() if r["name"].startswith("o_sized")}
    assert kinds == {"o_sized": "TABLE"}


# Drift

def test_drift_is_named_per_column(rows):
    stored = T.StructType.fromDDL("a int, b decimal(10,2), c date, d string, e bigint, gone string")
    df = rows("a bigint, b decimal(12,4), c timestamp_ntz, d string, e int, new int",
              (1, D("1.5000"), dt.datetime(2024, 1, 1), "x", 1, 1), (2**40, D("1.2345"), dt.datetime(2024, 1, 1, 10), "x", 1, 1), (None, None, None, None, None, None))
    found = {r["column_name"]: (r["stored_type"], r["incoming_type"], r["change"], r["changed_values"]) for r in schema_drift(df, stored).collect()}
    assert found == {
        "a": ("int", "bigint", "wider", 1), "b": ("decimal(10,2)", "decimal(12,4)", "wider", 1), "c": ("date", "timestamp_ntz", "wider", 1),
        "d": ("string", "string", "same", 0), "e": ("bigint", "int", "narrower", 0), "gone": ("string", None, "lost", 0), "new": (None, "int", "added", 0)}
    declared = T.StructType.fromDDL("a int, more string")
    (row,) = schema_drift(df, stored, declared).where("column_name = 'more'").collect()
    assert tuple(row) == ("more", "string", None, None, "lost", 0)


@pytest.mark.parametrize("incoming, stored, fits, does_not", [
    ("decimal(12,4)", "decimal(10,2)", D("3.1000"), D("3.1001")), ("bigint", "int", 2**31 - 1, 2**31), ("double", "decimal(10,2)", 0.25, 0.125),
    ("double", "int", 3.0, 3.5), ("timestamp_ntz", "date", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 1)),
    ("bigint", "double", 2**53, 2**53 + 1), ("decimal(38,10)", "bigint", D("7"), D("7.5"))])
def test_a_narrowing_that_changes_a_value_is_an_error(rows, incoming, stored, fits, does_not):
    target = T.StructType.fromDDL(f"v {stored}")
    assert [r["v"] for r in aligned(rows(f"v {incoming}", (fits,), (None,)), target).where("v IS NOT NULL").collect()] != []
    with pytest.raises(Exception, match="does not fit|CAST_OVERFLOW"):
        aligned(rows(f"v {incoming}", (does_not,)), target).collect()


def test_a_refresh_that_would_change_values_leaves_the_old_rows(rows, spark, tmp_path):
    full_refresh(rows("id int, v decimal(10,2)", (1, D("1.25"))), "o_drift", str(tmp_path))
    for run in (lambda df: full_refresh(df, "o_drift", str(tmp_path)), lambda df: append(df, "o_drift", "b")):
        with pytest.raises(Exception, match="v does not fit"):
            run(rows("id int, v decimal(10,3)", (1, D("1.255"))))
    assert [tuple(r) for r in spark.table("o_drift").collect()] == [(1, D("1.25"))]


# Parallel reads

def of_ranges(spark, predicates, values):
    df = spark.createDataFrame([(v,) for v in values], "k bigint").coalesce(1)
    return [df.where(p).count() for p in predicates]


@pytest.mark.parametrize("kind", ["even", "skewed", "hot", "few"])
def test_ranges_hold_about_the_same_number_of_rows(spark, kind):
    rng = random.Random(6)
    values = {"even": list(range(4000)), "skewed": [int(rng.paretovariate(0.5)) % 10**12 for _ in range(4000)],
              "hot": [5] * 1500 + list(range(2500)), "few": [1, 2, 2, 3] * 100}[kind] + [None] * 40
    known, slices = sorted(v for v in values if v is not None), 64
    tiles = [known[i * len(known) // slices: (i + 1) * len(known) // slices] for i in range(slices)]
    predicates = jdbc.split_predicates("k", [(t[-1], len(t)) for t in tiles if t], 8)
    sizes = of_ranges(spark, predicates, values)
    assert sum(sizes) == len(values) and sizes[-1] == 40
    largest = max(known.count(v) for v in set(known))
    assert max(sizes[:-1]) <= max(2 * len(known) / 8, largest * 1.2)


def test_ranges_of_nothing_and_of_other_types():
    assert jdbc.split_predicates("k", [], 4) == ["k IS NOT NULL", "k IS NULL"]
    assert jdbc.split_predicates("k", [(dt.date(2024, 1, 1), 5), (dt.date(2024, 2, 1), 5)], 2) == [
        "k <= DATE '2024-01-01'", "k > DATE '2024-01-01'", "k IS NULL"]
    assert jdbc.split_predicates("k", [("o'x", 5), ("z", 5)], 2)[0] == "k <= 'o''x'"
    assert "NTILE(8) OVER (ORDER BY k)" in jdbc.histogram_query("t", "k", 8)
    with pytest.raises(ValueError):
        jdbc.split_predicates("k", [], 0)


def test_scripts_are_listed_by_spark_alone(spark, tmp_path):
    for name in ("b ü.sql", "empty.sql", "a%20b.sql", "c.txt"):
        (tmp_path / name).write_bytes(b"" if name.startswith("empty") else b"SELECT 1")
    (tmp_path / "deeper").mkdir()
    (tmp_path / "deeper" / "d.sql").write_text("SELECT 1")
    assert [(r["name"], r["text"]) for r in scripts.scripts(spark, str(tmp_path)).collect()] == [
        ("a%20b.sql", "SELECT 1"), ("b ü.sql", "SELECT 1"), ("empty.sql", "")]
    sources = "".join(p.read_text() for p in Path(ledgerloom.__file__).parent.rglob("*.py"))
    assert "_jvm" not in sources and "_jsc" not in sources
