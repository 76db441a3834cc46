"""Stage tables, keys that reach the scan, and DISTINCT by digest."""

import random
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import stages
from ledgerloom.operators.stages import at_once, distinct_staged, rows_of, staged, staged_alone, staged_in_parts, staged_keys


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large_tables(spark):
    """Nothing is broadcast, and tables of any size get a Bloom filter of the keys they are joined with."""
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
               "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    before = {k: spark.conf.get(k, None) for k in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_a_stage_is_computed_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    stage = staged(spark.range(100).mapInArrow(seen, "id long"), "counted")
    assert stage.count() == 100 and stage.join(stage.withColumnRenamed("id", "other"), F.col("id") == F.col("other")).count() == 100
    assert calls.value == 100


def test_keys_are_different_and_complete(rows):
    keys = staged_keys(rows("a int, b string", (3, "x"), (3, "x"), (None, "y"), (1, None), (-2, "é")), {"n": "a", "t": "b"}, "keys")
    assert sorted(map(tuple, keys.rows.collect())) == [(-2, "é"), (3, "x")]
    assert keys.count == 2 and keys.ranges == {"n": (-2, 3), "t": ("x", "é")}
    fact = rows("i int, a int, b string", (1, 3, "x"), (2, 3, "é"), (3, -2, "é"), (4, None, "x"), (5, 3, None), (6, 3, "x"))
    assert sorted(r["i"] for r in rows_of(fact, keys, {"a": "n", "b": "t"}).collect()) == [1, 3, 6]
    none = staged_keys(rows("a int", (None,)), ["a"], "none")
    assert none.count == 0 and rows_of(fact, none, {"a": "a"}).columns == ["i", "a", "b"] and rows_of(fact, none, {"a": "a"}).count() == 0


def test_stages_at_once_keep_their_order(spark):
    assert at_once(lambda: spark.range(3).count(), lambda: "b", lambda: spark.range(5).count()) == [3, "b", 5]
    with pytest.raises(ZeroDivisionError):
        at_once(lambda: 1, lambda: 1 // 0)


def history(spark, folder, days):
    """Lines of 2,000 notes a day, stored by day; notes are numbered without regard to the day."""
    lines = spark.range(days * 2000 * 5).select(
        F.floor(F.col("id") / 10_000).alias("day"), F.pmod(F.xxhash64(F.floor(F.col("id") / 5)), F.lit(10**12)).alias("note"), F.col("id").alias("line"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"))
    lines.repartitionByRange(4, "day").write.parquet(folder)
    return spark.read.parquet(folder)


def test_what_is_shuffled_grows_with_the_span(spark, tmp_path, large_tables):
    """One day of 5 and of 50 days: the filters below the exchange leave about the same rows."""
    moved = {}
    for days in (5, 50):
        lines = history(spark, f"{tmp_path}/lines{days}", days)
        keys = staged_keys(lines.where("day = 2"), ["note"], "day_keys")
        found = rows_of(lines.select("note", "line", "text"), keys, {"note": "note"})
        assert found.agg(F.count("line"), F.count_distinct("note")).first()[:] == (10_000, keys.count)
        counted = rows_of(lines.select("note", "line", "text"), keys, {"note": "note"})
        counted.write.format("noop").mode("overwrite").save()
        text = plan(counted)
        assert "might_contain" in text
        below = text[text.index("Exchange hashpartitioning(note"):]
        assert below.index("might_contain") < below.index("FileScan"), "the Bloom filter stands below the exchange"
        assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(note", text)
        counted.collect()
        final = counted._jdf.queryExecution().executedPlan()
        moved[days] = rows_before_the_join(final)
    assert moved[50] <= 1.3 * moved[5], moved


def rows_before_the_join(final):
    """Rows of the larger input of the semi join, by the metrics of its shuffle."""
    found, todo = [], [final]
    while todo:
        node = todo.pop()
        metrics = node.metrics()
        if node.nodeName() == "Exchange" and metrics.contains("shuffleRecordsWritten"):
            found.append(metrics.apply("shuffleRecordsWritten").value())
        children = [node.executedPlan()] if node.nodeName() == "AdaptiveSparkPlan" else [node.plan()] if node.nodeName().endswith("QueryStage") else []
        kids = node.children()
        todo += children + [kids.apply(i) for i in range(kids.size())]
    return max(found)


def test_ranges_of_keys_skip_row_groups(spark, tmp_path, large_tables):
    path = f"{tmp_path}/ordered"
    spark.range(200_000).select(F.col("id").alias("note"), F.col("id").alias("line")).repartitionByRange(8, "note").write.parquet(path)
    keys = staged_keys(spark.range(500, 600), {"note": "id"}, "few")
    found = rows_of(spark.read.parquet(path), keys, {"note": "note"})
    assert found.count() == 100
    assert "GreaterThanOrEqual(note,500), LessThanOrEqual(note,599)" in plan(found)


def test_distinct_by_digest_agrees_with_distinct(spark, rows):
    rng = random.Random(2)
    data = [tuple(rng.choice([None, *options]) for options in ((1, 2), ("", "a"), (0.0, -0.0, float("nan")), (True,))) for _ in range(400)]
    df = rows("a int, b string, c double, d boolean", *data)
    assert sorted(map(str, distinct_staged(df, "d").collect())) == sorted(map(str, df.distinct().collect()))
    # nothing repeated: no second comparison
    once = distinct_staged(spark.range(1000).selectExpr("id", "cast(id as string) t"), "d")
    assert once.count() == 1000 and "Exchange" not in plan(once)
    assert distinct_staged(df.limit(0), "d").count() == 0


def test_rows_that_differ_in_one_column_or_in_where_null_stands_stay(rows):
    df = rows("a string, b string, c string", ("x", None, None), (None, "x", None), (None, None, "x"), ("x", "y", "z"), ("x", "y", "w"), ("x", "y", "w"))
    assert distinct_staged(df, "d").count() == 5


def test_a_stage_leaves_no_shuffle_files_and_its_frame_can_run_again(spark):
    from ledgerloom.session import apply_settings

    assert apply_settings(spark).conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
    counted = spark.range(0, 1000, 1, 4).groupBy((F.col("id") % 10).alias("k")).count()
    assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, counted.collect())) == [(k, 100) for k in range(10)]


def files(folder):
    """Bytes of the stages in a folder, by their names, without those that were emptied."""
    found = {}
    for path in folder.rglob("part-*.parquet"):
        if pq.ParquetFile(path).metadata.num_rows:
            name = re.sub(r"-[0-9a-f]{32}$", "", path.parent.name)
            found[name] = found.get(name, 0) + path.stat().st_size
    return found


def test_parts_keep_their_rows_and_leave_none_of_their_stages(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stages, "work_folder", lambda spark: str(tmp_path))
    threshold = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before, seen = spark.conf.get(threshold), []

    def part(k):
        seen.append((spark.conf.get(threshold), set(files(tmp_path))))
        halves = at_once(lambda: staged(spark.range(k * 10, k * 10 + 5), "low"), lambda: staged(spark.range(k * 10 + 5, k * 10 + 10), "high"))
        both = staged_alone(spark, lambda: staged(halves[0], "again").union(halves[1]), "both")
        assert {"low", "high", "both"} <= set(files(tmp_path)) and "again" not in files(tmp_path)
        return both

    whole = staged_in_parts(spark, [lambda k=k: part(k) for k in range(3)], "whole")
    assert sorted(r.id for r in whole.collect()) == list(range(30)) == sorted(r.id for r in whole.collect())
    assert [names for _, names in seen] == [set(), {"whole"}, {"whole"}] and set(files(tmp_path)) == {"whole"}
    assert seen[0][0] == "128MB" and spark.conf.get(threshold) == before
    with pytest.raises(ZeroDivisionError):
        staged_in_parts(spark, [lambda: 1 // staged(spark.range(3), "low").where("id > 5").count()], "failed")
    assert set(files(tmp_path)) == {"whole"} and spark.conf.get(threshold) == before
