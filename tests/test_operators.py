"""Joins, lists and plans: results on small rows, and the shape the work takes on a cluster."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from ledgerloom.functions import day_text
from ledgerloom.operators.joins import (
    distinct_rows,
    distinct_union,
    has_match,
    latest_by,
    lookup,
    matching,
    padded_union,
    share_of_total,
    total_order,
    totals_by,
)
from ledgerloom.operators.lists import joined_list
from ledgerloom.queries import QUERIES


def collected(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_twice_on_one_table(rows):
    cities = rows("code int, name string", (1, "A"), (2, "B"))
    trips = rows("i int, home int, goal int", (1, 1, 2), (2, 2, 9), (3, None, 1))
    out = lookup(lookup(trips, cities, {"home": "code"}, {"home_name": "name"}), cities, {"goal": "code"}, {"goal_name": "name"})
    assert sorted(collected(out, "i", "home_name", "goal_name")) == [(1, "A", "B"), (2, "B", None), (3, None, "A")]


def test_lookup_takes_expressions_and_the_key_itself(rows):
    dim = rows("code int, a string, b string", (1, "x", ""))
    out = lookup(rows("k int", (1,), (2,)), dim, {"k": "code"}, {"code": "code", "both": F.concat("a", F.lit("!")), "b": F.nullif("b", F.lit(""))})
    assert sorted(collected(out, "k", "code", "both", "b")) == [(1, 1, "x!", None), (2, None, None, None)]


def test_match_flags_and_filters(rows):
    left, right = rows("k int", (1,), (2,), (None,)), rows("c int", (2,), (2,), (None,))
    assert sorted(collected(has_match(left, right, {"k": "c"}, "hit"), "k", "hit"), key=str) == [(1, False), (2, True), (None, False)]
    assert collected(matching(left, right, {"k": "c"}), "k") == [(2,)]
    assert sorted(collected(matching(left, right, {"k": "c"}, keep=False), "k"), key=str) == [(1,), (None,)]


def test_share_of_total_edges(rows):
    df = rows("i int, a int, b string, q int", (1, 1, "x", 1), (2, 1, "x", 3), (3, 2, "x", 0), (4, None, "x", 5), (5, 1, "y", None), (6, 1, "y", 2))
    out = dict(collected(share_of_total(df, ["a", "b"], "q", "s"), "i", "s"))
    assert out == {1: 0.25, 2: 0.75, 3: None, 4: None, 5: None, 6: 1.0}
    assert dict(collected(share_of_total(df, ["a", "b"], "q", "s", empty_as_zero=True), "i", "s"))[5] == 0.0


def test_latest_prefers_a_missing_day(rows):
    day = dt.date
    df = rows("k int, d date, n int, p int", (1, day(2024, 1, 1), 5, 10), (1, day(2024, 2, 1), 1, 20), (1, day(2024, 2, 1), 2, 30),
              (2, None, 1, 40), (2, day(2024, 9, 1), 9, 50), (None, day(2024, 1, 1), 1, 60))
    assert sorted(collected(latest_by(df, ["k"], ["d", "n"], p="p"), "k", "p"), key=str) == [(1, 30), (2, 40), (None, 60)]


def test_latest_agrees_with_brute_force(spark):
    rnd = random.Random(5)
    data = [(rnd.randrange(20), rnd.choice([None, 1, 2, 3]), rnd.randrange(50), i) for i in range(2000)]
    df = spark.createDataFrame(data, "k int, a int, b int, i int")
    best = {}
    for k, a, b, i in data:
        rank = ((a is None, a or 0), b, i)
        best[k] = max(best.get(k, (rank, i)), (rank, i))
    assert dict(collected(latest_by(df, ["k"], ["a", "b", "i"], i="i"), "k", "i")) == {k: v[1] for k, v in best.items()}


def test_latest_by_any_types(spark):
    """NULLs, ties, negative and extreme values, packed into words, or not (text)."""
    rnd = random.Random(1)

    def some(*values):
        return rnd.choice([None, *values])

    data = [(rnd.randrange(200), some(-2**63, 2**63 - 1, 0, -1, 5), some(dt.datetime(1, 1, 1), dt.datetime(1969, 12, 31, 23, 59, 59, 999_999), dt.datetime(9999, 12, 31, 23, 59, 59, 1)),
             some(dt.date(1, 1, 1), dt.date(1969, 12, 31), dt.date(9999, 12, 31)), some(*map(Decimal, ("-99999999999999.9999", "0", "0.0001", "-0.0001", "99999999999999.9999"))),
             some("a", "b", ""), some(True, False), i) for i in range(4000)]
    df = spark.createDataFrame(data, "k int, n bigint, t timestamp_ntz, d date, p decimal(18,4), s string, b boolean, i int")
    for order in (["n", "t", "d", "p", "s", "b", "i"], ["t", "n"], ["b", "d", "n"], ["p", "t", "n"], ["s"], ["p", "s", "n"]):
        best, at = {}, [df.columns.index(c) for c in order]
        for row in data:
            rank = tuple((row[j] is None, row[j] if row[j] is not None else 0) for j in at)
            best[row[0]] = max(best.get(row[0], (rank, row[7])), (rank, row[7]))
        assert dict(collected(latest_by(df, ["k"], order, i="i"), "k", "i")) == {k: v[1] for k, v in best.items()}, order


def relations(df):
    return sum("Relation [" in line or "LogicalRDD" in line for line in df._jdf.queryExecution().optimizedPlan().toString().split("\n"))


def test_latest_reads_its_input_once_per_word(spark, rows, no_broadcast):
    df = rows("k int, d timestamp_ntz, n bigint, a int, b date, p decimal(18,4), o bigint", (1, None, 1, 1, None, Decimal(1), 1))
    for order, reads in ((["n"], 2), (["d", "n"], 2), (["d", "n", "p"], 3), (["d", "n", "p", "a"], 3), (["d", "n", "p", "a", "b", "o"], 4)):
        found = latest_by(df, ["k"], order, p="p")
        assert relations(found) == reads, order
        assert "SortAggregate" not in plan(found) and "partial_max" in plan(found)
    for name in ("topk_last_price", "subq_corr_top1"):
        assert relations(QUERIES[name](spark, SMALL)) <= 8, name


def test_rows_of_a_hot_key_are_dealt_by_their_words(spark, no_broadcast):
    hot = skewed(spark).withColumn("n", F.col("id") % 7)
    found = latest_by(hot, ["k"], ["n", "id"], id="id")
    assert dict(collected(found.where("k = -1"), "k", "id")) == {-1: max(i for i in range(0, 60_000, 3) if i % 7 == 6)}
    assert "Exchange hashpartitioning(_w0" in plan(found)
    # where they all share one word, too, the join splits them
    found = latest_by(skewed(spark).withColumn("n", F.col("id") % 1), ["k"], ["n"], pad="pad")
    found.collect()
    assert "skew=true" in plan(found)


def test_lists_sort_by_day_and_keep_repeats(rows):
    day = dt.date
    df = rows("k int, d date", (1, day(2025, 1, 2)), (1, day(2024, 12, 31)), (1, day(2024, 12, 31)), (1, None), (2, None))
    out = joined_list(df, ["k"], "d", "days", day_text)
    assert sorted(collected(out, "k", "days")) == [(1, "31/12/2024;31/12/2024;02/01/2025"), (2, None)]
    assert sorted(collected(joined_list(df, ["k"], "d", "days", day_text, distinct=True), "k", "days"))[0] == (1, "31/12/2024;02/01/2025")


def test_unions(rows):
    a, b = rows("k int, v string", (1, "x"), (1, "x")), rows("v string, k int", ("x", 1), ("y", 2))
    assert sorted(collected(distinct_union(a, b), "k", "v")) == [(1, "x"), (2, "y")]
    padded = padded_union(a, rows("k int, w double", (3, 1.5)))
    assert padded.schema["v"].dataType.simpleString() == "string"
    assert sorted(collected(padded, "k", "v", "w"), key=str) == [(1, "x", None), (1, "x", None), (3, None, 1.5)]


def test_distinct_rows_equals_distinct(rows):
    df = rows("a int, b string, c double", (1, None, 0.0), (1, None, -0.0), (1, "x", None), (1, "x", None), (None, None, None))
    assert sorted(collected(distinct_rows(df), "*"), key=str) == sorted(collected(df.distinct(), "*"), key=str)


def test_sort_breaks_ties_with_the_other_columns(rows):
    df = rows("k int, v int", (1, 3), (1, 1), (0, 9), (1, 2))
    assert collected(total_order(df, "k"), "k", "v") == [(0, 9), (1, 1), (1, 2), (1, 3)]


@pytest.fixture
def no_broadcast(spark):
    """Small partitions count as large, and nothing is broadcast, as with big tables."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def skewed(spark, n=60_000):
    """A third of the rows share one key."""
    return spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 1000).alias("k"), F.col("id"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"))


def test_hot_key_is_split_when_joined_to_its_totals(spark, no_broadcast):
    df = skewed(spark)
    out = share_of_total(df, ["k"], "id", "share")
    assert out.agg(F.round(F.sum("share"), 6)).first()[0] == 1001
    out.collect()
    assert "skew=true" in plan(out)


def test_grouping_by_bare_keys_would_not_be_split(spark, no_broadcast):
    """The reason totals are grouped by a struct: this shape keeps a hot key in one task."""
    df = skewed(spark)
    out = df.join(df.groupBy("k").agg(F.sum("id").alias("total")), "k")
    out.collect()
    assert "skew=true" not in plan(out)


def test_hot_key_is_split_in_a_lookup(spark, no_broadcast):
    dim = spark.range(-1, 1000).select(F.col("id").alias("code"), F.sha2(F.col("id").cast("string"), 256).alias("name"))
    out = lookup(skewed(spark), dim, {"k": "code"}, {"name": "name"})
    assert len(out.collect()) == 60_000
    assert "skew=true" in plan(out)


def test_totals_are_combined_before_the_shuffle(spark):
    text = plan(totals_by(skewed(spark), ["k"], n=F.count(F.lit(1))))
    assert text.count("HashAggregate") >= 2 and "partial_count" in text


def test_no_query_builds_pairs_without_a_key(spark):
    """No cross join, nested loop or window anywhere in the registered queries."""
    for name, run in QUERIES.items():
        if name.startswith("sink_") or name == "dq_refresh_counts":
            continue
        text = plan(run(spark, SMALL))
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Window ["):
            assert operator not in text, (name, operator)
        assert "PythonUDF" not in text and "BatchEvalPython" not in text, name


def test_filter_reaches_both_scans_below_the_union(spark):
    text = QUERIES["filter_over_union"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert text.count("PushedFilters: [") >= 2 or text.count("DataFilters: [") >= 2
    optimized = QUERIES["filter_over_union"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.index("Union") < optimized.index("Filter")


def test_only_needed_columns_are_read(spark):
    text = plan(QUERIES["join_inner"](spark, SMALL))
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_brand:string>" in text
