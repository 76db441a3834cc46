"""Manifest, line store and periodic runs against plain code, on odd rows, and through the registered queries."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from ledgerloom.llm import linestore, manifest, periodic
from ledgerloom.llm.frames import session

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
LONG_LINE = "A line of the licence that very many documents hold in common"
LONG = "\n".join(f"{LONG_LINE} {i % 7000}" for i in range(20_000))
ODD = [(1, None, None, "s", None), (2, "", "en", None, 0), (3, "one two", "en", "s", 7), (3, "one two", "en", "s", 7), (3, "other", "en", "s", 7),
       (None, "no id here", "de", "s", 10), (None, None, None, None, None), (4, LONG, "en", "s", len(LONG)), (5, "é\n\n", "é", "s", 3)]


@pytest.fixture(scope="module", autouse=True)
def settings(spark):
    session(spark)


# Manifest

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, columns=COLUMNS):
    return h(*("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in columns))


def plain_tree(leaves):
    """Levels from the leaves to the last node."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i: i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def plain_path(levels, i):
    found = []
    for level in levels[:-1]:
        start = i - i % 8
        found.append((level[start: i], level[i + 1: start + 8]))
        i //= 8
    return found


def plain_proofs(rows):
    """(doc_id, leaf, subroot, root, siblings) of every row."""
    trees = defaultdict(list)
    for row in rows:
        trees[row["lang"]].append((row["doc_id"] is not None, row["doc_id"] or 0, plain_leaf(row), row["doc_id"]))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    levels = {name: plain_tree([x[2] for x in sorted(trees[name], key=lambda x: x[:3])]) for name in names}
    top = plain_tree([levels[name][-1][0] for name in names]) if names else []
    out = []
    for k, name in enumerate(names):
        for i, x in enumerate(sorted(trees[name], key=lambda x: x[:3])):
            path = plain_path(levels[name], i) + plain_path(top, k)
            out.append((x[3], x[2], levels[name][-1][0], top[-1][0], "".join("".join(a + b) for a, b in path)))
    return sorted(out, key=str)


def built(docs):
    found = manifest.Manifest(docs, COLUMNS, group="lang", key="doc_id").proofs()
    own = found.withColumn("folded", manifest.folded(F.lower(F.hex("digest")))).collect()
    assert all(r["folded"] == r["root"].hex() for r in own)
    return sorted([(r["key"], r["digest"].hex(), r["subroot"].hex(), r["root"].hex(), r["siblings"]) for r in own], key=str)


def test_manifest_of_odd_rows(rows):
    docs = rows(DOCS, *ODD)
    assert built(docs) == plain_proofs([r.asDict() for r in docs.collect()])


def test_manifest_of_nothing(rows):
    assert built(rows(DOCS)) == []


@pytest.mark.parametrize("n", [1, 8, 9, 512, 513, 4097])
def test_manifest_of_all_heights(spark, n):
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"),
                                 F.when(F.col("id") % 50 != 7, "a").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    assert built(docs) == plain_proofs([r.asDict() for r in docs.collect()])


def test_manifest_of_many_groups(spark):
    """More groups than one aligned subtree of the upper tree holds."""
    docs = spark.range(1300).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.concat(F.lit("l"), F.col("id") % 650).alias("lang"),
                                    F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    assert built(docs) == plain_proofs([r.asDict() for r in docs.collect()])


def test_copies_and_one_id_are_parted(spark, monkeypatch):
    """A third of all rows is one row: range partitions split it."""
    docs = spark.range(30_000, numPartitions=8).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("x").alias("text"), F.lit("a").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    leaves = manifest.stored(docs.select(F.lit("=a").alias("tree"), F.col("doc_id").alias("key"), F.unhex(manifest.leaf(*COLUMNS)).alias("digest")), "leaves")
    written, stored = [], manifest.stored
    monkeypatch.setattr(manifest, "stored", lambda df, name: written.append(stored(df, name)) or written[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    numbered = manifest.numbered(leaves, ["key", "digest"], "ordered")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = written[0].groupBy(F.shiftright("at", 33)).count().collect()
    assert max(r["count"] for r in parts) < 10_000 / 2
    assert numbered.agg(F.countDistinct("pos"), F.max("pos"), F.min("pos")).first()[:] == (30_000, 29_999, 0)


def test_only_every_third_level_is_stored(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("a").alias("lang"))
    found = manifest.Manifest(docs, ("doc_id", "text"), group="lang", key="doc_id")
    assert [level.selectExpr("sum(size(nodes))").first()[0] for level in found.levels] == [5000, 10]
    assert max(r[0] for r in found.levels[0].selectExpr("size(nodes)").collect()) == 512


def test_a_changed_proof_or_leaf_leads_elsewhere(spark):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("a").alias("lang"))
    proofs = manifest.Manifest(docs, ("doc_id", "text"), group="lang", key="doc_id").proofs()
    own = F.lower(F.hex("digest"))
    other = proofs.select("root", manifest.folded(F.sha2(F.lit("y").cast("binary"), 256)).alias("f"))
    moved = proofs.withColumn("siblings", F.concat(F.lit("0" * 64), F.substr("siblings", F.lit(65)))).select("root", manifest.folded(own).alias("f"))
    for found in (other, moved):
        assert found.filter(F.col("f") == F.lower(F.hex("root"))).count() == 0


# Line store

def key_of(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\v\f\r"))


def plain_lines(rows, min_chars=40, min_docs=5):
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= min_chars and doc_id is not None:
                holders[key_of(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if len(holders.get(key_of(x), ())) < min_docs or max(holders[key_of(x)]) == doc_id]
        out.append((doc_id, "\n".join(left) if len(left) < len(lines) else text, len(lines), len(lines) - len(left)))
    return sorted(out, key=str)


def left_of(docs, **parameters):
    return sorted((tuple(r) for r in linestore.without_common_lines(docs, **parameters).select("doc_id", "text", "n_lines", "n_dropped").collect()), key=str)


def test_lines_of_random_documents(rows):
    rng = random.Random(3)
    pool = [f"{LONG_LINE} {i}" for i in range(12)] + ["short", "", "  ", "é" * 39, "é" * 40, "É" * 40, "x" * 40 + "\x0b", " \t" + "X" * 40]
    data = [(rng.choice([None, *range(30)]), rng.choice([None, "", *["\n".join(rng.choices(pool, k=rng.randint(1, 9))) for _ in range(5)]])) for _ in range(150)]
    docs = rows("doc_id long, text string", *data)
    want = plain_lines(data)
    assert sum(r[3] for r in want) > 100
    assert left_of(docs) == want
    assert left_of(docs, batches=7, fan=2) == want
    assert left_of(docs, min_chars=1, min_docs=3, batches=1) == plain_lines(data, 1, 3)


def test_lines_of_odd_rows(rows):
    docs = rows(DOCS, *ODD)
    assert left_of(docs) == plain_lines([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert left_of(rows(DOCS)) == []


def test_lines_of_very_long_texts(rows):
    data = [(i, LONG if i < 6 else "no such line") for i in range(8)]
    assert left_of(rows("doc_id long, text string", *data)) == plain_lines(data)


def test_line_columns_that_clash(rows):
    data = [(i, f"{LONG_LINE}\nown {i}", "a", i * 10, "p", 7, 9) for i in range(6)]
    found = linestore.without_common_lines(rows("doc_id long, text string, h1 string, line_no int, keeper string, n_lines int, gone int", *data))
    assert [f.name for f in found.schema] == ["doc_id", "text", "h1", "line_no", "keeper", "gone", "n_lines", "n_dropped"]
    got = sorted(tuple(r) for r in found.collect())
    assert got == [(i, f"own {i}" if i < 5 else f"{LONG_LINE}\nown {i}", "a", i * 10, "p", 9, 2, int(i < 5)) for i in range(6)]


def test_runs_are_merged_and_settled_lines_add_nothing(spark, rows):
    store = linestore.LineRuns(spark, fan=2)
    lines = [linestore.long_lines(rows("doc_id long, text string", *[(d, LONG_LINE) for d in range(first, first + 5)])) for first in (20, 10, 30, 0, 5)]
    sizes = []
    for batch in lines:
        store.add(batch)
        sizes.append([[spark.table(n).count() for n in level] for level in store.levels])
    # The second batch holds no greater id than the first, which settles the line; the third does.
    assert sizes == [[[1]], [[], [1]], [[1], [1]], [[], [], [1]], [[0], [], [1]]]
    assert [(r["docs"], r["keeper"]) for r in store._merged(store.runs()).collect()] == [(10, 34)]
    plan = store.runs()[0]._jdf.queryExecution().toString()
    store.drop()
    assert "Bucketed: true" in plan or "bucket" in plan.lower()


def test_a_batch_meets_the_runs_without_moving_them(spark, rows):
    store = linestore.LineRuns(spark)
    store.add(linestore.long_lines(rows("doc_id long, text string", (1, LONG_LINE))))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        own, run = linestore.counted(linestore.long_lines(rows("doc_id long, text string", (1, LONG_LINE)))), store.runs()[0]
        joined = own.join(run, linestore._KEY, "left_anti")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        store.drop()
    below = plan[plan.index("FileScan") - 200: plan.index("FileScan")]
    assert "SortMergeJoin" in plan and "Exchange" not in below


# Periodic runs

def plain_runs(words, min_words=24, repeats=3):
    found = []
    for q in range(1, len(words) // repeats + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(min_words, repeats * q) and not any(
                    q % p == 0 and s <= start and s + n >= start + length for s, n, p in found):
                found.append((start, length, q))
            i += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def periodic_text(rng):
    kinds, out = rng.choice([1, 2, 3, 5, 50]), []
    for _ in range(rng.randint(0, 6)):
        if rng.random() < 0.5:
            pattern = [f"w{rng.randrange(kinds)}é" for _ in range(rng.randint(1, 40))]
            times = rng.randint(1, 12)
            out += (pattern * times)[: rng.randint(1, len(pattern) * times)]
        else:
            out += [f"w{rng.randrange(kinds)}" for _ in range(rng.randint(0, 60))]
    return rng.choice([" ", "  ", "\n", "\x0b "]).join(out) + rng.choice(["", " "])


def test_runs_of_random_texts():
    rng, seen = random.Random(5), 0
    for _ in range(60):
        texts = [None, "", " \n", *[periodic_text(rng) for _ in range(5)], "\0 " * 30]
        counts, runs, collapsed = periodic.runs_of(pa.array(texts, pa.string()))
        for text, n, own, left in zip(texts, counts.tolist(), runs.to_pylist(), collapsed.to_pylist()):
            words = words_of(text)
            want = plain_runs(words)
            assert (n, [tuple(r.values()) for r in own], left) == (len(words), want, plain_collapsed(words, want))
            seen += len(want)
    assert seen > 200


def test_other_least_lengths():
    rng = random.Random(8)
    texts = [periodic_text(rng) for _ in range(20)]
    for min_words, repeats in ((4, 3), (6, 3), (30, 5), (3, 4)):
        _, runs, _ = periodic.runs_of(pa.array(texts), min_words, repeats)
        assert [[tuple(r.values()) for r in own] for own in runs.to_pylist()] == [plain_runs(words_of(t), min_words, repeats) for t in texts]


def test_two_repeats_are_refused():
    with pytest.raises(ValueError, match="three repeats"):
        periodic.runs_of(pa.array(["a a a a"]), repeats=2)


def test_splitting_goes_on_until_nothing_is_rare():
    # c falls first; then a, which stood three times only with its part behind c, and so on.
    words = ["a", "b", "b", "a", "b", "c", *["b", "d"] * 13, "a", "e", "e", "e"]
    codes = periodic._codes("".join(f"{w} " for w in words).encode(), __import__("numpy").cumsum([0] + [len(w) + 1 for w in words[:-1]]))
    at, segment = periodic.segments(codes, codes * 0)
    assert [words[i] for i in at] == ["b", "d"] * 13 and set(segment.tolist()) == {0}


def test_long_and_odd_texts(rows):
    long = " ".join(["x y z"] * 40_000 + [f"w{i}" for i in range(20_000)] + ["q"] * 24)
    docs = rows("doc_id long, text string, runs string, other string", (1, long, "old", "a"), (1, long, "old", "a"), (None, None, None, None), (2, "", "", ""))
    found = periodic.periodic_runs(docs)
    assert found.columns == ["doc_id", "text", "other", "n_words", "runs", "collapsed"]
    got = {(r["doc_id"], r["n_words"], tuple(map(tuple, r["runs"])), r["text"]) for r in found.collect()}
    runs = ((0, 120_000, 3), (140_000, 24, 1))
    assert got == {(1, 140_024, runs, long), (None, 0, (), None), (2, 0, (), "")} and found.count() == 4
    assert found.filter("doc_id = 1").select("collapsed").first()[0] == " ".join(["x y z"] + [f"w{i}" for i in range(20_000)] + ["q"])
    assert periodic.periodic_runs(docs.limit(0)).count() == 0


def test_strongest_run_is_exact(spark):
    runs = [(0, 24, 7), (30, 48, 14), (90, 25, 7), (120, 50, 14)]
    found = spark.createDataFrame([(runs,), ([],)], "runs array<struct<start: long, length: long, period: long>>")
    assert [tuple(r[0]) if r[0] else None for r in found.select(periodic.strongest()).collect()] == [(90, 25, 7), None]


def test_planted_runs_through_the_query(spark):
    got = {r["doc_id"]: r for r in contract.queries()["op13_periodic_runs"](spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    planted = 0
    for row in docs:
        words, crc = words_of(row["text"]), zlib.crc32(str(row["doc_id"]).encode())
        if crc % 10 == 0 and words:
            n, g = len(words), crc // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        planted += bool(runs)
        own = got[row["doc_id"]]
        assert own["n_runs"] == len(runs)
        assert own["runs_sha256"] == h("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert own["collapsed_sha256"] == h(plain_collapsed(words, runs))
    assert planted > 5 and len(got) == len(docs)
