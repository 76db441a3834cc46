"""Passages of benchmark items in documents: windows of words looked up in a broadcast hash set.

Texts are lower-cased in ASCII; words are runs of digits, ASCII letters and non-ASCII characters. A
window is WINDOW consecutive words of an item; an item of fewer words is one window. Every window of
every document is looked up by hash; hits are verified word by word, so the result is exact.

The set is broadcast in blocks of about BLOCK_WINDOWS different windows, without their items. A benchmark of more
windows is scanned block after block over all documents; hits of a later block are merged into those before.
Which items a window stands in is joined afterwards, to each different set of windows that was hit: a window that
all items share is one row of a block like any other.

Null or empty texts have no words, neither hit nor contaminated; items without words have no window.
Items that repeat an id count once, items without id mark words but are not listed. Rows stay as
they are, `words_hit` and the other new columns replace columns of these names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.frames import set_aside, steps, stored, with_computed
from ledgerloom.llm.words import PLAIN, code_points, joined_words, split_words, text_bytes

WINDOW, BLOCK_WINDOWS = 13, 1 << 18

ITEM_WINDOWS = "item_id long, size int, hash long, words binary"
#: Runs of hit words: [first, end) as word numbers and as code points of the text.
RUN = "struct<first: long, end: long, begin_char: long, end_char: long>"
HITS = f"n_words long, words_hit array<{RUN}>, windows array<long>"


def item_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Every different window of every item: item_id, size in words, hash, words parted by blanks."""

    def windows(batches):
        for batch in batches:
            for step in steps(batch, "text"):
                words = split_words(step.column(1), PLAIN)
                if not len(words.hash):
                    continue
                joined, begin, end = joined_words(words)
                ids, rows = step.column(0).to_pylist(), []
                for size in np.unique(np.minimum(words.counts, window)).tolist():
                    if size:
                        at, hashes = words.windows(size)
                        fits = np.minimum(words.counts, window)[words.doc[at]] == size
                        rows += [(ids[words.doc[i]], size, h, joined[begin[i]: end[i + size - 1]])
                                 for i, h in zip(at[fits].tolist(), hashes[fits].view(np.int64).tolist())]
                if rows:
                    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)],
                                                     names=["item_id", "size", "hash", "words"])

    return benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text")).mapInArrow(
        windows, ITEM_WINDOWS).distinct()


class WindowSet:
    """Windows of a block by size: sorted hashes, a bit table before them, words and numbers behind them."""

    _BITS = 22

    def __init__(self, rows: list):
        by_size: dict = defaultdict(lambda: defaultdict(dict))
        for row in rows:
            by_size[row["size"]][row["hash"]][bytes(row["words"])] = row["window"]
        self.sizes = {}
        for size, by_hash in by_size.items():
            hashes = np.sort(np.array(list(by_hash), np.int64).view(np.uint64))
            seen = np.zeros(1 << self._BITS, bool)
            seen[(hashes >> np.uint64(64 - self._BITS)).astype(np.int64)] = True
            self.sizes[size] = hashes, seen, [by_hash[h] for h in hashes.view(np.int64).tolist()]

    def occurrences(self, words) -> list[tuple[int, int, int]]:
        """First word, size and number of every verified window."""
        found, joined = [], None
        for size, (hashes, seen, texts) in self.sizes.items():
            at, own = words.windows(size)
            likely = seen[(own >> np.uint64(64 - self._BITS)).astype(np.int64)]
            at, own = at[likely], own[likely]
            where = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
            same = hashes[where] == own
            if same.any() and joined is None:
                joined = joined_words(words)
            for i, k in zip(at[same].tolist(), where[same].tolist()):
                text, begin, end = joined
                window = texts[k].get(text[begin[i]: end[i + size - 1]])
                if window is not None:
                    found.append((i, size, window))
        return found


def _hits(texts: pa.Array, block: WindowSet, before: pa.Array | None, windows_before: pa.Array | None):
    words = split_words(texts, PLAIN)
    n, first = len(texts), words.first
    change = np.zeros(len(words.hash) + 1, np.int64)
    windows: list[set] = [set(x) for x in windows_before.to_pylist()] if windows_before is not None else [set() for _ in range(n)]
    if before is not None:
        for i, runs in enumerate(before.to_pylist()):
            for run in runs:
                change[first[i] + run["first"]] += 1
                change[first[i] + run["end"]] -= 1
    for i, size, window in block.occurrences(words):
        change[i] += 1
        change[i + size] -= 1
        windows[words.doc[i]].add(window)
    hit = np.cumsum(change[:-1]) > 0
    runs: list[list] = [[] for _ in range(n)]
    if hit.any():
        chars = code_points(text_bytes(texts)[0])
        base = chars[text_bytes(texts)[1]]
        begins, ends = hit.copy(), hit.copy()
        same = words.doc[1:] == words.doc[:-1]
        begins[1:] &= ~(hit[:-1] & same)
        ends[:-1] &= ~(hit[1:] & same)
        for a, b in zip(np.flatnonzero(begins).tolist(), np.flatnonzero(ends).tolist()):
            d = words.doc[a]
            runs[d].append({"first": a - first[d], "end": b + 1 - first[d],
                            "begin_char": chars[words.start[a]] - base[d], "end_char": chars[words.end[b]] - base[d]})
    kind = pa.list_(pa.struct([(k, pa.int64()) for k in ("first", "end", "begin_char", "end_char")]))
    return words.counts, pa.array(runs, kind), pa.array([sorted(x) for x in windows], pa.list_(pa.int64()))


def _scanned(docs: DataFrame, windows: DataFrame, text: str, block_windows: int, keep: Sequence[str] | None) -> DataFrame:
    """docs (or its columns in keep) with the columns of HITS; windows: different ones, numbered."""
    docs = docs if keep is None else docs.select(*dict.fromkeys([*keep, text]))
    blocks = max(1, -(-windows.count() // block_windows))
    for k in range(blocks):
        # Different windows dealt by hash: a block holds about block_windows rows, whatever the benchmark holds.
        block = WindowSet(windows.filter(F.pmod(F.xxhash64("size", "hash"), F.lit(blocks)) == k).collect())
        if k == 0:
            docs = with_computed(docs, HITS, lambda texts, b=block: _hits(texts, b, None, None), text,
                                 keep=keep if blocks == 1 else None)
        else:
            earlier = stored(docs, "hits")
            names = {c: f"{c}_before" for c in ("words_hit", "windows")}
            docs = with_computed(
                earlier.withColumnsRenamed(names), HITS, lambda texts, runs, hit, b=block: _hits(texts, b, runs, hit),
                text, tuple(names.values()),
            ).drop(*names.values())
    return docs if keep is None else docs.select(*keep, "n_words", "words_hit", "windows")


def _numbered_windows(benchmark: DataFrame, item_id: str, item_text: str) -> tuple[DataFrame, DataFrame]:
    """The different windows with a number each, and item_id and number of each window of each item."""
    every = stored(item_windows(benchmark, item_id, item_text), "windows")
    key = ["size", "hash", "words"]
    windows = stored(every.select(*key).distinct().withColumn("window", F.monotonically_increasing_id()), "different_windows")
    return windows, every.filter("item_id IS NOT NULL").join(windows, key).select("window", "item_id")


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
         item_text: str = "text", block_windows: int = BLOCK_WINDOWS, keep: Sequence[str] | None = None) -> DataFrame:
    """docs (or its columns in keep) with n_words, words_hit and items."""
    windows, window_items = _numbered_windows(benchmark, item_id, item_text)
    docs = docs.drop("items")
    found = stored(_scanned(docs, windows, text, block_windows, keep), "hits")
    hit = found.filter(F.size("windows") > 0)
    # Items follow from the set of windows: each different set is looked up once.
    sets = hit.select("windows").distinct()
    listed = sets.withColumn("window", F.explode("windows")).join(window_items, "window").groupBy(F.struct("windows").alias("of")).agg(
        F.array_sort(F.collect_set("item_id")).alias("items")).select("of.windows", "items")
    none = F.array().cast("array<long>")
    named = hit.join(listed, "windows", "left").withColumn("items", F.coalesce("items", none))
    rest = found.filter(F.size("windows") == 0).withColumn("items", none)
    return named.unionByName(rest).select(*(c for c in found.columns if c != "windows"), "items")


def n_hit() -> Column:
    return F.aggregate("words_hit", F.lit(0).cast("long"), lambda n, run: n + run["end"] - run["first"])


def contaminated(share: int = 20) -> Column:
    """Whether at least one word in `share` is hit."""
    return (n_hit() > 0) & (share * n_hit() >= F.col("n_words"))


def _hit_words(docs: DataFrame, benchmark: DataFrame, text: str, item_id: str = "item_id", item_text: str = "text",
               block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """docs with n_words and words_hit: no items, so nothing is written or shuffled."""
    windows, _ = _numbered_windows(benchmark, item_id, item_text)
    return _scanned(docs, windows, text, block_windows, None).drop("windows")


def without_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", **names) -> DataFrame:
    """docs without the contaminated ones, with their own columns."""
    own, renamed, back = set_aside(docs)
    return back(_hit_words(own, benchmark, renamed[text], **names).filter(~contaminated()))


def without_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **names) -> DataFrame:
    """docs with the characters from the first to the last word of every hit run cut out."""
    own, renamed, back = set_aside(docs)
    found = _hit_words(own, benchmark, renamed[text], **names)
    column = F.coalesce(F.col(renamed[text]), F.lit(""))
    cuts = F.concat(F.array(F.lit(0).cast("long")), F.flatten(F.transform("words_hit", lambda r: F.array(r["begin_char"], r["end_char"]))),
                    F.array(F.char_length(column).cast("long")))
    kept = F.array_join(F.transform(
        F.sequence(F.lit(0), F.size("words_hit")),
        lambda k: F.substring(column, (cuts[2 * k] + 1).cast("int"), (cuts[2 * k + 1] - cuts[2 * k]).cast("int")),
    ), "")
    return back(found.withColumn(renamed[text], F.when(F.size("words_hit") > 0, kept).otherwise(F.col(renamed[text]))))
