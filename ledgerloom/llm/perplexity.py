"""Quality by perplexity under interpolated modified Kneser-Ney models of words and of characters.

Words are what white space parts, as they stand, and their model has order WORD_ORDER with start symbols
before a text. What it leaves to words it has not seen goes to the model of characters, of order ORDER over
code points, which spells every word: p(word) = a * p(white space before) + b * p(white space and word
spelled). White space after the last word is spelled. Counts are gathered from all trusted documents that
a model may learn from: the highest order counts occurrences, lower orders count the different symbols
seen before. Every order has its own three discounts, estimated from its numbers of n-grams that occur once
to four times; what they take goes to the next lower order, and from the lowest order of characters to all
symbols alike, an unknown one included.

The counts stay sharded: a shard holds a range of hashes, of words and of pairs of words with the triples they
begin, as packed runs of ascending hashes and their counts in one bucketed table. Pairs are counted in COUNT_ROUNDS
ranges of their hashes, one after the other. A triple is counted where its first pair lies, so that the pair's totals as a
context come with it, and its last pair where that one lies; words are summed up from the pairs. Discounts are taken when
a count is looked up. If the model is at most BROADCAST_GRAMS n-grams, it is handed to all tasks. Beyond that, documents
are scored in SCORE_ROUNDS parts, one after the other, so that disk holds the questions of one part only: documents are
dealt into blocks of about BLOCK_CHARS, each block asks every shard of the model for its own n-grams, and is scored with the
answers; a very long text is a block of its own. The n-grams of characters are handed to all tasks as long as they alone
are at most BROADCAST_GRAMS, and are part of the sharded model else.

Perplexity is per code point. A document is kept if it is at most the threshold of its language: the
QUANTILE (exact, equal values included) of the trusted documents of that language that were held out. A language without such documents
takes the quantile over all of them; without any, all documents with text are kept. Null and empty texts
have no perplexity and are not kept; an empty table gives an empty result. Null languages form a group of their own. Repeated rows are scored
alike.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.frames import forget, learning_row, shared_path, steps, stored, with_computed
from ledgerloom.llm.manifest import numbered
from ledgerloom.llm.words import SPACED, Words, code_points, mixed, split_words

ORDER, WORD_ORDER, QUANTILE = 4, 3, 0.995
#: SHARD_CHARS: characters of the corpus for each shard of the model.
BROADCAST_GRAMS, BLOCK_CHARS, SHARD_CHARS = 1 << 20, 1 << 23, 1 << 24
#: Parts that pairs are counted in and documents are scored in, each after the other; fewer if they had under ROUND_CHARS each.
COUNT_ROUNDS, SCORE_ROUNDS, ROUND_CHARS = 8, 10, 1 << 21
#: N-grams in a row of packed ones.
RUN_GRAMS = 1 << 17
SYMBOLS = tuple(f"s{k}" for k in range(1, ORDER + 1))
WORDS = tuple(f"w{k}" for k in range(1, WORD_ORDER + 1))
_DENSE = 1 << 24


def _numbered(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive number of each key, the different keys, and how often each occurs."""
    if size <= _DENSE:
        count = np.bincount(keys, minlength=size)
        found = np.flatnonzero(count)
        number = np.zeros(size, np.int64)
        number[found] = np.arange(len(found))
        return number[keys], found, count[found]
    found, number, count = np.unique(keys, return_inverse=True, return_counts=True)
    return number, found, count


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of the n-gram that ends at each symbol, the n-grams (rows of code points), their counts, and
    the n + 1 offsets of the texts in the first."""
    lengths = pc.utf8_length(pc.fill_null(texts, "")).to_numpy(zero_copy_only=False).astype(np.int64)
    pad = "\0" * (ORDER - 1)
    # Code points from 1 on, 0 for the start, so that a text's own NUL is a symbol like others.
    joined = np.frombuffer((pad + pad.join(x or "" for x in texts.to_pylist())).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) + 1
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    begin = offsets[:-1] + (ORDER - 1) * (1 + np.arange(len(lengths)))
    starts = (begin[:, None] - np.arange(1, ORDER)).reshape(-1)
    joined[starts] = 0
    at = np.arange(offsets[-1]) + np.repeat(begin - offsets[:-1], lengths)
    symbol, alphabet, _ = _numbered(joined, int(joined.max()) + 1 if len(joined) else 1)
    size = len(alphabet)
    number, kinds = symbol[at - ORDER + 1], alphabet[:, None]
    counts = np.zeros(0, np.int64)
    for k in range(ORDER - 2, -1, -1):
        number, found, counts = _numbered(number * size + symbol[at - k], len(kinds) * size)
        kinds = np.concatenate([kinds[found // size], alphabet[found % size, None]], 1)
    return number, kinds, counts, offsets


def gram_hashes(kinds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(kinds), np.uint64)
    for column in kinds.T:
        total = mixed(total + column.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return total.view(np.int64)


def gram_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(s1, ..., sN, c): the n-grams of all texts, added up per task before they are shuffled."""

    def summed(parts):
        kinds, counts = (np.concatenate(x) for x in zip(*parts))
        hashes = gram_hashes(kinds)
        order = np.argsort(hashes)
        at = _starts(hashes[order])
        return kinds[order[at]], np.add.reduceat(counts[order], at)

    def rows(parts):
        kinds, counts = summed(parts)
        return pa.RecordBatch.from_arrays([*(pa.array(c.astype(np.int32)) for c in kinds.T), pa.array(counts)], names=[*SYMBOLS, "c"])

    def count(batches):
        parts, n = [], 0
        for batch in batches:
            for step in steps(batch, "text"):
                _, kinds, counts, _ = grams(step.column(0))
                if len(kinds):
                    parts.append((kinds, counts))
                    n += len(kinds)
                if n >= BROADCAST_GRAMS:
                    parts = [summed(parts)]
                    n = len(parts[0][0])
                if n >= BROADCAST_GRAMS // 2 and len(parts) == 1:
                    yield rows(parts)
                    parts, n = [], 0
        if parts:
            yield rows(parts)

    schema = ", ".join([*(f"{s} int" for s in SYMBOLS), "c long"])
    return docs.select(F.col(text).alias("text")).mapInArrow(count, schema).groupBy(*SYMBOLS).agg(F.sum("c").alias("c"))


def discounts(n: list[int]) -> tuple[float, float, float]:
    """For n-grams seen once, twice, and three times or more, from how many are seen 1, 2, 3 and 4 times.

    Never 0, so that something is left for what was never seen.
    """
    n1, n2, n3, n4 = n
    if not (n1 and n2 and n3):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    raw = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    return tuple(min(max(d, 0.1), k) for k, d in enumerate(raw, 1))


def probabilities(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted (s1, ..., sN) with log2p under the model of the counts (s1, ..., sN, c)."""
    orders, level = {ORDER: counts}, counts
    for k in range(ORDER - 1, 0, -1):
        level = level.groupBy(*SYMBOLS[ORDER - k:]).agg(F.count("*").alias("c"))
        orders[k] = level
    c = F.col("c")
    log2p, found = None, wanted
    for k in range(1, ORDER + 1):
        of_counts = orders[k].agg(F.count("*"), F.sum("c"), *[F.count_if(c == i) for i in (1, 2, 3, 4)]).first()
        d1, d2, d3 = discounts(list(of_counts[2:]))
        taken = F.when(c == 1, d1).when(c == 2, d2).otherwise(d3)
        key, context = SYMBOLS[ORDER - k:], SYMBOLS[ORDER - k:-1]
        seen = orders[k].select(F.struct(*key).alias("key"), F.greatest(c - taken, F.lit(0.0)).alias("rest"))
        found = found.withColumn("key", F.struct(*key)).join(seen, "key", "left")
        if k == 1:
            total, kinds = of_counts[1] or 0, of_counts[0] + 1
            freed = orders[k].agg(F.sum(F.least(taken, c)).alias("x")).first()[0] or 0.0
            lower = F.lit((freed / total if total else 1.0) / kinds)
            p = F.coalesce(F.col("rest") / max(total, 1), F.lit(0.0)) + lower
        else:
            contexts = orders[k].groupBy(F.struct(*context).alias("key")).agg(F.sum("c").alias("total"), F.sum(F.least(taken, c)).alias("freed"))
            found = found.withColumn("key", F.struct(*context)).join(contexts, "key", "left")
            p = F.coalesce(F.col("rest"), F.lit(0.0)) / F.col("total") + F.col("freed") / F.col("total") * F.col("p")
            p = F.coalesce(p, F.col("p"))
        found = found.withColumn("p_here", p).drop("p", "rest", "total", "freed", "key").withColumnRenamed("p_here", "p")
    return found.withColumn("log2p", F.log2("p")).drop("p")


def word_grams(texts: pa.Array) -> tuple[Words, np.ndarray]:
    """The words and the n-gram that ends at each: rows of word hashes, 0 for the start."""
    words = split_words(texts, SPACED)
    own = words.hash.view(np.int64)
    columns = [own]
    for back in range(1, WORD_ORDER):
        prior = np.zeros(len(own), np.int64)
        same = words.doc[back:] == words.doc[:-back]
        prior[back:][same] = own[:-back][same]
        columns.insert(0, prior)
    return words, np.stack(columns, 1)


def _numbers(values: np.ndarray) -> bytes:
    """Rows of whole numbers, column after column and byte by byte, without the bytes that are 0 in all of them: compresses well."""
    values = np.ascontiguousarray(values.T).reshape(-1).view(np.uint64)
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    return bytes([width]) + np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _from_numbers(packed: bytes, columns: int = 1) -> np.ndarray:
    width = packed[0]
    parts = np.frombuffer(packed, np.uint8, offset=1).reshape(width, -1)
    values = np.zeros((parts.shape[1], 8), np.uint8)
    for i, part in enumerate(parts):  # a byte of all numbers at a time: twice as fast as the whole at once
        values[:, i] = part
    return values.view(np.int64).reshape(columns, -1).T


def _packed(keys: np.ndarray) -> bytes:
    """Ascending hashes: the first, and the differences."""
    return keys[:1].tobytes() + (_numbers(np.diff(keys)[:, None]) if len(keys) else b"")


def _unpacked(packed: bytes) -> np.ndarray:
    if not packed:
        return np.zeros(0, np.uint64)
    first = np.frombuffer(packed, np.uint64, 1)
    return np.cumsum(np.concatenate([first, _from_numbers(packed[8:])[:, 0].view(np.uint64)]), dtype=np.uint64)


def _planes(values: np.ndarray) -> bytes:
    """Rows of float32, column after column and byte by byte."""
    return np.ascontiguousarray(values.T).view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(planes: bytes, width: int) -> np.ndarray:
    parts = np.frombuffer(planes, np.uint8).reshape(4, -1).T
    return np.ascontiguousarray(parts).view(np.float32).reshape(width, -1).T


def _coded(values: np.ndarray) -> tuple[bytes, bytes]:
    """The different rows of float32, which are few, and which of them each row is."""
    _, at, codes = np.unique(gram_hashes(values.view(np.uint32)), return_index=True, return_inverse=True)
    return _planes(values[at]), _numbers(codes[:, None])


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where rows that differ from the row before begin."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.flatnonzero(new)


def _shards(hashes: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each hash: shards are ranges of hashes."""
    return ((hashes >> np.uint64(33)) * np.uint64(shards)) >> np.uint64(31)


def _by_shard(shard: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Each shard with the places of its rows, in their order."""
    order = np.argsort(shard.astype(np.uint16) if shard.max(initial=0) < 1 << 16 else shard, kind="stable")  # by radix if short
    cuts = _starts(shard[order])
    return [(int(shard[of[0]]), of) for of in np.split(order, cuts[1:]) if len(of)]


#: Packed n-grams of one part of the model. `own3`, `own2`, `own1`: counts of n-grams of that order; `context3`, `context2`: of
#: contexts of that order, the total and how many n-grams occur once, twice and more often; `letters`: log probabilities.
RUN = ("shard int, part string, goal int, keys binary, counts binary, n long, total long, "
       "seen1 long, seen2 long, seen3 long, seen4 long, final boolean")
_WIDTH = {"own3": 1, "own2": 1, "own1": 1, "context3": 4, "context2": 4, "letters": 1}
_RUN = pa.schema([("shard", pa.int32()), ("part", pa.string()), ("goal", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()),
                  *((c, pa.int64()) for c in ("n", "total", "seen1", "seen2", "seen3", "seen4")), ("final", pa.bool_())])


def _runs(shard: int, part: str, keys: np.ndarray, counts: np.ndarray, goal: int | None = None, final: bool = True) -> list[dict]:
    """Rows of RUN from ascending hashes and their counts (a row each)."""
    rows = []
    for a in range(0, len(keys), RUN_GRAMS):
        own = counts[a: a + RUN_GRAMS]
        seen = {f"seen{i}": int((own[:, 0] == i).sum()) for i in (1, 2, 3, 4)}
        rows.append({"shard": shard, "part": part, "goal": goal, "keys": _packed(keys[a: a + RUN_GRAMS]), "counts": _numbers(own), "n": len(own),
                     "total": 0 if part == "letters" else int(own[:, 0].sum()), **seen, "final": final})
    return rows


def _of_contexts(context: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different contexts, ascending, with their totals and numbers of n-grams seen once, twice and more often."""
    order = np.argsort(context)
    context, counts = context[order], counts[order]
    at = _starts(context)
    values = np.stack([counts, counts == 1, counts == 2, counts >= 3], 1).astype(np.int64)
    return context[at], np.add.reduceat(values, at, axis=0) if len(at) else values


def _distinct_triples(batches, part: int, parts: int):
    """Per about BLOCK_CHARS of text: the different word triples (rows of word hashes) of which a pair is of the part, and their counts."""
    found, size = [], 0

    def summed():
        kinds = np.concatenate(found)
        hashes = gram_hashes(kinds)
        order = np.argsort(hashes)
        at = _starts(hashes[order])
        return kinds[order[at]], np.diff(at, append=len(order))

    for batch in batches:
        for step in steps(batch, "text"):
            kinds = word_grams(step.column(0))[1]
            if parts > 1:
                first, last = (gram_hashes(kinds[:, a: a + 2]).view(np.uint64) % np.uint64(parts) == part for a in (0, 1))
                kinds = kinds[first | last]
            found.append(kinds)
            size += pc.sum(pc.binary_length(step.column(0))).as_py() or 0
            if size >= BLOCK_CHARS:
                yield summed()
                found, size = [], 0
    if found:
        yield summed()


def _pairs_counted(docs: DataFrame, shards: int, part: int, parts: int) -> DataFrame:
    """Rows of RUN from one of the parts of all pairs of words: their triples, their totals as contexts, their own counts, and what
    their words get from them (not final)."""

    def deal(batches):
        for kinds, counts in _distinct_triples(batches, part, parts):
            rows = []
            for first, pair in ((True, kinds[:, :2]), (False, kinds[:, 1:])):
                hashes = gram_hashes(pair).view(np.uint64)
                mine = np.flatnonzero(hashes % np.uint64(parts) == part)
                # By pair, or by the word in the middle: what the triples share is then next to each other.
                mine = mine[np.argsort(hashes[mine] if first else kinds[mine, 1].view(np.uint64))]
                for shard, of in _by_shard(_shards(hashes[mine], shards)):
                    of = mine[of]
                    if first:
                        rows.append((shard, True, _packed(hashes[of]), _numbers(gram_hashes(kinds[of])[:, None]), _numbers(counts[of][:, None])))
                    else:
                        rows.append((shard, False, _packed(kinds[of, 1].view(np.uint64)), _numbers(kinds[of][:, :1]), _numbers(kinds[of][:, 2:])))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.bool_(), *[pa.binary()] * 3))],
                                                 names=["shard", "first", "keys", "one", "two"])

    def merge(of: pa.Table) -> pa.Table:
        shard, first = of["shard"][0].as_py(), of["first"].to_numpy()
        columns = [of[c] for c in ("keys", "one", "two")]

        def gathered(which):
            rows = [[c[i].as_py() for c in columns] for i in np.flatnonzero(which)]
            return (np.concatenate([*(_unpacked(k) for k, _, _ in rows), np.zeros(0, np.uint64)]),
                    *(np.concatenate([*(_from_numbers(r[c])[:, 0] for r in rows), np.zeros(0, np.int64)]) for c in (1, 2)))

        pair, triple, counts = gathered(first)
        order = np.argsort(triple := triple.view(np.uint64))
        at = _starts(triple[order])
        counts = np.add.reduceat(counts[order], at) if len(at) else counts
        rows = _runs(shard, "own3", triple[order[at]], counts[:, None])
        rows += _runs(shard, "context3", *_of_contexts(pair[order[at]], counts))
        middle, before, after = gathered(~first)
        kinds = np.stack([before, middle.view(np.int64), after], 1)
        triple = gram_hashes(kinds)
        order = np.argsort(triple)
        kinds = kinds[order[_starts(triple[order])]]
        pair = gram_hashes(kinds[:, 1:]).view(np.uint64)
        order = np.argsort(pair)
        at = _starts(pair[order])
        counts, kinds = np.diff(at, append=len(order)), kinds[order[at]]
        rows += _runs(shard, "own2", pair[order[at]], counts[:, None])
        for name, (word, values) in (("context2", _of_contexts(gram_hashes(kinds[:, 1:2]).view(np.uint64), counts)),
                                     ("own1", _of_contexts(gram_hashes(kinds[:, 2:]).view(np.uint64), np.ones(len(kinds), np.int64)))):
            for goal, of in _by_shard(_shards(word, shards)):
                rows += _runs(shard, name, word[of], values[of, :_WIDTH[name]], goal, False)
        return pa.Table.from_pylist(rows, _RUN)

    return docs.select("text").mapInArrow(deal, "shard int, first boolean, keys binary, one binary, two binary").groupBy("shard").applyInArrow(merge, RUN)


def _words_summed(partial: DataFrame) -> DataFrame:
    """Final rows of RUN from what words get from the pairs of every shard."""

    def merge(of: pa.Table) -> pa.Table:
        rows, shard, names = [], of["goal"][0].as_py(), of["part"].to_pylist()
        for name in sorted(set(names)):
            at = [i for i, x in enumerate(names) if x == name]
            keys = np.concatenate([_unpacked(of["keys"][i].as_py()) for i in at])
            counts = np.concatenate([_from_numbers(of["counts"][i].as_py(), _WIDTH[name]) for i in at])
            order = np.argsort(keys)
            first = _starts(keys[order])
            rows += _runs(shard, name, keys[order[first]], np.add.reduceat(counts[order], first, axis=0))
        return pa.Table.from_pylist(rows, _RUN)

    return partial.groupBy("goal").applyInArrow(merge, RUN)


class GramRuns:
    """The bucketed table of packed n-grams: a task that holds a shard's questions reads its runs where they lie."""

    def __init__(self, spark):
        self.spark, self.name = spark, f"gram_runs_{uuid.uuid4().hex}"
        self.path = shared_path(spark, self.name)
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # Parts of a table are read as one scan, never as a union of bucketed ones (see linestore).
        spark.conf.set("spark.sql.unionOutputPartitioning", "false")

    def add(self, rows: DataFrame) -> None:
        rows.write.mode("append").partitionBy("final").bucketBy(self.buckets, "shard").option("path", self.path).option(
            "compression", "zstd").saveAsTable(self.name, format="parquet")

    def rows(self, final: bool = True) -> DataFrame:
        return self.spark.table(self.name).filter(F.col("final") == final)

    def drop(self) -> None:
        """Forget the runs and free their disk."""
        self.spark.sql(f"DROP TABLE {self.name}")
        forget(self.spark, self.path)

    def forget_partial(self) -> None:
        forget(self.spark, f"{self.path}/final=false")
        self.spark.catalog.refreshTable(self.name)


def word_counts(docs: DataFrame, shards: int = 1, parts: int = 1) -> GramRuns:
    """The n-grams of words of all texts, counted and packed."""
    runs = GramRuns(docs.sparkSession)
    for part in range(parts):
        runs.add(_pairs_counted(docs, shards, part, parts))
    runs.add(_words_summed(runs.rows(final=False)))
    runs.forget_partial()
    return runs


MODEL = "gram long, rest float, total float, freed float"


def _hashed(rows: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Rows of MODEL from rows with the symbols of n-grams."""

    def hashes(batches):
        for batch in batches:
            kinds = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(len(key))], 1)
            yield pa.RecordBatch.from_arrays([pa.array(gram_hashes(kinds)), *batch.columns[len(key):]], names=["gram", "rest", "total", "freed"])

    values = [(F.col(c) if c in rows.columns else F.lit(0.0)).cast("float").alias(c) for c in ("rest", "total", "freed")]
    return rows.select(*key, *values).mapInArrow(hashes, MODEL)


def _model_values(part: str, counts: np.ndarray, taken: dict[int, tuple[float, float, float]]) -> np.ndarray:
    """rest, total and freed of n-grams of a part, from rows of their counts."""
    values = np.zeros((len(counts), 3), np.float32)
    if part == "letters":
        values[:, 0] = np.ascontiguousarray(counts[:, 0]).view(np.float64)
    elif part.startswith("own"):
        own = counts[:, 0]
        values[:, 0] = own - np.array(taken[int(part[-1])])[np.minimum(own, 3) - 1]
    else:
        values[:, 1], values[:, 2] = counts[:, 0], counts[:, 1:] @ np.array(taken[int(part[-1])])
    return values


def word_model(counts: GramRuns) -> tuple[DataFrame, int, float, float, dict[int, tuple[float, float, float]]]:
    """Rows of MODEL of the counts, at least how many they are, the total of the lowest order, the share it leaves to spelling,
    and the discounts of every order."""
    seen = {r["part"]: r for r in counts.rows().groupBy("part").agg(
        *[F.sum(c).alias(c) for c in ("n", "total", "seen1", "seen2", "seen3", "seen4")]).collect()}
    own = {k: seen.get(f"own{k}") for k in range(1, WORD_ORDER + 1)}
    taken = {k: discounts([r[f"seen{i}"] for i in (1, 2, 3, 4)] if r else [0] * 4) for k, r in own.items()}
    lowest = own[1]
    spelled = 1.0
    if lowest:
        ones, twos = lowest["seen1"], lowest["seen2"]
        spelled = float(np.dot(taken[1], (ones, twos, lowest["n"] - ones - twos))) / lowest["total"]

    def unpack(batches):
        for batch in batches:
            for part, keys, values in zip(*(batch.column(i).to_pylist() for i in range(3))):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_unpacked(keys).view(np.int64)), *(pa.array(v) for v in _model_values(part, _from_numbers(values, _WIDTH[part]), taken).T.copy())],
                    names=["gram", "rest", "total", "freed"])

    rows = counts.rows().select("part", "keys", "counts").mapInArrow(unpack, MODEL)
    summed = rows.groupBy("gram").agg(*[F.sum(v).cast("float").alias(v) for v in ("rest", "total", "freed")])
    return summed, sum(r["n"] for r in own.values() if r), float(lowest["total"] if lowest else 1), spelled, taken


def _letter_runs(letters: DataFrame, shards: int) -> DataFrame:
    """Rows of RUN of the log probabilities of characters."""
    top = F.shiftrightunsigned("gram", 33) * F.lit(shards).cast("long")

    def pack(of: pa.Table) -> pa.Table:
        hashes = of["gram"].to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        values = of["rest"].to_numpy().astype(np.float64).view(np.int64)
        return pa.Table.from_pylist(_runs(of["shard"][0].as_py(), "letters", hashes[order], values[order, None]), _RUN)

    return letters.select("gram", "rest", F.shiftright(top, 31).cast("int").alias("shard")).groupBy("shard").applyInArrow(pack, RUN)


def asked_grams(kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams that scoring words (rows of word hashes) looks up, and the hashes that tell their shards: those of the
    first two words."""
    keys, routes = [], []
    for columns in (kinds, kinds[:, 1:], kinds[:, :-1], kinds[:, 2:], kinds[:, 1:2]):
        hashes = gram_hashes(columns).view(np.uint64)
        order = np.argsort(hashes)
        order = order[_starts(hashes[order])]
        keys.append(hashes[order])
        routes.append(gram_hashes(columns[order, :2]).view(np.uint64) if columns.shape[1] > 2 else keys[-1])
    return np.concatenate(keys), np.concatenate(routes)


class GramTable:
    """The model by the hash of the n-gram. Those of characters have their log probability for a rest; they may have a table of their own."""

    def __init__(self, hashes: np.ndarray, values: np.ndarray, word_total: float, spelled: float, letters: GramTable | None = None):
        self.hashes = hashes.view(np.uint64)
        order = np.argsort(self.hashes)
        self.hashes, self.values = self.hashes[order], values[order].astype(np.float32)
        self.word_total, self.spelled, self.letters = word_total, spelled, letters or self

    def _values(self, kinds: np.ndarray) -> np.ndarray:
        """rest, total and freed of each n-gram, 0 for those that are not there."""
        asked = gram_hashes(kinds).view(np.uint64)
        found = np.zeros((len(kinds), 3), np.float32)
        if len(self.hashes):
            # Looked up in ascending order, which reads the table from end to end instead of all over.
            order = np.argsort(asked)
            asked = asked[order]
            at = np.minimum(np.searchsorted(self.hashes, asked), len(self.hashes) - 1)
            there = np.flatnonzero(self.hashes[at] == asked)
            found[order[there]] = self.values[at[there]]
        return found.astype(np.float64)

    def _seen(self, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of each word after those before it, and the share left to its spelling."""
        seen, left = np.zeros(len(kinds)), np.ones(len(kinds))
        for k in range(WORD_ORDER, 1, -1):
            own, context = self._values(kinds[:, WORD_ORDER - k:]), self._values(kinds[:, WORD_ORDER - k:-1])
            known = context[:, 1] > 0
            total = np.where(known, context[:, 1], 1.0)
            seen += left * np.where(known, own[:, 0] / total, 0.0)
            left *= np.where(known, context[:, 2] / total, 1.0)
        return seen + left * self._values(kinds[:, -1:])[:, 0] / self.word_total, left * self.spelled

    def perplexities(self, texts: pa.Array):
        number, kinds, _, offsets = grams(texts)
        n = np.diff(offsets)
        if not len(number):
            return [pa.array(n), pa.nulls(len(texts), pa.float64())]
        spelled = np.concatenate([[0.0], np.cumsum(self.letters._values(kinds)[number, 0])])  # log2 of all before a code point
        words, kinds = word_grams(texts)
        points = code_points(words.data)
        start, end = points[words.start], points[words.end]
        begin = np.concatenate([[0], end])[:-1]  # after the word before
        first = np.flatnonzero(np.diff(words.doc, prepend=-1))
        begin[first] = offsets[words.doc[first]]
        seen, left = self._seen(kinds)
        with np.errstate(divide="ignore"):
            log2p = np.logaddexp2(np.log2(seen) + spelled[start] - spelled[begin], np.log2(left) + spelled[end] - spelled[begin])
        after = offsets[:-1].copy()
        np.maximum.at(after, words.doc, end)
        sums = np.bincount(words.doc, weights=log2p, minlength=len(n)) + spelled[offsets[1:]] - spelled[after]
        return [pa.array(n), pa.array(np.exp2(-sums / np.maximum(n, 1)), mask=n == 0)]


SCORED = "n_symbols long, perplexity double"


def _in_blocks(docs: DataFrame, block_chars: int, path: str) -> DataFrame:
    """docs with the block of each row: rows that a task reads in turn, so no key can swell a block."""

    def deal(batches):
        block, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for step in steps(batch, "text"):
                yield pa.RecordBatch.from_arrays([*step.columns, pa.array(np.full(step.num_rows, block))], names=[*step.schema.names, "block"])
                size += pc.sum(pc.binary_length(step.column("text"))).as_py() or 0
                if size >= block_chars:
                    block, size = block + 1, 0

    return stored(docs.mapInArrow(deal, docs.withColumn("block", F.lit(0).cast("long")).schema), "blocks", path, compression="zstd")


def _asked(dealt: DataFrame, shards: int, letters: bool) -> DataFrame:
    """The hashes every block asks of every shard; letters: those of characters too."""

    def rows(block: int, words: list[np.ndarray], spelled: list[np.ndarray]) -> pa.RecordBatch:
        keys, routes = asked_grams(np.concatenate(words))
        keys, routes = np.concatenate([keys, *spelled]), np.concatenate([routes, *spelled])
        order = np.argsort(keys)
        order = order[_starts(keys[order])]
        keys = keys[order]
        own = _by_shard(_shards(routes[order], shards))
        return pa.RecordBatch.from_arrays([
            pa.array([shard for shard, _ in own], pa.int32()), pa.array([block] * len(own), pa.int64()),
            pa.array([_packed(keys[of]) for _, of in own], pa.binary())], names=["shard", "block", "keys"])

    def ask(batches):
        block, words, spelled = None, [], []
        for batch in batches:
            for step in steps(batch, "text"):
                of = step.column(1).to_numpy()
                for a, b in zip(cuts := [0, *(np.flatnonzero(np.diff(of)) + 1).tolist()], [*cuts[1:], len(of)]):
                    if block != of[a] and words:
                        yield rows(block, words, spelled)
                        words, spelled = [], []
                    block = int(of[a])
                    texts = step.column(0).slice(a, b - a)
                    words.append(word_grams(texts)[1])
                    if letters:
                        spelled.append(gram_hashes(grams(texts)[1]).view(np.uint64))
        if words:
            yield rows(block, words, spelled)

    return dealt.select("text", "block").mapInArrow(ask, "shard int, block long, keys binary")


def _scored_by_blocks(docs: DataFrame, runs: GramRuns, shards: int, rounds: int, word_total: float, spelled: float,
                      taken: dict[int, tuple[float, float, float]], letters: GramTable | None) -> DataFrame:
    """Documents part after part, block by block, each block with the part of the model that it asked for."""
    answer = pa.schema([("block", pa.int64()), ("keys", pa.binary()), ("kinds", pa.binary()), ("codes", pa.binary())])

    def find(asked: pa.Table, model: pa.Table) -> pa.Table:
        out, questions = [], [_unpacked(k.as_py()) for k in asked["keys"]]
        found = [np.zeros((len(k), 3), np.float32) for k in questions]
        there = [np.zeros(len(k), bool) for k in questions]
        for part, keys, counts in zip(model["part"].to_pylist(), model["keys"], model["counts"]):
            own, counts = _unpacked(keys.as_py()), _from_numbers(counts.as_py(), _WIDTH[part])
            for k, into, met in zip(questions, found, there):
                a, b = np.searchsorted(k, own[0]), np.searchsorted(k, own[-1], "right")
                at = np.searchsorted(own, k[a:b])
                same = np.flatnonzero(own[at] == k[a:b])
                into[a + same] += _model_values(part, counts[at[same]], taken)
                met[a + same] = True
        for block, k, values, met in zip(asked["block"].to_pylist(), questions, found, there):
            kinds, codes = _coded(values[met])
            out.append({"block": block, "keys": _packed(k[met]), "kinds": kinds, "codes": codes})
        return pa.Table.from_pylist(out, answer)

    names = [c for c in docs.columns if c != "text"]

    def score(rows: pa.Table, found: pa.Table) -> pa.Table:
        keys = [_unpacked(k) for k in found["keys"].to_pylist()]
        values = [_from_planes(x.as_py(), 3)[_from_numbers(c.as_py())[:, 0]] for x, c in zip(found["kinds"], found["codes"])]
        own = GramTable(np.concatenate([*keys, np.zeros(0, np.uint64)]), np.concatenate([*values, np.zeros((0, 3), np.float32)]), word_total, spelled, letters)
        out = [pa.RecordBatch.from_arrays([*(step.column(c) for c in names), *own.perplexities(step.column("text"))], names=[*names, "n_symbols", "perplexity"])
               for batch in rows.to_batches() for step in steps(batch, "text")]
        return pa.Table.from_batches(out)

    shown = ", ".join(f"`{c}` {t}" for c, t in docs.select(names).dtypes)
    spark, path = docs.sparkSession, shared_path(docs.sparkSession, "scored")
    for part in range(rounds):
        mine = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds)) == part)
        dealt = _in_blocks(mine, BLOCK_CHARS, own := shared_path(spark, "blocks"))
        model = runs.rows().select("shard", "part", "keys", "counts")
        answers = _asked(dealt, shards, letters is None).groupBy("shard").cogroup(model.groupBy("shard")).applyInArrow(find, "block long, keys binary, kinds binary, codes binary")
        scored_part = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, f"{shown}, {SCORED}")
        scored_part.write.mode("append").parquet(path)
        forget(spark, own)
    return spark.read.schema(f"{shown}, {SCORED}").parquet(path)


def _quantiles(values: DataFrame, quantile: float) -> DataFrame:
    """tree and own: the least perplexity of each tree that at least the share `quantile` of its values does not exceed.

    Exact: the values are ranked by a range sort, and the one of the rank is taken.
    """
    ranked = numbered(stored(values, "calibrating"), ["perplexity"], "ranked")
    rank = F.greatest(F.ceil(F.lit(quantile) * F.col("width")) - 1, F.lit(0))
    return ranked.filter(F.col("pos") == rank).select("tree", F.col("perplexity").alias("own"))


def scored(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
           quantile: float = QUANTILE, learn_from: Column | None = None, broadcast_grams: int = BROADCAST_GRAMS) -> DataFrame:
    """doc_id, lang, n_symbols, perplexity, threshold and kept for every row of docs."""
    learn_from = learning_row() if learn_from is None else learn_from
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    trusted = labels.filter(F.col(label) == 1).select(F.col(doc_id).alias("doc_id"))
    # Hashed ids of trusted documents, so texts are dealt out by id but never sorted, at any size.
    learned = stored(plain.join(trusted.filter(learn_from).hint("shuffle_hash"), "doc_id", "left_semi"), "learned",
                     learned_path := shared_path(docs.sparkSession, "learned"), compression="zstd")
    counts = stored(gram_counts(learned), "counts")
    wanted = stored(gram_counts(plain).drop("c"), "wanted")  # each order of the model joins them: gathered once
    letters = stored(_hashed(probabilities(counts, wanted).withColumnRenamed("log2p", "rest"), SYMBOLS), "probabilities")
    chars = plain.agg(F.sum(F.char_length("text"))).first()[0] or 0
    shards, parts = max(1, -(-chars // SHARD_CHARS)), max(1, chars // ROUND_CHARS)
    runs = word_counts(learned, shards, min(COUNT_ROUNDS, parts))
    forget(docs.sparkSession, learned_path)
    words, n_words, word_total, spelled, taken = word_model(runs)
    n_letters = letters.count()

    def table(model: DataFrame) -> GramTable:
        rows: pd.DataFrame = model.toPandas()  # contexts are n-grams too, but for those of the start: about broadcast_grams rows at most
        return GramTable(rows["gram"].to_numpy(), rows[["rest", "total", "freed"]].to_numpy(), word_total, spelled)

    if n_letters + n_words <= broadcast_grams:
        found = stored(with_computed(plain, SCORED, table(letters.unionByName(words)).perplexities, keep=("doc_id", "lang")), "perplexity")
    else:
        if n_letters > broadcast_grams:
            runs.add(_letter_runs(letters, shards))
        found = _scored_by_blocks(plain, runs, shards, min(SCORE_ROUNDS, parts), word_total, spelled, taken,
                                  table(letters) if n_letters <= broadcast_grams else None)
    runs.drop()
    calibrating = found.join(trusted.filter(~learn_from), "doc_id", "left_semi").filter("perplexity IS NOT NULL")
    of_lang = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("-"))
    limits = _quantiles(calibrating.select(of_lang.alias("tree"), "perplexity"), quantile).withColumnRenamed("tree", "k")
    general = _quantiles(calibrating.select(F.lit("").alias("tree"), "perplexity"), quantile).first()
    threshold = F.coalesce("own", F.lit(general["own"] if general else None).cast("double"))
    joined = found.withColumn("k", of_lang).join(limits, "k", "left").withColumn("threshold", threshold)
    kept = F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    return joined.select("doc_id", "lang", "n_symbols", "perplexity", "threshold", kept.alias("kept"))
