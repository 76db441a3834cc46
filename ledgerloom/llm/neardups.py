"""Near duplicates by probability Jaccard similarity of weighted word shingles (ProbMinHash).

A text's shingles are its runs of five words (lower-cased in ASCII; fewer than five words are one
shingle), weighted by how often they occur. Each shingle is a Poisson process whose rate is its
weight: every arrival falls on a random component of the signature, and a component keeps the shingle
that arrives first. Two texts agree in a component with the probability

    J_P = sum over common shingles d of 1 / sum over all shingles e of max(a_e / a_d, b_e / b_d),

which is the Jaccard similarity where no shingle repeats. A shingle's arrivals are generated only
while they come before the latest first arrival of its text.

Equal texts are one class. Classes that share a band of the signature are candidates, and each
candidate is verified by J_P computed from both texts. In a bucket every class is first compared
with its most popular class only, the one that shares most buckets with others: in a group of copies
that is the text they were copied from, so the group costs a pair or two per class even where the
copies are less like each other. Classes of a bucket that are not connected then are compared with
each other, unless one bit of every component differs too often; for these classes a signature of WIDE
components is made, which tells a similarity of 0.73 from one of 0.8. A pair at the threshold fails that
with odds below 1e-6.
Linked classes and what they link on to form a group; its document of least id is kept.

With 25 bands of 5 components a pair of similarity 0.8 shares a band with odds of 0.99995.

Null texts are empty ones. Texts without words only match equal texts. Rows that repeat id and text
are all in the result. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.frames import set_aside, steps, stored, texts_of, with_computed
from ledgerloom.llm.graph import components
from ledgerloom.llm.words import PLAIN, Words, mixed, split_words

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 25, 5
COMPONENTS = BANDS * ROWS
#: Of COMPONENTS bits, so many may differ: 12.5 are expected at the threshold, with a deviation of 3.4.
MOST_BITS = 30
#: The same for the wider signature of classes that are still apart: 205 expected, deviation 13.6.
WIDE, MOST_WIDE_BITS = 2048, 270

_STEP = np.uint64(0x9E3779B97F4A7C15)


def weighted_shingles(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, hash and weight of every different shingle of a document."""
    at, hashes = words.windows(size)
    doc = words.doc[at]
    for k in range(1, size):  # texts of fewer words
        short, own = words.windows(k)
        whole = words.counts[words.doc[short]] == k
        doc, hashes = np.concatenate([doc, words.doc[short][whole]]), np.concatenate([hashes, own[whole]])
    own = mixed(hashes + doc.astype(np.uint64) * _STEP)
    ordered = np.sort(own)
    repeated = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(repeated):
        return doc, hashes, np.ones(len(doc))
    where = np.minimum(np.searchsorted(repeated, own), len(repeated) - 1)
    many = repeated[where] == own
    _, first, count = np.unique(own[many], return_index=True, return_counts=True)
    at = np.flatnonzero(many)[first]
    return (np.concatenate([doc[~many], doc[at]]), np.concatenate([hashes[~many], hashes[at]]),
            np.concatenate([np.ones(int((~many).sum())), count]))


def signatures(doc: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n: int, m: int = COMPONENTS) -> np.ndarray:
    """(n, m) first shingle per component; rows of documents without shingles are 0."""
    first = np.full(n * m, np.inf)
    found = np.zeros(n * m, np.uint64)
    time, seed, arrival, block = np.zeros(len(doc)), mixed(hashes), 0, 1
    while len(doc):
        # The next arrivals of every process that is still going: the j-th depends on shingle and j only.
        state = mixed(seed[:, None] + np.arange(arrival + 1, arrival + block + 1, dtype=np.uint64) * _STEP)
        uniform = ((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53
        times = time[:, None] + np.cumsum(-np.log(uniform), axis=1) / weights[:, None]
        at = doc[:, None] * m + ((mixed(state) >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(first, at.reshape(-1), times.reshape(-1))
        won = first[at] == times
        found[at[won]] = np.broadcast_to(hashes[:, None], at.shape)[won]
        left, place = np.unique(doc, return_inverse=True)
        latest = first.reshape(n, m)[left].max(axis=1)
        going = times[:, -1] < latest[place]
        doc, hashes, weights, time, seed = (x[going] for x in (doc, hashes, weights, times[:, -1], seed))
        arrival, block = arrival + block, min(2 * block if arrival else 1, 16)
    return found.reshape(n, m)


def _bands_and_bits(texts: pa.Array):
    n = len(texts)
    words = split_words(texts, PLAIN)
    signature = signatures(*weighted_shingles(words), n)
    band = np.zeros((n, BANDS), np.uint64)
    for k in range(ROWS):
        band = mixed(band + signature[:, k::ROWS] + np.arange(BANDS, dtype=np.uint64) * _STEP)
    bits = np.zeros((n, 128), np.uint8)
    bits[:, :COMPONENTS] = mixed(signature.reshape(-1)).reshape(n, -1) & np.uint64(1)
    sketch = np.packbits(bits, axis=1).view(np.int64)
    filled = words.counts > 0
    offsets = np.concatenate([[0], np.cumsum(filled * BANDS)])
    bands = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(band[filled].reshape(-1).view(np.int64)))
    return bands, sketch[:, 0].copy(), sketch[:, 1].copy()


def probability_jaccard(a: np.ndarray, a_weights: np.ndarray, b: np.ndarray, b_weights: np.ndarray) -> float:
    """J_P of two weighted sets, given as sorted different hashes with their weights."""
    both, in_a, in_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    rest_a, rest_b = np.delete(a_weights, in_a), np.delete(b_weights, in_b)
    of_a, of_b = np.concatenate([a_weights[in_a], rest_a, rest_b * 0]), np.concatenate([b_weights[in_b], rest_a * 0, rest_b])
    base = of_b.max() + 1
    kinds, number = np.unique(of_a * base + of_b, return_counts=True)  # equal pairs of weights (whole numbers) count alike
    x, y = np.divmod(kinds, base)
    return float(sum(k / (number * np.maximum(x / p, y / q)).sum() for p, q, k in zip(x, y, number) if p and q))


def _similarities(texts: pa.Array, others: pa.Array):
    """J_P of each pair of texts: counted for all pairs at once, and by weight where a shingle repeats."""
    n = len(texts)
    a, b = (weighted_shingles(split_words(column, PLAIN)) for column in (texts, others))
    keys_a, keys_b = (mixed(hashes + doc.astype(np.uint64) * _STEP) for doc, hashes, _ in (a, b))
    common = np.bincount(a[0][np.isin(keys_a, keys_b)], minlength=n)
    either = np.bincount(a[0], minlength=n) + np.bincount(b[0], minlength=n) - common
    found = common / np.maximum(either, 1)
    uneven = np.unique(np.concatenate([doc[weights > 1] for doc, _, weights in (a, b)]))
    uneven = uneven[found[uneven] > 0]
    if len(uneven):
        ordered = [(np.lexsort((hashes, doc)), doc, hashes, weights) for doc, hashes, weights in (a, b)]
        cuts = [np.searchsorted(doc[order], [uneven, uneven + 1]).T.tolist() for order, doc, _, _ in ordered]
        for i, own in zip(uneven.tolist(), zip(*cuts)):
            found[i] = probability_jaccard(*[x[order[p:q]] for (order, _, *both), (p, q) in zip(ordered, own) for x in both])
    return [pa.array(found)]


def text_digest(text: Column | str) -> Column:
    """128 bits of SHA-256: equal for equal texts only."""
    return F.substring(F.unhex(F.sha2(F.col(text).cast("binary"), 256)), 1, 16)


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Those of the pairs (a, b) of nodes whose texts are similar enough."""
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    scored = with_computed(both, "similarity double", _similarities, "text_a", ("text_b",), ("a", "b"))
    return scored.filter(F.col("similarity") >= similarity).select("a", "b").distinct()


def _sketches(texts: pa.Array):
    """One bit of each of WIDE components, as an array of longs per text."""
    found = []
    for at in range(0, len(texts), 512):  # the components of a few texts at a time
        some = texts.slice(at, 512)
        signature = signatures(*weighted_shingles(split_words(some, PLAIN)), len(some), WIDE)
        bits = (mixed(signature.reshape(-1)) & np.uint64(1)).astype(np.uint8).reshape(len(some), WIDE)
        found.append(np.packbits(bits, axis=1).view(np.int64))
    longs = np.concatenate(found)
    offsets = np.arange(len(longs) + 1, dtype=np.int32) * longs.shape[1]
    return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(longs.reshape(-1)))]


def _alike(x: str = "x", y: str = "y") -> Column:
    differing = F.zip_with(f"{x}.wide", f"{y}.wide", lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    return F.aggregate(differing, F.lit(0), lambda n, k: n + k) <= MOST_WIDE_BITS


def _first_shared(x: str = "x", y: str = "y") -> Column:
    """Whether no earlier band is shared, so that a pair comes up once (a band's hash names its place)."""
    before = F.col(f"{x}.at") - 1
    return ~F.arrays_overlap(F.slice(f"{x}.bands", F.lit(1), before), F.slice(f"{y}.bands", F.lit(1), before))


def _close(x: str = "x", y: str = "y") -> Column:
    return sum(F.bit_count(F.col(f"{x}.{s}").bitwiseXOR(F.col(f"{y}.{s}"))) for s in ("bits_0", "bits_1")) <= MOST_BITS


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, digest, class_id, class_size, group_id, kept, for every row of docs.

    class_id is the least id of the documents with the same text, group_id that of the documents the
    class is linked with; kept marks that document of each group.
    """
    spark = docs.sparkSession
    own = texts_of(docs, doc_id, text).withColumn("digest", text_digest("text"))
    signed = stored(with_computed(own, "bands array<long>, bits_0 long, bits_1 long", _bands_and_bits,
                                  keep=("doc_id", "digest")), "signatures")
    classes = signed.groupBy("digest", "bands", "bits_0", "bits_1").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    rows = classes.select(F.explode("bands").alias("band"), "node")
    sizes = rows.groupBy(F.struct("band").alias("k")).agg(F.count("*").alias("size")).filter("size > 1")
    shared = stored(rows.withColumn("k", F.struct("band")).join(sizes, "k").select("band", "node", "size"), "buckets")
    bits = classes.select("node", "bits_0", "bits_1")
    popular = shared.groupBy(F.struct("node").alias("k")).agg(F.sum("size").alias("met")).select("k.node", "met").join(bits, "node")
    popular = popular.select(F.struct("node").alias("k"), "met", "bits_0", "bits_1")
    # The most popular class of each bucket, ties by the greater node, as one number that orders both.
    order = F.col("met").cast("decimal(17,0)") * F.lit(str(10**19)).cast("decimal(20,0)") + F.col("node").cast("decimal(19,0)")
    met = shared.withColumn("k", F.struct("node")).join(popular, "k").select("band", "node", "bits_0", "bits_1", order.alias("order"))
    centres = met.groupBy(F.struct("band").alias("k")).agg(*[F.max_by(c, "order").alias(c) for c in ("node", "bits_0", "bits_1")])
    stars = met.withColumn("k", F.struct("band")).alias("x").join(centres.alias("y"), "k").filter((F.col("x.node") != F.col("y.node")) & _close())
    pairs = stars.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()

    wanted = shared.select("node").distinct().join(classes, "node").select("node", F.struct(F.col("class_id").alias("doc_id"), "digest").alias("row"))
    texts = stored(own.withColumn("row", F.struct("doc_id", "digest")).join(wanted, "row").select("node", "text").dropDuplicates(["node"]), "texts")
    roots = components(_verified(pairs, texts, similarity))

    # Buckets that hold classes of more than one component: all that is not connected yet is compared.
    rooted = shared.select("band", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed_up = rooted.groupBy(F.struct("band").alias("k")).agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 < r1").select("k")
    unsettled = stored(rooted.withColumn("k", F.struct("band")).join(mixed_up, "k").drop("k"), "unsettled")
    wide = with_computed(texts.join(unsettled.select("node").distinct(), "node", "left_semi"), "wide array<long>", _sketches, keep=("node",))
    signatures_of = classes.select("node", "bits_0", "bits_1", "bands").join(wide, "node")
    open_rows = stored(unsettled.join(signatures_of, "node").withColumn("at", F.array_position("bands", F.col("band")).cast("int")), "open")
    x, y = open_rows.alias("x"), open_rows.alias("y")
    apart = (F.col("x.node") < F.col("y.node")) & (F.col("x.root") != F.col("y.root"))
    across = x.join(y, (F.col("x.band") == F.col("y.band")) & apart & _close() & _alike() & _first_shared())
    rest = across.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    more = stored(_verified(rest, texts, similarity), "links")
    if not more.isEmpty():
        known = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = components(known.unionByName(more))

    first = F.min(F.struct("class_id", "digest"))
    linked = classes.select("node", "digest", "class_id", "class_size").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    groups = linked.groupBy(F.struct("root").alias("k")).agg(first.alias("group"))
    found = linked.withColumn("k", F.struct("root")).join(groups, "k").select(
        F.struct("digest").alias("k"), "class_id", "class_size", F.col("group"))
    members = signed.select("doc_id", "digest", F.struct("digest").alias("k")).join(found, "k")
    return members.select(
        "doc_id", "digest", "class_id", "class_size", F.col("group.class_id").alias("group_id"),
        (F.struct(F.col("doc_id").alias("class_id"), "digest") == F.col("group")).alias("kept"),
    )


def deduplicated(docs: DataFrame, similarity: float = SIMILARITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group, with the columns of docs."""
    found = near_duplicates(docs, similarity, doc_id, text).filter("kept").groupBy("doc_id", "digest").agg(F.count("*").alias("n"))
    kept = stored(found.select(F.struct("doc_id", "digest").alias("near_key"), "n"), "kept")
    own, names, back = set_aside(docs)
    whole = own.withColumn("whole", F.coalesce(F.col(names[text]), F.lit("")))
    keyed = whole.withColumn("near_key", F.struct(F.col(names[doc_id]).alias("doc_id"), text_digest("whole").alias("digest"))).drop("whole")
    left = keyed.join(kept.select("near_key"), "near_key", "left_semi")
    if not kept.filter("n > 1").isEmpty():  # rows that repeat id and text
        left = left.dropDuplicates(["near_key"])
    return back(left)
