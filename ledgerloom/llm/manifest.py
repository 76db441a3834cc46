"""Merkle manifest of a dataset: a digest per row, trees of FANOUT per group, proofs without stored interiors.

H is the lowercase hex SHA-256 of its inputs in a row; digests go in as hex text. A row's leaf is H of its
columns, each `-` if null, else the byte count of its text, `:` and the text. Per group, leaves ascend by
their key; while a group has more than one node, every FANOUT consecutive ones (the last run: fewer, even
one) become their H. What remains is the group's subroot. Subroots, in order of their groups (null first,
then by bytes), form a tree of the same kind, whose last node is the root.

Checkpoint and recompute: of each tree only every STRIDE-th level is written, as aligned subtrees of
FANOUT ** STRIDE consecutive nodes, one row each. Proofs go top down: a subtree's row meets the proof of the node
it leads to, the levels between are computed anew from the stored nodes, the siblings of each node
are sent out, and the levels are forgotten. So no row holds more than one subtree, one
proof and their digests, and a lost task repeats only its own subtrees.

Leaves are numbered by a range sort of digests, never of texts: rows of a partition are counted per group
and the counts are summed up. Rows of equal group, key and leaf are the same to the tree; they are parted by
their place in the stored leaves, so that even a third of all rows can be copies. Null keys come first; rows
of one key ascend by leaf. A repeated row is a leaf of its own. Empty texts count 0 bytes, texts are hashed
whole at any length. An empty table has no leaf, no subroot and no root. Only the columns named are read, so
other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.frames import stored

FANOUT, STRIDE = 8, 3
_SPAN = FANOUT ** STRIDE

#: How a node's proof is kept: hex digests of all siblings from the leaf up, and per level own place and number of siblings.
PROOF = "siblings string, places array<int>, others array<int>"


def leaf(*columns: Column | str) -> Column:
    """H over columns, each with its byte count."""
    parts = []
    for column in columns:
        text = (F.col(column) if isinstance(column, str) else column).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _node(run: Sequence[bytes]) -> bytes:
    return hashlib.sha256("".join(x.hex() for x in run).encode()).digest()


def _levels(nodes: list[bytes], width: int) -> list[list[bytes]]:
    """Levels of an aligned subtree from its stored nodes up; width: nodes of the whole tree at the stored level."""
    levels = [nodes]
    while width > 1 and len(levels) <= STRIDE:
        below = levels[-1]
        levels.append([_node(below[i: i + FANOUT]) for i in range(0, len(below), FANOUT)])
        width = -(-width // FANOUT)
    return levels


def numbered(nodes: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Rows with `pos`, their number from 0 within their `tree` in the given order, and `width`, the tree's number of rows."""
    sort = ["tree", *order, "_file", "_row"]
    dealt = nodes.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    placed = stored(dealt.repartitionByRange(*sort).sortWithinPartitions(*sort).drop("_file", "_row")
                    .withColumn("at", F.monotonically_increasing_id()), name)
    # The id holds the partition above bit 33 and the row's place in it below.
    part = F.shiftright("at", 33)
    counts = placed.groupBy("tree", part.alias("part")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("tree")
    offsets = counts.select("tree", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(whole).alias("width"))
    return placed.withColumn("part", part).join(offsets, ["tree", "part"]).withColumn(
        "pos", F.col("before") + F.col("at") - F.col("first")).drop("part", "first", "before", "at")


def _subtrees(nodes: DataFrame, rest: Sequence[str] = ()) -> DataFrame:
    """One row per aligned subtree: nodes (digest and the columns of `rest`) in order."""
    return nodes.groupBy("tree", "width", F.floor(F.col("pos") / _SPAN).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "digest", *rest))).alias("nodes"))


def _tops(subtrees: DataFrame) -> DataFrame:
    """The node each stored subtree leads to: tree, pos and width at its level, digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                levels = _levels([x["digest"] for x in row["nodes"]], row["width"])
                rows.append((row["tree"], row["block"], max(1, -(-row["width"] // _SPAN)), levels[-1][0]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.binary()))],
                                                 names=["tree", "pos", "width", "digest"])

    lean = subtrees.select("tree", "width", "block", F.transform("nodes", lambda x: F.struct(x["digest"])).alias("nodes"))
    return lean.mapInArrow(run, "tree string, pos long, width long, digest binary")


def _downward(subtrees: DataFrame, above: DataFrame, rest_ddl: str) -> DataFrame:
    """Proof of every stored node: subtree rows joined with the proof of the node they lead to (columns of PROOF, subroot, root)."""
    schema = f"tree string, pos long, digest binary, {PROOF}, subroot binary, root binary" + (f", {rest_ddl}" if rest_ddl else "")
    rest = [c.split()[0] for c in rest_ddl.split(", ")] if rest_ddl else []
    names = ["tree", "pos", "digest", "siblings", "places", "others", "subroot", "root", *rest]
    keys = above.select("tree", F.col("pos").alias("block"), "siblings", "places", "others", "subroot", "root")
    joined = subtrees.join(keys, ["tree", "block"])
    node_type = [joined.schema["nodes"].dataType.elementType[c].dataType for c in rest]

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [pa.string(), pa.int64(), pa.binary(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary(),
                 *map(to_arrow_type, node_type)]
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                nodes = row["nodes"]
                levels = _levels([x["digest"] for x in nodes], row["width"])
                hexed = [[x.hex() for x in level] for level in levels[:-1]]
                out = []
                for i, x in enumerate(nodes):
                    siblings, places, others, j = [], [], [], i
                    for level in hexed:
                        start = j - j % FANOUT
                        siblings += level[start: j] + level[j + 1: start + FANOUT]
                        places.append(j - start)
                        others.append(min(FANOUT, len(level) - start) - 1)
                        j //= FANOUT
                    out.append((row["tree"], x["pos"], x["digest"], "".join(siblings) + row["siblings"], places + row["places"],
                                others + row["others"], row["subroot"], row["root"], *(x[c] for c in rest)))
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), kinds)], names=names)

    return joined.mapInArrow(run, schema)


class Manifest:
    """Stored levels of the trees of a table; `carry` columns ride beside the leaves and are no part of them."""

    def __init__(self, docs: DataFrame, columns: Sequence[str], group: str, key: str, carry: dict[str, Column] | None = None):
        carry = carry or {}
        self.carried, tree = list(carry), F.col(group).cast("string")
        # '-' sorts before '=': null comes first, the rest by bytes.
        leaves = stored(docs.select(
            F.coalesce(F.concat(F.lit("="), tree), F.lit("-")).alias("tree"), F.col(key).alias("key"),
            F.unhex(leaf(*columns)).alias("digest"), *(c.alias(n) for n, c in carry.items())), "leaves")
        placed = numbered(leaves, ["key", "digest"], "ordered_leaves")
        self.rest = ["key", *self.carried]
        self.rest_ddl = ", ".join(f"{c} {leaves.schema[c].dataType.simpleString()}" for c in self.rest)
        self.levels, subroots = self._built(_subtrees(placed, self.rest))
        roots = stored(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), "subroots")
        self.top_levels, self.roots = self._built(_subtrees(numbered(roots, ["name"], "ordered_subroots"), ["name"]))

    @staticmethod
    def _built(bottom: DataFrame) -> tuple[list[DataFrame], DataFrame]:
        """Every STRIDE-th level as stored subtrees, from the bottom; and the last node of each tree."""
        levels, ends = [], []
        while True:
            levels.append(stored(bottom, f"level{STRIDE * len(levels)}"))
            tops = stored(_tops(levels[-1]), "tops")
            ends.append(tops.filter("width = 1").select("tree", "digest"))
            rest = tops.filter("width > 1")
            if rest.isEmpty():
                break
            bottom = _subtrees(rest)
        last = ends[0]
        for more in ends[1:]:
            last = last.unionByName(more)
        return levels, last

    @staticmethod
    def _proved(levels: list[DataFrame], ends: DataFrame, rest_ddl: str) -> DataFrame:
        """Proofs of the nodes of the lowest level; ends: the proof of each tree's last node, with subroot and root."""
        above = ends.withColumn("pos", F.lit(0).cast("long"))
        for k in range(len(levels) - 1, -1, -1):
            # A tree ends at the level where its subtrees are one; the others go on to the level above.
            done, open_ = levels[k].filter(F.col("width") <= _SPAN), levels[k].filter(F.col("width") > _SPAN)
            rest = rest_ddl if k == 0 else ""
            proofs = _downward(done, ends.withColumn("pos", F.lit(0).cast("long")), rest)
            if k < len(levels) - 1:
                proofs = proofs.unionByName(_downward(open_, above, rest))
            above = proofs
        return above

    def proofs(self) -> DataFrame:
        """A row per leaf: group tree, key, digest, pos, carried columns, PROOF, subroot and root (binary)."""
        nothing = (F.lit("").alias("siblings"), F.array().cast("array<int>").alias("places"), F.array().cast("array<int>").alias("others"))
        root = self.roots.select("tree", *nothing, F.lit(None).cast("binary").alias("subroot"), F.col("digest").alias("root"))
        subroots = self._proved(self.top_levels, root, "name string").select(
            F.col("name").alias("tree"), "siblings", "places", "others", F.col("digest").alias("subroot"), "root")
        return self._proved(self.levels, subroots, self.rest_ddl)


def folded(claim: Column | str) -> Column:
    """The root that a claimed leaf (hex) leads to by the proof in the columns of PROOF."""
    claim = F.col(claim) if isinstance(claim, str) else claim
    start = F.struct(claim.alias("digest"), F.lit(0).alias("at"))

    def up(done: Column, level: Column) -> Column:
        before = F.substr("siblings", done["at"] + 1, 64 * level["place"])
        after = F.substr("siblings", done["at"] + 1 + 64 * level["place"], 64 * (level["other"] - level["place"]))
        run = F.concat(before, done["digest"], after)
        return F.struct(F.sha2(run.cast("binary"), 256).alias("digest"), (done["at"] + 64 * level["other"]).cast("int").alias("at"))

    steps = F.arrays_zip(F.col("places").alias("place"), F.col("others").alias("other"))
    return F.aggregate(steps, start, up)["digest"]
