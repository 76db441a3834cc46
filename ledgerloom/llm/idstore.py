"""Token ids of documents in one row of blocks, with Elias-Fano coded document borders and ids.

A store is a Parquet folder, one row per block: the block's token ids one after another in 2 or 4
little-endian bytes each, and two Elias-Fano sequences: the borders of its documents, and their ids as distances
from the first. Of each number the low bits are packed side by side, the high bits are set bits in a unary
vector, and a count of the set bits before every 64 bytes lets `select` go straight to a number. That takes about
2 + log2(ids per document) bits a document and no table of 64-bit numbers.

Blocks hold whole documents, in ascending order of document id. A document longer than a block has
one of its own. Blocks know their start within their range of ids; the starts of the ranges, one row
for each partition that wrote, are summed when the store is read. Borders and ids are read by select: of whole
blocks (`read_ids`) or of given documents only (`read_documents`).

Null text: no token ids but the end id. Null document ids come first. Rows of one document id, null included, stay as they
are, ordered by a hash of their text, then by text: ranges cut through them, so that an id which a third of all rows
share is sorted by many tasks. An empty table gives a store without blocks, which reads as no documents. Other
columns are not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.frames import steps, texts_of
from ledgerloom.llm.tokens import encoder

BLOCK_IDS, BLOCK_DOCS = 1 << 20, 1 << 16
_RANK_BYTES = 64

_SEQUENCE = ("low_bits", "low", "high", "ranks")
STORE = ("part int, local_start long, n_docs int, n_ids long, width int, n_null int, first_id long, ids binary, "
         + ", ".join(f"{of}_low_bits int, {of}_low binary, {of}_high binary, {of}_ranks binary" for of in ("border", "doc")))


@dataclass
class EliasFano:
    """A non-decreasing sequence of n numbers from 0; select(i) returns the numbers at the places i."""

    n: int
    low_bits: int
    low: np.ndarray
    high: np.ndarray
    ranks: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values, n = values.astype(np.uint64), len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        low = ((values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        high = np.zeros((top >> bits) + n + 1, np.uint8)
        high[(values >> np.uint64(bits)).astype(np.int64) + np.arange(n)] = 1
        packed = np.packbits(high, bitorder="little")
        ones = np.add.reduceat(np.bitwise_count(packed).astype(np.uint32), np.arange(0, len(packed), _RANK_BYTES))
        ranks = (np.cumsum(ones) - ones).astype("<u4")
        return cls(n, bits, np.packbits(low.reshape(-1), bitorder="little"), packed, ranks)

    @classmethod
    def stored(cls, n: int, row: dict, of: str) -> EliasFano:
        bits, *parts = (row[f"{of}_{c}"] for c in _SEQUENCE)
        return cls(n, bits, *(np.frombuffer(x, kind) for x, kind in zip(parts, (np.uint8, np.uint8, "<u4"))))

    def columns(self) -> list:
        return [self.low_bits, self.low.tobytes(), self.high.tobytes(), self.ranks.tobytes()]

    def select(self, i: np.ndarray) -> np.ndarray:
        """The numbers at the places i (ascending): the rank table names the 64 bytes that hold the set bit of each."""
        i = np.asarray(i, np.int64)
        if not len(i):
            return np.zeros(0, np.uint64)
        block = np.searchsorted(self.ranks, i, side="right") - 1
        named, place = np.unique(block, return_inverse=True)
        at = named[:, None] * _RANK_BYTES + np.arange(_RANK_BYTES)
        bits = np.unpackbits(np.where(at < len(self.high), self.high[np.minimum(at, len(self.high) - 1)], 0).astype(np.uint8), axis=1, bitorder="little")
        row, column = np.nonzero(bits)  # the set bits of the named blocks, in order
        begins = np.searchsorted(row, np.arange(len(named)))
        found = column[begins[place] + i - self.ranks[block].astype(np.int64)] + block * _RANK_BYTES * 8
        low = i[:, None] * self.low_bits + np.arange(self.low_bits)
        low = ((self.low[low >> 3] >> (low & 7).astype(np.uint8)) & 1).astype(np.uint64)
        return ((found - i).astype(np.uint64) << np.uint64(self.low_bits)) + (low << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


class _Block:
    """Documents gathered for the next block of a partition."""

    def __init__(self, width: int):
        self.width, self.start = width, 0
        self._clear()

    def _clear(self) -> None:
        self.docs, self.lengths, self.ids, self.n_ids = [], [], [], 0

    def add(self, doc, ids: np.ndarray) -> None:
        self.docs.append(doc)
        self.lengths.append(len(ids))
        self.ids.append(ids)
        self.n_ids += len(ids)

    def full(self, more: int) -> bool:
        return bool(self.docs) and (self.n_ids + more > BLOCK_IDS or len(self.docs) >= BLOCK_DOCS)

    def row(self, part: int) -> pa.RecordBatch:
        borders = EliasFano.of(np.concatenate([[0], np.cumsum(self.lengths)]))
        n_null = sum(doc is None for doc in self.docs)
        known = np.array(self.docs[n_null:], np.int64)
        first = int(known[0]) if len(known) else 0
        numbers = EliasFano.of(known.view(np.uint64) - np.array([first]).view(np.uint64))  # modulo 2^64, so any span of ids fits
        ids = np.concatenate(self.ids).astype(f"<u{self.width}").tobytes()
        values = [part, self.start, len(self.docs), self.n_ids, self.width, n_null, first, ids, *borders.columns(), *numbers.columns()]
        self.start += self.n_ids
        self._clear()
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), *[pa.int32(), *[pa.binary()] * 3] * 2]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=[c.split()[0] for c in STORE.split(", ")])


def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode every text, append the end id and write a store."""

    def blocks(batches):
        model, part = encoder(vocabulary), TaskContext.get().partitionId()
        block = _Block(2 if max(len(model.ends_piece) - 1, end_id) < 1 << 16 else 4)
        for batch in batches:
            for step in steps(batch, "text"):
                ids, borders = model.encode(step.column(1))
                for i, doc in enumerate(step.column(0).to_pylist()):
                    own = np.append(ids[borders[i]: borders[i + 1]], np.uint32(end_id))
                    if block.full(len(own)):
                        yield block.row(part)
                    block.add(doc, own)
        if block.docs:
            yield block.row(part)

    tie = F.xxhash64("text")
    ordered = texts_of(docs, doc_id, text).repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    ordered.mapInArrow(blocks, STORE).write.option("compression", "zstd").parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of a store with their start in the whole row of ids."""
    blocks = spark.read.schema(STORE).parquet(path)
    ranges = blocks.groupBy("part").agg(F.max(F.col("local_start") + F.col("n_ids")).alias("n"))
    # One row per writing partition, numbered as their ranges ascend: their number is bounded by the job that wrote the store.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("range_start"))
    return blocks.join(F.broadcast(starts), "part").withColumn("start", F.col("range_start") + F.col("local_start"))


DOCUMENT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _selected(row: dict, places: np.ndarray) -> pa.RecordBatch:
    """The documents of a block at the places given, ascending."""
    ids = np.frombuffer(row["ids"], f"<u{row['width']}").astype("<u4")
    borders = EliasFano.stored(row["n_docs"] + 1, row, "border")
    begin, end = borders.select(places).astype(np.int64), borders.select(places + 1).astype(np.int64)
    named = places[places >= row["n_null"]] - row["n_null"]
    numbers = EliasFano.stored(row["n_docs"] - row["n_null"], row, "doc").select(named) + np.array([row["first_id"]]).view(np.uint64)
    doc_ids = pa.concat_arrays([pa.nulls(len(places) - len(named), pa.int64()), pa.array(numbers.view(np.int64), pa.int64())])
    crc = [zlib.crc32(ids[a:b]) for a, b in zip(begin.tolist(), end.tolist())]
    return pa.RecordBatch.from_arrays([doc_ids, pa.array(row["start"] + begin), pa.array(end - begin), pa.array(crc, pa.int64())],
                                      names=[c.split()[0] for c in DOCUMENT.split(", ")])


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a store: doc_id, start, n_tokens, ids_crc32 (of 32-bit little-endian ids)."""

    def documents(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                (row,) = batch.slice(k, 1).to_pylist()
                yield _selected(row, np.arange(row["n_docs"]))

    return read_blocks(spark, path).drop("part", "local_start", "range_start", "n_ids").mapInArrow(documents, DOCUMENT)


def read_documents(spark: SparkSession, path: str, wanted: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The same of the documents whose ids are wanted: only the blocks they lie in, only their borders.

    Blocks are found by their least and greatest id, then the ids of a block by select; each wanted id counts once.
    """

    def listed(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                (row,) = batch.slice(k, 1).to_pylist()
                n = row["n_docs"] - row["n_null"]
                numbers = EliasFano.stored(n, row, "doc").select(np.arange(n)) + np.array([row["first_id"]]).view(np.uint64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(numbers.view(np.int64), pa.int64()), pa.array(np.full(n, row["part"], np.int32)),
                    pa.array(np.full(n, row["local_start"])), pa.array(np.arange(n) + row["n_null"])], names=["doc_id", "part", "local_start", "place"])

    def documents(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                (row,) = batch.slice(k, 1).to_pylist()
                yield _selected(row, np.array(row["places"], np.int64))

    blocks = read_blocks(spark, path)
    index = blocks.select("part", "local_start", "n_docs", "n_null", "first_id", *(f"doc_{c}" for c in _SEQUENCE)).mapInArrow(
        listed, "doc_id long, part int, local_start long, place long")
    found = index.join(wanted.select(F.col(doc_id).cast("long").alias("doc_id")).distinct(), "doc_id").groupBy("part", "local_start").agg(
        F.array_sort(F.collect_list("place")).alias("places"))  # at most BLOCK_DOCS of a block
    return blocks.join(found, ["part", "local_start"]).drop("part", "local_start", "range_start", "n_ids").mapInArrow(documents, DOCUMENT)
