"""Packing of documents into sequences: best fit, then local search by moves and exchanges.

Pieces are dealt evenly into groups of at most GROUP_PIECES. In each group the pieces go, longest
first, into the sequence with the least room that still holds them. Then sequences are emptied step
by step, the emptiest first: a piece moves to another sequence with room, or is exchanged for a
shorter piece there, or two pieces are exchanged for one. If a sequence has no step left, the next one
is tried. Every step increases the sum of squared fills, so the search ends: when a pass over all
sequences finds no step, or when all room together is less than a sequence, for then none can be
saved. Pieces of sequences that stay underfull in their groups are dealt
and packed once more together.

Null text: an empty one, so its only id is the end id. Repeated rows are packed as often as they
occur, empty tables give no pieces. Texts of any length are cut, never shortened.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.frames import steps, stored, texts_of
from ledgerloom.llm.tokens import encoder

CAPACITY, GROUP_PIECES = 4096, 8192
#: Sequences below this share of the capacity are packed once more.
UNDERFULL = 0.97

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_GROUP_BITS = 20


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every text's ids with the end id, cut where they exceed the capacity: one row per piece."""

    def pieces(batches):
        model = encoder(vocabulary)
        for batch in batches:
            for step in steps(batch, "text"):
                ids, borders = model.encode(step.column(1))
                rows: list[tuple] = []
                for i, doc in enumerate(step.column(0).to_pylist()):
                    own = np.append(ids[borders[i]: borders[i + 1]], np.uint32(end_id)).astype("<u4")
                    rows += [(doc, k, a, len(cut := own[a: a + capacity]), zlib.crc32(cut))
                             for k, a in enumerate(range(0, len(own), capacity))]
                columns = zip(("doc_id", "piece", "start", "length", "ids_crc32"), zip(*rows),
                              (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))
                names, arrays = zip(*((n, pa.array(v, k)) for n, v, k in columns))
                yield pa.RecordBatch.from_arrays(list(arrays), names=list(names))

    return texts_of(docs, doc_id, text).mapInArrow(pieces, PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Indexes of the lengths per sequence; the longest go first, each where least room is left."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if a sequence has r left
    found: list[list[int]] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            found[at].append(i)
        else:
            room, at = capacity, len(found)
            found.append([i])
        by_room[room - size].append(at)
        rooms |= 1 << (room - size)
    return found


class _Search:
    """Local search over the sequences of one group that have room left."""

    def __init__(self, lengths: np.ndarray, found: list[list[int]], capacity: int):
        self.lengths, self.found, self.capacity = lengths, found, capacity
        self.at = np.empty(len(lengths), np.int64)
        for k, own in enumerate(found):
            self.at[own] = k
        self.fill = np.bincount(self.at, weights=lengths, minlength=len(found)).astype(np.int64)

    def run(self) -> list[list[int]]:
        least = -(-int(self.fill.sum()) // self.capacity)
        stepped = True
        while stepped:
            stepped = False
            for source in np.argsort(self.fill, kind="stable").tolist():
                if np.count_nonzero(self.fill) <= least:
                    return [own for own in self.found if own]
                stepped |= self._empty(source)
        return [own for own in self.found if own]

    def _empty(self, source: int) -> bool:
        """Empty one sequence as far as there are steps; whether there was any."""
        stepped = False
        while self.found[source]:
            room = self.capacity - self.fill
            room[(self.fill == 0) | (np.arange(len(room)) == source)] = 0
            if not (self._move(source, room) or self._exchange(source, room)):
                break
            stepped = True
        return stepped

    def _move(self, source: int, room: np.ndarray) -> bool:
        for i in sorted(self.found[source], key=lambda i: -self.lengths[i]):
            fits = np.flatnonzero((room >= self.lengths[i]) & (self.fill + self.lengths[i] > self.fill[source]))
            if len(fits):
                self._swap(source, [i], int(fits[np.argmin(room[fits])]), [])
                return True
        return False

    def _exchange(self, source: int, room: np.ndarray) -> bool:
        """The exchange that fills another sequence most: one piece, or else two, for a shorter one there."""
        others = np.flatnonzero(room[self.at] > 0)
        size, space = self.lengths[others], room[self.at[others]]
        own = self.found[source]
        singles = [[i] for i in own]
        pairs = {int(self.lengths[i] + self.lengths[j]): [i, j] for x, i in enumerate(own) for j in own[:x]}.values()
        for given in (singles, pairs):
            best = (0, None, None)
            for some in given:
                more = int(self.lengths[some].sum()) - size
                gain = np.where((more > 0) & (more <= space), more * (self.fill[self.at[others]] - self.fill[source] + more), 0)
                if len(gain) and gain.max() > best[0]:
                    best = (int(gain.max()), some, int(others[np.argmax(gain)]))
            if best[1]:
                self._swap(source, best[1], int(self.at[best[2]]), [best[2]])
                return True
        return False

    def _swap(self, source: int, out: list[int], target: int, back: list[int]) -> None:
        self.found[source] = [i for i in self.found[source] if i not in out] + back
        self.found[target] = [i for i in self.found[target] if i not in back] + out
        self.at[out], self.at[back] = target, source
        moved = int(self.lengths[out].sum() - self.lengths[back].sum())
        self.fill[source] -= moved
        self.fill[target] += moved


def packed_group(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence number, offset there and the sequence's fill, for each length."""
    found = _Search(lengths, best_fit(lengths, capacity), capacity).run()
    sequence, offset, fill = (np.zeros(len(lengths), np.int64) for _ in range(3))
    for k, own in enumerate(found):
        sizes = lengths[own]
        sequence[own], offset[own], fill[own] = k, np.cumsum(sizes) - sizes, sizes.sum()
    return sequence, offset, fill


def _packed(pieces: DataFrame, capacity: int, n: int, first_group: int) -> DataFrame:
    groups = max(1, -(-n // GROUP_PIECES))
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset", "fill")]

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(names, kind="stable", ignore_index=True)
        sequence, offset, fill = packed_group(frame["length"].to_numpy(), capacity)
        group = int(frame["group"].iloc[0])
        return frame[names].assign(sequence_id=(group << _GROUP_BITS) + sequence, offset=offset, fill=fill)

    schema = pieces.select(names).withColumns({k: F.lit(0).cast("long") for k in ("sequence_id", "offset", "fill")}).schema
    dealt = pieces.select(*names, (F.pmod(F.monotonically_increasing_id(), F.lit(groups)) + first_group).alias("group"))
    return dealt.groupBy("group").applyInPandas(pack, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Rows of token_pieces (or any with a `length` of at most the capacity) with sequence_id and offset."""
    pieces = stored(pieces, "pieces")
    n = pieces.count()
    first = stored(_packed(pieces, capacity, n, 0), "packed")
    underfull = F.col("fill") < UNDERFULL * capacity
    again = first.filter(underfull)
    second = _packed(again, capacity, again.count(), max(1, -(-n // GROUP_PIECES)))
    return first.filter(~underfull).unionByName(second).drop("fill")
