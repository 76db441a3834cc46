"""Periodic runs of words: stretches that repeat a pattern three times or more.

A run is a stretch of words of smallest period q (words q apart are equal), at least max(MIN_WORDS,
REPEATS * q) long, that no neighbouring word extends keeping period q. Words are what white space of
ASCII separates.

Method, for all texts of a step at once. *Splitting*: a word of a run occurs REPEATS times in it, so a
word that is rarer within its segment belongs to no run and cuts the segment there; pieces shorter
than MIN_WORDS go; segments that were cut are counted again, until none is. *Lag scan*: what survives
is compared with itself at growing lags, one octave (w/2, w] after the other. Stretches of w words get
exact names by doubling (the pair of names of its halves), and each place its lag to the next place of the
same name in its segment. At a smallest period q of the octave that lag is q at every place of the run (a
nearer one would be a smaller period) and at no place beside it, so a series of places of equal lag is
one run, complete on both sides. Only places whose halves both occur again go on to the next octave:
the cost is a sort per octave of what still repeats, not a comparison at every lag.

Null and empty texts have no words, no run and an empty collapsed text. Ties need no rule: runs come by
start, then period, and runs of different periods may overlap. Repeated rows are found each on its own;
an empty table gives none. A text of any length is scanned whole. Columns of the new names are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.frames import with_computed
from ledgerloom.llm.words import SPACED, joined_words, split_words

MIN_WORDS, REPEATS = 24, 3

RUNS = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"

_RUN = pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))


def _codes(joined: bytes, begin: np.ndarray) -> np.ndarray:
    """A number per word, equal for equal words only."""
    offsets = np.append(begin, len(joined)).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(joined)])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def _series(at: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each maximal series of neighbouring places of one value."""
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(value) != 0))
    return np.concatenate([[0], cut + 1]), np.append(cut, len(at) - 1)


def segments(code: np.ndarray, doc: np.ndarray, min_words: int = MIN_WORDS, repeats: int = REPEATS) -> tuple[np.ndarray, np.ndarray]:
    """Places that survive splitting, in order, and the number of the segment of each."""
    done, fresh = [], 0
    first, last = _series(np.arange(len(doc)), doc)
    at, segment = np.arange(len(doc)), np.repeat(np.arange(len(first)), last - first + 1)
    while len(at):
        long = np.bincount(segment)[segment] >= min_words
        at, segment = at[long], segment[long]
        if not len(at):
            break
        pair = segment * (int(code.max()) + 1) + code[at]
        _, place, count = np.unique(pair, return_inverse=True, return_counts=True)
        rare = count[place] < repeats
        cut = np.zeros(int(segment.max()) + 1, bool)
        cut[segment[rare]] = True
        stable = ~cut[segment]
        if stable.any():
            _, numbers = np.unique(segment[stable], return_inverse=True)
            done.append((at[stable], numbers + fresh))
            fresh += int(numbers.max()) + 1
        left = ~stable & ~rare
        at, segment = at[left], segment[left]
        first, last = _series(at, segment)
        segment = np.repeat(np.arange(len(first)), last - first + 1)
    if not done:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, segment = (np.concatenate(x) for x in zip(*done))
    order = np.argsort(at, kind="stable")
    return at[order], segment[order]


def _lag_scan(code: np.ndarray, at: np.ndarray, segment: np.ndarray, min_words: int, repeats: int) -> list[np.ndarray]:
    """Start, length and period of every run; at and segment are what splitting left."""
    found = []
    last = np.zeros(len(code), np.int64)  # last place of the segment of a place
    first_index, last_index = _series(at, segment)
    last[at] = np.repeat(at[last_index], last_index - first_index + 1)
    size = np.zeros(len(code), np.int64)
    size[at] = np.repeat(last_index - first_index + 1, last_index - first_index + 1)
    _, name = np.unique(segment * (int(code.max()) + 1) + code[at], return_inverse=True)
    names = np.full(len(code), -1, np.int64)
    w = 1
    while len(at):
        order = np.argsort(name, kind="stable")
        same = name[order][1:] == name[order][:-1]
        lag = np.zeros(len(at), np.int64)
        lag[order[:-1][same]] = (at[order][1:] - at[order][:-1])[same]
        near = (lag > w // 2) & (lag <= w)
        places, lags = at[near], lag[near]
        a, b = _series(places, lags)
        start, period = places[a], lags[a]
        length = b - a + w + period
        enough = length >= np.maximum(min_words, repeats * period)
        found.append(np.stack([start[enough], length[enough], period[enough]]))
        # Next octave: stretches of 2w words, of halves that both occur again, in segments that can hold a period above w.
        again = np.zeros(len(at), bool)
        again[order[1:][same]] = again[order[:-1][same]] = True
        names[:] = -1
        names[at[again]] = name[again]
        at = at[again]
        at = at[(at + 2 * w - 1 <= last[at]) & (size[at] >= repeats * (w + 1))]
        halves = names[at + w]
        at, halves = at[halves >= 0], halves[halves >= 0]
        _, name = np.unique(names[at] * (int(names.max()) + 1) + halves, return_inverse=True) if len(at) else (None, at)
        w *= 2
    return found


def runs_of(texts: pa.Array, min_words: int = MIN_WORDS, repeats: int = REPEATS) -> tuple:
    """Number of words, runs and collapsed text of each text: the columns of RUNS.

    A run must hold a pattern and a stretch of up to twice its length, hence three repeats at least.
    """
    if repeats < 3:
        raise ValueError("fewer than three repeats would slip through the octaves of the lag scan")
    words = split_words(texts, SPACED)
    joined, begin, end = joined_words(words)
    joined = joined.replace(b"\xff", b"\0")
    start = length = period = np.zeros(0, np.int64)
    if len(begin):
        code = _codes(joined, begin)
        at, segment = segments(code, words.doc, min_words, repeats)
        if len(at):
            start, length, period = np.concatenate(_lag_scan(code, at, segment, min_words, repeats), axis=1)
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    change = np.zeros(len(begin) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = np.cumsum(change[:-1]) == 0
    own = words.doc[start]
    runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start - words.first[own], length, period)], ["start", "length", "period"])
    per_text = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=len(texts)))]).astype(np.int32)
    return words.counts, pa.ListArray.from_arrays(pa.array(per_text, pa.int32()), runs).cast(_RUN), _joined(joined, begin, end, kept, words, len(texts))


def _joined(joined: bytes, begin: np.ndarray, end: np.ndarray, kept: np.ndarray, words, n: int) -> pa.Array:
    """The kept words of each text, joined by one blank."""
    size = np.where(kept, end - begin + 1, 0)
    data = np.frombuffer(joined, np.uint8)[np.repeat(kept, end - begin + 1)] if joined else np.zeros(0, np.uint8)
    offsets = np.concatenate([[0], np.cumsum(size)])[words.first].astype(np.int64)
    filled = offsets[1:] > offsets[:-1]
    data = np.delete(data, offsets[1:][filled] - 1)  # the blank after the last word of each text
    offsets = offsets - np.concatenate([[0], np.cumsum(filled)])
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data.tobytes())).cast(pa.string())


def periodic_runs(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS, repeats: int = REPEATS,
                  keep: Sequence[str] | None = None) -> DataFrame:
    """docs (or its columns in keep) with the columns of RUNS: numbers of words from 0; the text without what repeats.

    The collapsed text leaves out the words of each run after its first `period` words.
    """
    return with_computed(docs, RUNS, lambda texts: runs_of(texts, min_words, repeats), text, keep=keep)


def strongest() -> Column:
    """The run of the greatest length / period (exactly; the first of equal ones), null without runs."""
    first = F.get("runs", F.lit(0))
    return F.aggregate("runs", first, lambda best, run: F.when(run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best))


def listed() -> Column:
    """Every run as a line of its own."""
    return F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
