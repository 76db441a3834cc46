"""Quality rules: statistics of whole documents, base limits, and boosted trees over the statistics.

Words are runs of characters other than ASCII white space; null texts have none. The trees are grown
on labelled documents (a bounded sample, LEARN_ROWS) with second-order gradients over at most BINS
values per statistic. For statistics in FALLING the score never rises as they rise: a split that
would break this is not taken, and the children of one that keeps it are held to its two sides.
Grown trees are flattened into numpy node arrays that score a batch in as many steps as trees are
deep.

Without labels of both kinds there is no verdict beyond the base limits. Empty tables give empty
results; repeated rows are judged alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.frames import learning_row, least_hashed, stored, with_computed
from ledgerloom.llm.words import SPACED, code_points, mixed, per_document, span_hashes, split_words, text_bytes

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATIOS = ("log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "distinct_share",
          "upper_share", "mark_share", "digit_share", "stop_share", "words_per_line", "short_share")
STATISTICS = ", ".join([*(f"{c} long" for c in COUNTS), *(f"{c} double" for c in RATIOS)])
FALLING = ("symbol_share", "dup_line_share", "repeat_share")

LEARN_ROWS = 20_000
TREES, DEPTH, RATE, BINS, LEAST_WEIGHT, RIDGE = 60, 3, 0.2, 32, 4.0, 1.0
#: Documents are kept from this score on.
THRESHOLD = 0.4

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _in_range(low: str, high: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[ord(low): ord(high) + 1] = True
    return table


def _listed(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in chars]] = True
    return table


def _repeated(keys: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which keys occur at least twice in their document."""
    own = mixed(keys + doc.astype(np.uint64) * _STEP)
    ordered = np.sort(own)
    many = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(many):
        return np.zeros(len(keys), bool)
    return many[np.minimum(np.searchsorted(many, own), len(many) - 1)] == own


def _distinct(keys: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Number of different keys per document."""
    own = mixed(keys + doc.astype(np.uint64) * _STEP)
    many = _repeated(keys, doc)
    _, first = np.unique(own[many], return_index=True)
    return np.bincount(doc[~many], minlength=n) + np.bincount(doc[many][first], minlength=n)


def _line_counts(data: np.ndarray, offsets: np.ndarray, word_at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those of them that equal an earlier one of their document."""
    breaks = np.flatnonzero(data == 10)
    start = np.unique(np.concatenate([offsets[:-1], breaks + 1]))  # empty texts and last lines share theirs
    doc = np.searchsorted(offsets[1:], start, side="right")
    filled = doc < n  # a line that begins where the last text ends is empty
    start, doc = start[filled], doc[filled]
    next_break = np.append(breaks, len(data))[np.searchsorted(breaks, start)]
    end = np.minimum(next_break, offsets[doc + 1])
    with_word = np.searchsorted(word_at, end) > np.searchsorted(word_at, start)
    start, end, doc = start[with_word], end[with_word], doc[with_word]
    lines = np.bincount(doc, minlength=n)
    return lines, lines - _distinct(span_hashes(data, start, end), doc, n)


def statistics(texts: pa.Array) -> list[np.ndarray]:
    """One array per column of STATISTICS."""
    n = len(texts)
    data, offsets = text_bytes(texts)
    words = split_words(texts, SPACED)
    chars = code_points(data)

    def share(table: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(table[data])])[offsets])

    n_words, lengths = words.counts, chars[words.end] - chars[words.start]
    word_chars = per_document(lengths, words.doc, n)
    n_symbols = share(_SYMBOL)
    lines, n_dup_lines = _line_counts(data, offsets, words.start, n)
    at, windows = words.windows(5)
    change = np.zeros(len(words.hash) + 1, np.int64)
    found = at[_repeated(windows, words.doc[at])]
    np.add.at(change, found, 1)
    np.add.at(change, found + 5, -1)
    n_repeat_words = per_document(np.cumsum(change[:-1]) > 0, words.doc, n)

    per_word, per_char = 1.0 / np.maximum(n_words, 1), 1.0 / np.maximum(np.diff(chars[offsets]), 1)
    ratios = [
        np.log1p(n_words), word_chars * per_word, n_symbols * per_char, n_dup_lines / np.maximum(lines, 1), n_repeat_words * per_word,
        _distinct(words.hash, words.doc, n) * per_word, share(_in_range("A", "Z")) * per_char, share(_listed("!?;:")) * per_char,
        share(_in_range("0", "9")) * per_char, share(_listed(".,")) * per_word, n_words / np.maximum(lines, 1),
        per_document(lengths <= 3, words.doc, n) * per_word,
    ]
    return [n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, *ratios]


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


@dataclass
class Trees:
    """Flattened trees: a node sends values up to its threshold left; leaves point to themselves."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = np.where(x[row, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
        return 1.0 / (1.0 + np.exp(-(self.base + self.value[node].sum(axis=1))))


class _Grower:
    """Grows trees over binned statistics; direction is -1 where the score must not rise, else 0."""

    def __init__(self, x: np.ndarray, y: np.ndarray, direction: np.ndarray):
        self.y, self.direction = y, direction
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        self.binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(self.cuts, x.T)], 1)
        self.nodes: list[list] = []

    def run(self) -> Trees:
        share = np.clip(self.y.mean(), 1e-3, 1 - 1e-3)
        base = float(np.log(share / (1 - share)))
        score, roots = np.full(len(self.y), base), []
        for _ in range(TREES):
            p = 1.0 / (1.0 + np.exp(-score))
            self.gradient, self.hessian = p - self.y, p * (1 - p)
            roots.append(self._grow(np.arange(len(self.y)), DEPTH, -np.inf, np.inf, score))
        feature, threshold, left, right, value = (np.array(c) for c in zip(*self.nodes))
        return Trees(np.array(roots), feature, threshold, left, right, value, DEPTH, base)

    def _weight(self, g, h, low, high):
        return np.clip(-g / (h + RIDGE), low, high)

    def _grow(self, rows: np.ndarray, depth: int, low: float, high: float, score: np.ndarray) -> int:
        at = len(self.nodes)
        g, h = self.gradient[rows].sum(), self.hessian[rows].sum()
        own = float(self._weight(g, h, low, high))
        self.nodes.append([0, np.inf, at, at, RATE * own])
        split = self._best_split(rows, g, h, low, high) if depth else None
        if split is None:
            score[rows] += RATE * own
            return at
        feature, cut, left_weight, right_weight = split
        goes_left = self.binned[rows, feature] <= cut
        middle = (left_weight + right_weight) / 2
        bounds = ((middle, high), (low, middle)) if self.direction[feature] < 0 else ((low, high), (low, high))
        left = self._grow(rows[goes_left], depth - 1, *bounds[0], score)
        right = self._grow(rows[~goes_left], depth - 1, *bounds[1], score)
        self.nodes[at] = [feature, float(self.cuts[feature][cut]), left, right, 0.0]
        return at

    def _best_split(self, rows, g, h, low, high):
        best, found = 1e-6, None
        for feature, cuts in enumerate(self.cuts):
            bins = self.binned[rows, feature]
            gl, hl = (np.cumsum(np.bincount(bins, weights=w[rows], minlength=len(cuts) + 1))[:-1] for w in (self.gradient, self.hessian))
            gr, hr = g - gl, h - hl
            wl, wr = self._weight(gl, hl, low, high), self._weight(gr, hr, low, high)

            def gained(gradient, hessian, weight):
                return -(gradient * weight + 0.5 * (hessian + RIDGE) * weight ** 2)

            gain = gained(gl, hl, wl) + gained(gr, hr, wr) - gained(g, h, self._weight(g, h, low, high))
            allowed = (hl >= LEAST_WEIGHT) & (hr >= LEAST_WEIGHT) & ((self.direction[feature] == 0) | (wl >= wr))
            gain = np.where(allowed, gain, -np.inf)
            if len(gain) and gain.max() > best:
                cut = int(np.argmax(gain))
                best, found = float(gain[cut]), (feature, cut, float(wl[cut]), float(wr[cut]))
        return found


def grown_trees(x: np.ndarray, y: np.ndarray, names: tuple[str, ...] = RATIOS) -> Trees | None:
    """Trees for labels 0 and 1; None if only one of them occurs."""
    if len(np.unique(y)) < 2:
        return None
    return _Grower(x, y.astype(float), np.array([-1 if c in FALLING else 0 for c in names])).run()


def judged(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
           rows: int = LEARN_ROWS, threshold: float = THRESHOLD, learn_from: Column | None = None) -> DataFrame:
    """doc_id, STATISTICS, base_failed, score and kept for every row of docs.

    The trees learn from `rows` labelled documents, those of the least hash of their id; of an id that many rows share,
    from the least of each statistic.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = stored(with_computed(plain, STATISTICS, statistics, keep=("doc_id",)), "statistics")
    learn_from = learning_row() if learn_from is None else learn_from
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label")).filter(learn_from & F.col("label").isin(0, 1))
    sample = least_hashed(known, "doc_id", rows)
    # One row per sampled id and label before anything comes to the driver: at most `rows` rows.
    once = found.join(sample, "doc_id").groupBy("doc_id", "label").agg(*[F.min(c).alias(c) for c in RATIOS])
    learned = once.select("label", *RATIOS).toPandas()
    trees = grown_trees(learned[list(RATIOS)].to_numpy(), learned["label"].to_numpy())
    if trees is None:
        scored = found.withColumn("score", F.lit(1.0))
    else:
        names = [f.name for f in found.schema.fields]

        def score(batches):
            for batch in batches:
                x = np.stack([batch.column(names.index(c)).to_numpy() for c in RATIOS], 1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(trees.scores(x))], names=[*names, "score"])

        scored = found.mapInArrow(score, found.withColumn("score", F.lit(1.0)).schema)
    return scored.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
