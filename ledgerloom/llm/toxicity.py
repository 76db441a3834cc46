"""Toxicity by multiple-instance learning: sentence scores, learned from labels of whole documents.

A document is toxic if any of its sentences is: with sentence scores p the document's score is the
noisy-or 1 - (1 - leak) * prod(1 - p). A sentence's p is logistic in its features, which are its words
(lower-cased in ASCII) and their beginnings of a few lengths; sentences without a learned feature
count as 0. Sentences end at . ! ? and line breaks.

Labels come from LEARN_ROWS documents at most, those of the least hash of their id among the rows a
model may learn from. Of their features the MOST_FEATURES that point most surely at toxic documents
are kept, and weights are fitted to the documents' likelihood, with an L1 penalty. What is learned
is bounded by these parameters; every document is scored whole, in one pass, and `sentences` names
the offending ones.

Null and empty texts score the leak of the model, near 0. Without toxic and clean labels everything
scores 0. A label other than 0 and 1, or null, teaches nothing. Repeated rows score alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.frames import learning_row, least_hashed, set_aside, steps, stored, texts_of, with_computed
from ledgerloom.llm.words import PLAIN, Words, code_points, mixed, span_hashes, split_words, text_bytes

LEARN_ROWS, CANDIDATES, MOST_FEATURES = 20_000, 1 << 17, 4096
LEAST_DOCUMENTS, LEAST_Z = 3, 3.0
BEGINNINGS = (5, 6, 7, 8, 10)  # bytes
ROUNDS, RATE, PENALTY, FIRST_BIAS, LEAK = 400, 0.05, 5e-5, -1.5, 1e-3
THRESHOLD, OFFENDING = 0.7, 0.3

_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\n"]] = True
_BITS = 22


def _features(words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(word numbers, feature hashes): all words, and the beginnings of those that are longer."""
    found = [(np.arange(len(words.hash)), words.hash)]
    lengths = words.end - words.start
    for k in BEGINNINGS:
        longer = np.flatnonzero(lengths > k)
        hashes = span_hashes(words.data, words.start[longer], words.start[longer] + k) if len(longer) else np.zeros(0, np.uint64)
        found.append((longer, mixed(hashes + np.uint64(k))))
    return found


class FeatureSet:
    """Numbers of known features, looked up behind a table of bits."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes.view(np.uint64))
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[(self.hashes >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def found(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Word number and feature number of every occurrence."""
        at, numbers = [], []
        for word, hashes in _features(words):
            likely = np.flatnonzero(self.seen[(hashes >> np.uint64(64 - _BITS)).astype(np.int64)])
            where = np.minimum(np.searchsorted(self.hashes, hashes[likely]), len(self.hashes) - 1)
            same = self.hashes[where] == hashes[likely]
            at.append(word[likely[same]])
            numbers.append(where[same])
        return np.concatenate(at), np.concatenate(numbers)


def _sentences(texts: pa.Array, words: Words) -> np.ndarray:
    """Number of the sentence of each word; different in different documents."""
    data, _ = text_bytes(texts)
    before = np.concatenate([[0], np.cumsum(_ENDS[data])])
    return before[words.start] + words.doc


@dataclass
class NoisyOr:
    """Weights per feature; documents' scores from sentences' scores."""

    features: FeatureSet
    weight: np.ndarray
    bias: float

    def sentence_scores(self, texts: pa.Array):
        """Document, first word, end word and score of each sentence with a feature."""
        words = split_words(texts, PLAIN)
        at, number = self.features.found(words)
        sentence = _sentences(texts, words)
        with_feature, row = np.unique(sentence[at], return_inverse=True)
        z = self.bias + np.bincount(row, weights=self.weight[number], minlength=len(with_feature))
        first = np.searchsorted(sentence, with_feature)
        end = np.searchsorted(sentence, with_feature, side="right")
        return words, words.doc[first], first, end, 1 / (1 + np.exp(-z))

    def document_scores(self, texts: pa.Array):
        """score, and begin, end (code points) and score of the offending sentences."""
        words, doc, first, end, p = self.sentence_scores(texts)
        n = len(texts)
        score = 1 - (1 - LEAK) * np.exp(np.bincount(doc, weights=np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=n))
        data, offsets = text_bytes(texts)
        chars = code_points(data)
        listed: list[list] = [[] for _ in range(n)]
        for k in np.flatnonzero(p >= OFFENDING).tolist():
            d = doc[k]
            base = chars[offsets[d]]
            listed[d].append({"begin": chars[words.start[first[k]]] - base, "end": chars[words.end[end[k] - 1]] - base, "score": p[k]})
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        return [pa.array(score), pa.array(listed, kind)]


SCORED = "score double, sentences array<struct<begin: long, end: long, score: double>>"


def _feature_documents(docs: DataFrame, known: FeatureSet | None) -> DataFrame:
    """(feature, n): in how many documents each feature occurs; only known ones if they are given."""

    def count(batches):
        for batch in batches:
            for step in steps(batch, "text"):
                words = split_words(step.column(0), PLAIN)
                if known is None:
                    pairs = [(words.doc[at], hashes) for at, hashes in _features(words)]
                else:
                    at, number = known.found(words)
                    pairs = [(words.doc[at], known.hashes[number])]
                doc, hashes = (np.concatenate(x) for x in zip(*pairs))
                own = mixed(hashes + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                _, first = np.unique(own, return_index=True)  # each feature once a document
                found, n = np.unique(hashes[first], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["feature", "n"])

    return docs.select("text").mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def _bags(docs: DataFrame, features: FeatureSet):
    """label, number of the document and of the sentence, feature number, for the whole (bounded) sample."""

    def bag(texts):
        words = split_words(texts, PLAIN)
        at, number = features.found(words)
        order = np.argsort(words.doc[at], kind="stable")
        at, number, sentence = at[order], number[order], _sentences(texts, words)
        offsets = pa.array(np.searchsorted(words.doc[at], np.arange(len(texts) + 1)), pa.int32())
        return [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int64))) for x in (sentence[at] - words.doc[at], number)]

    rows = with_computed(docs, "at array<long>, numbers array<long>", bag, keep=("label",)).toPandas()
    size = rows["at"].map(len).to_numpy(np.int64)
    doc = np.repeat(np.arange(len(rows)), size)
    at, number = (np.concatenate([*rows[c], []]).astype(np.int64) for c in ("at", "numbers"))
    _, sentence = np.unique(np.stack([doc, at], 1), axis=0, return_inverse=True)
    return rows["label"].to_numpy(float), doc, sentence.reshape(-1), number


def fitted_weights(label: np.ndarray, doc: np.ndarray, sentence: np.ndarray, number: np.ndarray, n_features: int) -> tuple[np.ndarray, float]:
    """Weights (not negative) and bias that maximise the noisy-or likelihood of the labels."""
    n = int(sentence.max()) + 1 if len(sentence) else 0
    owner = np.zeros(n, np.int64)
    owner[sentence] = doc
    weight, bias = np.full(n_features, 1.0), FIRST_BIAS
    moments = np.zeros((2, n_features + 1))
    for step in range(1, ROUNDS + 1):
        z = bias + np.bincount(sentence, weights=weight[number], minlength=n)
        p = 1 / (1 + np.exp(-z))
        total = np.bincount(owner, weights=np.logaddexp(0, z), minlength=len(label)) - np.log1p(-LEAK)
        pull = np.where(label == 1, 1 / np.expm1(np.minimum(total, 50)), -1.0)  # d log-likelihood / d total
        slope = pull[owner] * p / len(label)
        gradient = np.append(np.bincount(number, weights=slope[sentence], minlength=n_features), slope.sum())
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.99 * moments[1] + 0.01 * gradient ** 2
        scale = RATE / (np.sqrt(moments[1] / (1 - 0.99 ** step)) + 1e-4)
        change = scale * moments[0] / (1 - 0.9 ** step)
        weight = np.maximum(weight + change[:-1] - scale[:-1] * PENALTY, 0.0)
        bias += change[-1]
    return weight, float(bias)


def learned(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text",
            rows: int = LEARN_ROWS, learn_from: Column | None = None) -> NoisyOr | None:
    """The model of at most `rows` labelled documents; None without both kinds of label.

    Of an id that many rows share, the text of the least hash is learned from.
    """
    learn_from = learning_row() if learn_from is None else learn_from
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label")).filter(learn_from & F.col("label").isin(0, 1))
    sample = least_hashed(known, "doc_id", rows)
    of_sample = texts_of(docs, doc_id, text).join(F.broadcast(sample), "doc_id")  # at most `rows` ids
    least = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("least")
    taught = stored(of_sample.groupBy("doc_id", "label").agg(least).select("label", "least.text"), "taught")
    kinds = dict(taught.groupBy("label").count().collect())
    if not (kinds.get(0) and kinds.get(1)):
        return None
    toxic = _feature_documents(taught.filter("label = 1"), None).filter(F.col("n") >= LEAST_DOCUMENTS)
    toxic = toxic.orderBy(F.desc("n"), "feature").limit(CANDIDATES).toPandas()
    if not len(toxic):
        return None
    candidates = FeatureSet(toxic["feature"].to_numpy())
    clean = _feature_documents(taught.filter("label = 0"), candidates).toPandas()
    n1, n0 = toxic["n"].to_numpy(float), toxic["feature"].map(dict(zip(clean["feature"], clean["n"]))).fillna(0).to_numpy(float)
    z = (np.log((n1 + 0.5) / (kinds[1] + 1)) - np.log((n0 + 0.5) / (kinds[0] + 1))) / np.sqrt(1 / (n1 + 0.5) + 1 / (n0 + 0.5))
    best = np.argsort(-z, kind="stable")[:MOST_FEATURES]
    best = best[z[best] >= LEAST_Z]
    if not len(best):
        return None
    features = FeatureSet(toxic["feature"].to_numpy()[best])
    weight, bias = fitted_weights(*_bags(taught, features), len(features.hashes))
    used = weight > 0
    return NoisyOr(FeatureSet(features.hashes[used]), weight[used], bias) if used.any() else None


def scored(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", keep=None, **learning) -> DataFrame:
    """docs (or its columns in keep) with score and the offending sentences."""
    model = learned(docs, labels, doc_id=doc_id, text=text, **learning)
    if model is None:
        return (docs if keep is None else docs.select(*keep)).withColumns({
            "score": F.lit(0.0), "sentences": F.array().cast("array<struct<begin: long, end: long, score: double>>")})
    return with_computed(docs, SCORED, model.document_scores, text, keep=keep)


def rejected(threshold: float = THRESHOLD) -> Column:
    return F.col("score") >= threshold


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs without those that score at least the threshold, with their own columns."""
    own, names, back = set_aside(docs)
    model = learned(docs, labels, doc_id=doc_id, text=text)
    return docs if model is None else back(with_computed(own, SCORED, model.document_scores, names[text]).filter(~rejected(threshold)))
