"""Operators do their whole job: brute force and inputs that a shortened one fails on."""

import re
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import packing, perplexity, pii, quality, toxicity
from ledgerloom.llm.frames import least_hashed, session
from ledgerloom.llm.tokens import encoder, vocabulary
from ledgerloom.session import work_folder


@pytest.fixture(scope="module", autouse=True)
def settings(spark):
    session(spark)


# --- perplexity

def kneser_ney(sentences, order, base):
    """p(gram) by plain code; base(symbol) is what the lowest order interpolates with."""
    levels = {order: Counter()}
    for s in sentences:
        s = [None] * (order - 1) + list(s)
        levels[order].update(tuple(s[i - order + 1: i + 1]) for i in range(order - 1, len(s)))
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])

    def parts(gram):
        """What the gram has of its own, and the share left to the base."""
        k = len(gram)
        if k == 0:
            return 0.0, 1.0
        n = Counter(levels[k].values())
        d = perplexity.discounts([n[1], n[2], n[3], n[4]])
        context = [c for g, c in levels[k].items() if g[:-1] == gram[:-1]]
        lower, left = parts(gram[1:])
        if not context:
            return lower, left
        own, total = levels[k][gram], sum(context)
        share = sum(min(d[min(c, 3) - 1], c) for c in context) / total
        return (max(own - d[min(own, 3) - 1], 0) if own else 0) / total + share * lower, share * left

    return lambda gram: (lambda a, b: a + b * base(len(levels[1])))(*parts(gram)), parts


def test_perplexity_is_that_of_words_that_back_off_to_spelling(spark, rows, monkeypatch):
    known = ["the cat sat on the mat", "the cat sat on the hat\n", "a dog sat on the cat", " the dog sat", "the cat sat on the mat"]
    other = ["the cat sat on the mat", "mat the on sat cat the", "zebra the  cat\n ", " ", "thé cat", "", None]
    docs = rows("doc_id long, lang string, text string", *((i, "en", t) for i, t in enumerate(known + other)))
    labels = rows("doc_id long, quality int", *((i, 1) for i in range(len(known))))
    letter, _ = kneser_ney(known, perplexity.ORDER, lambda n: 1 / (n + 1))
    _, word = kneser_ney([t.split() for t in known], 3, None)

    def brute(text):
        padded = [None] * (perplexity.ORDER - 1) + list(text)
        spelled = [letter(tuple(padded[i: i + perplexity.ORDER])) for i in range(len(text))]
        history, total, at = [None, None], 0.0, 0
        for m in re.finditer(r"\S+", text):
            seen, left = word((*history, m.group()))
            total += np.log2(seen * np.prod(spelled[at: m.start()]) + left * np.prod(spelled[at: m.end()]))
            history, at = [history[1], m.group()], m.end()
        return 2 ** (-(total + np.log2(spelled[at:]).sum()) / len(text))

    monkeypatch.setattr(perplexity, "SHARD_CHARS", 40)
    for limit in (perplexity.BROADCAST_GRAMS, 0):
        found = {r["doc_id"]: r["perplexity"] for r in perplexity.scored(docs, labels, learn_from=F.lit(True), broadcast_grams=limit).collect()}
        assert len(found) == len(known + other)
        for i, text in enumerate(known + other):
            assert found[i] == (pytest.approx(brute(text), rel=1e-4) if text else None), text
        assert found[5] < found[6]  # the order of words counts


def test_rows_of_the_language_model_grow_with_the_text(spark, rows):
    draw = np.random.default_rng(2)
    texts = [" ".join(f"w{i}" for i in draw.integers(0, 300, 200)) for _ in range(40)]
    counts = [perplexity.word_model(perplexity.word_counts(rows("text string", *((t,) for t in texts[:n]))))[0].count() for n in (10, 40)]
    assert counts[1] > 2.5 * counts[0]


def test_perplexity_part_after_part_frees_its_disk(spark, monkeypatch):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    docs, labels = docs.unionByName(docs.limit(20)), labels.withColumn("quality", F.lit(1))
    chars = docs.agg(F.sum(F.char_length("text"))).first()[0]
    monkeypatch.setattr(perplexity, "SHARD_CHARS", chars // 5)
    monkeypatch.setattr(perplexity, "ROUND_CHARS", chars // 3)

    def values(**options):
        return sorted((r["doc_id"], round(r["perplexity"] or 0, 3), r["kept"]) for r in perplexity.scored(docs, labels, **options).collect())

    whole = values()
    folder = Path(work_folder(spark).removeprefix("file://"))
    there = {p: p.stat().st_size for p in folder.rglob("*.parquet")}
    assert values(broadcast_grams=60_000) == whole and len(whole) == docs.count()
    left = sum(p.stat().st_size for p in folder.rglob("*.parquet") if p not in there)
    assert left < 1.5 * chars  # counts, wanted n-grams and probabilities of characters; no texts and no n-grams of words


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_packed_numbers_come_back(n):
    draw = np.random.default_rng(3)
    keys = np.unique(draw.integers(0, 1 << 64, n, dtype=np.uint64))
    assert (perplexity._unpacked(perplexity._packed(keys)) == keys).all()
    for bound in (2, 300, 1 << 62):
        numbers = draw.integers(-bound if bound > 300 else 0, bound, (n, 4))
        assert (perplexity._from_numbers(perplexity._numbers(numbers), 4) == numbers).all()


# --- packing

def thirds(draw):
    return draw.integers(1000, 1701, 1300)


def thirds_to_halves(draw):
    return draw.integers(700, 2201, 1300)


def thirds_and_two_thirds(draw):
    return np.concatenate([draw.integers(1330, 1421, 900), draw.integers(2600, 2801, 300)])


@pytest.mark.parametrize("lengths, share", [(thirds, 0.95), (thirds_to_halves, 0.99), (thirds_and_two_thirds, 0.98)])
def test_local_search_beats_best_fit(lengths, share):
    lengths = lengths(np.random.default_rng(5))
    sequence, _, fill = packing.packed_group(lengths, 4096)
    assert len(np.unique(sequence)) <= share * len(packing.best_fit(lengths, 4096))
    assert (np.bincount(sequence, weights=lengths)[sequence] == fill).all() and fill.max() <= 4096


# --- samples to learn from

TEN = "/root/testdata/sf0.01"


def test_samples_are_of_different_ids(rows):
    ids = rows("id long", *[(None,)] * 50, *[(7,)] * 50, *((i,) for i in range(20)))
    found = [r["id"] for r in least_hashed(ids, "id", 15).collect()]
    assert len(set(found)) == 15 and None not in found


def test_labels_without_id_take_no_place_in_the_sample(spark, rows):
    docs, labels = (spark.read.parquet(f"{TEN}/{t}.parquet") for t in ("documents", "labels"))
    more = labels.unionByName(spark.range(300).select(F.lit(None).cast("long").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"),
                                                      (F.col("id") % 2).cast("int").alias("toxic")))
    for run in (toxicity.scored, quality.judged):
        own, same = ({(r["doc_id"], round(r["score"], 9)) for r in run(docs, of, rows=250).select("doc_id", "score").collect()} for of in (labels, more))
        assert own == same and len({score for _, score in own}) > 2


def test_documents_without_id_or_with_a_hot_one_take_no_place_in_the_sample(spark, monkeypatch):
    monkeypatch.setattr(pii, "LEARN_DOCS", 300)
    docs = spark.read.parquet(f"{TEN}/documents.parquet").select("doc_id", "text")
    more = docs.unionByName(spark.range(600).select(F.when(F.col("id") % 2 == 0, F.lit(-5)).cast("long").alias("doc_id"), F.lit("no such data").alias("text")))
    assert pii.learned(docs) is not None and pii.learned(more) is not None


# --- token ids

def test_ids_are_those_of_an_untouched_tokenizer():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(vocabulary())
    texts = ["it's <|endoftext|> don't", None, "one two", "a<|StartOfText|>b<|startoftext|>", "", "<|endoftext|><|endoftext|>", "<| endoftext |>"]
    ids, offsets = encoder(vocabulary()).encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert 49407 in ids
