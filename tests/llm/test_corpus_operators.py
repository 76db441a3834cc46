"""Operators on small tables: nulls, empty and long texts, repeated rows, empty tables, clashing columns."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import chat, decontamination, idstore, neardups, packing, perplexity, pii, quality, rollups, toxicity
from ledgerloom.llm.frames import session, shared_path
from ledgerloom.llm.graph import components
from ledgerloom.llm.tokens import encoder, vocabulary

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i}" for i in range(30_000))
ODD = [(1, None, None, "s", None), (2, "", "en", None, 0), (3, "one two", "en", "s", 7), (3, "one two", "en", "s", 7),
       (None, "no id here", "de", "s", 10), (4, LONG, "en", "s", len(LONG))]


@pytest.fixture(scope="module", autouse=True)
def settings(spark):
    session(spark)


@pytest.fixture
def odd(rows):
    return rows(DOCS, *ODD)


@pytest.fixture
def no_docs(rows):
    return rows(DOCS)


def ids_of(text, end):
    return [*encoder(vocabulary()).tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4"))


# --- chat

def test_chat_escapes_masks_and_records_attachments(rows):
    part = "struct<kind: string, text: string, uri: string, width: int, height: int, seconds: double, pages: int>"
    messages = rows(
        f"conv_id long, turn long, role string, content array<{part}>, formatted string",
        (1, 2, "assistant", [("text", r"a \ </s> <image> [INST]\n", None, None, None, None, None)], "x"),
        (1, 1, "user", [("text", "see ", None, None, None, None, None), ("image", None, "u1", 60, 28, None, None),
                        ("audio", None, "u2", None, None, 2.5, None), ("document", None, "u3", None, None, None, 3), None], "x"),
        (2, 1, None, None, "x"), (None, None, "assistant", [("odd", "t", None, None, None, None, None)], None),
    )
    found = {r["conv_id"]: r for r in chat.formatted_chats(messages).select(
        "*", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    one = found[1]
    assert one["formatted"].startswith("<s>user[INST]see <image><audio><document>[/INST]</s><s>assistant[INST]a ")
    assert one["formatted"].count("</s>") == 2 and one["loss"] == r"a \ </s> <image> [INST]\n"
    assert [tuple(t) for t in one["turns"]][1] == ("assistant", r"a \ </s> <image> [INST]\n")
    assert [(a["turn_at"], a["kind"], a["uri"], a["n_tokens"]) for a in one["attachments"]] == [
        (1, "image", "u1", 3), (1, "audio", "u2", 63), (1, "document", "u3", 1536)]
    assert one["expanded_tokens"] == 1602
    assert [tuple(t) for t in found[2]["turns"]] == [("", "")] and found[2]["loss"] == ""
    assert found[None]["loss"] == "t"


def test_chat_of_an_empty_table(rows):
    empty = rows("conv_id long, turn long, role string, text string").withColumn("content", chat.text_part(F.col("text")))
    assert chat.formatted_chats(empty).count() == 0


# --- token ids

def test_id_store_round_trip(spark, odd, no_docs, monkeypatch):
    monkeypatch.setattr(idstore, "BLOCK_IDS", 64)
    path = shared_path(spark, "ids")
    idstore.write_ids(odd, path, vocabulary(), end_id=2)
    found = [tuple(r) for r in idstore.read_ids(spark, path).orderBy("start").collect()]
    expected, start = [], 0
    for doc, text, *_ in sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0)):
        own = ids_of(text, 2)
        expected.append((doc, start, len(own), crc(own)))
        start += len(own)
    assert found == expected
    wanted = spark.createDataFrame([(3,), (4,), (4,), (99,), (None,)], "doc_id long")
    assert [tuple(r) for r in idstore.read_documents(spark, path, wanted).orderBy("start").collect()] == [e for e in expected if e[0] in (3, 4)]
    path = shared_path(spark, "ids")
    idstore.write_ids(no_docs, path, vocabulary(), end_id=2)
    assert idstore.read_ids(spark, path).count() == 0


def test_ids_of_any_span_and_a_hot_one(spark, rows, monkeypatch):
    """A third of the rows without id are dealt over the ranges; ids may be as far apart as 64 bits allow."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    docs = spark.range(6000, numPartitions=4).select(
        F.when(F.col("id") % 3 > 0, F.when(F.col("id") % 2 == 0, -2**63 + F.col("id")).otherwise(2**63 - 1 - F.col("id"))).alias("doc_id"),
        F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    path = shared_path(spark, "ids")
    idstore.write_ids(docs, path, vocabulary(), end_id=2)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["n"] for r in idstore.read_blocks(spark, path).groupBy("part").agg(F.sum("n_docs").alias("n")).collect()]
    assert sum(sizes) == 6000 and max(sizes) < 1500
    found = idstore.read_ids(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in found] == sorted((r["doc_id"] for r in docs.collect()), key=lambda d: (d is not None, d or 0))
    starts = [0]
    for r in found:
        assert r["start"] == starts[-1]
        starts.append(r["start"] + r["n_tokens"])


# --- packing

def test_pieces_are_whole_and_packed_without_gaps(odd, no_docs):
    pieces = packing.token_pieces(odd, vocabulary(), end_id=1, capacity=512)
    found = packing.pack(pieces, 512).toPandas()
    whole = {}
    for doc, text, *_ in ODD:
        own = ids_of(text, 1)
        whole[doc] = [(k, a, len(own[a:a + 512]), crc(own[a:a + 512])) for k, a in enumerate(range(0, len(own), 512))]
    for doc, own in found.groupby("doc_id", dropna=False):
        doc = None if doc != doc else doc
        rows = sorted(set(own[["piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)))
        assert rows == whole[doc] and len(own) == len(rows) * (2 if doc == 3 else 1)
    for _, own in found.sort_values("offset").groupby("sequence_id"):
        assert (own["offset"] == own["length"].cumsum() - own["length"]).all() and own["length"].sum() <= 512
    assert found["sequence_id"].nunique() == math.ceil(found["length"].sum() / 512)
    assert packing.pack(packing.token_pieces(no_docs, vocabulary(), end_id=1)).count() == 0


def test_many_groups_leave_few_sequences_underfull(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 200)
    lengths = np.random.default_rng(4).integers(1, 900, 1000)
    pieces = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "doc_id long, length long")
    found = packing.pack(pieces, 1024).toPandas()
    assert len(found) == 1000 and found["doc_id"].is_unique
    assert found.groupby("sequence_id")["length"].sum().max() <= 1024
    assert found["sequence_id"].nunique() <= 1.04 * len(packing.best_fit(lengths, 1024))


# --- near duplicates

def test_near_duplicates_on_odd_rows(odd, no_docs):
    found = [(r["doc_id"], r["class_size"], r["kept"]) for r in neardups.near_duplicates(odd).collect()]
    assert sorted(found, key=str) == sorted([(1, 2, True), (2, 2, False), (3, 2, True), (3, 2, True), (None, 1, True), (4, 1, True)], key=str)
    kept = neardups.deduplicated(odd.withColumn("digest", F.lit("own")).withColumn("c0", F.lit(0)))
    assert kept.columns == [*odd.columns, "digest", "c0"]
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 3, 4]
    assert neardups.near_duplicates(no_docs).count() == 0


def test_near_duplicates_agree_with_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    draw = np.random.default_rng(8)
    texts = [" ".join(f"x{w}" for w in draw.integers(0, 10**6, 120)) for _ in range(12)]
    more = []
    for i, t in enumerate(texts):
        words = t.split()
        for k in range(6):  # chains: each copy differs from the one before by a few more words
            words[5 * k + 3] = f"y{i}{k}"
            more.append((100_000 + 10 * i + k, " ".join(words)))
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    found = {r["doc_id"]: r["group_id"] for r in neardups.near_duplicates(docs).collect()}

    import re
    own = {}
    for r in docs.collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"]))
        own[r["doc_id"]] = Counter(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()
    by_shingle = defaultdict(list)
    for d, s in own.items():
        for x in s:
            by_shingle[x].append(d)
    pairs = {(a, b) for docs_ in by_shingle.values() for a in docs_ for b in docs_ if a < b}
    root = {d: d for d in own}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    def similarity(a, b):
        total = 0.0
        for d in own[a].keys() & own[b].keys():
            total += 1 / sum(max(own[a][e] / own[a][d], own[b][e] / own[b][d]) for e in own[a].keys() | own[b].keys())
        return total

    for a, b in sorted(pairs):
        if 2 * sum((own[a] & own[b]).values()) > 0.5 * (sum(own[a].values()) + sum(own[b].values())) and similarity(a, b) >= 0.8:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for d in own:  # texts without words are only equal to their copies
        if not own[d]:
            root[d] = min(e for e in own if text[e] == text[d])
    assert {d: find(d) for d in own} == found


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 199), (200, 199)]
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {**{i: 0 for i in range(31)}, **{k: 100 for k in range(100, 140)}, 199: 199, 200: 199}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_ties_of_a_turn_are_ordered_by_their_plain_text(rows):
    texts = ["<s>", "<a", "[INST]", "[J", "\\", "]", "", None, "<s>"]
    messages = rows("conv_id long, turn long, role string, text string", *[(1, 0, "user", t) for t in texts], (1, None, "user", "first"))
    shown = chat.formatted_chats(messages.withColumn("content", chat.text_part(F.col("text"))))
    (turns,) = shown.select(chat.read_turns(F.col("formatted"))).first()
    assert [t["text"] for t in turns] == ["first", *sorted(t or "" for t in texts)]


def test_a_very_long_message(rows):
    long = "<s>[/INST] \\ " * 100_000
    messages = rows("conv_id long, turn long, role string, text string", (1, 0, "assistant", long), (1, 1, "user", "x"))
    shown = chat.formatted_chats(messages.withColumn("content", chat.text_part(F.col("text"))))
    assert shown.select(chat.read_loss(F.col("formatted"), F.col("loss_spans"))).first()[0] == long


# --- decontamination

def test_blocks_of_windows_give_the_same_hits(spark, odd, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    whole = decontamination.scan(docs, benchmark, keep=("doc_id",)).orderBy("doc_id").collect()
    parts = decontamination.scan(docs, benchmark, keep=("doc_id",), block_windows=300).orderBy("doc_id").collect()
    assert whole == parts and any(r["words_hit"] for r in whole)
    assert decontamination.scan(odd, benchmark.limit(0)).filter(decontamination.contaminated()).count() == 0
    assert decontamination.scan(no_docs, benchmark).count() == 0


def test_a_window_of_all_items_is_one_row_of_a_block(rows, monkeypatch):
    """Blocks hold different windows without their items, so none grows with how many items share a window."""
    shared = " ".join(f"k{i}" for i in range(13))
    benchmark = rows("item_id long, text string", *[(i, shared if i % 2 else f"{shared} own{i}") for i in range(3000)])
    sizes, block = [], decontamination.WindowSet
    monkeypatch.setattr(decontamination, "WindowSet", lambda rows: sizes.append(len(rows)) or block(rows))
    docs = rows("doc_id long, text string", (1, f"so {shared} so"), (2, f"{shared} own4 end"), (3, "nothing"))
    found = {r["doc_id"]: r["items"] for r in decontamination.scan(docs, benchmark, block_windows=200, keep=("doc_id",)).collect()}
    assert found == {1: list(range(3000)), 2: list(range(3000)), 3: []}
    assert sum(sizes) == 1501 and max(sizes) <= 300 and len(sizes) == 8


def test_a_hot_sampled_id_brings_one_row_to_the_driver(spark, monkeypatch):
    """One labelled id stands in half of all rows: each id is learned from once."""
    docs = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(0).alias("doc_id"),
                                    F.concat(F.when(F.col("id") % 4 == 0, "vile nasty ").otherwise("some good "), F.lit("words of text "), F.col("id").cast("string")).alias("text"))
    labels = spark.range(0, 4000, 2).select(F.col("id").alias("doc_id"), (F.col("id") % 4 == 0).cast("int").alias("quality"), (F.col("id") % 4 == 0).cast("int").alias("toxic"))
    n_learned = labels.filter(quality.learning_row()).count()
    seen = []
    monkeypatch.setattr(quality, "grown_trees", lambda x, y, *more: seen.append(len(y)))
    quality.judged(docs, labels).count()
    monkeypatch.setattr(toxicity, "_bags", lambda taught, features: (seen.append(taught.count()), (_ for _ in ()).throw(RuntimeError("enough")))[0])
    with pytest.raises(RuntimeError, match="enough"):
        toxicity.learned(docs, labels)
    assert seen == [n_learned, n_learned]


def test_spans_and_documents_are_removed(rows):
    item = " ".join(f"k{i}" for i in range(20))
    benchmark = rows("item_id long, text string", (5, item), (6, "Short, Item"), (7, None), (8, "!?"), (None, "without id"), (6, "short item"))
    clean = " ".join(f"c{i}" for i in range(200))
    docs = rows(
        "doc_id long, text string, items string", (1, f"Äh {item.upper()}! {clean}", "i"), (2, f"{clean} short--ITEM, {clean}", "i"),
        (3, clean, "i"), (4, None, "i"), (5, " ".join(f"k{i}" for i in range(12)), "i"), (6, "is without id", "i"))
    hit = {r["doc_id"]: (r["n"], r["items"], r["bad"]) for r in decontamination.scan(docs, benchmark).select(
        "doc_id", decontamination.n_hit().alias("n"), "items", decontamination.contaminated().alias("bad")).collect()}
    assert hit == {1: (20, [5], True), 2: (2, [6], False), 3: (0, [], False), 4: (0, [], False), 5: (0, [], False), 6: (2, [], True)}
    assert {r["doc_id"] for r in decontamination.without_documents(docs, benchmark).filter("items = 'i'").collect()} == {2, 3, 4, 5}
    cut = {r["doc_id"]: r["text"] for r in decontamination.without_spans(docs, benchmark).collect()}
    assert cut[1] == f"Äh ! {clean}" and cut[2] == f"{clean} , {clean}" and cut[3] == clean and cut[4] is None and cut[6] == "is "


# --- quality rules

def test_quality_without_labels_is_the_base(odd, no_docs, rows):
    labels = rows("doc_id long, quality int, toxic int")
    found = {r["doc_id"]: (r["n_words"], r["base_failed"], r["kept"]) for r in quality.judged(odd, labels).collect()}
    assert found == {1: (0, True, False), 2: (0, True, False), 3: (2, True, False), None: (3, True, False), 4: (30_000, False, True)}
    assert quality.judged(no_docs, labels).count() == 0


def test_quality_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = quality.judged(docs, labels).join(labels, "doc_id").filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1)
    right = found.filter((F.col("quality") == 1) == (F.col("score") >= quality.THRESHOLD)).count()
    assert right / found.count() > 0.95


# --- perplexity

def plain_kneser_ney(texts, order):
    counts = Counter()
    for t in texts:
        codes = [0] * (order - 1) + [ord(c) + 1 for c in t]
        counts.update(tuple(codes[i:i + order]) for i in range(len(codes) - order + 1))
    levels = {order: counts}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])

    def p(gram):
        k = len(gram)
        if k == 0:
            return 1 / (len(levels[1]) + 1)
        n = Counter(levels[k].values())
        d = perplexity.discounts([n[1], n[2], n[3], n[4]])
        context = [(g, c) for g, c in levels[k].items() if g[:-1] == gram[:-1]]
        if not context:
            return p(gram[1:])
        total = sum(c for _, c in context)
        taken = sum(min(d[min(c, 3) - 1], c) for _, c in context)
        own = levels[k][gram]
        return (max(own - d[min(own, 3) - 1], 0) if own else 0) / total + taken / total * p(gram[1:])

    return p


def test_probabilities_are_those_of_plain_kneser_ney(spark, rows):
    texts = ["the cat sat on the mat", "the cart at the art", "tattered hats", None, ""]
    trusted = rows("text string", *((t,) for t in texts))
    asked = rows("text string", ("a cat at the zoo",), ("thé",))
    wanted = perplexity.gram_counts(asked).drop("c")
    found = perplexity.probabilities(perplexity.gram_counts(trusted), wanted).collect()
    p = plain_kneser_ney([t or "" for t in texts], perplexity.ORDER)
    assert len(found) == 19
    for r in found:
        assert 2 ** r["log2p"] == pytest.approx(p(tuple(r[:-1]))), r


def test_perplexity_by_blocks_equals_the_broadcast_one(spark, odd, no_docs, monkeypatch):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.unionByName(odd)
    monkeypatch.setattr(perplexity, "BLOCK_CHARS", 100_000)

    def values(**options):
        return sorted(((str(r["doc_id"]), r["perplexity"] and round(r["perplexity"], 4), r["kept"]) for r in perplexity.scored(docs, labels, **options).collect()), key=str)

    whole = values()
    assert whole == values(broadcast_grams=10) and len(whole) == docs.count()
    assert ("2", None, False) in whole
    assert perplexity.scored(no_docs, labels).count() == 0
    nothing = perplexity.scored(odd, labels.limit(0)).collect()
    assert sum(r["kept"] for r in nothing) == 4


# --- toxicity

def test_toxicity_on_held_out_labels(spark, odd, no_docs):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.scored(docs, labels, keep=("doc_id",)).join(labels, "doc_id").filter(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1).withColumn("said", toxicity.rejected())
    counts = {(r["toxic"], r["said"]): r["count"] for r in found.groupBy("toxic", "said").count().collect()}
    assert counts[1, True] / (counts[1, True] + counts.get((1, False), 0)) > 0.8  # one in ten labels of these tables has no ground in the text
    assert counts.get((0, True), 0) / counts[0, False] < 0.01
    assert [r["score"] for r in toxicity.scored(odd, labels.limit(0)).collect()] == [0.0] * len(ODD)
    assert toxicity.without_toxic(odd.withColumn("score", F.lit(1)), labels).columns == [*odd.columns, "score"]
    assert toxicity.scored(no_docs, labels).count() == 0


# --- personal data

def test_personal_data_is_found_and_masked(spark, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    numbers = "4111111111111111 5500005555555559"
    own = spark.createDataFrame([(-1, f"é two cards {numbers} here", "en", "s", 1), (-2, None, "en", "s", None), (-3, "", "en", "s", 0),
                                 (-4, "mail ab.c@d-e.org, +1 (504) 555-2652, 10.0.0.300 and 10.0.0.3", "en", "s", 0)], DOCS)
    found = pii.found_spans(docs.unionByName(own)).collect()
    for r in found:
        assert [(s["begin"], s["end"], pii.KINDS.index(s["kind"])) for s in r["spans"] if s["base"]] == pii.base_spans(r["text"] or "")
    spans = {r["doc_id"]: [(s["kind"], (r["text"] or "")[s["begin"]: s["end"]]) for s in r["spans"]] for r in found}
    assert spans[-2] == spans[-3] == [] and spans[-1] == [("card", n) for n in numbers.split()]
    added = [(s["kind"], r["text"][s["begin"]: s["end"]]) for r in found if (r["doc_id"] or 0) >= 0 for s in r["spans"] if not s["base"]]
    assert sum(k == "secret" for k, _ in added) >= 10 and all(re.fullmatch("[0-9a-f]{40}", own) for k, own in added if k == "secret")
    assert spans[-4] == [("email", "ab.c@d-e.org"), ("phone", "+1 (504) 555-2652"), ("ip", "10.0.0.3")]
    masked = {r["doc_id"]: r["text"] for r in pii.redacted(own).collect()}
    assert masked[-4] == "mail [EMAIL], [PHONE], 10.0.0.300 and [IP]" and masked[-2] is None and masked[-3] == ""
    assert pii.found_spans(no_docs).count() == 0


def test_the_tagger_finds_forms_that_no_pattern_has(spark):
    """Made spans of another seed, in texts of other documents than it learned from: recall and precision per kind."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = F.col("doc_id") % 5 == 0
    model = pii.learned(docs.filter(~held_out))
    hosts = [re.sub(r"[0-9@()\[\]]", "a", r["text"][:500]) for r in docs.filter(held_out).collect() if len(r["text"] or "") > 200]
    draw, texts, made = np.random.default_rng(99), [], []
    for k in range(900):
        before, span, behind, kind = pii.made_span(draw)
        host = hosts[k % len(hosts)]
        at = max(host.find(" ", int(draw.integers(len(host) - 50))), 0)
        texts.append(f"{host[:at]} {before}{span}{behind} {host[at:]}")
        made.append((at + 1 + len(before), at + 1 + len(before) + len(span), kind))
    missed = [k for k, t in enumerate(texts) if not pii.base_spans(t)]  # a secret may hold a card number
    assert len(missed) > 890
    texts, made = ([x[k] for k in missed] for x in (texts, made))
    found = [[s[:3] for s in own] for own in pii.all_spans(texts, model)]
    for kind in ("email", "phone", "secret"):
        wanted = [own for own, m in zip(found, made) if pii.KINDS[m[2]] == kind]
        hits = sum(m in own for own, m in zip(found, made) if pii.KINDS[m[2]] == kind)
        assert hits >= 0.85 * len(wanted), (kind, hits, len(wanted))
    right = sum(m in own for own, m in zip(found, made))
    assert right >= 0.98 * sum(map(len, found))
    clean = [re.sub("[0-9@]", "a", h) for h in hosts]
    assert not any(pii.all_spans(clean, model))


@pytest.mark.parametrize("kind, right, wrong", [
    ("phone", "(504) 555-2652", "504 555 2652"), ("phone", "504-555-2652", "555-2652"), ("email", "ab (at) cd [dot] org", "ab at cd dot org"),
    ("secret", "04dbebab91ab85687d33eeaaf9ac699e", "0123456789012345678901234567"), ("secret", "sk_A1b2C3d4E5f6G7h8J9k0", "incomprehensibilities1")])
def test_other_forms_are_checked(kind, right, wrong):
    assert pii.other_form(kind, right) and not pii.other_form(kind, wrong)


# --- rollups

def test_rollups_commit_once_and_add_up(spark, rows):
    store = rollups.RollupStore(spark, shared_path(spark, "rollup"))
    side = "struct<source: string, lang: string, version: string, n_tokens: long>"

    def changes(*data):
        return rows(f"before {side}, after {side}", *data)

    def totals():
        return {tuple(r)[:3]: tuple(r)[3:] for r in store.totals().collect()}

    a, b = ("s", "en", "v1"), ("s", None, "v1")
    assert store.commit("1", changes((None, (*a, 10)), (None, (*a, 10)), (None, (*b, None)), (None, None)))
    assert totals() == {a: (2, 20), b: (1, 0)}
    second = changes(((*a, 10), (*a, 7)), ((*b, 0), None), ((*a, 10), ("t", "en", "v2", 9)))
    assert store.commit("2", second) and not store.commit("2", second)
    assert totals() == {a: (1, 7), ("t", "en", "v2"): (1, 9)}
    # A job that died before its commit leaves deltas that nobody counts; a second entry of a batch counts once.
    deltas = spark.read.parquet(f"{store.folder}/deltas")
    deltas.filter("batch = '2'").withColumn("attempt", F.lit("zzz")).write.mode("append").parquet(f"{store.folder}/deltas")
    assert totals() == {a: (1, 7), ("t", "en", "v2"): (1, 9)}
    spark.createDataFrame([("2", "zzz")], "batch string, attempt string").write.mode("append").parquet(f"{store.folder}/commits")
    assert totals() == {a: (1, 7), ("t", "en", "v2"): (1, 9)}
    assert store.commit("3", changes()) and totals() == {a: (1, 7), ("t", "en", "v2"): (1, 9)}


# --- pipeline

def test_stages_hand_on_what_they_keep(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, folder)
        assert after.columns == docs.columns
        after = spark.createDataFrame(after.collect(), docs.schema)
        assert after.select("doc_id").exceptAll(before.select("doc_id")).isEmpty()
        before = after
    packed = corpus_pipeline.run(spark, folder).toPandas()
    assert set(packed["doc_id"]) == {r["doc_id"] for r in before.collect()}
    expected = {}
    for r in before.collect():
        own = ids_of(r["text"], 1)
        for k, a in enumerate(range(0, len(own), 4096)):
            expected[r["doc_id"], k] = a, len(own[a:a + 4096]), crc(own[a:a + 4096])
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in packed.itertuples()} == expected


def test_stages_take_an_empty_table(spark, no_docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, "/root/testdata/sf0.001").count() == 0


def test_stages_keep_odd_rows_and_columns_of_any_name(spark, odd):
    docs = odd.withColumns({c: F.lit("own") for c in ("score", "items", "spans", "digest", "kept", "label", "node")})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, "/root/testdata/sf0.001")
        assert found.columns == docs.columns, name
        kept = sorted((r["doc_id"] or 0) for r in found.filter("score = 'own' AND kept = 'own'").collect())
        assert kept == ([0, 1, 3, 4] if name == "near_duplicates" else [0, 1, 2, 3, 3, 4]), name
