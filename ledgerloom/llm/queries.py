"""The registered queries of this package; SQL where it can express one."""

from __future__ import annotations

import re
import zlib

import pyarrow as pa
from pyspark.sql import functions as F

from ledgerloom.llm import (chat, decontamination, idstore, linestore, manifest, neardups, packing, periodic, perplexity, pii, quality, rollups,
                            toxicity)
from ledgerloom.llm.frames import held_out, shared_path, stored, table, with_computed
from ledgerloom.llm.tokens import vocabulary

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLE_SQL[function.__name__] = sql
        return function

    return register


def _escaped_length(column: str) -> str:
    controls = r"(<|\[)(/?s>|image>|audio>|document>|/?INST\])"
    return rf"length(regexp_replace(regexp_replace({column}, '\\', '\\\\', 'g'), '{controls}', '\1\\\2', 'g'))"


_CONTROLS_ONLY = "</s>[INST] ok [/INST]"


@query(f"""
WITH message AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '{_CONTROLS_ONLY}'), (-7, 1, 'assistant', '{_CONTROLS_ONLY}'))
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum({_escaped_length("role")} + {_escaped_length("text")} + {len(chat.TURN + chat.BODY + chat.BODY_END + chat.TURN_END)}) AS BIGINT) AS formatted_chars
FROM message GROUP BY conv_id
""")
def op1_chat_formatting(spark, sf_dir):
    messages = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    controls = spark.createDataFrame([(-7, k, role, _CONTROLS_ONLY) for k, role in enumerate(("user", "assistant"))], messages.schema)
    texts = messages.unionByName(controls).withColumn("content", chat.text_part(F.coalesce("text", F.lit(""))))
    formatted = F.col("formatted")
    loss, turns = chat.read_loss(formatted, F.col("loss_spans")), chat.read_turns(formatted)
    lines = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chat.formatted_chats(texts).select(
        "conv_id", F.size(turns).cast("long").alias("n_turns"), F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.char_length(formatted).cast("long").alias("formatted_chars"),
    )


@query()
def op2_id_store(spark, sf_dir):
    path = shared_path(spark, "ids")
    idstore.write_ids(table(spark, sf_dir, "documents"), path, vocabulary(), end_id=2)
    return idstore.read_ids(spark, path)


@query()
def op4_best_fit_packing(spark, sf_dir):
    return packing.pack(packing.token_pieces(table(spark, sf_dir, "documents"), vocabulary(), end_id=1))


# Two tokenizer versions whose counts SQL can repeat: words between white space, and pieces of words.
_SPACED, _PIECES = "[^\\x20\\x09-\\x0D]+", "[A-Za-z\\x{80}-\\x{10FFFF}]+|[0-9]|[!-/:-@\\[-`{-~]"


@query(f"""
SELECT source, lang, 'pieces-2' AS version, count(*) AS n_docs,
    CAST(sum(len(regexp_extract_all(coalesce(text, ''), '{_PIECES}'))) AS BIGINT) AS n_tokens
FROM documents WHERE len(regexp_extract_all(coalesce(text, ''), '{_SPACED}')) >= 10 GROUP BY source, lang
""")
def op6_token_rollup(spark, sf_dir):
    """All documents are counted by one version, recounted by the next (a batch that comes twice), short ones deleted."""
    text = F.coalesce("text", F.lit(""))
    counts = stored(table(spark, sf_dir, "documents").select(
        "source", "lang", F.regexp_count(text, F.lit(_SPACED)).alias("spaced"), F.regexp_count(text, F.lit(_PIECES)).alias("pieces")), "counts")
    first, second = (rollups.counted("source", "lang", *v) for v in (("spaced-1", "spaced"), ("pieces-2", "pieces")))
    store = rollups.RollupStore(spark, shared_path(spark, "rollup"))
    recount = counts.select(first.alias("before"), second.alias("after"))
    store.commit("load", counts.select(rollups.no_side().alias("before"), first.alias("after")))
    store.commit("recount", recount)
    store.commit("recount", recount)
    store.commit("short", counts.filter("spaced < 10").select(second.alias("before"), rollups.no_side().alias("after")))
    return store.totals()


_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN_WORDS = rf"regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(f"""
WITH item AS (SELECT item_id, w, least(len(w), 13) AS size FROM (SELECT item_id, {_PLAIN_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
item_window AS (
    SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS win
    FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM item)),
doc AS (SELECT doc_id, {_PLAIN_WORDS} AS w FROM documents),
doc_window AS (
    SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS win
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc, (SELECT DISTINCT size FROM item) WHERE len(w) >= size)),
hit AS (SELECT doc_id, i, size, item_id FROM doc_window JOIN item_window USING (size, win)),
hit_words AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS pos FROM hit) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
""")
def op8_decontamination(spark, sf_dir):
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    listed = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return decontamination.scan(documents, benchmark, keep=("doc_id",)).select(
        "doc_id", "n_words", decontamination.n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(listed.cast("binary"), 256).alias("items_sha256"), decontamination.contaminated().alias("contaminated"),
    )


@query()
def op5_quality_rules(spark, sf_dir):
    found = quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", *quality.COUNTS, "base_failed", "kept", "score")


@query()
def op7_probminhash(spark, sf_dir):
    found = neardups.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_size", "group_id", "kept")


@query()
def op9_kneser_ney(spark, sf_dir):
    return perplexity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op3_toxicity(spark, sf_dir):
    found = toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=("doc_id",))
    return found.select("doc_id", held_out().alias("held_out"), "score", toxicity.rejected().cast("int").alias("predicted"))


@query()
def op10_personal_data(spark, sf_dir):
    found = pii.found_spans(table(spark, sf_dir, "documents"), keep=("doc_id",))
    base = F.filter("spans", lambda s: s["base"])

    def of(kind):
        return F.filter(base, lambda s: s["kind"] == kind)

    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in pii.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.listed(base).cast("binary"), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"))


def _crc32(text: str) -> str:
    """SQL for the unsigned crc32 of ASCII text, bit by bit."""
    step = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, b: {step}), 4294967295)"


def _planted(texts: pa.Array, ids: pa.Array) -> pa.Array:
    """The texts; in one of ten, by crc32 of the id, the words from some place on repeat a pattern."""
    out = []
    for text, doc_id in zip(texts.to_pylist(), ids.to_pylist()):
        h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and (words := re.findall(r"[^\x20\x09-\x0D]+", text or "")):
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text = " ".join(words[:a] + [words[a + i % p] for i in range(n - a)])
        out.append(text)
    return pa.array(out, pa.string())


# Pairs of equal words at lags of up to a third of the text; neighbouring pairs of one lag are a stretch. Of the
# stretches over the same words the smallest lag is the period.
@query(rf"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {_crc32("CAST(doc_id AS VARCHAR)")} AS h FROM documents),
cut AS (SELECT doc_id, w, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) ELSE len(w) END AS a, 3 + (h // 10) % 8 AS parts FROM doc),
word AS (SELECT doc_id, n, i, w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // parts) END] AS word
    FROM (SELECT *, unnest(range(n)) AS i FROM cut)),
pair AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM word x JOIN word y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
stretch AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS n
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pair) GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(24, 3 * q)),
run AS (SELECT * FROM stretch r WHERE NOT EXISTS (
    SELECT 1 FROM stretch o WHERE o.doc_id = r.doc_id AND o.q < r.q AND r.q % o.q = 0 AND o.s <= r.s AND o.s + o.n >= r.s + r.n)),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS runs FROM run GROUP BY doc_id),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY CAST(n AS DOUBLE) / q DESC, s, q) AS place FROM run),
dropped AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + n)) AS i FROM run),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS words FROM word ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(s AS BIGINT) AS start, CAST(n AS BIGINT) AS length, CAST(q AS BIGINT) AS period,
    CAST(1000 * n // q AS BIGINT) AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(words, '')) AS collapsed_sha256
FROM documents LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, s, n, q FROM best WHERE place = 1) USING (doc_id)
""")
def op13_periodic_runs(spark, sf_dir):
    found = with_computed(
        table(spark, sf_dir, "documents"), periodic.RUNS, lambda texts, ids: periodic.runs_of(_planted(texts, ids)), also=("doc_id",), keep=("doc_id",))
    run = periodic.strongest()
    return found.withColumn("run", run).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *(F.col(f"run.{k}") for k in ("start", "length", "period")),
        F.expr("1000 * run.length div run.period").alias("exponent_milli"), F.sha2(periodic.listed().cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def _leaf_sql(text: str) -> str:
    columns = (*_LEAF_COLUMNS[:-1], text)
    return "sha256(" + " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns) + ")"


# One recursion builds the trees of the languages, one the tree over them; a third folds each leaf upwards.
@query(f"""
WITH RECURSIVE leaf AS (
    SELECT doc_id, coalesce('=' || lang, '-') AS tree, {_leaf_sql("text")} AS leaf,
        CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN {_leaf_sql(f"translate(text, '{_UPPER}', '{_LOWER}')")} ELSE {_leaf_sql("text")} END AS claim
    FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaf),
node AS (
    SELECT tree, 0 AS level, pos, n, leaf AS h FROM placed
    UNION ALL SELECT tree, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM node WHERE n > 1 GROUP BY tree, level, pos // 8, n),
subroot AS (SELECT tree, level, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM node WHERE n = 1),
top AS (
    SELECT 0 AS level, pos, n, subroot AS h FROM subroot
    UNION ALL SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY level, pos // 8, n),
every AS (
    SELECT tree, level, pos, n, h FROM node WHERE n > 1
    UNION ALL SELECT s.tree, s.level + t.level, t.pos, t.n, t.h FROM subroot s, top t),
fold AS (
    SELECT p.doc_id, p.tree, p.leaf, 0 AS level, CASE WHEN p.n = 1 THEN s.pos ELSE p.pos END AS pos, p.claim AS h, '' AS siblings FROM placed p JOIN subroot s USING (tree)
    UNION ALL
    SELECT f.doc_id, f.tree, f.leaf, f.level + 1, CASE WHEN f.level + 1 = any_value(s.level) THEN any_value(s.pos) ELSE f.pos // 8 END,
        sha256(string_agg(CASE WHEN e.pos = f.pos THEN f.h ELSE e.h END, '' ORDER BY e.pos)),
        f.siblings || coalesce(string_agg(e.h, '' ORDER BY e.pos) FILTER (e.pos <> f.pos), '')
    FROM fold f JOIN every e ON e.tree = f.tree AND e.level = f.level AND e.pos // 8 = f.pos // 8 AND e.n > 1 JOIN subroot s ON s.tree = f.tree
    GROUP BY f.doc_id, f.tree, f.leaf, f.level, f.pos, f.h, f.siblings),
done AS (SELECT * FROM fold QUALIFY level = max(level) OVER (PARTITION BY tree, doc_id, leaf))
SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256, h AS folded_root, h = root AS verified
FROM done JOIN subroot USING (tree), (SELECT h AS root FROM top WHERE n = 1)
""")
def op11_merkle_manifest(spark, sf_dir):
    """Documents whose id's crc32 is divisible by 3 come back with their capitals lost; the rest as they were."""
    docs = table(spark, sf_dir, "documents")
    text = F.translate("text", _UPPER, _LOWER)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    claim = F.when(tampered, F.unhex(manifest.leaf(*_LEAF_COLUMNS[:-1], text)))
    found = manifest.Manifest(docs, _LEAF_COLUMNS, group="lang", key="doc_id", carry={"claim": claim}).proofs()

    def hexed(column):
        return F.lower(F.hex(column))

    folded = found.withColumn("folded_root", manifest.folded(hexed(F.coalesce("claim", "digest"))))
    return folded.select(
        F.col("key").alias("doc_id"), hexed("digest").alias("leaf"), hexed("subroot").alias("subroot"), hexed("root").alias("root"),
        F.sha2(F.col("siblings").cast("binary"), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == hexed("root")).alias("verified"),
    )


@query(f"""
WITH line AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS i
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS key FROM line),
common AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (SELECT k.*, c.key IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS gone FROM keyed k LEFT JOIN common c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""")
def op12_line_dedup(spark, sf_dir):
    found = linestore.without_common_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
