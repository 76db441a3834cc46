"""Sources, sinks, transforms and data checks over whole tables."""

from uuid import uuid4

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import nan_as_null, to_integer, to_number
from ledgerloom.functions.text import qualified_names, scrubbed, selected_name, target_name
from ledgerloom.operators.quality import (
    TYPE_MAP,
    access_check,
    access_report,
    aligned,
    clean_names,
    column_profile,
    decimals_to_double,
    invalid_texts,
    mapped_types,
    missing_fields,
    missing_objects,
    references,
    run_totals,
    schema_drift,
    validated,
    validation_report,
)
from ledgerloom.plans.registry import refresh
from ledgerloom.queries.base import portable_sql, query, table
from ledgerloom.queries.joining import amount
from ledgerloom.session import work_folder
from ledgerloom.sinks.tables import append, content_check, full_refresh, load, prepared, roll_back, table_info, version_rows
from ledgerloom.sources.scripts import run_script

_SCAN = """SELECT l_returnflag, l_linestatus, sum(CAST(l_quantity AS DECIMAL(15,2))) AS quantity, count(*) AS n
FROM {lines} GROUP BY l_returnflag, l_linestatus"""


def _sql_text(value):
    return f"'{value}'" if value else "CAST(NULL AS VARCHAR)"


def target(spark, name):
    """A table name of its own for each run, and the folder its versions go to."""
    return f"{name}_{uuid4().hex[:12]}", work_folder(spark)


@query(portable_sql(_SCAN.format(lines="lineitem"), "quantity"))
def src_query_scan(spark, sf_dir):
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("scanned_lines")
    return run_script(spark, "-- whole result of a query text\n" + _SCAN.format(lines="scanned_lines") + ";\n")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def src_scan_project(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


_SUFFIXES = [".html", "#top", "/"]
_IGNORED = [r"^http://blog.*/$", r".*_test\.html$", r"^HTTPS://M\..*#top$", r".*/de/.*\.html$", r".*\.bak\.html$"]


@query(f"""SELECT page_id, url FROM pages WHERE ({' OR '.join(f"suffix(url, '{s}')" for s in _SUFFIXES)})
AND NOT ({' OR '.join(f"regexp_matches(url, '{p}', 'i')" for p in _IGNORED)})""")
def src_name_filter(spark, sf_dir):
    return table(spark, sf_dir, "pages").where(selected_name("url", _SUFFIXES, _IGNORED)).select("page_id", "url")


@query("""SELECT page_id, lower('STG_' || CASE WHEN strpos(name, '.') > 1 THEN regexp_replace(name, '\\.[^.]+$', '') ELSE name END || '_X') AS table_name
FROM (SELECT page_id, list_extract(string_split(rtrim(url, '/'), '/'), -1) AS name FROM pages) AS k""")
def src_target_name(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", target_name("url", "STG_", "_X").alias("table_name"))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal >= 0")
def sink_full_refresh(spark, sf_dir):
    """First load with all customers, then a refresh with those that are not in debt."""
    name, folder = target(spark, "customers")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    full_refresh(rows, name, folder)
    full_refresh(rows.where("c_acctbal >= 0"), name, folder)
    return spark.table(name)


@query("SELECT c_custkey, c_name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def sink_append(spark, sf_dir):
    name, folder = target(spark, "partners")
    full_refresh(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), name, folder)
    append(table(spark, sf_dir, "supplier").select(F.col("s_name").alias("c_name"), F.col("s_suppkey").alias("c_custkey")), name)
    return spark.table(name)


@query("""SELECT c_custkey, c_name, 'c' AS kind FROM customer UNION ALL SELECT s_suppkey, s_name, 's' FROM supplier""")
def sink_append_once(spark, sf_dir):
    """Two batches, each sent twice; and one whose job dies between writing and entering it, sent again."""
    name, folder = target(spark, "partners")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.lit("c").alias("kind"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"), F.lit("s").alias("kind"))
    for rows, batch in ((customers, "customers"), (customers, "customers")):
        load(rows, name, folder, "append", batch=batch)
    prepared(suppliers, name, "suppliers")
    for _ in range(2):
        append(suppliers, name, "suppliers")
    return spark.table(name)


@query("""SELECT c_custkey, 'now' AS version FROM customer WHERE c_acctbal >= 0 UNION ALL SELECT c_custkey, 'before' FROM customer WHERE c_acctbal < 0
UNION ALL SELECT c_custkey, 'first' FROM customer""")
def sink_roll_back(spark, sf_dir):
    """Three versions, the third gone back from; the first is still there to be read."""
    name, folder = target(spark, "customers")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    for condition in ("true", "c_acctbal < 0", "c_acctbal IS NULL"):
        full_refresh(rows.where(condition), name, folder)
    roll_back(spark, name)
    full_refresh(rows.where("c_acctbal >= 0"), name, folder, retain=4)
    shown = {"now": spark.table(name), "before": version_rows(spark, name, 1), "first": version_rows(spark, name, 3)}
    parts = [df.select("c_custkey", F.lit(version).alias("version")) for version, df in shown.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("SELECT c_custkey, c_name FROM customer WHERE c_acctbal IS NULL")
def sink_empty_refresh(spark, sf_dir):
    """A refresh that finds no rows leaves an empty table with the same columns."""
    name, folder = target(spark, "customers")
    rows = table(spark, sf_dir, "customer")
    full_refresh(rows.select("c_custkey", "c_name"), name, folder)
    full_refresh(rows.where("c_acctbal IS NULL").select("c_custkey", "c_name"), name, folder)
    return spark.table(name)


@query("""SELECT (SELECT count(*) FROM orders) AS row_count, CAST(position AS INT) AS position, column_name, column_type FROM (VALUES
(1, 'o_orderkey', 'bigint'), (2, 'o_custkey', 'bigint'), (3, 'o_orderstatus', 'string'), (4, 'o_totalprice', 'double'),
(5, 'o_orderdate', 'timestamp_ntz'), (6, 'o_orderpriority', 'string')) AS k (position, column_name, column_type)""")
def sink_table_info(spark, sf_dir):
    name, folder = target(spark, "orders")
    full_refresh(table(spark, sf_dir, "orders"), name, folder)
    return table_info(spark, name)


@query("""SELECT (SELECT count(*) FROM customer) AS extracted, (SELECT count(*) FROM customer) AS loaded, true AS consistent, true AS content_consistent""")
def dq_refresh_counts(spark, sf_dir):
    """Rows and content as they were written against what is read back."""
    name, folder = target(spark, "customers")
    full_refresh(table(spark, sf_dir, "customer"), name, folder)
    return content_check(spark, name).select(
        F.col("rows_written").alias("extracted"), F.col("rows_read").alias("loaded"), F.col("count_consistent").alias("consistent"), "content_consistent")


# Column, stored type, incoming type, change, and a condition for values that the stored type changes.
_DRIFT = [
    ("l_orderkey", "bigint", "bigint", "same", "false"), ("l_linenumber", "bigint", "int", "narrower", "false"),
    ("l_quantity", "decimal(10,0)", "decimal(15,2)", "wider", "CAST(l_quantity AS DECIMAL(15,2)) <> round(CAST(l_quantity AS DECIMAL(15,2)))"),
    ("l_extendedprice", "decimal(15,1)", "decimal(15,2)", "wider", "CAST(l_extendedprice AS DECIMAL(15,2)) <> round(CAST(l_extendedprice AS DECIMAL(15,2)), 1)"),
    ("l_partkey", "int", "bigint", "wider", "false"), ("l_returnflag", "string", "string", "same", "false"),
    ("l_suppkey", None, "bigint", "added", "false"), ("l_gone", "string", None, "lost", "false")]


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, {_sql_text(stored)} AS declared_type, {_sql_text(stored)} AS stored_type, {_sql_text(come)} AS incoming_type,
'{change}' AS change, count(*) FILTER ({changes}) AS changed_values FROM lineitem""" for c, stored, come, change, changes in _DRIFT))
def dq_schema_drift(spark, sf_dir):
    """Lines as they come against the structure they are stored in."""
    lines = table(spark, sf_dir, "lineitem").select(*[F.col(c).cast(come).alias(c) for c, _, come, _, _ in _DRIFT if come])
    stored = T.StructType.fromDDL(", ".join(f"{c} {kind}" for c, kind, *_ in _DRIFT if kind))
    return schema_drift(lines, stored)


_RUN = "region nation customer supplier part orders lineitem events".split()


@query(f"""SELECT sum(CASE WHEN n > 100 THEN 1 ELSE 0 END)::BIGINT AS processed, count(*) AS total, sum(CASE WHEN n > 100 THEN n ELSE 0 END)::BIGINT AS records,
sum(CASE WHEN n > 100 THEN 0 ELSE 1 END)::BIGINT AS errors, true AS timed, min(n) > 100 AS success, sum(CASE WHEN n > 100 THEN 1 ELSE 0 END)::DOUBLE * 100 / count(*) AS success_rate
FROM ({' UNION ALL '.join(f'SELECT count(*) AS n FROM {t}' for t in _RUN)}) AS k""")
def run_report(spark, sf_dir):
    """Totals of a refresh of eight tables; those of at most 100 rows count as not delivered, an error."""

    def delivered(name):
        rows = table(spark, sf_dir, name)
        if rows.limit(101).count() <= 100:
            raise ValueError(f"{name} has too few rows")
        return rows

    mark, folder = target(spark, "run")
    runs = refresh(spark, [(f"{t}_{mark}", lambda t=t: delivered(t)) for t in _RUN], folder)
    return run_totals(runs).withColumn("timed", F.col("seconds") > 0).drop("seconds")


@query("SELECT p_partkey AS p_partkey, p_name AS part_name, p_brand AS p_brand_, p_size AS size__cm_ FROM part")
def tr_clean_names(spark, sf_dir):
    return clean_names(table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias(" P-PartKey "), F.col("p_name").alias("Part Name"), F.col("p_brand").alias("P_Brand*"),
        F.col("p_size").alias("Size (cm)")))


def _profile_sql(columns: dict[str, tuple[str, str]]) -> str:
    rows = []
    for name, (source, target_type) in columns.items():
        is_text, is_number = source == "string", source in ("bigint", "double")
        value = f"nullif({name}, '5-LOW')" if name == "o_orderpriority" else name
        numbers = f"count(TRY_CAST({value} AS DOUBLE))" if is_text or is_number else "CAST(0 AS BIGINT)"
        longest = f"CAST(max(length({value})) AS BIGINT)" if is_text else "CAST(NULL AS BIGINT)"
        rows.append(f"SELECT '{name}' AS column_name, '{source}' AS source_type, '{target_type}' AS target_type, {longest} AS longest, "
                    f"count(*) - count({value}) AS nulls, {numbers} AS numbers, "
                    f"{f'CAST(least(greatest(coalesce({longest}, 0), 50) * 2, 4000) AS BIGINT)' if is_text else 'CAST(NULL AS BIGINT)'} AS width FROM orders")
    return " UNION ALL ".join(rows)


@query(_profile_sql({
    "o_orderkey": ("bigint", "BIGINT"), "o_custkey": ("bigint", "BIGINT"), "o_orderstatus": ("string", "TEXT"),
    "o_totalprice": ("double", "DOUBLE PRECISION"), "o_orderdate": ("timestamp_ntz", "TIMESTAMP"), "o_orderpriority": ("string", "TEXT")}))
def tr_column_profile(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return column_profile(orders.withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW"))))


_MIXED = """CASE event_type WHEN 'click' THEN '90071992547409' || lpad(k, 3, '0') WHEN 'error' THEN event_type WHEN 'purchase' THEN k || '.75'
WHEN 'view' THEN ' ' || k ELSE k || 'e2' END"""


@query(f"""SELECT event_id, TRY_CAST(v AS DOUBLE) AS number,
TRY_CAST(trunc(TRY_CAST(v AS DECIMAL(38,4))) AS BIGINT) AS whole FROM
(SELECT event_id, {_MIXED} AS v FROM (SELECT event_id, event_type, regexp_extract(props, '[0-9]+') AS k FROM events) AS a) AS b""")
def tr_to_numeric(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", F.get_json_object("props", "$.k").alias("k"))
    events = events.select("event_id", F.expr(_MIXED).alias("v"))
    return events.select("event_id", to_number("v").alias("number"), to_integer("v").alias("whole"))


_DECLARED = """CASE p_type WHEN 'ECONOMY' THEN 'NUMBER' WHEN 'STANDARD' THEN 'VARCHAR2' WHEN 'LARGE' THEN 'TIMESTAMP WITH TIME ZONE'
WHEN 'SMALL' THEN 'CLOB' WHEN 'MEDIUM' THEN 'ROWID' ELSE 'XMLTYPE' END"""


@query(f"""SELECT p_partkey, declared, CASE declared {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in TYPE_MAP.items())} END AS stored
FROM (SELECT p_partkey, {_DECLARED} AS declared FROM part) AS k""")
def tr_type_map(spark, sf_dir):
    return mapped_types(table(spark, sf_dir, "part").select("p_partkey", F.expr(_DECLARED).alias("declared")), "declared", "stored")


_TEXT = "CASE event_type WHEN 'error' THEN 'nan' WHEN 'view' THEN 'None' WHEN 'click' THEN NULL ELSE event_type END"


@query(f"SELECT event_id, CASE WHEN v <> 'nan' THEN v END AS label FROM (SELECT event_id, {_TEXT} AS v FROM events) AS k")
def tr_nan_to_null(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.expr(_TEXT).alias("v"))
    return events.select("event_id", nan_as_null("v").alias("label"))


_SCRIPT = r"""'-- source ' || source || chr(10) || 'Set ECHO off; /* ' || lang || chr(10) || ' */ SPOOL x.lst;' || chr(10) || '  ' || chr(10)
|| text || chr(10) || 'prompt done; SELECT 1 -- end'"""


@query(rf"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
{_SCRIPT}, '--[^\n]*', '', 'g'), '/\*(?s:.*?)\*/', '', 'g'), '(?i:SET)\s+[\p{{L}}\p{{N}}_]+[^\n]*?;', '', 'g'), '(?i:WHENEVER)\s+[^\n]*?;', '', 'g'),
'(?i:SPOOL)\s+[^\n]*?;', '', 'g'), '(?i:PROMPT)\s+[^\n]*?;', '', 'g'), '\n\s*\n', chr(10), 'g'), '^\s+|\s+$', '', 'g') AS script FROM documents""")
def tr_text_scrub(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", scrubbed(F.expr(_SCRIPT)).alias("script"))


_CHECKED = "CASE source WHEN 'src0' THEN NULL WHEN 'src1' THEN '' WHEN 'src2' THEN ' ' || chr(10) || chr(9) ELSE text END"
_MESSAGE = r"""CASE WHEN t IS NULL THEN 'missing' WHEN t = '' THEN 'empty' WHEN regexp_full_match(t, '\s*') THEN 'blank'
WHEN NOT list_contains(regexp_extract_all(lower(t), '[\p{L}\p{N}_]+'), 'the') THEN 'no keyword' ELSE 'ok' END"""


@query(f"""SELECT doc_id, message, message = 'ok' AS valid, round_even(strlen(t) / 1024.0::DOUBLE, 2) AS size_kb
FROM (SELECT doc_id, t, {_MESSAGE} AS message FROM (SELECT doc_id, {_CHECKED} AS t FROM documents) AS a) AS b""")
def dq_validate_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.expr(_CHECKED).alias("t"))
    return validated(docs, "t", "the").drop("t")


@query(portable_sql(f"""SELECT message, message = 'ok' AS valid, count(*) AS texts, coalesce(sum(CAST(round_even(strlen(t) / 1024.0::DOUBLE, 2) AS DECIMAL(18,2))), 0) AS size_kb
FROM (SELECT t, {_MESSAGE} AS message FROM (SELECT {_CHECKED} AS t FROM documents) AS a) AS b GROUP BY 1, 2""", "size_kb"))
def dq_validation_report(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.expr(_CHECKED).alias("t"))
    return validation_report(docs, "t", "the")


@query(f"""SELECT doc_id, message, round_even(strlen(t) / 1024.0::DOUBLE, 2) AS size_kb
FROM (SELECT doc_id, t, {_MESSAGE} AS message FROM (SELECT doc_id, {_CHECKED} AS t FROM documents) AS a) AS b WHERE message <> 'ok'""")
def dq_invalid_texts(spark, sf_dir):
    return invalid_texts(table(spark, sf_dir, "documents").select("doc_id", F.expr(_CHECKED).alias("t")), "t", "the")


_KINDS = {"links": [r'href="/?([^"]+)"'], "styles": [r'class="([^"]+)"', r"<([a-z]+)[^>]*>"]}
_REFS = r"""SELECT DISTINCT kind, name FROM (
SELECT 'links' AS kind, unnest(regexp_extract_all(html, 'href="/?([^"]+)"', 1)) AS name FROM pages
UNION ALL SELECT 'styles', unnest(regexp_extract_all(html, 'class="([^"]+)"', 1)) FROM pages
UNION ALL SELECT 'styles', unnest(regexp_extract_all(html, '<([a-z]+)[^>]*>', 1)) FROM pages) AS k"""
_WORD = r"[\p{L}]+"
_CATALOG = rf"""SELECT DISTINCT 'TABLE' AS kind, unnest(regexp_extract_all(text, '{_WORD}')) AS name FROM benchmark
UNION ALL SELECT DISTINCT 'FUNCTION', unnest(regexp_extract_all(text, '{_WORD}')) FROM conversations
UNION ALL SELECT DISTINCT 'VIEW', unnest(regexp_extract_all(text, '{_WORD}')) FROM documents"""
_ACCESS = f"""SELECT r.name AS object_name, r.kind AS requested_type, found_type IS NOT NULL AS has_access, found_type
FROM ({_REFS}) r LEFT JOIN (SELECT lower(name) AS name, CASE min(CASE kind WHEN 'TABLE' THEN 1 WHEN 'VIEW' THEN 2 ELSE 3 END) WHEN 1 THEN 'TABLE' WHEN 2 THEN 'VIEW' ELSE 'FUNCTION' END AS found_type
FROM ({_CATALOG}) AS c GROUP BY lower(name)) k ON k.name = lower(r.name)"""


def page_references(spark, sf_dir):
    return references(table(spark, sf_dir, "pages"), "html", _KINDS)


def word_catalog(spark, sf_dir):
    """Objects the references may name: words of three tables, each standing for one kind."""
    word = f"({_WORD})"
    found = references(table(spark, sf_dir, "benchmark"), "text", {"TABLE": [word]})
    found = found.unionByName(references(table(spark, sf_dir, "conversations"), "text", {"FUNCTION": [word]}))
    return found.unionByName(references(table(spark, sf_dir, "documents"), "text", {"VIEW": [word]}))


@query(_REFS)
def dq_extract_refs(spark, sf_dir):
    return page_references(spark, sf_dir)


@query(_ACCESS)
def dq_access_check(spark, sf_dir):
    return access_check(page_references(spark, sf_dir), word_catalog(spark, sf_dir))


@query(f"""SELECT CASE WHEN grouping(requested_type) = 1 THEN 'all' ELSE requested_type END AS requested_type, count(*) AS total,
count(*) FILTER (has_access) AS accessible, count(*) FILTER (NOT has_access) AS missing, bool_and(has_access) AS complete
FROM ({_ACCESS}) AS k GROUP BY ROLLUP (requested_type)""")
def dq_access_report(spark, sf_dir):
    return access_report(access_check(page_references(spark, sf_dir), word_catalog(spark, sf_dir)))


@query(f"SELECT requested_type, object_name FROM ({_ACCESS}) AS k WHERE NOT has_access")
def dq_missing_objects(spark, sf_dir):
    return missing_objects(access_check(page_references(spark, sf_dir), word_catalog(spark, sf_dir)))


_NAMES = ["the", "of", "de", "la", "and"]


@query(rf"""SELECT doc_id, array_to_string(list_transform(words, lambda w, i: CASE WHEN w IN ({', '.join(f"'{n}'" for n in _NAMES)})
AND NOT (i > 2 AND words[i - 1] = '.' AND words[i - 2] = 'erp') THEN 'erp.' || w ELSE w END), '') AS text
FROM (SELECT doc_id, regexp_extract_all('erp.the ' || text || ' erp.of', '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]') AS words FROM documents) AS k""")
def tr_qualify_refs(spark, sf_dir):
    text = F.concat(F.lit("erp.the "), F.col("text"), F.lit(" erp.of"))
    return table(spark, sf_dir, "documents").select("doc_id", qualified_names(text, "erp", _NAMES).alias("text"))


@query("""SELECT c_custkey, concat_ws(';', CASE WHEN c_mktsegment = 'BUILDING' THEN 'c_mktsegment' END, CASE WHEN c_acctbal < 0 THEN 'c_acctbal' END,
CASE WHEN c_nationkey = 7 THEN 'c_name' END) AS missing FROM customer""")
def dq_missing_fields(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_nationkey") == 7, "").otherwise(F.col("c_name")).alias("c_name"))
    return missing_fields(customers, ["c_mktsegment", "c_acctbal", "c_name"], "missing").select("c_custkey", "missing")


@query("SELECT s_nationkey::BIGINT AS nation, s_suppkey AS code, s_name AS name FROM supplier")
def tr_align_to_target(spark, sf_dir):
    wanted = spark.createDataFrame([], "nation bigint, code bigint, name string").schema
    return aligned(table(spark, sf_dir, "supplier"), wanted, ["code", "name", "nation", "balance"])


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_tax AS DECIMAL(15,2)) AS DOUBLE) AS tax FROM lineitem")
def tr_decimal_to_double(spark, sf_dir):
    return decimals_to_double(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", (amount("l_extendedprice") * amount("l_tax")).alias("tax")))
