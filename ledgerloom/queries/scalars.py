"""Scalar functions over whole tables."""

from pyspark.sql import functions as F

from ledgerloom.functions import (
    blank_as_null,
    capped_text,
    day_text,
    joined_text,
    margin_percent,
    money,
    negate_unless,
    open_balance,
    parsed_day,
    ratio,
    tax_id_mask,
    to_other_currency,
    with_sign_of,
)
from ledgerloom.operators.joins import lookup, totals_by
from ledgerloom.queries.base import portable_sql, query, table
from ledgerloom.queries.joining import _RATES, amount, rated_orders

_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
_KEYS = ", ".join(_KEY)


@query("SELECT o_orderkey, coalesce(nullif(o_orderpriority, '5-LOW'), 'N') AS priority, coalesce(nullif(o_orderstatus, 'P'), nullif(o_orderpriority, '1-URGENT'), '-') AS state FROM orders")
def fn_coalesce(spark, sf_dir):
    low, status = F.nullif("o_orderpriority", F.lit("5-LOW")), F.nullif("o_orderstatus", F.lit("P"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.coalesce(low, F.lit("N")).alias("priority"),
        F.coalesce(status, F.nullif("o_orderpriority", F.lit("1-URGENT")), F.lit("-")).alias("state"))


_SIGNED = "CASE l_returnflag WHEN 'R' THEN -l_quantity WHEN 'A' THEN NULL ELSE l_quantity END"


@query(portable_sql(f"""SELECT {_KEYS}, CASE WHEN q < 0 THEN -v ELSE v END AS price FROM
(SELECT *, {_SIGNED} AS q, CAST(l_extendedprice AS DECIMAL(15,2)) AS v FROM lineitem) AS k""", "price"))
def fn_sign_transfer(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("q", F.expr(_SIGNED))
    return lines.select(*_KEY, with_sign_of("q", amount("l_extendedprice")).alias("price"))


@query(portable_sql(f"""SELECT {_KEYS}, v * CASE WHEN flag = 'A' THEN 1 ELSE -1 END AS quantity FROM (SELECT {_KEYS}, CAST(l_quantity AS DECIMAL(15,2)) AS v,
CASE substr(o_orderpriority, 1, 1) WHEN '4' THEN NULL WHEN '2' THEN 'B' WHEN '5' THEN 'B' ELSE 'A' END AS flag
FROM lineitem JOIN orders ON o_orderkey = l_orderkey) AS k""", "quantity"))
def fn_negate_by_flag(spark, sf_dir):
    code = F.substring("o_orderpriority", 1, 1)
    flag = F.when(code == "4", None).when(code.isin("2", "5"), "B").otherwise("A")
    lines = lookup(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"), {"l_orderkey": "o_orderkey"}, {"flag": flag}, "inner")
    return lines.select(*_KEY, negate_unless("flag", "A", amount("l_quantity")).alias("quantity"))


@query(portable_sql(f"""SELECT {_KEYS}, CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(15,2))) AS DECIMAL(16,2)) AS net
FROM lineitem""", "net"))
def fn_decimal_round(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(*_KEY, money(amount("l_extendedprice") * (1 - amount("l_discount"))).alias("net"))


@query(portable_sql(f"""SELECT {_KEYS}, CASE WHEN v = 0 THEN 0 ELSE sign(v - c) * ((2 * abs(v - c) * 10000 + v) // (2 * v)) / 100.0 END AS margin FROM (
SELECT {_KEYS}, CAST(CASE WHEN l_discount = 0 THEN 0 ELSE l_extendedprice * 100 END AS DECIMAL(18,0))::HUGEINT AS v, CAST(p_retailprice * 100 AS DECIMAL(18,0))::HUGEINT AS c
FROM lineitem JOIN part ON p_partkey = l_partkey) AS k""", "margin"))
def fn_margin_pct(spark, sf_dir):
    lines = lookup(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part"), {"l_partkey": "p_partkey"}, {"cost": amount("p_retailprice")}, "inner")
    price = F.when(F.col("l_discount") == 0, F.lit(0).cast("decimal(15,2)")).otherwise(amount("l_extendedprice"))
    return lines.select(*_KEY, margin_percent(price, "cost").alias("margin"))


@query(f"""WITH rates AS ({_RATES}) SELECT o_orderkey, o_totalprice / coalesce(rate, 1) AS other_total FROM orders
LEFT JOIN rates ON priority = o_orderpriority AND on_day = CAST(o_orderdate AS DATE)""")
def fn_fx_convert(spark, sf_dir):
    return rated_orders(spark, sf_dir).select("o_orderkey", to_other_currency("o_totalprice", "rate").alias("other_total"))


@query(portable_sql("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN ordered - lost - sent ELSE ordered - lost - coalesce(returned, 0) - coalesce(sent, 0) END AS balance
FROM orders JOIN (SELECT l_orderkey, sum(CAST(l_quantity AS DECIMAL(15,2))) AS ordered, sum(CAST(l_tax * 100 AS DECIMAL(15,2))) AS lost,
  sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS DECIMAL(15,2)) END) AS returned,
  sum(CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS DECIMAL(15,2)) END) AS sent FROM lineitem GROUP BY 1) AS k ON l_orderkey = o_orderkey""", "balance"))
def fn_open_balance(spark, sf_dir):
    quantity = amount("l_quantity")
    sums = totals_by(
        table(spark, sf_dir, "lineitem"), ["l_orderkey"], ordered=F.sum(quantity), lost=F.sum((F.col("l_tax") * 100).cast("decimal(15,2)")),
        returned=F.sum(F.when(F.col("l_returnflag") == "R", quantity)), sent=F.sum(F.when(F.col("l_linestatus") == "F", quantity)))
    joined = lookup(table(spark, sf_dir, "orders"), sums, {"o_orderkey": "l_orderkey"},
                    {c: c for c in ("ordered", "lost", "returned", "sent")}, "inner")
    return joined.select("o_orderkey", open_balance(F.col("o_orderstatus") == "F", "ordered", "lost", "returned", "sent", "sent").alias("balance"))


@query("SELECT p_partkey, coalesce(nullif(p_type, 'PROMO'), '') || '-' || coalesce(CAST(nullif(p_size, 7) AS VARCHAR), '') AS label FROM part")
def fn_concat_oracle(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", joined_text(F.nullif("p_type", F.lit("PROMO")), F.lit("-"), F.nullif("p_size", F.lit(7))).alias("label"))


@query("SELECT p_partkey, upper(p_name || ' físico não disponível ção') AS label FROM part")
def fn_upper(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.upper(F.concat("p_name", F.lit(" físico não disponível ção"))).alias("label"))


@query("SELECT c_custkey, lpad(CAST(c_custkey * 7919 AS VARCHAR), 5, '0') AS padded, lpad(c_name, 14, '0') AS cut FROM customer")
def fn_lpad(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.lpad((F.col("c_custkey") * 7919).cast("string"), 5, "0").alias("padded"), F.lpad("c_name", 14, "0").alias("cut"))


_NUMBER = "CASE WHEN c_acctbal < 0 THEN 'X' || CAST(c_custkey AS STRING) ELSE CAST(c_custkey * 918273645 + c_nationkey AS STRING) END"
_KIND = "CASE c_mktsegment WHEN 'BUILDING' THEN 'J' WHEN 'MACHINERY' THEN 'J' WHEN 'FURNITURE' THEN 'Z' ELSE 'F' END"


@query(rf"""SELECT c_custkey, CASE kind WHEN 'J' THEN regexp_replace(lpad(number, 14, '0'), '^(..)(\d{{3}})(\d{{3}})(\d{{4}})(\d\d)$', '\1.\2.\3/\4-\5')
WHEN 'F' THEN regexp_replace(lpad(number, 11, '0'), '^(\d{{3}})(\d{{3}})(\d{{3}})(\d\d)$', '\1.\2.\3-\4') END AS tax_id
FROM (SELECT c_custkey, {_KIND} AS kind, {_NUMBER} AS number FROM customer) AS k""")
def fn_tax_id_mask(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.expr(_KIND).alias("kind"), F.expr(_NUMBER).alias("number"))
    return customers.select("c_custkey", tax_id_mask("kind", "number").alias("tax_id"))


@query("SELECT o_orderkey, strftime(CAST(strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y') AS DATE), '%Y-%m-%d') AS on_day FROM orders")
def fn_to_date(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", parsed_day(day_text("o_orderdate")).alias("on_day"))


@query("SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) + CAST(o_custkey % 90 AS INT), '%Y-%m-%d') AS due FROM orders")
def fn_date_add(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_custkey") % 90).cast("int")).alias("due"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS on_day FROM orders")
def fn_date_format(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", day_text("o_orderdate").alias("on_day"))


@query("SELECT doc_id, CAST(length(substr(text, 1, 4000)) AS BIGINT) AS kept, substr(text, 1, 4000) AS note FROM documents")
def fn_truncate_text(spark, sf_dir):
    note = capped_text("text", 4000)
    return table(spark, sf_dir, "documents").select("doc_id", F.length(note).cast("bigint").alias("kept"), note.alias("note"))


@query(f"""SELECT {_KEYS}, l_quantity + l_linenumber AS plus, l_quantity - l_tax AS less, l_quantity * l_extendedprice AS times,
l_extendedprice / nullif(l_tax, 0) AS over FROM lineitem""")
def fn_arith(spark, sf_dir):
    q, p, t = F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_tax")
    return table(spark, sf_dir, "lineitem").select(
        *_KEY, (q + F.col("l_linenumber")).alias("plus"), (q - t).alias("less"), (q * p).alias("times"), ratio(p, t).alias("over"))


@query("SELECT doc_id, CASE WHEN lang IN ('en', 'fr') THEN lang END AS lang, coalesce(CASE WHEN lang IN ('en', 'fr') THEN lang END, 'N') AS filled FROM documents")
def fn_empty_as_null(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("lang").isin("en", "fr"), F.col("lang")).otherwise("").alias("raw"))
    return docs.select("doc_id", blank_as_null("raw").alias("lang"), F.coalesce(blank_as_null("raw"), F.lit("N")).alias("filled"))
