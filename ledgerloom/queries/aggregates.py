"""Aggregates, ordered picks, set operations and subqueries over whole tables."""

from pyspark.sql import functions as F

from ledgerloom.functions import day_text, last_or_open, ratio
from ledgerloom.operators.joins import (
    distinct_union,
    latest_by,
    lookup,
    share_of_total,
    total_order,
    totals_by,
)
from ledgerloom.operators.lists import counted_values, joined_list, list_text
from ledgerloom.operators.quality import varchar_widths
from ledgerloom.queries.base import portable_sql, query, table
from ledgerloom.queries.joining import amount

# Ship day, missing for the lines with a tax of two percent.
_DAY = "CASE WHEN l_tax = 0.02 THEN NULL ELSE CAST(l_shipdate AS DATE) END"


def due_lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").withColumn("due", F.expr(_DAY))


@query(portable_sql("""SELECT l_orderkey, l_partkey, l_suppkey, l_linestatus, sum(CAST(l_quantity AS DECIMAL(15,2))) AS quantity,
sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS DECIMAL(15,2)) ELSE 0 END) AS returned,
sum(CASE WHEN l_tax = 0 THEN 0 ELSE CAST(l_tax * 100 AS DECIMAL(15,2)) END) AS tax FROM lineitem GROUP BY ALL""", "quantity returned tax"))
def agg_sum(spark, sf_dir):
    zero = F.lit(0)
    returned = F.when(F.col("l_returnflag") == "R", amount("l_quantity"))
    tax = F.when(F.col("l_tax") != 0, (F.col("l_tax") * 100).cast("decimal(15,2)"))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_partkey", "l_suppkey", "l_linestatus").agg(
        F.sum(amount("l_quantity")).alias("quantity"), F.sum(F.coalesce(returned, zero)).alias("returned"),
        F.sum(F.coalesce(tax, zero)).alias("tax"))


@query("SELECT l_orderkey, l_partkey, min(l_suppkey) AS lowest, min(l_linenumber) AS line FROM lineitem GROUP BY ALL")
def agg_min(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_partkey").agg(
        F.min("l_suppkey").alias("lowest"), F.min("l_linenumber").alias("line"))


@query(f"""SELECT l_orderkey, string_agg(strftime(due, '%d/%m/%Y'), ';' ORDER BY due) AS days
FROM (SELECT l_orderkey, {_DAY} AS due FROM lineitem) AS k GROUP BY 1""")
def agg_listagg(spark, sf_dir):
    return joined_list(due_lines(spark, sf_dir), ["l_orderkey"], "due", "days", day_text)


@query("""SELECT o_orderpriority, string_agg(label, ';' ORDER BY label) AS labels FROM (
SELECT DISTINCT o_orderpriority, CASE l_returnflag WHEN 'A' THEN '1-ACCEPTED' WHEN 'R' THEN '2-RETURNED' END AS label
FROM lineitem JOIN orders ON o_orderkey = l_orderkey) AS k GROUP BY 1""")
def agg_listagg_distinct(spark, sf_dir):
    flags = F.when(F.col("l_returnflag") == "A", "1-ACCEPTED").when(F.col("l_returnflag") == "R", "2-RETURNED")
    lines = lookup(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"), {"l_orderkey": "o_orderkey"},
                   {"o_orderpriority": "o_orderpriority"}, "inner")
    return joined_list(lines.withColumn("label", flags), ["o_orderpriority"], "label", "labels", distinct=True)


@query("SELECT l_partkey, l_suppkey, l_returnflag FROM lineitem GROUP BY ALL")
def agg_distinct(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag").distinct()


@query(portable_sql(f"""SELECT l_orderkey, min(due) AS first_due, CASE WHEN bool_and(due IS NOT NULL) THEN max(due) END AS last_due
FROM (SELECT l_orderkey, {_DAY} AS due FROM lineitem) AS k GROUP BY 1""", "", "first_due last_due"))
def agg_first_last_date(spark, sf_dir):
    return due_lines(spark, sf_dir).groupBy("l_orderkey").agg(
        F.min("due").alias("first_due"), last_or_open("due").alias("last_due"))


@query("SELECT count(*) AS n FROM lineitem")
def agg_count(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n"))


def _width_sql(name: str, columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, CAST(max(length({c})) AS BIGINT) AS longest, "
        f"CAST(least(greatest(max(length({c})), 50) * 2, 4000) AS BIGINT) AS width FROM {name}" for c in columns.split())


@query(" UNION ALL ".join([
    _width_sql("customer", "c_name c_mktsegment"), _width_sql("part", "p_name p_brand p_type"), _width_sql("supplier", "s_name"),
    _width_sql("documents", "text lang source")]))
def agg_varchar_width(spark, sf_dir):
    shown = [
        varchar_widths(table(spark, sf_dir, name)).select(F.lit(name).alias("table_name"), "column_name", "longest", "width")
        for name in ("customer", "part", "supplier", "documents")
    ]
    return shown[0].unionByName(shown[1]).unionByName(shown[2]).unionByName(shown[3])


@query(portable_sql("""SELECT l_partkey, price, o_orderkey FROM (
SELECT l_partkey, CAST(l_extendedprice AS DECIMAL(15,2)) AS price, o_orderkey, row_number() OVER (PARTITION BY l_partkey
  ORDER BY nullif(o_orderpriority, '1-URGENT') DESC NULLS FIRST, o_orderdate DESC NULLS FIRST, o_orderkey DESC, l_extendedprice DESC) AS place
FROM lineitem JOIN orders ON o_orderkey = l_orderkey) AS k WHERE place = 1""", "price"))
def topk_last_price(spark, sf_dir):
    lines = lookup(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice"), table(spark, sf_dir, "orders"),
                   {"l_orderkey": "o_orderkey"},
                   {"o_orderkey": "o_orderkey", "on_day": "o_orderdate", "urgency": F.nullif(F.left("o_orderpriority", F.lit(1)).cast("int"), F.lit(1))}, "inner")
    return latest_by(lines, ["l_partkey"], ["urgency", "on_day", "o_orderkey", "l_extendedprice"],
                     price=amount("l_extendedprice"), o_orderkey="o_orderkey")


@query(portable_sql(f"""SELECT l_suppkey, first_due, last_due FROM
(SELECT l_suppkey, due AS first_due, row_number() OVER (PARTITION BY l_suppkey ORDER BY due ASC NULLS LAST) AS a FROM (SELECT l_suppkey, {_DAY} AS due FROM lineitem) AS k) AS x
JOIN (SELECT l_suppkey, due AS last_due, row_number() OVER (PARTITION BY l_suppkey ORDER BY due DESC NULLS FIRST) AS z FROM (SELECT l_suppkey, {_DAY} AS due FROM lineitem) AS k) AS y
USING (l_suppkey) WHERE a = 1 AND z = 1""", "", "first_due last_due"))
def topk_first_last(spark, sf_dir):
    return due_lines(spark, sf_dir).groupBy("l_suppkey").agg(F.min("due").alias("first_due"), last_or_open("due").alias("last_due"))


_GROUP = "CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_suppkey END"
_QTY = "CASE WHEN l_quantity = 50 THEN NULL ELSE CAST(l_quantity - 1 AS DECIMAL(15,2)) END"


@query(f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN g IS NOT NULL AND l_orderkey IS NOT NULL THEN
CAST(q AS DOUBLE) / nullif(CAST(sum(coalesce(q, 0)) OVER (PARTITION BY l_orderkey, g) AS DOUBLE), 0) END AS part_of_total
FROM (SELECT *, {_GROUP} AS g, {_QTY} AS q FROM lineitem) AS k""")
def win_share_of_total(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("g", F.expr(_GROUP)).withColumn("q", F.expr(_QTY))
    lines = lines.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "g", "q")
    return share_of_total(lines, ["l_orderkey", "g"], "q", "part_of_total").drop("g", "q")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def limit_n(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)


@query("SELECT p_type, p_size, p_name, p_partkey FROM part ORDER BY ALL")
def sort_multi(spark, sf_dir):
    return total_order(table(spark, sf_dir, "part").select("p_type", "p_size", "p_name", "p_partkey"), "p_type", "p_size")


@query("SELECT l_partkey AS code, l_returnflag AS flag FROM lineitem UNION SELECT l_suppkey, l_linestatus FROM lineitem")
def set_union(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return distinct_union(
        lines.select(F.col("l_partkey").alias("code"), F.col("l_returnflag").alias("flag")),
        lines.select(F.col("l_suppkey").alias("code"), F.col("l_linestatus").alias("flag")))


@query("SELECT l_orderkey AS document, l_returnflag AS flag FROM lineitem UNION ALL SELECT l_orderkey, l_linestatus FROM lineitem")
def set_union_all(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(F.col("l_orderkey").alias("document"), F.col("l_returnflag").alias("flag")).unionByName(
        lines.select(F.col("l_orderkey").alias("document"), F.col("l_linestatus").alias("flag")))


@query("""SELECT l_orderkey AS document, l_linenumber AS line, l_partkey AS part, o_custkey AS customer FROM lineitem JOIN orders ON o_orderkey = l_orderkey
UNION SELECT l_orderkey + 1, l_linenumber, l_partkey, o_custkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'R'""")
def set_union_links(spark, sf_dir):
    lines = lookup(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"),
                   table(spark, sf_dir, "orders"), {"l_orderkey": "o_orderkey"}, {"customer": "o_custkey"}, "inner")

    def links(df, document):
        return df.select(document.alias("document"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"), "customer")

    return distinct_union(links(lines, F.col("l_orderkey")), links(lines.where("l_returnflag = 'R'"), F.col("l_orderkey") + 1))


@query("""SELECT 1 AS branch, l_partkey AS code FROM lineitem WHERE l_returnflag = 'N' UNION SELECT 1, l_partkey FROM lineitem WHERE l_returnflag = 'A'
UNION ALL SELECT 2, l_suppkey FROM lineitem WHERE l_returnflag = 'R' UNION SELECT 2, l_suppkey FROM lineitem WHERE l_linestatus = 'O'""")
def set_union_chain(spark, sf_dir):
    """UNION, UNION ALL, UNION from left to right: the last one removes every duplicate."""
    lines = table(spark, sf_dir, "lineitem")

    def branch(condition, number, code):
        return lines.where(condition).select(F.lit(number).alias("branch"), F.col(code).alias("code"))

    return distinct_union(branch("l_returnflag = 'N'", 1, "l_partkey"), branch("l_returnflag = 'A'", 1, "l_partkey"),
                          branch("l_returnflag = 'R'", 2, "l_suppkey"), branch("l_linestatus = 'O'", 2, "l_suppkey"))


@query(f"""WITH due AS (SELECT l_orderkey, string_agg(DISTINCT strftime(d, '%Y-%m-%d'), ';' ORDER BY strftime(d, '%Y-%m-%d')) AS days FROM
  (SELECT l_orderkey, {_DAY} AS d FROM lineitem) AS k GROUP BY 1)
SELECT 'NE' AS kind, o_orderkey, days FROM orders LEFT JOIN due ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'
UNION ALL SELECT 'NT', o_orderkey, days FROM orders LEFT JOIN due ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'F'""")
def cte_reuse(spark, sf_dir):
    """One list of due days serves both kinds of documents: the kinds are joined to it together."""
    due = joined_list(due_lines(spark, sf_dir), ["l_orderkey"], "due", "days", lambda d: day_text(d, "yyyy-MM-dd"), distinct=True)
    orders = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "F", "NE").otherwise("NT").alias("kind"), "o_orderkey")
    return lookup(orders, due, {"o_orderkey": "l_orderkey"}, {"days": "days"})


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS DOUBLE) / CAST((SELECT sum(CAST(x.l_quantity AS DECIMAL(15,2)))
FROM lineitem x WHERE x.l_orderkey = i.l_orderkey AND x.l_linestatus = i.l_linestatus) AS DOUBLE) AS part_of_total FROM lineitem i""")
def subq_corr_sum(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    totals = totals_by(lines, ["l_orderkey", "l_linestatus"], total=F.sum(amount("l_quantity")))
    joined = lookup(lines, totals, {"l_orderkey": "l_orderkey", "l_linestatus": "l_linestatus"}, {"total": "total"})
    return joined.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", ratio("l_quantity", "total").alias("part_of_total"))


@query("""SELECT o_orderkey, (SELECT l_partkey FROM lineitem WHERE l_orderkey = o_orderkey ORDER BY l_extendedprice DESC, l_partkey DESC LIMIT 1) AS top_part
FROM orders""")
def subq_corr_top1(spark, sf_dir):
    top = latest_by(table(spark, sf_dir, "lineitem"), ["l_orderkey"], ["l_extendedprice", "l_partkey"], top_part="l_partkey")
    return lookup(table(spark, sf_dir, "orders").select("o_orderkey"), top, {"o_orderkey": "l_orderkey"}, {"top_part": "top_part"})


@query("""SELECT o_orderkey, (SELECT string_agg(strftime(CAST(o_orderdate AS DATE) + l_linenumber * 30, '%d/%m/%Y'), ';' ORDER BY l_linenumber)
FROM lineitem WHERE l_orderkey = o_orderkey) AS due_days FROM orders""")
def subq_corr_listagg(spark, sf_dir):
    """Due days per order: its own date plus the terms of its lines."""
    terms = counted_values(table(spark, sf_dir, "lineitem").withColumn("days", F.col("l_linenumber") * 30), ["l_orderkey"], "days", "terms")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("on_day"))
    joined = lookup(orders, terms, {"o_orderkey": "l_orderkey"}, {"terms": "terms"})
    return joined.select("o_orderkey", list_text("terms", lambda d: day_text(F.date_add("on_day", d))).alias("due_days"))


@query("SELECT k.key, k.name, n_name FROM (SELECT c_custkey AS key, c_name AS name, c_nationkey FROM customer) AS k LEFT JOIN nation ON n_nationkey = c_nationkey")
def subq_inline_view(spark, sf_dir):
    view = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), "c_nationkey")
    return lookup(view, table(spark, sf_dir, "nation"), {"c_nationkey": "n_nationkey"}, {"n_name": "n_name"}).drop("c_nationkey")
