"""Joins over whole tables."""

from pyspark.sql import functions as F

from ledgerloom.functions import code_label
from ledgerloom.operators.joins import has_match, lookup, matching, share_of_total, totals_by
from ledgerloom.queries.base import portable_sql, query, table


def amount(name, scale=2):
    return F.col(name).cast(f"decimal(15,{scale})")


_LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, p_name, p_brand FROM lineitem JOIN part ON p_partkey = l_partkey")
def join_inner(spark, sf_dir):
    return lookup(table(spark, sf_dir, "lineitem").select(*_LINE), table(spark, sf_dir, "part"), {"l_partkey": "p_partkey"},
                  {"p_name": "p_name", "p_brand": "p_brand"}, "inner")


@query(portable_sql("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, total FROM lineitem
JOIN (SELECT l_orderkey, l_partkey, sum(CAST(l_quantity AS DECIMAL(15,2))) AS total FROM lineitem GROUP BY ALL) AS k
USING (l_orderkey, l_partkey)""", "total"))
def join_inner_composite(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    totals = totals_by(lines, ["l_orderkey", "l_partkey"], total=F.sum(amount("l_quantity")))
    return lookup(lines.select(*_LINE), totals, {"l_orderkey": "l_orderkey", "l_partkey": "l_partkey"}, {"total": "total"}, "inner")


@query("""SELECT c_custkey, n_name AS nation, r_name AS region FROM customer
LEFT JOIN (SELECT * FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_name <> 'ASIA') AS k ON n_nationkey = c_nationkey""")
def join_left_lookup(spark, sf_dir):
    regions = table(spark, sf_dir, "region").where("r_name <> 'ASIA'")
    nations = lookup(table(spark, sf_dir, "nation"), regions, {"n_regionkey": "r_regionkey"}, {"r_name": "r_name"}, "inner")
    return lookup(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), nations, {"c_nationkey": "n_nationkey"},
                  {"nation": "n_name", "region": "r_name"}).drop("c_nationkey")


_RATES = """SELECT DISTINCT o_orderpriority AS priority, CAST(o_orderdate AS DATE) AS on_day,
CAST(1 + extract(month FROM o_orderdate) % 5 AS DOUBLE) AS rate FROM orders WHERE o_orderpriority <> '5-LOW'"""


def rates(spark, sf_dir):
    """Rate per priority and day; low-priority orders have none."""
    on_day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").where("o_orderpriority <> '5-LOW'").select(
        F.col("o_orderpriority").alias("priority"), on_day.alias("on_day"),
        (F.lit(1) + F.month(on_day) % 5).cast("double").alias("rate")).distinct()


def rated_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("on_day", F.col("o_orderdate").cast("date"))
    return lookup(orders, rates(spark, sf_dir), {"o_orderpriority": "priority", "on_day": "on_day"}, {"rate": "rate"})


@query(f"""WITH rates AS ({_RATES}) SELECT o_orderkey, rate FROM orders
LEFT JOIN rates ON priority = o_orderpriority AND on_day = CAST(o_orderdate AS DATE)""")
def join_left_composite(spark, sf_dir):
    return rated_orders(spark, sf_dir).select("o_orderkey", "rate")


@query("SELECT o_orderkey, l_partkey, l_suppkey, l_linenumber FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_returnflag = 'N'")
def join_left_on_const(spark, sf_dir):
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    condition = (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("l_returnflag") == "N")
    return orders.join(lines, condition, "left").select("o_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


@query(portable_sql("""SELECT o_orderkey, coalesce(n, 0) AS n, total FROM orders LEFT JOIN
(SELECT l_orderkey, count(*) AS n, sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS total FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1) AS k
ON l_orderkey = o_orderkey""", "total"))
def join_left_agg(spark, sf_dir):
    totals = totals_by(table(spark, sf_dir, "lineitem").where("l_linestatus = 'F'"), ["l_orderkey"],
                       n=F.count(F.lit(1)), total=F.sum(amount("l_extendedprice")))
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return lookup(orders, totals, {"o_orderkey": "l_orderkey"}, {"n": "n", "total": "total"}).withColumn(
        "n", F.coalesce("n", F.lit(0)))


@query(portable_sql("""SELECT o_orderkey, kind, partner, cost FROM orders LEFT JOIN (
SELECT l_orderkey, 'NE' AS kind, l_partkey AS partner, CAST(l_extendedprice AS DECIMAL(15,2)) AS cost FROM lineitem WHERE l_returnflag = 'N'
UNION ALL SELECT l_orderkey, 'NT', l_suppkey, CAST(l_quantity AS DECIMAL(15,2)) FROM lineitem WHERE l_returnflag = 'A') AS k ON l_orderkey = o_orderkey""", "cost"))
def join_left_union(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    own = lines.where("l_returnflag = 'N'").select(
        "l_orderkey", F.lit("NE").alias("kind"), F.col("l_partkey").alias("partner"), amount("l_extendedprice").alias("cost"))
    incoming = lines.where("l_returnflag = 'A'").select(
        "l_orderkey", F.lit("NT").alias("kind"), F.col("l_suppkey").alias("partner"), amount("l_quantity").alias("cost"))
    return lookup(table(spark, sf_dir, "orders").select("o_orderkey"), own.unionByName(incoming), {"o_orderkey": "l_orderkey"},
                  {"kind": "kind", "partner": "partner", "cost": "cost"})


@query(portable_sql("""WITH due AS (SELECT l_orderkey, min(CAST(l_shipdate AS DATE)) AS first_day FROM lineitem GROUP BY 1)
SELECT 'open' AS kind, o_orderkey, first_day FROM orders LEFT JOIN due ON l_orderkey = o_orderkey WHERE o_orderstatus = 'O'
UNION ALL SELECT 'filled', o_orderkey, first_day FROM orders LEFT JOIN due ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'
UNION ALL SELECT 'partial', o_orderkey, first_day FROM orders LEFT JOIN due ON l_orderkey = o_orderkey WHERE o_orderstatus = 'P'""", "", "first_day"))
def join_cte(spark, sf_dir):
    due = totals_by(table(spark, sf_dir, "lineitem"), ["l_orderkey"], first_day=F.min(F.col("l_shipdate").cast("date")))
    kind = code_label("o_orderstatus", {"O": "open", "F": "filled", "P": "partial"})
    orders = table(spark, sf_dir, "orders").select(kind.alias("kind"), "o_orderkey").where("kind IS NOT NULL")
    return lookup(orders, due, {"o_orderkey": "l_orderkey"}, {"first_day": "first_day"}).select("kind", "o_orderkey", "first_day")


@query("""SELECT b.n_name AS buyer_nation, s.n_name AS seller_nation, count(*) AS n
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation b ON b.n_nationkey = c_nationkey
JOIN supplier ON s_suppkey = l_suppkey JOIN nation s ON s.n_nationkey = s_nationkey GROUP BY 1, 2""")
def join_role_playing(spark, sf_dir):
    nations = table(spark, sf_dir, "nation")
    buyers = lookup(table(spark, sf_dir, "customer"), nations, {"c_nationkey": "n_nationkey"}, {"buyer_nation": "n_name"}, "inner")
    sellers = lookup(table(spark, sf_dir, "supplier"), nations, {"s_nationkey": "n_nationkey"}, {"seller_nation": "n_name"}, "inner")
    lines = lookup(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey"), table(spark, sf_dir, "orders"),
                   {"l_orderkey": "o_orderkey"}, {"o_custkey": "o_custkey"}, "inner")
    lines = lookup(lines, buyers, {"o_custkey": "c_custkey"}, {"buyer_nation": "buyer_nation"}, "inner")
    lines = lookup(lines, sellers, {"l_suppkey": "s_suppkey"}, {"seller_nation": "seller_nation"}, "inner")
    return lines.groupBy("buyer_nation", "seller_nation").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT r_name, n_name, c_custkey, o_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem JOIN orders ON o_orderkey = l_orderkey
JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""")
def join_chain(spark, sf_dir):
    nations = lookup(table(spark, sf_dir, "nation"), table(spark, sf_dir, "region"), {"n_regionkey": "r_regionkey"}, {"r_name": "r_name"}, "inner")
    customers = lookup(table(spark, sf_dir, "customer"), nations, {"c_nationkey": "n_nationkey"},
                       {"n_name": "n_name", "r_name": "r_name"}, "inner")
    lines = lookup(table(spark, sf_dir, "lineitem").select(*_LINE), table(spark, sf_dir, "orders"), {"l_orderkey": "o_orderkey"},
                   {"o_orderkey": "o_orderkey", "o_custkey": "o_custkey"}, "inner")
    placed = lookup(lines, customers, {"o_custkey": "c_custkey"}, {"c_custkey": "c_custkey", "n_name": "n_name", "r_name": "r_name"}, "inner")
    return placed.select("r_name", "n_name", "c_custkey", "o_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


@query("""SELECT i.l_orderkey, i.l_partkey, i.l_suppkey, i.l_linenumber,
CAST(i.l_quantity AS DOUBLE) / CAST((SELECT sum(CAST(x.l_quantity AS DECIMAL(15,2))) FROM lineitem x WHERE x.l_orderkey = i.l_orderkey) AS DOUBLE)
  * CAST(sum(CAST(j.l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) AS allotted
FROM lineitem i JOIN lineitem j ON j.l_orderkey = i.l_orderkey AND j.l_returnflag = 'R'
GROUP BY i.l_orderkey, i.l_partkey, i.l_suppkey, i.l_linenumber, i.l_quantity""")
def join_fanout_weighted(spark, sf_dir):
    """Amounts returned per order spread over all its lines by quantity.

    Many lines meet many returns per order. The weight does not depend on the return, so the
    returns are summed first and no pair of lines is ever built.
    """
    lines = table(spark, sf_dir, "lineitem")
    shared = share_of_total(lines.select(*_LINE, amount("l_quantity").alias("quantity")), ["l_orderkey"], "quantity", "weight")
    returned = totals_by(lines.where("l_returnflag = 'R'"), ["l_orderkey"], total=F.sum(amount("l_extendedprice")))
    met = lookup(shared, returned, {"l_orderkey": "l_orderkey"}, {"total": "total"}, "inner")
    return met.select(*_LINE, (F.col("weight") * F.col("total").cast("double")).alias("allotted"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def join_semi(spark, sf_dir):
    returned = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    return matching(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), returned, {"o_orderkey": "l_orderkey"})


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def join_anti(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return matching(orders, table(spark, sf_dir, "lineitem"), {"o_orderkey": "l_orderkey"}, keep=False)


@query(portable_sql("""SELECT o_orderkey, (SELECT sum(CAST(l_quantity AS DECIMAL(15,2))) FROM lineitem
WHERE l_orderkey = o_orderkey AND l_linestatus = 'F') AS qent FROM orders""", "qent"))
def join_lateral_tvf(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").where("l_linestatus = 'F'")
    per_order = lines.where(F.col("l_orderkey") == F.col("o_orderkey").outer()).select(F.sum(amount("l_quantity")).alias("qent"))
    return table(spark, sf_dir, "orders").select("o_orderkey").lateralJoin(per_order).select("o_orderkey", "qent")


@query(portable_sql("""SELECT l_orderkey, l_partkey, qent FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) AS k
LEFT JOIN (SELECT l_orderkey, l_partkey, sum(CAST(l_quantity AS DECIMAL(15,2))) AS qent FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL) AS d
USING (l_orderkey, l_partkey)""", "qent"))
def udtf_delivered_qty(spark, sf_dir):
    """A SQL table function called once per order and product."""
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("delivery_lines")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION delivered_quantity(of_order BIGINT, of_part BIGINT)
        RETURNS TABLE (qent DECIMAL(25,2))
        RETURN SELECT sum(CAST(l_quantity AS DECIMAL(15,2))) FROM delivery_lines
               WHERE l_orderkey = of_order AND l_partkey = of_part AND l_linestatus = 'F'""")
    return spark.sql("""
        SELECT p.l_orderkey, p.l_partkey, d.qent
        FROM (SELECT DISTINCT l_orderkey, l_partkey FROM delivery_lines) p,
        LATERAL delivered_quantity(p.l_orderkey, p.l_partkey) d""")


@query("""SELECT o_orderkey, NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = 'O') AS all_closed FROM orders""")
def subq_not_exists(spark, sf_dir):
    unfinished = table(spark, sf_dir, "lineitem").where("l_linestatus = 'O'")
    flagged = has_match(table(spark, sf_dir, "orders"), unfinished, {"o_orderkey": "l_orderkey"}, "found")
    return flagged.select("o_orderkey", (~F.col("found")).alias("all_closed"))
