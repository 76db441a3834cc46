"""Projections and filters over whole tables."""

from pyspark.sql import functions as F

from ledgerloom.functions import code_label, negate_unless, to_number
from ledgerloom.operators.joins import has_match, lookup, padded_union
from ledgerloom.queries.base import portable_sql, query, table


def day(name):
    return F.col(name).cast("date")


@query("SELECT p_partkey AS product, p_name AS description, p_brand AS brand, p_size AS size FROM part")
def proj_rename(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product"), F.col("p_name").alias("description"),
        F.col("p_brand").alias("brand"), F.col("p_size").alias("size"),
    )


@query("SELECT 'NE' AS kind, 'DZ' AS series, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem")
def proj_literal(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.lit("NE").alias("kind"), F.lit("DZ").alias("series"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
    )


@query("""SELECT 'order' AS kind, o_orderkey AS document, o_orderpriority AS priority, CAST(NULL AS INT) AS line, CAST(NULL AS DOUBLE) AS quantity
FROM orders UNION ALL SELECT 'line', l_orderkey, NULL, l_linenumber, l_quantity FROM lineitem""")
def proj_null_pad(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.lit("order").alias("kind"), F.col("o_orderkey").alias("document"), F.col("o_orderpriority").alias("priority"))
    lines = table(spark, sf_dir, "lineitem").select(
        F.lit("line").alias("kind"), F.col("l_orderkey").alias("document"), F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("quantity"))
    return padded_union(orders, lines)


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN l_quantity ELSE -l_quantity END AS quantity,
CASE WHEN l_returnflag = 'A' THEN 'in' WHEN l_linestatus = 'F' THEN 'closed' ELSE 'open' END AS state FROM lineitem""")
def proj_case_searched(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        negate_unless("l_returnflag", "A", "l_quantity").alias("quantity"),
        F.when(F.col("l_returnflag") == "A", "in").when(F.col("l_linestatus") == "F", "closed").otherwise("open").alias("state"),
    )


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus IN ('O', 'F') THEN replace(replace(o_orderstatus, 'O', 'OPEN'), 'F', 'FILLED') END AS status
FROM orders""")
def proj_case_label(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", code_label("o_orderstatus", {"O": "OPEN", "F": "FILLED"}).alias("status"))


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
CASE WHEN o_orderstatus = 'F' AND l_linestatus = 'F' AND l_returnflag <> 'N' THEN 'returned'
     WHEN o_orderstatus = 'F' AND l_linestatus = 'F' THEN 'kept' ELSE 'pending' END AS outcome
FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def proj_case_compound(spark, sf_dir):
    lines = lookup(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"), {"l_orderkey": "o_orderkey"},
                   {"o_orderstatus": "o_orderstatus"}, "inner")
    closed = (F.col("o_orderstatus") == "F") & (F.col("l_linestatus") == "F")
    return lines.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.when(closed & (F.col("l_returnflag") != "N"), "returned").when(closed, "kept").otherwise("pending").alias("outcome"))


@query("""SELECT o_orderkey, CASE WHEN NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
THEN 'VN' ELSE 'VF' END AS flow FROM orders""")
def proj_exists_flag(spark, sf_dir):
    returned = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    flagged = has_match(table(spark, sf_dir, "orders"), returned, {"o_orderkey": "l_orderkey"}, "returned")
    return flagged.select("o_orderkey", F.when(F.col("returned"), "VF").otherwise("VN").alias("flow"))


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P' AND o_totalprice > 100000")
def filter_cmp(spark, sf_dir):
    return table(spark, sf_dir, "orders").where("o_orderstatus <> 'P' AND o_totalprice > 100000").select("o_orderkey", "o_orderstatus")


@query("SELECT p_partkey, p_type, p_size FROM part WHERE p_type IN ('ECONOMY', 'PROMO') AND p_size IN (1, 2, 3, 5, 8, 13, 21, 34)")
def filter_in(spark, sf_dir):
    return table(spark, sf_dir, "part").where(
        F.col("p_type").isin("ECONOMY", "PROMO") & F.col("p_size").isin(1, 2, 3, 5, 8, 13, 21, 34)
    ).select("p_partkey", "p_type", "p_size")


@query(portable_sql("""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
WHERE o_orderdate BETWEEN strptime('01/01/1996', '%d/%m/%Y') AND strptime('31/12/1999', '%d/%m/%Y')""", "", "o_orderdate"))
def filter_date_between(spark, sf_dir):
    first, last = (F.to_date(F.lit(d), "dd/MM/yyyy") for d in ("01/01/1996", "31/12/1999"))
    return table(spark, sf_dir, "orders").where(F.col("o_orderdate").between(first, last)).select("o_orderkey", "o_orderdate")


@query("""SELECT o_orderkey, priority FROM (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority FROM orders) AS k
WHERE priority IS NOT NULL""")
def filter_not_null(spark, sf_dir):
    return (table(spark, sf_dir, "orders").select("o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"))
            .where(F.col("priority").isNotNull()))


@query(portable_sql("""SELECT * FROM (SELECT o_orderkey AS document, CAST(o_orderdate AS DATE) AS on_day FROM orders
UNION SELECT l_orderkey, CAST(l_shipdate AS DATE) FROM lineitem) AS k WHERE on_day >= DATE '1998-01-01'""", "", "on_day"))
def filter_over_union(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("document"), day("o_orderdate").alias("on_day"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("document"), day("l_shipdate").alias("on_day"))
    return orders.unionByName(lines).distinct().where("on_day >= DATE '1998-01-01'")


@query("""SELECT o_orderkey, code FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'E' ELSE substr(o_orderpriority, 1, 1) END AS code
FROM orders) AS k WHERE TRY_CAST(code AS DOUBLE) <> 5""")
def filter_mixed_type(spark, sf_dir):
    code = F.when(F.col("o_orderstatus") == "P", "E").otherwise(F.substring("o_orderpriority", 1, 1))
    return table(spark, sf_dir, "orders").select("o_orderkey", code.alias("code")).where(to_number("code") != 5)
