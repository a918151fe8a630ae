"""Queries over the star schema: scans, joins, aggregates, windows, set operations and graphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loamstone.functions.dates import business_days
from loamstone.functions.scoring import band
from loamstone.operators import graph
from loamstone.operators.joins import as_of_join, range_join, salted_join
from loamstone.operators.ranking import first_wins, last_wins, top_per, within_budget
from loamstone.operators.series import range_sums
from loamstone.sources.tables import table


def money(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)")


def pricing_summary(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    net = money("l_extendedprice") * (1 - money("l_discount"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum(money("l_quantity")).alias("sum_qty"), F.sum(money("l_extendedprice")).alias("sum_base_price"), F.sum(net).cast("double").alias("sum_disc_price"),
        F.sum((net * (1 + money("l_tax")))).cast("double").alias("sum_charge"), F.count("*").alias("count_order"),
    )


def shipping_priority(spark: SparkSession, folder: str) -> DataFrame:
    cut = F.lit("1998-03-15").cast("timestamp_ntz")
    customers = table(spark, folder, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey")
    orders = table(spark, folder, "orders").where(F.col("o_orderdate") < cut).select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, folder, "lineitem").where(F.col("l_shipdate") > cut).select("l_orderkey", (money("l_extendedprice") * (1 - money("l_discount"))).alias("net"))
    joined = customers.join(orders, F.col("c_custkey") == F.col("o_custkey")).join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    sums = joined.groupBy("o_orderkey", "o_orderdate").agg(F.sum("net").cast("double").alias("revenue"))
    return sums.orderBy(F.desc("revenue"), "o_orderkey").limit(10)


def local_supplier_volume(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    lines = table(spark, folder, "lineitem").join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    lines = lines.join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    lines = lines.join(table(spark, folder, "supplier"), (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("c_nationkey") == F.col("s_nationkey")))
    joined = lines.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("r_name", "n_name").agg(F.sum(money("l_extendedprice") * (1 - money("l_discount"))).cast("double").alias("revenue"))


def revenue_forecast(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("l_shipdate")
    rows = table(spark, folder, "lineitem").where((day >= F.lit("1997-01-01").cast("timestamp_ntz")) & (day < F.lit("1998-01-01").cast("timestamp_ntz")))
    rows = rows.where(F.col("l_discount").between(0.05, 0.07) & (F.col("l_quantity") < 24))
    return rows.agg(F.sum(money("l_extendedprice") * money("l_discount")).cast("double").alias("revenue"))


def referential_integrity(spark: SparkSession, folder: str) -> DataFrame:
    """Rows whose keys have no partner, by kind."""
    orders, lines, customers = (table(spark, folder, t) for t in ("orders", "lineitem", "customer"))
    lost = lines.select("l_orderkey").join(orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_anti")
    owned = orders.select("o_custkey").join(customers.select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_anti")
    bare = orders.select("o_orderkey").join(lines.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")
    named = [(lost, "line_without_order"), (owned, "order_without_customer"), (bare, "order_without_lines")]
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("issue"), "n") for df, kind in named]
    return parts[0].union(parts[1]).union(parts[2])


def _daily_lines(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").groupBy(F.to_date("l_shipdate").alias("ship_day")).agg(F.sum("l_quantity").cast("long").alias("quantity"))
    return rows


def band_links_top3(spark: SparkSession, folder: str) -> DataFrame:
    """For each order the three nearest days within a week on which most was shipped."""
    orders = table(spark, folder, "orders")
    orders = orders.select("o_orderkey", F.to_date("o_orderdate").alias("order_day"))
    pairs = range_join(orders, _daily_lines(spark, folder), "order_day", "ship_day", 7)
    pairs = pairs.withColumn("score", F.lit(100) - F.abs(F.datediff("ship_day", "order_day")) * 60 / 7)
    pairs = pairs.withColumn("distance", F.abs(F.datediff("ship_day", "order_day")))
    label = band(F.col("distance") * -1, [(-1, "strong"), (-4, "medium")], "weak")
    top = top_per(pairs.withColumn("relation", label), ["o_orderkey"], [F.col("distance"), F.desc("quantity"), F.col("ship_day")], 3)
    return top.select("o_orderkey", "ship_day", "distance", "quantity", "relation", F.col("rank").cast("int").alias("place"))


def business_day_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """How many lines were shipped after how many business days."""
    orders = table(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("a"))
    lines = table(spark, folder, "lineitem").select("l_orderkey", F.to_date("l_shipdate").alias("b"))
    gaps = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(business_days(F.col("a"), F.col("b")).alias("gap"))
    return gaps.groupBy("gap").agg(F.count("*").alias("n"))


def previous_order_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """Each user's event count per day with the latest order of the same number as customer before it."""
    events = table(spark, folder, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("user_id"), F.to_date("o_orderdate").alias("order_day"), "o_orderkey")
    return as_of_join(events, orders, ["user_id"], "day", "order_day", ["order_day", "o_orderkey"])


def salted_brand_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue by brand with the join salted against parts that hold many lines."""
    lines = table(spark, folder, "lineitem").select(F.col("l_partkey").alias("p_partkey"), money("l_extendedprice").alias("price"))
    parts = table(spark, folder, "part").select("p_partkey", "p_brand")
    return salted_join(lines, parts, ["p_partkey"], 8).groupBy("p_brand").agg(F.sum("price").cast("double").alias("revenue"), F.count("*").alias("lines"))


def sales_rollup(spark: SparkSession, folder: str) -> DataFrame:
    joined = table(spark, folder, "orders").join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    sums = joined.rollup("c_mktsegment", "o_orderstatus").agg(F.count("*").alias("orders"), F.sum(money("o_totalprice")).cast("double").alias("total"), F.grouping_id().cast("long").alias("level"))
    return sums


def status_pivot(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count("o_orderkey"))
    return rows.select("o_orderpriority", *[F.coalesce(F.col(c), F.lit(0)).alias(f"n_{c.lower()}") for c in "FOP"])


def grouping_sets(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem")
    rows.createOrReplaceTempView("_lineitem_sets")
    return spark.sql(
        "SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM _lineitem_sets "
        "GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())"
    )


def top_customers(spark: SparkSession, folder: str) -> DataFrame:
    """The three customers of each nation with most orders."""
    orders = table(spark, folder, "orders").groupBy("o_custkey").agg(F.count("*").alias("orders"))
    joined = orders.join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    top = top_per(joined, ["c_nationkey"], [F.desc("orders"), F.col("c_custkey")], 3, "place")
    return top.select("c_nationkey", "c_custkey", "orders", "place")


def order_budget(spark: SparkSession, folder: str) -> DataFrame:
    """Per day the five dearest orders are kept, the others deferred."""
    rows = table(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"), "o_totalprice")
    kept = within_budget(rows, ["day"], [F.desc("o_totalprice"), F.col("o_orderkey")], 5)
    return kept.groupBy("day").agg(F.count_if("kept").alias("kept"), F.count_if(~F.col("kept")).alias("deferred"))


def customer_set_operations(spark: SparkSession, folder: str) -> DataFrame:
    """Sizes of the union, intersection and differences of the customers with urgent and with low-priority orders."""
    orders = table(spark, folder, "orders")
    a = orders.where("o_orderpriority = '1-URGENT'").select("o_custkey")
    b = orders.where("o_orderpriority = '5-LOW'").select("o_custkey")
    parts = {"union": a.union(b).distinct(), "intersect": a.intersect(b), "only_urgent": a.exceptAll(a.join(b, "o_custkey", "left_semi")).distinct(), "only_low": b.subtract(a)}
    out = None
    for name, df in parts.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n")
        out = one if out is None else out.union(one)
    return out


def trade_graph_reach(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes by depth of a breadth-first walk from region 0: regions, nations, customers, orders."""
    nation, customer, orders = (table(spark, folder, t) for t in ("nation", "customer", "orders"))
    node = lambda kind, c: F.concat(F.lit(kind), F.col(c).cast("string"))
    edges = nation.select(node("r", "n_regionkey").alias("src"), node("n", "n_nationkey").alias("dst"))
    edges = edges.union(customer.select(node("n", "c_nationkey"), node("c", "c_custkey"))).union(orders.select(node("c", "o_custkey"), node("o", "o_orderkey")))
    roots = spark.createDataFrame([("r0",)], "node string")
    return graph.breadth_first(edges, roots).groupBy("depth").agg(F.count("*").alias("nodes"))


def part_components(spark: SparkSession, folder: str) -> DataFrame:
    """Components of suppliers that share a part in any lines, by size."""
    lines = table(spark, folder, "lineitem")
    rows = lines.select("l_partkey", "l_suppkey").distinct()
    least = rows.groupBy("l_partkey").agg(F.min("l_suppkey").alias("b"))
    links = rows.join(least, "l_partkey").select(F.col("l_suppkey").alias("a"), "b").where("a <> b")
    return graph.components(links).groupBy("root").agg(F.count("*").alias("members"))


def moving_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue per day with that of the seven days up to it (a range frame over all years) and the month's so far."""
    days = table(spark, folder, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.sum(money("o_totalprice")).alias("revenue"))
    month = Window.partitionBy(F.trunc("day", "month")).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    out = range_sums(days, "day", "revenue", 7, "week").withColumn("month_so_far", F.sum("revenue").over(month))
    return out.select("day", *[F.col(c).cast("double").alias(c) for c in ("revenue", "week", "month_so_far")])


def latest_order_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Per customer the order that a last-wins table would hold, and the one of a first-wins table."""
    rows = table(spark, folder, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    last = last_wins(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", F.col("o_orderkey").alias("last_order"))
    first = first_wins(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", F.col("o_orderkey").alias("first_order"))
    return last.join(first, "o_custkey")


QUERIES = {
    f.__name__: f
    for f in (
        pricing_summary, shipping_priority, local_supplier_volume, revenue_forecast, referential_integrity, band_links_top3, business_day_gaps,
        previous_order_as_of, salted_brand_revenue, sales_rollup, status_pivot, grouping_sets, top_customers, order_budget, customer_set_operations,
        trade_graph_reach, part_components, moving_revenue, latest_order_upsert,
    )
}

_NET = "CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))"
SQL = {
    "pricing_summary": f"""
SELECT l_returnflag, l_linestatus, sum(CAST(l_quantity AS DECIMAL(18,2))) AS sum_qty, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS sum_base_price,
       CAST(sum({_NET}) AS DOUBLE) AS sum_disc_price, CAST(sum({_NET} * (1 + CAST(l_tax AS DECIMAL(18,2)))) AS DOUBLE) AS sum_charge, count(*) AS count_order
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL""",
    "shipping_priority": f"""
SELECT o_orderkey, o_orderdate, CAST(sum({_NET}) AS DOUBLE) AS revenue
FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
WHERE c_mktsegment = 'BUILDING' AND o_orderdate < TIMESTAMP '1998-03-15' AND l_shipdate > TIMESTAMP '1998-03-15'
GROUP BY ALL ORDER BY revenue DESC, o_orderkey LIMIT 10""",
    "local_supplier_volume": f"""
SELECT r_name, n_name, CAST(sum({_NET}) AS DOUBLE) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY ALL""",
    "revenue_forecast": """
SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01' AND l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24""",
    "referential_integrity": """
SELECT 'line_without_order' AS issue, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'order_without_customer', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'order_without_lines', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
    "band_links_top3": """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day FROM orders),
q AS (SELECT CAST(l_shipdate AS DATE) AS ship_day, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY 1),
p AS (SELECT o_orderkey, ship_day, abs(ship_day - order_day) AS distance, quantity FROM o JOIN q ON abs(ship_day - order_day) <= 7),
r AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY distance, quantity DESC, ship_day) AS place FROM p)
SELECT o_orderkey, ship_day, CAST(distance AS INT) AS distance, quantity,
       CASE WHEN distance <= 1 THEN 'strong' WHEN distance <= 4 THEN 'medium' ELSE 'weak' END AS relation, CAST(place AS INT) AS place
FROM r WHERE place <= 3""",
    "business_day_gaps": """
WITH days AS (SELECT CAST(d AS DATE) AS d FROM range(DATE '1990-01-01', DATE '2012-01-01', INTERVAL 1 DAY) t(d)),
n AS (SELECT d, sum(CASE WHEN isodow(d) < 6 THEN 1 ELSE 0 END) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM days)
SELECT CAST(abs(coalesce(y.before, 0) - coalesce(x.before, 0)) AS INT) AS gap, count(*) AS n
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN n x ON x.d = CAST(o_orderdate AS DATE) JOIN n y ON y.d = CAST(l_shipdate AS DATE) GROUP BY 1""",
    "previous_order_as_of": """
WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL),
o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS order_day, max(o_orderkey) AS o_orderkey FROM orders GROUP BY ALL)
SELECT e.user_id, e.day, e.n, o.order_day, o.o_orderkey FROM e ASOF LEFT JOIN o ON e.user_id = o.o_custkey AND e.day >= o.order_day""",
    "salted_brand_revenue": """
SELECT p_brand, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue, count(*) AS lines FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
    "sales_rollup": """
SELECT c_mktsegment, o_orderstatus, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
       CAST(grouping(c_mktsegment, o_orderstatus) AS BIGINT) AS level
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ROLLUP (c_mktsegment, o_orderstatus)""",
    "status_pivot": """
SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS n_f, count(*) FILTER (o_orderstatus = 'O') AS n_o, count(*) FILTER (o_orderstatus = 'P') AS n_p
FROM orders GROUP BY 1""",
    "grouping_sets": """
SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem
GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())""",
    "top_customers": """
WITH n AS (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1),
r AS (SELECT c_nationkey, c_custkey, orders, row_number() OVER (PARTITION BY c_nationkey ORDER BY orders DESC, c_custkey) AS place FROM n JOIN customer ON o_custkey = c_custkey)
SELECT * FROM r WHERE place <= 3""",
    "order_budget": """
WITH r AS (SELECT CAST(o_orderdate AS DATE) AS day, row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders)
SELECT day, count(*) FILTER (n <= 5) AS kept, count(*) FILTER (n > 5) AS deferred FROM r GROUP BY 1""",
    "customer_set_operations": """
WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'), b AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '5-LOW')
SELECT 'union' AS part, count(*) AS n FROM (FROM a UNION FROM b) UNION ALL SELECT 'intersect', count(*) FROM (FROM a INTERSECT FROM b)
UNION ALL SELECT 'only_urgent', count(*) FROM (FROM a EXCEPT FROM b) UNION ALL SELECT 'only_low', count(*) FROM (FROM b EXCEPT FROM a)""",
    "trade_graph_reach": """
WITH RECURSIVE e AS (
    SELECT 'r' || n_regionkey AS src, 'n' || n_nationkey AS dst FROM nation UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer
    UNION ALL SELECT 'c' || o_custkey, 'o' || o_orderkey FROM orders
), w AS (SELECT 'r0' AS node, 0 AS depth UNION SELECT e.dst, w.depth + 1 FROM w JOIN e ON e.src = w.node)
SELECT depth, count(*) AS nodes FROM (SELECT node, min(depth) AS depth FROM w GROUP BY 1) GROUP BY 1""",
    "part_components": """
WITH RECURSIVE r AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem),
e AS (SELECT DISTINCT a.l_suppkey AS a, b.l_suppkey AS b FROM r a JOIN r b USING (l_partkey) WHERE a.l_suppkey <> b.l_suppkey),
w AS (SELECT DISTINCT a AS node, a AS seen FROM e UNION SELECT w.node, e.b FROM w JOIN e ON e.a = w.seen)
SELECT root, count(*) AS members FROM (SELECT node, min(seen) AS root FROM w GROUP BY 1) GROUP BY 1""",
    "moving_revenue": """
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue FROM orders GROUP BY 1)
SELECT day, CAST(revenue AS DOUBLE) AS revenue, CAST(sum(revenue) OVER (ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS DOUBLE) AS week,
       CAST(sum(revenue) OVER (PARTITION BY date_trunc('month', day) ORDER BY day ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS month_so_far FROM d""",
    "latest_order_upsert": """
SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order FROM orders GROUP BY 1""",
}
