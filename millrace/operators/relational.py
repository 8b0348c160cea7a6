"""Scans, filters, joins, aggregates, windows, sorts and set operations, each with the SQL that it equals."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import Tables

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
SQL: dict[str, str] = {}
#: Parts in a block of join_theta.
BLOCK_ROWS = 1024


def query(sql: str) -> Callable:
    def add(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def money(name: str) -> Column:
    """A double of at most two digits after the point, as a decimal, whose sums are exact in any order."""
    return F.col(name).cast("decimal(12,2)")


@query("""SELECT n_name, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DECIMAL(28,4)) AS revenue, count(DISTINCT o_orderkey) AS n_orders
FROM region JOIN nation ON r_regionkey = n_regionkey JOIN customer ON n_nationkey = c_nationkey JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey
WHERE r_name = 'ASIA' AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01' GROUP BY n_name""")
def region_revenue(t: Tables) -> DataFrame:
    year = (F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")) & (F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
    price = money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    nations = t.region.where("r_name = 'ASIA'").join(t.nation, F.col("r_regionkey") == F.col("n_regionkey"))
    customers = nations.join(t.customer, F.col("n_nationkey") == F.col("c_nationkey"))
    orders = customers.join(t.orders.where(year), F.col("c_custkey") == F.col("o_custkey"))
    lines = orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    return lines.groupBy("n_name").agg(F.sum(price).cast("decimal(28,4)").alias("revenue"), F.count_distinct("o_orderkey").alias("n_orders"))


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_totalprice BETWEEN 1000 AND 50000 AND o_orderstatus IN ('F', 'O') AND o_orderpriority LIKE '%-H%'")
def filter_orders(t: Tables) -> DataFrame:
    return t.orders.where(F.col("o_totalprice").between(1000, 50000) & F.col("o_orderstatus").isin("F", "O") & F.col("o_orderpriority").like("%-H%")).select("o_orderkey", "o_orderpriority")


@query("SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE 'large' END AS size_class FROM part")
def project_case(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.when(F.col("p_size") < 10, "small").when(F.col("p_size") < 30, "medium").otherwise("large").alias("size_class"))


@query("SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS click, count(*) FILTER (WHERE event_type = 'view') AS view FROM events GROUP BY user_id")
def pivot_events(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").pivot("event_type", ["click", "view"]).count().na.fill(0)


@query("SELECT p_partkey, 'size' AS field, CAST(p_size AS DOUBLE) AS v FROM part UNION ALL SELECT p_partkey, 'price', p_retailprice FROM part")
def unpivot_parts(t: Tables) -> DataFrame:
    wide = t.part.select("p_partkey", F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("price"))
    return wide.unpivot("p_partkey", ["size", "price"], "field", "v")


@query("SELECT c_name, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey")
def join_inner(t: Tables) -> DataFrame:
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_name", "o_orderkey")


@query("SELECT o_orderkey, l_linenumber FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey")
def join_left(t: Tables) -> DataFrame:
    return t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", "l_linenumber")


@query("SELECT o_orderkey, l_orderkey FROM (SELECT * FROM orders WHERE o_orderstatus = 'F') FULL JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON o_orderkey = l_orderkey")
def join_full(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey").distinct()
    return t.orders.where("o_orderstatus = 'F'").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "full").select("o_orderkey", "l_orderkey")


@query("SELECT r_name, n_name FROM region CROSS JOIN nation")
def join_cross(t: Tables) -> DataFrame:
    """Both sides are fixed in size: 5 and 25 rows."""
    return t.region.crossJoin(F.broadcast(t.nation)).select("r_name", "n_name")


@query("SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45)")
def join_semi(t: Tables) -> DataFrame:
    return t.orders.join(t.lineitem.where("l_quantity > 45"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def join_anti(t: Tables) -> DataFrame:
    return t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey")


@query("SELECT a.p_partkey AS part_a, b.p_partkey AS part_b FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_type = b.p_type AND a.p_size < b.p_size AND a.p_retailprice > b.p_retailprice")
def join_theta(t: Tables) -> DataFrame:
    """Each group's parts, by price, in blocks: a block meets its own and dearer parts, and skips its sizes that are too small as a whole. A fixed number of tasks, several for each core, as the pairs are many more than the size of the input tells."""
    group, n = ["p_brand", "p_type"], max(int(t.spark.conf.get("spark.sql.shuffle.partitions")), 8 * t.spark.sparkContext.defaultParallelism)
    place = F.row_number().over(Window.partitionBy(*group).orderBy("p_retailprice", "p_size", "p_partkey")) - 1
    parts = t.part.where("p_brand IS NOT NULL AND p_type IS NOT NULL AND p_size IS NOT NULL AND p_retailprice IS NOT NULL").select(*group, F.floor(place / BLOCK_ROWS).alias("block"), "p_size", "p_retailprice", "p_partkey")
    a = parts.withColumn("block", F.explode(F.sequence(F.lit(0), "block"))).repartition(n, *group, "block")
    rows = F.collect_list(F.struct(F.col("p_retailprice").alias("price"), F.col("p_partkey").alias("part_b"))).alias("rows")
    sizes = parts.groupBy(*group, "block", F.col("p_size").alias("size")).agg(rows)
    b = sizes.groupBy(*group, "block").agg(F.collect_list(F.struct("size", "rows")).alias("sizes")).repartition(n, *group, "block")
    larger = a.join(b.hint("merge"), [*group, "block"]).select("p_size", "p_retailprice", F.col("p_partkey").alias("part_a"), F.inline("sizes")).where("p_size < size")
    return larger.select("p_retailprice", "part_a", F.inline("rows")).where("p_retailprice > price").select("part_a", "part_b")


@query("SELECT e.event_id AS error_id, v.event_id AS view_id FROM events e JOIN events v ON e.user_id = v.user_id AND e.event_type = 'error' AND v.event_type = 'view' AND v.ts BETWEEN e.ts - INTERVAL 1 HOUR AND e.ts")
def join_interval(t: Tables) -> DataFrame:
    """Errors with the views of the hour before, met in hours: an error looks into its own and the one before."""
    hour = lambda ts: F.floor(F.unix_timestamp(ts.cast("timestamp")) / 3600)
    errors = t.events.where("event_type = 'error'").select(F.col("event_id").alias("error_id"), F.col("user_id"), F.col("ts").alias("at"), F.explode(F.array(hour(F.col("ts")), hour(F.col("ts")) - 1)).alias("h"))
    views = t.events.where("event_type = 'view'").select(F.col("event_id").alias("view_id"), "user_id", "ts", hour(F.col("ts")).alias("h"))
    return errors.join(views, ["user_id", "h"]).where(F.col("ts").between(F.col("at") - F.expr("INTERVAL 1 HOUR"), F.col("at"))).select("error_id", "view_id")


@query("""SELECT event_id, (SELECT max(p.event_id) FROM events p WHERE p.user_id = c.user_id AND p.event_type = 'purchase' AND p.ts <= c.ts) AS purchase_id FROM events c WHERE event_type = 'click'""")
def join_asof(t: Tables) -> DataFrame:
    """Each click with its user's latest purchase: one sort by user, no join."""
    w = Window.partitionBy("user_id").orderBy("ts").rangeBetween(Window.unboundedPreceding, 0)
    both = t.events.where(F.col("event_type").isin("click", "purchase"))
    last = F.last(F.when(F.col("event_type") == "purchase", F.col("event_id")), ignorenulls=True).over(w)
    return both.withColumn("purchase_id", last).where("event_type = 'click'").select("event_id", "purchase_id")


@query("SELECT a.doc_id, b.quality FROM (SELECT doc_id, nullif(toxic, 0) AS k FROM labels) a JOIN (SELECT DISTINCT nullif(toxic, 0) AS k, quality FROM labels) b ON a.k IS NOT DISTINCT FROM b.k")
def join_null_safe(t: Tables) -> DataFrame:
    k = F.expr("nullif(toxic, 0)")
    a, b = t.labels.select("doc_id", k.alias("k")), t.labels.select(k.alias("other"), "quality").distinct()
    return a.join(b, F.col("k").eqNullSafe(F.col("other"))).select("doc_id", "quality")


@query("SELECT c_name, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey")
def join_shuffle_hash(t: Tables) -> DataFrame:
    return t.orders.join(t.customer.hint("shuffle_hash"), F.col("o_custkey") == F.col("c_custkey")).select("c_name", "o_orderkey")


@query("SELECT c_name, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey")
def join_merge(t: Tables) -> DataFrame:
    return t.orders.join(t.customer.hint("merge"), F.col("o_custkey") == F.col("c_custkey")).select("c_name", "o_orderkey")


@query("SELECT n_name, s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def join_broadcast(t: Tables) -> DataFrame:
    """The broadcast side is fixed in size: 25 rows."""
    return t.supplier.join(t.nation.hint("broadcast"), F.col("s_nationkey") == F.col("n_nationkey")).select("n_name", "s_suppkey")


@query("SELECT c_custkey, (SELECT max(o_totalprice) FROM orders WHERE o_custkey = c_custkey) AS most FROM customer")
def correlated_subquery(t: Tables) -> DataFrame:
    return t.spark.sql("SELECT c_custkey, (SELECT max(o_totalprice) FROM {orders} WHERE o_custkey = c_custkey) AS most FROM {customer}", orders=t.orders, customer=t.customer)


@query("SELECT c_custkey, n, last FROM customer, LATERAL (SELECT count(*) AS n, max(o_orderkey) AS last FROM orders WHERE o_custkey = c_custkey) x")
def lateral_join(t: Tables) -> DataFrame:
    return t.spark.sql("SELECT c_custkey, n, last FROM {customer}, LATERAL (SELECT count(*) AS n, max(o_orderkey) AS last FROM {orders} WHERE o_custkey = c_custkey) x", orders=t.orders, customer=t.customer)


@query("SELECT o_orderkey FROM orders o WHERE o_totalprice > (SELECT avg(CAST(o_totalprice AS DECIMAL(12,2))) FROM orders i WHERE i.o_custkey = o.o_custkey)")
def scalar_subquery(t: Tables) -> DataFrame:
    """Orders above their customer's mean: compared as sum and count, in decimals."""
    w = Window.partitionBy("o_custkey")
    above = money("o_totalprice") * F.count("*").over(w) > F.sum(money("o_totalprice")).over(w)
    return t.orders.withColumn("above", above).where("above").select("o_orderkey")


@query("SELECT c_custkey, o_orderkey FROM customer, LATERAL (SELECT o_orderkey FROM orders WHERE o_custkey = c_custkey ORDER BY o_totalprice DESC, o_orderkey LIMIT 2) x")
def lateral_top(t: Tables) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    best = t.orders.withColumn("rn", F.row_number().over(w)).where("rn <= 2")
    return t.customer.join(best, F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "o_orderkey")


@query("""SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DECIMAL(28,2)) AS sum_qty, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DECIMAL(28,4)) AS sum_disc, count(*) AS n
FROM lineitem GROUP BY ALL HAVING count(*) > 10""")
def group_having(t: Tables) -> DataFrame:
    disc = money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    sums = F.sum(money("l_quantity")).cast("decimal(28,2)").alias("sum_qty"), F.sum(disc).cast("decimal(28,4)").alias("sum_disc"), F.count("*").alias("n")
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(*sums).where("n > 10")


@query("SELECT o_orderstatus, count(DISTINCT o_custkey) AS customers, count(DISTINCT o_orderpriority) AS priorities FROM orders GROUP BY o_orderstatus")
def distinct_counts(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderstatus").agg(F.count_distinct("o_custkey").alias("customers"), F.count_distinct("o_orderpriority").alias("priorities"))


@query("SELECT user_id, count(*) FILTER (WHERE event_type = 'error') AS errors, count(*) AS n FROM events GROUP BY user_id")
def filtered_counts(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("errors"), F.count("*").alias("n"))


@query("SELECT p_brand, p_type, count(*) AS n, CAST(grouping(p_brand) AS INT) AS g FROM part GROUP BY GROUPING SETS ((p_brand), (p_type), ())")
def grouping_sets(t: Tables) -> DataFrame:
    sets = [[F.col("p_brand")], [F.col("p_type")], []]
    return t.part.groupingSets(sets, "p_brand", "p_type").agg(F.count("*").alias("n"), F.grouping("p_brand").cast("int").alias("g"))


@query("SELECT p_brand, p_type, CAST(sum(p_size) AS BIGINT) AS total FROM part GROUP BY ROLLUP (p_brand, p_type)")
def rollup_parts(t: Tables) -> DataFrame:
    return t.part.rollup("p_brand", "p_type").agg(F.sum("p_size").alias("total"))


@query("SELECT p_brand, p_type, max(p_size) AS largest FROM part GROUP BY CUBE (p_brand, p_type)")
def cube_parts(t: Tables) -> DataFrame:
    return t.part.cube("p_brand", "p_type").agg(F.max("p_size").alias("largest"))


@query("SELECT p_brand, median(p_size) AS mid, quantile_cont(p_size, 0.9) AS p90 FROM part GROUP BY p_brand")
def percentiles(t: Tables) -> DataFrame:
    return t.part.groupBy("p_brand").agg(F.median("p_size").alias("mid"), F.percentile("p_size", F.lit(0.9)).alias("p90"))


@query("SELECT p_type, round(corr(p_size, p_retailprice), 6) AS c, round(covar_samp(p_size, p_retailprice), 4) AS cov, round(var_pop(p_size), 6) AS v FROM part GROUP BY p_type")
def statistics(t: Tables) -> DataFrame:
    return t.part.groupBy("p_type").agg(F.round(F.corr("p_size", "p_retailprice"), 6).alias("c"), F.round(F.covar_samp("p_size", "p_retailprice"), 4).alias("cov"), F.round(F.var_pop("p_size"), 6).alias("v"))


@query("SELECT user_id, arg_max(event_type, ts) AS latest FROM events GROUP BY user_id")
def arg_max(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(F.max_by("event_type", "ts").alias("latest"))


@query("SELECT user_id, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS ids FROM events WHERE event_type = 'signup' GROUP BY user_id")
def ordered_list(t: Tables) -> DataFrame:
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("event_id")), lambda x: x.cast("string")), ",")
    return t.events.where("event_type = 'signup'").groupBy("user_id").agg(ids.alias("ids"))


@query("SELECT o_orderkey, row_number() OVER w AS rn, rank() OVER p AS rk, dense_rank() OVER p AS dr FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), p AS (PARTITION BY o_custkey ORDER BY o_orderpriority)")
def window_ranks(t: Tables) -> DataFrame:
    w, p = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"), Window.partitionBy("o_custkey").orderBy("o_orderpriority")
    return t.orders.select("o_orderkey", *(f.over(x).cast("long").alias(n) for f, x, n in ((F.row_number(), w, "rn"), (F.rank(), p, "rk"), (F.dense_rank(), p, "dr"))))


@query("SELECT p_partkey, ntile(4) OVER (w ORDER BY p_retailprice, p_partkey) AS quart, percent_rank() OVER (w ORDER BY p_size) AS pr, cume_dist() OVER (w ORDER BY p_size) AS cd FROM part WINDOW w AS (PARTITION BY p_brand)")
def window_shares(t: Tables) -> DataFrame:
    by, size = Window.partitionBy("p_brand").orderBy("p_retailprice", "p_partkey"), Window.partitionBy("p_brand").orderBy("p_size")
    return t.part.select("p_partkey", F.ntile(4).over(by).cast("long").alias("quart"), F.percent_rank().over(size).alias("pr"), F.cume_dist().over(size).alias("cd"))


@query("SELECT event_id, lag(event_type) OVER w AS before, lead(event_type, 2) OVER w AS after2, first_value(event_id) OVER w AS first_id FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)")
def window_neighbours(t: Tables) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts")
    return t.events.select("event_id", F.lag("event_type").over(w).alias("before"), F.lead("event_type", 2).over(w).alias("after2"), F.first("event_id").over(w).alias("first_id"))


@query("SELECT event_id, CAST(sum(CAST(value AS DECIMAL(18,4))) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS DECIMAL(28,4)) AS last5 FROM events")
def window_rows(t: Tables) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts").rowsBetween(-4, 0)
    return t.events.select("event_id", F.sum(F.col("value").cast("decimal(18,4)")).over(w).cast("decimal(28,4)").alias("last5"))


@query("SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS day_events FROM events")
def window_range(t: Tables) -> DataFrame:
    micros = F.expr("unix_micros(cast(ts AS timestamp))")
    w = Window.partitionBy("user_id").orderBy(micros).rangeBetween(-86_400_000_000, 0)
    return t.events.select("event_id", F.count("*").over(w).alias("day_events"))


@query("SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts) AS paid FROM events")
def window_last_known(t: Tables) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts")
    return t.events.select("event_id", F.last(F.when(F.col("event_type") == "purchase", F.col("value")), ignorenulls=True).over(w).alias("paid"))


@query("""SELECT user_id, session, count(*) AS n, min(event_id) AS first_id FROM (SELECT *, CAST(sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS BIGINT) AS session FROM
(SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, session""")
def sessions(t: Tables) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts")
    fresh = F.when(F.col("ts") <= F.lag("ts").over(w) + F.expr("INTERVAL 30 MINUTES"), 0).otherwise(1)
    marked = t.events.withColumn("fresh", fresh).withColumn("session", F.sum("fresh").over(w))
    return marked.groupBy("user_id", "session").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 5")
def top_offset(t: Tables) -> DataFrame:
    return t.orders.orderBy(F.desc("o_totalprice"), "o_orderkey").offset(5).limit(20).select("o_orderkey", "o_totalprice")


@query("SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3")
def top_of_group(t: Tables) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return t.orders.withColumn("rn", F.row_number().over(w)).where("rn <= 3").select("o_custkey", "o_orderkey")


@query("SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier")
def union_all(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_nationkey").alias("k")).union(t.supplier.select("s_nationkey"))


@query("SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(t: Tables) -> DataFrame:
    return union_all(t).distinct()


@query("SELECT c_nationkey AS k FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier")
def intersect_all(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_nationkey").alias("k")).intersectAll(t.supplier.select("s_nationkey"))


@query("SELECT c_nationkey AS k FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier")
def except_all(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_nationkey").alias("k")).exceptAll(t.supplier.select("s_nationkey"))


@query("SELECT DISTINCT p_brand, p_type FROM part")
def distinct_rows(t: Tables) -> DataFrame:
    return t.part.select("p_brand", "p_type").distinct()


@query("WITH RECURSIVE r(n, f) AS (SELECT 1, CAST(1 AS BIGINT) UNION ALL SELECT n + 1, f * (n + 1) FROM r WHERE n < 15) SELECT n, f FROM r")
def recursive_cte(t: Tables) -> DataFrame:
    return t.spark.sql("WITH RECURSIVE r(n, f) AS (SELECT 1, CAST(1 AS BIGINT) UNION ALL SELECT n + 1, f * (n + 1) FROM r WHERE n < 15) SELECT n, f FROM r")


@query("SELECT source, count(*) AS n, CAST(sum(quality) AS BIGINT) AS good, CAST(sum(toxic) AS BIGINT) AS toxic FROM documents JOIN labels USING (doc_id) GROUP BY source")
def label_rollup(t: Tables) -> DataFrame:
    """Labels meet the documents' ids and sources alone; sums are partial before the shuffle."""
    both = t.documents.select("doc_id", "source").join(t.labels, "doc_id")
    return both.groupBy("source").agg(F.count("*").alias("n"), F.sum("quality").alias("good"), F.sum("toxic").alias("toxic"))


@query("SELECT CAST(time_bucket(INTERVAL 1 DAY, ts) AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def tumbling_days(t: Tables) -> DataFrame:
    days = t.events.withColumn("ts", F.col("ts").cast("timestamp")).groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"))
    return days.select(F.col("w.start").cast("date").alias("day"), "event_type", "n")
