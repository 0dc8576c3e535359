"""Keyed state and generations: events as a log, orders by year as generations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import deltas, state
from ..plans import audit
from ..queries import query, table


@query("upsert_latest", "SELECT user_id, event_type, min(ts) AS discovered_at, arg_max(value, event_id) AS value, max(event_id) AS event_id FROM events GROUP BY user_id, event_type")
def upsert_latest(spark, d):
    e = table(spark, d, "events").select("user_id", "event_type", "event_id", "value", F.col("ts").alias("discovered_at"))
    first = state.upsert(e.where("event_id % 7 = 0").limit(0), e.where("event_id < 5000"), ["user_id", "event_type"], "event_id", ("discovered_at",))
    return state.upsert(first, e.where("event_id >= 5000"), ["user_id", "event_type"], "event_id", ("discovered_at",)).select("user_id", "event_type", "discovered_at", "value", "event_id")


@query("upsert_new_wins", "WITH o AS (SELECT *, 0 AS g FROM events WHERE event_id >= 4000), n AS (SELECT *, 1 AS g FROM events WHERE event_id < 4000) SELECT user_id, arg_max(value, (g, event_id)) AS value FROM (SELECT * FROM o UNION ALL SELECT * FROM n) GROUP BY user_id")
def upsert_new_wins(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "value")
    return state.upsert(e.where("event_id >= 4000"), e.where("event_id < 4000"), ["user_id"], "event_id").select("user_id", "value")


@query("null_key_upsert", "SELECT CASE WHEN k = '' THEN NULL ELSE k END AS segment, max(c_custkey) AS c_custkey FROM (SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE c_mktsegment END k FROM customer) GROUP BY k")
def null_key_upsert(spark, d):
    seg = F.when((F.col("c_mktsegment") == "MACHINERY") & (F.col("c_custkey") % 2 == 0), None).when(F.col("c_mktsegment") == "MACHINERY", "").otherwise(F.col("c_mktsegment"))
    c = table(spark, d, "customer").select(seg.alias("segment"), "c_custkey")
    return state.upsert(c.where("c_custkey < 700"), c.where("c_custkey >= 700"), ["segment"], "c_custkey")


@query("sync_delete", "SELECT o_orderkey FROM orders o WHERE EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c_acctbal > 0)")
def sync_delete(spark, d):
    good = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return state.delete_missing(table(spark, d, "orders"), good, "o_custkey").select("o_orderkey")


@query("synchronise_output", "SELECT c_custkey, coalesce(s.n, 0) AS n, CASE WHEN s.n IS NULL THEN 'pending' ELSE 'found' END AS status FROM customer LEFT JOIN (SELECT o_custkey, count(*) n FROM orders GROUP BY o_custkey) s ON s.o_custkey = c_custkey")
def synchronise_output(spark, d):
    made = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n")).withColumn("status", F.lit("found"))
    return state.synchronise(made, table(spark, d, "customer").select("c_custkey"), "c_custkey", {"n": F.lit(0).cast("long"), "status": F.lit("pending")}).select("c_custkey", "n", "status")


@query("attempt_latest_status", "SELECT user_id, arg_max(event_type, (ts, event_id)) AS status, max(ts) AS at FROM events GROUP BY user_id")
def attempt_latest_status(spark, d):
    return state.latest(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], ["event_type", "ts"]).select("user_id", F.col("event_type").alias("status"), F.col("ts").alias("at"))


@query("fk_orphans", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def fk_orphans(spark, d):
    return state.orphans(table(spark, d, "orders").select("o_orderkey"), table(spark, d, "lineitem"), "o_orderkey", "l_orderkey")


@query("duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark, d):
    return state.duplicates(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


GEN = "b AS (SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) s FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1), a AS (SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) s FROM orders WHERE o_orderkey % 2 = 1 GROUP BY 1)"


def generations(spark, d):
    o = table(spark, d, "orders")
    g = lambda r: state.latest(o.where(f"o_orderkey % 2 = {r}"), ["o_custkey"], ["o_orderkey"], ["o_orderstatus"])
    return g(0), g(1)


@query("status_transitions", f"WITH {GEN} SELECT b.s AS before, a.s AS after, count(*) AS n FROM b JOIN a USING (o_custkey) GROUP BY ALL")
def status_transitions(spark, d):
    b, a = generations(spark, d)
    return deltas.transitions(b, a, "o_custkey", "o_orderstatus")


@query("generation_delta", f"WITH {GEN} SELECT coalesce(b.o_custkey, a.o_custkey) AS o_custkey, CASE WHEN b.s IS NULL THEN 'A' WHEN a.s IS NULL THEN 'lost' WHEN a.s <> b.s THEN 'B' ELSE 'same' END AS kind FROM b FULL JOIN a ON a.o_custkey = b.o_custkey")
def generation_delta(spark, d):
    b, a = generations(spark, d)
    return deltas.delta(b, a, ["o_custkey"], "o_orderstatus")


@query("first_writer_wins", "SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000) THEN 'baseline' WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1 THEN 'written' ELSE 'corroborating' END AS role FROM orders")
def first_writer_wins(spark, d):
    base = table(spark, d, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    return deltas.first_writer(base, table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_orderkey", "role")


@query("running_coverage", "SELECT year, n, sum(n) OVER (ORDER BY year)::BIGINT AS upto FROM (SELECT year(o_orderdate) AS year, count(*) AS n FROM orders GROUP BY 1)")
def running_coverage(spark, d):
    return deltas.running_coverage(table(spark, d, "orders").withColumn("year", F.year("o_orderdate").cast("long")), "year", F.count("*"))


@query("retry_merge_better", "WITH b AS (SELECT o_custkey k, count(*) n, round(sum(o_totalprice), 2) v FROM orders WHERE year(o_orderdate) < 1996 GROUP BY 1), r AS (SELECT o_custkey k, count(*) n, round(sum(o_totalprice), 2) v FROM orders WHERE year(o_orderdate) >= 1996 GROUP BY 1) SELECT b.k AS k, CASE WHEN r.n - b.n >= 2 THEN r.n ELSE b.n END AS n, coalesce(r.n - b.n >= 2, false) AS replaced FROM b LEFT JOIN r ON r.k = b.k")
def retry_merge_better(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.year("o_orderdate").alias("y"), "o_totalprice")
    agg = lambda x: x.groupBy("k").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("v"))
    return deltas.better_retry(agg(o.where("y < 1996")), agg(o.where("y >= 1996")), "k", ["n", "v"], 2).select("k", "n", "replaced")


@query("funnel_loss", "WITH s AS (SELECT CASE WHEN c_acctbal <= 0 THEN 'balance' WHEN NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) THEN 'orders' WHEN c_nationkey > 90 THEN 'nation' ELSE 'done' END AS stage FROM customer) SELECT v.stage, count(s.stage) AS n FROM (VALUES ('balance'), ('orders'), ('nation'), ('done')) v(stage) LEFT JOIN s ON s.stage = v.stage GROUP BY v.stage")
def funnel_loss(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("has", F.lit(True))
    c = table(spark, d, "customer").join(o, "c_custkey", "left")
    return deltas.funnel(c, [("balance", F.col("c_acctbal") > 0), ("orders", F.coalesce("has", F.lit(False))), ("nation", F.col("c_nationkey") <= 90)])


@query("coverage_split", "SELECT part, count(*) AS n FROM (SELECT CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) THEN 'covered' WHEN c_nationkey % 3 > 0 THEN 'new_with_web' ELSE 'new_without_web' END AS part FROM customer) GROUP BY part")
def coverage_split(spark, d):
    c = table(spark, d, "customer").withColumn("web", F.when(F.col("c_nationkey") % 3 > 0, "https://a.cz").when(F.col("c_custkey") % 2 == 0, "  "))
    seen = table(spark, d, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return deltas.coverage(c, seen, "c_custkey", "web").groupBy("part").agg(F.count("*").alias("n"))


@query("missing_groups", "WITH f AS (SELECT o_custkey, list_distinct(list(o_orderpriority)) p FROM orders GROUP BY o_custkey) SELECT o_custkey, concat_ws(',', CASE WHEN NOT list_has_any(p, ['1-URGENT', '2-HIGH']) THEN 'fast' END, CASE WHEN NOT list_has_any(p, ['5-LOW']) THEN 'slow' END) AS missing FROM f")
def missing_groups(spark, d):
    f = table(spark, d, "orders").groupBy("o_custkey").agg(F.collect_set("o_orderpriority").alias("p"))
    return f.select("o_custkey", F.array_join(deltas.missing_groups({"fast": ["1-URGENT", "2-HIGH"], "slow": ["5-LOW"]}, F.col("p")), ",").alias("missing"))


@query("zero_filled_levels", "SELECT l.level, count(e.event_type) AS n FROM (VALUES ('error'), ('click'), ('refund')) l(level) LEFT JOIN events e ON e.event_type = l.level GROUP BY l.level")
def zero_filled_levels(spark, d):
    c = table(spark, d, "events").groupBy(F.col("event_type").alias("level")).agg(F.count("*").alias("n"))
    return deltas.zero_filled(c, "level", ["error", "click", "refund"])


@query("semi_and_anti", "SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AS has_final FROM customer")
def semi_and_anti(spark, d):
    c, o = table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return c.join(o, "c_custkey", "left_semi").withColumn("has_final", F.lit(True)).union(c.join(o, "c_custkey", "left_anti").withColumn("has_final", F.lit(False)))


@query("set_differences", "SELECT 'both' AS part, count(*) AS n FROM (SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL SELECT 'only_customers', count(*) FROM (SELECT c_nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier)")
def set_differences(spark, d):
    a, b = table(spark, d, "customer").select("c_nationkey"), table(spark, d, "supplier").select("s_nationkey")
    n = lambda x, part: x.agg(F.count("*").alias("n")).select(F.lit(part).alias("part"), "n")
    return n(a.intersect(b), "both").union(n(a.distinct().exceptAll(b.distinct()), "only_customers"))


@query("repeated_errors", "SELECT level, count(*) AS n FROM (SELECT CASE WHEN c >= 500 AND sum((c >= 500)::INT) OVER (PARTITION BY user_id) >= 20 THEN 'host_failing' WHEN c >= 500 THEN 'failure' WHEN c = 404 THEN 'expected_miss' ELSE 'warning' END AS level FROM (SELECT user_id, CASE event_type WHEN 'error' THEN 503 WHEN 'view' THEN 404 ELSE 400 END c FROM events)) GROUP BY level")
def repeated_errors(spark, d):
    code = F.when(F.col("event_type") == "error", 503).when(F.col("event_type") == "view", 404).otherwise(400)
    return audit.repeated_errors(table(spark, d, "events"), "user_id", code, 20).groupBy("level").agg(F.count("*").alias("n"))
