"""Planning over customers, orders, events and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import planning
from ..queries import query, table


@query("deep_pass_priority", """WITH r AS (SELECT o_custkey AS fund, 10 AS w, 'value_unconfirmed' AS t FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT o_custkey, 3, 'field_unanswered' FROM orders WHERE o_orderpriority = '1-URGENT' UNION ALL SELECT c_custkey, 1, 'series_sources_unreached' FROM customer WHERE c_acctbal < 0)
SELECT fund, sum(w)::BIGINT AS weight, count(*) AS n, string_agg(DISTINCT t, ',' ORDER BY t) AS triggers FROM r GROUP BY fund""")
def deep_pass_priority(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    t = lambda df, fund, field, status: df.select(F.col(fund).alias("fund"), F.lit(field).alias("field"), planning.unanswered_trigger(F.lit(field), F.lit(status), F.lit(False), F.lit(False), F.lit(True)).alias("trigger"))
    parts = [t(o.where("o_orderstatus = 'P'"), "o_custkey", "fees", "ambiguous"), t(o.where("o_orderpriority = '1-URGENT'"), "o_custkey", "manager", "not_found"), t(c.where("c_acctbal < 0"), "c_custkey", "aum_history", "not_found")]
    return planning.deep_pass(parts, "fund").withColumn("weight", F.col("weight").cast("long"))


@query("trigger_case", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'value_unconfirmed' WHEN o_orderstatus = 'O' AND o_orderkey % 2 = 0 THEN 'field_unanswered' END AS trigger FROM orders")
def trigger_case(spark, d):
    status = F.when(F.col("o_orderstatus") == "P", "conflicting").when(F.col("o_orderstatus") == "O", "not_found").otherwise("found")
    done = F.col("o_orderkey") % 2 == 1
    return table(spark, d, "orders").select("o_orderkey", planning.unanswered_trigger(F.lit("fees"), status, done, done, F.lit(False)).alias("trigger"))


@query("audit_triggers", "SELECT l_returnflag, l_linestatus, CASE WHEN l_returnflag = 'R' THEN 'audit_rejected' WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'source_fixable_finding' END AS trigger, count(*) AS n FROM lineitem GROUP BY ALL")
def audit_triggers(spark, d):
    status = F.when(F.col("l_returnflag") == "R", "rejected").when(F.col("l_returnflag") == "N", "suspicious").otherwise("valid")
    li = table(spark, d, "lineitem").withColumn("trigger", planning.audit_trigger(status, F.col("l_linestatus"), ["O"]))
    return li.groupBy("l_returnflag", "l_linestatus", "trigger").agg(F.count("*").alias("n"))


@query("between_sources", "SELECT l_orderkey, count(DISTINCT l_suppkey) > 1 AS between FROM lineitem GROUP BY 1")
def between_sources(spark, d):
    li = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.col("l_suppkey").cast("string")).alias("urls"))
    return li.select("l_orderkey", planning.between_sources(F.col("urls")).alias("between"))


@query("authoritative_copy", """WITH x AS (SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 3 = 0 THEN 'statute' ELSE 'annual_report' END AS kind, 'https://a.cz/' || lpad(o_custkey::VARCHAR, 9, '0') || '/' || lpad(o_orderkey::VARCHAR, 9, '0') || '/doc-' || CASE WHEN o_orderkey % 5 > 0 THEN year(o_orderdate)::VARCHAR ELSE 'x' || o_orderkey % 7 END || '.pdf' AS url, CASE WHEN o_orderkey % 5 > 0 THEN year(o_orderdate) ELSE 0 END AS y, (o_totalprice / 1000)::INT AS score FROM orders)
SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey, kind, CASE WHEN kind = 'statute' THEN 'current' WHEN y > 0 THEN y::VARCHAR ELSE regexp_extract(url, '([^/]*)/*$', 1) END ORDER BY y DESC, score DESC, url DESC) = 1 AS kept FROM x""")
def authoritative_copy(spark, d):
    o = table(spark, d, "orders")
    year = F.when(F.col("o_orderkey") % 5 > 0, F.year("o_orderdate").cast("string")).otherwise(F.concat(F.lit("x"), (F.col("o_orderkey") % 7).cast("string")))
    docs = o.select("o_orderkey", "o_custkey", F.when(F.col("o_custkey") % 3 == 0, "statute").otherwise("annual_report").alias("kind"), F.concat(F.lit("https://a.cz/"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"), F.lit("/"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0"), F.lit("/doc-"), year, F.lit(".pdf")).alias("url"), F.lit("").alias("text"), F.round(F.col("o_totalprice") / 1000).cast("int").alias("score"))
    return planning.authoritative(docs, "o_custkey", "url", "text", "kind", "score", F.lit(0)).select("o_orderkey", "kept")


@query("fallback_actions", """WITH n AS (SELECT c_nationkey, count(*) k FROM customer GROUP BY 1)
SELECT action, priority, count(*) AS n FROM customer JOIN n USING (c_nationkey), (VALUES ('expanded_crawl', 10), ('domain_adapter', 20), ('ocr', 30), ('approved_source:register', 105), ('grounded_llm', 500), ('manual_review', 900)) a(action, priority)
WHERE action IN ('expanded_crawl', 'manual_review') OR action = 'domain_adapter' AND k >= 2 OR action = 'ocr' AND c_acctbal < 0 OR action = 'approved_source:register' AND c_custkey % 2 = 0 OR action = 'grounded_llm' AND c_acctbal > 5000 GROUP BY ALL""")
def fallback_actions(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, "fees").otherwise("manager").alias("field"), F.col("c_nationkey").alias("domain"), (F.col("c_acctbal") < 0).alias("scanned"), (F.col("c_acctbal") > 5000).alias("parsed"))
    return planning.fallback_actions(c, "c_custkey", "field", "domain", "scanned", "parsed", [("register", 5, ["fees"])]).groupBy("action", "priority").agg(F.count("*").alias("n"))


@query("field_quotas", """WITH c AS (SELECT c_mktsegment AS field, count(*) AS n FROM customer GROUP BY 1), t AS (SELECT *, 22 * n / sum(n) OVER () AS exact FROM c),
f AS (SELECT *, least(n, greatest(1, floor(exact)))::INT AS base FROM t),
r AS (SELECT *, row_number() OVER (ORDER BY exact - floor(exact) DESC, field) AS k, 22 - sum(base) OVER () AS rest FROM f)
SELECT field, (base + (k <= rest)::INT)::INT AS quota FROM r""")
def field_quotas(spark, d):
    return planning.field_quotas(table(spark, d, "customer").groupBy("c_mktsegment").count(), "c_mktsegment", "count", 22)


@query("review_sample")
def review_sample(spark, d):
    """A sample of 200 orders for review: fields are priorities, types states, funds customers, the doubtful are dear, recent and of the first of a month."""
    hard = planning.difficulty([(F.col("o_totalprice") > 400_000, 3), (F.col("o_orderdate") >= "1998-01-01", 2), (F.dayofmonth("o_orderdate") == 1, 2)])
    rows = table(spark, d, "orders").withColumn("difficulty", hard)
    return planning.sample(rows, "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "difficulty", 200, "7")


@query("stratified_sample", "SELECT o_orderpriority, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY h, o_orderkey) n FROM (SELECT o_orderpriority, o_orderkey, h FROM (SELECT *, md5('7/' || o_orderkey) h, row_number() OVER (PARTITION BY o_orderpriority, o_custkey ORDER BY md5('7/' || o_orderkey), o_orderkey) g FROM orders) WHERE g <= 3)) WHERE n <= 40")
def stratified_sample(spark, d):
    return planning.stratified(table(spark, d, "orders"), "o_orderpriority", "o_orderkey", "7", 40, "o_custkey", 3).select("o_orderpriority", "o_orderkey")


@query("difficulty_scores", "SELECT l_returnflag, sum((l_quantity > 40)::INT * 3 + (l_tax > 0.05)::INT * 2 + (l_discount = 0)::INT)::BIGINT AS difficulty FROM lineitem GROUP BY 1")
def difficulty_scores(spark, d):
    s = planning.difficulty([(F.col("l_quantity") > 40, 3), (F.col("l_tax") > 0.05, 2), (F.col("l_discount") == 0, 1)])
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.sum(s).cast("long").alias("difficulty"))
