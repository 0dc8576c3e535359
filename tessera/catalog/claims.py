"""Ranking and reconciling claims: lineitems as claims of a part's price by its suppliers, events as series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rank, resolve
from ..plans import audit, rules
from ..queries import query, table

CLAIMS = """claims AS (SELECT l_partkey AS k, floor(l_quantity / 10) AS v, l_suppkey % 7 = 0 AS rebuilt, (l_suppkey % 5)::INT AS authority, l_linenumber % 3 AS scope, (l_suppkey % 4 * 10)::INT AS priority,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 2 END AS evidence, (l_quantity::INT * 3) AS score, l_orderkey AS source_id, CASE WHEN l_linestatus = 'O' THEN 'as_of' ELSE 'published_at' END AS date_kind, l_shipdate::DATE AS date_value FROM lineitem)"""


def claims(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(
        F.col("l_partkey").alias("k"),
        F.floor(F.col("l_quantity") / 10).cast("double").alias("v"),
        (F.col("l_suppkey") % 7 == 0).alias("rebuilt"),
        (F.col("l_suppkey") % 5).cast("int").alias("authority"),
        (F.col("l_linenumber") % 3).alias("scope"),
        (F.col("l_suppkey") % 4 * 10).cast("int").alias("priority"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(2).alias("evidence"),
        (F.col("l_quantity").cast("int") * 3).alias("score"),
        F.col("l_orderkey").alias("source_id"),
        F.when(F.col("l_linestatus") == "O", "as_of").otherwise("published_at").alias("date_kind"),
        F.col("l_shipdate").cast("date").alias("date_value"),
    )


LEADERS = CLAIMS + """, s AS (SELECT *, (CASE WHEN rebuilt THEN 0 ELSE 1 END, authority, scope, priority, evidence, score, -source_id) st FROM claims),
n AS (SELECT *, row_number() OVER (PARTITION BY k, v ORDER BY rebuilt, authority DESC, scope DESC, priority DESC, evidence DESC, score DESC, source_id, date_value DESC) rn, count(*) OVER (PARTITION BY k, v) n_claims FROM claims),
led AS (SELECT * FROM n WHERE rn = 1),
w AS (SELECT k, count(*) n_values, sum(n_claims)::BIGINT n_claims FROM led GROUP BY k), docs AS (SELECT k, min(source_id) = max(source_id) one FROM claims GROUP BY k)"""
PAIRS = LEADERS + """, p AS (SELECT a.k, a.v, b.v bv, (CASE WHEN b.rebuilt THEN 0 ELSE 1 END, b.authority, b.scope, b.priority, b.evidence, b.score, -b.source_id) rival,
  CASE WHEN a.rebuilt = b.rebuilt THEN 0 WHEN b.rebuilt THEN CASE WHEN a.authority >= b.authority AND a.scope >= b.scope THEN 1 ELSE 0 END ELSE CASE WHEN b.authority >= a.authority AND b.scope >= a.scope THEN -1 ELSE 0 END END f1,
  sign(a.authority - b.authority) f2, sign(a.scope - b.scope) f3, sign(a.priority - b.priority) f4, CASE WHEN a.date_kind = b.date_kind THEN sign(a.date_value - b.date_value) ELSE 0 END f5, sign(a.evidence - b.evidence) f6,
  CASE WHEN abs(a.score - b.score) < CASE WHEN docs.one THEN 1 ELSE 25 END THEN 0 ELSE sign(a.score - b.score) END f7
  FROM led a JOIN led b ON a.k = b.k AND a.v <> b.v JOIN docs ON docs.k = a.k),
q AS (SELECT *, CASE WHEN f1 <> 0 THEN f1 WHEN f2 <> 0 THEN f2 WHEN f3 <> 0 THEN f3 WHEN f4 <> 0 THEN f4 WHEN f5 <> 0 THEN f5 WHEN f6 <> 0 THEN f6 ELSE f7 END d,
  CASE WHEN f1 <> 0 THEN 'parser_provenance' WHEN f2 <> 0 THEN 'source_authority' WHEN f3 <> 0 THEN 'scope_specificity' WHEN f4 <> 0 THEN 'document_type' WHEN f5 <> 0 THEN 'information_date' WHEN f6 <> 0 THEN 'evidence_completeness' WHEN f7 <> 0 THEN 'extraction_score' END factor FROM p),
won AS (SELECT k, v, arg_max(factor, rival) decided_by FROM q GROUP BY k, v HAVING min(d) = 1)"""


@query("clear_winner", "WITH " + PAIRS + """ SELECT w.k, CASE WHEN n_values = 1 THEN (SELECT any_value(v) FROM led WHERE led.k = w.k) ELSE won.v END AS v,
  CASE WHEN n_values = 1 THEN 'equivalent_after_normalization' WHEN won.v IS NOT NULL THEN 'auto_resolved' ELSE 'unresolved' END AS outcome, won.decided_by, n_values, n_claims FROM w LEFT JOIN won ON won.k = w.k""")
def clear_winner(spark, d):
    return resolve.resolve(claims(spark, d), ["k"], ["v"]).select("k", "v", "outcome", "decided_by", "n_values", "n_claims")


@query("value_groups", "WITH " + LEADERS + " SELECT k, v, n_claims, source_id AS leader, score FROM led")
def value_groups(spark, d):
    return resolve.leaders(claims(spark, d), ["k"], ["v"]).select("k", "v", "n_claims", F.col("source_id").alias("leader"), "score")


@query("resolve_outcomes", "WITH " + PAIRS + " SELECT CASE WHEN n_values = 1 THEN 'equivalent_after_normalization' WHEN won.v IS NOT NULL THEN 'auto_resolved' ELSE 'unresolved' END AS outcome, won.decided_by, count(*) AS n FROM w LEFT JOIN won ON won.k = w.k GROUP BY ALL")
def resolve_outcomes(spark, d):
    return clear_winner(spark, d).groupBy("outcome", "decided_by").agg(F.count("*").alias("n"))


@query("best_per_key", "SELECT l_partkey, l_returnflag, max(l_extendedprice) AS price, min(l_orderkey) FILTER (l_extendedprice = m) AS l_orderkey FROM (SELECT *, max(l_extendedprice) OVER (PARTITION BY l_partkey, l_returnflag) m FROM lineitem) GROUP BY l_partkey, l_returnflag")
def best_per_key(spark, d):
    got = rank.best(table(spark, d, "lineitem"), ["l_partkey", "l_returnflag"], F.struct("l_extendedprice", -F.col("l_orderkey")), ["l_extendedprice", "l_orderkey"])
    return got.withColumnRenamed("l_extendedprice", "price")


@query("per_domain_cap3", "SELECT c_nationkey, c_custkey FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) n FROM customer) WHERE n <= 3")
def per_domain_cap3(spark, d):
    return rank.cap(table(spark, d, "customer"), ["c_nationkey"], [F.desc("c_acctbal"), "c_custkey"], 3).select("c_nationkey", "c_custkey")


@query("best_tier", "SELECT o_custkey, o_orderkey FROM (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) r FROM orders) WHERE r = 1")
def best_tier(spark, d):
    tier = -F.substring("o_orderpriority", 1, 1).cast("int")
    return rank.best_tier(table(spark, d, "orders"), ["o_custkey"], tier).select("o_custkey", "o_orderkey")


@query("row_slice", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25 OFFSET 10")
def row_slice(spark, d):
    return rank.slice_rows(table(spark, d, "orders"), [F.desc("o_totalprice"), "o_orderkey"], 10, 25).select("o_orderkey", "o_totalprice")


@query("round_robin", "SELECT turn, c_mktsegment, c_custkey FROM (SELECT c_mktsegment, c_custkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) turn FROM customer) ORDER BY turn, c_mktsegment LIMIT 23")
def round_robin(spark, d):
    return rank.round_robin(table(spark, d, "customer"), "c_mktsegment", [F.desc("c_acctbal"), "c_custkey"], 23).select(F.col("turn").cast("long").alias("turn"), "c_mktsegment", "c_custkey")


@query("ambiguity_margin", """SELECT n AS nation, s_suppkey, CASE WHEN s < 30 THEN 'not_found' WHEN s < 60 OR s - s2 < 15 THEN 'review' ELSE 'verified' END AS decision FROM (
  SELECT s_nationkey n, s_suppkey, floor(s_acctbal / 100)::INT s, lead(floor(s_acctbal / 100)::INT) OVER w s2, row_number() OVER w r FROM supplier WINDOW w AS (PARTITION BY s_nationkey ORDER BY floor(s_acctbal / 100)::INT DESC, s_suppkey)) WHERE r = 1""")
def ambiguity_margin(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"), "s_suppkey", F.floor(F.col("s_acctbal") / 100).cast("int").alias("score"))
    return rank.margin_decision(s, ["nation"], "score", ["s_suppkey"], 60, 15).select("nation", "s_suppkey", "decision")


@query("series_build", "SELECT user_id, event_type, count(*) AS points, min(ts::DATE) AS first_day, max(value) AS highest FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, value) n FROM events) WHERE n <= 5 GROUP BY user_id, event_type")
def series_build(spark, d):
    s = audit.series(table(spark, d, "events"), ["user_id", "event_type"], "ts", "value", 5)
    return s.select("user_id", "event_type", F.size("observations").cast("long").alias("points"), F.get("observations", 0)["ts"].cast("date").alias("first_day"), F.array_max(F.transform("observations", lambda o: o["value"])).alias("highest"))


@query("series_frequency", """WITH d AS (SELECT DISTINCT l_suppkey, l_shipdate::DATE AS dy FROM lineitem), g AS (SELECT l_suppkey, dy, lead(dy) OVER (PARTITION BY l_suppkey ORDER BY dy) - dy AS gap FROM d),
  m AS (SELECT l_suppkey, count(*) points, list_sort(list(gap) FILTER (gap IS NOT NULL)) gs FROM g GROUP BY l_suppkey)
SELECT l_suppkey, points, CASE WHEN coalesce(len(gs), 0) = 0 THEN 'irregular' WHEN gs[len(gs) // 2 + 1] <= 10 THEN 'daily' WHEN gs[len(gs) // 2 + 1] <= 45 THEN 'monthly' WHEN gs[len(gs) // 2 + 1] <= 130 THEN 'quarterly' WHEN gs[len(gs) // 2 + 1] <= 400 THEN 'annual' ELSE 'irregular' END AS frequency FROM m""")
def series_frequency(spark, d):
    li = table(spark, d, "lineitem").select("l_suppkey", F.col("l_shipdate").cast("date").alias("day"))
    return audit.series_frequency(li, ["l_suppkey"], "day")


@query("authority_case", "SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 4 WHEN 1 THEN 3 WHEN 2 THEN 1 ELSE 0 END AS rank, CASE WHEN s_suppkey % 3 = 0 THEN 0 WHEN s_suppkey % 3 = 1 THEN 1 ELSE 2 END AS evidence FROM supplier")
def authority_case(spark, d):
    name = F.get(F.array(*map(F.lit, ["official_fund", "fund_specific_manager", "external_fallback", "unknown"])), F.pmod("s_suppkey", F.lit(4)).cast("int"))
    k = F.col("s_suppkey") % 3
    return table(spark, d, "supplier").select("s_suppkey", resolve.authority_rank(name).alias("rank"), resolve.evidence_rank(F.when(k == 0, "  ").otherwise("text"), F.lit(True), F.when(k == 2, 4)).alias("evidence"))


@query("severity_worst", "SELECT o_custkey, CASE max(CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 2 ELSE 1 END) WHEN 3 THEN 'rejected' WHEN 2 THEN 'conflicting' ELSE 'suspicious' END AS status FROM orders GROUP BY o_custkey")
def severity_worst(spark, d):
    sev = F.when(F.col("o_orderstatus") == "F", "reject").when(F.col("o_orderstatus") == "O", "conflict").otherwise("review")
    return rules.worst(table(spark, d, "orders").select("o_custkey", sev.alias("severity")), ["o_custkey"])


@query("conflict_report", "WITH " + PAIRS + """, r AS (SELECT w.k, n_claims, CASE WHEN n_values = 1 THEN 'equivalent_after_normalization' WHEN won.v IS NOT NULL THEN 'auto_resolved' ELSE 'unresolved' END AS outcome, won.decided_by FROM w LEFT JOIN won ON won.k = w.k WHERE n_claims > 1)
SELECT 'outcome' AS section, outcome AS name, outcome, count(*) AS n FROM r GROUP BY outcome UNION ALL SELECT 'field', 'field ' || k % 5, outcome, count(*) FROM r GROUP BY k % 5, outcome
UNION ALL SELECT 'decided_by', coalesce(decided_by, 'undecided'), outcome, count(*) FROM r WHERE outcome <> 'equivalent_after_normalization' GROUP BY decided_by, outcome""")
def conflict_report(spark, d):
    rows = clear_winner(spark, d).withColumn("field", F.concat(F.lit("field "), F.col("k") % 5))
    return audit.conflict_report(rows, "field")
