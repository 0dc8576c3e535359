"""Validation, audit and delivery over orders, lineitems and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import audit, rules
from ..queries import query, table


@query("constraint_findings", """SELECT o_orderkey, code, severity FROM (SELECT o_orderkey, unnest([
  CASE WHEN cur = 'JPY' THEN 'unsupported_currency|review' END,
  CASE WHEN a = 0 THEN 'zero_minimum_investment|review' WHEN cur = 'CZK' AND a < 1000 OR cur = 'EUR' AND a < 100 THEN 'implausibly_small_minimum_investment|review' WHEN cur = 'CZK' AND a < 100000 OR cur = 'EUR' AND a < 5000 THEN 'below_qualified_investor_threshold|review' END,
  CASE WHEN a <> 0 AND a <> floor(a) THEN 'non_round_minimum_investment|review' END]) AS f FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN 0 WHEN o_orderkey % 2 = 0 THEN floor(o_totalprice) ELSE o_totalprice END AS a, CASE o_orderkey % 3 WHEN 0 THEN 'CZK' WHEN 1 THEN 'EUR' ELSE 'JPY' END AS cur FROM orders)), LATERAL (SELECT split_part(f, '|', 1) AS code, split_part(f, '|', 2) AS severity) WHERE f IS NOT NULL""")
def constraint_findings(spark, d):
    a = F.when(F.col("o_orderkey") % 50 == 0, 0.0).when(F.col("o_orderkey") % 2 == 0, F.floor("o_totalprice").cast("double")).otherwise(F.col("o_totalprice"))
    cur = F.get(F.array(*map(F.lit, ["CZK", "EUR", "JPY"])), F.pmod("o_orderkey", F.lit(3)).cast("int"))
    o = table(spark, d, "orders").select("o_orderkey", a.alias("a"), cur.alias("c"))
    return rules.exploded(o, ["o_orderkey"], rules.minimum_investment(F.col("a"), F.col("c"), F.lit(None).cast("string")))


@query("horizon_findings", "SELECT p_partkey, CASE WHEN p_size = 50 THEN 'calendar_year_as_horizon' ELSE 'implausible_horizon' END AS code FROM part WHERE p_size = 50 OR p_size > 30")
def horizon_findings(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.when(F.col("p_size") == 50, 2024.0).otherwise(F.col("p_size").cast("double")).alias("y"))
    return rules.exploded(p, ["p_partkey"], rules.horizon(F.col("y"))).select("p_partkey", "code")


@query("fee_findings", "SELECT p_partkey, 'unusually_high_fee_rate' AS code FROM part WHERE p_size > CASE WHEN p_partkey % 2 = 0 THEN 10 ELSE 15 END")
def fee_findings(spark, d):
    n = F.lit(None).cast("double")
    kind = F.when(F.col("p_partkey") % 2 == 0, "entry").otherwise("ongoing")
    f = rules.fee_item(kind, F.col("p_size").cast("double"), n, n, F.lit(True), n, F.lit("CZK"))
    return rules.exploded(table(spark, d, "part"), ["p_partkey"], f).select("p_partkey", "code")


@query("capital_findings", "SELECT o_orderkey, code FROM (SELECT o_orderkey, unnest([CASE WHEN o_totalprice < 1000 THEN 'per_share_value_as_aum' WHEN o_totalprice < 1000000 THEN 'implausibly_small_aum' END, CASE WHEN o_orderdate::DATE > DATE '2001-01-01' THEN 'future_as_of_date' END, CASE WHEN DATE '2001-01-01' - o_orderdate::DATE > 1825 THEN 'outdated_as_of_date' END]) AS code FROM orders) WHERE code IS NOT NULL")
def capital_findings(spark, d):
    o = table(spark, d, "orders")
    c = rules.capital(F.col("o_totalprice"), F.lit("CZK"), F.lit("fund_capital"), F.col("o_orderdate").cast("date"), F.lit("2001-01-01").cast("date"))
    return rules.exploded(o, ["o_orderkey"], c).select("o_orderkey", "code")


@query("series_conflicts", "SELECT l_suppkey AS fund, 'conflicting_annual_returns' AS code, 'conflict' AS severity FROM (SELECT l_suppkey, year(l_shipdate) y, l_returnflag, max(l_tax) - min(l_tax) s FROM lineitem GROUP BY ALL) WHERE s > 0.05 GROUP BY l_suppkey")
def series_conflicts(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("fund"), F.year("l_shipdate").alias("year"), F.lit("calendar_year").alias("series"), F.col("l_returnflag").alias("share_class"), F.col("l_tax").alias("rate"))
    return rules.annual_returns(li, "fund")


@query("mixed_class", "SELECT user_id AS fund, 'mixed_share_classes_in_series' AS code FROM events GROUP BY user_id, event_type HAVING bool_or(value < 20) AND bool_or(value >= 20) UNION SELECT user_id, 'duplicate_dates_in_series' FROM events GROUP BY user_id, event_type, value < 20, ts::DATE HAVING count(*) > 1")
def mixed_class(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("fund"), F.col("event_type").alias("kind"), F.when(F.col("value") >= 20, "A").alias("share_class"), F.lit("CZK").alias("currency"), F.col("ts").cast("date").alias("as_of"), "value")
    return rules.historical_series(e, "fund", F.lit("2100-01-01").cast("date")).select("fund", "code")


@query("duplicate_dates", "SELECT l_suppkey, l_shipdate::DATE AS day, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_dates(spark, d):
    return table(spark, d, "lineitem").groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("day")).agg(F.count("*").alias("n")).where("n > 1")


@query("future_or_stale", "SELECT l_returnflag, sum((l_shipdate::DATE > DATE '2000-06-30')::INT)::BIGINT AS future, sum((DATE '2000-06-30' - l_shipdate::DATE > 1825)::INT)::BIGINT AS stale FROM lineitem GROUP BY l_returnflag")
def future_or_stale(spark, d):
    a, b = rules.dated(F.col("l_shipdate").cast("date"), F.lit("2000-06-30").cast("date"))
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.count(a).alias("future"), F.count(b).alias("stale"))


def values_and_series(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("fund"), "o_orderkey", F.col("o_totalprice").alias("amount"), F.lit("CZK").alias("currency"), F.lit("nav").alias("metric"), F.col("o_orderdate").cast("date").alias("as_of"))
    return o.where("o_orderkey % 10 = 0"), o.where("o_orderkey % 10 > 0")


@query("cross_superseded", "WITH s AS (SELECT o_custkey f, max(o_orderdate::DATE) m, max((o_orderdate::DATE, o_totalprice)) x FROM orders WHERE o_orderkey % 10 > 0 GROUP BY 1) SELECT o_custkey AS fund, o_orderdate::DATE AS as_of, m AS latest FROM orders JOIN s ON f = o_custkey WHERE o_orderkey % 10 = 0 AND m > o_orderdate::DATE")
def cross_superseded(spark, d):
    v, s = values_and_series(spark, d)
    return rules.superseded(v, s, "fund").select("fund", "as_of", "latest")


@query("cross_disagreeing", "SELECT a.l_suppkey AS fund, count(*) AS n FROM lineitem a JOIN lineitem b ON a.l_suppkey = b.l_suppkey AND a.l_shipdate = b.l_shipdate WHERE a.l_orderkey % 100 = 0 AND b.l_orderkey % 100 > 0 GROUP BY 1 HAVING bool_and(abs(a.l_extendedprice - b.l_extendedprice) / greatest(a.l_extendedprice, b.l_extendedprice) > 0.01)")
def cross_disagreeing(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("fund"), "l_orderkey", F.col("l_extendedprice").alias("amount"), F.lit("CZK").alias("currency"), F.lit("nav").alias("metric"), F.col("l_shipdate").cast("date").alias("as_of"))
    return rules.disagreeing(li.where("l_orderkey % 100 = 0"), li.where("l_orderkey % 100 > 0"), "fund")


@query("cross_equal_band", "SELECT DISTINCT a.l_partkey FROM lineitem a JOIN lineitem b ON a.l_partkey = b.l_partkey AND abs(a.l_extendedprice - b.l_extendedprice) < 25.0 WHERE a.l_returnflag = 'R' AND b.l_returnflag = 'N'")
def cross_equal_band(spark, d):
    li = table(spark, d, "lineitem")
    return rules.equal_within(li.where("l_returnflag = 'R'"), li.where("l_returnflag = 'N'"), ["l_partkey"], "l_extendedprice", "l_extendedprice", 25.0)


@query("party_conflicts", "SELECT s_suppkey AS fund FROM supplier WHERE s_suppkey % 4 = 1")
def party_conflicts(spark, d):
    s = table(spark, d, "supplier")
    a = s.select(F.col("s_suppkey").alias("fund"), F.lit("manager").alias("role"), F.concat("s_name", F.lit(", a.s.")).alias("name"), F.lit("12345678").alias("ico"))
    b = s.select(F.col("s_suppkey").alias("fund"), F.lit("administrator").alias("role"), F.concat(F.upper("s_name"), F.lit(" A. S.")).alias("name"), F.when(F.col("s_suppkey") % 4 == 1, "87654321").otherwise("12345678").alias("ico"))
    return rules.same_company_other_number(a.union(b), "fund")


@query("collapse_findings", "SELECT l_orderkey, l_returnflag AS code, CASE max(CASE WHEN l_quantity > 40 THEN 3 WHEN l_quantity > 20 THEN 2 ELSE 1 END) WHEN 3 THEN 'reject' WHEN 2 THEN 'conflict' ELSE 'review' END AS severity FROM lineitem GROUP BY ALL")
def collapse_findings(spark, d):
    return rules.collapse(found(spark, d), ["l_orderkey"])


def found(spark, d):
    q = F.col("l_quantity")
    return table(spark, d, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("code"), F.when(q > 40, "reject").when(q > 20, "conflict").otherwise("review").alias("severity"))


@query("verdict_worst", "SELECT l_orderkey, CASE WHEN max(l_quantity) > 40 THEN 'rejected' WHEN max(l_quantity) > 20 THEN 'conflicting' ELSE 'suspicious' END AS status FROM lineitem GROUP BY l_orderkey")
def verdict_worst(spark, d):
    return rules.worst(found(spark, d), ["l_orderkey"])


@query("audit_counts", "SELECT l_returnflag, l_linestatus, l_linenumber, grouping(l_returnflag, l_linestatus, l_linenumber)::BIGINT AS level, count(*) AS n FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), (l_linenumber), (l_returnflag, l_linestatus), (l_returnflag, l_linenumber), ())")
def audit_counts(spark, d):
    return audit.counts(table(spark, d, "lineitem"), [["l_returnflag"], ["l_linestatus"], ["l_linenumber"], ["l_returnflag", "l_linestatus"], ["l_returnflag", "l_linenumber"], []])


@query("weakest_groups", "SELECT o_orderpriority AS field, count(*) FILTER (o_orderstatus <> 'P') AS delivered, count(*) FILTER (o_orderstatus = 'F') AS doubted, round(count(*) FILTER (o_orderstatus = 'F') / count(*) FILTER (o_orderstatus <> 'P'), 9) AS share FROM orders GROUP BY 1")
def weakest_groups(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderpriority").alias("field"), F.when(F.col("o_orderstatus") == "O", "valid").when(F.col("o_orderstatus") == "P", "missing").otherwise("rejected").alias("status"))
    return audit.weakest(o, "field", "status").withColumn("share", F.round("share", 9))


@query("shared_sources", "SELECT l_partkey AS url, count(DISTINCT l_suppkey) AS names FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1")
def shared_sources(spark, d):
    return audit.shared(table(spark, d, "lineitem"), "l_partkey", "l_suppkey").select(F.col("l_partkey").alias("url"), "names")


@query("review_examples", "SELECT status, reason, event_id FROM (SELECT *, row_number() OVER (PARTITION BY status ORDER BY event_id) n FROM (SELECT event_type AS status, user_id AS reason, min(event_id) AS event_id FROM events GROUP BY ALL)) WHERE n <= 5")
def review_examples(spark, d):
    e = table(spark, d, "events").select(F.col("event_type").alias("status"), F.col("user_id").alias("reason"), "event_id")
    return audit.examples(e, "status", "reason", ["event_id"])


@query("masked_delivery", "SELECT o_orderkey, CASE WHEN ok THEN 'found' ELSE 'not_found' END AS status, CASE WHEN ok THEN o_totalprice END AS value, CASE WHEN ok THEN 'https://a.cz/' || o_orderkey END AS source_url FROM (SELECT *, o_orderstatus <> 'P' AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 48) ok FROM orders)")
def masked_delivery(spark, d):
    doubts = table(spark, d, "lineitem").where("l_quantity > 48").select(F.col("l_orderkey").alias("o_orderkey"), F.lit("suspicious").alias("status"))
    blocked = audit.blocked(doubts, ["suspicious", "conflicting", "rejected"], ["o_orderkey"])
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", "found").otherwise("pending").alias("status"), F.col("o_totalprice").alias("value"), F.concat(F.lit("https://a.cz/"), "o_orderkey").alias("url"))
    return audit.delivered(o, blocked, ["o_orderkey"], "status", "value", "url")


@query("gate_mismatch", "SELECT * FROM (VALUES ('digest', 'digest differs'), ('fine', NULL), ('rules', 'ruleset differs'), ('unknown', 'unknown: 1')) v(name, reason)")
def gate_mismatch(spark, d):
    o, c = table(spark, d, "orders").select(F.col("o_custkey").alias("k")), table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    some = c.where("k <> 1")
    rows = [("digest", audit.gate("a", "b", "1", "1", o, c, "k", None)), ("fine", audit.gate("a", "a", "1", "1", o, c, "k", None)), ("rules", audit.gate("a", "a", "1", "2", o, c, "k", None)), ("unknown", audit.gate("a", "a", "1", "1", o.where("k = 1").union(c.where("k = 1")), some, "k", None))]
    return spark.createDataFrame(rows, "name string, reason string")


@query("allowlist_projection", "SELECT c_custkey, c_name AS name, c_nationkey AS nation FROM customer")
def allowlist_projection(spark, d):
    s = table(spark, d, "customer").select("c_custkey", F.struct(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("secret")).alias("v"))
    return s.select("c_custkey", audit.allow_list("v", ["name", "nation"]).alias("v")).select("c_custkey", "v.*")


@query("delivery_summary", "SELECT 'o_orderkey' AS field, count(*) AS found FROM orders UNION ALL SELECT 'final', count(*) FILTER (o_orderstatus = 'F') FROM orders UNION ALL SELECT 'large', count(*) FILTER (o_totalprice > 300000) FROM orders")
def delivery_summary(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", F.lit(1).cast("long")).alias("final"), F.when(F.col("o_totalprice") > 300000, F.lit(1).cast("long")).alias("large"))
    return audit.summary(o, ["o_orderkey", "final", "large"])


@query("found_histogram", "WITH c AS (SELECT least(count(o_orderkey), 25) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey) SELECT r.n::INT AS n, count(c.n) AS rows FROM range(26) r(n) LEFT JOIN c ON c.n = r.n GROUP BY r.n")
def found_histogram(spark, d):
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("k"))
    c = table(spark, d, "customer").join(o, "c_custkey", "left")
    return audit.histogram(c, "c_custkey", F.least(F.coalesce("k", F.lit(0)), F.lit(25)).cast("int"), 25)


@query("field_states", "SELECT c_custkey, 'balance' AS field, CASE WHEN c_acctbal > 0 THEN 'found' ELSE 'not_found' END AS value FROM customer UNION ALL SELECT c_custkey, 'segment', c_mktsegment FROM customer")
def field_states(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_acctbal") > 0, "found").otherwise("not_found").alias("balance"), F.col("c_mktsegment").alias("segment"))
    return audit.wide_to_long(c, ["c_custkey"], ["balance", "segment"])


@query("status_pivot", "SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS \"F\", count(*) FILTER (o_orderstatus = 'O') AS \"O\", count(*) FILTER (o_orderstatus = 'P') AS \"P\" FROM orders GROUP BY 1")
def status_pivot(spark, d):
    return table(spark, d, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1)))


@query("page_retention", "SELECT l_suppkey, round(sum(l_tax) / nullif(sum(CASE WHEN l_discount > 0.09 THEN l_discount ELSE 0 END), 0), 6) AS ratio FROM lineitem GROUP BY 1")
def page_retention(spark, d):
    li = table(spark, d, "lineitem")
    return li.groupBy("l_suppkey").agg(F.round(F.try_divide(F.sum("l_tax"), F.sum(F.when(F.col("l_discount") > 0.09, F.col("l_discount")).otherwise(0.0))), 6).alias("ratio"))
