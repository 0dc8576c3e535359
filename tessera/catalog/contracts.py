"""Contracts of records, dense ids of appended events, and fees by clause."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lines, state
from ..queries import query, table
from ..sources import contracts
from ..sources.contracts import Record, Text
from ..sources.schemas import DOMAINS


@query("contract_violations", """WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, CASE o_orderstatus WHEN 'F' THEN 'found' WHEN 'P' THEN 'pending' ELSE 'not_found' END AS status, o_orderpriority = '5-LOW' AS unsure FROM orders)
SELECT k AS o_orderkey, ((k % 11 = 0)::INT + CASE WHEN c % 5 > 0 THEN (k % 120 > 100)::INT + (k % 3 = 2)::INT ELSE 0 END + (k % 13 = 0)::INT + (k % 4 = 0)::INT + unsure::INT
+ CASE status WHEN 'found' THEN (c % 5 = 0)::INT + (k % 7 = 0)::INT + (k % 2)::INT WHEN 'pending' THEN (c % 5 > 0)::INT + 1 + (k % 2)::INT ELSE (k % 2 = 0)::INT + (c % 5 > 0)::INT END)::INT AS n FROM o""")
def contract_violations(spark, d):
    """Violations of a horizon's contract in records made of orders."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    status = F.when(F.col("o_orderstatus") == "F", "found").when(F.col("o_orderstatus") == "P", "pending").otherwise("not_found")
    value = F.when(c % 5 > 0, F.struct((k % 120).cast("double").alias("recommended_years"), F.element_at(F.array(*map(F.lit, ("exact", "minimum", "other"))), (k % 3 + 1).cast("int")).alias("kind")))
    source = F.struct(F.concat(F.when(k % 13 == 0, "ftp://").otherwise("https://"), F.lit("a.cz/"), k).alias("url"), F.lit(None).cast("string").alias("quote"), (k % 4).alias("page"))
    extraction = F.struct(F.lit("regex").alias("method"), F.when(F.col("o_orderpriority") == "5-LOW", "unsure").otherwise("high").alias("confidence"), F.lit(False).alias("review_required"))
    reason = F.when(k % 2 == 1, F.struct(F.lit("x").alias("code"), F.lit(None).cast("string").alias("detail")))
    field = F.struct(status.alias("status"), value.alias("value"), F.when(k % 7 > 0, "5 let").alias("raw_value"), source.alias("source"), extraction.alias("extraction"), reason.alias("reason"))
    mark = F.concat(F.when(k % 11 == 0, "FUND_").otherwise("fund_"), F.left(F.md5(c.cast("string")), F.lit(16)))
    node = Record({"fund_id": Text(DOMAINS["fund_id"]), "investment_horizon": contracts.field_contract(contracts.HORIZON)}, ("fund_id", "investment_horizon"))
    record = F.struct(mark.alias("fund_id"), field.alias("investment_horizon"))
    return table(spark, d, "orders").select("o_orderkey", F.size(contracts.checked(record, node)).alias("n"))


@query("event_ids", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS id FROM events")
def event_ids(spark, d):
    return state.numbered(table(spark, d, "events").select("event_id", "ts"), ["ts", "event_id"]).select("event_id", "id")


@query("appended_events", "SELECT event_id, row_number() OVER (ORDER BY event_type <> 'click', ts, event_id) AS id FROM events")
def appended_events(spark, d):
    """Clicks are recorded first, then all events, then all of them again."""
    e = table(spark, d, "events").select("event_id", "ts", "event_type")
    log = state.appended(e.withColumn("id", F.lit(0).cast("long")).limit(0), e.where("event_type = 'click'"), ["event_id"], ["ts"])
    for _ in range(2):
        log = log.unionByName(state.appended(log, e, ["event_id"], ["ts"])).checkpoint()
    return log.select("event_id", "id")


@query("clause_tiers", """WITH o AS (SELECT o_orderkey AS k, o_orderkey % 5 + 1 AS a, o_custkey % 9 + 1 AS r FROM orders)
SELECT k AS o_orderkey, 2 AS n, CASE WHEN k % 3 = 2 THEN 12 ELSE 0 END AS from_month, (CASE WHEN k % 3 = 2 THEN a + 1 ELSE a END * 12)::INT AS to_month, r::DOUBLE AS first_rate, CASE WHEN k % 3 = 2 THEN 0.0 ELSE r / 2.0 END::DOUBLE AS last_rate FROM o""")
def clause_tiers(spark, d):
    """Exit fees worded with the period first, with the rate first, and as a range."""
    k, s = F.col("o_orderkey"), lambda x: x.cast("string")
    a, r = k % 5 + 1, F.col("o_custkey") % 9 + 1
    half = F.replace(s(r / 2), F.lit("."), F.lit(","))
    text = (
        F.when(k % 3 == 0, F.concat(F.lit("vystupni poplatek do "), s(a), F.lit(" let "), s(r), F.lit(" %, po "), s(a), F.lit(" letech "), half, F.lit(" %")))
        .when(k % 3 == 1, F.concat(F.lit("vystupni poplatek "), half, F.lit(" % po "), s(a), F.lit(" letech, "), s(r), F.lit(" % do "), s(a), F.lit(" let")))
        .otherwise(F.concat(F.lit("od 1 do "), s(a + 1), F.lit(" let "), s(r), F.lit(" %; nad "), s(a + 1), F.lit(" roku 0 %")))
    )
    t = table(spark, d, "orders").select("o_orderkey", lines.clause_tiers(text).alias("t"))
    return t.select("o_orderkey", F.size("t").alias("n"), F.col("t")[0]["from_month"].alias("from_month"), F.col("t")[0]["to_month"].alias("to_month"), F.col("t")[0]["rate"].alias("first_rate"), F.element_at("t", -1)["rate"].alias("last_rate"))
