"""Lines of documents and ordered scans over events."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import lines
from ..queries import query, table

LINES = "l AS (SELECT doc_id, trim(u.x) AS line, u.i FROM documents, unnest(string_split(text, chr(10))) WITH ORDINALITY u(x, i) WHERE trim(u.x) <> ''), n AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS line_no FROM l)"


@query("line_offsets", f"WITH {LINES} SELECT doc_id, line_no, length(line)::BIGINT AS size, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM n")
def line_offsets(spark, d):
    return lines.lines(table(spark, d, "documents"), "doc_id", "text").select("doc_id", F.col("line_no").cast("long").alias("line_no"), F.length("line").cast("long").alias("size"), "start")


@query("context_window3", f"WITH {LINES} SELECT doc_id, line_no, concat_ws(' ', lag(line) OVER w, line, lead(line) OVER w) AS context FROM n WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)")
def context_window3(spark, d):
    rows = lines.lines(table(spark, d, "documents"), "doc_id", "text", around=(1, 1))
    return rows.select("doc_id", F.col("line_no").cast("long").alias("line_no"), "context")


@query("heading_carry12", f"WITH {LINES} SELECT doc_id, line_no, last_value(CASE WHEN length(line) < 60 THEN line END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS heading FROM n")
def heading_carry12(spark, d):
    rows = lines.lines(table(spark, d, "documents"), "doc_id", "text", heading=lambda x: F.when(F.length(x) < 60, x))
    return rows.select("doc_id", F.col("line_no").cast("long").alias("line_no"), "heading")


@query("asof_in_group", "SELECT c.event_id, (SELECT arg_max(p.value, (p.ts, p.event_id)) FROM events p WHERE p.user_id = c.user_id AND p.event_type = 'view' AND p.ts <= c.ts) AS value FROM events c WHERE c.event_type = 'purchase'")
def asof_in_group(spark, d):
    e = table(spark, d, "events")
    left = e.where("event_type = 'purchase'").select("user_id", "ts", "event_id")
    return lines.as_of(left, e.where("event_type = 'view'").select("user_id", "ts", "value"), ["user_id"], "ts", "value").select("event_id", "value")


@query("filled_gaps", "SELECT event_id, CASE WHEN v IS NOT NULL THEN v WHEN a = b THEN a END AS kind FROM (SELECT event_id, v, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) a, first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) b FROM (SELECT *, CASE WHEN event_type IN ('view', 'click') THEN event_type END v FROM events))")
def filled_gaps(spark, d):
    e = table(spark, d, "events").withColumn("kind", F.when(F.col("event_type").isin("view", "click"), F.col("event_type")))
    return lines.filled_gaps(e, "user_id", "event_id", "kind").select("event_id", "kind")


@query("section_spans", "SELECT event_id, s AS start, coalesce(CASE WHEN f THEN min(s) OVER w ELSE min(CASE WHEN f THEN s END) OVER w END, 100000000) AS \"end\" FROM (SELECT event_id, user_id, event_id AS s, event_type = 'error' AS f FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY s ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)")
def section_spans(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", F.col("event_id").alias("start"), (F.col("event_type") == "error").alias("foreign"))
    return lines.sections(e, "user_id", "start", "foreign", F.lit(100000000)).select("event_id", "start", "end")


@query("interval_union", "SELECT p, sum(greatest(0, b - greatest(a, coalesce(m, a))))::BIGINT AS covered FROM (SELECT p, a, b, max(b) OVER (PARTITION BY p ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) m FROM (SELECT l_suppkey p, l_orderkey a, l_orderkey + l_quantity::BIGINT b FROM lineitem)) GROUP BY p")
def interval_union(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("p"), F.col("l_orderkey").alias("a"), (F.col("l_orderkey") + F.col("l_quantity").cast("long")).alias("b"))
    return lines.covered_length(li, ["p"], "a", "b")


@query("section_index", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (CASE WHEN l_quantity >= 10 THEN 1 ELSE 0 END + CASE WHEN l_quantity >= 25 THEN 1 ELSE 0 END + CASE WHEN l_quantity >= 40 THEN 1 ELSE 0 END - 1)::BIGINT AS section FROM lineitem")
def section_index(spark, d):
    b = F.array(F.lit(10.0), F.lit(25.0), F.lit(40.0))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", lines.section_of(b, F.col("l_quantity")).cast("long").alias("section"))


@query("sessions", "SELECT user_id, session::BIGINT AS session, count(*) AS n, min(ts) AS begun FROM (SELECT user_id, ts, sum(CASE WHEN gap IS NULL OR gap > 3600 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM (SELECT user_id, event_id, ts, epoch(ts) - epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS gap FROM events)) GROUP BY user_id, session")
def sessions(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    gap = at - F.lag(at).over(w)
    e = table(spark, d, "events").withColumn("gap", gap)
    e = e.withColumn("session", F.sum(F.when(F.col("gap").isNull() | (F.col("gap") > 3600 * 1000000), 1).otherwise(0)).over(w))
    return e.groupBy("user_id", "session").agg(F.count("*").alias("n"), F.min("ts").alias("begun"))


@query("turn_context", "SELECT conv_id, turn, length(concat_ws(' ', lag(text, 2) OVER w, lag(text) OVER w, text, lead(text) OVER w))::BIGINT AS size FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def turn_context(spark, d):
    c = lines.context(table(spark, d, "conversations"), "conv_id", "turn", "text", 2, 1)
    return c.select("conv_id", "turn", F.length("context").cast("long").alias("size"))
