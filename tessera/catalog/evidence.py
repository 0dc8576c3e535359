"""Evidence about sources, quotes and parses, written out of the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import evidence as e
from ..operators import align, rank
from ..plans import grounding
from ..queries import query, table


def pick(values, key):
    """One of some texts (null allowed) by a number's rest."""
    return F.get(F.array(*[F.lit(v) for v in values]), F.pmod(key, F.lit(len(values))).cast("int"))


@query("source_kinds", "SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN 'official_website' WHEN 1 THEN 'manager_or_administrator' WHEN 2 THEN 'third_party' WHEN 3 THEN 'none' ELSE 'manager_or_administrator' END AS kind, CASE s_suppkey % 5 WHEN 0 THEN 'official_fund' WHEN 1 THEN 'generic_manager' WHEN 2 THEN 'external_fallback' WHEN 3 THEN 'unknown' ELSE 'generic_manager' END AS authority FROM supplier")
def source_kinds(spark, d):
    url = pick(["https://www.fond.cz/a", "https://avantfunds.cz/x", "https://news.kurzy.cz/y", "", "https://jiny.cz/"], F.col("s_suppkey"))
    third = ["kurzy.cz"]
    return table(spark, d, "supplier").select("s_suppkey", e.source_kind(url, F.lit("http://fond.cz"), third).alias("kind"), e.authority(url, F.lit("http://fond.cz"), F.lit(False), third).alias("authority"))


@query("fetch_failures", "SELECT event_id, CASE WHEN event_type = 'error' THEN 'expected_miss' WHEN event_type = 'view' THEN 'warning' ELSE 'failure' END AS level FROM events")
def fetch_failures(spark, d):
    t = F.col("event_type")
    code = F.when(t == "error", "http_status_error").when(t == "view", "unsupported_content").otherwise("timeout")
    return table(spark, d, "events").select("event_id", e.fetch_failure(code, F.when(t == "error", 404), t == "error", ["unsupported_content"]).alias("level"))


@query("identity_scopes", "SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'exact_fund' WHEN 1 THEN 'ambiguous' WHEN 2 THEN 'manager' WHEN 3 THEN 'another_fund' WHEN 4 THEN 'unknown' ELSE 'share_class' END AS scope, CASE c_custkey % 6 WHEN 0 THEN 'high' WHEN 1 THEN 'low' WHEN 2 THEN 'medium' WHEN 3 THEN 'medium' WHEN 4 THEN 'low' ELSE 'medium' END AS confidence FROM customer")
def identity_scopes(spark, d):
    k = F.col("c_custkey") % 6
    texts = F.array(F.when(k == 0, "IČO 12345678").when(k == 3, "IČO 87654321").otherwise("bez čísla"))
    ico = F.lit("12345678")
    got = e.identity(F.array(F.lit("modry")), k.isin(1, 5), e.matching_ico(texts, ico), e.foreign_ico(texts, ico), k.isin(1, 2), F.lit(False), F.when(k == 5, "A"), F.lit(None).cast("string"))
    return table(spark, d, "customer").select("c_custkey", got.alias("i")).select("c_custkey", "i.*")


@query("value_scopes", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'exact_fund' WHEN 1 THEN 'another_fund' WHEN 2 THEN 'multi_fund' ELSE 'unknown' END AS scope FROM part")
def value_scopes(spark, d):
    k = F.col("p_partkey") % 4
    return table(spark, d, "part").select("p_partkey", e.value_scope(k == 0, k == 1, F.lit(False), k == 2, F.lit(None).cast("string")).alias("scope"))


@query("layout_triggers", "SELECT doc_id, concat_ws(',', CASE WHEN doc_id % 3 = 0 THEN 'parser_ladder_fallback' END, CASE WHEN b >= 0.33 THEN 'broken_reading_order' END, CASE WHEN length(text) >= 2000 THEN 'text_without_tables' END) AS triggers, CASE WHEN doc_id % 5 = 0 THEN 'document_type' WHEN doc_id % 7 = 0 THEN 'fee_rows' END AS blocked FROM (SELECT *, CASE WHEN x + y = 0 THEN 0.0 ELSE x / (x + y) END AS b FROM (SELECT *, len(regexp_extract_all(text, '[.!?]\\s+\\p{Ll}')) x, len(regexp_extract_all(text, '[.!?]\\s+[\\p{Lu}0-9]')) y FROM documents))")
def layout_triggers(spark, d):
    from ..functions.text import broken_ratio

    docs = table(spark, d, "documents").withColumn("b", broken_ratio("text"))
    got = e.layout_triggers(F.lit("pdf"), F.lit(3), F.when(F.col("doc_id") % 3 == 0, "blocks").otherwise("pymupdf"), F.col("b"), F.length("text"), F.lit(0), F.lit(0.0))
    blocked = e.blocking_reason(F.when(F.col("doc_id") % 5 == 0, " PRIIPS_KID"), F.when(F.col("doc_id") % 7 == 0, 2).otherwise(0), F.lit(0))
    return docs.select("doc_id", F.array_join(got, ",").alias("triggers"), blocked.alias("blocked"))


@query("second_readings", "SELECT p_partkey, p_size > 25 AND p_size % 2 = 0 AS accepted, CASE WHEN p_size % 2 = 1 THEN 'words_lost' ELSE '' END AS regressions FROM part")
def second_readings(spark, d):
    size = F.col("p_size")
    got = e.second_reading(F.when(size % 2 == 1, 0.9).otherwise(1.0), F.lit(1.0), F.lit(1.0), F.when(size > 25, 0.4).otherwise(0.1), F.lit(0.1), F.lit(1), F.lit(1))
    return table(spark, d, "part").select("p_partkey", got["accepted"].alias("accepted"), F.array_join(got["regressions"], ",").alias("regressions"))


@query("zero_fees", "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'zero_fee_without_evidence' WHEN 1 THEN 'zero_fee_from_a_range' WHEN 2 THEN 'zero_fee_not_supported_by_source' WHEN 3 THEN 'zero_fee_of_another_fee_type' END AS code FROM part")
def zero_fees(spark, d):
    basis = pick([None, "vstupní poplatek od 0 % do 3 %", "vstupní poplatek dle ceníku", "výstupní poplatek 0 %", "vstupní poplatek 0 %"], F.col("p_partkey"))
    return table(spark, d, "part").select("p_partkey", e.zero_fee(F.lit(0.0), basis, F.array(F.lit("vstupni"))).alias("code"))


@query("collapsed_fees", "SELECT l_orderkey, count(*) >= 2 AND count(DISTINCT l_tax) = 1 AND min(l_tax) <> 0 AS collapsed FROM lineitem GROUP BY 1")
def collapsed_fees(spark, d):
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_tax").alias("r")).select("l_orderkey", e.collapsed_fees(F.col("r")).alias("collapsed"))


@query("fee_collection_groups", "SELECT count(*) AS orders, count(DISTINCT k) AS schedules FROM (SELECT l_orderkey, list_sort(list_distinct(list(l_returnflag || l_linestatus)))::VARCHAR k FROM lineitem GROUP BY 1)")
def fee_collection_groups(spark, d):
    items = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_returnflag").alias("type"), F.col("l_linestatus").alias("kind"))).alias("i"))
    return items.select(e.fees_key(F.col("i")).alias("k")).agg(F.count("*").alias("orders"), F.countDistinct("k").alias("schedules"))


@query("written_amounts", "SELECT o_orderkey, true AS thousands, o_orderkey % 2 = 0 AS found FROM orders")
def written_amounts(spark, d):
    n = ((F.col("o_orderkey") + 1001) * 1000).cast("double")
    quote = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("celkem "), F.replace(F.format_number(F.col("o_orderkey") + 1001, 0), F.lit(","), F.lit(" ")), F.lit(" tis. Kč"))).otherwise("beze slov")
    forms = e.written_forms(n)
    return table(spark, d, "orders").select("o_orderkey", F.array_contains(forms, F.replace(F.format_number(F.col("o_orderkey") + 1001, 0), F.lit(","), F.lit(""))).alias("thousands"), F.exists(forms, lambda f: F.contains(quote, f)).alias("found"))


@query("basis_numbers", "SELECT n_nationkey, true AS comma, true AS dot, false AS other FROM nation")
def basis_numbers(spark, d):
    n = F.col("n_nationkey") + F.lit(0.25)
    written = F.regexp_replace(F.format_number(n, 2), r"\.?0+$", "")
    return table(spark, d, "nation").select("n_nationkey", e.states_number(F.concat(F.lit("sazba "), F.replace(written, F.lit("."), F.lit(",")), F.lit(" %")), n).alias("comma"), e.states_number(F.concat(F.lit("sazba "), written, F.lit(" %")), n).alias("dot"), e.states_number(F.lit("sazba dle ceníku"), n).alias("other"))


@query("isin_scopes", "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'share_class' WHEN 1 THEN 'exact_fund' END AS scope FROM customer")
def isin_scopes(spark, d):
    register = F.create_map(F.lit("CZ0008040001"), F.struct(F.lit(True).alias("own"), F.lit("share_class").alias("scope")), F.lit("CZ0008040002"), F.struct(F.lit(True).alias("own"), F.lit("exact_fund").alias("scope")), F.lit("CZ0008049999"), F.struct(F.lit(False).alias("own"), F.lit("exact_fund").alias("scope")))
    written = pick(["ISIN CZ0008040002 a CZ0008040001", "ISIN CZ0008040002", "CZ0008040001 i CZ0008049999", "bez"], F.col("c_custkey"))
    return table(spark, d, "customer").select("c_custkey", e.isin_scope(e.numbers_of(F.array(written), e.ISIN), register).alias("scope"))


def evidence_rows(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(F.col("l_partkey").alias("fund"), F.col("l_returnflag").alias("field"), F.concat(F.lit("https://a.cz/"), "l_suppkey").alias("url"), F.col("l_linenumber").alias("page"), F.concat(F.lit("Řádek "), "l_linestatus").alias("quote"), (F.col("l_tax") > 0.07).alias("warning"), F.col("l_quantity").cast("int").alias("score"), F.col("l_orderkey").alias("source_id"))


@query("grounding_packets", """WITH s AS (SELECT l_partkey fund, l_returnflag field, l_suppkey u, l_linenumber p, l_linestatus q, l_tax > 0.07 w, l_quantity::INT s, l_orderkey i FROM lineitem),
o AS (SELECT *, row_number() OVER (PARTITION BY fund, field, u, p, q ORDER BY w, s DESC, i) k FROM s), t AS (SELECT *, row_number() OVER (PARTITION BY fund, field ORDER BY w, s DESC, i, p, q) n FROM o WHERE k = 1)
SELECT fund, field, count(*) AS snippets, sum(s)::BIGINT AS points FROM t WHERE n <= 8 GROUP BY ALL""")
def grounding_packets(spark, d):
    rows = evidence_rows(spark, d)
    got = grounding.packets(rows.select("fund", "field").distinct(), rows)
    return got.select("fund", "field", F.size("snippets").cast("long").alias("snippets"), F.aggregate("snippets", F.lit(0).cast("long"), lambda a, s: a + s["score"]).alias("points"))


@query("grounded_decisions", "SELECT o_orderkey AS fund, CASE WHEN o_orderstatus = 'F' THEN 'found' WHEN o_orderkey % 2 = 0 THEN 'found' ELSE 'not_found' END AS status, CASE WHEN o_orderstatus = 'F' THEN 'old' WHEN o_orderkey % 2 = 0 THEN 'new' END AS value FROM orders")
def grounded_decisions(spark, d):
    r = table(spark, d, "orders").select(F.col("o_orderkey").alias("fund"), F.lit("fees").alias("field"), F.when(F.col("o_orderstatus") == "F", "found").otherwise("not_found").alias("status"), F.when(F.col("o_orderstatus") == "F", "old").alias("value"))
    packets = r.select("fund", "field", F.sha2(F.concat_ws("/", "fund", "field"), 256).alias("packet_id"))
    decisions = packets.select("packet_id", F.when(F.col("fund") % 2 == 0, "accept").otherwise("reject").alias("decision"), F.lit("new").alias("value"))
    return grounding.apply(r, packets, decisions).select("fund", "status", "value")


@query("weak_funds", "SELECT c_custkey FROM customer LEFT JOIN (SELECT o_custkey, count(*) n, bool_or(o_orderstatus = 'P') f FROM orders GROUP BY 1) o ON o_custkey = c_custkey WHERE n IS NULL OR f OR n <= 8")
def weak_funds(spark, d):
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.when(F.bool_or(F.col("o_orderstatus") == "P"), "failed").otherwise("completed").alias("status"), F.count("*").alias("found"))
    return grounding.weak(table(spark, d, "customer").select("c_custkey"), o, "c_custkey", 8)


@query("coverage_bands", "SELECT CASE WHEN n <= 2 THEN n::VARCHAR WHEN n <= 5 THEN '3-5' ELSE '6+' END AS band, count(*) AS funds FROM (SELECT count(o_orderkey) n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey) GROUP BY 1")
def coverage_bands(spark, d):
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    c = table(spark, d, "customer").join(o, "c_custkey", "left").select(grounding.coverage_bands(F.coalesce("n", F.lit(0))).alias("band"))
    return c.groupBy("band").agg(F.count("*").alias("funds"))


@query("passage_pages")
def passage_pages(spark, d):
    """Every turn of a conversation placed on the turns: without SQL, as places depend on those before (see tests)."""
    c = table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").cast("int").alias("n"), "text")
    placed = align.place(c.withColumnRenamed("n", "page"), c.withColumnRenamed("n", "chunk"))
    at = F.row_number().over(Window.partitionBy("doc_id").orderBy("n")) - 1
    return placed.join(c.select("doc_id", "n", at.alias("chunk")), ["doc_id", "chunk"]).select("doc_id", F.col("n").alias("chunk"), "page")


@query("page_tables", "SELECT page_id, 1::BIGINT AS tables, 'a b' AS first_cell FROM pages")
def page_tables(spark, d):
    html = F.concat(F.col("html"), F.lit("<table><tr><td><table><tr><th>a  b</th><th>c</th></tr><tr><td>1</td><td>2</td></tr></table></td></tr></table>"))
    t = e.html_tables(html)
    return table(spark, d, "pages").select("page_id", t.alias("t")).select("page_id", F.size("t").cast("long").alias("tables"), F.get(F.get(F.get("t", 0), 0), 0).alias("first_cell"))


@query("markdown_chunks", "SELECT item_id, 3::BIGINT AS chunks, 'table' AS second FROM benchmark")
def markdown_chunks(spark, d):
    md = F.concat(F.regexp_replace("text", r"\s+", " "), F.lit("\n\n| a | b |\n|---|---|\n| 1 | 2 |\nend"))
    return table(spark, d, "benchmark").select("item_id", e.markdown_chunks(md).alias("c")).select("item_id", F.size("c").cast("long").alias("chunks"), F.get("c", 1)["kind"].alias("second"))
