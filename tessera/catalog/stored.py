"""Sinks, the store and its scans: tables are written in the shared folder and what is read back is compared."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..cluster import shared_folder
from ..queries import query, table
from ..sources import files, scans
from ..sources.store import Store


def new_folder(spark) -> str:
    return f"{shared_folder(spark)}/tessera-stored/{uuid.uuid4().hex}"


def stored(spark, d):
    """(sources, funds, parsed): orders as sources of customers, the finished ones parsed."""
    path = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("/cache/"), "o_orderkey"))
    kind = F.when(F.col("o_orderkey") % 2 == 0, "application/pdf").otherwise("text/html")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("source_id"), F.col("o_custkey").alias("fund_id"), F.concat(F.lit("https://a.cz/"), "o_orderkey").alias("url"), kind.alias("content_type"), path.alias("local_path"), "o_orderstatus")
    funds = table(spark, d, "customer").select(F.col("c_custkey").alias("fund_id"), F.col("c_name").alias("name"), F.concat(F.lit("https://f"), "c_custkey", F.lit(".cz")).alias("web"))
    parsed = o.where("o_orderstatus = 'F'").select("source_id", (F.col("source_id") * 10).alias("character_count"))
    return o.drop("o_orderstatus"), funds, parsed


@query("cached_sources", "SELECT o_orderkey AS source_id, c_name AS name, CASE WHEN o_orderstatus = 'F' THEN o_orderkey * 10 END AS character_count FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus <> 'P' AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 40)")
def cached_sources(spark, d):
    ids = table(spark, d, "lineitem").where("l_quantity > 40").select(F.col("l_orderkey").alias("source_id"))
    return scans.cached_sources(*stored(spark, d), ids).select("source_id", "name", "character_count")


@query("rows_to_process", "SELECT o_orderkey AS source_id, c_name AS name FROM (SELECT * FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 2 = 0 ORDER BY o_orderkey LIMIT 100) JOIN customer ON c_custkey = o_custkey")
def rows_to_process(spark, d):
    sources, funds, _ = stored(spark, d)
    return scans.rows_to_process(sources, funds, None, 100).select("source_id", "name")


@query("batch_manifest", "WITH r AS (SELECT l_orderkey, arg_max(l_suppkey, l_linenumber * 1000000 + l_suppkey) AS s FROM lineitem GROUP BY 1) SELECT c_custkey AS fund_id, count(o_orderkey) AS sources, coalesce(sum(s), 0)::BIGINT AS referrers, coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN o_orderkey * 10 END), 0)::BIGINT AS characters FROM customer LEFT JOIN orders ON o_custkey = c_custkey LEFT JOIN r ON l_orderkey = o_orderkey GROUP BY 1")
def batch_manifest(spark, d):
    sources, funds, parsed = stored(spark, d)
    li = table(spark, d, "lineitem").join(sources.select(F.col("source_id").alias("l_orderkey"), "fund_id", "url"), "l_orderkey")
    log = li.select("fund_id", "url", (F.col("l_linenumber") * 1000000 + F.col("l_suppkey")).alias("seq"), F.col("l_suppkey").alias("discovered_from"))
    listed = F.coalesce("sources", F.array().cast("array<struct<url:string,referrer:bigint,character_count:bigint>>"))
    add = lambda c: F.aggregate(listed, F.lit(0).cast("long"), lambda a, s: a + F.coalesce(s[c], F.lit(0)))
    got = scans.manifest(sources, parsed, log, funds)
    return got.select("fund_id", F.size(listed).cast("long").alias("sources"), add("referrer").alias("referrers"), add("character_count").alias("characters"))


@query("processed_and_rest", "SELECT 'done' AS part, count(*) AS n FROM customer WHERE c_acctbal > 0 UNION ALL SELECT 'rest', count(*) FROM customer WHERE c_acctbal <= 0 UNION ALL SELECT CASE WHEN c_acctbal > 0 THEN 'completed' ELSE 'failed' END, count(*) FROM customer GROUP BY 1")
def processed_and_rest(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("fund_id"), F.when(F.col("c_acctbal") > 0, "completed").otherwise("failed").alias("status"))
    done, rest, counts = scans.processed_and_rest(c.select("fund_id"), c, "status", ["completed"])
    n = lambda df, part: df.agg(F.count("*").alias("n")).select(F.lit(part).alias("part"), "n")
    return n(done, "done").union(n(rest, "rest")).union(counts.select("status", "n"))


@query("search_results", "SELECT s_suppkey AS query, unnest([0, 1, 2]) AS rank, unnest(['https://www.a' || s_suppkey || '.cz/x', 'https://b.cz/y', 'https://b.cz/z']) AS url, unnest(['a' || s_suppkey || '.cz', 'b.cz', 'b.cz']) AS domain FROM supplier WHERE s_suppkey % 3 > 0")
def search_results(spark, d):
    link = lambda u: F.struct(u.alias("link"), F.lit("t").alias("title"))
    own = F.concat(F.lit("https://www.a"), "s_suppkey", F.lit(".cz/x"))
    urls = [own, F.lit("https://x.google.com/q"), F.lit("https://b.cz/y"), own, F.lit(None).cast("string"), F.lit("https://b.cz/z"), F.lit("https://www.b.cz/third"), F.lit("none")]
    body = F.when(F.col("s_suppkey") % 3 > 0, F.to_json(F.struct(F.array(*map(link, urls)).alias("items")))).otherwise("<html>no json</html>")
    s = table(spark, d, "supplier").select("s_suppkey", body.alias("body"))
    return scans.search_results(s, "body", "s_suppkey", ["google.com"], 2).select("query", "rank", "url", "domain")


@query("saved_bodies", "SELECT page_id, strlen(html)::BIGINT AS size, sha256(html) AS sha256 FROM pages")
def saved_bodies(spark, d):
    folder = new_folder(spark)
    scans.save_bodies(table(spark, d, "pages").select("page_id", "url", F.col("html").cast("binary").alias("content")), folder)
    return scans.saved_bodies(spark, folder).select("page_id", F.octet_length("content").cast("long").alias("size"), "sha256")


@query("written_records", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def written_records(spark, d):
    folder = new_folder(spark)
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("double").alias("o_totalprice"))
    files.write_records(o, folder)
    return spark.read.schema(o.schema).json(folder)


@query("written_csv", "SELECT doc_id, coalesce(text, '') AS text FROM documents")
def written_csv(spark, d):
    folder = new_folder(spark)
    files.write_csv(table(spark, d, "documents").select("doc_id", "text"), folder)
    return files.read_csv(spark, folder, "doc_id long, text string").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


# --- the store: each table takes older rows, then all of them; the newest of a key stays


def kept(spark, name: str, rows):
    """The store's table `name` after two upserts of rows, the first of every other one."""
    store = Store(spark, new_folder(spark))
    store.initialise()
    rows = rows.withColumn("updated_at", F.timestamp_seconds("k"))
    store.upsert(name, rows.where("k % 2 = 0").drop("k"))
    store.upsert(name, rows.drop("k"))
    return store.table(name)


def numbered(spark, d):
    o = table(spark, d, "orders")
    fund = F.concat(F.lit("f"), "o_custkey").alias("fund_id")
    return o.select(F.col("o_orderkey").alias("k"), fund, "o_orderstatus", F.col("o_orderdate").cast("date").alias("day"), F.col("o_totalprice").cast("double").alias("price"), "o_orderpriority")


@query("store_parties", "SELECT 'f' || o_custkey AS fund_id, CASE o_orderstatus WHEN 'F' THEN 'manager' ELSE 'administrator' END AS role, 'Name ' || max(o_orderkey) AS name FROM orders GROUP BY 1, 2")
def store_parties(spark, d):
    role = F.when(F.col("o_orderstatus") == "F", "manager").otherwise("administrator")
    rows = numbered(spark, d).select("k", "fund_id", role.alias("role"), F.concat(F.lit("Name "), "k").alias("name"))
    return kept(spark, "fund_parties", rows).select("fund_id", "role", "name")


@query("store_capital", "SELECT 'f' || o_custkey AS fund_id, o_orderstatus AS metric_type, o_orderdate::DATE AS as_of, CASE WHEN o_orderkey % 3 = 0 THEN 'A' ELSE '' END AS share_class, arg_max(o_totalprice, o_orderkey)::DOUBLE AS amount FROM orders GROUP BY ALL")
def store_capital(spark, d):
    share = F.when(F.col("k") % 3 == 0, "A").when(F.col("k") % 3 == 1, "")
    rows = numbered(spark, d).select("k", "fund_id", F.col("o_orderstatus").alias("metric_type"), F.col("day").alias("as_of"), share.alias("share_class"), F.lit("CZK").alias("currency"), F.col("price").alias("amount"))
    return kept(spark, "capital_observations", rows).select("fund_id", "metric_type", "as_of", F.coalesce("share_class", F.lit("")).alias("share_class"), "amount")


@query("store_returns", "SELECT 'f' || o_custkey AS fund_id, year(o_orderdate)::INT AS year, 'calendar_year' AS series_type, arg_max(o_totalprice, o_orderkey)::DOUBLE AS return_percent FROM orders GROUP BY ALL")
def store_returns(spark, d):
    rows = numbered(spark, d).select("k", "fund_id", F.year("day").alias("year"), F.lit("calendar_year").alias("series_type"), F.col("price").alias("return_percent"))
    return kept(spark, "annual_returns", rows).select("fund_id", "year", "series_type", "return_percent")


@query("store_values", "SELECT 'f' || o_custkey AS fund_id, o_orderdate::DATE AS as_of, o_orderpriority AS value_type, arg_max(o_totalprice, o_orderkey)::DOUBLE AS value FROM orders GROUP BY ALL")
def store_values(spark, d):
    rows = numbered(spark, d).select("k", "fund_id", F.col("day").alias("as_of"), F.col("o_orderpriority").alias("value_type"), F.col("price").alias("value"))
    return kept(spark, "historical_values", rows).select("fund_id", "as_of", "value_type", "value")


@query("store_news", "SELECT 'f' || o_custkey AS fund_id, 'https://a.cz/' || o_orderkey % 4 AS url, 'Title ' || max(o_orderkey) AS title, arg_max(o_orderdate::DATE, o_orderkey) AS published_at FROM orders GROUP BY ALL")
def store_news(spark, d):
    rows = numbered(spark, d).select("k", "fund_id", F.concat(F.lit("https://a.cz/"), F.col("k") % 4).alias("url"), F.concat(F.lit("Title "), "k").alias("title"), F.col("day").alias("published_at"))
    return kept(spark, "fund_news", rows).select("fund_id", "url", "title", "published_at")


@query("store_discovery", "SELECT 'f' || o_custkey AS fund_id, o_orderstatus AS run_id, 'https://a.cz/' || o_orderkey % 3 AS url, (max(o_orderkey) % 100)::INT AS score, max(o_orderkey) % 2 = 0 AS accepted FROM orders GROUP BY ALL")
def store_discovery(spark, d):
    rows = numbered(spark, d).select("k", "fund_id", F.col("o_orderstatus").alias("run_id"), F.concat(F.lit("https://a.cz/"), F.col("k") % 3).alias("url"), (F.col("k") % 100).cast("int").alias("score"), (F.col("k") % 2 == 0).alias("accepted"))
    return kept(spark, "discovery_log", rows).select("fund_id", "run_id", "url", "score", "accepted")


@query("store_metadata", "SELECT o_orderkey AS source_id, 'f' || o_custkey AS fund_id, o_orderpriority AS document_type, o_orderdate::DATE AS published_at FROM orders")
def store_metadata(spark, d):
    rows = numbered(spark, d).select("k", F.col("k").alias("source_id"), "fund_id", F.col("o_orderpriority").alias("document_type"), F.col("day").alias("published_at"))
    return kept(spark, "document_metadata", rows).select("source_id", "fund_id", "document_type", "published_at")


@query("store_attempts", "SELECT (o_orderkey % 500)::BIGINT AS attempt_id, arg_max(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY 1")
def store_attempts(spark, d):
    rows = numbered(spark, d).select("k", (F.col("k") % 500).alias("attempt_id"), "fund_id", F.lit("fetch").alias("stage"), F.col("o_orderstatus").alias("status"))
    return kept(spark, "attempts", rows).select("attempt_id", "status")


def whole_store(spark, d) -> Store:
    """Customers as funds, orders as their sources, the finished ones parsed."""
    store = Store(spark, new_folder(spark))
    store.initialise()
    c = table(spark, d, "customer")
    store.register_funds(c.select(F.concat(F.lit("f"), "c_custkey").alias("fund_id"), F.col("c_name").alias("name"), F.timestamp_seconds("c_custkey").alias("updated_at")))
    o = numbered(spark, d).withColumn("updated_at", F.timestamp_seconds("k"))
    url = F.concat(F.lit("https://a.cz/"), "k")
    state = F.when(F.col("o_orderstatus") == "P", "discovered").otherwise("downloaded")
    store.upsert("sources", o.select(F.col("k").alias("source_id"), "fund_id", url.alias("url"), url.alias("canonical_url"), state.alias("status"), F.concat(F.lit("/c/"), "k").alias("local_path"), (F.col("k") % 50).cast("string").alias("sha256"), "updated_at"))
    store.record_parsed(o.where("o_orderstatus = 'F'").select(F.col("k").alias("source_id"), "fund_id", F.col("price").cast("int").alias("character_count"), "updated_at"))
    return store


@query("store_counts", "SELECT 'funds' AS \"table\", 'pending' AS status, count(*) AS n FROM customer UNION ALL SELECT 'parsed_documents', NULL, count(*) FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'sources', CASE o_orderstatus WHEN 'F' THEN 'parsed' WHEN 'P' THEN 'discovered' ELSE 'downloaded' END, count(*) FROM orders GROUP BY 2")
def store_counts(spark, d):
    return whole_store(spark, d).counts().where("n > 0")


@query("store_candidates", "SELECT min(o_orderkey) AS source_id FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderkey % 50")
def store_candidates(spark, d):
    return whole_store(spark, d).candidates().select("source_id")


@query("store_unstructured", "SELECT o_orderkey AS source_id FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 4 > 0")
def store_unstructured(spark, d):
    structured = table(spark, d, "orders").where("o_orderkey % 4 = 0").select(F.col("o_orderkey").alias("source_id"))
    return whole_store(spark, d).unstructured(structured).select("source_id")
