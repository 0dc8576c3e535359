"""Links of pages, their scores and walks over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import fuzzy, graph, rank
from ..queries import query, table

LINKS = r"""l AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<a\b[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>.*?</a>', 1)) href, unnest(range(len(regexp_extract_all(html, '(?is)<a\b[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>.*?</a>', 1)))) seq FROM pages),
j AS (SELECT page_id, seq, CASE WHEN regexp_matches(href, '(?i)^https?://') THEN href WHEN starts_with(href, '/') THEN regexp_extract(url, '^([a-zA-Z]+://[^/?#]*)', 1) || href END AS href FROM l WHERE starts_with(href, '/') OR regexp_matches(href, '(?i)^https?://'))"""


def links(spark, d):
    return graph.links(table(spark, d, "pages"), "page_id", "url", "html").where(F.col("href").isNotNull())


@query("page_links", f"WITH {LINKS} SELECT page_id, count(*) AS n, count(DISTINCT href) AS targets FROM j GROUP BY page_id")
def page_links(spark, d):
    return links(spark, d).groupBy("page_id").agg(F.count("*").alias("n"), F.countDistinct("href").alias("targets"))


@query("page_titles", r"SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g')) AS title FROM pages")
def page_titles(spark, d):
    return table(spark, d, "pages").select("page_id", graph.title(F.col("html")).alias("title"))


VISIBLE = r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script\s*>', ' ', 'g'), '(?is)<style\b.*?</style\s*>', ' ', 'g'), '(?is)<noscript\b.*?</noscript\s*>|<template\b.*?</template\s*>', ' ', 'g'), '(?is)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&'), '[\s\x{00A0}]+', ' ', 'g')) AS body
FROM pages"""


@query("visible_text", VISIBLE)
def visible_text(spark, d):
    p = table(spark, d, "pages")
    return p.select("page_id", graph.visible_text(F.col("html")).alias("body"))


@query("link_scores", f"WITH {LINKS} SELECT page_id, seq, greatest(0, least(70, 35 * (contains(lower(href), 'the')::INT + contains(lower(href), 'and')::INT)) - CASE WHEN contains(lower(href), 'login') THEN 80 ELSE 0 END)::BIGINT AS score FROM j")
def link_scores(spark, d):
    got = links(spark, d)
    score = graph.link_score(F.lower("href"), F.lit(""), ["the", "and"], ["login"])
    return got.select("page_id", F.col("seq").cast("long").alias("seq"), score.cast("long").alias("score"))


@query("best_link_per_url", f"WITH {LINKS} SELECT href, min(page_id) AS page_id, count(*) AS n FROM j GROUP BY href")
def best_link_per_url(spark, d):
    return links(spark, d).groupBy("href").agg(F.min("page_id").alias("page_id"), F.count("*").alias("n"))


EDGES = "e AS (SELECT DISTINCT l_orderkey AS a, l_partkey * 7 % 15000 AS b FROM lineitem)"


def edges(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("a"), (F.col("l_partkey") * 7 % 15000).alias("b"), F.col("l_quantity").cast("int").alias("score")).distinct()


@query("bfs_depth", f"WITH RECURSIVE {EDGES}, w(node, depth) AS (SELECT 3::BIGINT, 0 UNION SELECT e.b, w.depth + 1 FROM w JOIN e ON e.a = w.node WHERE w.depth < 4) SELECT node, min(depth) AS depth FROM w GROUP BY node")
def bfs_depth(spark, d):
    return graph.distances(edges(spark, d).select("a", "b"), spark.createDataFrame([(3,)], "node long"), 4)


@query("best_first_walk", "WITH " + EDGES.replace("SELECT DISTINCT l_orderkey AS a, l_partkey * 7 % 15000 AS b", "SELECT l_orderkey AS a, l_partkey * 7 % 15000 AS b, max(l_quantity)::INT AS s").replace("FROM lineitem)", "FROM lineitem GROUP BY 1, 2)") + ", r0 AS (SELECT 3::BIGINT node), r1 AS (SELECT b AS node, max(s) AS score FROM e JOIN r0 ON a = r0.node WHERE b NOT IN (SELECT node FROM r0) GROUP BY b ORDER BY score DESC, node LIMIT 3), r2 AS (SELECT b AS node, max(s) AS score FROM e JOIN r1 ON a = r1.node WHERE b NOT IN (SELECT node FROM r0) AND b NOT IN (SELECT node FROM r1) GROUP BY b ORDER BY score DESC, node LIMIT 3) SELECT node, 0 AS score, 0 AS round FROM r0 UNION ALL SELECT node, score, 1 FROM r1 UNION ALL SELECT node, score, 2 FROM r2")
def best_first_walk(spark, d):
    return graph.best_first(edges(spark, d), spark.createDataFrame([(3,)], "node long"), "score", 3, 2)


@query("sitemap_urls", "SELECT page_id, 1::BIGINT AS n FROM pages")
def sitemap_urls(spark, d):
    xml = F.concat(F.lit('<?xml version="1.0"?><urlset><url><loc> '), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit(" </loc></url></urlset>"))
    return table(spark, d, "pages").select("page_id", F.size(graph.sitemap_urls(xml)).cast("long").alias("n"))


@query("robots_rules", "SELECT n_nationkey, n_nationkey % 2 = 0 AS allowed, 2::BIGINT AS forbidden, 'https://a.cz/s.xml' AS sitemap FROM nation")
def robots_rules(spark, d):
    body = F.lit("User-agent: other\nDisallow: /\nUser-agent: *\nDisallow: /tajne # ne\nDisallow: /private/\nAllow: /\nSitemap: https://a.cz/s.xml")
    path = F.when(F.col("n_nationkey") % 2 == 0, "/statut").otherwise("/private/x")
    rules = graph.robots_disallowed(body)
    return table(spark, d, "nation").select("n_nationkey", graph.allowed(path, rules).alias("allowed"), F.size(rules).cast("long").alias("forbidden"), F.get(graph.robots_sitemaps(body), 0).alias("sitemap"))


@query("fuzzy_best_match", "SELECT s_name AS name, s_name || ' Fond' AS entry FROM supplier")
def fuzzy_best_match(spark, d):
    # each supplier's number alone tells it apart, so the catalogue's entry of the same number is the best
    s = table(spark, d, "supplier")
    names, entries = s.select(F.col("s_name").alias("name")), s.select(F.concat("s_name", F.lit(" Fond")).alias("entry"))
    return fuzzy.best_match(names, entries, "name", "entry", 0.72, 0.5).select("name", "entry")


@query("domain_cap", r"SELECT page_id FROM (SELECT page_id, row_number() OVER (PARTITION BY regexp_replace(lower(regexp_extract(url, '://([^/?#:]+)', 1)), '^www\.', '') ORDER BY page_id) n FROM (SELECT min(page_id) page_id, url FROM pages GROUP BY url)) WHERE n <= 3")
def domain_cap(spark, d):
    once = table(spark, d, "pages").groupBy("url").agg(F.min("page_id").alias("page_id"))
    return rank.cap(once.withColumn("domain", text.canonical_domain("url")), ["domain"], ["page_id"], 3).select("page_id")


@query("joined_urls", r"SELECT page_id, regexp_extract(url, '^([a-zA-Z]+://[^/?#]*)', 1) || '/statut.pdf' AS rooted, regexp_extract(url, '^([a-zA-Z]+:)', 1) || '//b.cz/x' AS schemed, NULL::VARCHAR AS mail FROM pages")
def joined_urls(spark, d):
    return table(spark, d, "pages").select("page_id", text.joined_url("url", F.lit("/statut.pdf")).alias("rooted"), text.joined_url("url", F.lit("//b.cz/x")).alias("schemed"), text.joined_url("url", F.lit("mailto:a@b.cz")).alias("mail"))


@query("resolved_urls", r"SELECT page_id, regexp_extract(url, '^([a-zA-Z]+://[^/?#]*)', 1) || '/b' AS url FROM pages")
def resolved_urls(spark, d):
    return table(spark, d, "pages").select("page_id", text.resolved_url("url", F.lit("/a/../b#c")).alias("url"))


def _crawl_sql(rounds: int) -> str:
    """The crawl below with each round written out."""
    group = lambda kinds: " OR ".join(f"list_contains(kinds, '{k}')" for k in kinds)
    enough = " AND ".join(f"({group(v)})" for v in graph.REQUIRED.values())
    parts = [
        "k AS (SELECT l_orderkey AS a, l_partkey * 7 % 15000 AS b, min(struct_pack(seq := l_linenumber, score := l_quantity::INT, kind := CASE l_suppkey % 7 WHEN 0 THEN 'priips_kid' WHEN 1 THEN 'statute' WHEN 2 THEN 'annual_report' ELSE 'other' END, document := l_returnflag = 'R')) AS l FROM lineitem GROUP BY 1, 2)",
        "s0 AS (SELECT o_custkey AS fund, o_orderkey % 15000 AS node, 100 AS score, 0 AS born, min(o_orderkey)::INT AS seq, NULL::INT AS round FROM orders GROUP BY 1, 2)",
        "b AS (SELECT c_custkey AS fund, 1 + c_custkey % 4 AS budget FROM customer)", "d0 AS (SELECT fund, node, NULL::VARCHAR AS kind, 0 AS round FROM s0 WHERE false)",
    ]
    for n in range(1, rounds + 1):
        parts += [
            f"h{n} AS (SELECT fund, node, score FROM (SELECT *, row_number() OVER (PARTITION BY fund ORDER BY score DESC, born, seq, node) AS r FROM s{n - 1} WHERE round IS NULL) WHERE r = 1 AND fund IN (SELECT fund FROM b WHERE budget >= {n}) AND fund NOT IN (SELECT fund FROM (SELECT fund, list(DISTINCT kind) AS kinds FROM d{n - 1} GROUP BY fund) WHERE {enough}))",
            f"x{n} AS (SELECT fund, b AS node, k.l.score AS score, k.l.seq AS seq, k.l.kind AS kind, k.l.document AS document FROM h{n} JOIN k ON k.a = h{n}.node)",
            f"d{n} AS (SELECT fund, node, arg_min(kind, round) AS kind, min(round) AS round FROM (SELECT * FROM d{n - 1} UNION ALL SELECT fund, node, kind, {n} FROM x{n} WHERE document) GROUP BY fund, node)",
            f"s{n} AS (SELECT fund, node, arg_min(score, (born, seq)) AS score, arg_min(born, (born, seq)) AS born, arg_min(seq, (born, seq)) AS seq, max(round) AS round FROM (SELECT * FROM s{n - 1} UNION ALL SELECT fund, node, score, {n}, seq, NULL FROM x{n} WHERE NOT document UNION ALL SELECT fund, node, score, 999, 0, {n} FROM h{n}) GROUP BY fund, node)",
        ]
    return "WITH " + ", ".join(parts)


def crawled(spark, d, rounds: int = 4):
    """Each customer's crawl from its orders over the links of line items, 1 to 4 pages each."""
    li = table(spark, d, "lineitem")
    of = F.col("l_suppkey") % 7
    kind = F.when(of == 0, "priips_kid").when(of == 1, "statute").when(of == 2, "annual_report").otherwise("other")
    edges = li.select(F.col("l_orderkey").alias("a"), (F.col("l_partkey") * 7 % 15000).alias("b"), F.col("l_linenumber").alias("seq"), F.col("l_quantity").cast("int").alias("score"), kind.alias("kind"), (F.col("l_returnflag") == "R").alias("document"))
    seeds = table(spark, d, "orders").select(F.col("o_custkey").alias("fund"), (F.col("o_orderkey") % 15000).alias("node"), F.lit(100).alias("score"), F.col("o_orderkey").alias("seq"))
    budgets = table(spark, d, "customer").select(F.col("c_custkey").alias("fund"), (1 + F.col("c_custkey") % 4).alias("budget"))
    return graph.crawl(edges, seeds, budgets, rounds, graph.REQUIRED)


@query("crawl_pages", _crawl_sql(4) + " SELECT fund, node, score, round FROM s4 WHERE round IS NOT NULL")
def crawl_pages(spark, d):
    return crawled(spark, d)[0]


@query("crawl_documents", _crawl_sql(4) + " SELECT fund, node, kind, round FROM d4")
def crawl_documents(spark, d):
    return crawled(spark, d)[1]


@query("sitemap_seeds", r"""WITH e AS (SELECT page_id % 20 AS fund, url AS node, regexp_extract(url, '://([^/?#:]+)', 1) AS host, length(url)::INT % 60 AS score, DATE '2024-01-01' + (page_id % 7)::INT AS modified FROM pages),
o AS (SELECT fund, node, max(score) AS score, min(modified) AS modified FROM e WHERE host LIKE '%e%' AND score >= 20 GROUP BY 1, 2)
SELECT fund, node, score, seq::INT AS seq FROM (SELECT *, row_number() OVER (PARTITION BY fund ORDER BY score DESC, modified, node) AS seq FROM o) WHERE seq <= 5""")
def sitemap_seeds(spark, d):
    p = table(spark, d, "pages")
    host = F.regexp_extract("url", r"://([^/?#:]+)", 1)
    entries = p.select((F.col("page_id") % 20).alias("fund"), F.col("url").alias("node"), host.alias("host"), F.when(F.contains(host, F.lit("e")), host).otherwise("another").alias("fund_host"), (F.length("url") % 60).alias("score"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 7).cast("int")).alias("modified"))
    return graph.sitemap_seeds(entries, 20, 5)
