"""Links of pages, and walks over them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import LINK_DOWNLOAD, LINK_LEAST, LINK_NEGATIVE, LINK_RULES
from ..functions.text import canonical_domain, canonical_url, fold, has_any, joined_url, once, url_path

LINK = r"""<a\b[^>]*?href\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>"""


def title(html: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1), r"\s+", " "))


def visible_text(html: Column) -> Column:
    """Text of a page without scripts, styles and tags."""
    bare = F.regexp_replace(html, r"(?is)<(script|style|noscript|template)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    for name, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(name), F.lit(sign))
    return F.trim(F.regexp_replace(bare, r"[\s ]+", " "))


def links(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """(key, seq, href, anchor): the links of each page in order."""
    found = F.regexp_extract_all(F.col(html), F.lit("(?is)" + LINK), 0)
    rows = pages.select(key, url, F.posexplode(found).alias("seq", "tag"))
    part = lambda k: F.regexp_extract("tag", "(?is)" + LINK, k)
    return rows.select(key, "seq", joined_url(url, part(1)).alias("href"), visible_text(part(2)).alias("anchor"))


def link_score(href: Column, anchor: Column, wanted: list[str], unrelated: list[str]) -> Column:
    """Points of a link: 35 for each wanted word to 70, years after 2015 2 each to 20, 30 for a PDF, 80 less for unrelated words, not below 0."""
    words = fold(F.concat_ws(" ", anchor, F.regexp_replace(href, r"[-_/.+]", " ")))
    hits = sum((F.when(F.contains(words, F.lit(w)), 1).otherwise(0) for w in wanted), F.lit(0))
    year = F.coalesce(F.array_max(F.transform(F.regexp_extract_all(words, F.lit(r"(?<!\d)(20\d{2})(?!\d)"), 1), lambda y: y.cast("int"))), F.lit(2015))
    fresh = F.greatest(F.lit(0), F.least(F.lit(20), (year - 2015) * 2))
    pdf = F.when(F.lower(href).rlike(r"\.pdf(\?|$)"), 30).otherwise(0)
    return F.greatest(F.lit(0), F.least(F.lit(70), hits * 35) + fresh + pdf - F.when(has_any(words, unrelated), 80).otherwise(0))


def classified_link(href: Column, anchor: Column, page: Column, download: Column | None = None) -> Column:
    """struct(kind, score, same_domain, direct) of a link, null below LINK_LEAST points.

    The rule with the most points names the kind, the first of equal ones. Direct documents, words of a
    download, the page's own domain add points; words of pages without documents take 70.
    """
    words = F.trim(F.concat(fold(anchor), F.lit(" "), fold(href)))
    rules = []
    for k, (kind, points, keywords) in enumerate(LINK_RULES):
        hits = sum((F.when(F.contains(words, F.lit(w)), 1).otherwise(0) for w in keywords), F.lit(0))
        score = F.when(hits > 0, points + F.least(hits - 1, F.lit(3)) * 5).otherwise(0)
        rules.append(F.struct(score.alias("score"), F.lit(-k).alias("order"), F.lit(kind).alias("kind")))
    direct = F.lower(url_path(href)).rlike(r"[^/]\.(pdf|xhtml|xml|txt)$")
    same = canonical_domain(href) == canonical_domain(page)
    more = F.when(direct, 30).otherwise(0) + F.when(has_any(fold(anchor), LINK_DOWNLOAD), 10).otherwise(0) + F.when(same, 5).otherwise(0)
    if download is not None:
        more = more + F.when(download, 10).otherwise(0)
    less = F.when(has_any(words, LINK_NEGATIVE), 70).otherwise(0)

    def scored(best: Column) -> Column:
        score = F.greatest(F.lit(0), best["score"] + more - less)
        kind = F.when(best["score"] > 0, best["kind"]).otherwise("other")
        return F.when(score >= LINK_LEAST, F.struct(kind.alias("kind"), score.alias("score"), same.alias("same_domain"), direct.alias("direct")))

    return once(F.array_max(F.array(*rules)), scored)


def distances(edges: DataFrame, roots: DataFrame, most: int) -> DataFrame:
    """(node, depth) of the nodes that at most `most` steps along edges(a, b) reach from roots(node).

    One join a step against what is new; a node is met again only by the anti join. Steps are bounded
    by `most`, so the plan is; each step's frontier is cut off by a checkpoint.
    """
    edges = edges.select("a", "b").checkpoint()  # steps read them again and again
    seen = roots.select("node").distinct().withColumn("depth", F.lit(0))
    frontier = seen
    for depth in range(1, most + 1):
        new = edges.join(frontier, edges["a"] == frontier["node"]).select(F.col("b").alias("node")).distinct()
        frontier = new.join(seen, "node", "left_anti").withColumn("depth", F.lit(depth)).checkpoint()
        if frontier.isEmpty():
            break
        seen = seen.union(frontier)
    return seen


def best_first(edges: DataFrame, roots: DataFrame, score: str, budget: int, rounds: int) -> DataFrame:
    """(node, score, round): a crawl over stored links that each round takes the `budget` best links not yet taken.

    Of links to one node the best counts. The frontier of a round is a top-k, so no task sorts all links.
    """
    taken = roots.select("node", F.lit(0).alias("score"), F.lit(0).alias("round"))
    last = taken
    for n in range(1, rounds + 1):
        near = edges.join(last, edges["a"] == last["node"]).groupBy("b").agg(F.max(edges[score]).alias("score"))
        new = near.withColumnRenamed("b", "node").join(taken, "node", "left_anti").orderBy(F.desc("score"), "node").limit(budget)
        last = new.withColumn("round", F.lit(n)).select("node", "score", "round").checkpoint()
        if last.isEmpty():
            break
        taken = taken.union(last)
    return taken


#: What a pass needs before it may stop, by groups any member of which will do.
REQUIRED = {
    "key_information": ["priips_kid"],
    "governing_document": ["statute", "subfund_statute", "memorandum"],
    "reporting_document": ["annual_report", "financial_statements", "half_year_report", "factsheet"],
}


def permitted(links: DataFrame, robots: DataFrame, host: str, path: str) -> DataFrame:
    """links without those that the robots rules (host, disallowed) of their own host forbid; hosts without rules forbid nothing."""
    rules = robots.select(F.col("host").alias("__host"), F.col("disallowed").alias("__no"))
    own = links.join(rules, links[host] == F.col("__host"), "left")
    return own.where(F.col("__no").isNull() | allowed(F.col(path), F.col("__no"))).drop("__host", "__no")


def sitemap_seeds(entries: DataFrame, least: int, most: int = 40) -> DataFrame:
    """(fund, node, score, seq): the best `most` sitemap addresses of each fund, of its own host and of at least `least` points.

    entries: fund, node, host, fund_host, score, modified. Highest points first, then the oldest, then by address;
    an address counts once, as the first of its listings. The cap is the feature's.
    """
    own = entries.where((F.col("host") == F.col("fund_host")) & (F.col("score") >= least))
    order = [F.desc("score"), F.coalesce("modified", F.lit("0001-01-01").cast("date")), "node"]
    once = own.groupBy("fund", "node").agg(F.max("score").alias("score"), F.min("modified").alias("modified"))
    ranked = once.withColumn("seq", F.row_number().over(Window.partitionBy("fund").orderBy(*order)))
    return ranked.where(F.col("seq") <= most).select("fund", "node", "score", "seq")


def crawl(links: DataFrame, seeds: DataFrame, budgets: DataFrame, rounds: int, required: dict[str, list[str]] | None = None) -> tuple[DataFrame, DataFrame]:
    """(pages (fund, node, score, round), documents (fund, node, kind, round)): a best-first crawl of each fund over stored links.

    links: a, b, seq, score, kind, document. seeds: fund, node, score, seq. budgets: fund, budget, the pages
    that a fund may fetch. Each round every fund takes the best page of its own frontier (most points, then
    found earliest, then in the order of its page's links, then by name); links of it that the fund has not met
    before enter its frontier with the points of their first sight, documents are noted and not fetched. A fund
    stops when its budget is spent, its frontier empty, or, with `required`, when its documents have a kind of
    each group. Rounds are bounded by `rounds`, the largest budget that counts.

    What a fund has met is a table of narrow rows, written each round; a round joins links only with the
    pages just taken, one a fund, and settles what is new by one aggregation, so no seen set is gathered and no
    frontier is sorted.
    """
    links = links.where("b is not null").groupBy("a", "b").agg(F.min(F.struct("seq", "score", "kind", "document")).alias("l")).select("a", "b", "l.*")
    links = links.repartition("a").checkpoint()  # dealt by page once; rounds bring their few pages to it
    first = F.struct(F.lit(0).alias("born"), F.col("seq").cast("int").alias("seq"))
    seen = seeds.groupBy("fund", "node").agg(F.min_by(F.struct("score", "seq"), "seq").alias("s")).select("fund", "node", "s.*")
    seen = seen.select("fund", "node", F.col("score").cast("int").alias("score"), first.alias("at"), F.lit(None).cast("int").alias("round")).checkpoint()
    documents = None
    for n in range(1, rounds + 1):
        open_ = seen.where("round is null")
        heads = open_.groupBy("fund").agg(F.min_by(F.struct("node", "score"), F.struct((-F.col("score")).alias("s"), "at.born", "at.seq", "node")).alias("h"))
        heads = heads.join(budgets.where(F.col("budget") >= n), "fund", "left_semi").select("fund", "h.node", "h.score")
        if required is not None and documents is not None:
            kinds = documents.groupBy("fund").agg(F.collect_set("kind").alias("kinds"))  # kinds are few
            enough = reduce(lambda x, y: x & y, (F.arrays_overlap("kinds", F.array(*map(F.lit, group))) for group in required.values()))
            heads = heads.join(kinds.where(enough), "fund", "left_anti")
        heads = heads.checkpoint()
        if heads.isEmpty():
            break
        near = links.join(heads.select("fund", F.col("node").alias("a")), "a")
        found = near.where("document").select("fund", F.col("b").alias("node"), "kind", F.lit(n).alias("round"))
        documents = found if documents is None else documents.union(found)
        documents = documents.groupBy("fund", "node").agg(F.min_by(F.struct("kind", "round"), "round").alias("d")).select("fund", "node", "d.*").checkpoint()
        new = near.where("not document").select("fund", F.col("b").alias("node"), F.col("score").cast("int").alias("score"), F.struct(F.lit(n).alias("born"), F.col("seq").cast("int").alias("seq")).alias("at"), F.lit(None).cast("int").alias("round"))
        taken = heads.select("fund", "node", F.col("score").cast("int").alias("score"), F.lit(None).cast("struct<born:int,seq:int>").alias("at"), F.lit(n).alias("round"))
        every = seen.union(new).union(taken)
        met = every.groupBy("fund", "node").agg(F.min_by(F.struct("score", "at"), "at").alias("f"), F.max("round").alias("round"))
        seen = met.select("fund", "node", "f.score", "f.at", "round").checkpoint()
    none = seeds.select("fund", "node", F.lit(None).cast("string").alias("kind"), F.lit(None).cast("int").alias("round")).limit(0)
    return seen.where("round is not null").select("fund", "node", "score", "round"), documents if documents is not None else none


def sitemap_urls(xml: Column) -> Column:
    """Addresses of a sitemap or an index of them."""
    return F.transform(F.regexp_extract_all(xml, F.lit(r"(?is)<loc>\s*(.*?)\s*</loc>"), 1), canonical_url)


def robots_sitemaps(body: Column) -> Column:
    return F.regexp_extract_all(body, F.lit(r"(?im)^\s*sitemap:\s*(\S+)"), 1)


def robots_disallowed(body: Column, agent: str = "*") -> Column:
    """Paths that the groups of an agent (else of all) forbid: lines carried by the last user-agent line."""
    lines = F.transform(F.split(body, r"\r?\n"), lambda x: F.trim(F.regexp_replace(x, "#.*$", "")))
    empty = F.array().cast("array<string>")

    def step(a: Column, x: Column) -> Column:
        key, value = F.lower(F.trim(F.regexp_extract(x, "^([^:]+):", 1))), F.trim(F.regexp_extract(x, "^[^:]+:(.*)$", 1))
        starts = key == "user-agent"
        applies = F.when(starts, (a["agents"] & a["on"]) | (F.lower(value) == agent.lower())).otherwise(a["on"])
        forbid = (key == "disallow") & a["on"] & (value != "")
        return F.struct(applies.alias("on"), starts.alias("agents"), F.when(forbid, F.concat(a["out"], F.array(value))).otherwise(a["out"]).alias("out"))

    return F.aggregate(lines, F.struct(F.lit(False).alias("on"), F.lit(False).alias("agents"), empty.alias("out")), step, lambda a: a["out"])


def allowed(path: Column, disallowed: Column) -> Column:
    return ~F.exists(disallowed, lambda d: F.startswith(path, d))
