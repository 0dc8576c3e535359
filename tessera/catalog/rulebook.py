"""Classifiers, link rules, audits and totals over the given tables; the SQL is made from the same fixed values, by other means."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import classify, labels, values
from ..operators import deltas, fuzzy, graph
from ..plans import audit, rules
from ..queries import query, table


def sql_list(words: list[str]) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def picked(words: list[str], key: str) -> Column:
    return F.get(F.array(*map(F.lit, words)), F.pmod(F.col(key), F.lit(len(words))).cast("int"))


def contains_any(x: str, words: list[str]) -> str:
    return f"len(list_filter({sql_list(words)}, lambda word_: contains({x}, word_))) > 0"


#: A header for each keyword, pair and exclusion, and some that decide nothing or between two types.
HEADERS = [""]
for _strong, _weak, _pairs, _out in labels.DOCUMENT_TYPES.values():
    HEADERS += _strong + _weak + [f"{a} a {b}" for a, b in _pairs]
HEADERS += ["statut podfondu a statut fondu", "pololetni zprava a vyrocni zprava", "cenik a prospekt", "statut a newsletter", "memorandum", "vyrocni zprava a ucetni zaverka"]

_RULES = []
for _k, (_kind, (_strong, _weak, _pairs, _out)) in enumerate(labels.DOCUMENT_TYPES.items()):
    _RULES += [(_kind, _k, w, w, 6) for w in _strong] + [(_kind, _k, w, w, 2) for w in _weak] + [(_kind, _k, a, b, 2) for a, b in _pairs]
_EXCLUDED = [(kind, w) for kind, (_, _, _, out) in labels.DOCUMENT_TYPES.items() for w in out]

DOCUMENT_TYPES_SQL = f"""WITH s AS (SELECT doc_id, 5 AS weight, {sql_list(HEADERS)}[doc_id % {len(HEADERS)} + 1] AS x FROM documents UNION ALL SELECT doc_id, 1, lower(text) FROM documents),
r(kind, pos, word, also, points) AS (VALUES {', '.join(map(str, _RULES))}), e(kind, word) AS (VALUES {', '.join(map(str, _EXCLUDED))}),
p AS (SELECT doc_id, r.kind, pos, sum(weight * points) AS score FROM s JOIN r ON contains(x, r.word) AND contains(x, also) WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.kind = r.kind AND contains(x, e.word)) GROUP BY ALL),
o AS (SELECT *, row_number() OVER w AS n, lead(kind) OVER w AS other, lead(score) OVER w AS second FROM p WINDOW w AS (PARTITION BY doc_id ORDER BY score DESC, pos))
SELECT d.doc_id, CASE WHEN score >= 6 THEN kind ELSE 'other' END AS kind, coalesce(score, 0)::BIGINT AS score,
  coalesce(score >= 6 AND second IS NOT NULL AND score - second < 4 AND (kind, other) NOT IN (VALUES {', '.join(map(str, labels.REFINEMENTS))}), false) AS ambiguous
FROM documents d LEFT JOIN o ON o.doc_id = d.doc_id AND n = 1"""


@query("document_types", DOCUMENT_TYPES_SQL)
def document_types(spark, d):
    v = classify.vote({"header_text": picked(HEADERS, "doc_id"), "body_text": F.lower("text")})
    return table(spark, d, "documents").select("doc_id", v.alias("v")).select("doc_id", F.coalesce("v.kind", F.lit("other")).alias("kind"), F.col("v.score").cast("long").alias("score"), "v.ambiguous")


WORDINGS = labels.NOT_PUBLISHED + labels.PERIOD_END + labels.BENCHMARK + ["cilovy vynos 8 % p.a.", "k 31.12.2024", ""]


@query("return_wording", f"SELECT o_orderkey, {contains_any('x', labels.NOT_PUBLISHED)} AS unpublished, {contains_any('x', labels.PERIOD_END)} AS period_end, {contains_any('x', labels.BENCHMARK)} AS linked FROM (SELECT o_orderkey, {sql_list(WORDINGS)}[o_orderkey % {len(WORDINGS)} + 1] AS x FROM orders)")
def return_wording(spark, d):
    x = picked(WORDINGS, "o_orderkey")
    flags = [classify.no_published_return(x).alias("unpublished"), classify.has_any(x, labels.PERIOD_END).alias("period_end"), classify.has_any(x, labels.BENCHMARK).alias("linked")]
    return table(spark, d, "orders").select("o_orderkey", *flags)


@query("period_end_dates", f"SELECT o_orderkey, CASE WHEN {contains_any('x', labels.PERIOD_END)} AND o_orderkey % 3 > 0 THEN make_date(CASE WHEN o_orderkey % 3 = 1 THEN 2001 + o_orderkey % 20 ELSE 2003 END, CASE WHEN o_orderkey % 3 = 1 THEN 6 ELSE 12 END, CASE WHEN o_orderkey % 3 = 1 THEN 30 ELSE 31 END) END AS day FROM (SELECT o_orderkey, {sql_list(WORDINGS)}[o_orderkey % {len(WORDINGS)} + 1] AS x FROM orders)")
def period_end_dates(spark, d):
    span = F.concat(F.lit("za obdobi od 1.7.2000 do 30.6."), (2001 + F.col("o_orderkey") % 20).cast("string"))
    body = F.when(F.col("o_orderkey") % 3 == 1, span).when(F.col("o_orderkey") % 3 == 2, "vyrocni zprava za rok 2003").otherwise("vyhotoveno dne 10.9.2024")
    day = classify.period_end_date(picked(WORDINGS, "o_orderkey"), values.document_dates(body, F.lit("https://a.cz/x.pdf")))
    return table(spark, d, "orders").select("o_orderkey", day.alias("day"))


ANCHORS = [w for _, _, words in labels.LINK_RULES for w in words] + ["Stáhnout statut fondu", "statut fondu memorandum", "kontakt statut", "more", "", "Výroční zpráva annual report annual financial report"]
_LINKS = [(kind, k, points, w) for k, (kind, points, words) in enumerate(labels.LINK_RULES) for w in words]
LINK_KINDS_SQL = rf"""WITH l AS (SELECT page_id, url, CASE page_id % 4 WHEN 0 THEN 'https://other.cz/a/file.PDF?x=1' WHEN 1 THEN 'https://other.cz/gallery/x' WHEN 2 THEN regexp_extract(url, '^([a-zA-Z]+://[^/?#]*)', 1) || '/doc.xml' ELSE regexp_extract(url, '^([a-zA-Z]+://[^/?#]*)', 1) || '/doc.xml.html' END AS href,
  lower(strip_accents({sql_list(ANCHORS)}[page_id % {len(ANCHORS)} + 1])) AS a FROM pages),
x AS (SELECT *, a || ' ' || lower(strip_accents(href)) AS w FROM l), r(kind, pos, points, word) AS (VALUES {', '.join(map(str, _LINKS))}),
p AS (SELECT page_id, kind, pos, max(points) + least(count(*) - 1, 3) * 5 AS s FROM x JOIN r ON contains(w, word) GROUP BY ALL),
b AS (SELECT page_id, arg_max(kind, (s, -pos)) AS kind, max(s) AS s FROM p GROUP BY page_id),
t AS (SELECT x.page_id, coalesce(kind, 'other') AS kind, greatest(0, coalesce(s, 0) + CASE WHEN page_id % 4 IN (0, 2) THEN 30 ELSE 0 END + CASE WHEN {contains_any('a', labels.LINK_DOWNLOAD)} THEN 10 ELSE 0 END
  + CASE WHEN page_id % 4 >= 2 THEN 5 ELSE 0 END - CASE WHEN {contains_any('w', labels.LINK_NEGATIVE)} THEN 70 ELSE 0 END)::BIGINT AS score FROM x LEFT JOIN b USING (page_id))
SELECT page_id, CASE WHEN score >= 35 THEN kind END AS kind, CASE WHEN score >= 35 THEN score END AS score FROM t"""


@query("link_kinds", LINK_KINDS_SQL)
def link_kinds(spark, d):
    root, k = F.regexp_extract("url", "^([a-zA-Z]+://[^/?#]*)", 1), F.col("page_id") % 4
    href = F.when(k == 0, "https://other.cz/a/file.PDF?x=1").when(k == 1, "https://other.cz/gallery/x").when(k == 2, F.concat(root, F.lit("/doc.xml"))).otherwise(F.concat(root, F.lit("/doc.xml.html")))
    link = graph.classified_link(href, picked(ANCHORS, "page_id"), F.col("url"))
    return table(spark, d, "pages").select("page_id", link.alias("l")).select("page_id", "l.kind", F.col("l.score").cast("long").alias("score"))


@query("catalogue_matches")
def catalogue_matches(spark, d):
    """Part names against names in other wording, by the rules of one catalogue; the ratio of letters has no SQL (see tests)."""
    p = table(spark, d, "part").select(F.col("p_name").alias("name")).distinct()
    entries = p.select(F.concat(F.lit("Fond "), F.regexp_replace("name", r"^(\S+) (\S+)", "$2 $1"), F.lit(" SICAV")).alias("entry"))
    return fuzzy.best_match(p, entries, "name", "entry", profile=fuzzy.AMISTA)


@query("news_findings", """WITH i AS (SELECT o_custkey AS fund, o_orderkey k, 'https://' || CASE o_orderkey % 4 WHEN 0 THEN 'www.fund' || o_custkey || '.cz' WHEN 1 THEN 'manager.cz' WHEN 2 THEN 'manager.cz/modravlna' ELSE 'press.cz' END || '/n' || o_orderkey AS url, o_orderkey % 5 = 0 AS undated FROM orders)
SELECT fund, url, CASE k % 4 WHEN 1 THEN 'news_of_another_fund' ELSE 'news_from_unofficial_source' END AS code, CASE k % 4 WHEN 1 THEN 'reject' ELSE 'review' END AS severity FROM i WHERE k % 4 IN (1, 3)
UNION ALL SELECT DISTINCT fund, NULL, 'news_without_date', 'review' FROM i WHERE undated""")
def news_findings(spark, d):
    k = F.col("o_orderkey") % 4
    host = F.when(k == 0, F.concat(F.lit("www.fund"), "o_custkey", F.lit(".cz"))).when(k == 1, "manager.cz").when(k == 2, "manager.cz/modravlna").otherwise("press.cz")
    url = F.concat(F.lit("https://"), host, F.lit("/n"), "o_orderkey")
    title = F.when(k == 2, "Fond Modrá vlna roste").otherwise("Zpráva o trhu")
    day = F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderdate").cast("date"))
    items = table(spark, d, "orders").select(F.col("o_custkey").alias("fund"), url.alias("url"), title.alias("title"), day.alias("published_at"), (k == 3).alias("third_party"))
    funds = table(spark, d, "customer").select(F.col("c_custkey").alias("fund"), F.lit("Modrá vlna fond SICAV").alias("name"), F.concat(F.lit("https://fund"), "c_custkey", F.lit(".cz")).alias("web"))
    return rules.news_items(items, funds, "fund")


QUOTES = [
    "snížen vlastní kapitál společnosti MS Trnitá 1 s.r.o. o {} mil. Kč",
    "vlastní kapitál společnosti MS Trnitá 1 s.r.o. a fondu celkem {} mil. Kč",
    "fondový kapitál Modrá vlna SICAV a.s. činí {} mil. Kč",
    "Trnitá 1 s.r.o., Modrá vlna SICAV a.s. {} mil. Kč",
    "aktiva {} mil. Kč, z toho Trnitá 1 s.r.o.",
    "Trnitá 1 s.r.o. bez částky",
]


@query("capital_attribution", "SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN 'capital_of_another_company' END AS code FROM orders")
def capital_attribution(spark, d):
    amount = (F.col("o_orderkey") % 900 + 100).cast("double")
    quote = F.replace(picked(QUOTES, "o_orderkey"), F.lit("{}"), F.format_number(amount, 0))
    return table(spark, d, "orders").select("o_orderkey", rules.capital_attribution(amount * 1e6, quote, F.lit("Modrá vlna SICAV a.s."))["code"].alias("code"))


@query("small_amounts", "SELECT l_returnflag, l_linestatus, code, count(*) AS n FROM (SELECT l_returnflag, l_linestatus, CASE WHEN l_linenumber = 1 THEN 'other' WHEN l_linestatus = 'O' THEN 'aum_value_not_tied_to_label' WHEN l_returnflag = 'R' THEN 'thousands_unit_not_applied' ELSE 'implausibly_small_aum' END AS code FROM lineitem) GROUP BY ALL")
def small_amounts(spark, d):
    code = F.when(F.col("l_linenumber") == 1, "other").otherwise("implausibly_small_aum")
    quote = F.when(F.col("l_linestatus") == "O", "Aktiva 17 000 tis. Kč").otherwise("Aktiva 17 000")
    url = F.when(F.col("l_returnflag") == "R", "https://a.cz/Výroční-zpráva.pdf").otherwise("https://a.cz/x.pdf")
    li = table(spark, d, "lineitem").withColumn("code", rules.explained_small_amount(code, quote, url))
    return li.groupBy("l_returnflag", "l_linestatus", "code").agg(F.count("*").alias("n"))


@query("pass_metrics", "SELECT l_returnflag, count(*) AS funds, sum(l_linenumber)::BIGINT AS pages_visited, sum(l_suppkey % 3)::BIGINT AS failures, sum(l_suppkey % 3 // 2)::BIGINT AS expected_misses, round(sum(l_partkey % 10) + 0.0::DOUBLE, 3) AS duration_seconds, (sum(l_suppkey % 3) - sum(l_suppkey % 3 // 2))::BIGINT AS real_failures FROM lineitem GROUP BY 1")
def pass_metrics(spark, d):
    failed = F.col("l_suppkey") % 3
    li = table(spark, d, "lineitem").select("l_returnflag", F.col("l_linenumber").alias("pages_visited"), failed.alias("failures"), F.floor(failed / 2).alias("expected_misses"), (F.col("l_partkey") % 10).cast("double").alias("duration_seconds"))
    return audit.pass_metrics(li, ["l_returnflag"])


@query("run_totals", """SELECT user_id % 7 AS part, 'outcomes' AS metric, event_type AS level, count(*)::DOUBLE AS n FROM events GROUP BY ALL
UNION ALL SELECT part, 'triggers', 't' || t, count(*) FROM (SELECT user_id % 7 AS part, unnest(range(event_id % 3)) AS t FROM events) GROUP BY ALL
UNION ALL SELECT user_id % 7, 'changed', NULL, sum(event_id % 11) FROM events GROUP BY ALL""")
def run_totals(spark, d):
    k = F.col("event_id") % 3
    triggers = F.slice(F.array(F.lit("t0"), F.lit("t1")), F.lit(1), k.cast("int"))
    e = table(spark, d, "events").select((F.col("user_id") % 7).alias("part"), "event_type", triggers.alias("triggers"), (F.col("event_id") % 11).alias("changed"))
    return audit.totals(e, {"outcomes": "event_type", "triggers": "triggers"}, ["changed"], ["part"])


@query("ablation", "SELECT s AS switch, c_custkey AS fund, 'fees' AS field FROM customer, (VALUES (1), (2)) v(s) WHERE c_custkey % (s + 1) > 0")
def ablation(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("fund"), F.lit("fees").alias("field"))
    without = c.withColumn("switch", F.explode(F.array(F.lit(1), F.lit(2)))).where("fund % (switch + 1) = 0")
    return deltas.ablation(c, without, "switch", ["fund", "field"])
