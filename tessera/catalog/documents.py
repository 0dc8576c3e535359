"""Text functions over documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classify, text
from ..operators import rank
from ..queries import query, table

FOLD = r"trim(regexp_replace(replace(strip_accents(lower({0})), 'ß', 'ss'), '\s+', ' ', 'g'))"


@query("fold_text", f"SELECT doc_id, {FOLD.format('text')} AS folded FROM documents")
def fold_text(spark, d):
    return table(spark, d, "documents").select("doc_id", text.fold("text").alias("folded"))


@query("fold_text_exactly", f"SELECT doc_id, {FOLD.format('text')} AS folded FROM documents")
def fold_text_exactly(spark, d):
    return table(spark, d, "documents").select("doc_id", text.fold_exactly("text").alias("folded"))


@query("fold_aligned", "SELECT doc_id, length(text)::BIGINT AS n, length(text)::BIGINT AS n_folded, lower(strip_accents(text)) AS folded FROM documents")
def fold_aligned(spark, d):
    f = text.fold_aligned("text")
    return table(spark, d, "documents").select("doc_id", F.length("text").cast("long").alias("n"), F.length(f).cast("long").alias("n_folded"), f.alias("folded"))


@query("text_dedup_first", "SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY text")
def text_dedup_first(spark, d):
    return table(spark, d, "documents").groupBy(F.sha2("text", 256)).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")).select("doc_id", "copies")


@query("extracted_text", r"SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '[ \t]+', ' ', 'g'), ' ?\n ?', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS body FROM documents")
def extracted_text(spark, d):
    return table(spark, d, "documents").select("doc_id", text.extracted("text").alias("body"))


@query("url_canonical", r"SELECT page_id, lower(regexp_extract(url, '^([a-zA-Z]+)://', 1)) || '://' || lower(regexp_extract(url, '://([^/?#:]+)', 1)) || CASE WHEN rtrim(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '/') = '' THEN '/' ELSE rtrim(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '/') END || CASE WHEN regexp_extract(url, '\?([^#]*)', 1) = '' THEN '' ELSE '?' || regexp_extract(url, '\?([^#]*)', 1) END AS url FROM pages")
def url_canonical(spark, d):
    return table(spark, d, "pages").select("page_id", text.canonical_url("url").alias("url"))


@query("url_domain_counts", r"SELECT regexp_replace(lower(regexp_extract(url, '://([^/?#:]+)', 1)), '^www\.', '') AS domain, count(*) AS n FROM pages GROUP BY 1")
def url_domain_counts(spark, d):
    return table(spark, d, "pages").groupBy(text.canonical_domain("url").alias("domain")).agg(F.count("*").alias("n"))


@query("file_name_words", r"""WITH n AS (SELECT page_id, url_decode(regexp_extract(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '([^/]*)/*$', 1)) AS name FROM pages)
SELECT page_id, trim(regexp_replace(lower(strip_accents(regexp_replace(regexp_replace(name, '^(.+)\.[^.]*$', '\1'), '[-_.+]', ' ', 'g'))), '\s+', ' ', 'g')) AS words, name FROM n""")
def file_name_words(spark, d):
    p = table(spark, d, "pages")
    return p.select("page_id", text.file_name_words("url").alias("words"), text.file_name("url").alias("name"))


@query("distinctive_tokens", "WITH w AS (SELECT p_partkey, unnest(string_split(p_name || ' Fond ' || p_type || ' ' || p_name, ' ')) t FROM part) SELECT p_partkey, count(DISTINCT lower(t)) FILTER (length(t) >= 3 AND lower(t) <> 'fond') AS n, min(lower(t)) FILTER (length(t) >= 3 AND lower(t) <> 'fond') AS first_token FROM w GROUP BY p_partkey")
def distinctive_tokens(spark, d):
    t = text.distinctive_tokens(F.concat_ws(" ", "p_name", F.lit("Fond"), "p_type", "p_name"))
    return table(spark, d, "part").select("p_partkey", F.size(t).cast("long").alias("n"), F.array_min(t).alias("first_token"))


@query("company_keys", r"SELECT s_suppkey, regexp_replace(lower(s_name || ', A. S.'), '[^a-z0-9]', '', 'g') AS key, count(*) OVER (PARTITION BY regexp_replace(lower(s_name), '[^a-z]', '', 'g')) AS same_letters FROM supplier")
def company_keys(spark, d):
    letters = text.entity_key(F.regexp_replace("s_name", "[^A-Za-z]", ""))
    s = table(spark, d, "supplier").withColumn("letters", letters)
    n = s.groupBy("letters").agg(F.count("*").alias("same_letters"))
    return s.join(n, "letters").select("s_suppkey", text.company_key(F.concat("s_name", F.lit(", A. S."))).alias("key"), "same_letters")


@query("legal_forms_stripped", "SELECT s_suppkey, s_name AS name, s_name AS plain FROM supplier")
def legal_forms_stripped(spark, d):
    forms = F.array(*map(F.lit, [", a.s.", " SICAV a. s.", " s.r.o.", ""]))
    named = F.concat("s_name", F.get(forms, F.pmod("s_suppkey", F.lit(4)).cast("int")))
    return table(spark, d, "supplier").select("s_suppkey", F.col("s_name").alias("name"), text.without_legal_forms(named).alias("plain"))


@query("name_phrases", "SELECT p_partkey, len(string_split(p_name || ' fond', ' '))::BIGINT AS n_words, 2::BIGINT AS phrases FROM part")
def name_phrases(spark, d):
    named = F.concat("p_name", F.lit(" fond"))
    return table(spark, d, "part").select("p_partkey", F.size(text.words(named)).cast("long").alias("n_words"), F.size(text.name_phrases(named)).cast("long").alias("phrases"))


@query("domain_guesses", "SELECT p_partkey, replace(p_name, ' ', '') || '.cz' AS first_guess, (CASE WHEN p_name LIKE '% %' THEN 4 ELSE 2 END * 3)::BIGINT AS n FROM part")
def domain_guesses(spark, d):
    g = text.domain_guesses("p_name")
    return table(spark, d, "part").select("p_partkey", F.get(g, 0).alias("first_guess"), F.size(g).cast("long").alias("n"))


@query("search_queries", "SELECT s_suppkey, s_name || ' SICAV a.s.|' || s_name || '|' || s_name || ' fond|' || lower(regexp_replace(s_name, '[^A-Za-z0-9]+', ' ', 'g')) AS q FROM supplier")
def search_queries(spark, d):
    q = text.search_queries(F.concat("s_name", F.lit(" SICAV a.s.")))
    return table(spark, d, "supplier").select("s_suppkey", F.array_join(q, "|").alias("q"))


@query("registration_numbers", "SELECT c_custkey, CASE WHEN length(d) = 8 THEN d END AS ico FROM (SELECT c_custkey, regexp_replace(CASE WHEN c_custkey % 3 = 0 THEN 'IČO: ' || lpad(c_custkey::VARCHAR, 8, '0') ELSE 'IČ 12 ' || c_custkey END, '[^0-9]', '', 'g') d FROM customer)")
def registration_numbers(spark, d):
    raw = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("IČO: "), F.lpad(F.col("c_custkey").cast("string"), 8, "0"))).otherwise(F.concat(F.lit("IČ 12 "), "c_custkey"))
    return table(spark, d, "customer").select("c_custkey", text.registration_number(raw).alias("ico"))


@query("share_classes", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'PIA' WHEN o_orderkey % 4 = 1 THEN 'A' WHEN o_orderkey % 4 = 2 THEN 'B2' END AS class FROM orders")
def share_classes(spark, d):
    texts = F.array(*map(F.lit, ["Třída PIA: 1,3820 CZK", "pro třídu A platí", "akcie B2 fondu", "Fondový kapitál celkem"]))
    return table(spark, d, "orders").select("o_orderkey", text.share_class(F.get(texts, F.pmod("o_orderkey", F.lit(4)).cast("int"))).alias("class"))


@query("emphasis_stripped", "SELECT item_id, text AS plain FROM benchmark")
def emphasis_stripped(spark, d):
    marked = F.concat(F.lit("**"), F.substring("text", F.lit(1), F.lit(10)), F.lit("**__"), F.substring("text", F.lit(11), F.length("text")), F.lit("__"))
    return table(spark, d, "benchmark").select("item_id", text.without_emphasis(marked).alias("plain"))


@query("text_metrics", r"SELECT doc_id, length(text)::BIGINT AS chars, len(regexp_extract_all(text, '[^\s]+'))::BIGINT AS words, len(regexp_extract_all(text, '[0-9]'))::BIGINT AS digits, len(list_distinct(regexp_extract_all(text, '[^\s]+')))::BIGINT AS distinct_words FROM documents")
def text_metrics(spark, d):
    w = F.regexp_extract_all("text", F.lit(r"[^\s]+"), 0)
    return table(spark, d, "documents").select("doc_id", F.length("text").cast("long").alias("chars"), F.size(w).cast("long").alias("words"), F.regexp_count("text", F.lit("[0-9]")).cast("long").alias("digits"), F.size(F.array_distinct(w)).cast("long").alias("distinct_words"))


@query("token_retention", r"WITH t AS (SELECT doc_id, list_distinct(regexp_extract_all(text, '[^\s]+')) a, regexp_extract_all(regexp_replace(text, '[^\n]*[0-9][^\n]*', '', 'g'), '[^\s]+') b FROM documents) SELECT doc_id, CASE WHEN len(a) = 0 THEN 1.0::DOUBLE ELSE round(len(list_intersect(a, b)) / len(a), 9) END AS retention FROM t")
def token_retention(spark, d):
    w = lambda x: F.regexp_extract_all(x, F.lit(r"[^\s]+"), 0)
    second = text.without_figures("text")  # a second reading that has lost the lines with digits
    return table(spark, d, "documents").select("doc_id", F.round(text.retention(w(F.col("text")), w(second)), 9).alias("retention"))


@query("broken_sentences", r"SELECT doc_id, CASE WHEN b + w = 0 THEN 0.0::DOUBLE ELSE round(b / (b + w), 9) END AS ratio FROM (SELECT doc_id, len(regexp_extract_all(text, '[.!?]\s+\p{Ll}')) b, len(regexp_extract_all(text, '[.!?]\s+[\p{Lu}0-9]')) w FROM documents)")
def broken_sentences(spark, d):
    return table(spark, d, "documents").select("doc_id", F.round(text.broken_ratio("text"), 9).alias("ratio"))


@query("first_match_label", "SELECT doc_id, CASE WHEN f LIKE '%license%' THEN 'legal' WHEN f LIKE '%the %' OR f LIKE '%and %' THEN 'english' WHEN f LIKE '% der %' THEN 'german' END AS kind FROM (SELECT doc_id, lower(strip_accents(text)) f FROM documents)")
def first_match_label(spark, d):
    labels = {"legal": ["license"], "english": ["the ", "and "], "german": [" der "]}
    return table(spark, d, "documents").select("doc_id", classify.first_match(text.fold_aligned("text"), labels).alias("kind"))


@query("nearest_label", "WITH f AS (SELECT doc_id, lower(strip_accents(text)) f FROM documents), p AS (SELECT doc_id, k, w, o, CASE WHEN contains(f, w) THEN length(f) - instr(reverse(f), reverse(w)) - length(w) + 1 END pos FROM f, (VALUES ('article', ' the ', 0), ('article', ' der ', 0), ('link', ' and ', 1), ('link', ' und ', 1), ('place', ' in ', 2)) l(k, w, o)) SELECT f.doc_id, (SELECT arg_max(k, pos * 1000000 + length(w) * 1000 - o) FROM p WHERE p.doc_id = f.doc_id AND pos IS NOT NULL) AS kind FROM f")
def nearest_label(spark, d):
    labels = {"article": [" the ", " der "], "link": [" and ", " und "], "place": [" in "]}
    return table(spark, d, "documents").select("doc_id", classify.nearest_label(text.fold_aligned("text"), labels).alias("kind"))


@query("keyword_vote_type", """WITH s AS (SELECT doc_id, lower(text) b, lower(substr(text, 1, 60)) h FROM documents), p AS (SELECT doc_id,
  5 * (CASE WHEN contains(h, 'the ') THEN 6 ELSE 0 END + CASE WHEN contains(h, ' of ') THEN 2 ELSE 0 END) + CASE WHEN contains(b, 'the ') THEN 6 ELSE 0 END + CASE WHEN contains(b, ' of ') THEN 2 ELSE 0 END e,
  5 * (CASE WHEN contains(h, 'die ') THEN 6 ELSE 0 END + CASE WHEN contains(h, ' und ') THEN 2 ELSE 0 END) + CASE WHEN contains(b, 'die ') THEN 6 ELSE 0 END + CASE WHEN contains(b, ' und ') THEN 2 ELSE 0 END g FROM s)
SELECT doc_id, CASE WHEN greatest(e, g) >= 6 THEN CASE WHEN e >= g THEN 'english' ELSE 'german' END END AS kind, greatest(e, g)::BIGINT AS score, greatest(e, g) >= 6 AND abs(e - g) < 4 AS ambiguous FROM p""")
def keyword_vote_type(spark, d):
    types = {"english": (["the "], [" of "]), "german": (["die "], [" und "])}
    v = classify.vote({"header_text": F.lower(F.substring("text", 1, 60)), "body_text": F.lower("text")}, types)
    return table(spark, d, "documents").select("doc_id", v.alias("v")).select("doc_id", "v.kind", F.col("v.score").cast("long").alias("score"), "v.ambiguous")


@query("marker_flags", "SELECT doc_id, contains(f, 'license') AS licensed, contains(f, 'inflation') OR contains(f, 'benchmark') AS benchmark_linked, length(line) - length(replace(line, ' ', '')) + 1 <= 8 AS short_first_line FROM (SELECT doc_id, lower(text) f, trim(string_split(text, chr(10))[1]) line FROM documents)")
def marker_flags(spark, d):
    low, line = F.lower("text"), F.trim(F.get(F.split("text", "\n"), 0))
    return table(spark, d, "documents").select("doc_id", text.has_any(low, ["license"]).alias("licensed"), text.has_any(low, classify.BENCHMARK).alias("benchmark_linked"), (F.size(F.split(line, " ")) <= 8).alias("short_first_line"))


@query("snippets_topk", """WITH l AS (SELECT doc_id, lang, unnest(string_split(text, chr(10))) line, unnest(range(len(string_split(text, chr(10))))) pos FROM documents),
s AS (SELECT doc_id, lang, pos, trim(line) line, 35 * (contains(lower(line), 'the ')::INT + contains(lower(line), 'license')::INT) + least(length(trim(line)), 50) score FROM l WHERE trim(line) <> ''),
u AS (SELECT *, row_number() OVER (PARTITION BY lang, line ORDER BY score DESC, doc_id, pos) k FROM s), r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, doc_id, pos) n FROM u WHERE k = 1)
SELECT lang, n::BIGINT AS place, doc_id, score::BIGINT AS score FROM r WHERE n <= 5""")
def snippets_topk(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "lang", F.posexplode(F.split("text", "\n")).alias("pos", "line")).withColumn("line", F.trim("line")).where("line <> ''")
    hits = sum((F.when(F.contains(F.lower("line"), F.lit(w)), 1).otherwise(0) for w in ("the ", "license")), F.lit(0))
    scored = rows.withColumn("score", 35 * hits + F.least(F.length("line"), F.lit(50)))
    once = rank.best(scored, ["lang", "line"], F.struct("score", -F.col("doc_id"), -F.col("pos")), ["doc_id", "pos", "score"])
    top = rank.cap(once, ["lang"], [F.desc("score"), "doc_id", "pos"], 5)
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), "doc_id", "pos"))
    return top.select("lang", place.cast("long").alias("place"), "doc_id", F.col("score").cast("long").alias("score"))
