"""Who is named in documents, conversations and links."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..functions.labels import DOCUMENT_VOCABULARY, NAME_NOISE, OTHER_FUND_MARKERS
from ..operators import mentions
from ..queries import query, table
from .web import LINKS, links

WORDS = r"regexp_extract_all(lower(strip_accents({0})), '[\p{{L}}\p{{N}}]+')"


def listed(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def first_words(x, n: int):
    """The first n words of a text as it is written, with what stands between them."""
    return F.regexp_extract(x, rf"^[^\p{{L}}\p{{N}}]*((?:[\p{{L}}\p{{N}}]+[^\p{{L}}\p{{N}}]+){{{n - 1}}}[\p{{L}}\p{{N}}]+)", 1)


@query("name_mentions", f"""WITH n AS (SELECT item_id, {WORDS.format('text')}[1:3] AS name FROM benchmark), d AS (SELECT doc_id, {WORDS.format('text')} AS list FROM documents),
w AS (SELECT doc_id, list, unnest(list) AS w, unnest(range(len(list))) AS word FROM d)
SELECT doc_id, item_id, word::INT AS word, 3 AS n_words FROM w JOIN n ON w.w = n.name[1] WHERE list[word + 1:word + 3] = n.name AND len(n.name) = 3""")
def name_mentions(spark, d):
    names = table(spark, d, "benchmark").select("item_id", first_words("text", 3).alias("name"))
    found = mentions.mentions(table(spark, d, "documents"), ["doc_id"], "text", names, "name", "item_id")
    return found.select("doc_id", "item_id", "word", "n_words")


@query("opening_mentions", f"""WITH t AS (SELECT conv_id, turn, {WORDS.format('text')} AS list FROM conversations), n AS (SELECT DISTINCT conv_id AS named, list[1:2] AS name FROM t WHERE len(list) >= 2),
w AS (SELECT conv_id, turn, unnest(list) AS w, unnest(range(len(list))) AS word, list FROM t)
SELECT conv_id, turn, count(*) AS n, count(DISTINCT named) AS conversations, min(word)::INT AS first_word FROM w JOIN n ON w.w = n.name[1] WHERE list[word + 1:word + 2] = n.name GROUP BY conv_id, turn""")
def opening_mentions(spark, d):
    """Where turns of conversations hold the two words with which a turn of any conversation opens."""
    turns = table(spark, d, "conversations")
    names = turns.select(F.col("conv_id").alias("named"), first_words("text", 2).alias("name"))
    found = mentions.named(turns, ["conv_id", "turn"], "text", names, "name", "named", most=500)
    turns = found.groupBy("conv_id", "turn").agg(F.sum(F.size("ids")).alias("n"), F.collect_list("ids").alias("named"), F.min("word").alias("first_word"))
    return turns.select("conv_id", "turn", "n", F.size(F.array_distinct(F.flatten("named"))).cast("long").alias("conversations"), "first_word")


FORMED = rf"""t AS (SELECT doc_id, regexp_extract_all(regexp_replace(lower(strip_accents(text)), '\bthe\b', 'sicav', 'g'), '[a-z0-9]+') AS list FROM documents),
w AS (SELECT doc_id, word, list_filter(list[greatest(word - 7, 1):word], lambda x: length(x) >= 2 AND NOT list_contains({listed(NAME_NOISE)}, x)) AS tokens FROM (SELECT doc_id, list, unnest(list) AS w, unnest(range(len(list))) AS word FROM t) WHERE w = 'sicav'),
m AS (SELECT doc_id, word, tokens FROM w WHERE len(tokens) > 0), f AS (SELECT doc_id, arg_min(tokens, word) AS first FROM m GROUP BY doc_id)"""


@query("names_before_forms", f"""WITH {FORMED} SELECT doc_id, count(*) AS n, array_to_string(any_value(first), ' ') AS first, bool_or(NOT (tokens[greatest(-len(tokens), -2):] = first[greatest(-len(first), -2):])) AS names_another,
count(*) FILTER (WHERE tokens[greatest(-len(tokens), -2):] = first[greatest(-len(first), -2):] AND len(tokens) >= 2 OR (len(first) = 1 AND tokens[-1] = first[1])) AS sections FROM m JOIN f USING (doc_id) WHERE len(first) >= 2 GROUP BY doc_id""")
def names_before_forms(spark, d):
    """Names before legal forms, with each `the` of the documents read as one: the first one's last two words are the document's own."""
    docs = table(spark, d, "documents").select("doc_id", F.regexp_replace(text.fold_aligned("text"), r"\bthe\b", "sicav").alias("text"))
    found = docs.select("doc_id", F.length("text").alias("size"), mentions.names_before_forms("text").alias("m")).where(F.size("m") > 0)
    rows = found.withColumn("first", F.col("m")[0]["tokens"]).where(F.size("first") >= 2).withColumn("own", F.slice("first", -2, 2))
    sections = mentions.own_sections(F.col("m"), F.col("own"), F.col("size"))
    return rows.select("doc_id", F.size("m").cast("long").alias("n"), F.array_join("first", " ").alias("first"), mentions.names_another(F.col("m"), F.col("own")).alias("names_another"), F.size(sections).cast("long").alias("sections"))


GENERIC = listed(text.GENERIC_WORDS)


@query("links_naming_another", rf"""WITH {LINKS}, a AS (SELECT j.page_id, j.seq, j.href, replace(lower(strip_accents(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1))), 'ß', 'ss') AS title FROM j JOIN pages USING (page_id) WHERE j.href IS NOT NULL),
x AS (SELECT *, list_filter(list_distinct(regexp_extract_all(title, '[\p{{L}}\p{{N}}]+')), lambda t: length(t) >= 3 AND NOT list_contains({GENERIC}, t)) AS own,
  'podfond ' || replace(lower(strip_accents(regexp_replace(coalesce(url_decode(regexp_extract(href, '://[^/?#]*([^?#]*)', 1) || ' ' || regexp_extract(href, '^[^?#]*\?([^#]*)', 1)), ''), '[-_/.+]', ' ', 'g'))), 'ß', 'ss') AS words FROM a),
y AS (SELECT *, list_filter(list_distinct(regexp_extract_all(words, '[a-z]{{3,}}')), lambda t: NOT list_contains({GENERIC}, t) AND NOT list_contains({listed(DOCUMENT_VOCABULARY)}, t)) AS named FROM x)
SELECT page_id, count(*) AS n, count(*) FILTER (WHERE len(own) > 0 AND len(named) > 0 AND len(list_filter(named, lambda n: len(list_filter(own, lambda o: n = o OR length(n) >= 4 AND contains(o, n) OR length(o) >= 4 AND contains(n, o))) > 0)) = 0) AS another FROM y GROUP BY page_id""")
def links_naming_another(spark, d):
    """Links, read as naming a subfund, that share no word with their page's title."""
    from ..operators.graph import title

    titles = table(spark, d, "pages").select("page_id", title(F.col("html")).alias("title"))
    rows = links(spark, d).join(titles, "page_id")
    another = text.link_names_another("title", F.lit(OTHER_FUND_MARKERS[1]), "href")
    return rows.groupBy("page_id").agg(F.count("*").alias("n"), F.count_if(another).alias("another"))
