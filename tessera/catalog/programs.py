"""Audits of evidence and programs over whole runs, over the given tables; the SQL says the same by other means."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import resolve
from ..plans import planning, programs, sources_audit
from ..queries import query, table
from .claims import PAIRS, claims
from .rulebook import contains_any, picked, sql_list

FEE_LINES = [
    "Vstupní poplatek {} %",
    "Vstupní poplatek je příjmem společnosti a činí {} %",
    "Výstupní poplatek (srážka) je {} % příjmem do fondu",
    "Výkonnostní odměna činí {} % z výnosu, odměna je příjmem fondu",
    "Vstupní poplatek se hradí při úpisu investičních akcií podle sazebníku distributora a činí {} %",
    "od 0 % do {} % z výše investice, splatné při úpisu podle sazebníku a podmínek distributora; vstupní poplatek",
    "Poplatek max. {} %",
    "Poplatek nejvýše dle sazebníku",
    "náleží fondu: {} %",
    "{} % z hodnoty",
]
FEE_EVIDENCE_SQL = f"""WITH r AS (SELECT o_orderkey, o_orderkey % 60 / 4.0 AS rate, o_orderkey % 3 = 0 AS maximum, rtrim(rtrim(printf('%.4f', o_orderkey % 60 / 4.0), '0'), '.') AS g, {sql_list(FEE_LINES)}[o_orderkey % {len(FEE_LINES)} + 1] AS line FROM orders),
w AS (SELECT *, CASE WHEN o_orderkey % 7 < 4 THEN replace(g, '.', ',') ELSE g END AS shown FROM r),
x AS (SELECT *, lower(strip_accents(replace(line, '{{}}', shown))) AS t FROM w),
p AS (SELECT *, CASE WHEN strpos(t, g) > 0 THEN strpos(t, g) ELSE nullif(strpos(t, replace(g, '.', ',')), 0) END AS place,
  list_filter(list_transform({sql_list(sources_audit.FEE_LABELS)}, lambda w_: strpos(t, w_)), lambda p_: p_ > 0) AS labels,
  list_min(list_filter(list_transform({sql_list(sources_audit.INCOME_SHARE)}, lambda w_: strpos(t, w_)), lambda p_: p_ > 0)) AS share FROM x),
q AS (SELECT *, list_min(labels) AS label, list_min(list_transform(labels, lambda p_: abs(place - p_))) AS distance,
  contains(t, 'do ' || shown || ' %') AND NOT contains(t, 'prijmem do') AS range_end FROM p)
SELECT o_orderkey, 'value_not_present_in_evidence' AS code, 'review' AS severity FROM q WHERE place IS NULL
UNION ALL SELECT o_orderkey, 'value_far_from_fee_label', 'review' FROM q WHERE distance > 60 AND NOT range_end
UNION ALL SELECT o_orderkey, 'percentage_describes_income_share', 'review' FROM q WHERE place IS NOT NULL AND share IS NOT NULL
  AND CASE WHEN label IS NULL THEN share < place ELSE label < place AND (share > label AND share < place OR share - place - length(g) BETWEEN 0 AND 3) END
UNION ALL SELECT o_orderkey, 'maximum_flag_contradicts_source', 'conflict' FROM q WHERE place IS NOT NULL AND NOT maximum AND {contains_any('t', sources_audit.FEE_MAXIMUM)}"""


@query("fee_evidence", FEE_EVIDENCE_SQL)
def fee_evidence(spark, d):
    k = F.col("o_orderkey")
    rate = (k % 60 / 4).cast("double")
    plain = sources_audit.plain_number(rate)
    shown = F.when(k % 7 < 4, F.replace(plain, F.lit("."), F.lit(","))).otherwise(plain)
    basis = F.replace(picked(FEE_LINES, "o_orderkey"), F.lit("{}"), shown)
    fees = table(spark, d, "orders").select("o_orderkey", rate.alias("rate"), basis.alias("basis"), (k % 3 == 0).alias("maximum"))
    return sources_audit.fee_findings(fees, ["o_orderkey"])


SOURCE_EVIDENCE_SQL = """WITH v AS (SELECT o_orderkey, o_custkey, o_orderkey % 3 AS source, o_orderkey % 5 AS kind, CASE o_orderkey % 5 WHEN 0 THEN 'https://m.cz/klient' || o_custkey || '/statut.pdf' WHEN 1 THEN 'https://m.cz/dokument/' || o_orderkey % 2000
  WHEN 2 THEN '' WHEN 3 THEN 'https://m.cz/KL%C3%8DENT' || o_custkey WHEN 4 THEN NULL END AS url FROM orders),
s AS (SELECT *, count(DISTINCT o_custkey) OVER (PARTITION BY url) AS names FROM v WHERE url <> '')
SELECT o_orderkey, 'third_party_source' AS code, 'review' AS severity, 0::BIGINT AS other_names FROM s WHERE source = 2
UNION ALL SELECT o_orderkey, 'source_shared_across_funds', 'conflict', names - 1 FROM s WHERE names > 1
UNION ALL SELECT o_orderkey, 'source_does_not_name_the_fund', 'review', 0 FROM s WHERE source = 1 AND kind = 1"""


@query("source_evidence", SOURCE_EVIDENCE_SQL)
def source_evidence(spark, d):
    k, fund = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    own, encoded = F.concat(F.lit("https://m.cz/klient"), fund, F.lit("/statut.pdf")), F.concat(F.lit("https://m.cz/KL%C3%8DENT"), fund)
    url = F.when(k % 5 == 0, own).when(k % 5 == 1, F.concat(F.lit("https://m.cz/dokument/"), (k % 2000).cast("string"))).when(k % 5 == 2, "").when(k % 5 == 3, encoded)
    source = F.when(k % 3 == 0, "official_website").when(k % 3 == 1, "manager_or_administrator").otherwise("third_party")
    name = F.concat(F.lit("Fond Klient"), fund)
    values = table(spark, d, "orders").select("o_orderkey", name.alias("name"), url.alias("url"), source.alias("source"))
    return sources_audit.source_evidence(values, ["o_orderkey"], "name", "url", "source")


CROSS_FIELDS_SQL = """WITH o AS (SELECT o_custkey AS fund, o_orderkey AS k, o_totalprice AS amount, o_orderdate::DATE AS as_of FROM orders),
a AS (SELECT * FROM o WHERE k % 10 = 0), s AS (SELECT * FROM o WHERE k % 10 > 0), latest AS (SELECT fund, max(as_of) AS m FROM s GROUP BY fund)
SELECT DISTINCT fund, 'assets_under_management' AS field, 'newer_aum_observation_exists' AS code, 'review' AS severity FROM a JOIN latest USING (fund) WHERE m > as_of
UNION ALL SELECT a.fund, 'assets_under_management', 'conflicting_values', 'conflict' FROM a JOIN s ON a.fund = s.fund AND a.as_of = s.as_of GROUP BY a.fund HAVING min(abs(a.amount - s.amount) / greatest(a.amount, s.amount)) > 0.01
UNION ALL SELECT DISTINCT fund, 'assets_under_management', 'per_share_value_as_aum', 'reject' FROM a WHERE k % 40 = 0
UNION ALL SELECT DISTINCT c_custkey, 'target_return', 'historical_return_as_target_return', 'review' FROM customer JOIN o ON fund = c_custkey WHERE c_custkey % 5 > 1 AND k % 3 > 0 AND k % 12 = c_custkey % 12
UNION ALL SELECT s_suppkey, 'administrator', 'conflicting_values', 'conflict' FROM supplier WHERE s_suppkey % 4 = 1"""


@query("cross_fields", CROSS_FIELDS_SQL)
def cross_fields(spark, d):
    k, fund = F.col("o_orderkey"), F.col("o_custkey").alias("fund")
    orders = table(spark, d, "orders")
    money = orders.select(fund, k, F.col("o_totalprice").alias("amount"), F.lit("CZK").alias("currency"), F.lit("nav").alias("metric"), F.col("o_orderdate").cast("date").alias("as_of"))
    currency = F.when(k % 40 == 0, "CZK").otherwise("EUR")
    shares = orders.where(k % 10 == 0).select(fund, F.lit("nav_per_share").alias("kind"), currency.alias("currency"), F.col("o_totalprice").alias("value"))
    c = F.col("c_custkey")
    kind = F.when(c % 5 == 0, "range").when(c % 5 == 1, "not_published").otherwise("target")
    targets = table(spark, d, "customer").select(c.alias("fund"), kind.alias("kind"), (c % 12).cast("double").alias("value"))
    returns = orders.select(fund, F.when(k % 3 > 0, "calendar_year").otherwise("cumulative").alias("series"), (k % 12).cast("double").alias("rate"))
    s = table(spark, d, "supplier")
    own = F.col("s_suppkey").alias("fund")
    number = F.when(F.col("s_suppkey") % 4 == 1, "87654321").when(F.col("s_suppkey") % 4 == 2, F.lit(None)).otherwise("12345678")
    parties = s.select(own, F.lit("manager").alias("role"), F.concat("s_name", F.lit(", a.s.")).alias("name"), F.lit("12345678").alias("ico"))
    parties = parties.union(s.select(own, F.lit("administrator"), F.concat(F.upper("s_name"), F.lit(" A. S.")), number))
    return sources_audit.cross_fields(money.where(k % 10 == 0), money.where(k % 10 > 0), shares, targets, returns, parties, "fund")


#: The claims of each part's leading group, by date kind; the rest is the SQL of `clear_winner`.
LEADING_GROUP = ", every AS (SELECT *, first_value(date_kind) OVER (PARTITION BY k ORDER BY rebuilt, authority DESC, scope DESC, priority DESC, evidence DESC, score DESC, source_id, date_kind DESC) AS top_kind FROM all_claims), claims AS (SELECT * EXCLUDE (top_kind) FROM every WHERE date_kind = top_kind)"
CONTEST_SQL = "WITH " + PAIRS.replace("claims AS (", "all_claims AS (", 1).replace(", s AS (", LEADING_GROUP + ", s AS (", 1) + """ SELECT w.k, CASE WHEN n_values = 1 THEN (SELECT any_value(v) FROM led WHERE led.k = w.k) ELSE won.v END AS v, (SELECT any_value(date_kind) FROM claims c WHERE c.k = w.k) AS date_kind,
  CASE WHEN n_values = 1 THEN 'equivalent_after_normalization' WHEN won.v IS NOT NULL THEN 'auto_resolved' ELSE 'unresolved' END AS outcome, won.decided_by, n_values, n_claims FROM w LEFT JOIN won ON won.k = w.k"""


@query("leading_contest", CONTEST_SQL)
def leading_contest(spark, d):
    c = claims(spark, d)
    return resolve.contest_leading(c.withColumn("statement", F.col("date_kind")), ["k"], ["statement"], ["v"]).withColumnRenamed("statement", "date_kind")


STAGES = ["discover", "crawl", "parse", "extract", "write"]
BATCH_SQL = """WITH f AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 0 WHEN o_orderstatus = 'P' THEN 1 WHEN o_orderkey % 5 = 0 THEN 3 END AS bad FROM orders),
s AS (SELECT *, unnest(range(coalesce(bad + 1, 5))) AS step FROM f)
SELECT step::INT AS step, ['discover', 'crawl', 'parse', 'extract', 'write'][step + 1] AS stage, CASE WHEN step = bad THEN 'failed' ELSE 'completed' END AS status,
  CASE WHEN step = bad THEN CASE bad WHEN 0 THEN 'no address' WHEN 1 THEN 'timeout' ELSE 'not a number' END END AS reason, count(*) AS n FROM s GROUP BY ALL"""


def batch(spark, d):
    k = F.col("o_orderkey")
    number = F.when(k % 5 == 0, "n/a").otherwise(k.cast("string"))
    failures = [
        F.when(k % 7 == 0, "no address"),
        F.when(F.col("o_orderstatus") == "P", "timeout"),
        F.lit(None).cast("string"),
        F.when(F.expr("try_cast(number AS BIGINT)").isNull(), "not a number"),
        F.lit(None).cast("string"),
    ]
    orders = table(spark, d, "orders").select(k, "o_orderstatus", number.alias("number"))
    return programs.run_batch(orders, "o_orderkey", list(zip(STAGES, failures)))


@query("batch_transitions", BATCH_SQL)
def batch_transitions(spark, d):
    return batch(spark, d).groupBy("step", "stage", "status", "reason").agg(F.count("*").alias("n"))


@query("batch_outcomes", """SELECT o_orderkey, CASE WHEN bad IS NULL THEN 'write' ELSE bad END AS stage, CASE WHEN bad IS NULL THEN 'completed' ELSE 'failed' END AS status
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'discover' WHEN o_orderstatus = 'P' THEN 'crawl' WHEN o_orderkey % 5 = 0 THEN 'extract' END AS bad FROM orders)""")
def batch_outcomes(spark, d):
    return programs.outcomes(batch(spark, d), "o_orderkey").select("o_orderkey", "stage", "status")


FIELDS = ["fees", "target_return", "administrator", "fund_news"]
PASSES_SQL = f"""WITH c AS (SELECT c_custkey AS fund, unnest(range(4)) AS i FROM customer),
f AS (SELECT fund, i, {sql_list(FIELDS)}[i + 1] AS field, CASE (fund + i) % 4 WHEN 0 THEN 'found' WHEN 1 THEN 'not_found' WHEN 2 THEN 'ambiguous' ELSE 'pending' END AS was FROM c)"""


def passes(spark, d):
    """A first pass over the customers, and a second one that finds every third customer's fields."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("fund"), F.posexplode(F.array(*map(F.lit, FIELDS))).alias("i", "field"))
    status = F.get(F.array(*map(F.lit, ["found", "not_found", "ambiguous", "pending"])), ((F.col("fund") + F.col("i")) % 4).cast("int"))
    fast = c.select("fund", "field", status.alias("status"))
    yes, no = F.lit(True), F.lit(False)
    trigger = planning.unanswered_trigger(F.col("field"), F.col("status"), yes, no, no)
    reasons = fast.select("fund", "field", trigger.alias("trigger")).where("trigger is not null")

    def crawl(wanted):
        return wanted.withColumn("status", F.when(F.col("fund") % 3 == 0, "found").otherwise("not_found"))

    return programs.two_pass(fast, reasons, crawl, "fund")


_OPEN = "(was = 'ambiguous' OR was IN ('not_found', 'pending') AND field <> 'fund_news')"


@query("two_pass_recovered", PASSES_SQL + f" SELECT fund, field, was FROM f WHERE {_OPEN} AND fund % 3 = 0")
def two_pass_recovered(spark, d):
    return passes(spark, d)[2]


@query("two_pass_states", PASSES_SQL + f" SELECT fund, field, CASE WHEN NOT {_OPEN} THEN was WHEN fund % 3 = 0 THEN 'found' ELSE 'not_found' END AS status FROM f")
def two_pass_states(spark, d):
    return passes(spark, d)[1]


DOMAINS_SQL = """WITH o AS (SELECT o_custkey AS fund, o_orderkey AS k, 'd' || o_orderkey % 3 || CASE WHEN o_orderkey % 2 = 0 THEN '.cz' ELSE '.eu' END AS domain, o_orderkey * 37 % 101 AS score, o_orderkey % 8 AS rank, substr(o_orderpriority, 1, 1) IN ('1', '2') AS main FROM orders),
c AS (SELECT *, 'https://' || domain || '/' || k AS url, score >= 85 AS good FROM o),
r AS (SELECT * FROM c WHERE main OR fund NOT IN (SELECT fund FROM c WHERE main AND good)),
n AS (SELECT *, row_number() OVER w AS place, lead(score) OVER w AS next, count(*) OVER (PARTITION BY fund, good) AS goods, min(substr(domain, 1, 2)) OVER (PARTITION BY fund, good) = max(substr(domain, 1, 2)) OVER (PARTITION BY fund, good) AS one,
  bool_and(k % 5 < 4 AND NOT good) OVER (PARTITION BY fund) AS failed, bool_or(k % 3 > 0) OVER (PARTITION BY fund) AS searched FROM r WINDOW w AS (PARTITION BY fund ORDER BY good DESC, score DESC, rank, domain, url)),
s AS (SELECT *, CASE WHEN good AND (goods = 1 OR one OR score - next >= 15) THEN 'verified' WHEN good THEN 'review_required' WHEN failed AND searched THEN 'error' WHEN score >= 40 THEN 'review_required' ELSE 'not_found' END AS status FROM n WHERE place = 1)
SELECT c_custkey AS fund, coalesce(status, 'not_found') AS status, CASE WHEN status = 'verified' THEN domain END AS domain, CASE WHEN status = 'verified' THEN url END AS url FROM customer LEFT JOIN s ON fund = c_custkey"""


@query("domain_resolution", DOMAINS_SQL)
def domain_resolution(spark, d):
    k = F.col("o_orderkey")
    domain = F.concat(F.lit("d"), (k % 3).cast("string"), F.when(k % 2 == 0, ".cz").otherwise(".eu"))
    found = table(spark, d, "orders").select(F.col("o_custkey").alias("fund"), k, domain.alias("domain"), (k * 37 % 101).alias("score"), (k % 8).alias("rank"), F.substring("o_orderpriority", 1, 1).isin("1", "2").alias("main"))
    accepted = F.col("score") >= 85
    error = F.when((k % 5 < 4) & ~accepted, "timeout")
    found = found.select("fund", "domain", F.concat(F.lit("https://"), "domain", F.lit("/"), k.cast("string")).alias("url"), "score", "rank", accepted.alias("accepted"), error.alias("error"), (k % 3 == 0).alias("guessed"), "main")
    funds = table(spark, d, "customer").select(F.col("c_custkey").alias("fund"))
    return programs.resolve_domains(funds, found.where("main").drop("main"), found.where("not main").drop("main"), "fund")
