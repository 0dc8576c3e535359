"""Extraction programs over documents that the queries write, one for each customer or part."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import resolve
from ..plans import extraction as x
from ..queries import query, table


def memoranda(spark, d):
    """Lines of a memorandum (document type memorandum, page 4) of each customer."""
    k = F.col("c_custkey")
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("Memorandum fondu "), "c_name"),
        F.concat(F.lit("Doporučený investiční horizont je "), (k % 9 + 1).cast("string"), F.lit(" let")),
        F.lit("Ostatní ustanovení"),
        F.concat(F.lit("Minimální investice: "), (k % 5 + 1).cast("string"), F.lit(" mil. Kč")),
        F.lit("Další ustanovení"),
        F.concat(F.lit("Cílový výnos "), (k % 12 + 1).cast("string"), F.lit(",5 % p.a.")),
        F.lit("Poplatky"),
        F.concat(F.lit("Vstupní poplatek max. "), (k % 4 + 1).cast("string"), F.lit(" %")),
        F.lit("Poplatek za obhospodařování 1,5 %"),
        F.lit("Majetek"),
        F.concat(F.lit("Fondový kapitál k 31. 12. 2024: "), (k % 700 + 100).cast("string"), F.lit(" mil. Kč")),
        F.lit("Osoby"),
        F.concat(F.lit("Obhospodařovatel: Modrá investiční společnost, a.s., IČO: "), F.lpad(k.cast("string"), 8, "0")),
        F.lit("Výkonnost v jednotlivých letech"),
        F.concat(F.lit("2023: "), (k % 10).cast("string"), F.lit(",1 %, 2024: 6,5 %")),
        F.lit("Hodnota investiční akcie"),
        F.concat(F.lit("31. 1. 2024 1,"), F.lpad((k % 10000).cast("string"), 4, "0"), F.lit(" Kč")),
    )
    customers = table(spark, d, "customer").select("c_custkey", "c_name").repartition(4 * spark.sparkContext.defaultParallelism, "c_custkey")  # narrow rows, before they become text
    pages = customers.select(k.alias("fund"), k.alias("source_id"), F.lit("memorandum").alias("document_type"), F.lit(4).alias("page"), text.alias("text"))
    return x.lines_of(pages)


@query("extract_horizon", "SELECT c_custkey AS fund, (c_custkey % 9 + 1)::DOUBLE AS years, 150 AS score, 'high' AS confidence, 3::BIGINT AS lines FROM customer")
def extract_horizon(spark, d):
    c = x.horizons(memoranda(spark, d))
    return c.groupBy("fund").agg(F.max("value.years").alias("years"), F.max("score").alias("score"), F.max("confidence").alias("confidence"), F.count("*").alias("lines"))


@query("extract_minimum_investment", "SELECT c_custkey AS fund, (c_custkey % 5 + 1) * 1e6 AS amount, 'CZK' AS currency FROM customer")
def extract_minimum_investment(spark, d):
    return x.minimum_investments(memoranda(spark, d)).groupBy("fund").agg(F.max("value.amount").alias("amount"), F.max("value.currency").alias("currency"))


@query("extract_target_return", "SELECT c_custkey AS fund, c_custkey % 12 + 1.5 AS percent, 'target' AS kind, 'per_annum' AS annualization FROM customer")
def extract_target_return(spark, d):
    return x.target_returns(memoranda(spark, d)).groupBy("fund").agg(F.max("value.exact").alias("percent"), F.max("value.type").alias("kind"), F.max("value.annualization").alias("annualization"))


@query("extract_fees", "SELECT c_custkey AS fund, 'entry' AS kind, (c_custkey % 4 + 1)::DOUBLE AS rate, true AS maximum FROM customer UNION ALL SELECT c_custkey, 'management', 1.5, false FROM customer")
def extract_fees(spark, d):
    return x.fee_schedule(x.fees(memoranda(spark, d))).select("fund", "kind", F.col("value.rate").alias("rate"), F.col("value.maximum").alias("maximum"))


@query("extract_assets", "SELECT c_custkey AS fund, (c_custkey % 700 + 100) * 1e6 AS amount, 'fund_capital' AS metric, DATE '2024-12-31' AS as_of FROM customer")
def extract_assets(spark, d):
    a = x.assets(memoranda(spark, d), 2026)
    return a.groupBy("fund").agg(F.max("value.amount").alias("amount"), F.max("value.metric").alias("metric"), F.max("value.as_of").alias("as_of"))


@query("extract_parties", "SELECT c_custkey AS fund, 'Modrá investiční společnost, a.s.' AS name, lpad(c_custkey::VARCHAR, 8, '0') AS ico FROM customer")
def extract_parties(spark, d):
    return x.parties(memoranda(spark, d), "manager").select("fund", "name", "ico").distinct()


@query("extract_annual_returns", "SELECT c_custkey AS fund, 2023 AS year, 'calendar_year' AS series, (c_custkey % 10 + 0.1)::DOUBLE AS rate FROM customer UNION ALL SELECT c_custkey, 2024, 'calendar_year', 6.5::DOUBLE FROM customer")
def extract_annual_returns(spark, d):
    return x.annual_returns(memoranda(spark, d)).select("fund", "year", "series", "rate")


@query("extract_historical_values", "SELECT c_custkey AS fund, 'investment_share_value' AS kind, DATE '2024-01-31' AS as_of, round(1 + (c_custkey % 10000) / 10000.0, 4)::DOUBLE AS value FROM customer UNION ALL SELECT c_custkey, 'fund_capital', DATE '2024-12-31', (c_custkey % 700 + 100) * 1e6 FROM customer")
def extract_historical_values(spark, d):
    return x.historical_values(memoranda(spark, d)).select("fund", "kind", "as_of", "value")


@query("extract_capital_history", "SELECT c_custkey AS fund, 'fund_capital' AS metric, DATE '2024-12-31' AS as_of, (c_custkey % 700 + 100) * 1e6 AS amount FROM customer")
def extract_capital_history(spark, d):
    return x.capital_history(memoranda(spark, d)).select("fund", "metric", "as_of", "amount")


@query("resolved_fields", "SELECT c_custkey AS fund, 'investment_horizon' AS field, (c_custkey % 9 + 1)::DOUBLE AS value, 'equivalent_after_normalization' AS outcome FROM customer UNION ALL SELECT c_custkey, 'minimum_investment', (c_custkey % 5 + 1) * 1e6, 'equivalent_after_normalization' FROM customer")
def resolved_fields(spark, d):
    m = memoranda(spark, d)
    claims = x.claims(x.horizons(m), F.col("value.years")).unionByName(x.claims(x.minimum_investments(m), F.col("value.amount")))
    return resolve.resolve(claims, ["fund", "field"], ["value"]).select("fund", "field", "value", "outcome")


@query("extract_news", "SELECT fund, url, published_at FROM (SELECT *, row_number() OVER (PARTITION BY fund ORDER BY coalesce(published_at, DATE '0001-01-01') DESC, title DESC, url) n FROM (SELECT o_custkey AS fund, 'https://a.cz/' || year(o_orderdate) || '/' || month(o_orderdate) || '/' || day(o_orderdate) || '/x' AS url, arg_min('Zpráva ' || o_orderkey, o_orderkey) AS title, CASE WHEN year(o_orderdate) >= 2000 THEN o_orderdate::DATE END AS published_at FROM orders GROUP BY o_custkey, 2, o_orderdate)) WHERE n <= 25")
def extract_news(spark, d):
    o = table(spark, d, "orders")
    url = F.concat(F.lit("https://a.cz/"), F.year("o_orderdate"), F.lit("/"), F.month("o_orderdate"), F.lit("/"), F.dayofmonth("o_orderdate"), F.lit("/x"))
    items = o.select(F.col("o_custkey").alias("fund"), F.col("o_orderkey").alias("seq"), url.alias("url"), F.concat(F.lit("Zpráva "), "o_orderkey").alias("title"))
    return x.news(items).select("fund", "url", "published_at")
