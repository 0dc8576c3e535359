"""Numbers, money, percentages and dates read from text that the query writes out of the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classify, values
from ..operators import lines
from ..queries import query, table


@query("parse_number_forms", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS plain, l_extendedprice AS czech, l_extendedprice AS english, l_quantity AS short FROM lineitem")
def parse_number_forms(spark, d):
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    whole, rest = (cents / 100).cast("long"), F.lpad((cents % 100).cast("string"), 2, "0")
    grouped = F.regexp_replace(F.format_number(whole, 0), ",", " ")
    li = table(spark, d, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        values.number(F.concat(whole.cast("string"), F.lit("."), rest)).alias("plain"),
        values.number(F.concat(grouped, F.lit(","), rest)).alias("czech"),
        values.number(F.concat(F.format_number(whole, 0), F.lit("."), rest)).alias("english"),
        values.number(F.col("l_quantity").cast("int").cast("string")).alias("short"),
    )


@query("money_amounts", "SELECT o_orderkey, (o_orderkey % 900 + 1)::DOUBLE * CASE o_orderkey % 4 WHEN 0 THEN 1e3 WHEN 1 THEN 1e6 WHEN 2 THEN 1e9 ELSE 1 END AS amount, CASE o_orderkey % 3 WHEN 0 THEN 'CZK' WHEN 1 THEN 'EUR' ELSE 'CZK' END AS currency FROM orders")
def money_amounts(spark, d):
    unit = F.get(F.array(*map(F.lit, [" tis.", " mil.", " mld.", ""])), F.pmod("o_orderkey", F.lit(4)).cast("int"))
    cur = F.get(F.array(*map(F.lit, [" kc", " eur", " czk"])), F.pmod("o_orderkey", F.lit(3)).cast("int"))
    written = F.concat(F.lit("fondovy kapital k 31. 12. 2023 cinil "), (F.col("o_orderkey") % 900 + 1).cast("string"), unit, cur, F.lit(" celkem"))
    m = values.money(written)
    return table(spark, d, "orders").select("o_orderkey", m["amount"].alias("amount"), m["currency"].alias("currency"))


@query("money_after_label", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE (o_orderkey % 700 + 1) * 1e6 END AS amount FROM orders")
def money_after_label(spark, d):
    lead = F.when(F.col("o_orderkey") % 5 == 0, F.lit("dan 15 mil. kc, neinvesticni fondovy kapital: ")).otherwise(F.lit("dan 15 mil. kc. fondovy kapital: "))
    written = F.concat(lead, (F.col("o_orderkey") % 700 + 1).cast("string"), F.lit(" mil. kc"))
    return table(spark, d, "orders").select("o_orderkey", values.money_after(written, classify.CAPITAL_METRICS["fund_capital"])["amount"].alias("amount"))


@query("currency_codes", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'CZK' WHEN 1 THEN 'CZK' WHEN 2 THEN 'EUR' END AS currency FROM orders")
def currency_codes(spark, d):
    raw = F.get(F.array(*map(F.lit, ["Kč", " czk ", "EUR", "jpy"])), F.pmod("o_orderkey", F.lit(4)).cast("int"))
    return table(spark, d, "orders").select("o_orderkey", values.currency(raw).alias("currency"))


@query("percent_pairs", "SELECT o_orderkey, 2020 + (o_orderkey % 4) AS year, (o_orderkey % 90) / 10.0::DOUBLE AS rate FROM orders UNION ALL SELECT o_orderkey, 2021 + (o_orderkey % 4), -1.5::DOUBLE FROM orders")
def percent_pairs(spark, d):
    year = F.lit(2020) + F.col("o_orderkey") % 4
    rate = F.format_number((F.col("o_orderkey") % 90) / 10, 1)
    line = F.concat(F.lit("vykonnost "), year.cast("string"), F.lit(": "), F.replace(rate, F.lit("."), F.lit(",")), F.lit(" %, "), (year + 1).cast("string"), F.lit(": -1,5 %"))
    got = table(spark, d, "orders").select("o_orderkey", F.explode(lines.years_and_rates(line)).alias("p"))
    return got.select("o_orderkey", F.col("p.year").cast("long").alias("year"), F.col("p.rate").alias("rate"))


@query("signed_percentages", "SELECT o_orderkey, 2::BIGINT AS n, CASE WHEN o_orderkey % 60 = 0 THEN 0.0 ELSE -((o_orderkey % 60) / 10.0) END::DOUBLE AS lowest FROM orders")
def signed_percentages(spark, d):
    rate = F.replace(F.format_number((F.col("o_orderkey") % 60) / 10, 1), F.lit("."), F.lit(","))
    p = values.signed_percentages(F.concat(F.lit("pokles −"), rate, F.lit(" % a 2,5 %, ne 950 %")))
    return table(spark, d, "orders").select("o_orderkey", F.size(p).cast("long").alias("n"), (F.array_min(p) + 0.0).alias("lowest"))


@query("leading_percent", "SELECT n_nationkey, n_nationkey + 0.5::DOUBLE AS percent, NULL::DOUBLE AS none FROM nation")
def leading_percent(spark, d):
    cell = F.concat("n_nationkey", F.lit(",5 % při odkupu do 3 let"))
    return table(spark, d, "nation").select("n_nationkey", values.leading_percentage(cell).alias("percent"), values.leading_percentage(F.concat(F.lit("max. "), cell)).alias("none"))


@query("cell_numbers", "SELECT n_nationkey, -(n_nationkey * 1000 + 5)::DOUBLE AS value, 'Kč' AS unit FROM nation")
def cell_numbers(spark, d):
    cell = F.concat(F.lit("− "), F.regexp_replace(F.format_number(F.col("n_nationkey") * 1000 + 5, 0), ",", " "), F.lit(" Kč"))
    n = values.whole_cell_number(cell)
    return table(spark, d, "nation").select("n_nationkey", n["value"].alias("value"), n["unit"].alias("unit"))


@query("quote_supports_number", "SELECT o_orderkey, true AS exact, true AS scaled, o_orderkey % 97 = 0 AS wrong FROM orders")
def quote_supports_number(spark, d):
    v = (F.col("o_orderkey") % 97).cast("double")
    quote = F.concat(F.lit("cinil "), (F.col("o_orderkey") % 97).cast("string"), F.lit(" mil."))
    return table(spark, d, "orders").select("o_orderkey", values.supports(quote, v).alias("exact"), values.supports(quote, v * 1e6).alias("scaled"), values.supports(quote, v * 1.07).alias("wrong"))


@query("date_extract", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE (DATE '2021-01-01' + (o_orderkey % 1000)::INT) END AS date FROM orders")
def date_extract(spark, d):
    day = F.date_add(F.lit("2021-01-01").cast("date"), (F.col("o_orderkey") % 1000).cast("int"))
    names = F.array(*map(F.lit, ["ledna", "unora", "brezna", "dubna", "kvetna", "cervna", "cervence", "srpna", "zari", "rijna", "listopadu", "prosince"]))
    forms = F.array(
        F.concat(F.lit("ke dni "), F.date_format(day, "yyyy-MM-dd")),
        F.concat(F.lit("ke dni "), F.date_format(day, "d. M. yyyy")),
        F.concat(F.lit("ke dni "), F.dayofmonth(day), F.lit(". "), F.get(names, F.month(day) - 1), F.lit(" "), F.year(day)),
        F.lit("ke dni 31. 2. 2023, vydano 2023-13-01 a 1. 1. 2024"),
    )
    return table(spark, d, "orders").select("o_orderkey", values.first_date(F.get(forms, F.pmod("o_orderkey", F.lit(4)).cast("int"))).alias("date"))


@query("document_dates", "SELECT o_orderkey, 'as_of' AS kind, DATE '2024-08-31' AS value, DATE '2024-09-10' AS published FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, 'reporting_period_end', DATE '2024-12-31', NULL FROM orders WHERE o_orderkey % 2 = 1")
def document_dates(spark, d):
    written = F.when(F.col("o_orderkey") % 2 == 0, "udaje k 31. 8. 2024. vyhotoveno dne 10. 9. 2024.").otherwise("za obdobi od 1.1.2024 do 31.12.2024")
    o = table(spark, d, "orders").select("o_orderkey", values.document_dates(written, F.lit("https://a.cz/vz.pdf")).alias("x")).withColumn("i", values.information_date(F.col("x")))
    return o.select("o_orderkey", "i.kind", "i.value", F.col("x.published").alias("published"))


@query("money_keys", "SELECT l_returnflag, count(DISTINCT round(l_extendedprice * 3, 2)) AS n FROM lineitem GROUP BY l_returnflag")
def money_keys(spark, d):
    k = values.money_key(F.col("l_extendedprice") * 3, F.lit("czk"))
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.countDistinct(k).alias("n"))


@query("confidence_levels", "SELECT CASE WHEN p_size * 4 >= 145 THEN 'high' WHEN p_size * 4 >= 105 THEN 'medium' ELSE 'low' END AS confidence, count(*) AS n FROM part GROUP BY 1")
def confidence_levels(spark, d):
    return table(spark, d, "part").groupBy(values.confidence(F.col("p_size") * 4).alias("confidence")).agg(F.count("*").alias("n"))


@query("fee_lines", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 6.0 WHEN 1 THEN 4.0 WHEN 2 THEN 0.0 END AS rate, p_partkey % 4 < 2 AS maximum, CASE WHEN p_partkey % 4 = 3 THEN 500.0 END AS amount FROM part")
def fee_lines(spark, d):
    forms = F.array(*map(F.lit, ["vstupni poplatek od 0 % do 6 % z investice", "vstupni poplatek max. 4 %", "vystupni poplatek zdarma", "poplatek 500 kc"]))
    f = values.fee(F.get(forms, F.pmod("p_partkey", F.lit(4)).cast("int")))
    return table(spark, d, "part").select("p_partkey", f["rate"].alias("rate"), f["maximum"].alias("maximum"), f["amount"].alias("amount"))


@query("fee_tiers", "SELECT p_partkey, a AS from_month, b AS to_month, r AS rate FROM part, (VALUES (0, 12, 10.0::DOUBLE), (12, 24, 5.0), (24, NULL, 0.0)) t(a, b, r) WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, a, b, r FROM part, (VALUES (0, 36, 5.0::DOUBLE), (36, NULL, 0.0)) t(a, b, r) WHERE p_partkey % 2 = 1")
def fee_tiers(spark, d):
    line = F.when(F.col("p_partkey") % 2 == 0, "do 1 roku - 10 %, od 1 do 2 let - 5 %, po 2 letech 0 %").otherwise("vystupni poplatek 0 % po 3 letech, 5 % do 3 let")
    return table(spark, d, "part").select("p_partkey", F.explode(values.fee_tiers(line)).alias("t")).select("p_partkey", "t.*")


@query("classified_wordings", """SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN 'fund_capital' WHEN 1 THEN 'registered_capital' WHEN 2 THEN 'net_assets' END AS metric, CASE n_nationkey % 4 WHEN 3 THEN 'calendar_year' END AS series,
  CASE n_nationkey % 4 WHEN 3 THEN 'annual' END AS frequency, CASE n_nationkey % 4 WHEN 1 THEN 'minimum' ELSE 'exact' END AS horizon FROM nation""")
def classified_wordings(spark, d):
    forms = F.array(*map(F.lit, ["zapisovany zakladni kapital a fondovy kapital", "minimalne 5 let, zakladni kapital", "cista aktiva fondu", "rocni vykonnost fondu"]))
    x = F.get(forms, F.pmod("n_nationkey", F.lit(4)).cast("int"))
    return table(spark, d, "nation").select("n_nationkey", classify.capital_metric(x).alias("metric"), classify.first_match(x, classify.RETURN_SERIES).alias("series"), classify.first_match(x, classify.FREQUENCIES).alias("frequency"), classify.horizon_kind(x).alias("horizon"))
