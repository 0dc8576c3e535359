"""Text to values, with representative texts."""

from __future__ import annotations

import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import classify, text, values
from tessera.operators import lines
from tessera.plans import extraction as x
from tessera.plans import rules


def one(spark, column, **given):
    df = spark.createDataFrame([tuple(given.values())], list(given)) if given else spark.range(1)
    return df.select(column.alias("v")).first().v


@pytest.mark.parametrize(("raw", "value"), [("1 000 000", 1e6), ("2,5", 2.5), ("1.234,5", 1234.5), ("1,234.5", 1234.5), ("1,234", 1234.0), ("12.345.678", 12345678.0), ("0,125", 125.0), ("3,50", 3.5), ("x", None)])
def test_numbers(spark, raw, value):
    assert one(spark, values.number("t"), t=raw) == value


@pytest.mark.parametrize(("raw", "value"), [("1,888 mld. kc", (1.888e9, "CZK")), ("693 601 745 kc", (693601745.0, "CZK")), ("17 000 tis. kc", (17e6, "CZK")), ("125 000 eur", (125e3, "EUR")), ("12 let", None)])
def test_money(spark, raw, value):
    got = one(spark, values.money("t"), t=raw)
    assert (tuple(got) if got else None) == value


def test_money_after_label(spark):
    labels = classify.CAPITAL_METRICS["fund_capital"]
    t = "z toho neinvesticni fondovy kapital: 100 000 kc z toho investicni fondovy kapital: 672 417 510 kc"
    assert one(spark, values.money_after("t", labels), t=t).amount == 672417510.0
    assert one(spark, values.money_after("t", labels), t="z toho neinvesticni fondovy kapital: 100 000 kc") is None


@pytest.mark.parametrize(("raw", "day"), [("k 31. 12. 2025", "2025-12-31"), ("2024-02-29", "2024-02-29"), ("2023-02-30 a 1. 1. 2024", None), ("15. prosince 2025", "2025-12-15"), ("bez data", None)])
def test_dates(spark, raw, day):
    assert one(spark, values.first_date(text.fold("t")), t=raw) == (datetime.date.fromisoformat(day) if day else None)


@pytest.mark.parametrize(
    ("raw", "kind", "day"),
    [("účinný od 15. 12. 2025", "effective_at", "2025-12-15"), ("Údaje k 31. 8. 2024. Vyhotoveno dne 10. 9. 2024.", "as_of", "2024-08-31"), ("za období od 1.1.2024 do 31.12.2024", "reporting_period_end", "2024-12-31"), ("za rok 2024", "reporting_period_end", "2024-12-31"), ("nic", "unknown", None)],
)
def test_document_dates(spark, raw, kind, day):
    df = spark.createDataFrame([(raw, "https://a.cz/x.pdf")], "t string, u string").withColumn("d", values.document_dates(text.fold("t"), "u"))
    got = df.select(values.information_date(F.col("d")).alias("i")).first().i
    assert (got.kind, got.value and got.value.isoformat()) == (kind, day)


@pytest.mark.parametrize(
    ("raw", "tiers"),
    [("Výstupní poplatek 0 % po 3 letech, 5 % do 3 let", [(0, 36, 5.0), (36, None, 0.0)]), ("do 1 roku - 10 %, od 1 do 2 let - 5 %, po 2 letech 0 %", [(0, 12, 10.0), (12, 24, 5.0), (24, None, 0.0)]), ("vstupní poplatek 3 %", [])],
)
def test_fee_tiers(spark, raw, tiers):
    assert [tuple(r) for r in one(spark, values.fee_tiers(text.fold("t")), t=raw)] == tiers


@pytest.mark.parametrize(("raw", "rate", "top"), [("Vstupní poplatek od 0 % do 6 % z částky", 6.0, True), ("// Vstupní poplatek max. 4 %", 4.0, True), ("poplatek za obhospodařování 1,5 %", 1.5, False), ("vstupní poplatek zdarma", 0.0, False)])
def test_fees(spark, raw, rate, top):
    got = one(spark, values.fee(text.fold("t")), t=raw)
    assert (got.rate, got.maximum) == (rate, top)


@pytest.mark.parametrize(("url", "want"), [("HTTPS://Example.COM:443/Documents/KID.pdf#page=3", "https://example.com/Documents/KID.pdf"), ("http://www.A.cz", "http://www.a.cz/"), ("http://a.cz:8080/x/?Q=1", "http://a.cz:8080/x?Q=1"), ("ftp://a.cz:80/", "ftp://a.cz:80/"), ("/relative#", "/relative")])
def test_canonical_url(spark, url, want):
    assert one(spark, text.canonical_url("u"), u=url) == want
    assert one(spark, text.canonical_url("u"), u=want) == want
    assert one(spark, text.canonical_domain("u"), u=url) == want.split("/")[2].split(":")[0].removeprefix("www.") if "://" in want else True


@given(t=st.text(alphabet=st.characters(max_codepoint=0x24F), max_size=40))
@settings(max_examples=15, deadline=None)
def test_aligned_folding_keeps_places(spark, t):
    got = spark.createDataFrame([(t,)], "t string").select(F.length(text.without_marks("t")).alias("n"), F.length("t").alias("m")).first()
    assert got.n == got.m


def test_names(spark):
    assert one(spark, text.company_key("t"), t="Správce, a. s.") == one(spark, text.company_key("t"), t="SPRAVCE a.s.")
    assert one(spark, text.distinctive_tokens("t"), t="Modrý SICAV a.s. fond Modrý Reality") == ["modry", "reality"]
    assert one(spark, text.share_class("t"), t="Třída PIA: 1,3820 CZK") == "PIA" and one(spark, text.share_class("t"), t="pro třídu A") == "A" and one(spark, text.share_class("t"), t="Fondový kapitál celkem") is None
    assert one(spark, text.registration_number("t"), t="IČO: 123 45 678") == "12345678" and one(spark, text.registration_number("t"), t="1234567") is None
    assert one(spark, text.cut_party_name("t"), t="je 4. 10. 2021 AVANT investiční společnost, a.s.") == "AVANT investiční společnost, a.s."
    assert one(spark, text.name_phrases("t"), t="Modrý reality fond") == ["modry reality", "modry reality fond"]


def test_classifiers(spark):
    c = lambda f, t: one(spark, f("t"), t=t)
    assert c(classify.capital_metric, "zapisovany zakladni kapital 2 mil., fondovy kapital") == "fund_capital"
    assert c(classify.capital_metric, "bez slov") is None
    assert c(classify.aum_metric, "aktiva") == "assets_total" and c(classify.horizon_kind, "min. 3 roky") == "minimum"
    assert one(spark, classify.negated(F.col("t"), F.lit(13)), t="neinvesticni fondovy kapital") and not one(spark, classify.negated(F.col("t"), F.lit(0)), t="fondovy kapital")
    v = one(spark, classify.vote({"document_title": F.col("t"), "body_text": F.lit(None).cast("string")}, classify.DOCUMENT_TYPES), t="factsheet fondu")
    assert (v.kind, v.score, v.ambiguous) == ("factsheet", 30, False)


def test_years_and_rates(spark):
    got = one(spark, lines.years_and_rates(F.col("t")), t="vykonnost 2022: 5,1 %, 2023: 7,7 % a -3 % v roce 2024")
    assert [tuple(r) for r in got] == [(2022, 5.1), (2023, 7.7), (2024, -3.0)]
    assert one(spark, lines.years_and_rates(F.col("t")), t="2022 a az za velmi dlouhou vetou nekde jinde 5 %") == []


MEMORANDUM = """Memorandum fondu
Doporučený investiční horizont je 5 let
Ostatní ustanovení
Minimální investice: 1 000 000 Kč
Jiné
Cílový výnos 8 % p.a.
Jiné
Vstupní poplatek max. 3 %
Poplatek za obhospodařování 1,5 %
Výkonnostní poplatek 20 %
Jiné
Fondový kapitál k 31. 12. 2025: 2,5 mld. Kč
Jiné
Obhospodařovatel: Modrá investiční společnost, a.s., IČO: 12345678
Výkonnost v jednotlivých letech
2023: 7,1 %, 2024: 6,5 %
Hodnota investiční akcie
31. 1. 2024 1,1138 Kč
29. 2. 2024 1,1201 Kč"""


@pytest.fixture(scope="module")
def page_lines(spark):
    pages = spark.createDataFrame([("f1", 1, "memorandum", 4, MEMORANDUM), ("f2", 2, "factsheet", 1, "minimální investice 1,1138 Kč, cena investiční akcie"), ("f3", 3, "factsheet", 1, "")], "fund string, source_id long, document_type string, page int, text string")
    return x.lines_of(pages)


def test_extraction(page_lines):
    h = x.horizons(page_lines).first()
    assert (h.fund, h.value.years, h.score, h.confidence) == ("f1", 5.0, 150, "high")
    m = x.minimum_investments(page_lines).collect()
    assert {(r.fund, r.value.amount, r.value.currency) for r in m} == {("f1", 1e6, "CZK")}
    assert {r.value.exact for r in x.target_returns(page_lines).collect()} == {8.0}
    f = {r.kind: (r.value.rate, r.value.maximum) for r in x.fee_schedule(x.fees(page_lines)).collect()}
    assert f == {"entry": (3.0, True), "management": (1.5, False), "performance": (20.0, False)}
    a = {(r.value.amount, r.value.as_of.isoformat(), r.value.metric) for r in x.assets(page_lines, 2026).collect()}
    assert a == {(2.5e9, "2025-12-31", "fund_capital")}
    p = {(r.name, r.ico) for r in x.parties(page_lines, "manager").collect()}
    assert p == {("Modrá investiční společnost, a.s.", "12345678")}
    assert [(r.metric, r.amount) for r in x.capital_history(page_lines).collect()] == [("fund_capital", 2.5e9)]
    assert sorted((r.year, r.series, r.rate) for r in x.annual_returns(page_lines).collect()) == [(2023, "calendar_year", 7.1), (2024, "calendar_year", 6.5)]
    assert sorted((r.kind, r.as_of.isoformat(), r.value) for r in x.historical_values(page_lines).collect()) == [("fund_capital", "2025-12-31", 2.5e9), ("investment_share_value", "2024-01-31", 1.1138), ("investment_share_value", "2024-02-29", 1.1201)]


def test_rules(spark):
    codes = lambda checks: [f.code for f in one(spark, checks)]
    assert codes(rules.horizon(F.lit(2024.0))) == ["calendar_year_as_horizon"] and codes(rules.horizon(F.lit(5.0))) == []
    assert codes(rules.minimum_investment(F.lit(1_250_000.0), F.lit("EUR"), F.lit("fond musí dosáhnout zisif"))) == ["statutory_capital_as_minimum_investment"]
    assert codes(rules.target_return(F.lit(None).cast("double"), F.lit(9.0), F.lit(3.0))) == ["inverted_target_return_range"]
    assert codes(rules.party(F.lit("2025 investiční společnost"), F.lit("Fond"))) == ["party_name_opens_with_date"]
    assert codes(rules.provenance(F.lit("https://a.cz/x.pdf"), F.lit("cinil 5 mil."), F.lit(7e6), F.lit(None).cast("int"))) == ["number_not_in_quote", "missing_page"]
    assert codes(rules.rebuilt_text(F.lit(True), F.lit("high"), F.lit(False), F.lit(True))) == ["fallback_confidence_too_high", "fallback_without_review"]
    assert codes(rules.horizon_wording(F.lit("exact"), F.lit("min. 3 roky"))) == ["horizon_bound_lost"]
