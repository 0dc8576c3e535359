"""Classification, link rules, catalogue matches, news and capital rules against plain Python and representative cases."""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from tessera.functions import classify, labels
from tessera.operators import fuzzy, graph
from tessera.plans import rules


def one(spark, column, **given):
    return spark.createDataFrame([tuple(given.values())], ", ".join(f"{k} string" for k in given)).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("title", "body", "kind", "ambiguous"),
    [
        ("sdeleni klicovych informaci", "", "priips_kid", False),
        ("statut podfondu", "statut fondu", "subfund_statute", False),  # a refinement is no second opinion
        ("statut fondu", "", "statute", False),
        ("vyrocni zprava", "ucetni zaverka rozvaha", "annual_report", False),
        ("pololetni zprava", "vyrocni zprava", "half_year_report", False),
        ("cenik a prospekt", "", "prospectus", True),  # as many points: the first listed, and ambiguous
        ("", "memorandum", "other", False),  # a weak word of the body is too little
        ("", "obchodni rejstrik", "other", False),
        ("vypis, obchodni rejstrik", "", "register", False),
        (None, None, "other", False),
    ],
)
def test_document_types(spark, title, body, kind, ambiguous):
    signals = {"document_title": F.col("t"), "body_text": F.col("b")}
    assert one(spark, classify.document_type(signals), t=title, b=body) == kind
    assert one(spark, classify.vote(signals)["ambiguous"], t=title, b=body) is ambiguous


@pytest.mark.parametrize(
    ("href", "anchor", "want"),
    [
        ("https://a.cz/statut.pdf", "Statut fondu", ("statute", 95 + 5 + 30 + 5)),
        ("https://www.a.cz/x", "Výroční zpráva", ("annual_report", 85)),
        ("https://b.cz/x", "dokumenty", ("other", 55)),
        ("https://b.cz/kontakt", "dokumenty", None),
        ("https://a.cz/file.pdf", "more", ("other", 35)),
        ("https://a.cz/file.pdf.html", "more", None),
    ],
)
def test_link_kinds(spark, href, anchor, want):
    got = one(spark, graph.classified_link(F.col("h"), F.col("a"), F.lit("https://a.cz/")), h=href, a=anchor)
    assert (tuple(got)[:2] if got else None) == want


def plain_score(own, theirs, p):
    a, b = own.split(), theirs.split()
    if p.equal and own == theirs:
        return 1.0
    common = len(set(a) & set(b))
    if not common or common / len(a) < fuzzy.COVER or p.prefix and len(a) == 1 and not theirs.startswith(a[0]):
        return 0.0
    total = p.cover * common / len(a) + p.back * common / len(b) + p.ratio * SequenceMatcher(None, own, theirs, autojunk=False).ratio()
    total += p.inside * (own in theirs) + p.held * (common == len(a)) + p.holds * (common == len(b))
    return min(1.0, total)


@pytest.mark.parametrize("profile", [fuzzy.AMISTA, fuzzy.BHS, fuzzy.POROVNEJFONDY])
def test_catalogue_matches(spark, profile):
    names = ["Modrá vlna", "Vlna", "Zelený les a dům", "Les", "Rudá hora nad řekou", "Nic takového", "Fond", "7 12"]
    entries = ["Modrá vlna fond SICAV", "Vlna modrá", "Nová vlna", "Vlnařství", "Zelený les dům park", "Dům Zelený les", "Rudá hora", "Hora rudá nad řekou", "les zelený", "Lesní"]
    key = lambda x: " ".join(dict.fromkeys(w for w in re.findall("[a-z0-9]+", fold(x)) if len(w) > 1 and not w.isdigit() and w not in labels.CATALOGUE_GENERIC))
    fold = lambda x: "".join(c for c in __import__("unicodedata").normalize("NFKD", x.lower()) if not __import__("unicodedata").combining(c))
    want = {}
    for n in names:
        own = key(n)
        found = [(round(s, 6), e) for e in entries if own and (s := plain_score(own, key(e), profile)) >= (profile.single if len(own.split()) == 1 else profile.least)]
        if found:
            want[n] = max(found)
    a, b = spark.createDataFrame([(n,) for n in names], "n string"), spark.createDataFrame([(e,) for e in entries], "e string")
    got = {r.n: (r.score, r.e) for r in fuzzy.best_match(a, b, "n", "e", profile=profile).collect()}
    assert got == want and want


def test_wordings(spark):
    assert one(spark, classify.no_published_return("t"), t="fond nestanovuje cilovy vynos") and not one(spark, classify.no_published_return("t"), t="cilovy vynos 8 %")


def test_capital_of_another_company(spark):
    check = lambda quote, amount: one(spark, rules.capital_attribution(F.lit(amount), F.col("q"), F.lit("Modrá vlna SICAV a.s."))["code"], q=quote)
    assert check("vlastní kapitál Trnitá 1 s.r.o. o 119 350 mil. Kč", 119_350e6) == "capital_of_another_company"
    assert check("Trnitá 1 s.r.o., kapitál fondu 119 350 mil. Kč", 119_350e6) is None  # a word for the fund stands closer
    assert check("Trnitá 1 s.r.o. a Modrá vlna a.s. 119 350 mil. Kč", 119_350e6) is None
    assert check("119 350 mil. Kč, Trnitá 1 s.r.o.", 119_350e6) is None  # the amount stands first
    assert check("Trnitá 1 s.r.o. 5 mil. Kč", 119_350e6) is None
    assert check(None, 1e6) is None


def test_news_of_an_unknown_fund_and_without_web(spark):
    items = spark.createDataFrame([(1, "https://m.cz/a", "Modrá vlna roste", None, False), (1, "https://m.cz/b", "jiný", None, False), (2, "https://m.cz/c", "x", None, True)], "fund int, url string, title string, published_at date, third_party boolean")
    funds = spark.createDataFrame([(1, "Modrá vlna", None), (2, "Fond", "https://f.cz")], "fund int, name string, web string")
    got = sorted(map(tuple, rules.news_items(items, funds, "fund").collect()), key=repr)
    assert got == sorted([(1, "https://m.cz/b", "news_of_another_fund", "reject"), (2, "https://m.cz/c", "news_from_unofficial_source", "review"), (1, None, "news_without_date", "review"), (2, None, "news_without_date", "review")], key=repr)
