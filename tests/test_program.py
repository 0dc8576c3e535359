"""The program over all fields: its reading against plain Python, and its results on worked documents."""

from __future__ import annotations

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from tessera.functions.classify import HISTORICAL_VALUES, RETURN_SERIES
from tessera.plans import program

PAGES = "fund int, fund_name string, source_id int, document_type string, page int, title string, text string"


def fold(t):
    return " ".join("".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)).lower().replace("ß", "ss").split())


def test_reading_finds_what_plain_search_finds(spark):
    r = random.Random(3)
    bits = [w for own in program.WORDS.values() for w in own]
    texts = []
    for _ in range(40):
        parts = []
        for _ in range(r.randint(0, 30)):
            line = " ".join(r.choice([r.choice(bits), "slovo", "a", "12 %", "Žluť", "31. 12. 2024"]) for _ in range(r.randint(0, 4)))
            cut = r.randint(0, len(line))
            parts.append(line[:cut].rstrip() + "\n" + line[cut:].lstrip() if r.random() < 0.2 else line)
        texts.append("\n".join(parts))
    df = spark.createDataFrame([(k, "Alfa", k, "statute", 1, "", t) for k, t in enumerate(texts)], PAGES)
    got = {(x.fund, x.line_no): x for x in program.lines_worth_reading(df, memory=3).collect()}
    seen = set()
    for k, t in enumerate(texts):
        lines = [x.strip() for x in t.split("\n") if x.strip()]
        flat = [fold(x) for x in lines]
        heads = {}
        for name, table in (("return", RETURN_SERIES), ("value", HISTORICAL_VALUES)):
            own = [next((j for j, words in enumerate(table.values()) if any(w in x for w in words)), -1) for x in flat]
            heads[name] = [next((own[j] for j in range(i, max(-1, i - 4), -1) if own[j] >= 0), -1) for i in range(len(flat))]
        for i, x in enumerate(flat):
            near = " ".join(flat[max(0, i - 1) : i + 2])
            mask = sum(1 << b for b, f in enumerate(program.FIELDS) if any(w in near for w in program.WORDS[f]))
            own = sum(1 << b for b, f in enumerate(program.FIELDS) if any(w in x for w in program.WORDS[f]))
            under = max(heads["return"][i], heads["value"][i]) >= 0 and any(c.isdigit() for c in x)
            if mask or under:
                row = got[k, i]
                seen.add((k, i))
                assert (row.line, row.folded, row.near, row.near_bits, row.line_bits) == (lines[i], x, near, mask, own)
                assert (row.return_heading, row.value_heading) == (heads["return"][i], heads["value"][i])
    assert seen == set(got)


GAP = "\nostatní ustanovení\nplatí beze změny\n"


def run(spark, docs, newest=2026):
    """{(fund, field): (status, {point: (low, high, word, outcome)})} of docs (fund, source_id, type, text)."""
    pages = spark.createDataFrame([(f, f"Alfa{f} SICAV", s, kind, 1, f"Alfa{f}", t) for f, s, kind, t in docs], PAGES)
    states, values = program.all_fields(pages, spark.createDataFrame([(f,) for f in sorted({d[0] for d in docs})], "fund int"), newest)
    points = {}
    for v in values.collect():
        points.setdefault((v.fund, v.field), {})[v.point] = (v.low, v.high, v.word, v.outcome)
    return {(s.fund, s.field): (s.status, points.get((s.fund, s.field), {})) for s in states.collect()}


def test_worked_documents(spark):
    same = "equivalent_after_normalization"
    docs = [
        # one document with every field
        (1, 1, "memorandum", GAP.join(["Investiční horizont je 5 let", "Minimální investice: 1 000 000 Kč", "Cílový výnos 8 % p.a.", "Vstupní poplatek max. 3 %", "Poplatek za obhospodařování 1,5 %",
                                       "Fondový kapitál k 31. 12. 2025: 2,5 mld. Kč", "Obhospodařovatel: Modrá investiční společnost, a.s., IČO: 12345678", "Výkonnost v jednotlivých letech\n2023: 4,1 %, 2024: 6,5 %"])),
        # negations: a share's price, past results, a scenario, a benchmark, a falling range
        (2, 2, "statute", GAP.join(["Minimální investice, hodnota investiční akcie 1,1138 Kč", "Cílový výnos, minulá výkonnost 9 %", "Stresový scénář: očekávaný výnos 3 %", "Cílový výnos PRIBOR + 2 %", "Cílový výnos 8 až 4 %"])),
        # nothing is published
        (3, 3, "statute", "Fond neuvádí cílový výnos"),
        # equals of equal documents, and a better document
        (4, 4, "statute", "Investiční horizont je 5 let"), (4, 5, "statute", "Investiční horizont činí 7 let"),
        (5, 6, "statute", "Investiční horizont je 5 let"), (5, 7, "priips_kid", "Recommended holding period: 3 years"),
        # another fund's section, and a hurdle before one value
        (6, 8, "statute", "Beta SICAV" + GAP + "Investiční horizont 9 let"), (7, 9, "memorandum", "Cílový výnos 7 %, hurdle rate 5 %"),
        # a range, a legal threshold
        (8, 10, "memorandum", "Očekávaný výnos 4 - 6 % ročně" + GAP + "Minimální investice podle zákona 125 000 EUR"),
        (9, 11, "statute", None), (10, 12, "statute", ""),
    ]
    got = run(spark, docs)
    assert got[1, "investment_horizon"] == ("found", {"": (5.0, None, "exact", same)})
    assert got[1, "minimum_investment"] == ("found", {"initial_subscription|": (1e6, None, "CZK", same)})
    assert got[1, "target_return"] == ("found", {"target|": (8.0, None, "per_annum", same)})
    assert got[1, "fees"] == ("found", {"entry": (3.0, None, None, same), "management": (1.5, None, None, same)})
    assert got[1, "assets_under_management"] == ("found", {"fund_capital|CZK|2025-12-31": (2.5e9, None, "CZK", same)})
    assert got[1, "manager"] == ("found", {"": (None, None, "modrainvesticnispolecnostas", same)})
    assert got[1, "annual_returns"] == ("found", {"2023|calendar_year|": (4.1, None, None, same), "2024|calendar_year|": (6.5, None, None, same)})
    assert got[1, "administrator"] == ("not_found", {})
    for field in ("minimum_investment", "target_return"):
        assert got[2, field] == ("not_found", {}), field
    assert got[3, "target_return"] == ("not_publicly_disclosed", {})
    assert got[4, "investment_horizon"] == ("conflicting", {"": (None, None, None, "unresolved")})
    assert got[5, "investment_horizon"] == ("found", {"": (3.0, None, "exact", "auto_resolved")})
    assert got[6, "investment_horizon"] == ("scope_unconfirmed", {})
    assert got[7, "target_return"][1] == {"hurdle|": (5.0, None, "unknown", same)}
    assert got[8, "target_return"][1] == {"expected|": (4.0, 6.0, "per_annum", same)}
    assert got[8, "minimum_investment"][1] == {"legal_threshold|": (125000.0, None, "EUR", same)}
    assert {got[f, x][0] for f in (9, 10) for x in program.FIELDS} == {"not_found"}


def test_values_name_their_evidence(spark):
    pages = spark.createDataFrame([(1, "Alfa SICAV", 5, "statute", 3, "Alfa", "Úvod\nInvestiční horizont je 5 let"), (1, "Alfa SICAV", 4, "statute", 2, "Alfa", "Investiční\nhorizont 5 let")], PAGES)
    _, values = program.all_fields(pages.withColumn("page_scope_note", F.lit("kept")), spark.createDataFrame([(1,)], "fund int"), 2026)
    v = values.first()
    assert (v.source_id, v.page, v.n_values, v.n_claims > 2) == (4, 2, 1, True) and "horizont 5 let" in v.quote


def test_no_pages(spark):
    states, values = program.all_fields(spark.createDataFrame([], PAGES), spark.createDataFrame([(1,)], "fund int"), 2026)
    assert {s.status for s in states.collect()} == {"not_found"} and values.collect() == []


@pytest.mark.parametrize("named, title, start, want", [([], False, 5, "unknown"), ([], True, 5, "exact_fund"), ([(0, True)], False, 5, "exact_fund"), ([(0, True), (3, False)], True, 5, "another_fund"), ([(9, False)], True, 5, "multi_fund")])
def test_scope_of_a_place(named, title, start, want):
    assert program.scope_at(start, named, title) == want
