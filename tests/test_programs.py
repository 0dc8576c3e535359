"""Audits of evidence and programs over runs: accepted and rejected cases, nulls and ties."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tessera.operators import resolve
from tessera.plans import programs, sources_audit

FAR = "value_far_from_fee_label"
SHARE = "percentage_describes_income_share"
MAXIMUM = "maximum_flag_contradicts_source"
ABSENT = "value_not_present_in_evidence"


@pytest.mark.parametrize(
    ("rate", "basis", "maximum", "codes"),
    [
        (2.5, "Vstupní poplatek 2,5 %", None, []),
        (2.5, "Vstupní poplatek 2,50 %", None, []),  # another spelling of the number
        (3.0, "Vstupní poplatek 2,5 %", None, [ABSENT]),
        (3.0, "Poplatek max. dle sazebníku", None, [ABSENT]),  # nothing else is tried
        (95.0, "Výstupní poplatek 95 % z hodnoty", None, []),
        (100.0, "Vstupní poplatek je příjmem společnosti a činí 100 %", None, [SHARE]),
        (100.0, "Výstupní poplatek (srážka) je 100 % příjmem do fondu", None, [SHARE]),
        (20.0, "Výkonnostní odměna činí 20 % z výnosu a je příjmem fondu", None, []),  # the recipient comes later
        (20.0, "náleží fondu: 20 %", None, [SHARE]),  # no label at all
        (20.0, "20 % náleží fondu", None, []),
        (4.0, "vstupní poplatek " + "x" * 60 + " 4 %", None, [FAR]),
        (4.0, "vstupní poplatek " + "x" * 40 + " 4 %", None, []),
        (4.0, "vstupní poplatek " + "x" * 60 + " od 0 % do 4 %", None, []),  # the end of a range may stand apart
        (4.0, "4 % z investice", None, []),
        (4.0, "Poplatek nejvýše 4 %", None, [MAXIMUM]),
        (4.0, "Poplatek nejvýše 4 %", False, [MAXIMUM]),
        (4.0, "Poplatek nejvýše 4 %", True, []),
        (0.0, "Poplatek 0 %", None, []),
        (None, "Poplatek 4 %", None, []),
        (4.0, None, None, []),
        (4.0, "", None, [ABSENT]),
    ],
)
def test_fee_evidence(spark, rate, basis, maximum, codes):
    df = spark.createDataFrame([(1, rate, basis, maximum)], "k int, rate double, basis string, maximum boolean")
    assert sorted(r.code for r in sources_audit.fee_findings(df, ["k"]).collect()) == sorted(codes)


def test_plain_number(spark):
    df = spark.createDataFrame([(100.0,), (0.0,), (2.5,), (0.0625,), (10.0,)], "x double")
    assert [r[0] for r in df.select(sources_audit.plain_number(F.col("x"))).collect()] == ["100", "0", "2.5", "0.0625", "10"]


def test_source_evidence(spark):
    manager, third = "manager_or_administrator", "third_party"
    rows = [
        (1, "Fond Modrá vlna", "https://m.cz/modr%C3%A1-vlna.pdf", manager),
        (2, "Fond Modrá vlna", "https://m.cz/katalog", manager),
        (3, "Fond Zelený les", "https://m.cz/katalog", "official_website"),
        (4, "Fond Zelený les", "https://db.cz/x", third),
        (5, "Fond Zelený les", "https://db.cz/x", third),  # one name twice isn't two
        (6, "Fond Zelený les", "", third),
        (7, "Fond Zelený les", None, third),
        (8, None, "https://m.cz/bez", manager),
        (9, "Fond", "https://m.cz/%zz", manager),  # no distinctive word, a broken escape
    ]
    values = spark.createDataFrame(rows, "k int, name string, url string, source string")
    got = {(r.k, r.code, r.other_names) for r in sources_audit.source_evidence(values, ["k"], "name", "url", "source").collect()}
    assert got == {
        (2, "source_shared_across_funds", 1),
        (2, "source_does_not_name_the_fund", 0),
        (3, "source_shared_across_funds", 1),
        (4, "third_party_source", 0),
        (5, "third_party_source", 0),
    }


def claim(k, statement, v, authority, source_id, rebuilt=False):
    return (k, statement, v, rebuilt, authority, 0, 0, 2, 0, source_id, "unknown", None)


def test_only_the_leaders_statement_is_contested(spark):
    schema = "k int, statement string, v int, rebuilt boolean, authority int, scope int, priority int, evidence int, score int, source_id int, date_kind string, date_value date"
    rows = [
        claim(1, "nav", 10, 4, 1), claim(1, "nav", 11, 3, 2), claim(1, "equity", 99, 3, 3),  # equity is another statement
        claim(2, "nav", 10, 4, 1), claim(2, "nav", 11, 4, 2), claim(2, "equity", 9, 1, 3),  # a tie stays open
        claim(3, None, 7, 4, 1), claim(3, None, 8, 2, 2), claim(3, "nav", 9, 3, 3),  # an unnamed statement is one too
        claim(None, "nav", 5, 1, 1),
    ]
    got = resolve.contest_leading(spark.createDataFrame(rows, schema), ["k"], ["statement"], ["v"])
    assert {(r.k, r.statement, r.v, r.outcome, r.n_claims) for r in got.collect()} == {
        (1, "nav", 10, "auto_resolved", 2),
        (2, "nav", None, "unresolved", 2),
        (3, None, 7, "auto_resolved", 2),
        (None, "nav", 5, "equivalent_after_normalization", 1),
    }


def test_batch_isolates_failures(spark):
    funds = spark.createDataFrame([(1, "5"), (2, "x"), (3, None)], "k int, n string")
    stages = [("read", F.when(F.col("n").isNull(), "empty")), ("parse", F.when(F.expr("try_cast(n AS INT)").isNull(), "not a number")), ("write", F.lit(None).cast("string"))]
    steps = programs.run_batch(funds, "k", stages)
    got = {(r.k, r.step, r.stage, r.status, r.reason) for r in steps.collect()}
    assert got == {
        (1, 0, "read", "completed", None), (1, 1, "parse", "completed", None), (1, 2, "write", "completed", None),
        (2, 0, "read", "completed", None), (2, 1, "parse", "failed", "not a number"),
        (3, 0, "read", "failed", "empty"),
    }
    assert {(r.k, r.stage, r.status) for r in programs.outcomes(steps, "k").collect()} == {(1, "write", "completed"), (2, "parse", "failed"), (3, "read", "failed")}
    assert programs.run_batch(funds.limit(0), "k", stages).count() == 0


def test_second_pass_is_limited_and_never_loses_states(spark):
    fast = spark.createDataFrame([(1, "fees", "not_found"), (1, "manager", "found"), (2, "fees", "pending"), (2, "target_return", "pending")], "fund int, field string, status string")
    reasons = spark.createDataFrame([(1, "fees", "t"), (2, "fees", "t"), (2, "target_return", "t"), (9, "fees", "t")], "fund int, field string, trigger string")
    tried = []

    def crawl(wanted):
        tried.extend(sorted(tuple(r) for r in wanted.collect()))
        return wanted.withColumn("status", F.lit("found"))

    plan, after, recovered = programs.two_pass(fast, reasons, crawl, "fund", most=1)
    assert tried == [(2, "fees"), (2, "target_return")] and [r.fund for r in plan.collect()] == [2]
    assert {tuple(r) for r in after.collect()} == {(1, "fees", "not_found"), (1, "manager", "found"), (2, "fees", "found"), (2, "target_return", "found")}
    assert {tuple(r) for r in recovered.collect()} == {(2, "fees", "pending"), (2, "target_return", "pending")}


def test_domains(spark):
    schema = "fund int, domain string, url string, score int, rank int, accepted boolean, error string, guessed boolean"
    row = lambda fund, domain, score, good=False, error=None, guessed=False: (fund, domain, f"https://{domain}", score, 1, good, error, guessed)
    primary = [
        row(1, "a.cz", 80, True), row(1, "b.cz", 50),
        row(2, "a.cz", 70, True), row(2, "a.eu", 69, True),  # one brand
        row(3, "a.cz", 90, True), row(3, "b.cz", 75, True),  # a clear lead
        row(4, "a.cz", 80, True), row(4, "b.cz", 75, True),
        row(5, "a.cz", 0, error="timeout"), row(5, "b.cz", 0, error="dns", guessed=True),
        row(6, "a.cz", 0, error="dns", guessed=True),  # a guess that doesn't exist is no failure
        row(7, "a.cz", 45),
        row(8, "a.cz", 39),
        row(10, "a.cz", 10),
    ]
    adapters = [row(1, "c.cz", 99, True), row(10, "a.cz", 99, True), row(8, "c.cz", 61, True)]
    funds = spark.createDataFrame([(i,) for i in range(1, 11)], "fund int")
    got = programs.resolve_domains(funds, spark.createDataFrame(primary, schema), spark.createDataFrame(adapters, schema), "fund")
    assert {r.fund: (r.status, r.domain) for r in got.collect()} == {
        1: ("verified", "a.cz"), 2: ("verified", "a.cz"), 3: ("verified", "a.cz"), 4: ("review_required", None),
        5: ("error", None), 6: ("not_found", None), 7: ("review_required", None), 8: ("verified", "c.cz"),
        9: ("not_found", None), 10: ("not_found", None),
    }
