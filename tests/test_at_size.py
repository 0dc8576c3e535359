"""What keeps queries in proportion to their tables: work done once, dealt to all tasks."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from tessera.catalog import extraction as memoranda
from tessera.catalog import program as program_documents
from tessera.functions.text import fold, without_figures
from tessera.operators import lines, mentions
from tessera.plans import extraction as x
from tessera.plans import program

PAGE = "Žluťoučký\tkůň \x0b ß\n \n\t\n Σίσυφος ΟΔΟΣ  \nRecommended  holding period:\r 5 years\nİstanbul ΟΔΟΣ\n\nStraße"


def test_folded_lines_are_the_folds_of_lines(spark):
    df = spark.createDataFrame([(1, 2, PAGE), (3, 4, ""), (5, 6, None), (7, 8, " \n")], "a int, b int, t string")
    got = lines.lines(df, ["a", "b"], "t", around=(1, 1), folded=True)
    rows = got.select("a", "b", "line_no", "folded", "near", fold("line").alias("f"), fold("context").alias("n")).orderBy("line_no").collect()
    assert [(r.a, r.b, r.line_no) for r in rows] == [(1, 2, k) for k in range(len(rows))] and len(rows) == 6
    assert [(r.folded, r.near) for r in rows] == [(r.f, r.n) for r in rows]


def test_lines_without_folds(spark):
    df = spark.createDataFrame([(1, "a\n\n bc \nd"), (2, None)], "k int, t string")
    assert [tuple(r) for r in lines.lines(df, "k", "t", around=(1, 0), heading=lambda x: F.when(F.length(x) > 1, x)).orderBy("line_no").collect()] == [(1, 0, "a", 0, "a", None), (1, 1, "bc", 2, "a bc", "bc"), (1, 2, "d", 5, "bc d", "bc")]
    assert lines.lines(df, "k", "t").count() == 3


def evaluated(df, what: str) -> int:
    """How often the plan that is run evaluates an expression that holds `what`."""
    return df._jdf.queryExecution().optimizedPlan().toString().count(what)


@pytest.fixture(scope="module")
def some_lines(spark):
    df = spark.createDataFrame([(1, 1, "memorandum", 4, 0, "l", "c", 0, "l", "c")], "fund int, source_id int, document_type string, page int, line_no int, line string, context string, start long, folded string, near string")
    return df.repartition(2, "fund")  # rows known to the optimizer would be folded into constants


def test_assets_are_read_once(some_lines):
    assert evaluated(x.assets(some_lines, 2026), "hodnota majetku fondu|") == 1


def test_customers_are_dealt_before_they_become_text(spark):
    assert memoranda.memoranda(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism


def test_fees_are_read_once(some_lines):
    assert evaluated(x.fees(some_lines), "zdarma|") == 1 and evaluated(x.fees(some_lines), "performance fee") == 1


def test_horizons_are_read_once(some_lines):
    assert evaluated(x.horizons(some_lines), r"recommended\s") == 2  # the number, and the words around it


def test_minimum_investments_are_read_once(some_lines):
    assert evaluated(x.minimum_investments(some_lines), "nejnizsi|") == 3  # number, unit and currency


def test_capital_history_is_read_once(some_lines):
    assert evaluated(x.capital_history(some_lines), "(tisic|tis|milionu") == 3  # number, unit and currency


def test_target_returns_are_read_once(some_lines):
    found = x.target_returns(some_lines)
    assert evaluated(found, "hurdle(?:") == 1 and evaluated(found, "anticipated|") == 3  # a range's ends and one value


def test_both_fields_of_a_memorandum_are_resolved(spark):
    from tessera.operators import resolve

    m = memoranda.memoranda(spark, "/root/testdata/sf0.001")
    claims = x.claims(x.horizons(m), F.col("value.years")).unionByName(x.claims(x.minimum_investments(m), F.col("value.amount")))
    assert evaluated(claims, r"recommended\s") == 2 and evaluated(claims, "nejnizsi|") == 3
    got = resolve.resolve(claims, ["fund", "field"], ["value"])
    assert got.count() == 2 * m.select("fund").distinct().count() and got.where("n_claims <> 3").count() == 0


def test_lines_without_figures_in_linear_time(spark):
    begun = time.time()
    df = spark.range(1).select(F.expr("repeat('word ', 80000)").alias("w")).select(F.concat("w", F.lit("\n1 a\r b\n"), "w", F.lit("\n\n2")).alias("t"), "w").repartition(2, "w")
    row = df.select(without_figures("t").alias("v"), "w").first()
    assert row.v == f"{row.w}\n\n{row.w}\n\n" and time.time() - begun < 30


def test_many_names_meet_texts_in_one_reading(spark):
    names = spark.range(900).select("id", F.concat(F.lit("Name "), F.col("id") % 600, F.when(F.col("id") % 3 == 0, " x").otherwise("")).alias("name"))
    texts = spark.range(50).select("id", F.concat(F.lit("a name, "), F.col("id"), F.lit(" X name "), F.col("id") + 300).alias("t"))
    got = mentions.mentions(texts.withColumnRenamed("id", "k"), ["k"], "t", names, "name", "id", 100)
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    one = mentions.mentions(texts.withColumnRenamed("id", "k"), ["k"], "t", names, "name", "id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, one.collect())) and got.count() > 100


def test_equal_windows_of_many_documents_are_one_row(spark):
    pages = program_documents.order_documents(spark, "/root/testdata/sf0.001").coalesce(1)
    windows, rows = program.windows_worth_reading(pages), program.lines_worth_reading(pages)
    n, places, same = windows.agg(F.count("*"), F.sum(F.size("places")), F.count_distinct("context", "line", "folded", "near", "near_bits", "line_bits", "return_heading", "value_heading", "page_scope")).first()
    assert places == rows.count() and n == same < places / 3
    assert rows.select("source_id", "line_no").distinct().count() == places


def test_scopes_are_ranked_with_windows(spark):
    pages = program_documents.order_documents(spark, "/root/testdata/sf0.001").limit(40)
    found = program.candidates(program.windows_worth_reading(pages), 2026).checkpoint()
    claims = program.as_claims(found)
    assert evaluated(claims, "[Tt]") == 0
    assert claims.where(F.col("scope") != program.scope_rank(F.col("page_scope"), F.col("quote"))).count() == 0 < claims.where("scope > 0").count()
