"""Evidence, alignment, grounding, hypothesis properties of functions."""

from __future__ import annotations

import datetime
import re

from hypothesis import assume, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import evidence, text
from tessera.operators import align
from tessera.plans import extraction, grounding, planning


def one(spark, column, **given):
    df = spark.createDataFrame([tuple(given.values())], list(given)) if given else spark.range(1)
    return df.select(column.alias("v")).first().v


def test_decoding(spark):
    rows = [("žluť".encode(),), ("žluť".encode("cp1250"),), ('<meta charset="iso-8859-2">žluť'.encode("iso-8859-2"),), (b"",), (None,)]
    got = [r.v for r in spark.createDataFrame(rows, "b binary").select(evidence.decoded("b").alias("v")).collect()]
    assert got == ["žluť", "žluť", '<meta charset="iso-8859-2">žluť', "", None]


def test_tables_of_pages(spark):
    html = "<table><tr><td>a</td><td> b\n c </td></tr><tr><td>1</td><td>2</td></tr></table><table><tr><td>lonely</td></tr></table>"
    assert one(spark, evidence.html_tables("h"), h=html) == [[["a", "b c"], ["1", "2"]]]
    assert one(spark, evidence.html_tables("h"), h="") == []


def test_markdown(spark):
    got = one(spark, evidence.markdown_chunks("m"), m="Title\n\n| a |\n|---|\nafter\n\nend")
    assert [(c.kind, c.text) for c in got] == [("paragraph", "Title"), ("table", "| a |\n|---|"), ("paragraph", "after"), ("paragraph", "end")]


def test_written_forms(spark):
    forms = one(spark, evidence.written_forms(F.col("n")), n=1_250_000.0)
    assert {"1,250,000", "1 250 000", "1.250.000", "1250000", "1250", "1 250"} <= set(forms) and "1" not in forms


def test_zero_fees(spark):
    z = lambda basis, rate=0.0: spark.createDataFrame([(basis,)], "b string").select(evidence.zero_fee(F.lit(rate), F.col("b"), F.array(F.lit("vstupni"))).alias("v")).first().v
    assert z(None) == "zero_fee_without_evidence" and z("vstupní poplatek 0 %") is None and z("cokoli", 1.0) is None


def test_named_funds(spark):
    assert one(spark, evidence.named_funds("t"), t="Správu provádí Modrý Reality SICAV a také Zelený podfond. nic podfond") == ["Modrý Reality", "Zelený"]


def test_passages_go_to_their_pages(spark):
    words = lambda a, n=8: " ".join(f"slovo{a}{k:03d}" for k in range(n))
    pages = spark.createDataFrame([(1, p, words(chr(96 + p), 20)) for p in (1, 2, 3)], "doc_id long, page int, text string")
    chunks = [words("a"), "krátce", words("a"), words("c"), "x", words("b"), words("z")]
    df = spark.createDataFrame([(1, k, t) for k, t in enumerate(chunks)] + [(2, 0, words("a"))], "doc_id long, chunk int, text string")
    got = {(r.doc_id, r.chunk): r.page for r in align.place(pages, df).collect()}
    assert got == {(1, 0): 1, (1, 1): 1, (1, 2): 1, (1, 3): 3, (1, 4): None, (1, 5): 2, (1, 6): None, (2, 0): None}


def test_packets_and_decisions(spark):
    s = spark.createDataFrame([("f", "fees", "u", 1, "A  b", False, 5, 7), ("f", "fees", "u", 1, "a B", False, 9, 8), ("f", "fees", "v", 1, "c", True, 99, 9), ("g", "fees", "u", 1, "a", False, 1, 1)], "fund string, field string, url string, page int, quote string, warning boolean, score int, source_id long")
    p = grounding.packets(spark.createDataFrame([("f", "fees")], "fund string, field string"), s)
    row = p.first()
    assert [(x.source_id, x.score) for x in row.snippets] == [(8, 9), (9, 99)]
    d = spark.createDataFrame([(row.packet_id, "accept", "3 %", [8]), ("other", "accept", "x", [1])], "packet_id string, decision string, value string, snippet_ids array<long>")
    assert [r.packet_id for r in grounding.bad_references(p, d).collect()] == ["other"]
    r = spark.createDataFrame([("f", "fees", "not_found", None), ("g", "fees", "found", "1 %")], "fund string, field string, status string, value string")
    assert {(x.fund, x.status, x.value) for x in grounding.apply(r, p, d).collect()} == {("f", "found", "3 %"), ("g", "found", "1 %")}
    assert grounding.report(r, "Fields", ["fund", "status"]).endswith("| f | not_found |\n| g | found |")


def test_news(spark):
    rows = [("f", 0, "https://a.cz/2024/05/01/x", "Zpráva"), ("f", 1, "https://a.cz/2024/05/01/x", "Znovu"), ("f", 2, "https://a.cz/y", "Novinka 3. 6. 2024"), ("f", 3, "https://a.cz/kontakt", "Kontakt"), ("f", 4, "https://a.cz/z", "Bez data")]
    got = extraction.news(spark.createDataFrame(rows, "fund string, seq int, url string, title string")).collect()
    assert {(r.url, r.title, r.published_at) for r in got} == {("https://a.cz/2024/05/01/x", "Zpráva", datetime.date(2024, 5, 1)), ("https://a.cz/y", "Novinka 3. 6. 2024", datetime.date(2024, 6, 3)), ("https://a.cz/z", "Bez data", None)}


def test_triggers(spark):
    t = lambda field, status, *flags: one(spark, planning.unanswered_trigger(F.lit(field), F.lit(status), *map(F.lit, flags)))
    assert t("fees", "ambiguous", True, True, False) == "value_unconfirmed" and t("fees", "not_found", True, True, False) is None
    assert t("fees", "not_found", True, False, False) == "field_unanswered" and t("aum_history", "not_found", False, False, True) == "series_sources_unreached"
    assert t("aum_history", "not_found", False, False, False) is None and t("news", "not_found", False, False, True) is None and t("fees", "found", False, False, True) is None


@given(url=st.from_regex(r"https?://[A-Za-z]{1,8}\.(cz|com)(:\d{2,4})?(/[A-Za-z0-9._-]{0,6}){0,3}(\?[a-z]=[0-9])?(#[a-z]{0,3})?", fullmatch=True))
@settings(max_examples=15, deadline=None)
def test_canonical_addresses_stay(spark, url):
    assume(not re.search(r"\w/{2,}(\?|#|$)", url))  # a path of slashes alone becomes empty, and then one slash
    once = one(spark, text.canonical_url("u"), u=url)
    assert one(spark, text.canonical_url("u"), u=once) == once and "#" not in once
