"""Mentions of names against plain search."""

from __future__ import annotations

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import mentions


def plain_words(t):
    flat = "".join(unicodedata.normalize("NFKD", c)[0] for c in t).lower()
    return [(m.start(), m.end(), m[0]) for m in re.finditer(r"[^\W_]+", flat)]


def brute(texts, names):
    out = set()
    for key, t in texts:
        words = plain_words(t or "")
        for own_id, name in names:
            want = [w for _, _, w in plain_words(name or "")]
            for k in range(len(words) - len(want) + 1):
                if want and [w for _, _, w in words[k : k + len(want)]] == want:
                    out.add((key, own_id, words[k][0], words[k + len(want) - 1][1], k, len(want)))
    return out


@pytest.mark.parametrize("most", [3, 1000])
def test_mentions(spark, most):
    r = random.Random(1)
    vocabulary = ["Alfa", "beta", "žluť", "Fond", "a", "x1", "SICAV"]
    some = lambda n: r.choice([" ", ", ", "\n", "-"]).join(r.choice(vocabulary) for _ in range(n))
    names = [(k, some(r.randint(1, 4))) for k in range(40)] + [(100, ""), (101, None), (102, "..."), (103, "Alfa"), (104, "ALFA")]
    texts = [(k, some(r.randint(0, 40))) for k in range(60)] + [(200, None), (201, ""), (202, "Alfabeta alfa_beta Alfa!")]
    df, listed = spark.createDataFrame(texts, "key int, t string").repartition(4), spark.createDataFrame(names, "id int, name string")
    got = mentions.mentions(df, ["key"], "t", listed, "name", "id", most)
    assert sorted(map(tuple, got.collect())) == sorted(brute(texts, names))


def test_no_names_and_no_texts(spark):
    texts, names = spark.createDataFrame([(1, "Alfa")], "key int, t string"), spark.createDataFrame([(1, "Alfa")], "id int, name string")
    assert mentions.mentions(texts, ["key"], "t", names.limit(0), "name", "id").collect() == []
    assert mentions.mentions(texts.limit(0), ["key"], "t", names, "name", "id").collect() == []


REST = "platí to co je psáno ve statutu každého z nich zde"
TEXT = f"Přehled fondů. KOOR ESG investiční fond s proměnným kapitálem: poplatek 1 %, {REST}. CREDITAS ASSETS SICAV má 2 %, {REST}. Znovu KOOR ESG podfond, a.s., 3 %. SICAV"


def section_of(spark, t, own):
    df = spark.createDataFrame([(t, own)], "t string, own array<string>").withColumn("m", mentions.names_before_forms("t"))
    return df.select("m", mentions.own_sections(F.col("m"), F.col("own"), F.length("t")).alias("s"), mentions.names_another(F.col("m"), F.col("own")).alias("another")).first()


def test_sections_of_a_page_of_many_funds(spark):
    got = section_of(spark, TEXT, ["koor", "esg"])
    assert [m.tokens[-2:] for m in got.m][:3] == [["koor", "esg"], ["creditas", "assets"], ["koor", "esg"]]
    parts = [TEXT[s.start : s.end] for s in got.s]
    assert "1 %" in parts[0] and "CREDITAS ASSETS SICAV má 2 %" not in parts[0] and got.another
    alone = section_of(spark, "Statut KOOR ESG investiční fond. KOOR ESG SICAV", ["koor", "esg"])
    assert not alone.another and len(alone.s) == 2
    assert section_of(spark, "SICAV", ["a"]).m == [] and section_of(spark, None, ["a"]).m == []


@pytest.mark.parametrize(
    "name, anchor, url, another",
    [
        ("CARE SICAV, a.s.", "Statut podfondu ESG SeniorCare", "https://a.cz/x.pdf", False),
        ("CARE SICAV, a.s.", "Statut podfond Alfa", "https://a.cz/x.pdf", True),
        ("CARE SICAV, a.s.", "Statut", "https://a.cz/alfa", False),
        ("CARE SICAV, a.s.", "Statut fond SICAV", "https://a.cz/", False),
        ("Fond SICAV", "podfond Alfa", "https://a.cz/", False),
        ("Alfa fond", None, "https://a.cz/podfond-alfa-2024.pdf", False),
    ],
)
def test_links_of_other_funds(spark, name, anchor, url, another):
    row = spark.createDataFrame([(name, anchor, url)], "n string, a string, u string").select(text.link_names_another("n", "a", "u").alias("v")).first()
    assert row.v == another
