"""Near duplicates by five-word shingles against brute force, and the pipeline's stage."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import similar

from .conftest import made_up
from .test_near_duplicates import brute_components


def shingles(text):
    w = (text or "").lower().split()
    return {" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(r, text, edits):
    w = text.split()
    for _ in range(edits):
        w[r.randrange(len(w))] = "edited" + str(r.randrange(10**6))
    return " ".join(w)


def documents(seed):
    r = random.Random(seed)
    base = [t for t in made_up(seed, 120, 300) if len(t.split()) > 8]
    near = [edited(r, t, r.randint(1, max(1, len(t.split()) // 30))) for t in base for _ in range(2)]
    more = [edited(r, base[0], r.randint(1, 3)) for _ in range(60)]
    few = ["a b c d e f g h i", "a b c d e f g h", "a b c d e f g h i j", "one two", "ONE two", "", None, " \n"]
    return [(k, t) for k, t in enumerate(base + near + more + few)]


def wanted(rows):
    sets = {k: shingles(t) for k, t in rows}
    ids = sorted(sets)
    return brute_components(ids, [(a, b) for a in ids for b in ids if a < b and similarity(sets[a], sets[b]) >= 0.8]), sets


def test_stage_finds_similar_texts(spark):
    rows = documents(4)
    roots, sets = wanted(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text"))
    got = corpus_pipeline.one_of_each(spark, df.repartition(5), "").collect()
    assert sorted(r.doc_id for r in got) == sorted(set(roots.values()))
    assert len(got) < len(rows) - 150  # most near copies go


def test_large_cluster_is_cut_into_tiles(spark, monkeypatch):
    monkeypatch.setattr(similar, "CELLS", 900)
    rows = documents(6)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in similar.dedup(df).collect()) == sorted(set(wanted(rows)[0].values()))


def test_without_ids_and_with_shared_ones(spark):
    a, b, c = made_up(9, 1, 90)[0] * 3, made_up(10, 1, 90)[0] * 3, made_up(11, 1, 90)[0] * 3
    df = spark.createDataFrame([(None, a), (None, a + " extra"), (None, b), (5, c), (None, c + " extra"), (6, "one"), (6, "two"), (7, "two")], "doc_id long, text string")
    got = similar.dedup(df.repartition(3)).collect()
    assert sorted(r.doc_id or -1 for r in got) == [-1, -1, 5, 6]
    assert similar.dedup(df.limit(0)).collect() == []
