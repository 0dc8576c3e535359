"""SimHash, embeddings and connected components against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tessera.llm import common, embeddings, simhash

from .conftest import made_up


def brute_components(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(260)]
    edges += [(1000 + k, 1001 + k) for k in range(60)]  # a chain
    edges += [(5000, 5000 + k) for k in range(1, 300)]  # a star
    edges += [(7777, 7777)]
    df = spark.createDataFrame(edges + [(None, 3), (4, None)], "a long, b long").repartition(7)
    got = {r.node: r.root for r in common.components(df).collect()}
    assert got == brute_components({n for e in edges for n in e}, edges)
    assert common.components(df.limit(0)).collect() == []


def brute_fingerprint(text, k=3):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    s = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark, odd_documents, no_documents):
    texts = made_up(5, 60, 200)
    rows = [(100 + k, t) for k, t in enumerate(texts)] + [(300 + k, t.replace("a", "A", 1)) for k, t in enumerate(texts[:20])] + [(400 + k, t + " extra") for k, t in enumerate(texts[:20])]
    df = odd_documents.where("doc_id is not null").select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    got = simhash.near_duplicates(df.withColumn("fingerprint", F.lit("clash"))).collect()
    docs = df.collect()
    prints = [(d.doc_id, brute_fingerprint(d.text)) for d in docs]
    edges = [(a, b) for k, (a, x) in enumerate(prints) for b, y in prints[k:] if bin(x ^ y).count("1") <= 3]
    roots = brute_components({d for d, _ in prints}, edges)
    assert sorted((r.doc_id, r.fingerprint % 2**64, r.component_id) for r in got) == sorted((d, p, roots[d]) for d, p in prints)
    kept = [r.doc_id for r in simhash.dedup(df).collect()]
    assert sorted(kept) == sorted(set(roots.values()))
    assert simhash.near_duplicates(no_documents).collect() == []
    assert simhash.dedup(no_documents).collect() == []


def test_simhash_without_ids(spark):
    df = spark.createDataFrame([(None, "one two three"), (None, "one two three"), (7, "one two three"), (None, "far from all else here")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in simhash.near_duplicates(df).collect())
    assert got == [(-1, -1), (-1, 7), (-1, 7), (7, 7)]


def test_simhash_dedup_without_ids(spark):
    words = " ".join(made_up(8, 1, 400)[0].split() * 3)
    near = [(None, words), (None, words + " extra"), (None, words.replace("a", "A", 1))]
    df = spark.createDataFrame([*near, (None, "quite another text"), (None, "quite another text"), (None, "and a third of its own"), (7, "one two three"), (None, "one two three"), (8, None)], "doc_id long, text string")
    a, b = brute_fingerprint(words), brute_fingerprint(words + " extra")
    assert a != b and bin(a ^ b).count("1") <= 3
    got = simhash.dedup(df.repartition(3)).collect()
    assert sorted(r.doc_id or -1 for r in got) == [-1, -1, -1, 7, 8]
    texts = {r.text for r in got}
    assert texts - {t for _, t in near} == {"quite another text", "and a third of its own", "one two three", None}
    assert [r.component_id for r in simhash.near_duplicates(df).collect() if r.doc_id is None].count(7) == 1


def test_bit_slices():
    r = np.random.default_rng(1)
    base = r.integers(0, 2**63, 500).astype(np.uint64) * np.uint64(2) + r.integers(0, 2, 500).astype(np.uint64)
    flips = base ^ (np.uint64(1) << r.integers(0, 64, 500).astype(np.uint64)) ^ (np.uint64(1) << r.integers(0, 64, 500).astype(np.uint64))
    block = np.concatenate([base, flips])
    for radius in (0, 1, 2, 3):
        q, b = simhash.close(base[:300], block, radius)
        want = {(i, j) for i in range(300) for j in np.flatnonzero(np.bitwise_count(block ^ base[i]) <= radius)}
        assert set(zip(q.tolist(), b.tolist())) == want
        assert (simhash.close_rows(base, flips, radius) == (np.bitwise_count(base ^ flips) <= radius)).all()


def test_large_key_is_cut_into_tiles(spark, monkeypatch):
    monkeypatch.setattr(simhash, "GROUP", 40)
    r = np.random.default_rng(2)
    center = int(r.integers(0, 2**62))
    prints = sorted({center ^ (1 << int(b)) ^ (1 << int(c)) for b in r.integers(0, 20, 60) for c in r.integers(0, 40, 4)})
    df = spark.createDataFrame([(p, k) for k, p in enumerate(prints)], "fp long, node long")
    got = [(e.a, e.b) for e in simhash.links(df).collect()]
    all_edges = [(i, j) for i in range(len(prints)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 3]
    nodes = set(range(len(prints)))
    assert brute_components(nodes, got) == brute_components(nodes, all_edges)


def test_embeddings(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 64)
    r = np.random.default_rng(7)
    base = r.normal(size=(120, 24))
    near = base[:60] + r.normal(size=(60, 24)) * 0.09
    edge = base[:40] + r.normal(size=(40, 24)) * np.linspace(0.05, 0.9, 40)[:, None]
    group = base[:1] + r.normal(size=(150, 24)) * 0.02
    x = np.concatenate([base, near, edge, group, base[:5], base[:5] * 1e6, base[5:8] * 1e-9]).tolist()
    odd = [None, [], [0.0] * 24, [float("nan")] + [1.0] * 23, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23, [1.0, 2.0], [2.0, 4.0]]
    rows = [(k, v, 1) for k, v in enumerate(x)] + [(1000 + k, v, 2) for k, v in enumerate(odd)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {g.vec_id: (g.n_links, g.component_id, g.kept) for g in embeddings.near_duplicates(df.repartition(5)).collect()}
    m = np.array(x)
    u = m / np.linalg.norm(m, axis=1)[:, None]
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    edges = [(int(a), int(b)) for a, b in zip(*np.nonzero(link))] + [(1006, 1007)]
    roots = brute_components({k for k, _, _ in rows}, edges)
    n = dict(enumerate(link.sum(1).tolist())) | {1006: 1, 1007: 1}
    assert got == {k: (n.get(k, 0), roots[k], roots[k] == k) for k, _, _ in rows}
    assert embeddings.near_duplicates(df.limit(0)).collect() == []


def test_embedding_bounds_hold():
    r = np.random.default_rng(4)
    x = r.normal(size=(200, 1500))
    q, scale, error = embeddings.quantise(x)
    b = embeddings.Block(np.arange(200).tobytes(), np.ones(200, np.int64).tobytes(), scale.tobytes(), error.tobytes(), q.tobytes())
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = embeddings.product(b.q, b.q) / (b.scale[:, None] * b.scale[None, :])
    assert (np.abs(near - u @ u.T) <= b.error[:, None] + b.norm[:, None] * b.error[None, :] + 1e-12).all()


def test_embeddings_with_shared_and_missing_ids(spark):
    v = [1.0, 0.0], [0.0, 1.0]
    df = spark.createDataFrame([(1, v[0]), (1, v[1]), (2, v[0]), (3, v[1]), (None, v[1])], "vec_id long, embedding array<float>")
    got = sorted((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df).collect())
    assert got == [(-1, 2, 1, False), (1, 1, 1, True), (1, 2, 1, True), (2, 1, 1, False), (3, 2, 1, False)]
