"""Periodic runs against all periods of all stretches."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import runs
from tessera.llm.common import documents

SF = "/root/testdata/sf0.001"


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def brute(w):
    """Runs (start, length, period) by trying every period: maximal stretches on which words q apart agree."""
    n, out = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                out.setdefault((i, j - i + q), q)  # periods ascend: the first is the smallest
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in out.items())


def rest(w, found):
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def of(texts):
    numbers = {}
    flat = [numbers.setdefault((x), len(numbers)) for t in texts for x in t]
    bounds = np.cumsum([0, *map(len, texts)])
    got = [[] for _ in texts]
    for s, n, q in runs.find_runs(np.array(flat, np.int64), bounds).tolist():
        k = int(np.searchsorted(bounds, s, "right")) - 1
        got[k].append((s - int(bounds[k]), n, q))
    return got


@given(st.lists(st.lists(st.integers(0, 2), max_size=60), min_size=1, max_size=5))
@settings(max_examples=400, deadline=None)
def test_small_alphabets(texts):
    assert of(texts) == [brute(t) for t in texts]


def test_planted_and_nested_runs():
    r = random.Random(1)
    texts = []
    for _ in range(150):
        t = []
        for _ in range(r.randint(1, 6)):
            unit = [r.randint(0, 4) for _ in range(r.randint(1, 9))]
            if r.random() < 0.3:
                unit = unit * r.randint(2, 6) + [r.randint(0, 4)]
            t += unit * r.randint(1, 7) + unit[: r.randint(0, len(unit))] + [r.randint(0, 50) for _ in range(r.randint(0, 8))]
        texts.append(t)
    assert of(texts) == [brute(t) for t in texts]


@pytest.mark.parametrize("unit", [1, 2, 7, 500])
def test_one_long_run(unit):
    """A text that is one run: work stays near its length."""
    n = 60_000
    t = [5, *(list(range(10, 10 + unit)) * (n // unit + 1))[:n], 6]
    assert of([t]) == [[(1, n, unit)]]


def test_leaves_in_small_steps(monkeypatch):
    t = [0, 1, 0, 1, 0, 1, 0, 1, 2, 2, 2, 2, 2, 2, 2] * 5
    want = brute(t)
    texts = np.array(t, np.int64)
    end, begin = np.full(len(t), len(t)), np.zeros(len(t), np.int64)
    order, levels = runs.suffixes(texts, begin, end)
    shared = np.concatenate([[0], runs.common(levels, end, order[:-1], order[1:])])
    whole = runs.branching(order, end, begin, runs.tree(shared.tolist()))
    assert (runs.branching(order, end, begin, runs.tree(shared.tolist()), leaves=3) == whole).all() and of([t]) == [want]


def test_suffix_array_and_tree():
    r = random.Random(3)
    t = [r.randint(0, 3) for _ in range(300)]
    order, levels = runs.suffixes(np.array(t), np.zeros(300, np.int64), np.full(300, 300))
    assert order.tolist() == sorted(range(300), key=lambda k: t[k:])
    shared = np.concatenate([[0], runs.common(levels, np.full(300, 300), order[:-1], order[1:])])
    for p in range(1, 300):
        a, b = t[order[p - 1] :], t[order[p] :]
        assert shared[p] == next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    depth, first, end, cut = runs.tree(shared.tolist())
    for d, a, b in zip(depth, first, end):
        inside = shared[a + 1 : b]
        assert inside.min() == d and (a == 0 or shared[a] < d) and (b == 300 or shared[b] < d)


def altered(doc_id, t):
    w = words(t)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def expected(rows):
    out = []
    for doc_id, t in rows:
        w = altered(doc_id, t)
        found = brute(w)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        four = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        out.append((doc_id, len(found), *four, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(rest(w, found))))
    return sorted(out, key=str)


def test_op12_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark, SF).collect()]
    want = expected(rows)
    assert sorted((tuple(r) for r in runs.op12(spark, SF).collect()), key=str) == want
    assert sum(r[1] > 0 for r in want) > 5


def test_op12_odd_rows(spark, odd_documents, tmp_path):
    odd_documents.withColumn("runs", F.lit("clash")).withColumn("w", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in runs.op12(spark, str(tmp_path)).collect()), key=str)
    assert got == expected([(r.doc_id, r.text) for r in odd_documents.collect()])


def test_op12_empty(spark, no_documents, tmp_path):
    no_documents.write.parquet(f"{tmp_path}/documents.parquet")
    assert runs.op12(spark, str(tmp_path)).collect() == []


def test_collapse_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, "a b " * 5 + "c", "x", 1), (2, None, "y", 2)], "id int, text string, collapsed string, found int")
    got = {r.id: r for r in runs.collapse(df).collect()}
    assert got[1].collapsed == "a b c" and [tuple(r) for r in got[1].runs] == [(0, 10, 2)] and got[1].found == 1
    assert got[2].collapsed == "" and got[2].runs == []
