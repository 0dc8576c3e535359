"""Crawls by fund, and the sample under several constraints, against sequential versions."""

from __future__ import annotations

import hashlib
import heapq
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.operators import graph
from tessera.plans import planning


def brute_crawl(links, seeds, budgets, rounds, required):
    """A priority queue for each fund, a page at a time."""
    pages, documents = set(), {}
    of = {}
    for a, b, seq, score, kind, document in sorted(links, key=lambda x: x[2]):
        if b is not None:
            of.setdefault(a, {}).setdefault(b, (seq, score, kind, document))
    for fund, budget in budgets:
        queue, met, found = [], set(), {}
        for f, node, score, seq in sorted(seeds, key=lambda s: s[3]):
            if f == fund and node not in met:
                met.add(node)
                heapq.heappush(queue, (-score, 0, seq, node))
        n = 0
        while queue and n < min(budget, rounds):
            if required and all(set(found.values()) & set(group) for group in required.values()):
                break
            score, _, _, node = heapq.heappop(queue)
            n += 1
            pages.add((fund, node, -score, n))
            for b, (seq, own, kind, document) in sorted(of.get(node, {}).items(), key=lambda x: x[1][0]):
                if document:
                    found.setdefault(b, kind)
                    documents.setdefault((fund, b), (kind, n))
                elif b not in met:
                    met.add(b)
                    heapq.heappush(queue, (-own, n, seq, b))
    return pages, {(*k, *v) for k, v in documents.items()}


@pytest.mark.parametrize("required", [None, graph.REQUIRED])
def test_crawl(spark, required):
    r = random.Random(5)
    links = [(a, r.choice([None, *range(40)]), seq, r.randint(0, 9) * 10, r.choice(["priips_kid", "statute", "factsheet", "other"]), r.random() < 0.4) for a in range(40) for seq in range(r.randint(0, 12))]
    seeds = [(f, r.randint(0, 39), r.choice([100, 190]), s) for f in range(12) for s in range(r.randint(0, 3))]
    budgets = [(f, r.randint(0, 9)) for f in range(12)]
    got = graph.crawl(
        spark.createDataFrame(links, "a long, b long, seq int, score int, kind string, document boolean"), spark.createDataFrame(seeds, "fund long, node long, score int, seq int"),
        spark.createDataFrame(budgets, "fund long, budget int"), 7, required,
    )
    pages, documents = brute_crawl(links, seeds, budgets, 7, required)
    assert {tuple(x) for x in got[0].collect()} == pages
    assert {tuple(x) for x in got[1].collect()} == documents


def test_crawl_without_seeds(spark):
    links = spark.createDataFrame([(1, 2, 0, 1, "other", False)], "a long, b long, seq int, score int, kind string, document boolean")
    seeds, budgets = spark.createDataFrame([], "fund long, node long, score int, seq int"), spark.createDataFrame([(1, 3)], "fund long, budget int")
    pages, documents = graph.crawl(links, seeds, budgets, 3)
    assert pages.collect() == [] and documents.collect() == []


def test_robots_of_each_host(spark):
    links = spark.createDataFrame([("a.cz", "/x/1"), ("a.cz", "/y"), ("b.cz", "/x/1")], "host string, path string")
    robots = spark.createDataFrame([("a.cz", ["/x"]), ("c.cz", ["/"])], "host string, disallowed array<string>")
    assert sorted(map(tuple, graph.permitted(links, robots, "host", "path").collect())) == [("a.cz", "/y"), ("b.cz", "/x/1")]


def sequential(rows, size, seed, hard, most):
    """The same sample over all rows, one row at a time."""
    counts = Counter(r["field"] for r in rows)
    quota = planning.quotas(dict(counts), size)
    share = {t: n / len(rows) for t, n in Counter(r["type"] for r in rows).items()}
    chosen, fund, field, kind = {}, Counter(), Counter(), Counter()

    def accept(r, turn):
        chosen[r["key"]] = turn
        fund[r["fund"]] += 1
        field[r["field"]] += 1
        kind[r["type"]] += 1

    mix = lambda k: hashlib.md5(f"{seed}/{k}".encode()).hexdigest()
    for f in sorted(quota):
        for r in sorted((r for r in rows if r["field"] == f), key=lambda r: (-r["difficulty"], mix(r["key"]), r["key"])):
            if field[f] < round(quota[f] * hard) and fund[r["fund"]] < most:
                accept(r, "hard")
    while len(chosen) < size:
        left = [r for r in rows if r["key"] not in chosen and field[r["field"]] < quota[r["field"]] and fund[r["fund"]] < most]
        if not left:
            break
        accept(min(left, key=lambda r: (-(share[r["type"]] * size - kind[r["type"]]), -r["difficulty"], r["fund"], r["field"], r["key"])), "spread")
    return chosen


@pytest.mark.parametrize("n, funds, size", [(600, 40, 30), (600, 6, 30), (50, 50, 60), (900, 300, 25)])
def test_sample_is_the_sequential_one(spark, n, funds, size):
    r = random.Random(n + funds)
    rows = [{"key": k, "fund": int(funds * r.random() ** 3), "field": r.choice("aaabbcd"), "type": r.choice("xxxxyyz"), "difficulty": r.randint(0, 5)} for k in range(n)]
    df = spark.createDataFrame([tuple(x.values()) for x in rows] + [(None, 1, "a", "x", 9), (n + 1, None, "a", "x", 9)], "key long, fund long, field string, type string, difficulty int").repartition(5)
    got = planning.sample(df, "key", "fund", "field", "type", "difficulty", size, "7")
    picked = {x.key: x["pass"] for x in got.collect()}
    assert picked == sequential(rows, size, "7", planning.HARD_SHARE, planning.ROWS_OF_A_FUND)
    assert max(Counter(x["fund"] for x in rows if x["key"] in picked).values()) <= 3


def test_sample_of_nothing(spark):
    df = spark.createDataFrame([], "key long, fund long, field string, type string, difficulty int")
    assert planning.sample(df, "key", "fund", "field", "type", "difficulty", 5, "7").collect() == []


def test_sitemap_seeds_keep_one_host(spark):
    rows = [(1, "u1", "a", "a", 50, None), (1, "u2", "b", "a", 90, None), (1, "u3", "a", "a", 10, None), (1, "u1", "a", "a", 40, None)]
    df = spark.createDataFrame(rows, "fund int, node string, host string, fund_host string, score int, modified date")
    assert [tuple(x) for x in graph.sitemap_seeds(df, 20).collect()] == [(1, "u1", 50, 1)]
    assert graph.sitemap_seeds(df.where(F.lit(False)), 20).collect() == []


def test_review_sample_query(spark):
    from tessera import queries

    sf = "/root/testdata/sf0.001"
    orders = spark.read.parquet(f"{sf}/orders.parquet").collect()
    rows = [
        {"key": o.o_orderkey, "fund": o.o_custkey, "field": o.o_orderpriority, "type": o.o_orderstatus,
         "difficulty": 3 * (o.o_totalprice > 400_000) + 2 * (o.o_orderdate.year >= 1998) + 2 * (o.o_orderdate.day == 1)}
        for o in orders
    ]
    got = {x.o_orderkey: x["pass"] for x in queries.QUERIES["review_sample"](spark, sf).collect()}
    assert got == sequential(rows, 200, "7", planning.HARD_SHARE, planning.ROWS_OF_A_FUND)
