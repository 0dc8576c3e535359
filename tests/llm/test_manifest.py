"""The Merkle manifest against a plain build of the same trees."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import manifest
from tessera.llm.common import documents

SF = "/root/testdata/sf0.001"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain(trees):
    """{tree key: [(id, leaf, altered)] in order} -> rows (id, leaf, subroot, root, proof, folded, verified), by walking up node by node."""

    def walk(nodes):
        """(top, path of each node)"""
        paths, groups = [[] for _ in nodes], [[k] for k in range(len(nodes))]
        while len(nodes) > 1:
            above, members = [], []
            for k in range(0, len(nodes), 8):
                run = nodes[k : k + 8]
                for j, node in enumerate(run):
                    for x in groups[k + j]:
                        paths[x].append((run[:j], run[j + 1 :]))
                above.append(H(*run))
                members.append([x for g in groups[k : k + 8] for x in g])
            nodes, groups = above, members
        return nodes[0], paths

    tops = {t: walk([leaf for _, leaf, _ in rows]) for t, rows in trees.items()}
    order = sorted(tops, key=str.encode)
    root, uppers = walk([tops[t][0] for t in order]) if order else (None, [])
    out = []
    for t, upper in zip(order, uppers):
        subroot, paths = tops[t]
        for (own_id, leaf, altered), path in zip(trees[t], paths):
            node = altered
            for left, right in path + upper:
                node = H(*left, node, *right)
            out.append((own_id, leaf, subroot, root, H(*[x for a, b in path + upper for x in a + b]), node, node == root))
    return out


def written(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def lower(t):
    return None if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def expected(rows):
    trees = {}
    for doc_id, text, lang, source, n_chars in rows:
        leaf = lambda t: H(*map(written, (doc_id, source, lang, n_chars, t)))
        bad = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        trees.setdefault("" if lang is None else "=" + lang, []).append((doc_id, leaf(text), leaf(lower(text) if bad else text)))
    for own in trees.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return plain(trees)


def key(r):
    return tuple((x is not None, x) if x is not None else (False, 0) for x in r)


def run(df, tmp_path, spark):
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in manifest.op13(spark, str(tmp_path)).collect()), key=key)


def test_op13_whole_table(spark):
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in documents(spark, SF).collect()]
    assert sorted((tuple(r) for r in manifest.op13(spark, SF).collect()), key=key) == sorted(expected(rows), key=key)


def test_op13_odd_rows(spark, odd_documents, tmp_path):
    more = odd_documents.withColumn("lang", F.when(F.col("doc_id") % 5 == 0, F.lit(None)).when(F.col("doc_id") % 5 == 1, "žá").otherwise(F.col("lang")))
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in more.collect()]
    assert run(more.withColumn("tree", F.lit("clash")), tmp_path, spark) == sorted(expected(rows), key=key)


def test_op13_empty(spark, no_documents, tmp_path):
    assert run(no_documents, tmp_path, spark) == []


@pytest.mark.parametrize("n", [1, 8, 9, 64, 513, 1600])
def test_blocks_and_top_tree(spark, n):
    """Trees of one and of several blocks, the last of one leaf, give what one plain tree gives."""
    r = random.Random(n)
    trees = {"=a": n, "=b": 1, "": 3}
    rows = {t: [(k, H(t, str(k)), H(t, str(k), "x") if r.random() < 0.1 else H(t, str(k))) for k in range(m)] for t, m in trees.items()}
    df = spark.createDataFrame([(t[1:] if t else None, *x) for t, own in rows.items() for x in own], "tree string, id long, leaf string, altered string").repartition(5)
    got, root = manifest.manifest(df)
    want = plain(rows)
    assert root == want[0][3]
    assert sorted(tuple(x)[1:] for x in got.collect()) == sorted(want)


def test_height_follows_the_bound():
    assert manifest.height_of([100]) == 3 and manifest.height_of([8**8] * 2, 8**4) == 5 and manifest.height_of([10**12]) == 6
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(manifest, "HEIGHTS", range(1, 3))
        assert manifest.height_of([64, 1], 9) == 1 and manifest.height_of([64, 1], 8) == 2


def test_altered_rows_alone_fail(spark):
    got, _ = manifest.manifest(spark.createDataFrame([("a", k, H(str(k)), H(str(k + (k == 7)))) for k in range(100)], "tree string, id long, leaf string, altered string"))
    assert [r.id for r in got.where("not verified").collect()] == [7]
