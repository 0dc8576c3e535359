"""Each query that SQL can't express, and every stage of the pipeline, run on sf0.001 against plain Python."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer
from xxhash import xxh64_intdigest

import corpus_pipeline
from tessera.llm import bpe, idfile, mixing, quality, rules, secrets, simhash
from tessera.llm.common import documents

from .test_corpus import SF, brute_counts, brute_spans, brute_targets
from .test_near_duplicates import brute_components, brute_fingerprint
from .test_similar_texts import shingles, similarity


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in documents(spark, SF).collect()}


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.no_padding()
    t.no_truncation()
    return t


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def test_op1(spark, texts, library):
    want = {}
    for k, t in texts.items():
        ids = library.encode(t, add_special_tokens=False).ids
        want[k] = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.op1(spark, SF).collect()} == want


def test_op4(spark, texts, library):
    want, start = {}, 0
    for k in sorted(texts):
        ids = library.encode(texts[k], add_special_tokens=False).ids + [2]
        want[k] = (start, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids)))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in idfile.op4(spark, SF).collect()} == want


def test_op5(spark, texts):
    prints = {k: brute_fingerprint(t) for k, t in texts.items()}
    ids = sorted(prints)
    roots = brute_components(ids, [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 3])
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op5(spark, SF).collect()} == {k: (f"{prints[k]:016x}", roots[k]) for k in ids}


def test_op7(spark, texts):
    want = {}
    for k, t in texts.items():
        base, every = brute_spans(t)
        line = lambda spans: ",".join(f"{secrets.KINDS[kind]}:{a}:{b}" for a, kind, b in spans)
        want[k] = tuple(sum(kind == n for _, kind, _ in base) for n in range(3)) + (sha(line(base)), line(every))
    got = {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in secrets.op7(spark, SF).collect()}
    assert got == want


def plain_score(text, weights):
    """The logistic function of a dot product, n-gram by n-gram."""
    words = text.split()
    mixed = lambda x: int(quality._mix(__import__("numpy").array([x], "uint64"))[0])
    own = [xxh64_intdigest(w, 1) for w in words]
    forms = [xxh64_intdigest(quality.shape(w), 2) for w in words]
    total = 0.0
    for k in range(len(words)):
        before, form = (own[k - 1], forms[k - 1]) if k else (7, 7)
        pair = 11 if before == own[k] else (mixed(before) + own[k]) % 2**64
        grams = [own[k], pair, forms[k], (mixed(form) + forms[k] + 3) % 2**64]
        total += sum(weights[mixed(g) >> 48] for g in grams) / len(words)
    return 1 / (1 + math.exp(-(total + weights[-1])))


def test_op9(spark, texts):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    weights = quality.fit(documents(spark, SF), labels)
    got = {r.doc_id: r for r in quality.op9(spark, SF).collect()}
    assert got.keys() == texts.keys()
    for k, t in texts.items():
        assert got[k].held_out == (zlib.crc32(str(k).encode()) % 5 == 0)
        assert got[k].score == pytest.approx(plain_score(t, weights), abs=1e-9) and got[k].predicted == int(got[k].score >= 0.3)


def path_length(tree, row):
    feature, split, child, length = tree
    at = 0
    while feature[at] >= 0:
        at = child[at] + int(row[feature[at]] > split[at])
    return length[at]


def test_op10(spark, texts):
    forest, threshold = rules.fit(documents(spark, SF), spark.read.parquet(f"{SF}/labels.parquet"))
    got = {r.doc_id: r for r in rules.op10(spark, SF).collect()}
    assert got.keys() == texts.keys()
    for k, t in texts.items():
        n, chars, symbols, again, repeat = brute_counts(t)
        r = got[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, again, repeat)
        failed = n < 10 or 100 * repeat > 20 * n
        w, c = max(n, 1), max(chars, 1)
        lines = max(sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in t.split("\n")), 1)
        row = [symbols / w, again / lines, repeat / w, len(re.findall("[A-Z]", t)) / c, len(re.findall("[0-9]", t)) / c, chars / w]
        anomaly = 2 ** (-sum(path_length(tree, row) for tree in forest.trees) / (len(forest.trees) * forest.unit))
        assert r.anomaly == pytest.approx(anomaly) and r.base_failed == failed and r.kept == (not failed and r.anomaly <= threshold)


def test_labels_without_documents_do_not_use_up_the_sample(spark):
    docs = spark.createDataFrame([(k, "good plain words here" if k % 2 else "BAD!! $$$ BAD") for k in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)] + [(10_000 + k, 1) for k in range(20_000)], "doc_id long, quality int")
    for got in (quality.classify(docs, labels, sample=100).collect(), quality.classify(docs, labels.orderBy("quality"), sample=100).collect()):
        assert all(r.predicted == r.doc_id % 2 for r in got)
    forest, _ = rules.fit(docs, labels, sample=100)
    assert len(forest.trees) == rules.TREES


def brute_lines(rows):
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\r\x0b\x0c"))
    first = {}
    for k in sorted(rows):
        for x in rows[k].split("\n"):
            first.setdefault(key(x), k)
    return {k: "\n".join(x for x in t.split("\n") if len(key(x)) < 10 or first[key(x)] == k) for k, t in rows.items()}


def test_stages_of_the_pipeline(spark, texts, library, tmp_path):
    docs = documents(spark, SF)
    extra = [c for c in ("score", "predicted", "held_out", "kept", "n_lines", "n_dropped")]
    clashing = docs.selectExpr("*", *[f"'own {c}' AS {c}" for c in extra])
    good, lines, one, mixed, encoded = [f for _, f in corpus_pipeline.STAGES]
    hold = lambda df: spark.createDataFrame(df.collect(), clashing.schema)

    weights = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    held = hold(good(spark, clashing, SF))
    assert held.columns == clashing.columns and {tuple(r[c] for c in extra) for r in held.collect()} == {tuple(f"own {c}" for c in extra)}
    rows = {r.doc_id: r.text or "" for r in held.collect()}
    assert rows == {k: t for k, t in texts.items() if plain_score(t, weights) >= 0.3}

    held = hold(lines(spark, held, SF))
    after = {r.doc_id: r.text for r in held.collect()}
    assert after == brute_lines(rows) and all(r.n_chars == len(r.text) for r in held.collect())

    held = hold(one(spark, held, SF))
    sets = {k: shingles(t) for k, t in after.items()}
    ids = sorted(sets)
    roots = brute_components(ids, [(a, b) for a in ids for b in ids if a < b and similarity(sets[a], sets[b]) >= 0.8])
    assert sorted(r.doc_id for r in held.collect()) == sorted(set(roots.values()))

    whole = {r.doc_id: r for r in held.collect()}
    held.write.parquet(f"file://{tmp_path}/docs")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/docs/*.parquet'")
    taken = dict(con.execute(f"select doc_id, taken from ({mixing.OP3_SQL})").fetchall())
    held = hold(mixed(spark, held, SF))
    words = {k: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for k, r in whole.items()}
    copies = Counter(r.doc_id for r in held.collect())
    assert {k: copies[k] * n for k, n in words.items()} == taken and all(r == whole[r.doc_id] for r in held.collect())
    sizes, by_source = Counter(), defaultdict(int)
    for k, r in whole.items():
        sizes[r.source] += words[k]
        by_source[r.source] += copies[k] * words[k]
    for source, target in brute_targets(dict(sizes)).items():
        assert abs(by_source[source] - target) <= max(n for k, n in words.items() if whole[k].source == source)

    last = sorted((r.doc_id, tuple(r.ids), r.n_tokens, r.round_trip) for r in encoded(spark, held, SF).collect())
    want = [(r.doc_id, tuple(library.encode(r.text, add_special_tokens=False).ids)) for r in held.collect()]
    assert last == sorted((k, ids, len(ids), True) for k, ids in want)
    run = sorted((r.doc_id, tuple(r.ids), r.n_tokens, r.round_trip) for r in corpus_pipeline.run(spark, SF).collect())
    assert run == last


def test_stages_of_no_documents(spark):
    docs = documents(spark, SF).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == [], name
