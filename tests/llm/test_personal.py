"""Personal data: patterns against plain regular expressions, the tagger's gradient, decoding and accuracy on rows it hasn't seen."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import personal, tagger
from tessera.llm.common import documents

from .conftest import ODD, made_up

SF = "/root/testdata/sf0.001"


def luhn(s):
    return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(map(int, reversed(s)))) % 10 == 0


def plain_base(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def test_base_spans():
    r = random.Random(4)
    parts = ["a", "b.c", "@", ".", "%", "+", "-", "_", " ", "1", "12", "255", "256", "0004", "4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (918) 555-3922", "(", "1.2.3.4", "x@y.cz", "é", "\n", "  "]
    for _ in range(4000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 12)))
        assert personal.base_spans(t) == plain_base(t), t


@pytest.mark.parametrize("t", ["a" * 400_000, "1" * 400_000, "a@" * 200_000, "1." * 200_000, "+1 " * 130_000, "1 " * 200_000, "a.b" * 100_000 + "@"])
def test_base_spans_of_long_runs(t):
    personal.base_spans(t)  # at once; the plain patterns take hours for some


def small_model(kinds=2, width=3, seed=0):
    r = np.random.default_rng(seed)
    w = tagger.begin(kinds, width, seed, np.float64)
    w = {k: v + r.normal(0, 0.3, v.shape) for k, v in w.items()}
    return w, r.integers(97, 101, (3, 7)).astype(np.uint8), np.array([[0, 1, 2, 0, 3, 4, 4], [1, 1, 2, 2, 0, 0, 3], [0, 0, 0, 0, 0, 3, 4]])


def test_gradient():
    w, x, y = small_model()
    _, slopes = tagger.loss_and_slopes(w, x, y)
    r = np.random.default_rng(1)
    for name, v in w.items():
        places = [k for k in np.ndindex(v.shape) if name != "gates" or 97 <= k[1] <= 100]
        for at in [places[k] for k in r.integers(0, len(places), 12)]:
            old, losses = v[at], []
            for step in (1e-5, -1e-5):
                v[at] = old + step
                losses.append(tagger.loss_and_slopes(w, x, y)[0])
            v[at] = old
            assert slopes[name][at] == pytest.approx((losses[0] - losses[1]) / 2e-5, abs=1e-6), (name, at)


def plain_states(w, x, d):
    """One row and one direction, cell by cell."""
    width = w["recurrence"].shape[1]
    h, c, out = np.zeros(width), np.zeros(width), []
    logistic = lambda v: 1 / (1 + np.exp(-v))
    for s in x if d == 0 else x[::-1]:
        a = w["gates"][d, s] + h @ w["recurrence"][d]
        i, f, o, g = logistic(a[:width]), logistic(a[width : 2 * width]), logistic(a[2 * width : 3 * width]), np.tanh(a[3 * width :])
        c = f * c + i * g
        h = o * np.tanh(c)
        out.append(h)
    return np.array(out)


def test_decoding_is_the_best_of_all_paths():
    w, x, _ = small_model(kinds=1)
    x = x[:, :6]
    labels, chance = tagger.decode(w, x)
    bad, bad_start = tagger.forbidden(3)
    for k, row in enumerate(x):
        e = plain_states(w, row, 0) @ w["emission"][0] + plain_states(w, row, 1)[::-1] @ w["emission"][1] + w["bias"]
        scores = {}
        for path in itertools.product(range(3), repeat=6):
            if not bad_start[path[0]] and not any(bad[a, b] for a, b in zip(path, path[1:])):
                scores[path] = w["starts"][path[0]] + sum(e[t, p] for t, p in enumerate(path)) + sum(w["moves"][a, b] for a, b in zip(path, path[1:]))
        best = max(scores, key=scores.get)
        assert tuple(labels[k]) == best
        z = sum(np.exp(s) for s in scores.values())
        for t in range(6):
            assert chance[k, t] == pytest.approx(sum(np.exp(s) for p, s in scores.items() if p[t] == best[t]) / z, abs=1e-9)


def test_reconciled_is_the_best_choice():
    r = random.Random(2)
    for _ in range(200):
        spans = [(s, r.randint(0, 3), s + r.randint(1, 8), round(r.random(), 3)) for s in (r.randint(0, 20) for _ in range(r.randint(0, 8)))]
        got = personal.reconciled(spans)
        worth = {}
        for s, k, e, p in spans:
            worth[s, k, e] = max(worth.get((s, k, e), 0), p)
        fits = lambda own: all(a[2] <= b[0] for a, b in zip(sorted(own), sorted(own)[1:]))
        best = max((sum(worth[s] * (s[2] - s[0]) for s in own) for n in range(len(worth) + 1) for own in itertools.combinations(worth, n) if fits(own)), default=0)
        assert fits(got) and sum(worth[s] * (s[2] - s[0]) for s in got) == pytest.approx(best)


@pytest.fixture(scope="module")
def model(spark):
    return personal.fit(documents(spark, SF))


def test_spans_that_no_pattern_finds(model):
    """Made-up entities and likenesses that training hasn't seen, in texts that it hasn't seen either."""
    r = np.random.default_rng(991)
    texts = [t for t in made_up(77, 400, 40) if len(t) > 60]
    found = wanted = wrong = 0
    for k, t in enumerate(texts):
        place = len(t) // 2
        if k % 2:
            kind, entity = personal.made_entity(r)
            text = f"{t[:place]} {entity} {t[place:]}"
            if not personal.base_spans(text):
                wanted += 1
                own = personal.found_spans([text], model)[0]
                found += (place + 1, kind, place + 1 + len(entity)) in own
        else:
            text = f"{t[:place]} {personal.made_likeness(r)} {t[place:]}"
            base = personal.base_spans(text)
            wrong += bool(personal.apart(personal.found_spans([text], model)[0], base))
    assert wanted > 50 and found >= 0.85 * wanted, (found, wanted)
    assert wrong <= 0.03 * len(texts) / 2, wrong


def test_windows_overlap_and_skip_nothing(model):
    entity, found = "(918) 555-3922", 0
    leads = range(8, 400, 7)
    for lead in leads:  # wherever the windows cut
        text = "word " * (lead // 5) + "w" * (lead % 5) + " " + entity + " more words here" * 12
        start = text.index(entity)
        own = personal.found_spans([text], model)[0]
        found += own == [(start, 3, start + len(entity))]
    assert found >= 0.9 * len(leads), found
    long = "word " * 30_000
    assert personal.found_spans([long], model) == [[]] and list(personal.windows(long, tagger.symbols(long))) == []


def expected(rows, model):
    out = []
    for doc_id, t in rows:
        t = t or ""
        base = plain_base(t)
        more = [s for s in (personal.found_spans([t], model)[0] if model else []) if not any(b[0] < s[2] and s[0] < b[2] for b in base)]
        line = lambda spans: ",".join(f"{personal.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
        out.append((doc_id, *(sum(s[1] == k for s in base) for k in range(4)), hashlib.sha256(line(base).encode()).hexdigest(), line(base + more)))
    return sorted(out, key=str)


def test_op11_whole_table(spark, model):
    rows = [(r.doc_id, r.text) for r in documents(spark, SF).collect()]
    want = expected(rows, model)
    assert sorted((tuple(r) for r in personal.op11(spark, SF).collect()), key=str) == want
    assert sum(sum(r[1:5]) for r in want) > 5


def test_op11_odd_rows(spark, odd_documents, tmp_path):
    df = odd_documents.withColumn("spans", F.lit("clash"))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in personal.op11(spark, str(tmp_path)).collect()), key=str)
    assert got == expected([(r.doc_id, r.text) for r in odd_documents.collect()], personal.fit(df))
    assert len(got) == len(ODD) + 4


def test_op11_empty(spark, no_documents, tmp_path):
    no_documents.write.parquet(f"{tmp_path}/documents.parquet")
    assert personal.op11(spark, str(tmp_path)).collect() == []
