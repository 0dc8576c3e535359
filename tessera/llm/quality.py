"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

A text's words give four kinds of n-grams: words, pairs of words, shapes of words (runs of capitals,
small letters, digits and signs) and pairs of shapes; a word that follows itself makes one and the
same pair. They are hashed into `WIDTH` places and weigh their share of the text's n-grams of the kind, so a score is the
logistic function of a sparse dot product with one weight a place.

Training takes at most `SAMPLE` labelled rows (those with the smallest hashes of doc_id), whose counts
of places come to the driver: the bound doesn't grow with the data. Scoring covers every row.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import in_chunks
from .common import documents, trim

WIDTH = 1 << 16
KINDS = 4
SAMPLE = 4000
ROUNDS = 6
CUT = 0.3

_CAPITALS, _SMALL, _DIGITS, _SIGNS = re.compile(r"[A-Z]{2,}"), re.compile(r"[^\W\d_]+"), re.compile(r"\d+"), re.compile(r"(.)\1\1+")


def shape(word: str) -> str:
    """A word with its runs of letters and digits shortened."""
    return _SIGNS.sub(r"\1\1", _DIGITS.sub("0", _SMALL.sub(lambda m: "AA" if len(m[0]) > 1 and m[0].isupper() else "A" if m[0][0].isupper() else "a", word)))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _place(x: np.ndarray) -> np.ndarray:
    return (_mix(x) >> np.uint64(48)).astype(np.int64)


def places(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, share, ends): n-grams of each text; text k has those from ends[k] to ends[k + 1]."""
    from xxhash import xxh64_intdigest

    split = pc.utf8_split_whitespace(texts.fill_null(""))
    ends = split.offsets.to_numpy().astype(np.int64)
    words = split.values.slice(ends[0], ends[-1] - ends[0]).dictionary_encode()
    ends = ends - ends[0]
    known = words.dictionary.to_pylist()
    index = words.indices.to_numpy()
    own = np.fromiter((xxh64_intdigest(w, 1) for w in known), np.uint64, len(known))[index] if len(known) else np.zeros(0, np.uint64)
    forms = np.fromiter((xxh64_intdigest(shape(w), 2) for w in known), np.uint64, len(known))[index] if len(known) else np.zeros(0, np.uint64)
    n = np.diff(ends)
    first = np.zeros(len(own), bool)
    first[ends[:-1][n > 0]] = True

    def before(x: np.ndarray) -> np.ndarray:
        """What stands before each, a fixed value at the start of a text."""
        out = np.concatenate([[np.uint64(0)], x[:-1]]) if len(x) else x
        return np.where(first, np.uint64(7), out)

    pairs = _mix(before(own)) + own
    pairs[(before(own) == own)] = np.uint64(11)
    grams = np.stack([_place(own), _place(pairs), _place(forms), _place(_mix(before(forms)) + forms + np.uint64(3))], 1)
    share = np.repeat(1 / np.maximum(n, 1), n)
    return grams.ravel(), np.repeat(share, KINDS), ends * KINDS


def _counts():
    """Column function text -> the distinct places (16 bits) and their shares (32 bits), in binary."""

    @F.arrow_udf("binary")
    def own(texts: pa.Array) -> pa.Array:
        out = []
        for part in in_chunks(texts):
            place, share, ends = places(part)
            for a, b in zip(ends[:-1], ends[1:]):
                at, where = np.unique(place[a:b], return_inverse=True)
                out.append(at.astype("<u2").tobytes() + np.bincount(where, share[a:b], len(at)).astype("<f4").tobytes())
        return pa.array(out, pa.binary())

    return own


def train(rows: list[tuple[bytes, int]], rounds: int = ROUNDS, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02) -> np.ndarray:
    """Weights, the last one the constant, by FTRL-proximal updates over rows of (counts, label)."""
    z, n = np.zeros(WIDTH + 1), np.zeros(WIDTH + 1)

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(rounds):
        for data, label in rows:
            k = len(data) // 6
            at = np.append(np.frombuffer(data[: 2 * k], "<u2").astype(np.int64), WIDTH)
            x = np.append(np.frombuffer(data[2 * k :], "<f4").astype(np.float64), 1.0)
            own_z, own_n = z[at], n[at]
            w = weights(own_z, own_n)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - label) * x
            z[at] = own_z + g - (np.sqrt(own_n + g * g) - np.sqrt(own_n)) / alpha * w
            n[at] = own_n + g * g
    return weights(z, n)


def scorer(spark: SparkSession, weights: np.ndarray):
    """Column function text -> score; null and empty texts get the constant's."""
    shared = spark.sparkContext.broadcast(weights)

    @F.arrow_udf("double")
    def own(texts: pa.Array) -> pa.Array:
        w = shared.value
        out = []
        for part in in_chunks(texts):
            place, share, ends = places(part)
            sums, some = np.zeros(len(part)), ends[1:] > ends[:-1]
            if some.any():
                sums[some] = np.add.reduceat(w[place] * share, ends[:-1][some])
            out.append(1 / (1 + np.exp(-(sums + w[WIDTH]))))
        del texts
        trim()
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return own


def held_out(doc_id: Column) -> Column:
    """Rows that labels are never learnt from; a null doc_id is among them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def labelled(df: DataFrame, given: DataFrame, sample: int | None, doc_id: str, text: str) -> DataFrame:
    """(id, label, text) of the labels given(id, label) that have a document in df: all, or the `sample` of the smallest hashes.

    Of several documents of an id the smallest text is taken.
    """
    if sample is not None:
        ids = df.select(F.col(doc_id).alias("id"))
        given = F.broadcast(given.join(ids, "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(sample))  # `sample` rows are broadcast
    texts = df.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return texts.join(given, "id").groupBy("id", "label").agg(F.min("text").alias("text"))


def fit(df: DataFrame, labels: DataFrame, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> np.ndarray:
    """Weights learnt from at most `sample` rows with labels 0 or 1, held-out ones excepted.

    Of several labels of a doc_id the larger counts; labels that are null, neither 0 nor 1, or without
    a document are left out, and don't count in `sample`. Without any row to learn from, all weights are
    zero (every score 0.5).
    """
    given = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).where(F.col("label").isin(0, 1) & ~held_out(F.col("id")))
    given = given.groupBy("id").agg(F.max("label").alias("label"))
    rows = labelled(df, given, sample, doc_id, text).select("id", _counts()(F.col("text")).alias("counts"), "label")
    found = sorted((tuple(r) for r in rows.collect()), key=lambda r: (hash_order(r[0]), r[1]))  # at most `sample` rows
    return train([(data, y) for _, data, y in found])


def hash_order(k: int) -> int:
    """An order that has nothing to do with the ids' own."""
    return (k * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64


def classify(df: DataFrame, labels: DataFrame, cut: float = CUT, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """df with held_out, score (chance of label 1) and predicted (1 if score >= cut); columns of those names are replaced.

    Every row is scored from its whole text alone; see `fit` for what the labels may be. Repeated rows
    score alike; an empty table gives an empty one.
    """
    weights = fit(df, labels, sample, doc_id, text, label)
    done = df.withColumns({"held_out": held_out(F.col(doc_id)), "score": scorer(df.sparkSession, weights)(F.col(text))})
    return done.withColumn("predicted", F.when(F.col("score") >= cut, 1).otherwise(0))


def accepted(df: DataFrame, labels: DataFrame, cut: float = CUT, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """The rows of df with a score of at least cut, with df's columns as they are, whatever their names.

    Null and empty texts have the score of the weights' constant; repeated rows go or stay together.
    """
    weights = fit(df, labels, sample, doc_id, text, label)
    return df.where(scorer(df.sparkSession, weights)(F.col(text)) >= cut)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select("doc_id", "held_out", "score", "predicted")
