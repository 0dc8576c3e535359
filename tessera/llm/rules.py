"""Quality rules, and an isolation forest over their statistics.

Statistics of a text come from Arrow and numpy over batches of texts. The forest isolates documents by
random splits of a few ratios of them: how short the path to a document's leaf is says how anomalous
it is. All labelled documents grow every tree, level by level: tasks say how many rows reach each
node and between which values, the driver draws the splits. The verdict's threshold is calibrated on
all of them too: so high that at most `SPARE` of the good ones that pass the base rules are over it.
What the driver gets is bounded by trees and levels, not by the data; every document's statistics
and path lengths are computed.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import in_chunks
from .common import documents, fresh, save, scratch, trim
from .quality import labelled

TREES = 100
DEPTH = 8
SPARE = 0.002
BINS = 1000
WINDOW = 5
#: Fixed value: signs that count as symbols.
SYMBOLS = r"[#*$%&|<>]"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_capitals", "n_digits"]
STATISTICS = "struct<" + ",".join(f"{c}:bigint" for c in COUNTS + MORE) + ">"


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of each word's spelling, text of each word, code points of each spelling)."""
    split = pc.ascii_split_whitespace(texts)
    ends = split.offsets.to_numpy().astype(np.int64)
    values = split.values.slice(ends[0], ends[-1] - ends[0])
    text = np.repeat(np.arange(len(texts)), np.diff(ends))
    if len(values):
        some = pc.not_equal(values, "")
        values, text = values.filter(some), text[some.to_numpy(zero_copy_only=False)]
    known = values.dictionary_encode()
    return known.indices.to_numpy().astype(np.int64), text, pc.utf8_length(known.dictionary).to_numpy(zero_copy_only=False).astype(np.int64)


def _sorted_groups(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(order, group number along it) of rows, equal rows in one group."""
    order = np.lexsort(columns)
    new = np.zeros(len(order), bool)
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    return order, np.cumsum(new)


def repeated_words(word: np.ndarray, text: np.ndarray, texts: int, window: int = WINDOW) -> np.ndarray:
    """Words of each text that lie in a window of `window` words found twice or more in it."""
    starts = np.flatnonzero(text[: len(text) - window + 1] == text[window - 1 :]) if len(word) >= window else np.zeros(0, np.int64)
    if not len(starts):
        return np.zeros(texts, np.int64)
    columns, packed, bits = [], text[starts], 21
    if max(int(word.max()), texts) < 1 << bits:  # three numbers fit into 63 bits
        parts = [packed, *(word[starts + k] for k in range(window))]
        for k in range(0, len(parts), 3):
            key = np.zeros(len(starts), np.int64)
            for p in parts[k : k + 3]:
                key = key << bits | p
            columns.append(key)
    else:
        columns = [packed, *(word[starts + k] for k in range(window))]
    order, group = _sorted_groups(columns)
    twice = np.bincount(group)[group] > 1
    step = np.zeros(len(word) + 1, np.int64)
    step += np.bincount(starts[order[twice]], minlength=len(word) + 1)
    step -= np.bincount(starts[order[twice]] + window, minlength=len(word) + 1)[: len(word) + 1]
    return np.bincount(text[np.cumsum(step)[:-1] > 0], minlength=texts)


def _distinct(text: np.ndarray, value: np.ndarray, texts: int) -> np.ndarray:
    """Distinct values of each text."""
    pairs = np.unique(text << 40 | value)
    return np.bincount(pairs >> 40, minlength=texts)


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts COUNTS and MORE of each text; null counts as empty."""
    texts = texts.fill_null("")
    n = len(texts)
    out = {}
    word, text, sizes = _words(texts)
    out["n_words"] = np.bincount(text, minlength=n)
    long = lambda x: x.cast(pa.int64()).to_numpy(zero_copy_only=False)
    out["word_chars"] = np.bincount(text, sizes[word], n).astype(np.int64)
    out["n_symbols"] = long(pc.count_substring_regex(texts, SYMBOLS))
    cut = pc.split_pattern(texts, "\n")
    ends = cut.offsets.to_numpy().astype(np.int64)
    lines = cut.values.slice(ends[0], ends[-1] - ends[0]).dictionary_encode()
    of = np.repeat(np.arange(n), np.diff(ends))
    filled = pc.match_substring_regex(lines.dictionary, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    number = lines.indices.to_numpy().astype(np.int64)
    real = filled[number] if len(number) else np.zeros(0, bool)
    out["n_dup_lines"] = np.bincount(of[real], minlength=n) - _distinct(of[real], number[real], n)
    out["n_repeat_words"] = repeated_words(word, text, n)
    out["n_lines"] = np.bincount(of[real], minlength=n)
    out["n_capitals"] = long(pc.count_substring_regex(texts, "[A-Z]"))
    out["n_digits"] = long(pc.count_substring_regex(texts, "[0-9]"))
    return out


def statistics():
    """Column function text -> struct of the counts."""

    @F.arrow_udf(STATISTICS)
    def own(texts: pa.Array) -> pa.Array:
        parts = [measure(part) for part in in_chunks(texts)]
        del texts
        trim()
        return pa.StructArray.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *(p[c] for p in parts)])) for c in COUNTS + MORE], names=COUNTS + MORE)

    return own


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Ratios of the counts, a row for each text, none of which grows with its length."""
    c = {k: np.asarray(v, np.float64) for k, v in counts.items()}
    words, chars, lines = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1), np.maximum(c["n_lines"], 1)
    return np.stack([c["n_symbols"] / words, c["n_dup_lines"] / lines, c["n_repeat_words"] / words, c["n_capitals"] / chars, c["n_digits"] / chars, c["word_chars"] / words], 1)


class Forest:
    """Isolation trees as arrays: feature (-1 at a leaf), split, left child (right is the next), length at a leaf.

    Every row goes into every tree. A level needs no more of the rows than `summary` says of the
    nodes that the level before left open, and summaries of parts of the rows can be put together.
    """

    def __init__(self, rows: np.ndarray | None = None, trees: int = TREES, depth: int = DEPTH, seed: int = 7) -> None:
        self.trees = [(np.full(1, -1), np.zeros(1), np.zeros(1, np.int64), np.zeros(1)) for _ in range(trees)]
        self.open = [0] * trees  # the nodes from this one on have yet to be split or closed
        self.unit = 0.0
        if rows is not None:
            self.grow(lambda: self.summary(rows), depth, seed)

    @staticmethod
    def expected(n: int) -> float:
        """Mean path length of a failed search in a binary tree of n."""
        return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n

    def grow(self, look: Callable[[], tuple[np.ndarray, np.ndarray, np.ndarray]], depth: int = DEPTH, seed: int = 7) -> None:
        """Trees of at most `depth` levels; look() is the `summary` of all rows. Fewer than two rows give no trees."""
        random = np.random.default_rng(seed)
        for level in range(depth + 1):
            n, low, high = look()
            if not level:
                self.unit = self.expected(int(n[0]))
                if n[0] < 2:
                    self.trees, self.open = [], []
            at = 0
            for t, (feature, split, child, length) in enumerate(self.trees):
                first, size = self.open[t], len(feature)
                for node in range(first, len(feature)):
                    wide = np.flatnonzero(high[at] > low[at])
                    if level < depth and len(wide):
                        f = int(random.choice(wide))
                        feature[node], split[node], child[node] = f, random.uniform(low[at, f], high[at, f]), size
                        size += 2
                    else:
                        length[node] = level + self.expected(int(n[at]))
                    at += 1
                more = np.zeros(size - len(feature))
                self.trees[t] = (np.append(feature, more.astype(np.int64) - 1), np.append(split, more), np.append(child, more.astype(np.int64)), np.append(length, more))
                self.open[t] = len(feature)
            if all(first == len(tree[0]) for first, tree in zip(self.open, self.trees)):
                break

    @staticmethod
    def leaves(tree: tuple[np.ndarray, ...], rows: np.ndarray) -> np.ndarray:
        """The node in which each row ends."""
        feature, split, child, _ = tree
        at = np.zeros(len(rows), np.int64)
        while True:
            inner = np.flatnonzero(feature[at] >= 0)
            if not len(inner):
                return at
            here = at[inner]
            at[inner] = child[here] + (rows[inner, feature[here]] > split[here])

    def summary(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of rows, smallest and largest value of each feature) in the open nodes, tree after tree."""
        total = sum(len(tree[0]) - first for first, tree in zip(self.open, self.trees))
        n, low, high = np.zeros(total, np.int64), np.full((total, rows.shape[1]), np.inf), np.full((total, rows.shape[1]), -np.inf)
        base = 0
        for first, tree in zip(self.open, self.trees):
            node = self.leaves(tree, rows) - first
            order = np.argsort(node, kind="stable")
            order = order[np.searchsorted(node[order], 0) :]
            if len(order):
                own, starts, counts = np.unique(node[order], return_index=True, return_counts=True)
                n[base + own] = counts
                low[base + own], high[base + own] = np.minimum.reduceat(rows[order], starts), np.maximum.reduceat(rows[order], starts)
            base += len(tree[0]) - first
        return n, low, high

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly of each row, 0 to 1: 2 to the power of minus its mean path length over the expected one."""
        total = np.zeros(len(rows))
        for tree in self.trees:
            total += tree[3][self.leaves(tree, rows)]
        return 2.0 ** (-total / (max(len(self.trees), 1) * (self.unit or 1.0)))


def ratios(batch: pa.RecordBatch) -> np.ndarray:
    """The features of rows of counts."""
    return features({c: batch.column(c).to_numpy(zero_copy_only=False) for c in COUNTS + MORE})


def grown(counts: DataFrame) -> Forest:
    """A forest of all rows of counts: one job a level, in which tasks sum up their rows by node."""
    forest, wide = Forest(), range(features(dict.fromkeys(COUNTS + MORE, np.zeros(0))).shape[1])
    names = ["node", "n", *(f"low{k}" for k in wide), *(f"high{k}" for k in wide)]
    types = ", ".join(f"{c} {'long' if c in ('node', 'n') else 'double'}" for c in names)

    def look() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shared = counts.sparkSession.sparkContext.broadcast(forest)

        def own(batches):
            total = None
            for batch in batches:
                new = shared.value.summary(ratios(batch))
                total = new if total is None else tuple(f(x, y) for f, x, y in zip((np.add, np.minimum, np.maximum), total, new))
            if total is not None:
                n, low, high = total
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (some, n[some], *low[some].T, *high[some].T)], names=names)

        parts = [F.sum("n"), *(F.min(f"low{k}") for k in wide), *(F.max(f"high{k}") for k in wide)]
        found = counts.mapInArrow(own, types).groupBy("node").agg(*parts).collect()  # a row for each open node
        shared.destroy()
        n, low, high = forest.summary(np.zeros((0, len(wide))))
        for node, count, *values in found:
            n[node], low[node], high[node] = count, values[: len(wide)], values[len(wide) :]
        return n, low, high

    forest.grow(look)
    return forest


def ranked(df: DataFrame, column: str, share: float) -> float | None:
    """Of a column's n doubles in ascending order the one at place ceil((n - 1) * share), counted from 0; None without any.

    Exact: a round counts the values still in question by `BINS` ranges, and one range is left.
    """
    n, low, high = df.agg(F.count(column), F.min(column), F.max(column)).first()
    rank = math.ceil((n - 1) * share)
    while n and low < high:
        bins = F.floor((F.col(column) - low) / (high - low) * BINS)
        rows = df.where(F.col(column).between(low, high)).groupBy(bins.alias("bin")).agg(F.count("*").alias("n"), F.min(column), F.max(column))
        for _, count, low, high in sorted(map(tuple, rows.collect())):
            if rank < count:
                break
            rank -= count
    return low


def fit(df: DataFrame, labels: DataFrame, sample: int | None = None, spare: float = SPARE, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> tuple[Forest, float]:
    """(forest, threshold) from all labelled rows of df; from at most `sample` of them where a caller sets that.

    The threshold is the anomaly that a share `spare` of the rows labelled 1 that pass the base rules
    exceeds. Of several labels of a doc_id the larger counts, null ones and those without a document
    don't. Without such rows nothing is over it.
    """
    given = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg(F.max(label).alias("label"))
    rows = labelled(df, given, sample, doc_id, text).select("label", statistics()(F.col("text")).alias("s")).select("label", "s.*")
    with scratch(df.sparkSession):
        counts, _ = save(rows, "rules-counts")
        forest = grown(counts)
        good = counts.where((F.col("label") == 1) & ~base_failed(F.col("n_words"), F.col("n_repeat_words")))
        scored, _ = save(good.select(judge(df.sparkSession, forest)(*COUNTS, *MORE).alias("anomaly")), "rules-anomalies")
        threshold = ranked(scored, "anomaly", 1 - spare)
    return forest, 1.0 if threshold is None else threshold


def judge(spark: SparkSession, forest: Forest):
    """Column function counts -> the anomaly."""
    shared = spark.sparkContext.broadcast(forest)

    @F.arrow_udf("double")
    def own(*counts: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(ratios(pa.RecordBatch.from_arrays(list(counts), names=COUNTS + MORE))))

    return own


def judged(spark: SparkSession, forest: Forest):
    """Column function text -> struct of the counts and the anomaly, in one pass."""
    shared = spark.sparkContext.broadcast(forest)

    @F.arrow_udf(STATISTICS[:-1] + ",anomaly:double>")
    def own(texts: pa.Array) -> pa.Array:
        parts = [measure(part) for part in in_chunks(texts)]
        del texts
        trim()
        counts = {c: np.concatenate([np.zeros(0, np.int64), *(p[c] for p in parts)]) for c in COUNTS + MORE}
        return pa.StructArray.from_arrays([*map(pa.array, counts.values()), pa.array(shared.value.scores(features(counts)))], names=[*counts, "anomaly"])

    return own


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 10) | (100 * n_repeat_words > 20 * n_words)


def apply_rules(df: DataFrame, labels: DataFrame, sample: int | None = None, spare: float = SPARE, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """df with the counts, base_failed, anomaly and kept; columns of those names are replaced.

    kept is false for rows that fail the base rules and for those whose anomaly is over the calibrated
    threshold. Null and empty texts have no words and fail the base rules. Every row is judged by its
    whole text; repeated rows alike; an empty table gives an empty one.
    """
    forest, threshold = fit(df, labels, sample, spare, doc_id, text, label)
    found = fresh(df, "found")[0]
    done = df.withColumn(found, judged(df.sparkSession, forest)(F.col(text)))
    done = done.withColumns({c: F.col(f"{found}.{c}") for c in [*COUNTS, "anomaly"]}).drop(found)
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return done.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") <= threshold))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's rule counts and verdict."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return apply_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select("doc_id", *COUNTS, "base_failed", "kept", "anomaly")
