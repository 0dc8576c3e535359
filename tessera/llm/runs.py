"""Periodic runs of words, by branching tandem repeats in a suffix tree.

The words of a batch of texts get a suffix array by prefix doubling (all texts at once, no suffix
going beyond its text) and from it the nodes of the suffix tree as LCP intervals. At each node of
depth q, the leaves of all children but the largest are looked at: a leaf i whose partner i + q (or
i - q) hangs below the same node by another child is a tandem repeat that the next word breaks. By
the smaller half, a leaf is looked at once for each halving of its node: n log n in all. Each such
repeat is rotated to the left as long as the period holds; all rotations of one make a maximal run.

A text in which no five words stand twice can't hold a run of at least max(6, 4 q) words (its words
from the start and from q on agree in five or more), so no tree is built for it.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import in_chunks
from .common import documents, fresh, trim

#: Least words of a run, and least number of its periods.
LEAST, TIMES = 6, 4
#: Words that must stand twice in a text that holds a run: LEAST - 1 for a period of one word, more for others.
SEED = min(max(LEAST, TIMES * q) - q for q in range(1, LEAST + 1))
#: Leaves that are looked at in one step.
LEAVES = 2_000_000
RESULT = "struct<runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>"


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words of all texts, bounds): text k has those from bounds[k] to bounds[k + 1]; null is empty."""
    split = pc.ascii_split_whitespace(texts.fill_null(""))
    ends = split.offsets.to_numpy().astype(np.int64)
    values = split.values.slice(ends[0], ends[-1] - ends[0])
    some = pc.not_equal(values, "")
    before = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
    return values.filter(some), before[ends - ends[0]]


def may_repeat(word: np.ndarray, text: np.ndarray, texts: int, seed: int = SEED) -> np.ndarray:
    """Which texts hold some `seed` words twice; now and then one more, where two hashes agree."""
    found = np.zeros(texts, bool)
    if len(word) < seed:
        return found
    mixed = np.zeros(len(word) - seed + 1, np.uint64)
    for k in range(seed):
        mixed = (mixed ^ word[k : k + len(mixed)].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    inside = text[: len(mixed)] == text[seed - 1 :]
    bits = np.uint64(max(1, int(texts - 1).bit_length()))
    key = np.sort((mixed[inside] << bits) | text[: len(mixed)][inside].astype(np.uint64))
    twice = key[1:][key[1:] == key[:-1]]
    found[(twice & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)] = True
    return found


def suffixes(word: np.ndarray, text: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(suffix array, levels): levels[k][i] is the place of the first suffix with the 2 ** k words at i; suffixes of different texts share nothing."""
    n = len(word)
    key = text * (int(word.max()) + 1) + word
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = np.arange(n)
    rank, levels, width = np.zeros(n, np.int64), [], 1
    while True:
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[order[at]] = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        levels.append(rank.astype(np.int32 if n < 1 << 31 else np.int64))
        alone = new & np.concatenate([new[1:], [True]])
        at = at[~alone]  # what others still share, place by place; groups stay together
        if not len(at):
            return order, levels
        own = order[at]
        ahead = own + width
        key = rank[own] * (n + 1) + np.where(ahead < end[own], rank[np.minimum(ahead, n - 1)] + 1, 0)
        inner = np.argsort(key, kind="stable")
        order[at], key = own[inner], key[inner]
        width *= 2


def common(levels: list[np.ndarray], end: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Words that the suffixes i and j of one text have in common, from the widest level down."""
    n, length = len(end), np.zeros(len(i), np.int64)
    for k in reversed(range(len(levels))):
        a, b = i + length, j + length
        inside = (a < end[i]) & (b < end[j])
        same = levels[k][np.minimum(a, n - 1)] == levels[k][np.minimum(b, n - 1)]
        length[inside & same] += 1 << k
    return length


def tree(shared: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Inner nodes (depth, first, end) over the suffix array, and the node that each boundary cuts (-1: the root).

    shared[p]: words that the suffixes at p - 1 and p have in common.
    """
    depth, first, end, stack = [], [], [], []
    cut = [-1] * len(shared)
    for p, d in enumerate([*shared[1:], 0], 1):
        low = p - 1
        while stack and depth[stack[-1]] > d:
            v = stack.pop()
            end[v], low = p, first[v]
        if d:
            if not stack or depth[stack[-1]] < d:
                stack.append(len(depth))
                depth.append(d), first.append(low), end.append(0)
            cut[p] = stack[-1]
    return tuple(np.array(x, np.int64) for x in (depth, first, end, cut))


def branching(order: np.ndarray, end: np.ndarray, begin: np.ndarray, nodes: tuple, leaves: int = LEAVES) -> np.ndarray:
    """(start, period) of all branching tandem repeats: rows in order of their end, then period."""
    depth, first, last, cut = nodes
    inverse = np.empty(len(order), np.int64)
    inverse[order] = np.arange(len(order))
    at = np.flatnonzero(cut >= 0)
    node = np.concatenate([np.arange(len(depth)), cut[at]])  # each node's children begin at its first leaf and at each boundary
    low = np.concatenate([first, at])
    by_node = np.lexsort((low, node))
    node, low = node[by_node], low[by_node]
    ends_here = np.concatenate([node[1:] != node[:-1], [True]])[: len(node)]
    high = np.where(ends_here, last[node], np.concatenate([low[1:], [0]])[: len(node)])
    size = high - low
    by_size = np.lexsort((-size, node))  # the first child of each node in this order is its largest
    largest = by_size[np.concatenate([[True], node[1:] != node[:-1]])[: len(node)]]
    small = np.setdiff1d(np.arange(len(node)), largest)
    found = []
    total = np.cumsum(size[small])
    step = 0
    while step < len(small):
        to = max(step + 1, int(np.searchsorted(total, (total[step - 1] if step else 0) + leaves, "right")))
        child = np.repeat(small[step:to], size[small[step:to]])
        place = np.arange(len(child)) - np.repeat(np.cumsum(size[small[step:to]]) - size[small[step:to]], size[small[step:to]]) + low[child]
        i, q, v = order[place], depth[node[child]], node[child]
        for sign in (1, -1):
            j = i + sign * q
            inside = (j < end[i]) & (j >= begin[i])
            r = inverse[np.where(inside, j, 0)]
            hit = inside & (r >= first[v]) & (r < last[v]) & ~((r >= low[child]) & (r < high[child]))
            found.append(np.stack([np.minimum(i, j)[hit], q[hit]], 1))
        step = to
    pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
    return pairs[np.lexsort((pairs[:, 1], pairs[:, 0] + 2 * pairs[:, 1]))]


def rotated(word: np.ndarray, start: int, period: int, begin: int) -> int:
    """Where the leftmost rotation of a repeat starts: as far to the left as the period holds."""
    step = 64
    while start > begin:
        low = max(begin, start - step)
        broken = np.flatnonzero(word[low:start] != word[low + period : start + period])
        if len(broken):
            return low + int(broken[-1]) + 1
        start, step = low, step * 2
    return start


def find_runs(word: np.ndarray, bounds: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Maximal runs of at least max(least, times * period) words, rows (start, length, period); times is 2 or more.

    word: numbers of spellings; bounds: where each text begins, and the end. Memory is about 30 longs
    for each word of the texts that hold a seed twice, and one int for each of them and level.
    """
    texts = len(bounds) - 1
    text = np.repeat(np.arange(texts), np.diff(bounds))
    seed = min(max(least, times * q) - q for q in range(1, least + 1))
    kept = may_repeat(word, text, texts, seed)
    some = kept[text]
    if not some.any():
        return np.zeros((0, 3), np.int64)
    origin = np.flatnonzero(some)
    word, text = word[some].astype(np.int64), text[some]
    size = np.diff(bounds)[kept]
    ends = np.cumsum(size)
    end, begin = np.repeat(ends, size), np.repeat(ends - size, size)
    order, levels = suffixes(word, text, end)
    shared = np.concatenate([[0], common(levels, end, order[:-1], order[1:])])
    repeats = branching(order, end, begin, tree(shared.tolist()))
    stop, q = repeats[:, 0] + 2 * repeats[:, 1], repeats[:, 1]
    need = np.maximum(least, times * q)
    from_ = stop - need
    long = (from_ >= begin[repeats[:, 0]]) if len(repeats) else np.zeros(0, bool)
    repeats, stop, q, need, from_ = repeats[long], stop[long], q[long], need[long], from_[long]
    long = common(levels, end, from_, from_ + q) >= need - q
    out: list[tuple[int, int, int]] = []
    here, starts = -1, []
    for e, p, s in zip(stop[long].tolist(), q[long].tolist(), from_[long].tolist()):
        if e != here:
            here, starts = e, []
        # a repeat within a run of a smaller period that ends here too has a multiple of that period: the same run
        if any(s >= x for x in starts):
            continue
        start = rotated(word, s, p, int(begin[s]))
        starts.append(start)
        out.append((int(origin[start]), e - start, p))
    return np.array(sorted(out, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def runs_and_rest(texts: pa.Array) -> pa.Array:
    """RESULT of each text."""
    words, bounds = words_of(texts)
    known = words.dictionary_encode()
    found = find_runs(known.indices.to_numpy().astype(np.int64), bounds)
    text = np.searchsorted(bounds, found[:, 0], "right") - 1
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, found[:, 0] + found[:, 2], 1)
    np.add.at(step, found[:, 0] + found[:, 1], -1)
    kept = np.cumsum(step)[:-1] == 0
    ends = np.concatenate([[0], np.cumsum(kept)])[bounds]
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words.filter(pa.array(kept))), " ")
    rows = pa.StructArray.from_arrays([pa.array(found[:, 0] - bounds[text]), pa.array(found[:, 1]), pa.array(found[:, 2])], ["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(texts) + 1)), pa.int32()), rows)
    return pa.StructArray.from_arrays([lists, collapsed], ["runs", "collapsed"])


def collapse(df: DataFrame, text: str = "text") -> DataFrame:
    """df with runs and collapsed; columns of those names are replaced.

    runs: maximal periodic stretches of words of at least max(6, 4 periods) words, as array of
    struct(start, length, period) in words, by start, then period. collapsed: the words that no run
    holds after its first period, joined by one space. Null and empty texts have no runs and collapse to an
    empty text; repeated rows give the same; an empty table gives an empty one. Texts are taken whole, however long.
    """

    @F.arrow_udf(RESULT)
    def own(texts: pa.Array) -> pa.Array:
        parts = [runs_and_rest(part) for part in in_chunks(texts, 3_000_000)]
        del texts
        trim()
        return pa.concat_arrays(parts) if parts else runs_and_rest(pa.array([], pa.string()))

    name = fresh(df, "found")[0]
    done = df.withColumn(name, own(F.col(text)))
    return done.withColumns({"runs": F.col(f"{name}.runs"), "collapsed": F.col(f"{name}.collapsed")}).drop(name)


def tail_made_periodic(h: int, words: list[str]) -> list[str]:
    """The words with those from some place on made periodic, as an id's crc32 says."""
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def altered():
    """Column function (doc_id, text) -> the text, in one of ten with a periodic tail; a null id leaves it, null stays null."""

    @F.arrow_udf("string")
    def own(ids: pa.Array, texts: pa.Array) -> pa.Array:
        chosen = {}
        for k, x in enumerate(ids.to_pylist()):
            h = 1 if x is None else crc32(str(x).encode())
            if h % 10 == 0:
                words = words_of(texts.slice(k, 1))[0].to_pylist()
                if words:
                    chosen[k] = " ".join(tail_made_periodic(h, words))
        if not chosen:
            return texts
        mask = np.zeros(len(texts), bool)
        mask[list(chosen)] = True
        return pc.replace_with_mask(texts, pa.array(mask), pa.array(list(chosen.values()), texts.type))

    return own


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's runs, the longest of them, and what stays once they are collapsed."""
    docs = documents(spark, sf_dir).select("doc_id", altered()(F.col("doc_id"), F.col("text")).alias("text"))
    rank = lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))
    line = lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")])
    found = collapse(docs).withColumn("best", F.array_max(F.transform("runs", rank)))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
