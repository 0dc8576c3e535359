"""SimHash near-duplicates, compared bit-sliced.

Fingerprints that differ in at most `radius` of 64 bits agree in at least `agree` of radius + agree
blocks of bits, so every choice of `agree` blocks is a key and only fingerprints that share a key are
compared. Copies share one fingerprint, which is compared once. A key that very many fingerprints share
is cut into groups of about `GROUP`, and every two groups meet in a tile of their own. With radius 3
and agree 2 a key has 25 bits, so n different fingerprints meet about n * n / 7,000,000 times in all
(10 ** 11 comparisons, 64 at a time, for 10 ** 9); agree 3 has 32 bits in 20 keys and meets a sixtieth
as often: take it beyond 10 ** 9. No choice loses a link.

Inside a tile the fingerprints stand as bit planes (one bit of 64 fingerprints in a word). Planes are
compared with the query's bits and added, three at a time, by carry-save adders into counters that lie
vertically too; a query leaves a block as soon as all of the block is beyond the radius. A tile returns
a spanning forest of its links, not the pairs. `similar.py` compares wider fingerprints by the same
planes and counters where near duplicates are texts of a given similarity.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import components, documents, fresh, row_hash, save, settled, spanning_forest, trim

SHINGLE = 3
RADIUS = 3
#: Fingerprints of a key that one task compares with each other; more are cut into tiles.
GROUP = 4096
ONES = np.uint64(2**64 - 1)


def shingle_hashes(data: bytes, shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of the word shingles of UTF-8 text, repeats included."""
    from xxhash import xxh64_intdigest

    words = data.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxh64_intdigest(line, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    cuts = [line[a:b] for a, b in zip(starts[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist())]
    return np.fromiter(map(xxh64_intdigest, cuts, repeat(42)), np.uint64, len(cuts))


def fingerprint(hashes: np.ndarray) -> int:
    """The bits set in more than half of the hashes."""
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(shingle: int = SHINGLE):
    """Column function binary text -> fingerprint as long; null gives that of no words, zero."""

    @F.arrow_udf("long")
    def own(texts: pa.Array) -> pa.Array:
        found = [fingerprint(shingle_hashes(t.as_buffer().to_pybytes(), shingle)) if t.is_valid else 0 for t in texts]
        del texts
        trim()
        return pa.array(np.array(found, np.uint64).view(np.int64))

    return own


def planes(values: np.ndarray) -> np.ndarray:
    """(bits, words) planes of (n,) or (n, k) values of 64 or 64 * k bits: bit j of 64 values in a word."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1)
    bits = np.zeros((-(-len(values) // 64) * 64, 8 * raw.shape[1]), np.uint8)
    bits[: len(values)] = np.unpackbits(raw, axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


class Counter:
    """Vertical counts of set bits. `over` has a bit for each count beyond the radius.

    Counters begin at 2 ** bits - 1 - radius, so it is their carry out that says so.
    """

    def __init__(self, shape: tuple[int, ...], radius: int) -> None:
        start = (1 << radius.bit_length()) - 1 - radius
        self.digits = [np.full(shape, ONES if start >> k & 1 else np.uint64(0)) for k in range(radius.bit_length())]
        self.over = np.zeros(shape, np.uint64)

    def put(self, level: int, bits: np.ndarray) -> None:
        """Add a plane of weight 2 ** level."""
        for k in range(level, len(self.digits)):
            bits, self.digits[k] = self.digits[k] & bits, self.digits[k] ^ bits
        self.over |= bits

    def add(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> None:
        """Add three planes of weight one: a carry-save adder makes one of weight one and one of two of them."""
        half = a ^ b
        self.put(0, half ^ c)
        self.put(1, (a & b) | (c & half))

    def take(self, stay: np.ndarray) -> None:
        self.digits, self.over = [d[stay] for d in self.digits], self.over[stay]


def near(queries: np.ndarray, own: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(which queries have any, words of bits for these): values in the planes `own` within radius of a query."""
    left = np.arange(len(queries))
    bits = np.unpackbits(np.ascontiguousarray(queries).view(np.uint8).reshape(len(queries), -1), axis=1, bitorder="little")
    masks = np.where(bits.T, ONES, np.uint64(0))
    count = Counter((len(queries), own.shape[1]), radius)
    none = np.zeros_like(count.over)
    for k in range(0, len(own), 3):
        trio = [own[j][None, :] ^ masks[j][:, None] if j < len(own) else none[: len(left)] for j in (k, k + 1, k + 2)]
        count.add(*trio)
        if k % 12 == 9:
            stay = (count.over != ONES).any(1)
            if not stay.all():
                left, masks = left[stay], masks[:, stay]
                count.take(stay)
            if not len(left):
                break
    return left, ~count.over


def close(queries: np.ndarray, block: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (query, block) of values that differ in at most radius bits."""
    own = planes(block)
    q_out, b_out = [], []
    for w in range(0, own.shape[1], 16):
        for at in range(0, len(queries), 256):
            left, words = near(queries[at : at + 256], own[:, w : w + 16], radius)
            if len(left):
                q, b = np.nonzero(np.unpackbits(words.view(np.uint8), axis=1, bitorder="little"))
                b += 64 * w
                real = b < len(block)
                q_out.append(at + left[q[real]])
                b_out.append(b[real])
    return (np.concatenate(q_out), np.concatenate(b_out)) if q_out else (np.zeros(0, np.int64),) * 2


def close_rows(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Which a[k], b[k] differ in at most radius bits: planes of the differences, counted vertically."""
    own = planes(a ^ b)
    count = Counter((own.shape[1],), radius)
    zero = np.zeros(own.shape[1], np.uint64)
    for k in range(0, len(own), 3):
        count.add(*[own[j] if j < len(own) else zero for j in (k, k + 1, k + 2)])
        if k % 12 == 9 and (count.over == ONES).all():
            return np.zeros(len(a), bool)
    return np.unpackbits((~count.over).view(np.uint8), bitorder="little")[: len(a)].astype(bool)


def _tiles(radius: int):
    """Links of sorted rows (key, i, j, block, fp, node) -> forest edges (a, b)."""

    def out(a, b):
        node, root = spanning_forest(a, b)
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], names=["a", "b"])

    def one(block: np.ndarray, i: int, j: int, fp: np.ndarray, node: np.ndarray):
        here = np.flatnonzero(block == i)
        there = here if i == j else np.flatnonzero(block == j)
        a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for at in range(0, len(here), 1024):
            q, k = close(fp[here[at : at + 1024]], fp[there], radius)
            a, b = spanning_forest(np.concatenate([a, node[here[at + q]]]), np.concatenate([b, node[there[k]]]))
        return a, b

    def run(batches):
        held: list = []
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held:
                columns = [np.concatenate([h, c]) for h, c in zip(held, columns)]
            key, i, j, block, fp, node = columns
            change = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            end = int(change[-1]) if len(change) else 0
            held = [c[end:] for c in columns]
            yield from tiles([c[:end] for c in columns], change[change < end])
        if held and len(held[0]):
            key, i, j = held[:3]
            yield from tiles(held, np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1)

    def tiles(columns, change):
        key, i, j, block, fp, node = columns
        if not len(key):
            return
        fp = fp.view(np.uint64)
        starts = np.concatenate([[0], change])
        sizes = np.diff(np.concatenate([starts, [len(key)]]))
        small = (sizes <= 32) & (i[starts] == j[starts])
        left = np.repeat(np.where(small, sizes, 0), sizes) - (np.arange(len(key)) - np.repeat(starts, sizes))
        found = []
        for d in range(1, 32):
            at = np.flatnonzero(left > d)
            if not len(at):
                break
            at = at[close_rows(fp[at], fp[at + d], radius)]
            if len(at):
                found.append((node[at], node[at + d]))
        for k in np.flatnonzero(~small):
            part = slice(starts[k], starts[k] + sizes[k])
            a, b = one(block[part], i[starts[k]], j[starts[k]], fp[part], node[part])
            if len(a):
                found.append((a, b))
        if found:
            yield out(np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found]))

    return run


def block_bounds(radius: int, agree: int = 2) -> list[tuple[int, int]]:
    """(lowest bit, bits) of radius + agree nearly equal blocks."""
    n = radius + agree
    at = [64 * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(at[:-1], at[1:])]


def key_columns(radius: int, agree: int) -> list[Column]:
    """A key for each choice of `agree` blocks: the blocks' bits, and the choice's number hashed in where 64 bits are too few."""
    bounds = block_bounds(radius, agree)
    keys = []
    for t, chosen in enumerate(combinations(range(len(bounds)), agree)):
        key = F.lit(0).cast("long")
        for x in chosen:
            low, n = bounds[x]
            key = F.shiftleft(key, n).bitwiseOR(F.shiftrightunsigned("fp", low).bitwiseAND((1 << n) - 1))
        keys.append(F.shiftleft(F.lit(t).cast("long"), 58).bitwiseOR(key) if agree == 2 else F.xxhash64(F.lit(t), key))
    return keys


def links(classes: DataFrame, radius: int = RADIUS, agree: int = 2) -> DataFrame:
    """Forest edges (a, b) over nodes of classes(fp long, node long) whose fingerprints are within radius."""
    assert 0 <= radius <= 3 and agree >= 2
    keyed = classes.select("fp", "node", F.explode(F.array(*key_columns(radius, agree))).alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    groups = F.ceil(F.col("n") / GROUP).cast("int")
    block = F.pmod(F.xxhash64("fp"), groups).cast("int")
    own = keyed.join(shared, "key").select("key", "fp", "node", groups.alias("g"), block.alias("block"))
    other = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    tiled = other.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "fp", "node")
    dealt = tiled.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(_tiles(radius), "a long, b long")


def near_duplicates(df: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint long, component_id) of every row of df.

    Texts without words, null ones too, have fingerprint zero and link with each other. Repeated rows
    are copies. A null doc_id never is the smallest of its group; a group of null ids only has a null
    component_id. Rows that share a doc_id count as one document: what either links with is linked. An
    empty table gives an empty one; other columns are left out.
    """
    rows, roots = _linked(df, shingle, radius, doc_id, text)
    classes = rows.groupBy("node").agg(F.min("doc_id").alias("id"))
    named, _ = save(classes.join(roots, "node", "left"), "named")
    ids, _ = save(named.where("root is not null").groupBy("root").agg(F.min("id").alias("least")), "ids")
    found = named.join(ids, "root", "left").select("node", F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"))
    return rows.join(found, "node").select("doc_id", F.col("node").alias("fingerprint"), "component_id")


def _linked(df: DataFrame, shingle: int, radius: int, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, t, node), node the fingerprint and t the text's hash, and (node, root) of linked fingerprints.

    Fingerprints are the nodes, as every row has one, with a doc_id or without.
    """
    made = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("t"), fingerprints(shingle)(F.col(text).cast("binary")).alias("node"))
    rows, _ = save(made, "fingerprints")
    classes = rows.select("node").distinct().select(F.col("node").alias("fp"), "node")
    roots, _ = save(components(links(classes, radius).union(shared_ids(rows)), "simhash"), "roots")
    return rows, roots


def shared_ids(rows: DataFrame) -> DataFrame:
    """Edges between the nodes of a doc_id that several rows (doc_id, node) share."""
    many = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high").select("doc_id", "low")
    return rows.join(many, "doc_id").select(F.col("node").alias("a"), F.col("low").alias("b")).where("a <> b")


def first_rows(df: DataFrame, rows: DataFrame, roots: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row of df for each group: that of the smallest (doc_id, hash of text), null ids last.

    rows (doc_id, t, node) stand for those of df; nodes without a root are groups of their own. Which
    rows stay is settled on ids and hashes; texts are joined to it once, and only rows of which df has
    several equal in id and text are dealt by these, to keep one.
    """
    none, own, t, copies = fresh(df, "none", "id", "t", "copies")
    place = F.struct(F.col("doc_id").isNull().alias("n"), F.coalesce("doc_id", F.lit(0)).alias("i"), F.col("t").alias("t"))
    least = rows.groupBy("node", place.alias("least")).agg(F.count("*").alias("copies"))
    grouped = least.join(roots, "node", "left").withColumn("group", F.coalesce("root", "node"))
    kept = grouped.groupBy("group").agg(F.min("least").alias("least"))
    many = least.groupBy("least").agg(F.sum("copies").alias("copies"))
    named = [F.col("least.n").alias(none), F.col("least.i").alias(own), F.col("least.t").alias(t), F.col("copies").alias(copies)]
    keep, _ = save(kept.join(many, "least").select(*named), "kept")
    given = F.col(doc_id).cast("long")
    marked = df.withColumns({none: given.isNull(), own: F.coalesce(given, F.lit(0)), t: F.xxhash64(F.col(text))})
    keys = [none, own, t]
    if keep.where(F.col(copies) > 1).isEmpty():
        return marked.join(keep, keys, "left_semi").select(*df.columns)
    alone = marked.join(keep.where(F.col(copies) == 1), keys, "left_semi")
    several = marked.join(keep.where(F.col(copies) > 1), keys, "left_semi")
    number = fresh(marked, "number")[0]
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(row_hash(df)))
    return alone.select(*df.columns).union(several.withColumn(number, first).where(F.col(number) == 1).select(*df.columns))


def dedup(df: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of df of which one stays for each group: the smallest doc_id's; all columns as they are.

    Of rows with that same doc_id one with the smallest hash of its text stays. Rows without doc_id
    stay only where their whole group has none, and then one of them for each such group.
    """
    rows, roots = _linked(df, shingle, radius, doc_id, text)
    return first_rows(df, rows, roots, doc_id, text)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and group of near duplicates."""

    def make() -> DataFrame:
        found = near_duplicates(documents(spark, sf_dir))
        return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")

    return settled(spark, "op5", make)
