"""Near duplicates of a given similarity: wide SimHash fingerprints compared bit-sliced, then exact sets.

This is the SimHash operator where near duplicates are texts whose sets of word shingles have a Jaccard
similarity of at least `threshold`. 64 bits and a radius of 3 can't tell such texts: at 0.8 they differ in
15 of 100 bits. So a text gets a fingerprint of `BITS` bits (signs of sums over hashes of its shingles);
texts within `RADIUS` bits of each other go to the exact comparison of their sets, all others are passed
over. At 0.8 two sets differ in at most 0.19 of the bits (sets of 4 and 5 shingles; 0.152 for large ones),
48 of 256 with a deviation of 6.2, so a radius of 72 misses one such pair in 10,000 at worst; unlike texts
differ in 128, seven deviations away. Radius and width hold for thresholds of 0.8 and more.

Which texts meet at all is settled by keys of minima over the shingles' hashes: BANDS keys of ROWS minima
each, shared by a pair of similarity s with a chance of 1 - (1 - s ** ROWS) ** BANDS, 99.9 % at 0.8. Keys of
fingerprint bits alone would need 340 of 24 bits for the same. Texts that share keys, even by way of
others, make a cluster, and all pairs of a cluster are compared, whether they share a key or not. A large
cluster is cut into blocks of about CELLS shingles, every two of which meet in a tile of their own; a tile
returns a spanning forest of its links, not the pairs. Texts of the same set are one node.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, save, trim
from .simhash import first_rows, near, planes, shared_ids, shingle_hashes

SHINGLE = 5
THRESHOLD = 0.8
BITS, RADIUS = 256, 72
BANDS, ROWS = 32, 7
#: Shingles of a block of a cluster; a set counts for BITS / 4 more, so that small sets don't crowd a block.
CELLS = 1 << 18


def shingle_set(data: bytes | None, shingle: int) -> np.ndarray:
    """Sorted different hashes of the word shingles; none of a null text."""
    return np.unique(shingle_hashes(data or b"", shingle))


def node_of(hashes: np.ndarray) -> int:
    """64-bit name of a set: texts of the same set share it."""
    from xxhash import xxh64_intdigest

    return int(np.uint64(xxh64_intdigest(hashes.tobytes(), 7)).view(np.int64))


def _factors() -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20)
    odd, plus = r.integers(0, 2**64, (2, BANDS * ROWS), dtype=np.uint64)
    return odd | np.uint64(1), plus


def bands(hashes: np.ndarray, factors: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Keys (long) of a set, one for each band."""
    odd, plus = factors
    low = np.full(len(odd), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1024):
        low = np.minimum(low, (hashes[None, at : at + 1024] * odd[:, None] + plus[:, None]).min(1))
    low = low.reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = (key ^ low[:, k]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _sketches(shingle: int, threshold: float):
    """(doc_id, t, text binary) -> (doc_id, t, node, size, keys)."""
    # a set of fewer shingles only reaches the threshold with an equal one
    least = int(np.ceil(threshold / (1 - threshold) - 1e-9)) if threshold < 1 else np.inf

    def run(batches):
        factors = _factors()
        for batch in batches:
            nodes, sizes, keys, ends = [], [], [], [0]
            for text in batch.column(2):
                hashes = shingle_set(text.as_py(), shingle)
                nodes.append(node_of(hashes))
                sizes.append(len(hashes))
                if len(hashes) >= least:
                    keys.append(bands(hashes, factors))
                ends.append(len(keys) * BANDS)
            flat = pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), lists], names=["doc_id", "t", "node", "size", "keys"])
            del batch, keys, flat, lists
            yield out
            del out
            trim()

    return run


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """BITS bits (as words) set in more than half of the hashes, each of them spread to so many bits."""
    votes = np.zeros(BITS, np.int64)
    steps = (np.arange(BITS // 64, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    for at in range(0, len(hashes), 4096):
        x = hashes[at : at + 4096, None] + steps
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        votes += np.unpackbits(x.view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(2 * votes > len(hashes), bitorder="little").view(np.uint64)


def _sets(shingle: int):
    """(root, blocks, text binary) -> (root, blocks, node, print binary, set binary)."""

    def run(batches):
        for batch in batches:
            sets = [shingle_set(text.as_py(), shingle) for text in batch.column(2)]
            prints = pa.array([wide_fingerprint(s).tobytes() for s in sets], pa.binary())
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([node_of(s) for s in sets], pa.int64()), prints, pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["root", "blocks", "node", "print", "set"],
            )
            del batch, sets, prints
            yield out
            del out
            trim()

    return run


def similar(nodes: np.ndarray, prints: np.ndarray, sets: list[np.ndarray], threshold: float) -> tuple[list[int], list[int]]:
    """Edges (a, b) that link what all pairs of similarity >= threshold link.

    Bit planes say which sets are within RADIUS of a set; of these, the ones not yet linked with it are
    compared exactly.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    words, cells = np.unique(np.concatenate(sets), return_inverse=True)
    marks = np.zeros(len(words), np.int64)
    label = np.arange(n)
    own = planes(prints)
    a, b = [], []
    for at in range(0, n, 64):
        which, bits = near(prints[at : at + 64], own, RADIUS)
        for x, row in zip((at + which).tolist(), bits):
            some = np.flatnonzero(np.unpackbits(row.view(np.uint8), bitorder="little")[:n])
            some = some[label[some] != label[x]]
            if not len(some):
                continue
            long = sizes[some]
            first = np.cumsum(long) - long
            at_cells = np.repeat(starts[some] - first, long) + np.arange(long.sum())
            marks[cells[starts[x] : starts[x] + sizes[x]]] = 1
            common = np.add.reduceat(marks[cells[at_cells]], first)
            marks[cells[starts[x] : starts[x] + sizes[x]]] = 0
            found = some[common / (long + sizes[x] - common) >= threshold]
            if len(found):
                label[np.isin(label, label[found])] = label[x]
                a += [int(nodes[x])] * len(found)
                b += nodes[found].tolist()
    return a, b


def _tiles(threshold: float):
    """Sorted rows (root, i, j, node, print, set) -> edges (a, b)."""

    def run(batches):
        tile, nodes, prints, sets = None, [], [], []

        def done():
            a, b = similar(np.array(nodes, np.int64), np.stack(prints), sets, threshold)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            for root, i, j, node, mark, held in zip(*(c.to_pylist() for c in batch.columns)):
                if tile != (root, i, j):
                    if len(nodes) > 1:
                        yield done()
                    tile, nodes, prints, sets = (root, i, j), [], [], []
                nodes.append(node)
                prints.append(np.frombuffer(mark, np.uint64))
                sets.append(np.frombuffer(held, np.uint64))
            del batch
            trim()
        if len(nodes) > 1:
            yield done()
        tile, nodes, prints, sets = None, [], [], []
        trim()

    return run


def links(df: DataFrame, rows: DataFrame, shingle: int, threshold: float, text: str) -> DataFrame:
    """Edges (a, b) between the nodes of rows (t, node, size, keys) of df that are similar."""
    made = rows.where("size(keys) > 0").groupBy("node").agg(F.min("t").alias("t"), F.first("size").alias("size"), F.first("keys").alias("keys"))
    classes, _ = save(made, "classes")
    keyed = classes.select("node", F.explode("keys").alias("key"))
    low, _ = save(keyed.groupBy("key").agg(F.min("node").alias("m"), F.count("*").alias("n")).where("n > 1").select("key", "m"), "keys")
    stars = keyed.join(low, "key").where("node <> m").select(F.col("node").alias("a"), F.col("m").alias("b"))
    clusters, _ = save(components(stars, "clusters").join(classes, "node").select("node", "root", "t", "size"), "clusters")
    blocks = clusters.groupBy("root").agg(F.ceil(F.sum(F.col("size") + BITS // 4) / CELLS).cast("int").alias("blocks"))
    wanted, _ = save(clusters.join(blocks, "root").select("t", "root", "blocks"), "wanted")
    texts = df.select(F.xxhash64(F.col(text)).alias("t"), F.col(text).cast("binary").alias("text")).join(wanted.select("t"), "t", "left_semi").groupBy("t").agg(F.first("text").alias("text"))
    sets, _ = save(texts.join(wanted, "t").select("root", "blocks", "text").mapInArrow(_sets(shingle), "root long, blocks int, node long, print binary, set binary"), "sets")
    own = sets.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiled = own.select("root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "print", "set")
    return tiled.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j").mapInArrow(_tiles(threshold), "a long, b long")


def dedup(df: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of df of which one stays for each group of similar texts; all columns as they are.

    Groups are what pairs of similarity >= threshold link. Texts of at most `shingle` words are one
    shingle; those without words, null ones too, are alike. The smallest doc_id's row stays, and of
    rows with that same doc_id the one with the smallest hash of its text. Rows that share a doc_id
    count as one document. Rows without doc_id stay only where their whole group has none, and then
    one of them for each such group. An empty table gives an empty one.
    """
    given = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("t"), F.col(text).cast("binary").alias("text"))
    rows, _ = save(given.mapInArrow(_sketches(shingle, threshold), "doc_id long, t long, node long, size int, keys array<long>"), "sketches")
    roots, _ = save(components(links(df, rows, shingle, threshold, text).union(shared_ids(rows)), "similar"), "roots")
    return first_rows(df, rows, roots, doc_id, text)
