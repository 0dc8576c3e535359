"""Near-duplicate embeddings by cosine: int8 tile products with exact error bounds.

Each unit vector u is held as int8 values q and a scale, a = q / scale, with e = |u - a| measured. For
two vectors |u.v - a.b| <= e_u + |a| e_v, so a product of int8 tiles (whole numbers, exact in single
precision up to 1,024 dimensions and summed in double beyond) says which pairs are surely below or
surely above the threshold; only the rest are computed again from the given values in double
precision. Equal vectors count as one with a weight.

Blocks of about `BLOCK` vectors meet pairwise in tiles. Only codes, scales and errors travel there, made
once for each vector. A tile returns link counts per vector, a spanning forest of its links, and the
vectors that have a doubtful pair in it, never its pairs. The doubles of these vectors follow to the same
tiles, where their doubtful pairs, and no others, are settled. Work is that of all pairs of different
vectors: the method is exact and takes no index.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import components, save, settled, spanning_forest

THRESHOLD = 0.9
BLOCK = 8192
#: More than double rounding can change a cosine.
SLACK = 1e-9


def usable():
    """Column function array<float or double> -> its values as doubles (binary); null for vectors that link with nothing."""

    @F.arrow_udf("binary")
    def values(rows: pa.Array) -> pa.Array:
        out: list[bytes | None] = []
        for row in rows:
            v = row.values if row.is_valid else None
            if v is None or v.null_count or not len(v):
                out.append(None)
                continue
            x = v.to_numpy().astype(np.float64) + 0.0
            top = np.abs(x).max()
            out.append(x.tobytes() if np.isfinite(top) and top > 0 else None)
        return pa.array(out, pa.binary())

    return values


CODES = "key binary, dim int, n long, codes binary, scale double, error double"


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 values, scale, measured error) of the unit vectors along the rows of x."""
    x = x / np.abs(x).max(1, keepdims=True)
    u = x / np.sqrt((x * x).sum(1, keepdims=True))
    scale = 127 / np.abs(u).max(1)
    q = np.rint(u * scale[:, None]).astype(np.int8)
    return q, scale, np.sqrt(((u - q / scale[:, None]) ** 2).sum(1)) + 1e-12


def _codes(batches):
    """(key, dim, n, v binary) -> CODES, each vector quantised once."""
    for batch in batches:
        held = batch.to_pydict()
        dims = np.array(held["dim"], np.int64)
        codes, scale, error = [b""] * len(dims), np.zeros(len(dims)), np.zeros(len(dims))
        for dim in np.unique(dims).tolist():
            at = np.flatnonzero(dims == dim)
            q, scale[at], error[at] = quantise(np.frombuffer(b"".join(held["v"][k] for k in at), np.float64).reshape(len(at), dim))
            for k, row in zip(at.tolist(), q):
                codes[k] = row.tobytes()
        names = ["key", "dim", "n", "codes", "scale", "error"]
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("dim"), batch.column("n"), pa.array(codes, pa.binary()), pa.array(scale), pa.array(error)], names=names)


#: What travels to tiles: a row for each block with the codes of its vectors, in order of their places.
BLOCKS = "dim int, block int, places binary, n binary, scale binary, error binary, codes binary"


def _block(table: pa.Table) -> pa.Table:
    """One row for the vectors of a block (about BLOCK of them)."""
    table = table.sort_by("place")
    packed = [np.asarray(table.column(c).to_numpy(), t).tobytes() for c, t in (("place", np.int64), ("n", np.int64), ("scale", np.float64), ("error", np.float64))]
    codes = b"".join(table.column("codes").to_pylist())
    values = [table.column("dim")[0].as_py(), table.column("block")[0].as_py(), *packed, codes]
    kinds = [pa.int32(), pa.int32()] + [pa.binary()] * 5
    names = ["dim", "block", "places", "n", "scale", "error", "codes"]
    return pa.table({c: pa.array([v], k) for c, v, k in zip(names, values, kinds)})


class Block:
    """Quantised vectors; x, their doubles, only where doubtful pairs are settled."""

    def __init__(self, places: bytes, n: bytes, scale: bytes, error: bytes, codes: bytes, x: np.ndarray | None = None) -> None:
        self.place, self.n = np.frombuffer(places, np.int64), np.frombuffer(n, np.int64)
        self.scale, self.error = np.frombuffer(scale, np.float64), np.frombuffer(error, np.float64)
        self.count = len(self.place)
        self.q = np.frombuffer(codes, np.int8).reshape(self.count, -1)
        self.norm = np.sqrt((self.q.astype(np.float64) ** 2).sum(1)) / self.scale
        self.links, self.doubtful = np.zeros(self.count, np.int64), np.zeros(self.count, bool)
        self.x = x

    def cosines(self, at: np.ndarray, other: Block, to: np.ndarray) -> np.ndarray:
        a, b = self.x[at], other.x[to]
        a = a / np.abs(a).max(1, keepdims=True)
        b = b / np.abs(b).max(1, keepdims=True)
        return (a * b).sum(1) / np.sqrt((a * a).sum(1) * (b * b).sum(1))


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 rows."""
    if a.shape[1] <= 1024:
        return a.astype(np.float32) @ b.astype(np.float32).T
    return sum(product(a[:, k : k + 1024], b[:, k : k + 1024]).astype(np.float64) for k in range(0, a.shape[1], 1024))


def compare(a: Block, b: Block, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Adds links between a and b (or within a, if b is a) to both and returns a forest of them over places.

    Without doubles these are the pairs that are surely above the threshold, and vectors with a pair that
    may be are marked doubtful. With doubles they are those of the doubtful pairs that are above it.
    """
    fa, fb = np.zeros(0, np.int64), np.zeros(0, np.int64)
    low, exact = threshold - SLACK, a.x is not None
    right = b.q.astype(np.float32) if b.q.shape[1] <= 1024 else b.q
    for at in range(0, a.count, 256):
        rows = slice(at, at + 256)
        p = a.q[rows].astype(np.float32) @ right.T if right.dtype == np.float32 else product(a.q[rows], right)
        reach = low - a.error[rows] - a.norm[rows] * b.error.max()
        floor = np.where(reach > 0, reach * a.scale[rows] * b.scale.min(), reach * a.scale[rows] * b.scale.max())
        i, j = np.nonzero(p >= np.floor(floor)[:, None].astype(p.dtype))
        if a is b:
            i, j = i[j > i + at], j[j > i + at]
        for k in range(0, len(i), 1 << 18):
            x, y = i[k : k + (1 << 18)] + at, j[k : k + (1 << 18)]
            close = p[x - at, y].astype(np.float64) / (a.scale[x] * b.scale[y])
            bound = a.error[x] + a.norm[x] * b.error[y]
            linked = close - bound >= threshold + SLACK
            open_ = np.flatnonzero(~linked & (close + bound >= low))
            if exact:
                linked = np.zeros(len(x), bool)
                linked[open_] = np.concatenate([a.cosines(x[s], b, y[s]) for s in np.array_split(open_, len(open_) // 50_000 + 1)]) >= threshold
            else:
                a.doubtful[x[open_]] = True
                b.doubtful[y[open_]] = True
            x, y = x[linked], y[linked]
            a.links += np.bincount(x, b.n[y], a.count).astype(np.int64)
            b.links += np.bincount(y, a.n[x], b.count).astype(np.int64)
            fa, fb = spanning_forest(np.concatenate([fa, a.place[x]]), np.concatenate([fb, b.place[y]]))
    return fa, fb


#: place and links of a vector; a and b of a link of the forest; or the tile and place of a doubtful vector.
RESULT = "place long, links long, a long, b long, dim int, i int, j int"


def _emit(tile: tuple[int, int, int], blocks: list[Block], fa: np.ndarray, fb: np.ndarray):
    some = [np.flatnonzero(x.links) for x in blocks]
    open_ = [x.place[x.doubtful] for x in blocks]
    place = np.concatenate([x.place[at] for x, at in zip(blocks, some)])
    links = np.concatenate([x.links[at] for x, at in zip(blocks, some)])
    doubtful = np.concatenate(open_)
    columns = []
    for parts in ((place, None, doubtful), (links, None, None), (None, fa, None), (None, fb, None), *[(None, None, np.full(len(doubtful), t)) for t in tile]):
        sizes = len(place), len(fa), len(doubtful)
        columns.append(pa.concat_arrays([pa.nulls(n, pa.int64()) if x is None else pa.array(x, pa.int64()) for x, n in zip(parts, sizes)]))
    columns[4:] = [c.cast(pa.int32()) for c in columns[4:]]
    return pa.RecordBatch.from_arrays(columns, names=["place", "links", "a", "b", "dim", "i", "j"])


def _tiles(threshold: float):
    """Block rows (dim, i, j, then BLOCKS without dim), sorted by tile -> RESULT."""

    def run(batches):
        last = None
        for batch in batches:
            for k in range(batch.num_rows):
                dim, i, j, _, *values = (c[k].as_py() for c in batch.columns)
                own = Block(*values)
                if i == j:
                    pair = [own]
                elif last is None or last[0] != (dim, i, j):
                    last = (dim, i, j), own
                    continue
                else:
                    pair, last = [last[1], own], None
                yield _emit((dim, i, j), pair, *compare(pair[0], pair[-1], threshold))

    return run


def _doubtful(threshold: float):
    """Doubtful vectors (dim, i, j, block, place, n, scale, error, codes, v), sorted by tile and block -> RESULT."""

    def run(batches):
        tile, held = None, []

        def done():
            groups = [[r for r in held if r[0] == tile[1]], [r for r in held if r[0] == tile[2]]]
            blocks = []
            for rows in groups[: 1 if tile[1] == tile[2] else 2]:
                if not rows:
                    return None
                packed = [np.array([r[k] for r in rows], t).tobytes() for k, t in ((1, np.int64), (2, np.int64), (3, np.float64), (4, np.float64))]
                x = np.frombuffer(b"".join(r[6] for r in rows), np.float64).reshape(len(rows), -1)
                blocks.append(Block(*packed, b"".join(r[5] for r in rows), x))
            return _emit(tile, blocks, *compare(blocks[0], blocks[-1], threshold))

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:3] != tile:
                    if held and (out := done()) is not None:
                        yield out
                    tile, held = row[:3], []
                held.append(row[3:])
        if held and (out := done()) is not None:
            yield out

    return run


def near_duplicates(df: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row: links are cosines of at least threshold.

    Vectors that are null, empty, all zero, or hold a null or non-finite value link with nothing, and
    neither do vectors of different lengths. Equal vectors, repeated rows too, link with each other. Rows
    that share a vec_id are one vertex. A null vec_id never is the smallest of a component; where no row
    of a component has an id, component_id is null and kept false. An empty table gives an empty one;
    other columns are left out.
    """
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), usable()(F.col(embedding)).alias("v"))
    rows, _ = save(rows.select("vec_id", "v", F.unhex(F.md5("v")).alias("key")), "vectors")
    some = rows.where("v is not null").withColumn("dim", (F.octet_length("v") / 8).cast("int"))
    classes = some.groupBy("key", "dim").agg(F.count("*").alias("n"), F.max("v").alias("v"))
    codes, _ = save(classes.mapInArrow(_codes, CODES), "codes")
    dims, _ = save(codes.groupBy("dim").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("of")), "dims")
    dealt = codes.join(dims, "dim").withColumn("block", F.pmod(F.xxhash64("key"), F.col("of")).cast("int"))
    within = F.row_number().over(Window.partitionBy("dim", "block").orderBy("key"))
    place = F.shiftleft(F.col("dim").cast("long"), 44).bitwiseOR(F.shiftleft(F.col("block").cast("long"), 20)).bitwiseOR(within)
    placed, _ = save(dealt.withColumn("place", place), "places")
    blocks = placed.select("dim", "block", "place", "n", "scale", "error", "codes").groupBy("dim", "block").applyInArrow(_block, BLOCKS)
    # block i meets blocks i, i + 1, ... half way round, so every block is in as many tiles
    turns = blocks.join(dims, "dim").withColumn("step", F.explode(F.sequence(F.lit(0), F.col("of") - 1)))
    other = F.pmod(F.col("block") + F.col("step"), F.col("of")).cast("int")
    tile = ["dim", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")]
    tiles = turns.withColumn("other", other).select(*tile, "block", "places", "n", "scale", "error", "codes")
    dealt = tiles.repartition("dim", "i", "j").sortWithinPartitions("dim", "i", "j", "block")
    sure, _ = save(dealt.mapInArrow(_tiles(threshold), RESULT), "sure")
    open_ = sure.where("dim is not null").select("dim", "i", "j", "place")
    wanted = placed.join(open_.select("place").distinct(), "place", "left_semi").select("key", "block", "place", "n", "scale", "error", "codes")
    doubles = some.join(wanted.select("key"), "key", "left_semi").groupBy("key").agg(F.max("v").alias("v"))
    vectors = wanted.join(doubles, "key").drop("key")
    full = open_.join(vectors, "place").select("dim", "i", "j", "block", "place", "n", "scale", "error", "codes", "v")
    settled_, _ = save(full.repartition("dim", "i", "j").sortWithinPartitions("dim", "i", "j", "block").mapInArrow(_doubtful(threshold), RESULT), "settled")
    found = sure.where("dim is null").union(settled_.where("dim is null"))
    members = rows.join(placed.select("key", "place"), "key").select("vec_id", "place")
    roots, _ = save(components(found.where("a is not null").select("a", "b").union(_shared_ids(members)), "vectors"), "roots")
    crossing = found.where("place is not null").groupBy("place").agg(F.sum("links").alias("links"))
    own = placed.select("key", "place", "n").join(crossing, "place", "left").join(roots.withColumnRenamed("node", "place"), "place", "left")
    known, _ = save(own.select("key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "place").alias("group")), "known")
    all_, _ = save(rows.select("vec_id", "key").join(known, "key", "left").select("vec_id", "n_links", "group"), "grouped")
    least = all_.where("group is not null").groupBy("group").agg(F.min("vec_id").alias("least"))
    out = all_.join(least, "group", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("group").isNull(), F.col("vec_id")).otherwise(F.col("least")).alias("component_id")
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _shared_ids(members: DataFrame) -> DataFrame:
    """Edges between different vectors (place) that share a vec_id: they are one vertex."""
    some = members.where("vec_id is not null")
    many = some.groupBy("vec_id").agg(F.min("place").alias("low"), F.max("place").alias("high")).where("low <> high").select("vec_id", "low")
    return some.join(many, "vec_id").select(F.col("place").alias("a"), F.col("low").alias("b")).where("a <> b")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's links and component."""
    return settled(spark, "op2", lambda: near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))


OP2_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (SELECT a.vec_id a, b.vec_id b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN l ON l.a = r.b),
c AS (SELECT a, min(b) m FROM reach GROUP BY a), n AS (SELECT a, count(*) k FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.k, 0)::BIGINT AS n_links, c.m AS component_id, e.vec_id = c.m AS kept
FROM embeddings e JOIN c ON c.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id"""
