"""Helpers shared by the corpus operators: intermediate tables, their owners, and connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rounds of `components`, each of which at least halves the longest path.
ROUNDS = 64

_OWNED: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor sees: spark.checkpoint.dir.

    Where it is unset a local master gets a temporary folder; a cluster gets an error, as its executors
    would write to their own disks.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder; the innermost `scratch` owns it."""
    path = f"{shared_dir(spark)}/tessera/{name}-{uuid.uuid4().hex}"
    if (owned := _OWNED.get()) is not None:
        owned.append(path)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a table written by `save` once nothing reads it any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Owns the tables that operators save inside, and drops them at its end: write your result before.

    with scratch(spark):
        near_duplicates(docs).write.parquet(out)
    """
    paths: list[str] = []
    token = _OWNED.set(paths)
    try:
        yield
    finally:
        _OWNED.reset(token)
        for path in paths:
            drop_path(spark, path)


def write(df: DataFrame, path: str) -> DataFrame:
    """Write df as Parquet and read it back."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """(df written in the shared folder and read back, its path): cuts lineage and survives lost executors."""
    path = new_path(df.sparkSession, name)
    return write(df, path), path


def settled(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The rows of make(), written; whatever make saved on the way is dropped."""
    path = new_path(spark, name)
    with scratch(spark):
        return write(make(), path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that begin with the given ones and that df doesn't have."""
    used = {c.lower() for c in df.columns}
    mark = "_"
    while any(f"{mark}{n}".lower() in used for n in names):
        mark += "_"
    return [f"{mark}{n}" for n in names]


def row_hash(df: DataFrame) -> Column:
    """64 bits of all columns of a row: rows of the same values have the same."""
    plain = [F.map_entries(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`") for f in df.schema.fields]
    return F.xxhash64(*[F.when(c.isNull(), F.lit(k)).otherwise(F.lit(-1)) for k, c in enumerate(plain)], *plain)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def trim() -> None:
    """Give memory that a batch took back to the system: workers share an executor's memory with its JVM."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def spanning_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) pairs that link the same nodes as the edges a-b; each root is its smallest node."""
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = inverse[: len(a)], inverse[len(a) :]
    parent = np.arange(len(nodes))
    while True:
        low = np.minimum(parent[u], parent[v])
        before = parent.copy()
        np.minimum.at(parent, parent[u], low)
        np.minimum.at(parent, parent[v], low)
        np.minimum.at(parent, u, low)
        np.minimum.at(parent, v, low)
        while (parent[parent] != parent).any():
            parent = parent[parent]
        if (before == parent).all():
            break
    moved = parent != np.arange(len(nodes))
    return nodes[moved], nodes[parent[moved]]


def _contract(batches):
    """Replace the edges of one task by a spanning forest of them, in bounded chunks; self links stay, once a chunk."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    count = 0

    def rows(node, root):
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], names=["a", "b"])

    def flush():
        a = np.concatenate([x for x, _ in held])
        b = np.concatenate([y for _, y in held])
        held.clear()
        return spanning_forest(a, b)

    for batch in batches:
        a, b = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        own = a == b
        if own.any():
            alone = np.unique(a[own])
            yield rows(alone, alone)
            a, b = a[~own], b[~own]
        if len(a):
            held.append((a, b))
            count += len(a)
        if count >= 2_000_000:
            node, root = flush()
            if len(node) > 1_000_000:
                yield rows(node, root)
                count = 0
            else:
                held.append((node, root))
                count = len(node)
    if held:
        yield rows(*flush())


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of edges (a long, b long): rows (node long, root long) for nodes with an edge.

    root is the smallest node that links reach. Each round hooks every node on the smallest root of its
    neighbours and halves the paths, so rounds grow with the logarithm of the longest chain. A
    neighbourhood is only ever reduced by min (map-side first), never gathered, and what is joined to
    it is a written table, so that Spark may broadcast a small one and split a node with very many
    links over tasks; each task first shrinks its own edges to a forest. edges are evaluated once. State
    is written to the shared folder every round, and a round that leaves count and hash sum of the
    links as they were is the last. Self links give their node the root itself; null ends are ignored;
    an empty table gives an empty table.
    """
    spark = edges.sparkSession
    edges = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a is not null and b is not null")
    given, given_path = save(edges.mapInArrow(_contract, "a long, b long"), name)
    own = given.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("root"))
    links, old = given.where("a <> b"), None
    total = [F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
    shape = links.agg(*total).first()
    for _ in range(ROUNDS):
        # large star: every larger neighbour of a node moves to the smallest node around it
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low, low_path = save(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), name)
        moved = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large, large_path = save(moved, name)
        # small star: each node and its smaller neighbours move to the smallest of them
        low2, low2_path = save(large.groupBy("a").agg(F.min("b").alias("m")), name)
        end = F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b"))
        moved = large.join(low2, "a").select(end.alias("a"), F.col("m").alias("b"))
        links, path = save(moved.where("a <> b").distinct(), name)
        before, shape = shape, links.agg(*total).first()
        for done in (low_path, large_path, low2_path, old):
            if done:
                drop_path(spark, done)
        old = path
        if shape == before:
            break
    else:
        raise RuntimeError(f"components: links still move after {ROUNDS} rounds")
    tops = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    found = links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(tops).union(own)
    return found.groupBy("node").agg(F.min("root").alias("root"))
