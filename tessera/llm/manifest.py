"""Merkle manifest of a dataset: leaves in large blocks, a small top tree on the driver, proofs on executors.

Each row is a leaf, the digest of its fields. The leaves of a tree (a language) stand in order; every
eight consecutive nodes become the digest of their hex texts until one is left, the subroot, and the
subroots likewise become the root. Leaves get dense numbers from one range shuffle and a prefix sum
over the counts of its parts; 8 ** height consecutive ones make a block, one row of a written table.
Each task reduces its blocks; only one digest a block comes to the driver, which builds the top tree
and broadcasts it as its levels, out of which an executor takes the rest of a block's paths. Proofs and
folds of single rows are then finished from the same blocks, without another shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, save

ARITY = 8
#: Blocks that the driver's tree should have at most; blocks grow to up to ARITY ** 6 leaves (about 20 MB) to keep to it.
TOP = 65_536
HEIGHTS = range(3, 7)
#: Trees that one manifest may have: each has a subroot on the driver.
TREES = 1_000_000
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf(fields: list[Column]) -> Column:
    """Digest of a row: each field as its length in bytes, a colon and its text; null as a dash."""

    def written(c: Column) -> Column:
        c = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))

    return F.sha2(F.concat(*map(written, fields)), 256)


def reduced(nodes: list[str], rounds: int | None = None) -> list[list[str]]:
    """Levels above and with `nodes`: so many rounds, or until one node is left."""
    levels = [nodes]
    while len(levels[-1]) > 1 if rounds is None else len(levels) <= rounds:
        last = levels[-1]
        levels.append([digest(last[k : k + ARITY]) for k in range(0, len(last), ARITY)])
    return levels


def siblings(levels: list[list[str]], at: int) -> list[tuple[list[str], list[str]]]:
    """(those before, those after) the node's way up from place `at` of the first level, level by level; none at the top."""
    out = []
    for nodes in levels[:-1]:
        first = at - at % ARITY
        out.append((nodes[first:at], nodes[at + 1 : first + ARITY]))
        at //= ARITY
    return out


def folded(node: str, path: list[tuple[list[str], list[str]]]) -> str:
    """The root that a node and its siblings give."""
    for before, after in path:
        node = digest([*before, node, *after])
    return node


def written_path(path: list[tuple[list[str], list[str]]]) -> str:
    return "".join(x for before, after in path for side in (before, after) for x in side)


def numbered(rows: DataFrame) -> tuple[DataFrame, list[tuple[str, int]]]:
    """(rows of (tree, id, leaf, altered) with pos, their place in their tree from 0; (tree, number of its rows)).

    Leaves are written once, so that texts are digested once, then dealt by range of (tree, id, leaf), so
    that a tree with most rows goes to many tasks; one row for each part and tree comes to the driver for the prefix sum.
    """
    rows, _ = save(rows, "manifest-digests")
    dealt = rows.repartitionByRange("tree", "id", "leaf").sortWithinPartitions("tree", "id", "leaf", "altered")
    at = F.monotonically_increasing_id()
    held, _ = save(dealt.withColumns({"part": F.spark_partition_id(), "at": at.bitwiseAND(F.lit((1 << 33) - 1))}), "manifest-leaves")
    counts = sorted(tuple(r) for r in held.groupBy("tree", "part").agg(F.min("at"), F.count("*")).collect())
    total: dict[str, int] = {}
    starts = []
    for tree, part, first, n in counts:
        starts.append((tree, part, total.get(tree, 0) - first))
        total[tree] = total.get(tree, 0) + n
    places = rows.sparkSession.createDataFrame(starts, "tree string, part int, shift long")
    placed = held.join(places, ["tree", "part"]).select("tree", "id", "leaf", "altered", (F.col("at") + F.col("shift")).alias("pos"))
    return placed, sorted(total.items(), key=lambda x: x[0].encode())


def height_of(sizes: list[int], top: int = TOP) -> int:
    """The least height at which the trees have at most `top` blocks in all, or the greatest there is."""
    return next((h for h in HEIGHTS if sum(-(-n // ARITY**h) for n in sizes) <= top), HEIGHTS[-1])


def blocks_of(placed: DataFrame, height: int) -> DataFrame:
    """One row for each block: (tree, block, leaves), leaves in order, at most ARITY ** height of them."""
    own = F.struct("pos", "id", F.unhex("leaf").alias("leaf"), F.unhex("altered").alias("altered"))
    block = F.floor(F.col("pos") / ARITY**height).cast("long").alias("block")
    return placed.groupBy("tree", block).agg(F.array_sort(F.collect_list(own)).alias("leaves"))


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list, list[str], list[str]]]:
    """(tree, block, ids, leaves, altered) from rows whose blocks stand together."""
    key, held = None, ([], [], [])
    for batch in batches:
        for tree, block, own_id, own, altered in zip(*(c.to_pylist() for c in batch.columns)):
            if key != (tree, block):
                if key is not None:
                    yield *key, *held
                key, held = (tree, block), ([], [], [])
            held[0].append(own_id)
            held[1].append(own.hex())
            held[2].append(altered.hex())
    if key is not None:
        yield *key, *held


def manifest(leaves: DataFrame, top: int = TOP) -> tuple[DataFrame, str | None]:
    """(rows (tree, id, leaf, subroot, root, proof_sha256, folded_root, verified), the root).

    leaves: tree (string, null for a tree of its own, the first), id (long), leaf and altered (hex
    digests: the row as listed in the manifest, and as it is found now). Places go by id, nulls first,
    then by the digests, so repeated rows stand beside each other and each has its own proof. The proof
    has the siblings up to the root in order; folded_root is what the altered leaf and these give. An
    empty table gives no rows and no root. More than `TREES` trees are refused, as subroots come to the driver.
    """
    spark = leaves.sparkSession
    named = F.when(F.col("tree").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("tree")))
    placed, sizes = numbered(leaves.select(named.alias("tree"), F.col("id").cast("long").alias("id"), "leaf", "altered"))
    if len(sizes) > TREES:
        raise ValueError(f"a manifest of {len(sizes)} trees: at most {TREES} have their subroots on the driver")
    height = height_of([n for _, n in sizes], top)
    blocks, _ = save(blocks_of(placed, height), "manifest-blocks")
    rows = blocks.select("tree", "block", F.inline("leaves")).select("tree", "block", "id", "leaf", "altered")
    many = spark.sparkContext.broadcast({tree: n > ARITY**height for tree, n in sizes})  # a flag a tree, at most TREES

    def inner(tree: str, own: list[str]) -> list[list[str]]:
        return reduced(own, height if many.value[tree] else None)

    def roots(batches):
        for tree, block, _, own, _ in _by_block(batches):
            yield pa.RecordBatch.from_pydict({"tree": [tree], "block": [block], "node": [inner(tree, own)[-1][0]]})

    nodes: dict[str, list[str]] = {}
    for tree, _, node in sorted(tuple(r) for r in rows.mapInArrow(roots, "tree string, block long, node string").collect()):  # a digest a block
        nodes.setdefault(tree, []).append(node)
    own_tops = {tree: reduced(nodes[tree]) for tree, _ in sizes}
    names = [tree for tree, _ in sizes]
    over = reduced([own_tops[tree][-1][0] for tree in names]) if names else [[]]
    root = over[-1][0] if names else None
    # the top tree, from which each block's path to the root is taken: 9 / 8 digests a block
    shared = spark.sparkContext.broadcast((own_tops, {tree: k for k, tree in enumerate(names)}, over))

    def finished(batches):
        tops, place, upper = shared.value
        for tree, block, ids, own, altered in _by_block(batches):
            levels = inner(tree, own)
            suffix = siblings(tops[tree], block) + siblings(upper, place[tree])
            suffix_text, subroot, above = written_path(suffix), tops[tree][-1][0], upper[-1][0]
            for begin in range(0, len(own), 4096):
                proofs, found = [], []
                for at in range(begin, min(begin + 4096, len(own))):
                    path = siblings(levels, at)
                    proofs.append(digest([written_path(path), suffix_text]))
                    found.append(folded(altered[at], path + suffix))
                n = len(proofs)
                columns = [[tree[1:] if tree else None] * n, ids[begin : begin + n], own[begin : begin + n], [subroot] * n, [above] * n, proofs, found, [x == above for x in found]]
                types = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["tree", "id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    schema = "tree string, id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return rows.mapInArrow(finished, schema), root


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the manifest by language, against documents of which a third were written in small letters."""
    docs = documents(spark, sf_dir)
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    small = F.translate("text", ascii_uppercase, ascii_lowercase)
    found = [F.when(chosen, small).otherwise(F.col("text")) if f == "text" else F.col(f) for f in FIELDS]
    leaves = docs.select(F.col("lang").alias("tree"), F.col("doc_id").alias("id"), leaf([F.col(f) for f in FIELDS]).alias("leaf"), leaf(found).alias("altered"))
    rows, _ = manifest(leaves)
    return rows.drop("tree").withColumnRenamed("id", "doc_id")


def _sql(levels: int = 8, upper: int = 3) -> str:
    """SQL of the same rows, for trees of up to 8 ** levels leaves and 8 ** upper trees, each level written out."""
    step = "list_reduce([xor(acc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    crc = f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda acc, b: {step}))"

    def field(x: str) -> str:
        return f"coalesce(strlen({x}::VARCHAR)::VARCHAR || ':' || {x}::VARCHAR, '-')"

    def own_leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(text if f == "text" else f) for f in FIELDS) + ")"

    def level(k: int, source: str, key: str) -> list[str]:
        """Nodes of a level with those before and after them in their run, and the level above."""
        return [
            f"r{k} AS (SELECT {key}, pos // 8 AS run, n, list(h ORDER BY pos) AS hs FROM {source} GROUP BY ALL)",
            f"s{k} AS (SELECT {key}, pos, CASE WHEN n > 1 THEN array_to_string(hs[1:pos % 8], '') ELSE '' END AS l, CASE WHEN n > 1 THEN array_to_string(hs[pos % 8 + 2:], '') ELSE '' END AS r, n FROM (SELECT {key}, run * 8 + unnest(range(len(hs))) AS pos, hs, n FROM r{k}))",
            f"n{k + 1} AS (SELECT {key}, run AS pos, CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h, (n + 7) // 8 AS n FROM r{k})",
        ]

    ctes = [
        f"d AS (SELECT *, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS t, {crc} % 3 = 0 AS chosen FROM documents)",
        f"e AS (SELECT doc_id, t, {own_leaf('text')} AS leaf, CASE WHEN chosen THEN {own_leaf(f"translate(text, '{ascii_uppercase}', '{ascii_lowercase}')")} ELSE {own_leaf('text')} END AS altered FROM d)",
        "n0 AS (SELECT t, doc_id, altered, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf, altered) - 1 AS pos, leaf AS h, count(*) OVER (PARTITION BY t) AS n FROM e)",
        "m0 AS (SELECT t, pos, h, n FROM n0)",
    ]
    for k in range(levels):
        ctes += level(k, "m0" if k == 0 else f"n{k}", "t")
    first = levels + 1
    ctes.append(f"n{first} AS (SELECT 0 AS g, t, row_number() OVER (ORDER BY encode(t)) - 1 AS pos, h, count(*) OVER () AS n FROM n{levels})")
    for k in range(first, first + upper):
        ctes += level(k, f"n{k}", "g")
    chain = [f"f0 AS (SELECT t, doc_id, pos, h AS leaf, altered AS a, '' AS p FROM n0)"]
    for k in range(levels):
        chain.append(f"f{k + 1} AS (SELECT f.t, doc_id, f.pos // 8 AS pos, leaf, CASE WHEN n > 1 THEN sha256(l || a || r) ELSE a END AS a, p || l || r AS p FROM f{k} f JOIN s{k} s ON f.t = s.t AND f.pos = s.pos)")
    chain.append(f"u{first} AS (SELECT doc_id, leaf, a, p, u.h AS subroot, u.pos FROM f{levels} f JOIN n{first} u ON f.t = u.t)")
    for k in range(first, first + upper):
        chain.append(f"u{k + 1} AS (SELECT doc_id, leaf, CASE WHEN n > 1 THEN sha256(l || a || r) ELSE a END AS a, p || l || r AS p, subroot, f.pos // 8 AS pos FROM u{k} f JOIN s{k} s ON f.pos = s.pos)")
    last = first + upper
    return f"WITH {', '.join(ctes + chain)} SELECT doc_id, leaf, subroot, n.h AS root, sha256(p) AS proof_sha256, a AS folded_root, a = n.h AS verified FROM u{last} u CROSS JOIN n{last} n"


OP13_SQL = _sql()
