"""WARC files and their Merkle fixity audit.

`write_files` writes pages as WARC records, one gzip member each, and `read_members` reads such files back,
member by member, whatever damage they have: what doesn't decode becomes one member of its own and reading
goes on at the next that does. A replica's tree is made of what lies on disk: a leaf is the SHA-256 of a
member's length and bytes; a node covers an ordered range of offsets of a file and is the hash of the range's
length and of its children's hashes, and stands beside the range; the files' roots, in order, make the root of the
replica. Where a node ends its last child's hash says, so lost and added records, which move all that follows,
change only the nodes above them. Every level is a partition of a written table. `audit` compares the two
roots; only where they differ it goes on to the files, and from level to level to the children of nodes that
the other replica's file doesn't have, down to the stretches of records between those that both have. Only
these are aligned by their bytes.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import new_path, save, settled, trim

#: Children of a node, on average.
FAN = 32
DATE = "2024-01-01T00:00:00Z"
#: A gzip member of nothing: the text writer puts it after each record, and readers pass over it.
EMPTY = gzip.compress(b"", 9, mtime=0)
MAGIC = b"\x1f\x8b\x08"


def record(page_id: Column, url: Column, body: Column, date: str = DATE) -> Column:
    """A WARC/1.0 resource record as text; null urls and bodies count as empty, a null page_id has no number."""
    url, body, number = F.coalesce(url, F.lit("")), F.coalesce(body, F.lit("")), F.coalesce(page_id.cast("string"), F.lit(""))
    key = F.md5(F.concat(number, F.lit(" "), url))
    uuid = F.concat_ws("-", *[F.substring(key, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    lines = [
        F.lit("WARC/1.0"), F.lit("WARC-Type: resource"), F.concat(F.lit("WARC-Record-ID: <urn:uuid:"), uuid, F.lit(">")), F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), url), F.concat(F.lit("Page-ID: "), number), F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def packed():
    """Column function record -> its gzip member, as a string of these bytes."""

    @F.arrow_udf("binary")
    def own(records: pa.Array) -> pa.Array:
        out = pa.array([gzip.compress(r.as_buffer(), 6, mtime=0) for r in records], pa.binary())
        trim()
        return out

    return own


def _write(members: DataFrame, path: str) -> None:
    """Write column `member` (binary), one after the other, as files of `path`; column `part`, if any, makes a folder each."""
    rows = members.withColumn("member", F.col("member").cast("string"))  # the bytes stay as they are
    writer = rows.write.option("lineSep", EMPTY.decode("latin-1")).option("encoding", "ISO-8859-1")
    (writer.partitionBy("part") if "part" in members.columns else writer).text(path)


def write_files(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Pages as WARC files, a file for each task, in the order in which pages come; no shuffle.

    Null urls and bodies are empty; repeated rows make equal records; an empty table makes no record;
    other columns are left out.
    """
    made = record(F.col(page_id).cast("long"), F.col(url), F.col(html))
    _write(pages.select(packed()(made).alias("member")), path)


def _next(data: bytes, at: int) -> int:
    """Where the next readable record begins, gzipped or plain, or the end of data."""
    while True:
        starts = [k for k in (data.find(MAGIC, at), data.find(b"WARC/1.", at)) if k >= 0]
        if not starts:
            return len(data)
        at = min(starts)
        if data[at : at + 1] == b"W":
            return at
        unpack = zlib.decompressobj(31)
        try:
            begun = unpack.decompress(data[at : at + 4096], 64)
            if begun[:5] == b"WARC/" or unpack.eof and not begun:
                return at
        except zlib.error:
            pass
        at += 1


def _plain(data: bytes, at: int) -> int | None:
    """The end of the plain record at `at`, or None if it isn't whole."""
    end = data.find(b"\r\n\r\n", at)
    length = re.search(rb"(?im)^content-length: *(\d+)\r?$", data[at:end]) if end >= 0 else None
    if length is None:
        return None
    stop = end + 4 + int(length[1])
    return stop + 4 if data[stop : stop + 4] == b"\r\n\r\n" else None


def _unpack(data: bytes, at: int, step: int = 1 << 16) -> tuple[bytes | None, int]:
    """(content, end) of the gzip member at `at`; None if it is damaged or cut off."""
    unpack, parts = zlib.decompressobj(31), []
    for k in range(at, len(data), step):
        try:
            parts.append(unpack.decompress(data[k : k + step]))
        except zlib.error:
            break
        if unpack.eof:
            return b"".join(parts), min(k + step, len(data)) - len(unpack.unused_data)
    return None, at


def split_members(data: bytes) -> Iterator[tuple[int, int, bytes | None]]:
    """(offset, length, record or None) of each stretch of a WARC file: a whole record, or what can't be read up to the next."""
    at = 0
    while at < len(data):
        record, end = None, at + 1
        if data[at : at + 3] == MAGIC:
            record, stop = _unpack(data, at)
            if record and _plain(record, 0) != len(record):
                record = None
            end = stop if record is not None else end
        elif data[at : at + 7] == b"WARC/1." and (stop := _plain(data, at)) is not None:
            record, end = data[at:stop], stop
        if record is None:
            end = _next(data, end)
        if record != b"":
            yield at, end - at, record
        at = end


def fields(record: bytes) -> tuple[list[tuple[str, str]], bytes]:
    """(headers, body) of a whole record; lines without a colon are passed over."""
    end = record.index(b"\r\n\r\n")
    lines = record[:end].decode("utf-8", "replace").split("\r\n")[1:]
    return [(k.strip(), v.strip()) for k, colon, v in (x.partition(":") for x in lines) if colon], record[end + 4 : -4]


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(file, content) at path; a file is one row, so files are to be of the size of a task."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.where("length > 0").select(F.col("path").alias("file"), "content")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, offset, length, headers map, body, whole) of every record of the WARC files at path, plain or gzipped.

    Bytes that aren't a whole record (damaged, cut off, or strays between records) are a row with whole
    false and null headers and body; reading goes on behind them.
    """

    def parse(batches):
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = []
                for at, length, record in split_members(data.as_buffer().to_pybytes()):
                    headers, body = fields(record) if record is not None else (None, None)
                    rows.append((name, at, length, list(dict(headers).items()) if headers is not None else None, body, record is not None))
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary(), pa.bool_()]
                columns = list(zip(*rows)) if rows else [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "offset", "length", "headers", "body", "whole"])

    return _files(spark, path).mapInArrow(parse, "file string, offset long, length long, headers map<string,string>, body binary, whole boolean")


NODES = "level int, part long, node long, parent long, first long, end long, hash binary, own binary, before binary, page_id long, size long"


def _part(name: str) -> int:
    """The number of a file: of its part=... folder, or of its part-... name."""
    found = re.search(r"part=(\d+)", name) or re.search(r"part-(\d+)", name)
    return int(found[1]) if found else zlib.crc32(name.rsplit("/", 1)[-1].encode())


def _groups(nodes: list[tuple], fan: int) -> Iterator[list[tuple]]:
    """Nodes in groups of two or more that end where a node's hash says so, some `fan` of them, at most eight times as many.

    What ends a group is in its last node alone, so a lost or added node moves the groups around it and no others.
    """
    group: list[tuple] = []
    for node in nodes:
        group.append(node)
        if len(group) >= 2 and int.from_bytes(node[6][-4:], "big") % fan == 0 or len(group) >= 8 * fan:
            yield group
            group = []
    if group:
        yield group


def _trees(fan: int):
    """(file, content) -> the nodes of each file's tree, leaves at level 0, and the leaf before each node of level 1."""

    def run(batches):
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                part, content, leaves = _part(name), data.as_buffer().to_pybytes(), []
                for k, (at, length, record) in enumerate(split_members(content)):
                    own = hashlib.sha256(content[at : at + length]).digest()
                    page = dict(fields(record)[0]).get("Page-ID", "") if record is not None else ""
                    number = int(page) if re.fullmatch(r"-?\d{1,18}", page) else None
                    leaves.append((0, part, k, None, at, at + length, hashlib.sha256(b"%d:" % length + own).digest(), own, None, number, len(record) if record is not None else None))
                rows, level, below = [], 0, leaves
                while below and (level == 0 or len(below) > 1):
                    level += 1
                    above, at = [], 0
                    for k, g in enumerate(_groups(below, fan)):
                        digest = hashlib.sha256(b"%d:" % (g[-1][5] - g[0][4]) + b"".join(x[6] for x in g)).digest()
                        rows += [(*x[:3], k, *x[4:]) for x in g]
                        above.append((level, part, k, None, g[0][4], g[-1][5], digest, None, (below[at - 1][7] if at else b"") if level == 1 else None, None, None))
                        at += len(g)
                    below = above
                # the file's root stands once more, at level -1, with the number of its leaves as `size` and its height as `first`
                if leaves:
                    rows += [below[0], (-1, part, 0, None, level, leaves[-1][5], below[0][6], None, None, None, len(leaves))]
                kinds = [pa.int32()] + [pa.int64()] * 5 + [pa.binary()] * 3 + [pa.int64()] * 2
                names = ["level", "part", "node", "parent", "first", "end", "hash", "own", "before", "page_id", "size"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 11, kinds)], names=names)
            trim()

    return run


class Tree:
    """The tree of the files at path, every level a partition of a written table; `root` is the whole replica's."""

    def __init__(self, spark: SparkSession, path: str, fan: int = FAN) -> None:
        self.fan, where = fan, new_path(spark, "tree")
        _files(spark, path).mapInArrow(_trees(fan), NODES).write.option("compression", "zstd").partitionBy("level").parquet(where)
        self.nodes = spark.read.schema(NODES).parquet(where)
        text = F.concat_ws(",", F.array_sort(F.collect_list(F.concat_ws(":", F.lpad(F.col("part").cast("string"), 19, "0"), F.hex("hash")))))
        # files by the thousand (by number) make a level, and these the root
        groups = self.level(-1).groupBy(F.floor(F.col("part") / 1000).alias("group")).agg(F.sha2(text, 256).alias("hash"))
        top = groups.agg(F.sha2(F.concat_ws(",", F.array_sort(F.collect_list(F.concat_ws(":", F.lpad(F.col("group").cast("string"), 19, "0"), "hash")))), 256).alias("hash"))
        self.root = top.first().hash

    def level(self, k: int) -> DataFrame:
        return self.nodes.where(F.col("level") == k).drop("level")


def _unlike(a: DataFrame, b: DataFrame) -> DataFrame:
    """Nodes of a that b has no equal of in the same file: of equal ones as many stay as a has more."""
    nth = F.row_number().over(Window.partitionBy("part", "hash").orderBy("node"))
    return a.withColumn("nth", nth).join(b.withColumn("nth", nth).select("part", "hash", "nth"), ["part", "hash", "nth"], "left_anti").drop("nth")


def _stretches(groups: DataFrame) -> DataFrame:
    """(part, parent, anchor, nth): groups of level 1 with what their stretch stands behind; consecutive groups are one stretch.

    The leaf before a stretch is the last of a group that both replicas have, so it names the stretch in either.
    """
    w = Window.partitionBy("part").orderBy("node")
    begins = F.coalesce(F.lag("node").over(w) + 1 != F.col("node"), F.lit(True))
    rows = groups.select("part", "node", "before", begins.alias("begins"))
    rows = rows.withColumn("stretch", F.sum(F.col("begins").cast("int")).over(w)).withColumn("anchor", F.last(F.when(F.col("begins"), F.col("before")), True).over(w))
    heads = rows.where("begins").withColumn("nth", F.row_number().over(Window.partitionBy("part", "anchor").orderBy("stretch"))).select("part", "stretch", "nth")
    return rows.join(heads, ["part", "stretch"]).select("part", F.col("node").alias("parent"), "anchor", "nth")


def _apart(ours: list[dict], theirs: list[dict]) -> list[tuple[dict, str]]:
    """What differs between two stretches of leaves: equal bytes are the same, the rest pair up in order.

    A stretch of bytes that can't be read takes as many records as fill its length.
    """
    same = Counter(x["own"] for x in ours) & Counter(x["own"] for x in theirs)

    def rest(leaves: list[dict]) -> list[dict]:
        left = same.copy()
        out = []
        for x in leaves:
            if left[x["own"]] > 0:
                left[x["own"]] -= 1
            else:
                out.append(x)
        return out

    left, rows = rest(ours), []
    for x in rest(theirs):
        if not left:
            rows.append((x, "extra"))
            continue
        taken = 1
        while x["size"] is None and taken < len(left) and left[taken]["end"] - left[0]["first"] <= x["end"] - x["first"]:
            taken += 1
        rows += [(r, "damaged") for r in left[:taken]]
        left = left[taken:]
    return rows + [(r, "missing") for r in left]


def _align(key, ours: pa.Table, theirs: pa.Table) -> pa.Table:
    """The leaves that differ of a stretch.

    Records that stand once in both are fixed points, in order; what lies between them is compared apart.
    """
    a, b = ours.sort_by("node").to_pylist(), theirs.sort_by("node").to_pylist()
    once = [{h: k for k, h in enumerate(x["own"] for x in side)} for side in (a, b)]
    often = [Counter(x["own"] for x in side) for side in (a, b)]
    fixed = [h for h in once[0] if often[0][h] == 1 == often[1].get(h, 0)]
    other = sorted(fixed, key=once[1].get)
    rows, i, k = [], 0, 0
    for at, to, n in SequenceMatcher(None, fixed, other, autojunk=False).get_matching_blocks():
        for h in fixed[at : at + n]:
            j, m = once[0][h], once[1][h]
            rows += _apart(a[i:j], b[k:m]) if j > i or m > k else []
            i, k = j + 1, m + 1
    rows += _apart(a[i:], b[k:])
    cells = [[x["page_id"], x["part"], x["first"], x["end"] - x["first"], x["size"], state] for x, state in rows]
    kinds = [pa.int64()] * 5 + [pa.string()]
    names = ["page_id", "part", "offset", "length", "size", "state"]
    return pa.table({n: pa.array([c[k] for c in cells], t) for k, (n, t) in enumerate(zip(names, kinds))})


FOUND = "page_id long, part long, offset long, length long, size long, state string"


STRETCH = ["part", "anchor", "nth"]


def unlike_leaves(own: Tree, other: Tree) -> list[DataFrame]:
    """(part, anchor, nth, and the leaf) of either tree: the leaves below nodes that the other tree's file doesn't have.

    From the files' roots down, a level at a time, the children of such nodes alone are read. (anchor, nth) names the
    stretch in which a leaf stands, between nodes that both have.
    """
    a, b = own.level(-1).alias("a"), other.level(-1).alias("b")
    unlike = a.join(b, "part", "full").where(~F.col("a.hash").eqNullSafe(F.col("b.hash")))
    files, _ = save(unlike.select("part", F.col("a.first").alias("a"), F.col("b.first").alias("b")), "files")
    sides = [(own, "a"), (other, "b")]
    found: list[DataFrame | None] = [None, None]
    for k in range(files.agg(F.max(F.greatest("a", "b"))).first()[0], 0, -1):
        near = []
        for (tree, side), last in zip(sides, found):
            nodes = tree.level(k).select("part", "node", "parent", "hash", "before")
            wanted = nodes.where("parent is null").join(files.where(F.col(side) == k).select("part"), "part", "left_semi")
            if last is not None:
                wanted = wanted.union(nodes.join(last.select("part", F.col("node").alias("parent")), ["part", "parent"], "left_semi").select(*nodes.columns))
            near.append(wanted)
        found = [save(_unlike(x, y), "differing")[0] for x, y in (near, near[::-1])]
    leaves = []
    for (tree, _), groups in zip(sides, found):
        rows = tree.level(0).select("part", "parent", "node", "first", "end", "own", "page_id", "size").join(_stretches(groups), ["part", "parent"])
        leaves.append(save(rows.select(*STRETCH, "node", "first", "end", "own", "page_id", "size"), "leaves")[0])
    return leaves


def differences(own: Tree, other: Tree) -> DataFrame:
    """(page_id, part, offset, length, size, state) of the records that are not the same in both replicas.

    state is damaged (the bytes differ), missing (other lacks the record) or extra (only other has it;
    place and size are then other's, else own's). A record that only one replica's file holds may be a
    file that the other lacks. page_id and size (bytes of the record) are null where it can't be read.
    Equal roots end it at once.
    """
    if own.root == other.root:
        return own.nodes.sparkSession.createDataFrame([], FOUND)
    a, b = unlike_leaves(own, other)
    return a.groupBy(*STRETCH).cogroup(b.groupBy(*STRETCH)).applyInArrow(_align, FOUND)


def audit(spark: SparkSession, path: str, other: str, fan: int = FAN) -> DataFrame:
    """(page_id, part, offset, length, size, state) of all records of the replica at `path`, and those that only `other` has.

    state is intact where both replicas hold the same bytes at the same place of the same file (or, in a
    file that has lost or gained records, in the same order); see `differences` for the rest. Two empty
    replicas give an empty table.
    """
    own = Tree(spark, path, fan)
    found, _ = save(differences(own, Tree(spark, other, fan)), "found")
    bad = found.where("state <> 'extra'").select("part", "offset", "state")
    leaves = own.level(0).select("page_id", "part", F.col("first").alias("offset"), (F.col("end") - F.col("first")).alias("length"), "size")
    kept = leaves.join(bad, ["part", "offset"], "left").select("page_id", "part", "offset", "length", "size", F.coalesce("state", F.lit("intact")).alias("state"))
    return kept.union(found.where("state = 'extra'"))


def copy_files(spark: SparkSession, path: str, other: str, change: Callable[[int | None, bytes], list[bytes]] | None = None) -> None:
    """Copy the WARC files at `path` to `other`; change(page_id, member) says which members stand there in a member's stead."""

    def run(batches):
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                content, parts = data.as_buffer().to_pybytes(), []
                for at, length, record in split_members(content):
                    page = dict(fields(record)[0]).get("Page-ID", "") if record is not None else ""
                    parts += change(int(page) if page else None, content[at : at + length]) if change else [content[at : at + length]]
                yield pa.RecordBatch.from_arrays([pa.array([_part(name)], pa.int64()), pa.array([EMPTY.join(parts)], pa.binary())], names=["part", "member"])

    _write(_files(spark, path).mapInArrow(run, "part long, member binary"), other)


def wear(page_id: int | None, member: bytes) -> list[bytes]:
    """The damage that the query does to its second replica: a byte turned, a record lost, a record twice."""
    if page_id is None:
        return [member]
    if page_id % 101 == 5:
        at = len(member) // 2
        return [member[:at] + bytes([member[at] ^ 0x55]) + member[at + 1 :]]
    return [] if page_id % 1009 == 7 else [member, member] if page_id % 1013 == 11 else [member]


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record in an archive on disk: its size and its state in a second archive, copied and then damaged."""

    def make() -> DataFrame:
        path, other = new_path(spark, "warc"), new_path(spark, "warc-copy")
        write_files(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
        copy_files(spark, path, other, wear)
        return audit(spark, path, other).select("page_id", F.col("size").alias("length"), "state")

    return settled(spark, "op6", make)


OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(url, '') u, coalesce(html, '') h FROM pages),
r AS (SELECT page_id, (strlen(h) + strlen(u) + strlen(strlen(h)::VARCHAR) + strlen(page_id::VARCHAR) + 208)::BIGINT AS length FROM p)
SELECT page_id, length, CASE WHEN page_id % 101 = 5 THEN 'damaged' WHEN page_id % 1009 = 7 THEN 'missing' ELSE 'intact' END AS state FROM r
UNION ALL SELECT page_id, length, 'extra' FROM r WHERE page_id % 1013 = 11 AND page_id % 101 <> 5"""
