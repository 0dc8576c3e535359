"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding, with control bytes apart.

A file set is a folder of three Parquet tables:

* `blocks`: part, block, start (ids in the part before), doc_ids, counts (ids of each document), control, data. Four ids share one
  control byte (two bits each: bytes of the id less one, lowest bits first); `data` holds the ids' own
  bytes, little-endian. What is coded is the rank of an id by falling frequency, so most take one byte.
* `ranks`: token, rank. At most one row for each token of the vocabulary.
* `parts`: part, base. Ids in all parts before.

Parts are ranges of ascending doc_id and blocks follow each other in a part, so (part, block) is the
order of documents. Decoding looks control bytes up in a table of lengths and shifts whole arrays.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .common import documents, drop_path, new_path, save, settled, trim

#: Bytes of each of the four ids of a control byte.
LENGTHS = np.array([[(c >> (2 * k) & 3) + 1 for k in range(4)] for c in range(256)], np.int64)
#: Ids of a block, about.
BLOCK = 1 << 18
#: Bytes of text that one step encodes: each looks its parts up in the whole memory, so large steps are cheap ones.
STEP = 12_000_000


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of unsigned 32-bit values."""
    values = values.astype("<u4")
    sizes = 1 + (values > 0xFF) + (values > 0xFFFF) + (values > 0xFFFFFF)
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = sizes - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    raw = values.view(np.uint8).reshape(-1, 4)
    return control.tobytes(), raw[np.arange(4) < sizes[:, None]].tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The values that `pack` coded."""
    sizes = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:count]
    starts = np.cumsum(sizes) - sizes
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)])
    out = raw[starts].astype(np.uint32)
    for k in (1, 2, 3):
        at = np.flatnonzero(sizes > k)
        if len(at):
            out[at] |= raw[starts[at] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


class Library(bpe.Parts):
    """Ids by the tokenizers library; it gets each distinct part of a text once."""

    remembered_bytes = 112_000_000

    def __init__(self, text: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(text)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.special = {x.content: k for k, x in self.tokenizer.get_added_tokens_decoder().items()}
        super().__init__()

    def encode_new(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """One text of all parts with a special token between them: the library makes results per text, not per part."""
        if not self.special:
            ids = [x.ids for x in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
            return np.array([k for x in ids for k in x], np.int32), np.array([len(x) for x in ids], np.int64)
        between, mark = next(iter(self.special.items()))
        flat, lengths = [], []
        for at in range(0, len(parts), 2048):
            ids = np.array(self.tokenizer.encode_batch_fast([between.join(parts[at : at + 2048])], add_special_tokens=False)[0].ids, np.int32)
            ends = np.append(np.flatnonzero(ids == mark), len(ids))
            lengths.append(np.diff(ends, prepend=-1) - 1)
            flat.append(ids[ids != mark])
        return np.concatenate(flat), np.concatenate(lengths)


def width(size: int) -> str:
    """The type in which ids of a vocabulary of `size` are held between steps."""
    return "<u2" if size <= 1 << 16 else "<u4"


ENCODED = "doc_id long, ids binary, counts binary"


def _tokenise(vocabulary, end: int | None, kind: str):
    """doc_id and ids of each text (`end` after them), and at the end of a task one row with the counts of all its ids."""

    def run(batches):
        own = bpe.loaded(Library, vocabulary.value)
        tail = b"" if end is None else np.array([end], kind).tobytes()
        total = np.zeros(own.tokenizer.get_vocab_size() + 1, np.int64)
        for batch in batches:
            ids, at = [], 0
            for part in bpe.in_chunks(batch.column(1), STEP):
                rows = own.encode(part)
                flat, ends = rows.values.to_numpy(), rows.offsets.to_numpy()
                seen = np.bincount(flat, minlength=len(total))
                if len(seen) > len(total):
                    total = np.concatenate([total, np.zeros(len(seen) - len(total), np.int64)])
                total += seen
                narrow = flat.astype(kind)
                ids += [narrow[a:b].tobytes() + tail for a, b in zip(ends[:-1], ends[1:])]
                at += len(part)
            if end is not None:
                if end >= len(total):
                    total = np.concatenate([total, np.zeros(end + 1 - len(total), np.int64)])
                total[end] += len(ids)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), pa.nulls(len(ids), pa.binary())], names=["doc_id", "ids", "counts"])
            del ids, batch
            trim()
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([total.astype("<i8").tobytes()], pa.binary())], names=["doc_id", "ids", "counts"])

    return run


def _add_counts(batches):
    """token, n of count rows."""
    total = np.zeros(0, np.int64)
    for batch in batches:
        for row in batch.column(0).to_pylist():
            own = np.frombuffer(row, "<i8")
            size = max(len(own), len(total))
            total = np.pad(total, (0, size - len(total))) + np.pad(own, (0, size - len(own)))
    tokens = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(total[tokens])], names=["token", "n"])


BLOCKS = "part int, block long, start long, doc_ids array<long>, counts array<long>, control binary, data binary"


def _blocks(ranks: np.ndarray, kind: str):
    def write(batches):
        from pyspark import TaskContext

        part, block, start = TaskContext.get().partitionId(), 0, 0
        docs: list = []
        rows: list[bytes] = []
        held, size = 0, np.dtype(kind).itemsize

        def cut():
            nonlocal block, start, docs, rows, held
            ids = np.frombuffer(b"".join(rows), kind)
            control, data = pack(ranks[ids])
            counts = [len(x) // size for x in rows]
            made = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int64()), pa.array([start], pa.int64()), pa.array([docs], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64())), pa.array([control], pa.binary()), pa.array([data], pa.binary())],
                names=["part", "block", "start", "doc_ids", "counts", "control", "data"],
            )
            block, start, docs, rows, held = block + 1, start + len(ids), [], [], 0
            return made

        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                docs.append(doc)
                rows.append(ids)
                held += len(ids) // size
                if held >= BLOCK:
                    yield cut()
        if docs:
            yield cut()

    return write


def write_ids(df: DataFrame, path: str, vocabulary: str, end: int | None = None, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode `text` of every row with the tokenizers library and write the file set to `path`.

    Rows are in ascending doc_id, null first; rows with equal doc_id stand side by side in order of
    their ids, so repeated rows give the same files whatever their order. Null and empty texts have no ids but `end`. An
    empty table gives empty files. Other columns are not written.
    """
    spark = df.sparkSession
    shared, kind = spark.sparkContext.broadcast(vocabulary), width(max(Library(vocabulary).tokenizer.get_vocab_size(), (end or 0) + 1))
    ids, held = save(df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_tokenise(shared, end, kind), ENCODED), "ids")
    counts = ids.where("counts is not null").select("counts").mapInArrow(_add_counts, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    found = sorted(((r.n, -r.token) for r in counts.collect()), reverse=True)  # one row for each token of the vocabulary at most
    tokens = [-k for _, k in found]
    spark.createDataFrame([(t, k) for k, t in enumerate(tokens)], "token long, rank long").coalesce(1).write.parquet(f"{path}/ranks")
    ranks = np.zeros(max(tokens, default=0) + 1, np.uint32)
    ranks[tokens] = np.arange(len(tokens))
    ordered = ids.where("ids is not null").select("doc_id", "ids").repartitionByRange(F.col("doc_id").asc()).sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(_blocks(ranks, kind), BLOCKS).write.option("compression", "zstd").parquet(f"{path}/blocks")
    drop_path(spark, held)
    blocks = spark.read.parquet(f"{path}/blocks")
    sums = blocks.groupBy("part").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    base, rows = 0, []
    for r in sorted(sums.collect()):  # one row for each part
        rows.append((r.part, base))
        base += r.n
    spark.createDataFrame(rows, "part int, base long").coalesce(1).write.parquet(f"{path}/parts")


def scan(spark: SparkSession, path: str, make, kind: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and `value` from the files at `path`.

    value, of SQL type kind, is made from a block's ids where they are decoded: make(ids, ends) gives an Arrow
    array with an entry for each document, whose ids end at `ends`.
    """
    tokens = np.array([r.token for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()], np.uint32)
    bases = {r.part: r.base for r in spark.read.parquet(f"{path}/parts").collect()}
    blocks = spark.read.parquet(f"{path}/blocks").select("part", "start", "doc_ids", "counts", "control", "data")

    def rows(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                part, start, docs, counts, control, data = (batch.column(c)[k] for c in range(6))
                counts = counts.values.to_numpy()
                ends = np.concatenate([[0], np.cumsum(counts)])
                ids = tokens[unpack(control.as_buffer(), data.as_buffer(), int(ends[-1]))] if ends[-1] else np.zeros(0, np.uint32)
                yield pa.RecordBatch.from_arrays([docs.values, pa.array(ends[:-1] + (bases[part.as_py()] + start.as_py())), pa.array(counts), make(ids, ends)], names=["doc_id", "start", "n_tokens", "value"])

    return blocks.mapInArrow(rows, f"doc_id long, start long, n_tokens long, value {kind}")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (array<int>) from the files at `path`."""
    make = lambda ids, ends: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32)))
    return scan(spark, path, make, "array<int>").withColumnRenamed("value", "ids")


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, crc32 of the ids as little-endian unsigned 32-bit integers."""

    def make(ids, ends):
        flat = ids.astype("<u4")
        return pa.array([zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.int64())

    return scan(spark, path, make, "long").withColumnRenamed("value", "crc32")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written to files and read back: place, count and checksum."""
    import public_tokenizers

    vocabulary = bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))

    def make() -> DataFrame:
        path = new_path(spark, "idfile")
        write_ids(documents(spark, sf_dir), path, vocabulary, end=2)
        return read_checksums(spark, path).withColumnRenamed("crc32", "ids_crc32")

    return settled(spark, "op4", make)
