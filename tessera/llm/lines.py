"""Line dedup across documents, decided on hashes and returned as bitmaps.

Each line that is long enough gives a 128-bit hash of its key, its document and its position. Hashes
are dealt out by range of (hash, doc_id) and sorted within, so a task streams over them and sees the
first document of each hash first; a hash with very many documents runs on over several tasks. Only
the first run of a task may have begun in an earlier one: its first document is settled afterwards
from one short row of each task. What comes back is a compressed bitmap of kept lines per document;
texts travel once, when bitmaps are applied to them.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, fresh, save, settled, trim

#: Keys of fewer code points never are dropped.
SHORTEST = 10


def line_key(line: bytes) -> bytes:
    """A line without white space at its ends and with A-Z in lower case."""
    return line.strip(b" \t\n\r\x0b\x0c").lower()


def _points(key: bytes) -> int:
    return len(key) if key.isascii() else len(key.decode("utf-8", "replace"))


def _hashes(shortest: int):
    def run(batches):
        from xxhash import xxh3_128_digest

        for batch in batches:
            docs, texts, data = (c.to_pylist() for c in batch.columns)
            out_doc, out_text, out_pos, out_hash = [], [], [], []
            for doc, own, text in zip(docs, texts, data):
                for pos, line in enumerate((text or b"").split(b"\n")):
                    key = line_key(line)
                    if len(key) >= shortest and (len(key) >= 4 * shortest or _points(key) >= shortest):
                        out_doc.append(doc)
                        out_text.append(own)
                        out_pos.append(pos)
                        out_hash.append(xxh3_128_digest(key))
            halves = np.frombuffer(b"".join(out_hash), ">i8").astype(np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(halves[:, 0])), pa.array(np.ascontiguousarray(halves[:, 1])), pa.array(out_doc, pa.int64()), pa.array(out_text, pa.int64()), pa.array(out_pos, pa.int32())],
                names=["hi", "lo", "doc_id", "text_id", "pos"],
            )

    return run


DROPPED, OPEN, LAST = 0, 1, 2


def _first_seen(batches):
    """Streams sorted rows; gives DROPPED lines, OPEN ones of the first run's first document, and the LAST run's first document."""
    first_run, key, first_doc = True, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        hi, lo = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        doc_null = batch.column(2).is_null().to_numpy(zero_copy_only=False)
        doc = batch.column(2).fill_null(0).to_numpy()
        new = np.ones(len(hi), bool)
        new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
        new[0] = key is None or key != (hi[0], lo[0])
        starts = np.flatnonzero(new)
        run = np.cumsum(new) - 1  # -1: the run goes on from the batch before
        head_doc, head_null = doc[starts], doc_null[starts]
        if not new[0]:
            run, head_doc, head_null = run + 1, np.concatenate([[first_doc[0]], head_doc]), np.concatenate([[first_doc[1]], head_null])
        own = (doc == head_doc[run]) & (doc_null == head_null[run])
        kind = np.where(own, -1, DROPPED)
        if first_run:
            begun = key is not None and not new[0]
            opened = run == 0 if key is None or begun else np.zeros(len(run), bool)
            kind[own & opened] = OPEN
            if run[-1] > 0 or not (key is None or begun):
                first_run = False
        key, first_doc = (hi[-1], lo[-1]), (head_doc[-1], bool(head_null[-1]))
        at = np.flatnonzero(kind >= 0)
        if len(at):
            some = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*some.columns, pa.array(kind[at].astype(np.int32))], names=[*batch.schema.names, "kind"])
    if key is not None and not first_run:
        values = [key[0], key[1], None if first_doc[1] else int(first_doc[0]), None, None, LAST]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=["hi", "lo", "doc_id", "text_id", "pos", "kind"])


def bitmaps():
    """Column function array<int> of dropped positions -> compressed bitmap, 1 for each line that stays."""

    @F.arrow_udf("binary")
    def own(rows: pa.Array) -> pa.Array:
        out = []
        for row in rows:
            at = row.values.to_numpy()
            keep = np.ones((int(at.max()) // 8 + 1) * 8, np.uint8)
            keep[at] = 0
            out.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes(), 1))
        return pa.array(out, pa.binary())

    return own


def text_id(text: Column) -> Column:
    """Tells rows of one doc_id with different texts apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def keep_bitmaps(df: DataFrame, shortest: int = SHORTEST, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_id, bitmap) of the documents that lose lines; lines beyond a bitmap's end stay.

    A line goes if its key (see `line_key`) has at least `shortest` code points and an other document
    with a smaller doc_id holds it. Lines that a document repeats share their fate. A null doc_id comes
    after all others, and rows with one doc_id are one document. Null texts count as empty. An empty
    table gives an empty one.
    """
    thin = df.select(F.col(doc_id).cast("long").alias("doc_id"), text_id(F.col(text)).alias("text_id"), F.col(text).cast("binary").alias("data"))
    # written, as dealing by range reads its input twice
    hashed, _ = save(thin.mapInArrow(_hashes(shortest), "hi long, lo long, doc_id long, text_id long, pos int"), "hashes")
    order = [F.col("hi"), F.col("lo"), F.col("doc_id").asc_nulls_last()]
    found = hashed.repartitionByRange(*order).sortWithinPartitions(*order, "text_id", "pos").mapInArrow(_first_seen, "hi long, lo long, doc_id long, text_id long, pos int, kind int")
    found, _ = save(found, "lines")
    last = F.coalesce(F.col("doc_id"), F.lit(2**63 - 1))
    first = found.where(f"kind <> {DROPPED}").groupBy("hi", "lo").agg(F.min(last).alias("first"), F.min(F.col("doc_id").isNull()).alias("no_id"))
    late = found.where(f"kind = {OPEN}").join(first, ["hi", "lo"]).where((last > F.col("first")) | (F.col("doc_id").isNull() & ~F.col("no_id")))
    dropped = found.where(f"kind = {DROPPED}").select("doc_id", "text_id", "pos").union(late.select("doc_id", "text_id", "pos"))
    return dropped.groupBy("doc_id", "text_id").agg(F.collect_set("pos").alias("at")).select("doc_id", "text_id", bitmaps()(F.col("at")).alias("bitmap"))


def apply_bitmaps():
    """Column function (text, bitmap) -> struct(kept text, n_lines, n_dropped)."""

    @F.arrow_udf("struct<kept:string,n_lines:bigint,n_dropped:bigint>")
    def own(texts: pa.Array, maps: pa.Array) -> pa.Array:
        kept, lines, dropped = [], [], []
        for text, packed in zip(texts.to_pylist(), maps.to_pylist()):
            text = text or ""
            if packed is None:
                kept.append(text)
                lines.append(text.count("\n") + 1)
                dropped.append(0)
                continue
            parts = text.split("\n")
            keep = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8), bitorder="little")[: len(parts)].tolist()
            keep += [1] * (len(parts) - len(keep))
            stay = [p for p, k in zip(parts, keep) if k]
            kept.append("\n".join(stay))
            lines.append(len(parts))
            dropped.append(len(parts) - len(stay))
        done = pa.StructArray.from_arrays([pa.array(kept, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], names=["kept", "n_lines", "n_dropped"])
        del kept, texts, maps
        trim()
        return done

    return own


def _applied(df: DataFrame, shortest: int, doc_id: str, text: str) -> tuple[DataFrame, str]:
    """(df with a column struct(kept, n_lines, n_dropped), its name)."""
    doc, of, packed, done = fresh(df, "doc", "of", "map", "done")
    maps = keep_bitmaps(df, shortest, doc_id, text).select(F.col("doc_id").alias(doc), F.col("text_id").alias(of), F.col("bitmap").alias(packed))
    same = text_id(df[text]).eqNullSafe(F.col(of)) & df[doc_id].cast("long").eqNullSafe(F.col(doc))
    found = df.join(maps.hint("shuffle_hash"), same, "left")
    return found.withColumn(done, apply_bitmaps()(F.col(text), F.col(packed))).drop(doc, of, packed), done


def dedup_lines(df: DataFrame, shortest: int = SHORTEST, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """df with columns kept (text of the lines that stay), n_lines and n_dropped; columns of those names are replaced.

    Every row stays, with an empty text if all its lines go. See `keep_bitmaps` for what goes.
    """
    found, done = _applied(df, shortest, doc_id, text)
    return found.withColumns({c: F.col(f"{done}.{c}") for c in ("kept", "n_lines", "n_dropped")}).drop(done)


def without_repeats(df: DataFrame, shortest: int = SHORTEST, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """df with each text less the lines that go (see `keep_bitmaps`); all other columns as they are, every row stays."""
    found, done = _applied(df, shortest, doc_id, text)
    return found.withColumn(text, F.col(f"{done}.kept")).select(*df.columns)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines, lines dropped and digest of what stays."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return settled(spark, "op8", lambda: dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", digest))


#: The white space of the contract, and letters.
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
OP8_SQL = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) ls FROM documents),
l AS (SELECT doc_id, unnest(ls) line, unnest(range(1, len(ls) + 1)) pos FROM d),
k AS (SELECT doc_id, pos, line, translate(trim(line, {_WHITE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') key FROM l),
f AS (SELECT key, min(doc_id) first FROM k WHERE length(key) >= 10 GROUP BY key),
m AS (SELECT k.doc_id, pos, line, coalesce(k.doc_id > f.first, false) gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""
