"""BPE and token-id files against the tokenizers library."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import bpe, idfile
from tessera.llm.common import new_path

from .conftest import ODD, made_up

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_padding()
    t.no_truncation()
    return t


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(bpe.read_vocabulary(PATH))


def expected(library, texts):
    return [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_same_ids_and_text_as_the_library(library, vocabulary):
    texts = [t for t in ODD if t is not None] + made_up(1, 200) + ["ab" * 400 + " " + "!" * 700, "x" * 49, "日本" * 60]
    ids = vocabulary.encode(pa.array(texts)).to_pylist()
    assert ids == expected(library, texts)
    for own in ids:
        assert vocabulary.decode(np.array(own, np.int32)) == library.decode(own, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=4))
def test_any_text(texts):
    library = Tokenizer.from_file(PATH)
    own = bpe.loaded(bpe.Vocabulary, bpe.read_vocabulary(PATH))
    assert own.encode(pa.array(texts, pa.string())).to_pylist() == expected(library, texts)


def test_short_rows_and_heap_agree(vocabulary):
    for word in ("tokenization", "aaaaaaaaaaaaaaaa", "ththththth", "Ġx", "a"):
        assert vocabulary.short([word.encode()], 48)[0] == vocabulary.long(word.encode())


def test_memory_of_parts_is_bounded(vocabulary, monkeypatch, library):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    texts = made_up(2, 30)
    for t in texts:
        assert vocabulary.encode(pa.array([t])).to_pylist() == expected(library, [t])
        assert len(vocabulary.known) < 50 + len(t)


def test_frame(spark, odd_documents, no_documents, library):
    json_text = bpe.read_vocabulary(PATH)
    done = bpe.round_trip(odd_documents.withColumn("ids", F.lit("old")), json_text)
    two = bpe.decode(bpe.encode(odd_documents, json_text), json_text)
    rows = sorted((r.doc_id or -1, r.text or "", tuple(r.ids), r.decoded) for r in done.collect())
    assert rows == sorted((r.doc_id or -1, r.text or "", tuple(r.ids), r.decoded) for r in two.collect())
    assert len(rows) == odd_documents.count()
    for _, text, ids, decoded in rows:
        assert list(ids) == library.encode(text, add_special_tokens=False).ids and decoded == text
    assert bpe.round_trip(no_documents, json_text).collect() == []


def test_decode_of_bad_ids(spark):
    df = spark.createDataFrame([([50, None, -3, 999999, 51],), ([],), (None,)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(df, bpe.read_vocabulary(PATH)).collect()] == ["ST", "", None]


@given(st.lists(st.integers(0, 2**32 - 1), max_size=300))
@settings(max_examples=60, deadline=None)
def test_variable_length_coding(values):
    v = np.array(values, np.uint32)
    control, data = idfile.pack(v)
    assert len(control) == -(-len(v) // 4)
    assert (idfile.unpack(control, data, len(v)) == v).all()


def test_files(spark, odd_documents, no_documents, library, monkeypatch):
    monkeypatch.setattr(idfile, "BLOCK", 64)
    path = new_path(spark, "test-ids")
    idfile.write_ids(odd_documents.repartition(3), path, bpe.read_vocabulary(PATH), end=2)
    sums = {r.start: r.crc32 for r in idfile.read_checksums(spark, path).collect()}
    got = sorted((r.start, r.doc_id, tuple(r.ids), sums[r.start]) for r in idfile.read_ids(spark, path).collect())
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, library.encode(r.text or "", add_special_tokens=False).ids + [2]) for r in odd_documents.collect()), key=lambda r: (r[0], r[1], np.array(r[2], "<u2").tobytes()))
    start = 0
    for (at, doc, ids, crc), (there, want_doc, want) in zip(got, rows, strict=True):
        assert (at, doc, list(ids)) == (start, want_doc if there else None, want)
        assert crc == zlib.crc32(np.array(want, "<u4").tobytes())
        start += len(want)
    empty = new_path(spark, "test-ids")
    idfile.write_ids(no_documents, empty, bpe.read_vocabulary(PATH))
    assert idfile.read_ids(spark, empty).collect() == []
