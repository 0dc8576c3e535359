"""Byte-level BPE encoding and decoding by contiguous rank arrays.

Each short word holds its part ids and the ranks of neighbouring parts in one contiguous row. The
row is scanned for its smallest rank, the boundary there is deleted (the rest of the row moves up)
and the two neighbouring ranks are looked up afresh, until no rank is left. Rows of many words form
a matrix, so numpy does each step for all of them at once. Words longer than `SHORT` bytes, where
repeated scans would cost the square of the length, take a heap over the same ranks instead; both
give the merges in order of (rank, position).
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, fresh, trim

SHORT = 48
NONE = np.int32(2**31 - 1)
#: Parts of texts that a Python worker remembers, in Arrow arrays, and bytes of these arrays; beyond either it starts afresh.
REMEMBERED, REMEMBERED_BYTES = 1_000_000, 48_000_000
#: Longer parts are encoded each time and not remembered.
LONGEST = 256
#: Bytes of text that one step encodes; each step looks its parts up in the memory at once.
ENCODED = 6_000_000
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The split of the byte-level vocabulary into words, as its file's pre-tokenizer defines it.
WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
_WORDS = regex.compile(WORDS)
_RUN = regex.sub(r"\\u(....)", r"\\x{\1}", f"[{SPACE}]{{2}}|\\x00")


def byte_symbols() -> dict[str, int]:
    """The printable symbol that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Parts:
    """Ids of texts through a bounded memory of parts that no word crosses.

    Where no white space stands beside another, a space always begins a word and a line end is one, so
    Arrow cuts the texts there, numbers the distinct parts, and only those not yet known are encoded;
    other texts go through the whole pattern. `special` maps texts of special tokens to ids.
    """

    special: dict[str, int]
    #: Bytes of the memory's arrays beyond which it starts afresh.
    remembered_bytes = REMEMBERED_BYTES

    def __init__(self) -> None:
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.forget()

    def forget(self) -> None:
        self.known = pa.array(["", *self.special], pa.string())
        self.flat = np.array(list(self.special.values()), np.int32)
        self.lengths = np.array([0] + [1] * len(self.special), np.int64)

    def encode_new(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts one after the other, and how many each has."""
        raise NotImplementedError

    def numbers(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of each of some distinct parts, ids, ids of each place); new parts are encoded.

        Ids and their numbers are those of the memory, then those of long parts, which it doesn't hold.
        """
        if len(self.known) > REMEMBERED or self.known.nbytes + self.flat.nbytes + self.lengths.nbytes > self.remembered_bytes:
            self.forget()
        long = pc.greater(pc.binary_length(parts), LONGEST)
        at = pc.index_in(parts, value_set=self.known)
        unknown = pc.is_null(at)
        places = at.fill_null(-1).to_numpy().astype(np.int64)
        new = parts.filter(pc.and_not(unknown, long))
        if len(new):
            places[pc.and_not(unknown, long).to_numpy(zero_copy_only=False)] = np.arange(len(self.known), len(self.known) + len(new))
            self.flat, self.lengths = self.extended(self.flat, self.lengths, new)
            self.known = pa.concat_arrays([self.known, new])
        rest = pc.and_(unknown, long).to_numpy(zero_copy_only=False)
        if not rest.any():
            return places, self.flat, self.lengths
        places[rest] = len(self.lengths) + np.arange(rest.sum())
        return places, *self.extended(self.flat, self.lengths, parts.filter(pa.array(rest)))

    def extended(self, flat: np.ndarray, lengths: np.ndarray, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        made = [(flat, lengths)] + [self.encode_new(parts.slice(k, 16_384).to_pylist()) for k in range(0, len(parts), 16_384)]
        return np.concatenate([f for f, _ in made]), np.concatenate([n for _, n in made])

    def gather(self, parts: pa.DictionaryArray, ends: np.ndarray) -> pa.Array:
        """list<int32> of the ids of rows whose parts end at `ends`."""
        numbers, flat, lengths = self.numbers(parts.dictionary)
        numbers = numbers[parts.indices.to_numpy()] if len(parts) else np.zeros(0, np.int64)
        sizes = lengths[numbers]
        starts = (np.cumsum(lengths) - lengths)[numbers]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        places = np.repeat((starts - upto[:-1]).astype(np.int32), sizes) + np.arange(upto[-1], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(upto[ends].astype(np.int32)), pa.array(flat[places]))

    def plain(self, texts: pa.Array) -> pa.Array:
        cut = pc.split_pattern(pc.replace_substring(pc.replace_substring(texts, " ", "\0 "), "\n", "\0\n\0"), "\0")
        known = cut.values.slice(cut.offsets[0].as_py(), cut.offsets[-1].as_py() - cut.offsets[0].as_py()).dictionary_encode()
        offsets = cut.offsets.to_numpy()
        return self.gather(known, offsets - offsets[0])

    def other(self, texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts.to_pylist():
            parts = self.cut.split(text) if self.cut is not None else [text]
            rows.append([w for k, part in enumerate(parts) for w in ([part] if k % 2 else _WORDS.findall(part))])
        words = pa.array(list(chain.from_iterable(rows)), pa.string()).dictionary_encode()
        return self.gather(words, np.cumsum([0, *map(len, rows)]))

    def encode(self, texts: pa.Array) -> pa.Array:
        """list<int32> of string texts. Special tokens written out in a text become their ids; null gives none."""
        texts = texts.fill_null("")
        odd = pc.match_substring_regex(texts, _RUN)
        for token in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, token))
        if not pc.any(odd).as_py():
            return self.plain(texts)
        mask = odd.to_numpy(zero_copy_only=False)
        both = pa.concat_arrays([self.plain(texts.filter(pc.invert(odd))), self.other(texts.filter(odd))])
        back = np.empty(len(mask), np.int64)
        back[np.concatenate([np.flatnonzero(~mask), np.flatnonzero(mask)])] = np.arange(len(mask))
        return both.take(pa.array(back))


class Vocabulary(Parts):
    """Merge ranks, ids and bytes of a byte-level BPE vocabulary in the tokenizers library's JSON."""

    def __init__(self, text: str) -> None:
        data = json.loads(text)
        symbols = byte_symbols()
        vocab = data["model"]["vocab"]
        self.size = max(max(vocab.values()), *(x["id"] for x in data["added_tokens"]), 0) + 1
        self.bytes: list[bytes] = [b""] * self.size
        for token, k in vocab.items():
            self.bytes[k] = bytes(symbols[c] for c in token) if all(c in symbols for c in token) else token.encode()
        self.special = {x["content"]: x["id"] for x in data["added_tokens"]}
        for token, k in self.special.items():
            self.bytes[k] = token.encode()
        self.first = np.array([vocab[c] for c, _ in sorted(symbols.items(), key=lambda x: x[1])], np.int32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank_of_key = np.append(keys[order], np.int64(2**62)), np.append(order, NONE).astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int32)
        pairs = self.first.astype(np.int64)[:, None] * self.size + self.first[None, :]
        self.of_bytes = self.ranks(pairs.ravel()).reshape(256, 256)
        self.rank_of_pair: dict[int, int] | None = None
        super().__init__()

    def ranks(self, pairs: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, pairs)
        return np.where(self.keys[at] == pairs, self.rank_of_key[at], NONE)

    def short(self, words: list[bytes], width: int) -> list[list[int]]:
        """Ids of words of 1 to width bytes."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
        ids = self.first[raw]
        ranks = np.full((len(words), width), NONE, np.int32)
        ranks[:, : width - 1] = self.of_bytes[raw[:, :-1], raw[:, 1:]]
        columns = np.arange(width)
        ranks[columns[None, :] >= (lengths - 1)[:, None]] = NONE
        out: list[list[int]] = [[]] * len(words)
        rows = np.arange(len(words))
        while len(rows):
            at = ranks.argmin(1)
            best = ranks[np.arange(len(rows)), at]
            if (done := best == NONE).any():
                for k, x, n in zip(rows[done].tolist(), ids[done].tolist(), lengths[done].tolist()):
                    out[k] = x[:n]
                go = ~done
                rows, ids, ranks, lengths, at, best = rows[go], ids[go], ranks[go], lengths[go], at[go], best[go]
                if not len(rows):
                    break
            n = np.arange(len(rows))
            ids[n, at] = self.merged[best]
            # delete the boundary: what follows moves up by one
            up = columns[None, :-1] > at[:, None]
            ids[:, :-1] = np.where(up, ids[:, 1:], ids[:, :-1])
            ranks[:, :-1] = np.where(columns[None, :-1] >= at[:, None], ranks[:, 1:], ranks[:, :-1])
            lengths = lengths - 1
            # refresh the ranks on both sides of the new part
            mid = ids[n, at].astype(np.int64)
            left = np.maximum(at - 1, 0)
            with_left = self.ranks(ids[n, left] * np.int64(self.size) + mid)
            ranks[n, left] = np.where(at > 0, with_left, ranks[n, left])
            right = np.minimum(at + 1, width - 1)
            ranks[n, at] = np.where(at + 1 < lengths, self.ranks(mid * self.size + ids[n, right]), NONE)
        return out

    def long(self, word: bytes) -> list[int]:
        """Ids of a word of any length: a heap of (rank, position) over linked parts."""
        if self.rank_of_pair is None:
            self.rank_of_pair = dict(zip(self.keys[:-1].tolist(), self.rank_of_key[:-1].tolist()))
        table, size, merged = self.rank_of_pair, self.size, self.merged
        ids = self.first[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, k, ids[k], ids[k + 1]) for k in range(n - 1) if (r := table.get(ids[k] * size + ids[k + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, k, a, b = heapq.heappop(heap)
            m = after[k]
            if ids[k] != a or m >= n or ids[m] != b:
                continue
            ids[k], ids[m] = int(merged[r]), -1
            after[k] = after[m]
            if after[m] < n:
                before[after[m]] = k
            for p, q in ((before[k], k), (k, after[k])):
                if p >= 0 and q < n and (r := table.get(ids[p] * size + ids[q])) is not None:
                    heapq.heappush(heap, (r, p, ids[p], ids[q]))
        return [x for x in ids if x >= 0]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(words)
        groups: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            if len(w) > SHORT:
                out[k] = self.long(w)
            elif w:
                groups.setdefault(4 if len(w) <= 4 else 8 if len(w) <= 8 else 16 if len(w) <= 16 else SHORT, []).append(k)
        for width, at in groups.items():
            for part in range(0, len(at), 20_000):
                some = at[part : part + 20_000]
                for k, ids in zip(some, self.short([words[j] for j in some], width)):
                    out[k] = ids
        return out

    def encode_new(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        split = [[p] if p[1:].isalpha() and (p[0] == " " or p[0].isalpha()) else _WORDS.findall(p) for p in parts]
        ids = self.encode_words([w.encode() for w in chain.from_iterable(split)])
        words = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(words.sum()))
        if len(words) == len(parts):
            return flat, words
        return flat, np.bincount(np.repeat(np.arange(len(parts)), [len(ws) for ws in split]), words, len(parts)).astype(np.int64)

    def decode(self, ids: np.ndarray) -> str:
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size):
            ids = ids[(ids >= 0) & (ids < self.size)]
        return b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


_LOADED: dict[int, tuple[str, object]] = {}


def loaded(make: Callable[[str], object], text: str) -> object:
    """make(text), once in each Python worker."""
    key = hash((make.__name__, len(text), text[:200], text[-200:]))
    if key not in _LOADED or _LOADED[key][0] != text:
        _LOADED[key] = (text, make(text))
    return _LOADED[key][1]


def in_chunks(texts: pa.Array, most: int = 6_000_000):
    """Slices of texts of about `most` bytes, to bound what one step holds."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield texts.slice(at, to - at)
        at = to


def read_vocabulary(path: str) -> str:
    """Text of a vocabulary file, read by the driver; operators broadcast it (a vocabulary's size doesn't grow with the data)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encoder(spark: SparkSession, vocabulary: str) -> Callable[[Column], Column]:
    """Column function text -> array<int>, by the method above. vocabulary: text of the JSON file."""
    shared = spark.sparkContext.broadcast(vocabulary)

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        own = loaded(Vocabulary, shared.value)
        ids = pa.concat_arrays([pa.array([], pa.list_(pa.int32())), *map(own.encode, in_chunks(texts, ENCODED))])
        trim()
        return ids

    return encode


def decoder(spark: SparkSession, vocabulary: str) -> Callable[[Column], Column]:
    """Column function array<int> -> text; bytes that aren't UTF-8 become U+FFFD, ids outside the vocabulary nothing."""
    shared = spark.sparkContext.broadcast(vocabulary)

    @F.arrow_udf("string")
    def decode(rows: pa.Array) -> pa.Array:
        own = loaded(Vocabulary, shared.value)
        values = (x.values if x.is_valid else None for x in rows)
        return pa.array([None if v is None else own.decode((v.drop_null() if v.null_count else v).to_numpy()) for v in values], pa.string())

    return decode


def round_trip(df: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """df with token ids and the text that these ids decode to, in one pass of Python.

    The same as `decode(encode(df))`, in which Spark would evaluate `encode` once for each column. Null
    and empty texts get no ids and the empty text; repeated rows stay, each for itself; columns named like
    `ids` and `decoded` are replaced, all others stay; an empty table gives an empty one.
    """
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def both(texts: pa.Array) -> pa.Array:
        own = loaded(Vocabulary, shared.value)
        id_parts, text_parts = [pa.array([], pa.list_(pa.int32()))], [pa.array([], pa.string())]
        for part in in_chunks(texts, ENCODED):
            rows = own.encode(part)
            flat, ends = rows.values.to_numpy(), rows.offsets.to_numpy()
            id_parts.append(rows)
            text_parts.append(pa.array([own.decode(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.string()))
            del rows, flat, part
        del texts
        columns = []
        for parts in (id_parts, text_parts):
            columns.append(parts[1] if len(parts) == 2 else pa.concat_arrays(parts))
            parts.clear()
        trim()
        return pa.StructArray.from_arrays(columns, names=["ids", "decoded"])

    made = fresh(df, "made")[0]
    done = df.withColumn(made, both(F.col(text)))
    return done.withColumns({ids: F.col(f"{made}.ids"), decoded: F.col(f"{made}.decoded")}).drop(made)


def encode(df: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """df with the token ids of column `text` in column `ids` (a column of that name is replaced).

    Null and empty texts get an empty array; rows, repeated ones too, stay as they are; whole texts
    are encoded, whatever their length. An empty table stays empty.
    """
    return df.withColumn(ids, encoder(df.sparkSession, vocabulary)(F.col(text)))


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """df with the text of token ids in column `text` (replaced if there). Null ids give null, none give ''."""
    return df.withColumn(text, decoder(df.sparkSession, vocabulary)(F.col(ids)))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again: token count and digests of both."""
    import public_tokenizers

    vocabulary = read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    done = round_trip(documents(spark, sf_dir).select("doc_id", "text"), vocabulary)
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
