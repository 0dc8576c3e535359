"""Personal data: patterns, and a character tagger (bidirectional LSTM with a CRF) for the forms that no pattern names.

The tagger is trained in numpy on the driver from labelled spans: pieces of at most `SAMPLE` documents,
whose spans are those of the patterns, with made-up entities and look-alikes of known places put into
them. Every text is cut into overlapping windows; each that holds a digit, an @ or an (at) is decoded
(spans must hold one, so the others can't have any). A span that a window cuts is left to the window
that has it whole; of those that clash between windows the set of the greatest total confidence stays,
chosen over the whole text. An exact check follows: digits of phones, Luhn of cards, syntax of addresses.
"""

from __future__ import annotations

import ipaddress
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from string import ascii_letters, digits

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tagger
from .bpe import in_chunks
from .common import documents, fresh, trim

KINDS = ["email", "ip", "card", "phone"]
#: Documents that training pieces come from, and pieces of one document.
SAMPLE, PIECES = 200, 8
#: Characters of a window and from one window to the next; a span is shorter than their difference.
WINDOW, STRIDE = 128, 64
#: Characters of a training row.
ROW = 64
#: Made-up rows for each piece.
COPIES = 3
#: Least chance of a span's least certain character.
LEAST = 0.5
#: Windows that are decoded at once.
BATCH = 256

LOCAL = ascii_letters + digits + "._%+-"
#: The base patterns, with possessive repeats where giving back can't help. The local part is what stands before an @.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"(?<![0-9])[0-9]++(?:[\x20-][0-9]++)*+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ANCHOR = re.compile(r"[0-9@]|[(\[{]at[)\]}]", re.I)
WRITTEN_AT = re.compile(r"\s*[(\[{]at[)\]}]\s*|\s*@\s*", re.I)
WRITTEN_DOT = re.compile(r"\s*[(\[{]dot[)\]}]\s*", re.I)

Span = tuple[int, int, int]  # start, kind, end


def luhn(number: str) -> bool:
    total = sum(int(c) for c in number[-1::-2]) + sum(sum(divmod(2 * int(c), 10)) for c in number[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, by start, then kind; work grows in proportion to the text."""
    out, free, last = [], 0, -1
    at = text.find("@")
    while at >= 0:
        low = max(free, last + 1)
        piece = text[low:at]
        start = low + len(piece.rstrip(LOCAL))
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, 0, m.end()))
            free = m.end()
        last = at
        at = text.find("@", at + 1)
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(own := re.sub(r"[\x20-]", "", m[0])) <= 19 and luhn(own):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 9 <= sum(c in digits for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def holds(kind: int, found: str) -> bool:
    """Whether what the tagger found is written as its kind must be."""
    if len(found) >= WINDOW - STRIDE:
        return False
    number = "".join(c for c in found if c in digits)
    if kind == 0:
        parts = WRITTEN_AT.split(found)
        return len(parts) == 2 and re.fullmatch(r"[\w.%+-]+", parts[0]) is not None and DOMAIN.fullmatch(WRITTEN_DOT.sub(".", parts[1])) is not None
    if kind == 1:
        try:
            return ":" in found and found.count(":") >= 3 and ipaddress.IPv6Address(found) is not None
        except ValueError:
            return False
    if kind == 2:
        return 12 <= len(number) <= 19 and re.fullmatch(r"[0-9](?:[\x20._/-]{0,2}[0-9])+", found) is not None and luhn(number)
    if re.fullmatch(r"[0-9]{4}([ .-][0-9]{4}){2,3}", found) or re.fullmatch(r"[0-9]{1,4}[.-][0-9]{1,2}[.-][0-9]{1,4}", found):
        return False  # a grouped number, a date
    return 9 <= len(number) <= 15 and re.fullmatch(r"[+(]?[0-9][\x20()./0-9-]+[0-9]", found) is not None and re.search(r"[0-9)][\x20()./-]+[0-9]+[\x20()./-]+[0-9]", found) is not None


# --- labelled rows ---------------------------------------------------------------------------------


def _digits(r: np.random.Generator, n: int) -> str:
    return "".join(map(str, r.integers(0, 10, n)))


def _word(r: np.random.Generator, low: int = 3, high: int = 9) -> str:
    return "".join(chr(97 + c) for c in r.integers(0, 26, r.integers(low, high)))


def _card(r: np.random.Generator) -> str:
    body = str(r.integers(3, 7)) + _digits(r, 14)
    return next(body + str(c) for c in range(10) if luhn(body + str(c)))


def made_entity(r: np.random.Generator) -> tuple[int, str]:
    """(kind, text) of a made-up entity, half of them in forms that the patterns miss."""
    kind, form = int(r.integers(0, 4)), int(r.integers(0, 6))
    if kind == 0:
        name = _word(r) + ["", ".", "_", "-"][r.integers(0, 4)] + [_word(r), _digits(r, 2)][r.integers(0, 2)]
        dot = [".", " (dot) ", "[dot]", "(dot)", " [dot] ", "."][form]
        at = ["@", " (at) ", "[at]", "(at)", " [at] ", "@"][form]
        return kind, name + at + dot.join([_word(r)] * int(r.integers(0, 2)) + [_word(r), ["com", "org", "net", "de", "fr", "cz"][r.integers(0, 6)]])
    if kind == 1:
        if form < 2:
            return kind, ".".join(str(x) for x in r.integers(1, 256, 4))
        parts = [f"{x:x}" for x in r.integers(1, 65536, 8)]
        return kind, ":".join(parts) if form < 4 else "::".join([":".join(parts[:3]), ":".join(parts[6:])])
    if kind == 2:
        sign = ["", " ", "-", ".", "  ", "/"][form]
        number = _card(r)
        return kind, sign.join(number[k : k + 4] for k in range(0, 16, 4))
    a, b, c = _digits(r, 3), _digits(r, 3), _digits(r, 4)
    return kind, [f"+{r.integers(1, 99)} ({a}) {b}-{c}", f"({a}) {b}-{c}", f"({a}) {b} {c}", f"00{r.integers(10, 99)} {a} {b} {c[:3]}", f"0{a}/{b} {c}", f"+{r.integers(1, 999)} {a} {b} {c[:3]}"][form]


def made_likeness(r: np.random.Generator) -> str:
    """What looks like an entity and is none: keys, dates, sums, versions, times, plain numbers."""
    n = lambda low, high: int(r.integers(low, high))
    return [
        lambda: "token = \"" + "".join("0123456789abcdef"[k] for k in r.integers(0, 16, n(24, 44))) + "\"",
        lambda: f"{n(1900, 2100)}-{n(1, 13):02}-{n(1, 29):02}",
        lambda: f"{n(1, 29)}. {n(1, 13)}. {n(1900, 2100)}",
        lambda: f"{n(1, 999)} {_digits(r, 3)} {_digits(r, 3)} {['Kč', 'EUR', 'USD', 'CZK'][n(0, 4)]}",
        lambda: f"{n(0, 99)}.{n(0, 99)}.{n(0, 99)}",
        lambda: f"{n(0, 24):02}:{n(0, 60):02}:{n(0, 60):02}",
        lambda: _digits(r, n(1, 18)),
        lambda: f"{n(0, 999)},{_digits(r, 2)} %",
        lambda: ":".join(f"{x:02X}" for x in r.integers(0, 256, 6)),
        lambda: f"{n(1900, 2100)}-{n(1900, 2100)}",
        lambda: f"@{_word(r)}",
        lambda: f"978-{n(0, 9)}-{_digits(r, 2)}-{_digits(r, 6)}-{n(0, 9)}",
        lambda: "-".join("".join("0123456789abcdef"[k] for k in r.integers(0, 16, m)) for m in (8, 4, 4, 4, 12)),
        lambda: f"{n(256, 999)}.{n(256, 999)}.{n(0, 999)}.{n(0, 999)}",
        lambda: f"ISO {n(1000, 99999)}:{n(1900, 2100)}",
        lambda: "".join((ascii_letters + digits)[k] for k in r.integers(0, 62, n(16, 40))),
    ][n(0, 16)]()


def row_of(text: str, spans: list[Span]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, labels) of a training row, filled up."""
    x, y = np.full(ROW, tagger.PAD, np.uint8), np.zeros(ROW, np.int64)
    own = tagger.symbols(text)[:ROW]
    x[: len(own)] = own
    for start, kind, end in spans:
        if end <= ROW:
            y[start:end] = 2 * kind + 2
            y[start] = 2 * kind + 1
    return x, y


def uncut(spans: list[Span], low: int, high: int) -> tuple[int, int]:
    """The stretch from low to high without the parts of spans that it would cut: what is left of those would be labelled as none."""
    for start, _, end in spans:
        low = end if start < low < end else low
    for start, _, end in reversed(spans):
        high = start if start < high < end else high
    return low, max(low, high)


def labelled_rows(pieces: list[str], copies: int = COPIES, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Rows to learn from: each piece as it is, and copies with an entity or a likeness put between two words of it."""
    r = np.random.default_rng(seed)
    rows = []
    for piece in pieces:
        known = base_spans(piece)
        rows.append(row_of(piece, known))
        for _ in range(copies):
            gaps = [k for k, c in enumerate(piece) if c == " " and not any(a <= k < b for a, _, b in known)] + [len(piece)]
            place = gaps[int(r.integers(0, len(gaps)))]
            before, after = piece[:place], piece[place + 1 :]
            if r.random() < 0.6:
                kind, entity = made_entity(r)
            else:
                kind, entity = None, made_likeness(r)
            room = max(0, ROW - len(entity) - 4)
            keep = int(r.integers(0, room + 1))
            before = before[uncut(base_spans(before), len(before) - min(keep, len(before)), len(before))[0] :]
            lead = before + (["\n", " ", ": ", ", "][r.integers(0, 4)] if before else "")
            text = lead + entity + ([" ", ". ", ", ", "\n", ""][r.integers(0, 5)] + after if after else "")
            spans = [(len(lead), kind, len(lead) + len(entity))] if kind is not None else []
            own = [s for s in base_spans(text) if not any(s[0] < b and a < s[2] for a, _, b in spans)]
            spans = sorted(spans + own)
            rows.append(row_of(text[: uncut(spans, 0, ROW)[1]], spans))
    return np.stack([x for x, _ in rows]), np.stack([y for _, y in rows])


def _pieces():
    """Column function (doc_id, text) -> pieces of the text: around its spans, and elsewhere."""

    @F.arrow_udf("array<string>")
    def own(ids: pa.Array, texts: pa.Array) -> pa.Array:
        out = []
        for k, text in zip(ids.to_pylist(), texts.to_pylist()):
            r = np.random.default_rng(zlib.crc32(str(k).encode()))
            spans = base_spans(text)
            starts = [max(0, s - int(r.integers(0, ROW - min(e - s, ROW - 1)))) for s, _, e in spans[: PIECES // 2]]
            starts += [int(r.integers(0, max(1, len(text) - ROW))) for _ in range(PIECES - len(starts))]
            cuts = [uncut([x for x in spans if x[2] > s and x[0] < s + ROW], s, min(s + ROW, len(text))) for s in starts]
            out.append([text[a:b] for a, b in cuts])
        return pa.array(out, pa.list_(pa.string()))

    return own


def fit(df: DataFrame, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text") -> tagger.Weights | None:
    """A tagger from pieces of at most `sample` documents, those of the smallest hashes of their ids; None without any text."""
    given = df.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where("id is not null and text <> ''")
    some = given.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = given.join(F.broadcast(some), "id").groupBy("id").agg(F.min("text").alias("text"))  # at most `sample` ids are broadcast
    found = sorted((r.id, p) for r in rows.select("id", _pieces()(F.col("id"), F.col("text")).alias("pieces")).collect() for p in r.pieces)
    if not found:
        return None
    return tagger.train(*labelled_rows([p for _, p in found]), len(KINDS))


# --- decoding --------------------------------------------------------------------------------------


def windows(text: str, seen: np.ndarray) -> Iterator[int]:
    """Starts of the windows that hold an anchor; the last window ends with the text."""
    n = len(seen)
    marks = (seen >= 48) & (seen <= 57) | (seen == 64)
    for m in re.finditer(r"[(\[{]at[)\]}]", text, re.I):
        marks[m.start()] = True
    places = np.flatnonzero(marks)
    if not len(places):
        return
    last = max(0, -(-(n - WINDOW) // STRIDE))  # number of the last window
    both = np.concatenate([places // STRIDE, places // STRIDE - 1])
    yield from (int(k) * STRIDE for k in np.unique(np.clip(both, 0, last)))


def reconciled(spans: list[tuple[int, int, int, float]]) -> list[Span]:
    """Of the windows' spans (start, kind, end, chance), those without overlap whose chances have the greatest sum of lengths times chances."""
    best: dict[Span, float] = {}
    for start, kind, end, p in spans:
        best[start, kind, end] = max(best.get((start, kind, end), 0.0), p)
    order = sorted(best, key=lambda s: (s[2], s[0], s[1]))
    ends = [s[2] for s in order]
    total, took = [0.0], []
    for k, s in enumerate(order):
        free = bisect_right(ends, s[0], 0, k)
        with_it = total[free] + best[s] * (s[2] - s[0])
        took.append((with_it > total[k], free))
        total.append(max(total[k], with_it))
    out, k = [], len(order)
    while k:
        chosen, free = took[k - 1]
        if chosen:
            out.append(order[k - 1])
        k = free if chosen else k - 1
    return sorted(out)


def found_spans(texts: list[str], w: tagger.Weights, least: float = LEAST) -> list[list[Span]]:
    """The tagger's spans of whole texts, reconciled and checked."""
    numbers = [tagger.symbols(t) for t in texts]
    todo = [(k, start) for k, t in enumerate(texts) for start in windows(t, numbers[k])]
    every: list[list[tuple[int, int, int, float]]] = [[] for _ in texts]
    for part in range(0, len(todo), BATCH):
        own = todo[part : part + BATCH]
        x = np.full((BATCH, WINDOW), tagger.PAD, np.uint8)  # always as many rows: how texts are dealt to batches changes nothing
        for row, (k, start) in enumerate(own):
            piece = numbers[k][start : start + WINDOW]
            x[row, : len(piece)] = piece
        labels, chance = tagger.decode(w, x)
        for row in np.flatnonzero((labels[: len(own)] > 0).any(1)):
            k, start = own[row]
            text, line = texts[k], labels[row]
            heads = np.flatnonzero(line % 2 == 1)
            for a in heads.tolist():
                b = a + 1
                while b < WINDOW and line[b] == line[a] + 1:
                    b += 1
                p = float(chance[row, a:b].min())
                cut = (a == 0 and start > 0) or (b == WINDOW and start + b < len(text))
                if p >= least and not cut and start + b <= len(text):
                    every[k].append((start + a, int(line[a]) // 2, start + b, p))
    return [[s for s in reconciled(spans) if holds(s[1], t[s[0] : s[2]]) and ANCHOR.search(t[s[0] : s[2]])] for t, spans in zip(texts, every)]


def apart(more: list[Span], base: list[Span]) -> list[Span]:
    """Those of `more` that touch none of `base`; both by start."""
    ends, out = sorted((e, s) for s, _, e in base), []
    starts = sorted((s, e) for s, _, e in base)
    for s, kind, e in more:
        # a base span overlaps if it begins before e and ends after s
        if bisect_right(starts, (e - 1, 1 << 62)) - bisect_right(ends, (s, 1 << 62)) <= 0:
            out.append((s, kind, e))
    return out


RESULT = "struct<base_spans:array<struct<start:bigint,kind:int,end:bigint>>,spans:array<struct<start:bigint,kind:int,end:bigint>>>"
_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])


def scanner(spark: SparkSession, w: tagger.Weights | None):
    """Column function text -> RESULT."""
    shared = spark.sparkContext.broadcast(w)  # some 40,000 numbers, whatever the data

    @F.arrow_udf(RESULT)
    def own(texts: pa.Array) -> pa.Array:
        base, every = [], []
        for part in in_chunks(texts, 4_000_000):
            rows = [t or "" for t in part.to_pylist()]
            plain = [base_spans(t) for t in rows]
            more = found_spans(rows, shared.value) if shared.value is not None else [[] for _ in rows]
            base += plain
            every += [sorted(b + apart(m, b)) for b, m in zip(plain, more)]
        del texts
        trim()
        lists = [pa.array([[dict(zip(("start", "kind", "end"), s)) for s in spans] for spans in side], pa.list_(_SPAN)) for side in (base, every)]
        return pa.StructArray.from_arrays(lists, ["base_spans", "spans"])

    return own


def scan(df: DataFrame, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """df with base_spans and spans: arrays of struct(start, kind, end), kind the place in KINDS, by start, then kind.

    base_spans are the patterns', spans has those of the tagger too that touch none of them. Places are
    code points, ends exclusive. The tagger is fitted on at most `sample` documents of df. Null and empty texts have no
    spans; rows without an id are searched but never learnt from; equal texts give equal spans; an empty table
    gives an empty one; columns of those two names are replaced, all others stay.
    """
    name = fresh(df, "found")[0]
    done = df.withColumn(name, scanner(df.sparkSession, fit(df, sample, doc_id, text))(F.col(text)))
    return done.withColumns({"base_spans": F.col(f"{name}.base_spans"), "spans": F.col(f"{name}.spans")}).drop(name)


def written(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data."""
    found = scan(documents(spark, sf_dir).select("doc_id", "text"))
    of = lambda k: lambda x: x["kind"] == k
    counts = [F.size(F.filter("base_spans", of(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(written(F.col("base_spans")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
