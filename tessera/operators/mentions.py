"""Who is named in a text: all mentions of very many names at once, and names that stand before a legal form.

Names and texts are compared word by word, in folded letters, so marks, case, punctuation and line ends
between words don't matter. All names stand in one automaton with failure links, so a text is read once,
however many names there are; more names than one automaton should hold are met by a join with the
texts' runs of words, in one reading too.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import FORM_WORDS, NAME_NOISE, NAME_REACH
from ..functions.text import fold_aligned, tokens_match

#: Names of one automaton (about 1 kB each); it is built by the driver and broadcast.
MOST = 200_000
#: Bits by which runs of words are passed over that are no name.
BITS = 1 << 24
WORD = re.compile(r"[^\W_]+")


def name_words(name: Column | str) -> Column:
    """A name's folded words, joined by blanks: the form in which names are compared."""
    return F.trim(F.regexp_replace(fold_aligned(name), r"[^\p{L}\p{N}]+", " "))


def _automaton(rows: list[tuple[str, list]]):
    import ahocorasick

    machine = ahocorasick.Automaton()
    for words, ids in rows:
        machine.add_word(f" {words} ", (ids, words.count(" ") + 1, len(words) + 2))
    machine.make_automaton()
    return machine


def _found(machine, text: str):
    """(ids, start, end, first word, words) of each mention, in order of end; names that overlap or hold others are all there."""
    places = [(m.start(), m.end(), m[0]) for m in WORD.finditer(text)]
    line, starts, at = [], [], 0
    for _, _, word in places:
        starts.append(at)
        line.append(word)
        at += len(word) + 1
    for last, (ids, n, size) in machine.iter(f" {' '.join(line)} "):
        first = bisect_right(starts, last - size + 1) - 1
        yield ids, places[first][0], places[first + n - 1][1], first, n


def mentions(df: DataFrame, keys: list[str], text: str, names: DataFrame, name: str, name_id: str, most: int = MOST) -> DataFrame:
    """(keys, name_id, start, end, word, n_words): every mention of a name in a text, places in letters and in words.

    A mention is a run of whole words equal to the name's words. Names without words are never found; names of
    the same words are all found; null texts hold none. Texts are read once: up to `most` different names stand in one
    automaton, more are met by a join (see `named`).
    """
    found = named(df, keys, text, names, name, name_id, most)
    return found.select(*keys, F.explode("ids").alias(name_id), "start", "end", "word", "n_words")


def named(df: DataFrame, keys: list[str], text: str, names: DataFrame, name: str, name_id: str, most: int = MOST) -> DataFrame:
    """(keys, ids, start, end, word, n_words): `mentions` with the ids of all names of the same words in one row, in order."""
    listed = names.select(name_words(name).alias("words"), F.col(name_id).alias("id")).where("words <> ''").groupBy("words").agg(F.sort_array(F.collect_set("id")).alias("ids")).checkpoint()
    rows = df.select(*keys, fold_aligned(text).alias("__text"))
    return _by_automaton(rows, keys, listed) if listed.count() <= most else _by_windows(rows, keys, listed)


def _scanned(rows: DataFrame, keys: list[str], column: str, kind: T.DataType, search) -> DataFrame:
    """(keys, column, start, end, word, n_words): what search finds in each text that isn't null."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = rows.select(*keys).schema.add(column, kind).add("start", "integer").add("end", "integer").add("word", "integer").add("n_words", "integer")
    arrow = to_arrow_schema(schema)

    def scan(batches):
        for batch in batches:
            at, columns = [], ([], [], [], [], [])
            for k, t in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                for found in search(t) if t else ():
                    at.append(k)
                    for c, v in zip(columns, found):
                        c.append(v)
            took = batch.take(pa.array(at, pa.int64()))
            own_keys = [took.column(k) for k in range(len(keys))]
            yield pa.RecordBatch.from_arrays([*own_keys, *[pa.array(c, arrow.field(len(keys) + k).type) for k, c in enumerate(columns)]], schema=arrow)

    return rows.mapInArrow(scan, schema)


def _by_automaton(rows: DataFrame, keys: list[str], listed: DataFrame) -> DataFrame:
    """All names in one automaton, built by the driver."""
    machine = rows.sparkSession.sparkContext.broadcast(_automaton(sorted((r.words, list(r.ids)) for r in listed.collect())))
    return _scanned(rows, keys, "ids", listed.schema["ids"].dataType, lambda t: _found(machine.value, t) if len(machine.value) else ())


def _by_windows(rows: DataFrame, keys: list[str], listed: DataFrame) -> DataFrame:
    """All runs of words as long as some name meet the names in a join; runs whose bit no name has set are passed over before.

    The bits, 2 MB however many names there are, and the names' lengths are all that the driver gets.
    """
    n_words = F.size(F.split("words", " "))
    lengths = sorted(r[0] for r in listed.select(n_words).distinct().collect())
    place = F.crc32(F.encode("words", "UTF-8")) % BITS + 1
    parts = listed.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    filled = bytearray(BITS // 8)
    for part, own in parts.collect():  # BITS / 32,768 at most
        filled[(part - 1) * 4096 : part * 4096] = own
    bits = rows.sparkSession.sparkContext.broadcast(bytes(filled))

    def search(t: str):
        places, own = [(m.start(), m.end(), m[0]) for m in WORD.finditer(t)], bits.value
        for n in lengths:
            for k in range(len(places) - n + 1):
                run = " ".join([w for _, _, w in places[k : k + n]])
                h = crc32(run.encode()) % BITS
                if own[h >> 3] >> (h & 7) & 1:
                    yield run, places[k][0], places[k + n - 1][1], k, n

    found = _scanned(rows, keys, "__words", T.StringType(), search)
    return found.join(listed, F.col("__words") == F.col("words")).select(*keys, "ids", "start", "end", "word", "n_words")


def names_before_forms(text: Column | str) -> Column:
    """array of struct(tokens, start, end): names in a text, the words before a legal form, in order.

    tokens are those of the NAME_REACH words before the form that aren't noise and have two letters; a form
    without any names nobody. start is where the first token stands, end where the form ends.
    """
    return _before_forms(fold_aligned(text))


_NAMED = T.ArrayType(T.StructType([T.StructField("tokens", T.ArrayType(T.StringType())), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


@F.arrow_udf(_NAMED)
def _before_forms(texts: pa.Array) -> pa.Array:
    own = [[{"tokens": tokens, "start": start, "end": end} for tokens, start, end in named_before_forms(t)] for t in texts.to_pylist()]
    return pa.array(own, pa.list_(pa.struct([("tokens", pa.list_(pa.string())), ("start", pa.int32()), ("end", pa.int32())])))


WORD_END = re.compile(r"\w")
FORM = re.compile(r"(?:" + "|".join(r"\s+".join(map(re.escape, f.split())) for f in FORM_WORDS) + r")\b")


def named_before_forms(folded: str | None) -> list[tuple[list[str], int, int]]:
    """(tokens, start, end) of the names in one folded text, as `names_before_forms` gives them."""
    own, heads = [], [m for m in FORM.finditer(folded) if not WORD_END.match(folded, max(0, m.start() - 1), m.start())] if folded else []
    if heads:
        places = [(m.start(), m[0]) for m in re.finditer(r"[a-z0-9]+", folded[: heads[-1].start()])]
        starts = [s for s, _ in places]
        for m in heads:
            last = bisect_right(starts, m.start() - 1)
            named = [(s, w) for s, w in places[max(0, last - NAME_REACH) : last] if w not in NAME_NOISE and len(w) >= 2]
            if named:
                own.append(([w for _, w in named], named[0][0], m.end()))
    return own


def is_named(tokens: Column, own: Column) -> Column:
    """Whether a mention ends with all of our own tokens, in order."""
    n = F.size(own)
    return (n > 0) & (F.size(tokens) >= n) & (F.slice(tokens, F.greatest(F.size(tokens) - n + 1, F.lit(1)), F.greatest(n, F.lit(1))) == own)


def own_sections(found: Column, own: Column, length: Column) -> Column:
    """array of struct(start, end): from each mention of our own name to the next of another name, or the end."""
    ours = F.filter(found, lambda m: is_named(m["tokens"], own))
    others = F.filter(found, lambda m: ~is_named(m["tokens"], own))
    after = lambda m: F.array_min(F.transform(F.filter(others, lambda o: o["start"] > m["start"]), lambda o: o["start"]))
    return F.transform(ours, lambda m: F.struct(m["start"].alias("start"), F.greatest(F.coalesce(after(m), length), m["end"]).alias("end")))


def names_another(found: Column, own: Column) -> Column:
    """Whether a text names somebody else by a legal form."""
    return F.exists(found, lambda m: ~is_named(m["tokens"], own))


def related(own: Column, named: Column) -> Column:
    """Whether some named token is one of ours or a fragment of one (four letters at least), or the other way round."""
    return F.exists(named, lambda n: F.exists(own, lambda o: tokens_match(n, o)))
