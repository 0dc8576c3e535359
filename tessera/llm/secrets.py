"""Secret scan with DataFrame functions alone: patterns, and sliding-window Shannon entropy.

Spans of a pattern come from two passes of the regex engine: the matches, and the text between them;
lengths added up give the places. Candidates of the entropy method are runs of token characters that
hold letters and digits and that no allow-list pattern covers. A window slides over a candidate: each
step adds the entering character to the counts of its class's alphabet, takes the leaving one out, and
changes the sum of n log n by these two counts only.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, fresh

#: The base patterns, in the order in which kinds are listed.
KEYWORD = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
ASSIGN = KEYWORD + r"[A-Za-z0-9+/_.=-]+"
ACCESS = r"AKIA[A-Z0-9]+"
#: Shorter runs fail anyway; a run is taken whole, so its start is where no such character stands before.
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "entropy_hex", "entropy_token"]

CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Characters that are scored at once: a longer candidate is cut into pieces that overlap by a window less one.
PIECE = 2048
#: Beyond any place of a text.
FAR = (1 << 31) - 1
HEX_ALPHABET = "0123456789abcdef"
TOKEN_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Bits a character that a window must reach.
LIMITS = {"entropy_hex": 3.0, "entropy_token": 3.8}
#: What looks random and is no secret: words, numbers, UUIDs, dates, placeholders, long repeats.
ALLOWED = [
    r"^[A-Za-z_=/+-]+$",
    r"^[0-9+/_=-]+$",
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"(?i)example|sample|dummy|placeholder|changeme|redacted",
    r"([A-Za-z0-9])\1{5}",
    r"^(/?[A-Za-z]{4,}+[0-9]{0,4}+)++$",
    r"\d{4}-\d{2}-\d{2}",
]


def running(values: Column, add: Callable[[Column, Column], Column] = lambda a, x: a + x, zero: int = 0) -> Column:
    """What an array's first 1, 2, ... values add up to, in blocks of 256 so that long arrays stay cheap."""
    append = lambda a, x: F.concat(a, F.array(add(F.element_at(a, -1), x)))
    blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(values) / 256).cast("int") - 1), lambda c: F.slice(values, c * 256 + 1, 256))
    sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(zero), add))
    bases = F.aggregate(sums, F.array(F.lit(zero)), append)
    inner = F.transform(F.arrays_zip(blocks.alias("b"), F.slice(bases, 1, F.size(sums)).alias("s")), lambda z: F.slice(F.aggregate(z["b"], F.array(z["s"]), append), 2, 256))
    return F.flatten(inner)


def with_matches(df: DataFrame, text: str, pattern: str, name: str) -> DataFrame:
    """df with `name`: array of struct(start, end, hit) of the leftmost non-overlapping matches, in code points."""
    hits, gaps, steps, ends = fresh(df, "hits", "gaps", "steps", "ends")
    some = F.col(text).rlike(pattern)
    none = F.array().cast("array<string>")
    df = df.withColumn(hits, F.when(some, F.regexp_extract_all(F.col(text), F.lit(pattern), 0)).otherwise(none))
    df = df.withColumn(gaps, F.when(F.size(hits) > 0, F.split(F.col(text), pattern, -1)).otherwise(none))
    df = df.withColumn(steps, F.slice(F.zip_with(hits, gaps, lambda h, g: F.length(g) + F.length(h)), 1, F.size(hits)))
    df = df.withColumn(ends, F.when(F.size(hits) > 0, running(F.col(steps))).otherwise(F.array().cast("array<int>")))
    end = lambda k: F.get(ends, k)
    both = F.transform(hits, lambda h, k: F.struct((end(k) - F.length(h)).alias("start"), end(k).alias("end"), h.alias("hit")))
    return df.withColumn(name, both).drop(hits, gaps, steps, ends)


def pieces(s: Column, window: int) -> Column:
    """s in pieces of at most PIECE characters, each after the last window - 1 characters of the one before."""
    cut = F.regexp_extract_all(s, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    before = lambda x, k: F.when(k > 0, F.right(F.get(x, k - 1), F.lit(window - 1))).otherwise(F.lit(""))
    return let(cut, lambda x: F.transform(x, lambda p, k: F.concat(before(x, k), p)))


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value evaluated once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def highest_entropy(s: Column, alphabet: str, window: int = WINDOW) -> Column:
    """The most bits a character of any window of `window` characters of s, all of them of the alphabet.

    Counts are incremental: each step adds the entering character and takes out the leaving one. The
    counts of a window stand in a few longs, a field of some bits for each character of the alphabet.
    Work is in proportion to the length of s, whatever it is.
    """
    width = window.bit_length()
    fields = 63 // width
    weights = [0.0] + [n * math.log2(n) for n in range(1, window + 1)]
    steps = F.array(*[F.lit(b - a) for a, b in zip(weights, weights[1:])])
    empty = F.array(*[F.lit(0).cast("long")] * -(-len(alphabet) // fields))
    first = F.struct(empty.alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))

    def place(c: Column) -> Column:
        at = F.position(c, F.lit(alphabet)) - 1
        return let(at, lambda k: F.struct(F.floor(k / fields).cast("int").alias("word"), (F.pmod(k, F.lit(fields)) * width).alias("shift")))

    def one(at: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), at["shift"])

    def count(counts: Column, at: Column) -> Column:
        shifted = F.call_function("shiftright", F.get(counts, at["word"]), at["shift"])
        return shifted.bitwiseAND(F.lit((1 << width) - 1)).cast("int")

    def slide(a: Column, x: Column) -> Column:
        into, out = x["into"], x["out"]
        gone = F.when(out.isNull(), F.lit(0.0)).otherwise(F.get(steps, count(a["counts"], out) - 1))
        fewer = F.when(out.isNull(), a["counts"]).otherwise(F.transform(a["counts"], lambda n, j: F.when(j == out["word"], n - one(out)).otherwise(n)))

        def enter(counts: Column) -> Column:
            total = a["sum"] - gone + F.get(steps, count(counts, into))
            more = F.transform(counts, lambda n, j: F.when(j == into["word"], n + one(into)).otherwise(n))
            bits = lambda t: F.when(x["full"], F.lit(math.log2(window)) - t / window).otherwise(F.lit(0.0))
            return let(total, lambda t: F.struct(more.alias("counts"), t.alias("sum"), F.greatest(a["best"], bits(t)).alias("best")))

        return let(fewer, enter)

    def best(piece: Column) -> Column:
        places = F.transform(F.filter(F.split(piece, ""), lambda c: c != ""), place)
        pairs = let(places, lambda p: F.transform(p, lambda c, k: F.struct(c.alias("into"), F.get(p, k - window).alias("out"), (k >= window - 1).alias("full"))))
        return F.aggregate(pairs, first, slide, lambda a: a["best"])

    return F.array_max(F.transform(pieces(s, window), best))


def scan(df: DataFrame, text: str = "text", allowed: list[str] = ALLOWED, limits: dict[str, float] = LIMITS) -> DataFrame:
    """df with base_spans and spans: arrays of struct(start, kind, end), kind the place in KINDS.

    base_spans are those of the patterns; spans has those of the entropy method too, where they touch
    no base span. Both are sorted by start, then kind. Places are code points, ends exclusive. Null and
    empty texts have none; repeated rows give the same; an empty table gives an empty one; columns of
    those two names are replaced, all others stay. Work grows in proportion to a text's length.
    """
    own, *names = fresh(df, "own", "assign", "access", "hex", "candidates", "bits")
    assigned, accesses, hexes, candidates, scores = names
    df = df.withColumn(own, F.coalesce(F.col(text), F.lit("")))
    for name, pattern in zip(names, (ASSIGN, ACCESS, HEX, CANDIDATE)):
        df = with_matches(df, own, pattern, name)
    span = lambda kind: lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"))
    assign = F.filter(assigned, lambda m: F.length(F.regexp_replace(m["hit"], f"^{KEYWORD}", "")) >= 6)
    access = F.filter(accesses, lambda m: F.length(m["hit"]) >= 20)
    base = F.concat(F.transform(assign, span(0)), F.transform(access, span(1)), F.transform(hexes, span(2)))
    df = df.withColumn("base_spans", F.array_sort(base))
    hit_allowed = lambda m: reduce(or_, (m["hit"].rlike(p) for p in allowed), F.lit(False))
    # both in one order: a candidate touches a base span if one before it ends behind its start, or one after it starts before its end
    tagged = lambda a, tag, hit: F.transform(a, lambda m: F.struct(m["start"].alias("start"), F.lit(tag).alias("tag"), m["end"].alias("end"), hit(m).alias("hit")))
    merged = F.array_sort(F.concat(tagged("base_spans", 0, lambda m: F.lit("")), tagged(candidates, 1, lambda m: m["hit"])))
    is_base = lambda m, there, value: F.when(m["tag"] == 0, there).otherwise(F.lit(value))
    before = lambda b: running(F.transform(b, lambda m: is_base(m, m["end"], 0)), lambda a, x: F.greatest(a, x))
    after = lambda b: F.reverse(running(F.reverse(F.transform(b, lambda m: is_base(m, m["start"], FAR))), lambda a, x: F.least(a, x), FAR))
    apart = lambda b, last, first: F.filter(b, lambda m, k: (m["tag"] == 1) & (F.get(last, k) <= m["start"]) & (F.get(first, k) >= m["end"]))
    free = let(merged, lambda b: let(before(b), lambda last: let(after(b), lambda first: apart(b, last, first))))  # each evaluated once
    plain = F.transform(free, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["hit"].alias("hit")))
    some = (F.size(candidates) > 0) & (F.size("base_spans") > 0)
    df = df.withColumn(candidates, F.filter(F.when(some, plain).otherwise(F.col(candidates)), lambda m: ~hit_allowed(m)))
    is_hex = lambda m: m["hit"].rlike("^[0-9A-Fa-f]+$")
    as_hex = lambda m: highest_entropy(F.lower(m["hit"]), HEX_ALPHABET)
    bits = F.transform(candidates, lambda m: F.when(is_hex(m), as_hex(m)).otherwise(highest_entropy(m["hit"], TOKEN_ALPHABET)))
    df = df.withColumn(scores, bits)
    kind = lambda m: F.when(is_hex(m), 3).otherwise(4)
    enough = lambda m, b: b >= F.when(is_hex(m), limits["entropy_hex"]).otherwise(limits["entropy_token"])
    more = lambda m, b: F.when(enough(m, b), F.struct(m["start"].alias("start"), kind(m).alias("kind"), m["end"].alias("end")))
    scored = F.filter(F.zip_with(candidates, scores, more), lambda x: x.isNotNull())
    return df.withColumn("spans", F.array_sort(F.concat("base_spans", scored))).drop(own, *names)


def written(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets."""
    found = scan(documents(spark, sf_dir).select("doc_id", "text"))
    of = lambda k: lambda x: x["kind"] == k
    counts = [F.size(F.filter("base_spans", of(k))).cast("long").alias(f"n_{KINDS[k]}") for k in range(3)]
    return found.select("doc_id", *counts, F.sha2(written(F.col("base_spans")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
