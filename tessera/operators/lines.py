"""Lines of documents: places, context windows, carried headings, spans and pairings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import SPACES, fold_keeping_space, once, running_sums


def lines(df: DataFrame, doc: str | list[str], text: str, around: tuple[int, int] | None = None, heading: Callable[[Column], Column] | None = None, memory: int = 12, sep: str = " ", folded: bool = False) -> DataFrame:
    """(doc, line_no, line, start): non-empty trimmed lines and their places in the text of them joined by line ends.

    around adds `context`, the line with so many before and after it; heading, a function of a line, adds `heading`, its
    last value in the line or the `memory` lines before. All are taken inside each document's own array: no window, no shuffle.
    folded adds `folded`, the folded line, and with around `near`, the folded context (sep is a blank then); each text is folded once.
    """
    docs = [doc] if isinstance(doc, str) else doc
    kept = F.filter(F.transform(F.split(F.col(text), "\n", -1), lambda x: F.trim(x)), lambda x: x != "")

    def flat(raw: Column) -> Column:
        both = once(F.split(fold_keeping_space(text), "\n", -1), lambda f: F.filter(F.transform(raw, lambda x, k: F.struct(x.alias("x"), F.get(f, k).alias("f"))), lambda z: F.trim(z["x"]) != ""))
        return F.transform(both, lambda z: F.trim(F.regexp_replace(z["f"], SPACES, " ")))

    def placed(own: Column, flats: Column | None = None) -> Column:
        ends = running_sums(F.transform(own, lambda x: F.length(x) + 1))
        near = lambda a, k, before, after: F.slice(a, F.greatest(k - before, F.lit(0)) + 1, k + after + 1 - F.greatest(k - before, F.lit(0)))

        def rows(e: Column, heads: Column | None = None) -> Column:
            def row(x: Column, k: Column) -> Column:
                parts = [x.alias("line"), (F.get(e, k) - F.length(x) - 1).cast("long").alias("start")]
                if around:
                    parts.append(F.array_join(near(own, k, *around), sep).alias("context"))
                if flats is not None:
                    parts.append(F.get(flats, k).alias("folded"))
                    if around:
                        parts.append(F.array_join(F.filter(near(flats, k, *around), lambda f: f != ""), " ").alias("near"))
                if heads is not None:
                    parts.append(F.try_element_at(F.filter(near(heads, k, memory, 0), lambda h: h.isNotNull()), F.lit(-1)).alias("heading"))
                return F.struct(*parts)

            return F.transform(own, row)

        if heading is None:
            return once(ends, lambda e: rows(e))
        return once(ends, lambda e: once(F.transform(own, lambda x: heading(x)), lambda h: rows(e, h)))

    more = ["l.context"] * bool(around) + ["l.folded"] * folded + ["l.near"] * (folded and bool(around)) + ["l.heading"] * (heading is not None)
    both = (lambda own: once(flat(F.split(F.col(text), "\n", -1)), lambda flats: placed(own, flats))) if folded else (lambda own: placed(own))  # of one argument: a second would be the place
    rows = F.posexplode_outer(F.when(F.size(kept) > 0, once(kept, both)))  # outer: for the other, Spark evaluates the array once more, to filter by its size
    return df.select(*docs, rows.alias("line_no", "l")).where("line_no IS NOT NULL").select(*docs, "line_no", "l.line", "l.start", *more)


def context(df: DataFrame, doc: str, order: str, line: str, before: int, after: int, sep: str = " ") -> DataFrame:
    """df with `context`: the line with those around it."""
    w = Window.partitionBy(doc).orderBy(order).rowsBetween(-before, after)
    return df.withColumn("context", F.array_join(F.collect_list(line).over(w), sep))


def carried(df: DataFrame, doc: str, order: str, heading: Column, memory: int = 12) -> DataFrame:
    """df with `heading`: the last one of the `memory` lines before or the line itself."""
    w = Window.partitionBy(doc).orderBy(order).rowsBetween(-memory, 0)
    return df.withColumn("heading", F.last(heading, ignorenulls=True).over(w))


def filled_gaps(df: DataFrame, doc: str, order: str, value: str) -> DataFrame:
    """df whose missing values stand between two equal known ones filled with them: two running frames, one of them reversed."""
    upto = lambda by: Window.partitionBy(doc).orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    before = F.last(value, ignorenulls=True).over(upto(F.col(order)))
    after = F.last(value, ignorenulls=True).over(upto(F.col(order).desc()))
    return df.withColumn("__a", before).withColumn("__b", after).withColumn(value, F.coalesce(F.col(value), F.when(F.col("__a") == F.col("__b"), F.col("__a")))).drop("__a", "__b")


def sections(df: DataFrame, doc: str, start: str, foreign: str, end: Column) -> DataFrame:
    """(doc, start, foreign, end): mentions as spans, an own one up to the next foreign mention, a foreign one up to the next of any."""
    w = Window.partitionBy(doc).orderBy(F.col(start).desc()).rowsBetween(Window.unboundedPreceding, -1)
    any_next, foreign_next = F.min(start).over(w), F.min(F.when(F.col(foreign), F.col(start))).over(w)
    return df.withColumn("end", F.coalesce(F.when(F.col(foreign), any_next).otherwise(foreign_next), end))


def covered_length(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """(keys, covered): the length of the union of each group's intervals."""
    w = Window.partitionBy(*keys).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    own = F.greatest(F.lit(0), F.col(end) - F.greatest(F.col(start), F.coalesce(F.max(end).over(w), F.col(start))))
    return df.withColumn("__own", own).groupBy(*keys).agg(F.sum("__own").alias("covered"))


def as_of(left: DataFrame, right: DataFrame, keys: list[str], time: str, value: str) -> DataFrame:
    """left with `value`: right's latest at or before each row's time, by one union and one window (no range join)."""
    both = left.withColumn("__r", F.lit(1)).withColumn("__v", F.lit(None).cast(right.schema[value].dataType))
    own = right.select(*keys, time, F.col(value).alias("__v")).withColumn("__r", F.lit(0))
    w = Window.partitionBy(*keys).orderBy(time, "__r").rowsBetween(Window.unboundedPreceding, 0)
    out = both.unionByName(own, allowMissingColumns=True).withColumn("__last", F.last("__v", ignorenulls=True).over(w))
    return out.where("__r = 1").drop("__r", "__v").withColumnRenamed("__last", value)


def section_of(bounds: Column, offset: Column) -> Column:
    """The number of the section (from 0) in which a place lies; -1 before the first bound."""
    return F.size(F.filter(bounds, lambda b: b <= offset)) - 1


def years_and_rates(line: Column, reach: int = 25) -> Column:
    """array of struct(year, rate): years left to right, each with the nearest percentage within `reach` letters not taken yet."""
    found = F.regexp_extract_all(line, F.lit(r"(?<!\d)(?:19|20)\d{2}(?!\d)(?!\s*%)|[-+]?\d{1,3}(?:[.,]\d+)?\s*%"), 0)
    gaps = F.split(line, r"(?<!\d)(?:19|20)\d{2}(?!\d)(?!\s*%)|[-+]?\d{1,3}(?:[.,]\d+)?\s*%", -1)
    steps = F.transform(F.arrays_zip(found.alias("hit"), F.slice(gaps, 1, F.size(found)).alias("gap")), lambda z: z)
    empty = F.array().cast("array<struct<at:int,hit:string>>")
    placed = F.aggregate(steps, F.struct(F.lit(0).alias("at"), empty.alias("out")), lambda a, z: F.struct((a["at"] + F.length(z["gap"]) + F.length(z["hit"])).alias("at"), F.concat(a["out"], F.array(F.struct((a["at"] + F.length(z["gap"])).alias("at"), z["hit"].alias("hit")))).alias("out")), lambda a: a["out"])
    years, rates = F.filter(placed, lambda p: ~F.contains(p["hit"], F.lit("%"))), F.filter(placed, lambda p: F.contains(p["hit"], F.lit("%")))
    near = lambda y, left: F.array_min(F.transform(F.filter(left, lambda r: F.abs(r["at"] - y["at"]) <= reach), lambda r: F.struct(F.abs(r["at"] - y["at"]).alias("far"), r["at"].alias("at"), r["hit"].alias("hit"))))
    value = lambda h: F.replace(F.regexp_replace(h, r"[\s%]", ""), F.lit(","), F.lit(".")).cast("double")
    none = F.array().cast("array<struct<year:int,rate:double>>")

    def step(a: Column, y: Column) -> Column:
        pick = near(y, a["left"])
        taken = F.struct(F.filter(a["left"], lambda r: r["at"] != pick["at"]).alias("left"), F.concat(a["out"], F.array(F.struct(y["hit"].cast("int").alias("year"), value(pick["hit"]).alias("rate")))).alias("out"))
        return F.when(pick.isNull(), a).otherwise(taken)

    return F.aggregate(years, F.struct(rates.alias("left"), none.alias("out")), step, lambda a: a["out"])


def greedy_pairs(periods: Column, rates: Column) -> Column:
    """array of struct(period, rate): to each period in turn the first rate not taken that stands behind it, else the last before it.

    periods and rates: arrays of struct(at, ...) in order of `at`. Periods for which no rate is left are dropped.
    """
    ahead = lambda left, p: F.filter(left, lambda r: r["at"] >= p["at"])

    def step(a: Column, p: Column) -> Column:
        def taken(pick: Column) -> Column:
            rest = F.filter(a["left"], lambda r: r["at"] != pick["at"])
            return F.when(pick.isNull(), a).otherwise(F.struct(rest.alias("left"), F.concat(a["out"], F.array(F.struct(p.alias("period"), pick.alias("rate")))).alias("out")))

        chosen = once(ahead(a["left"], p), lambda after: F.coalesce(F.get(after, 0), F.try_element_at(a["left"], F.lit(-1))))
        return once(chosen, taken)

    pair = F.struct(F.get(periods, 0).alias("period"), F.get(rates, 0).alias("rate"))
    return F.aggregate(periods, F.struct(rates.alias("left"), F.filter(F.array(pair), lambda x: F.lit(False)).alias("out")), step, lambda a: a["out"])


def places(line: Column, pattern: str) -> Column:
    """array of struct(at, end, hit): the matches of a pattern in a line, places from 0."""
    found, gaps = F.regexp_extract_all(line, F.lit(pattern), 0), F.split(line, pattern, -1)
    ends = lambda f: running_sums(F.transform(f, lambda h, k: F.length(h) + F.length(F.get(gaps, k))))
    return once(found, lambda f: once(ends(f), lambda e: F.transform(f, lambda h, k: F.struct((F.get(e, k) - F.length(h)).cast("int").alias("at"), F.get(e, k).cast("int").alias("end"), h.alias("hit")))))


#: A holding period in folded text: from, up to, after, or from one to another.
PERIOD = r"od \d{1,2} do \d{1,2} (?:let|roku|mesicu)|(?:do|po|nad|od) \d{1,2} (?:letech|let|roku|rocich|roce|mesicich|mesicu|mesici)"
PERCENT = r"\d{1,2}(?:[.,]\d+)?\s*%"


def clause_tiers(folded: Column) -> Column:
    """array of struct(from_month, to_month, rate): fees by holding period, period and rate of one clause, each rate once.

    Clauses end at a comma, a semicolon or the word for and; in each, periods take rates by `greedy_pairs`.
    """
    number = lambda x, p, k=1: F.regexp_extract(x, p, k).try_cast("int")

    def tier(pair: Column) -> Column:
        hit, rate = pair["period"]["hit"], F.replace(F.regexp_replace(pair["rate"]["hit"], r"[\s%]", ""), F.lit(","), F.lit(".")).try_cast("double")
        unit = F.when(hit.rlike("mesic"), 1).otherwise(12)
        both = hit.rlike(r"^od \d+ do ")
        low = F.when(both, number(hit, r"^od (\d+)")).when(hit.rlike("^(po|nad|od) "), number(hit, r"^\w+ (\d+)")).otherwise(0) * unit
        high = F.when(both, number(hit, r"do (\d+)")).when(hit.rlike("^do "), number(hit, r"^do (\d+)")) * unit
        return F.struct(low.cast("int").alias("from_month"), high.cast("int").alias("to_month"), rate.alias("rate"))

    clauses = F.split(folded, r",(?!\d)|;| a (?=\d|od |do |po |nad )")
    pairs = F.flatten(F.transform(clauses, lambda c: greedy_pairs(places(c, PERIOD), places(c, PERCENT))))
    return F.array_sort(F.transform(pairs, tier))
