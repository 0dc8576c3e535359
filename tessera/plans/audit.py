"""Audits of whole sets: counts by several groupings at once, weakest fields, examples, gates and delivery."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.deltas import union_all

from ..operators.rank import cap


def counts(findings: DataFrame, groupings: list[list[str]]) -> DataFrame:
    """Counts of rows by each grouping, from one pass: (columns, level, n), columns outside a grouping null.

    level is the grouping's number of grouping columns, as bits of those left out.
    """
    columns = list(dict.fromkeys(c for g in groupings for c in g))
    return findings.groupingSets([[F.col(c) for c in g] for g in groupings], *[F.col(c) for c in columns]).agg(F.grouping_id().alias("level"), F.count("*").alias("n"))


def weakest(verdicts: DataFrame, field: str, status: str, good: str = "valid", absent: str = "missing") -> DataFrame:
    """(field, delivered, doubted, share) of fields that deliver anything; order by falling share, doubted, then name."""
    there = F.count_if(F.col(status) != absent)
    doubted = F.count_if(~F.col(status).isin(good, absent))
    return verdicts.groupBy(field).agg(there.alias("delivered"), doubted.alias("doubted")).where("delivered > 0").withColumn("share", F.col("doubted") / F.col("delivered"))


def examples(findings: DataFrame, status: str, reason: str, order: list[str], most: int = 5) -> DataFrame:
    """The first finding of each reason, for the first `most` reasons of each status."""
    row = F.struct(*order, *[c for c in findings.columns if c not in (*order, status, reason)])
    first = findings.groupBy(status, reason).agg(F.min(row).alias("f")).select(status, reason, "f.*")
    return cap(first, [status], order, most)


def shared(df: DataFrame, url: str, name: str) -> DataFrame:
    """(url, names) of addresses that more than one name has."""
    return df.where(F.coalesce(F.col(url).cast("string"), F.lit("")) != "").select(url, name).distinct().groupBy(url).agg(F.count("*").alias("names")).where("names > 1")


def blocked(findings: DataFrame, statuses: list[str], keys: list[str]) -> DataFrame:
    return findings.where(F.col("status").isin(statuses)).select(*keys).distinct()


def delivered(values: DataFrame, blocked_pairs: DataFrame, keys: list[str], status: str, value: str, url: str) -> DataFrame:
    """values with only what is found, not empty and not blocked; anything else is not_found and has neither value nor address."""
    held = values.join(blocked_pairs.withColumn("__held", F.lit(True)), keys, "left")
    good = (F.col(status) == "found") & F.col("__held").isNull() & F.col(value).isNotNull()
    return held.select(*keys, F.when(good, "found").otherwise("not_found").alias("status"), F.when(good, F.col(value)).alias("value"), F.when(good, F.col(url)).alias("source_url"))


def gate(audit_digest: str | None, digest: str, ruleset: str | None, current: str, findings: DataFrame, records: DataFrame, key: str, audited: int | None) -> str | None:
    """Why an audit doesn't belong to these records, or nothing: digest, rules, unknown funds, count, in this order."""
    if not audit_digest:
        return "no digest"
    if audit_digest != digest:
        return "digest differs"
    if not ruleset:
        return "no ruleset"
    if ruleset != current:
        return "ruleset differs"
    unknown = findings.join(records, key, "left_anti").select(key).limit(1).collect()
    if unknown:
        return f"unknown: {unknown[0][0]}"
    if audited is not None and audited != records.count():
        return "count differs"
    return None


def allow_list(value: str, kept: list[str]) -> Column:
    """The named fields of a struct, null where it is."""
    return F.when(F.col(value).isNotNull(), F.struct(*[F.col(f"{value}.{k}").alias(k) for k in kept]))


def allow_list_items(values: str, kept: list[str]) -> Column:
    return F.transform(values, lambda x: F.struct(*[x[k].alias(k) for k in kept]))


def summary(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, found): how many rows hold each field, from one pass and unpivoted."""
    one = df.agg(*[F.count(f).alias(f) for f in fields])
    return one.unpivot([], fields, "field", "found")


def wide_to_long(df: DataFrame, keys: list[str], fields: list[str], name: str = "field", value: str = "value") -> DataFrame:
    return df.unpivot(keys, fields, name, value)


def histogram(df: DataFrame, key: str, n: Column, most: int) -> DataFrame:
    """(n, rows) of how many rows have n = 0 .. most, those without any included."""
    got = df.select(n.alias("n")).groupBy("n").agg(F.count("*").alias("rows"))
    every = df.sparkSession.range(most + 1).select(F.col("id").cast("int").alias("n"))
    return every.join(got, "n", "left").select("n", F.coalesce("rows", F.lit(0)).alias("rows"))


def frequency(gap_days: Column) -> Column:
    """The frequency of a series from a gap in days."""
    return F.when(gap_days <= 10, "daily").when(gap_days <= 45, "monthly").when(gap_days <= 130, "quarterly").when(gap_days <= 400, "annual").otherwise("irregular")


def series_frequency(df: DataFrame, keys: list[str], day: str) -> DataFrame:
    """(keys, points, frequency): by the upper median of the gaps between a series' distinct days; irregular below two."""
    w = Window.partitionBy(*keys).orderBy(day)
    gaps = df.select(*keys, day).distinct().withColumn("gap", F.datediff(F.lead(day).over(w), day))
    own = gaps.groupBy(*keys).agg(F.count("*").alias("points"), F.array_sort(F.collect_list("gap")).alias("g"))
    median = F.get("g", F.floor(F.size("g") / 2).cast("int"))
    return own.select(*keys, "points", F.when(F.size("g") == 0, "irregular").otherwise(frequency(median)).alias("frequency"))


def series(df: DataFrame, keys: list[str], day: str, value: str, most: int = 400) -> DataFrame:
    """(keys, observations): each series as a sorted array of at most `most` observations (the feature's cap)."""
    return cap(df, keys, [day, value], most).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(day, value))).alias("observations"))


def repeated_errors(df: DataFrame, host: str, code: Column, least: int = 3) -> DataFrame:
    """df with `level`: errors of hosts with at least `least` server errors become one kind."""
    n = F.sum(F.when(code >= 500, 1).otherwise(0)).over(Window.partitionBy(host))
    level = F.when((code >= 500) & (n >= least), "host_failing").when(code >= 500, "failure").when(code == 404, "expected_miss").otherwise("warning")
    return df.withColumn("level", level)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


#: What a pass adds up, and the digits to which seconds are rounded.
PASS_COUNTS = ["pages_visited", "documents_discovered", "documents_downloaded", "documents_parsed", "superseded_documents", "failures", "expected_misses", "warnings"]
PASS_SECONDS = {"duration_seconds": 3, "discovery_seconds": 1, "crawl_seconds": 1, "parse_seconds": 1, "extract_seconds": 1}


def pass_metrics(results: DataFrame, by: list[str] = ()) -> DataFrame:
    """Sums of a pass over results, a row for each fund: funds, counts, rounded seconds; real failures are those not expected."""
    counts_ = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in PASS_COUNTS if c in results.columns]
    seconds = [F.round(F.coalesce(F.sum(c), F.lit(0.0)), n).alias(c) for c, n in PASS_SECONDS.items() if c in results.columns]
    got = results.groupBy(*by).agg(F.count("*").alias("funds"), *counts_, *seconds)
    return got.withColumn("real_failures", F.col("failures") - F.col("expected_misses")) if {"failures", "expected_misses"} <= set(got.columns) else got


def totals(documents: DataFrame, counters: dict[str, str], sums: list[str], by: list[str] = ()) -> DataFrame:
    """(by, metric, level, n): how often each level of the counters stands (each element of arrays), and the sums, as rows."""
    parts = []
    for metric, column in counters.items():
        listed = documents.schema[column].dataType.typeName() == "array"
        rows = documents.select(*by, (F.explode(column) if listed else F.col(column)).alias("level")).withColumn("level", F.col("level").cast("string"))
        parts.append(rows.groupBy(*by, "level").agg(F.count("*").cast("double").alias("n")).select(*by, F.lit(metric).alias("metric"), "level", "n"))
    if sums:
        added = documents.groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("double").alias(c) for c in sums])
        rows = F.array(*[F.struct(F.lit(c).alias("metric"), F.lit(None).cast("string").alias("level"), F.col(c).alias("n")) for c in sums])
        parts.append(added.select(*by, F.explode(rows).alias("r")).select(*by, "r.*"))
    return union_all(parts)


def conflict_report(resolved: DataFrame, field: str, reasons: int = 40) -> DataFrame:
    """(section, name, outcome, n): how the disagreements of resolved(field, outcome, decided_by, n_claims) ended.

    Keys of one claim were never in conflict and don't count. Sections: all outcomes; outcomes of each field; what decided,
    where anything had to be decided (undecided where nothing could); of the last the `reasons` most frequent. One pass:
    every key gives a row to each section it belongs to, which are added up before the shuffle.
    """
    decided = F.when(F.col("outcome") != "equivalent_after_normalization", F.coalesce("decided_by", F.lit("undecided")))
    row = lambda section, name: F.struct(F.lit(section).alias("section"), name.cast("string").alias("name"), F.col("outcome").alias("outcome"))
    sections = F.array(row("outcome", F.col("outcome")), row("field", F.col(field)), F.when(decided.isNotNull(), row("decided_by", decided)))
    counts = resolved.where("n_claims > 1").select(F.explode(F.filter(sections, lambda s: s.isNotNull())).alias("s")).groupBy("s").agg(F.count("*").alias("n")).select("s.*", "n")
    w = Window.partitionBy("section").orderBy(F.desc("n"), "name", "outcome")
    return counts.withColumn("__k", F.row_number().over(w)).where((F.col("section") != "decided_by") | (F.col("__k") <= reasons)).drop("__k")
