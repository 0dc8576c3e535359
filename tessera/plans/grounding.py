"""Packets of evidence for open fields, and decisions made on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fold, has_any
from ..operators.rank import cap

#: Points of a snippet.
WARNING_POINTS, IDENTITY_POINTS, KEYWORD_POINTS, NUMBER_POINTS = -80, 25, 20, 10


def snippet_score(priority: Column, quote: Column, keywords: list[str], identity: Column, warnings: list[str]) -> Column:
    q = fold(quote)
    hits = sum((F.when(F.contains(q, F.lit(k)), KEYWORD_POINTS).otherwise(0) for k in keywords), F.lit(0))
    points = priority + hits + F.when(identity, IDENTITY_POINTS).otherwise(0) + F.when(q.rlike(r"\d"), NUMBER_POINTS).otherwise(0) + F.when(has_any(q, warnings), WARNING_POINTS).otherwise(0)
    return F.greatest(F.lit(0), points)


def packets(unresolved: DataFrame, snippets: DataFrame, most: int = 8) -> DataFrame:
    """(packet_id, fund, field, snippets): for each unresolved (fund, field) its best snippets.

    Of snippets with one address, page and folded quote the first counts; order: without warning, score, source, page.
    """
    own = snippets.join(unresolved.select("fund", "field").distinct(), ["fund", "field"], "left_semi").withColumn("__q", fold("quote"))
    row = F.struct("warning", (-F.col("score")).alias("down"), "source_id", "page", "quote")
    once = own.groupBy("fund", "field", "url", "page", "__q").agg(F.min(row).alias("r")).select("fund", "field", "r.*")
    top = cap(once, ["fund", "field"], ["warning", "down", "source_id", "page", "quote"], most)
    got = top.groupBy("fund", "field").agg(F.transform(F.array_sort(F.collect_list(F.struct("warning", "down", "source_id", "page", "quote"))), lambda s: F.struct(s["source_id"].alias("source_id"), s["page"].alias("page"), (-s["down"]).alias("score"), s["quote"].alias("quote"))).alias("snippets"))
    return got.withColumn("packet_id", F.sha2(F.concat_ws("/", "fund", "field"), 256))


def bad_references(packets_: DataFrame, decisions: DataFrame) -> DataFrame:
    """Decisions on unknown packets or with snippets that their packet lacks."""
    ids = packets_.select("packet_id", F.transform("snippets", lambda s: s["source_id"]).alias("known"))
    both = decisions.join(ids, "packet_id", "left")
    return both.where(F.col("known").isNull() | (F.size(F.array_except("snippet_ids", F.coalesce("known", F.array().cast("array<long>")))) > 0)).select("packet_id")


def apply(records: DataFrame, packets_: DataFrame, decisions: DataFrame, overwrite: bool = False) -> DataFrame:
    """records(fund, field, status, value) with accepted decisions' values; what is found stays unless told otherwise."""
    d = decisions.where("decision = 'accept'").join(packets_.select("packet_id", "fund", "field"), "packet_id").select("fund", "field", F.col("value").alias("__new"))
    takes = F.col("__new").isNotNull() & (F.lit(overwrite) | (F.col("status") != "found"))
    done = records.join(d, ["fund", "field"], "left")
    return done.withColumn("value", F.when(takes, F.col("__new")).otherwise(F.col("value"))).withColumn("status", F.when(takes, "found").otherwise(F.col("status"))).drop("__new")


def weak(funds: DataFrame, outputs: DataFrame, fund: str, most_found: int) -> DataFrame:
    """Funds without output, with a failed one, or with few fields found."""
    o = outputs.select(fund, F.col("status").alias("__s"), F.col("found").alias("__n"))
    return funds.join(o, fund, "left").where(F.col("__s").isNull() | (F.col("__s") == "failed") | (F.col("__n") <= most_found)).drop("__s", "__n")


def parts_by_status(records: DataFrame, status: str, done: list[str]) -> tuple[DataFrame, DataFrame]:
    """Records that are done and those that remain."""
    is_done = F.coalesce(F.col(status).isin(done), F.lit(False))
    return records.where(is_done), records.where(~is_done)


def quality(found: Column, weighted: Column, processing: Column) -> Column:
    """What outputs of one fund are compared by, in this order."""
    return F.struct(found.alias("found"), weighted.alias("weighted"), processing.alias("processing"))


def coverage_bands(n: Column) -> Column:
    """Bands of found fields: 0, 1, 2, 3-5, 6+."""
    return F.when(n <= 2, n.cast("string")).when(n <= 5, "3-5").otherwise("6+")


def report(counts: DataFrame, title: str, columns: list[str]) -> str:
    """A Markdown table of an aggregate (a few rows), made on the driver."""
    head = "| " + " | ".join(columns) + " |\n|" + "---|" * len(columns)
    return f"# {title}\n\n{head}\n" + "\n".join("| " + " | ".join(str(r[c]) for c in columns) + " |" for r in counts.orderBy(*columns).collect())
