"""Scans of stored sources for reruns and reports, and what a cache holds, as joins of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import canonical_domain
from ..operators.rank import cap


def cached_sources(sources: DataFrame, funds: DataFrame, parsed: DataFrame, ids: DataFrame) -> DataFrame:
    """Sources of ids(source_id) that lie in the cache, with their fund and, where they are parsed, the parser's facts."""
    own = sources.join(ids.select("source_id").distinct(), "source_id", "left_semi").where("local_path is not null")
    return own.join(funds.select("fund_id", "name", "web"), "fund_id").join(parsed.drop("fund_id", "url"), "source_id", "left")


def rows_to_process(sources: DataFrame, funds: DataFrame, ids: DataFrame | None, limit: int, kind: str = "pdf") -> DataFrame:
    """The cached sources of some ids, which alone count if given; else the first `limit` of a content type, by id (the limit is the feature's)."""
    held = sources.where("local_path is not null")
    if ids is not None:
        held = held.join(ids.select("source_id").distinct(), "source_id", "left_semi")
    else:
        held = held.where(F.contains("content_type", F.lit(kind))).orderBy("source_id").limit(limit)
    return held.join(funds.select("fund_id", "name", "web"), "fund_id")


def manifest(sources: DataFrame, parsed: DataFrame, log: DataFrame, funds: DataFrame) -> DataFrame:
    """(fund_id, sources): each fund of a batch, its sources in order of address with their referrer (the last logged) and parse."""
    referrers = log.groupBy("fund_id", "url").agg(F.max_by("discovered_from", "seq").alias("referrer"))
    rows = sources.join(parsed.select("source_id", "character_count"), "source_id", "left").join(referrers, ["fund_id", "url"], "left")
    listed = rows.groupBy("fund_id").agg(F.array_sort(F.collect_list(F.struct("url", "referrer", "character_count"))).alias("sources"))
    return funds.select("fund_id").join(listed, "fund_id", "left")


def processed_and_rest(funds: DataFrame, records: DataFrame, status: str, done: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records that are done, funds that remain, counts by status): the split of a run that was stopped."""
    own = records.where(F.col(status).isin(done))
    return own, funds.join(own, "fund_id", "left_anti"), records.groupBy(status).agg(F.count("*").alias("n"))


def search_results(responses: DataFrame, body: str, query: str, excluded: list[str], most: int = 3) -> DataFrame:
    """(query, rank, url, domain, title, snippet) of JSON answers: items in order, each address once, at most `most` of a domain.

    Bodies that are not JSON, or have no list of items, and items without an address give nothing. A
    domain is excluded with all below it.
    """
    items = F.from_json(F.col(body), "items array<struct<link:string,title:string,snippet:string>>")["items"]
    rows = responses.select(F.col(query).alias("query"), F.posexplode(items).alias("seq", "i")).where("i.link is not null")
    named = [F.coalesce(f"i.{c}", F.lit("")).alias(c) for c in ("title", "snippet")]
    rows = rows.select("query", "seq", F.col("i.link").alias("url"), canonical_domain("i.link").alias("domain"), *named)
    out = F.col("domain") == ""
    for x in excluded:
        out = out | (F.col("domain") == x) | F.endswith("domain", F.lit(f".{x}"))
    once = rows.where(~out).groupBy("query", "url", "domain").agg(F.min_by(F.struct("title", "snippet"), "seq").alias("i"), F.min("seq").alias("seq"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy("seq")) - 1
    return cap(once, ["query", "domain"], ["seq"], most).select("query", rank.alias("rank"), "url", "domain", "i.title", "i.snippet")


def save_bodies(responses: DataFrame, path: str, body: str = "content") -> None:
    """Bodies under their digest, each once, and what is known of every answer: two tables at path."""
    kept = responses.withColumn("sha256", F.sha2(F.col(body), 256))
    kept.groupBy("sha256").agg(F.first(body).alias(body)).write.mode("overwrite").parquet(f"{path}/bodies")
    kept.drop(body).write.mode("overwrite").parquet(f"{path}/answers")


def saved_bodies(spark: SparkSession, path: str, wanted: Column | None = None) -> DataFrame:
    """The answers at path with their bodies; of those, what `wanted` says."""
    answers = spark.read.parquet(f"{path}/answers")
    return (answers if wanted is None else answers.where(wanted)).join(spark.read.parquet(f"{path}/bodies"), "sha256", "left")
