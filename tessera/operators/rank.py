"""Keeping, ordering and limiting rows by group. Ties are always broken by the order given."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list, order: list) -> DataFrame:
    """The first row of each group, by a window: for whole rows of any width."""
    return cap(df, keys, order, 1)


def cap(df: DataFrame, keys: list, order: list, most: int) -> DataFrame:
    """At most `most` rows of each group, the first by order. Spark limits each task's groups before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= most).drop("__n")


def best(df: DataFrame, keys: list[str], by: Column, columns: list[str]) -> DataFrame:
    """The named columns of the row with the largest `by` in each group, by aggregation: groups are reduced
    before the shuffle, so a group of any size costs no task more than others. by must tell rows apart."""
    top = F.max_by(F.struct(*columns), by).alias("__best")
    return df.groupBy(*keys).agg(top).select(*keys, *[F.col(f"__best.{c}") for c in columns])


def best_tier(df: DataFrame, keys: list, tier: Column) -> DataFrame:
    """All rows of each group's highest tier."""
    w = Window.partitionBy(*keys)
    return df.withColumn("__tier", tier).withColumn("__top", F.max("__tier").over(w)).where(F.col("__tier") == F.col("__top")).drop("__tier", "__top")


def slice_rows(df: DataFrame, order: list, offset: int, limit: int) -> DataFrame:
    """Rows from offset on, at most `limit` of them (0: all)."""
    df = df.orderBy(*order).offset(offset)
    return df.limit(limit) if limit else df


def round_robin(df: DataFrame, bucket: str, order: list, limit: int) -> DataFrame:
    """Rows taken from each bucket in turn: first ones, second ones and so on, at most `limit`."""
    turn = F.row_number().over(Window.partitionBy(bucket).orderBy(*order))
    return df.withColumn("turn", turn).orderBy("turn", bucket).limit(limit)


def margin_decision(df: DataFrame, keys: list, score: str, order: list, least: int, close: int) -> DataFrame:
    """(keys, the best row's columns, decision): verified, review where the second is too close or points are few, else not_found."""
    w = Window.partitionBy(*keys).orderBy(F.desc(score), *order)
    first = df.withColumn("__n", F.row_number().over(w)).withColumn("second", F.lead(score).over(w)).where("__n = 1").drop("__n")
    near = F.col("second").isNotNull() & (F.col(score) - F.col("second") < close)
    return first.withColumn("decision", F.when(F.col(score) < least // 2, "not_found").when((F.col(score) < least) | near, "review").otherwise("verified"))
