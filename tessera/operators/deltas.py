"""Generations of results compared and merged."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def transitions(before: DataFrame, after: DataFrame, key: str, status: str, by: list[str] = ()) -> DataFrame:
    """(by, before, after, n) of the keys that both generations have."""
    both = before.select(key, *by, F.col(status).alias("before")).join(after.select(key, F.col(status).alias("after")), key)
    return both.groupBy(*by, "before", "after").agg(F.count("*").alias("n"))


def delta(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, kind): A where only new has a value, B where they differ, same, or lost."""
    both = old.select(*keys, F.col(value).alias("__o")).join(new.select(*keys, F.col(value).alias("__n")), keys, "full")
    kind = F.when(F.col("__o").isNull() & F.col("__n").isNotNull(), "A").when(F.col("__n").isNull(), "lost").when(F.col("__o") != F.col("__n"), "B").otherwise("same")
    return both.select(*keys, kind.alias("kind"))


def first_writer(base: DataFrame, stages: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """stages' rows with `role`: `baseline` where base already has the key, else `written` for the first by order, `corroborating` for later ones."""
    there = base.select(*keys).distinct().withColumn("__base", F.lit(True))
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    role = F.when(F.col("__base"), "baseline").when(F.col("__n") == 1, "written").otherwise("corroborating")
    return stages.join(there, keys, "left").withColumn("__n", n).withColumn("role", role).drop("__base", "__n")


def better_retry(base: DataFrame, retry: DataFrame, key: str, quality: list[str], least_gain: int) -> DataFrame:
    """base's rows, replaced by retry's where its quality (compared column by column) is higher and the first column gains enough."""
    r = retry.select(key, F.struct(*quality).alias("__q"), F.struct(*[c for c in retry.columns if c != key]).alias("__row"))
    better = F.col("__q").isNotNull() & (F.col("__q") > F.struct(*quality)) & (F.col(f"__q.{quality[0]}") - F.col(quality[0]) >= least_gain)
    done = base.join(r, key, "left").withColumn("replaced", F.coalesce(better, F.lit(False)))
    return done.select(key, *[F.when(F.col("replaced"), F.col(f"__row.{c}")).otherwise(F.col(c)).alias(c) for c in base.columns if c != key], "replaced")


def running_coverage(df: DataFrame, stage: str, n: Column) -> DataFrame:
    """(stage, n, upto): values gained by each stage and up to it; stages are few, so one task sums them."""
    own = df.groupBy(stage).agg(n.alias("n"))
    return own.withColumn("upto", F.sum("n").over(Window.orderBy(stage).rowsBetween(Window.unboundedPreceding, 0)))


def funnel(df: DataFrame, stages: list[tuple[str, Column]]) -> DataFrame:
    """(stage, n): rows by the first stage whose condition fails, `done` if none; stages without rows have 0."""
    first = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in stages], F.lit("done"))
    names = [name for name, _ in stages] + ["done"]
    counts = df.groupBy(first.alias("stage")).agg(F.count("*").alias("n"))
    return zero_filled(counts, "stage", names)


def zero_filled(counts: DataFrame, key: str, levels: list) -> DataFrame:
    """counts with a row for each level, n 0 where there was none."""
    every = counts.sparkSession.createDataFrame([(x,) for x in levels], [key])
    return every.join(counts, key, "left").select(key, F.coalesce("n", F.lit(0)).alias("n"))


def coverage(all_: DataFrame, covered: DataFrame, key: str, web: str) -> DataFrame:
    """all_ with `part`: covered, new with an address, or new without."""
    there = covered.select(key).distinct().withColumn("__c", F.lit(True))
    has = F.trim(F.coalesce(F.col(web), F.lit(""))) != ""
    return all_.join(there, key, "left").withColumn("part", F.when(F.col("__c"), "covered").when(has, "new_with_web").otherwise("new_without_web")).drop("__c")


def missing_groups(groups: dict[str, list[str]], found: Column) -> Column:
    """Names of the groups of which nothing was found."""
    return F.filter(F.array(*[F.when(~F.arrays_overlap(found, F.array(*map(F.lit, v))), F.lit(k)) for k, v in groups.items()]), lambda x: x.isNotNull())


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def ablation(whole: DataFrame, without: DataFrame, switch: str, keys: list[str]) -> DataFrame:
    """(switch, keys): what whole(keys) has and without(switch, keys) lacks, with one change switched off, for each switch."""
    names = [r[0] for r in without.select(switch).distinct().collect()]  # a row for each switch
    expected = whole.select(*keys).distinct().withColumn(switch, F.explode(F.array(*map(F.lit, names))))
    return expected.join(without.select(switch, *keys), [switch, *keys], "left_anti").select(switch, *keys)
