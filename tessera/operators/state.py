"""Tables kept by key: upserts, synchronisation, event logs, integrity.

Without a table format that merges in place, a new version of a table is a DataFrame: the union of old and new rows reduced by
key. The reduction is an aggregation (max_by), so groups shrink before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def present(key: str) -> Column:
    """A part of a key in which missing and '' are one."""
    return F.coalesce(F.col(key).cast("string"), F.lit(""))


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: str, first_kept: tuple[str, ...] = ()) -> DataFrame:
    """old with the rows of new: the last by `order` of each key wins, new before old; columns of
    `first_kept` stay as the key's first row has them. Missing parts of keys are equal to each other and to ''."""
    rows = old.withColumn("__gen", F.lit(0)).unionByName(new.withColumn("__gen", F.lit(1)), allowMissingColumns=True)
    version = F.struct("__gen", order)
    rest = [c for c in rows.columns if c not in (*keys, "__gen")]
    got = rows.groupBy(*[present(k).alias(k) for k in keys]).agg(F.max_by(F.struct(*rest), version).alias("__last"), F.min_by(F.struct(*rest), version).alias("__first"))
    own = [F.col(f"__first.{c}" if c in first_kept else f"__last.{c}").alias(c) for c in rest]
    return got.select(*[F.when(F.col(k) != "", F.col(k)).cast(rows.schema[k].dataType).alias(k) for k in keys], *own)


def synchronise(table: DataFrame, wanted: DataFrame, key: str, defaults: dict[str, Column]) -> DataFrame:
    """A row for each key of wanted: the table's if it has one, else the defaults; rows of other keys go."""
    old = table.withColumn("__there", F.lit(True))
    done = wanted.join(old, key, "left")
    return done.withColumns({c: F.when(F.col("__there"), F.col(c)).otherwise(v) for c, v in defaults.items()}).drop("__there")


def delete_missing(table: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    return table.join(wanted.select(key).distinct(), key, "left_semi")


def latest(events: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """The columns of each key's last event."""
    return events.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("l")).select(*keys, *[F.col(f"l.{c}") for c in columns])


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows of child whose key parent lacks: empty where the foreign key holds."""
    return child.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n) of keys that more than one row has."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def numbered(df: DataFrame, order: list[str], name: str = "id", after: int = 0) -> DataFrame:
    """df with dense numbers after + 1, after + 2, ... by `order`, which must tell rows apart.

    No task sees all rows: they are dealt by range and sorted in their parts, which are written so that a repeated
    task finds them as they were; counts of the parts, one row each, are added up, and each row's number is its
    part's offset and its place in it.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    held = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"__part": F.spark_partition_id(), "__at": place}).checkpoint()
    counts = held.groupBy("__part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy().orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a part
    offsets = counts.select("__part", before.alias("__before"))
    return held.join(offsets, "__part").withColumn(name, F.lit(after) + F.col("__before") + F.col("__at") + 1).drop("__part", "__at", "__before")


def appended(log: DataFrame, events: DataFrame, key: list[str], order: list[str], name: str = "id") -> DataFrame:
    """Rows to append to log (which has key and name): those of events whose key it lacks, once each, numbered on from its last.

    Appending the same events again gives nothing, and a retry before the append gives the same numbers, so ids stay
    dense and unique. Of events with one key the first by `order` counts. Null parts of keys are equal.
    """
    last = log.agg(F.coalesce(F.max(name), F.lit(0)).alias("last")).first()["last"]
    once = events.groupBy(*key).agg(F.min(F.struct(*order, *[c for c in events.columns if c not in order + key])).alias("__e"))
    once = once.select(*key, *[F.col(f"__e.{c}") for c in events.columns if c not in key])
    known = log.select(*[F.col(k).alias(f"__{k}") for k in key]).distinct()
    same = [once[k].eqNullSafe(known[f"__{k}"]) for k in key]
    return numbered(once.join(known, same, "left_anti"), [*order, *[k for k in key if k not in order]], name, last)
