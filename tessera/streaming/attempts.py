"""Event logs as streams: latest state by key, counts by window, and host failures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.state import upsert


def read(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Events of Parquet files as they come, with the schema of a table like them; `at` is their time."""
    return spark.readStream.schema(like.schema).parquet(path).withColumn("at", F.col("ts").cast("timestamp"))


class Latest:
    """A table of the last event of each key, kept by foreachBatch.

    A batch is first reduced to one row a key, then merged with the last whole version before it on disk; the new version is
    written beside it under the batch's number. So the state outlives this object, and a batch that runs twice merges with the
    same version and writes the same rows again. A table belongs to one checkpoint: a batch before the table's last
    version is refused. Only the last two versions stay.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], order: str) -> None:
        self.spark, self.path, self.keys, self.order = spark, path.rstrip("/"), keys, order

    def _at(self, name: str = ""):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def versions(self) -> list[int]:
        """The whole versions on disk, oldest first."""
        files, root = self._at()
        if not files.exists(root):
            return []
        names = [x.getPath().getName() for x in files.listStatus(root)]
        return sorted(int(n[1:]) for n in names if n[0] == "v" and n[1:].isdigit() and files.exists(self._at(f"{n}/_SUCCESS")[1]))

    def merge(self, batch: DataFrame, number: int) -> None:
        there = self.versions()
        if there and number < there[-1]:
            raise ValueError(f"{self.path} holds version {there[-1]}, of another checkpoint than batch {number}")
        before = [v for v in there if v < number]
        own = upsert(batch.limit(0), batch, self.keys, self.order)
        if before:
            own = upsert(self.spark.read.parquet(f"{self.path}/v{before[-1]}"), own, self.keys, self.order)
        own.write.mode("overwrite").parquet(f"{self.path}/v{number}")
        for old in before[:-1]:
            files, where = self._at(f"v{old}")
            files.delete(where, True)

    def table(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/v{self.versions()[-1]}")

    def run(self, events: DataFrame, checkpoint: str) -> DataFrame:
        """All events there are, then the table."""
        query = events.writeStream.foreachBatch(self.merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        return self.table()


def counts(events: DataFrame, window: str = "1 hour", slide: str | None = None, late: str = "10 minutes", by: str = "event_type") -> DataFrame:
    """(window, by, n, total): counts by tumbling or sliding windows; events later than the watermark are left out."""
    own = F.window("at", window, slide) if slide else F.window("at", window)
    return events.withWatermark("at", late).groupBy(own.alias("window"), by).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes", by: str = "user_id") -> DataFrame:
    return events.withWatermark("at", late).groupBy(F.session_window("at", gap).alias("window"), by).agg(F.count("*").alias("n"))


def failing_hosts(events: DataFrame, host: str, is_error, least: int = 3, window: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Hosts with at least `least` errors in a window."""
    got = events.where(is_error).withWatermark("at", late).groupBy(F.window("at", window).alias("window"), host).agg(F.count("*").alias("errors"))
    return got.where(F.col("errors") >= least)


def to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Run a stream over what is there into Parquet files and read them."""
    stream.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.parquet(path)
