"""The state of a run as tables in a folder: keyed upserts, ordered scans, integrity.

Each table is a folder of numbered versions in Parquet. A write makes a whole new version and becomes
current when it is complete (its `_SUCCESS` is there); the two newest are kept. Keys treat missing
parts as equal, and what the first row of a key knew of its discovery stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import state
from .schemas import struct

#: name -> (columns, key, columns that the first row keeps).
TABLES: dict[str, tuple[str, list[str], tuple[str, ...]]] = {
    "funds": ("fund_id string, name string, web string, status string, created_at timestamp, updated_at timestamp", ["fund_id"], ("created_at",)),
    "sources": ("source_id bigint, fund_id string, url string, canonical_url string, title string, document_type string, content_type string, status string, sha256 string, local_path string, discovered_at timestamp, updated_at timestamp", ["fund_id", "canonical_url"], ("discovered_at", "source_id")),
    "attempts": ("attempt_id bigint, fund_id string, stage string, status string, url string, error_code string, error_message string, updated_at timestamp", ["attempt_id"], ()),
    "parsed_documents": ("source_id bigint, fund_id string, document_format string, parser_name string, page_count int, character_count int, scanned_candidate boolean, text_path string, updated_at timestamp", ["source_id"], ()),
    "fund_parties": ("fund_id string, role string, name string, ico string, source_url string, updated_at timestamp", ["fund_id", "role"], ()),
    "capital_observations": ("fund_id string, metric_type string, amount double, currency string, as_of date, share_class string, scope_type string, source_url string, quote string, page int, confidence string, review_required boolean, updated_at timestamp", ["fund_id", "metric_type", "as_of", "share_class", "currency"], ()),
    "annual_returns": ("fund_id string, year int, return_percent double, series_type string, share_class string, currency string, source_url string, updated_at timestamp", ["fund_id", "year", "series_type", "share_class", "currency"], ()),
    "historical_values": ("fund_id string, as_of date, value double, value_type string, share_class string, currency string, frequency string, unit string, updated_at timestamp", ["fund_id", "as_of", "value_type", "share_class", "currency"], ()),
    "fund_news": ("fund_id string, url string, title string, published_at date, updated_at timestamp", ["fund_id", "url"], ()),
    "discovery_log": ("fund_id string, run_id string, url string, score int, accepted boolean, rejection_reason string, updated_at timestamp", ["fund_id", "run_id", "url"], ()),
    "document_metadata": ("source_id bigint, fund_id string, document_type string, scope string, effective_at date, published_at date, as_of date, period_start date, period_end date, updated_at timestamp", ["source_id"], ()),
}
#: child column -> parent table and column.
REFERENCES = [(t, "fund_id", "funds", "fund_id") for t in TABLES if t != "funds"] + [("parsed_documents", "source_id", "sources", "source_id"), ("document_metadata", "source_id", "sources", "source_id")]
#: The states a row may be in.
STATES = {"funds": ["pending", "in_progress", "completed", "partial", "failed"], "sources": ["discovered", "downloaded", "parsed", "failed", "skipped"]}
ORDERS = {
    "fund_parties": ["role"],
    "capital_observations": ["as_of", "metric_type"],
    "annual_returns": ["year", "series_type"],
    "historical_values": ["value_type", "share_class", "as_of"],
    "parsed_documents": ["source_id"],
    "document_metadata": ["source_id"],
}
VERSION = 5


class StoreError(RuntimeError):
    """A store that isn't as it must be."""


class Store:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    # --- versions

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _versions(self, table: str) -> list[int]:
        fs, p = self._fs(f"{self.root}/{table}")
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        good = [n for n in names if n.startswith("v") and fs.exists(self._fs(f"{self.root}/{table}/{n}/_SUCCESS")[1])]
        return sorted(int(n[1:]) for n in good)

    def initialise(self) -> None:
        """Empty tables where there are none; a store of a newer version is refused."""
        fs, p = self._fs(f"{self.root}/version")
        if fs.exists(p):
            found = self.spark.read.json(f"{self.root}/version").first().version
            if found > VERSION:
                raise StoreError(f"version {found} is newer than {VERSION}")
        self.spark.createDataFrame([(VERSION,)], "version int").coalesce(1).write.mode("overwrite").json(f"{self.root}/version")
        for name, (ddl, _, _) in TABLES.items():
            if not self._versions(name):
                self._write(name, self.spark.createDataFrame([], struct(ddl)))

    def reset(self) -> None:
        fs, p = self._fs(self.root)
        fs.delete(p, True)

    def table(self, name: str) -> DataFrame:
        versions = self._versions(name)
        if not versions:
            raise StoreError(f"no table {name}")
        return self.spark.read.schema(struct(TABLES[name][0])).parquet(f"{self.root}/{name}/v{versions[-1]}")

    def _write(self, name: str, df: DataFrame) -> None:
        versions = self._versions(name)
        new = versions[-1] + 1 if versions else 1
        wanted = struct(TABLES[name][0])
        df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted]).write.mode("overwrite").parquet(f"{self.root}/{name}/v{new}")
        for v in versions[:-1]:
            fs, p = self._fs(f"{self.root}/{name}/v{v}")
            fs.delete(p, True)

    # --- writes

    def upsert(self, name: str, rows: DataFrame) -> None:
        """Rows by the table's key: the newest updated_at of the rows wins, and wins over what is there."""
        ddl, keys, kept = TABLES[name]
        for f in struct(ddl):
            if f.name not in rows.columns:
                rows = rows.withColumn(f.name, F.lit(None).cast(f.dataType))
        if name in STATES:
            bad = rows.where(~F.coalesce(F.col("status"), F.lit("")).isin(STATES[name])).limit(1).collect()
            if bad:
                raise StoreError(f"{name}: no status {bad[0].status}")
        self._write(name, state.upsert(self.table(name), rows.select(*[f.name for f in struct(ddl)]), keys, "updated_at", kept))

    def register_funds(self, funds: DataFrame) -> None:
        """The given funds and no others: a known one keeps its state, a new one is pending, what hangs on others goes."""
        old = self.table("funds").select("fund_id", F.col("status").alias("__status"))
        rows = funds.join(old, "fund_id", "left").withColumn("status", F.coalesce("__status", F.lit("pending"))).drop("__status")
        self.upsert("funds", rows)
        self._write("funds", state.delete_missing(self.table("funds"), funds, "fund_id"))
        for name in TABLES:
            if name != "funds":
                self._write(name, state.delete_missing(self.table(name), funds, "fund_id"))

    def record_parsed(self, rows: DataFrame) -> None:
        """Parsed documents; their sources become parsed."""
        self.upsert("parsed_documents", rows)
        done = rows.select("source_id").distinct().withColumn("__done", F.lit(True))
        s = self.table("sources").join(done, "source_id", "left")
        self._write("sources", s.withColumn("status", F.when(F.col("__done"), "parsed").otherwise(F.col("status"))))

    def set_status(self, fund_id: str, status: str, at) -> None:
        """One fund's state; a fund that isn't there is an error."""
        one = self.table("funds").where(F.col("fund_id") == fund_id)
        if one.count() != 1:
            raise StoreError(f"no fund {fund_id}")
        self.upsert("funds", one.withColumn("status", F.lit(status)).withColumn("updated_at", F.lit(at).cast("timestamp")))

    def persist_extended(self, records: DataFrame) -> dict[str, int]:
        """The found series, parties and news of nested records as rows; how many of each were written."""
        found = lambda f: records.where(F.col(f"{f}.status") == "found")
        now = F.current_timestamp().alias("updated_at")
        items = lambda f, path: found(f).select("fund_id", F.explode(f"{f}.value.{path}").alias("x"))
        parties = found("manager").select("fund_id", F.lit("manager").alias("role"), "manager.value.*", now).union(found("administrator").select("fund_id", F.lit("administrator").alias("role"), "administrator.value.*", now))
        capital = items("aum_history", "observations").select("fund_id", "x.*", now)
        returns = items("annual_returns", "observations").select("fund_id", "x.*", now)
        values = items("historical_values", "series").select("fund_id", "x.value_type", "x.share_class", "x.currency", "x.frequency", F.explode("x.observations").alias("o")).select("fund_id", "value_type", "share_class", "currency", "frequency", "o.*", now)
        news = items("news", "items").select("fund_id", "x.*", now)
        done = {"fund_parties": parties, "capital_observations": capital, "annual_returns": returns, "historical_values": values, "fund_news": news}
        counts = {}
        for name, rows in done.items():
            self.upsert(name, rows)
            counts[name] = rows.count()
        return counts

    # --- reads

    def of_fund(self, name: str, fund_id: str, where: Column | None = None) -> DataFrame:
        """A fund's rows of a table in the table's order."""
        rows = self.table(name).where(F.col("fund_id") == fund_id)
        if where is not None:
            rows = rows.where(where)
        if name == "fund_news":
            return rows.orderBy(F.desc_nulls_last("published_at"), "title")
        if name == "discovery_log":
            return rows.orderBy(F.desc("score"), "url")
        return rows.orderBy(*ORDERS.get(name, TABLES[name][1]))

    def parseable(self, fund_id: str, include_parsed: bool = False) -> DataFrame:
        return self.of_fund("sources", fund_id, F.col("status").isin(["downloaded", "parsed"] if include_parsed else ["downloaded"])).orderBy("source_id")

    def parsed(self, fund_id: str) -> DataFrame:
        """Parsed documents with their sources."""
        return self.of_fund("parsed_documents", fund_id).join(self.table("sources").drop("fund_id", "updated_at"), "source_id").orderBy("source_id")

    def candidates(self, limit: int | None = None) -> DataFrame:
        """Parsed sources with a body, one of each digest (all of those without); with a limit the first so many by id."""
        rows = self.table("sources").join(self.table("parsed_documents").drop("fund_id", "updated_at"), "source_id").where("local_path is not null")
        key = F.coalesce(F.nullif(F.col("sha256"), F.lit("")), F.concat(F.lit("source "), F.col("source_id").cast("string")))
        first = rows.withColumn("__k", key).groupBy("__k").agg(F.min_by(F.struct(*rows.columns), "source_id").alias("r")).select("r.*")
        return first if limit is None else first.orderBy("source_id").limit(limit)

    def unstructured(self, structured: DataFrame) -> DataFrame:
        """Parsed sources that have no structured file yet."""
        return self.table("parsed_documents").join(structured.select("source_id"), "source_id", "left_anti")

    def extended(self, fund_id: str) -> dict[str, DataFrame]:
        """A fund's series as arrays, its values grouped by type, class, currency and frequency."""
        values = self.of_fund("historical_values", fund_id).groupBy("value_type", "share_class", "currency", "frequency").agg(F.array_sort(F.collect_list(F.struct("as_of", "value"))).alias("observations"))
        return {"parties": self.of_fund("fund_parties", fund_id), "capital": self.of_fund("capital_observations", fund_id), "returns": self.of_fund("annual_returns", fund_id), "values": values, "news": self.of_fund("fund_news", fund_id)}

    def counts(self) -> DataFrame:
        """(table, status, n): rows of each table, funds and sources by state."""
        parts = [self.table(t).groupBy("status" if t in STATES else F.lit(None).cast("string").alias("status")).agg(F.count("*").alias("n")).select(F.lit(t).alias("table"), "status", "n") for t in TABLES]
        out = parts[0]
        for p in parts[1:]:
            out = out.union(p)
        return out

    def broken_references(self) -> list[str]:
        """Tables and columns with rows whose parent is missing, or that have no key of their own."""
        out = []
        for child, column, parent, key in REFERENCES:
            rows = self.table(child).where(F.col(column).isNotNull())
            if state.orphans(rows, self.table(parent), column, key).limit(1).count():
                out.append(f"{child}.{column}")
        for name, (_, keys, _) in TABLES.items():
            if state.duplicates(self.table(name), keys).limit(1).count():
                out.append(f"{name} has repeated keys")
        return out
