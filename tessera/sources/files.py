"""Reading and writing files through Spark's sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import schemas


class InputError(ValueError):
    """An input that can't be used as it is."""


def read_array(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Rows of a JSON array in the order they stand in, strictly of a schema, with `ordinal` from 0. An empty file is an error."""
    raw = spark.read.option("multiLine", True).option("mode", "FAILFAST").schema(schemas.struct(ddl)).json(path)
    rows = raw.withColumn("__at", F.monotonically_increasing_id())
    if rows.isEmpty():
        raise InputError(f"{path} holds no records")
    return rows.withColumn("ordinal", F.row_number().over(Window.orderBy("__at")) - 1).drop("__at")


def read_funds(spark: SparkSession, path: str) -> DataFrame:
    funds = read_array(spark, path, schemas.FUND)
    bad = funds.where(F.trim(F.coalesce("name", F.lit(""))) == "").limit(1).collect()
    if bad:
        raise InputError(f"record {bad[0].ordinal} has no name")
    return funds.withColumn("name", F.trim("name"))


def read_fallback_sources(spark: SparkSession, path: str) -> DataFrame:
    """Enabled sources by priority and name; two of one name, whatever its case, are an error."""
    rows = read_array(spark, path, schemas.FALLBACK_SOURCE)
    twice = rows.groupBy(F.lower("name").alias("n")).count().where("count > 1").limit(1).collect()
    if twice:
        raise InputError(f"the source {twice[0].n} is listed twice")
    return rows.where(F.coalesce("enabled", F.lit(True))).orderBy("priority", "name").drop("ordinal")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Nested records, strictly."""
    return read_array(spark, path, schemas.RECORD)


def read_lenient(spark: SparkSession, path: str, ddl: str = schemas.RECORD) -> DataFrame:
    """Records as far as they can be read; what can't is kept as text in `_corrupt_record`."""
    schema = schemas.struct(ddl).add("_corrupt_record", "string")
    return spark.read.option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").schema(schema).json(path)


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """Records of any shape, one variant each."""
    return spark.read.option("multiLine", True).option("singleVariantColumn", "record").json(path)


def read_audit(spark: SparkSession, path: str) -> tuple[DataFrame, str | None, str | None, int | None]:
    """(findings, digest, ruleset, funds) of an audit report."""
    report = spark.read.option("multiLine", True).schema(schemas.struct(schemas.AUDIT)).json(path)
    head = report.select("input_sha256", "ruleset_version", "summary.funds").first()
    return report.select(F.explode("findings").alias("f")).select("f.*"), head.input_sha256, head.ruleset_version, head.funds


def read_packets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).schema(schemas.struct(schemas.PACKETS)).json(path).select(F.explode("packets").alias("p")).select("p.*")


def read_decisions(spark: SparkSession, path: str) -> DataFrame:
    """Decisions; two of one packet are an error."""
    rows = spark.read.option("multiLine", True).schema(schemas.struct(schemas.DECISIONS)).json(path).select(F.explode("decisions").alias("d")).select("d.*")
    if rows.groupBy("packet_id").count().where("count > 1").limit(1).collect():
        raise InputError("a packet is decided twice")
    return rows


def read_parsed_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Parsed documents of a folder, whatever its depth, one JSON file each."""
    return spark.read.option("multiLine", True).option("recursiveFileLookup", True).schema(schemas.struct(schemas.PARSED_DOCUMENT)).json(folder)


def read_bodies(spark: SparkSession, folder: str, metadata: DataFrame, key: str = "path", digest: str = "sha256") -> DataFrame:
    """Stored bodies that have the digest their metadata gives."""
    bodies = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select(F.regexp_extract("path", r"([^/]+)$", 1).alias(key), "content")
    return bodies.join(metadata, key).where(F.sha2("content", 256) == F.col(digest))


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)


def write_records(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """JSON lines; Spark's committer makes all files visible at once. Existing output is refused unless told otherwise."""
    df.write.mode("overwrite" if overwrite else "errorifexists").json(path)


def write_by(df: DataFrame, path: str, key: str = "fund_id") -> None:
    df.write.mode("overwrite").partitionBy(key).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV in which a text of several lines stays one cell."""
    df.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def read_csv(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema(schemas.struct(ddl)).csv(path)


def json_schema(df: DataFrame) -> str:
    return df.schema.json()


def documents_format(content: str, content_type: str, url: str):
    """What a body is, by its first bytes, its declared type, then its address."""
    head, kind, name = F.col(content), F.lower(F.coalesce(F.col(content_type), F.lit(""))), F.lower(F.regexp_replace(url, r"[?#].*$", ""))
    first = F.decode(F.substring(head, 1, 512), "iso-8859-1")
    return (
        F.when(F.startswith(first, F.lit("%PDF-")), "pdf").when(first.rlike(r"(?is)^\s*(<!doctype html|<html)"), "html").when(first.rlike(r"(?s)^\s*<\?xml"), F.when(first.rlike("(?i)<html"), "xhtml").otherwise("xml"))
        .when(F.contains(kind, F.lit("pdf")), "pdf").when(F.contains(kind, F.lit("html")), "html").when(F.contains(kind, F.lit("xml")), "xml").when(F.startswith(kind, F.lit("text/")), "text")
        .when(name.rlike(r"\.pdf$"), "pdf").when(name.rlike(r"\.html?$"), "html").when(name.rlike(r"\.(txt|md)$"), "text").otherwise("unknown")
    )


def by_web(df: DataFrame, web: str, needles: list[str]) -> DataFrame:
    """Rows whose address holds one of the needles, whatever the case; all rows without needles."""
    return df if not needles else df.where(F.exists(F.array(*[F.lit(n.lower()) for n in needles]), lambda n: F.contains(F.lower(web), n)))


def selected(df: DataFrame, key: str, ids: list[str], offset: int, limit: int) -> DataFrame:
    """The rows of some ids, which alone count if given; else those from offset on, at most limit (0: all)."""
    if ids:
        return df.where(F.col(key).isin(ids))
    rows = df.orderBy("ordinal").offset(offset)
    return rows.limit(limit) if limit else rows


