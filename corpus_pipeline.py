"""A corpus pipeline over documents: each stage's result is written as Parquet and read by the next.

Rejected documents, repeated lines and near-duplicate documents go; the rest is mixed to weights by
source and encoded. Stages take (spark, docs, sf_dir) and work on all rows of docs; all but the last
return docs' own columns, whatever others there are. Null texts count as empty ones, null sources as a
source, null ids come after all others; an empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.cluster import ship
from tessera.llm import bpe, lines, mixing, quality, similar
from tessera.llm.common import documents, scratch, settled

#: Weights of the sources by code point, repeating.
WEIGHTS = [1, 2, 3]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; labelled or not, all are scored, equal texts alike."""
    ship(spark)
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document with the lines that no document of a smaller doc_id holds; n_chars follows. All rows stay."""
    ship(spark)
    kept = lines.without_repeats(docs)
    return kept.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast("long")) if "n_chars" in docs.columns else kept


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles of Jaccard similarity 0.8 and more.

    SimHash fingerprints of 256 bits, compared bit-sliced, then the exact similarity. The smallest
    doc_id stays; rows without one stay only where their whole group has none, one for each group.
    """
    ship(spark)
    return similar.dedup(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; equal rows are drawn one by one."""
    ship(spark)
    return mixing.mixed(docs, WEIGHTS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text; docs must have doc_id, lang, source and text."""
    ship(spark)
    vocabulary = bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    done = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), vocabulary)
    same = F.col("decoded").eqNullSafe(F.coalesce("text", F.lit("")))
    return done.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("quality_classifier", good),
    ("line_dedup", without_repeated_lines),
    ("simhash_near_dedup", one_of_each),
    ("source_mix", mix),
    ("bpe", encode),
]

#: SQL can't express the classifier, SimHash and BPE stages; tests/llm/test_contracts.py holds each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result over the documents of sf_dir, written; whatever came before it is dropped."""

    def last() -> DataFrame:
        docs = documents(spark, sf_dir)
        for name, stage in STAGES[:-1]:
            docs = settled(spark, f"stage-{name}", lambda: stage(spark, docs, sf_dir))
        return STAGES[-1][1](spark, docs, sf_dir)  # written once, as the pipeline's result

    return settled(spark, "pipeline", last)
