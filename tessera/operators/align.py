"""Passages of a second reading placed on the pages of the first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.evidence import anchors

LEAST_ANCHORS, LEAST_OVERLAP, LOOKBACK, PENALTY = 3, 0.34, 1, 0.005
PLACED = "doc_id long, chunk int, page int"


def _place(table):
    """Each passage on the page that shares most of its anchors, from the last placed page (less one) on."""
    import pyarrow as pa

    row = table.to_pylist()[0]
    pages = [set(p["anchors"]) for p in row["pages"]]
    numbers = [p["page"] for p in row["pages"]]
    placed: list[int | None] = []
    pointer = 0
    for chunk in row["chunks"]:
        own = set(chunk["anchors"])
        best, at = 0.0, None
        if len(own) >= LEAST_ANCHORS:
            for k in range(max(pointer - LOOKBACK, 0), len(pages)):
                overlap = len(own & pages[k]) / len(own)
                if overlap >= LEAST_OVERLAP and overlap - PENALTY * abs(k - pointer) > best:
                    best, at = overlap - PENALTY * abs(k - pointer), k
        if at is not None:
            pointer = at
        placed.append(None if at is None else numbers[at])
    for k, p in enumerate(placed):
        if p is None:
            before = next((x for x in reversed(placed[:k]) if x is not None), None)
            after = next((x for x in placed[k + 1 :] if x is not None), None)
            placed[k] = before if before == after else None
    return pa.table({"doc_id": pa.array([row["doc_id"]] * len(placed), pa.int64()), "chunk": pa.array(range(len(placed)), pa.int32()), "page": pa.array(placed, pa.int32())})


def place(pages: DataFrame, chunks: DataFrame) -> DataFrame:
    """(doc_id, chunk, page) of chunks(doc_id, chunk, text) against pages(doc_id, page, text); page null where none fits.

    The pointer runs on from passage to passage, so a document is one group; its anchors, not its texts, are gathered.
    """
    p = pages.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page", anchors("text").alias("anchors")))).alias("pages"))
    c = chunks.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("chunk", anchors("text").alias("anchors")))).alias("chunks"))
    both = c.join(p, "doc_id", "left").withColumn("pages", F.coalesce("pages", F.array().cast("array<struct<page:int,anchors:array<string>>>")))
    return both.groupBy("doc_id").applyInArrow(_place, PLACED)
