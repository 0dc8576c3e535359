"""What a parsed document holds, measured from its pages, blocks and tables, and whether a second reading is worth it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.evidence import blocking_reason, layout_triggers
from ..functions.labels import FEE_ROW_WORDS
from ..functions.text import broken_ratio, fold, has_any, once
from ..functions.values import leading_percentage
from ..operators.grids import row_label

#: Blocks that a page in columns has, and on each side of its middle.
BLOCKS, BLOCKS_A_SIDE = 8, 4
YEAR = r"(?<!\d)(?:19|20)\d{2}(?!\d)"


def in_columns(blocks: Column) -> Column:
    """Whether a page's blocks stand on both sides of its middle."""

    def judged(b: Column) -> Column:
        left, right = F.array_min(F.transform(b, lambda k: k["x0"])), F.array_max(F.transform(b, lambda k: k["x1"]))
        sides = lambda mid: (F.size(F.filter(b, lambda k: k["x1"] < mid)) >= BLOCKS_A_SIDE) & (F.size(F.filter(b, lambda k: k["x0"] > mid)) >= BLOCKS_A_SIDE)
        return (F.size(b) >= BLOCKS) & (right > left) & once((left + right) / 2, sides)

    return F.coalesce(once(blocks, judged), F.lit(False))


def row_kinds(rows: Column) -> Column:
    """array of struct(fee, year) of a table's rows that have a label and other filled cells."""

    def kind(row: Column) -> Column:
        def told(label: Column) -> Column:
            rest = F.filter(row, lambda c: (c != label) & (F.trim(c) != ""))
            fee = F.exists(rest, lambda c: leading_percentage(c).isNotNull()) & has_any(fold(label), FEE_ROW_WORDS)
            return F.when(label.isNotNull() & (F.size(rest) > 0), F.struct(fee.alias("fee"), F.array_join(row, " ").rlike(YEAR).alias("year")))

        return once(row_label(row), told)

    return F.filter(F.transform(rows, kind), lambda k: k.isNotNull())


def measured(parsed: DataFrame) -> DataFrame:
    """(source_id, character_count, broken_ratio, page_count, pages_with_numbers, table_count, labelled_rows, fee_rows, year_rows, multi_column_pages, triggers, blocked_by).

    parsed: source_id, document_format, parser_name, document_type, pages (page_number, text, blocks, tables). All of a
    document is in its row, so nothing is shuffled. Documents without pages measure as empty; null blocks and tables are none.
    """
    pages = F.coalesce("pages", F.filter(F.col("pages"), lambda p: F.lit(False)), F.array().cast(parsed.schema["pages"].dataType))
    some = lambda a, kind: F.coalesce(a, F.array().cast(kind))
    tables = F.flatten(F.transform(pages, lambda p: some(p["tables"], "array<struct<rows:array<array<string>>>>")))
    facts = parsed.select("source_id", "document_format", "parser_name", "document_type", pages.alias("p"), tables.alias("t"))
    facts = facts.withColumn("text", F.array_join(F.transform("p", lambda p: F.coalesce(p["text"], F.lit(""))), "\n"))
    facts = facts.withColumn("rows", F.flatten(F.transform("t", lambda t: row_kinds(some(t["rows"], "array<array<string>>")))))
    facts = facts.withColumn("multi_column_pages", F.size(F.filter("p", lambda p: in_columns(p["blocks"]))))
    count = lambda c: F.size(F.filter("rows", lambda r: r[c]))
    out = facts.select(
        "source_id", "document_format", "parser_name", "document_type", F.length("text").alias("character_count"), broken_ratio("text").alias("broken_ratio"), F.size("p").alias("page_count"),
        F.size(F.filter("p", lambda p: p["page_number"].isNotNull())).alias("pages_with_numbers"), F.size("t").alias("table_count"), F.size("rows").alias("labelled_rows"), count("fee").alias("fee_rows"),
        count("year").alias("year_rows"), "multi_column_pages",
    )
    share = F.coalesce(F.try_divide("multi_column_pages", "page_count"), F.lit(0.0))
    triggers = layout_triggers(F.col("document_format"), F.col("page_count"), F.col("parser_name"), F.col("broken_ratio"), F.col("character_count"), F.col("labelled_rows"), share)
    blocked = blocking_reason(F.col("document_type"), F.col("fee_rows"), F.col("year_rows"))
    return out.withColumns({"triggers": triggers, "blocked_by": blocked}).drop("document_format", "parser_name", "document_type")
