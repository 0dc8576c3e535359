"""Tables of text cells (array<array<string>>)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fold
from ..functions.values import first_date, whole_cell_number


def cells(df: DataFrame, keys: list[str], rows: str) -> DataFrame:
    """(keys, row, col, cell) of every cell."""
    a = df.select(*keys, F.posexplode(rows).alias("row", "cells"))
    return a.select(*keys, "row", F.posexplode("cells").alias("col", "cell"))


def column_periods(df: DataFrame, keys: list[str], rows: str, head: int = 3) -> DataFrame:
    """(keys, col, date, year): the first date or year that a column's first `head` rows hold."""
    c = cells(df, keys, rows).where(F.col("row") < head)
    date = first_date(fold("cell"))
    year = F.regexp_extract("cell", r"^\s*((?:19|20)\d{2})\s*$", 1).try_cast("int")
    got = c.select(*keys, "row", "col", date.alias("date"), year.alias("year")).where("date is not null or year is not null")
    first = lambda x: F.min_by(x, F.when(F.col(x).isNotNull(), F.col("row")))
    return got.groupBy(*keys, "col").agg(first("date").alias("date"), first("year").alias("year"))


def row_label(cells: Column) -> Column:
    """The first cell of at most 120 letters that is text, not a number, date or year."""
    good = F.filter(cells, lambda c: (F.length(F.trim(c)) > 0) & (F.length(c) <= 120) & c.rlike(r"\p{L}") & whole_cell_number(c).isNull() & ~c.rlike(r"^\s*\d{1,2}\.\s?\d{1,2}\.\s?\d{4}\s*$"))
    return F.get(good, 0)


def labelled_rows(df: DataFrame, keys: list[str], rows: str) -> DataFrame:
    """(keys, row, label, rest): rows with a label, and their other filled cells."""
    a = df.select(*keys, F.posexplode(rows).alias("row", "cells")).withColumn("label", row_label(F.col("cells")))
    rest = F.filter("cells", lambda c: (c != F.col("label")) & (F.trim(c) != ""))
    return a.where("label is not null").select(*keys, "row", "label", rest.alias("rest"))


def table_values(df: DataFrame, keys: list[str], rows: str) -> DataFrame:
    """(keys, row, label, col, date, year, value, unit): numbers of labelled rows, with their columns' periods."""
    labels = df.select(*keys, F.posexplode(rows).alias("row", "cells")).select(*keys, "row", row_label(F.col("cells")).alias("label"), F.posexplode("cells").alias("col", "cell"))
    got = labels.where("label is not null").withColumn("n", whole_cell_number("cell")).where("n is not null")
    return got.join(column_periods(df, keys, rows), [*keys, "col"], "left").select(*keys, "row", "label", "col", "date", "year", F.col("n.value").alias("value"), F.col("n.unit").alias("unit"))


def shape(rows: Column) -> Column:
    """struct(rows, cols, filled) of a table."""
    width = F.coalesce(F.array_max(F.transform(rows, lambda r: F.size(r))), F.lit(0))
    filled = F.aggregate(rows, F.lit(0), lambda a, r: a + F.size(F.filter(r, lambda c: F.trim(c) != "")))
    return F.struct(F.size(rows).alias("rows"), width.alias("cols"), filled.alias("filled"))


def table_score(rows: Column, words: list[str]) -> Column:
    """Points of a table: 4 for each word it holds, 2 for a number, 10 less where it reads as prose."""
    flat = fold(F.array_join(F.transform(rows, lambda r: F.array_join(r, " ")), " "))
    points = sum((F.when(F.contains(flat, F.lit(w)), 4).otherwise(0) for w in words), F.lit(0))
    prose = F.exists(rows, lambda r: F.exists(r, lambda c: F.size(F.split(c, " ")) > 30))
    return points + F.when(flat.rlike(r"\d"), 2).otherwise(0) - F.when(prose, 10).otherwise(0)


def repeated_headers(df: DataFrame, doc: str, text: str, first_lines: int = 3) -> DataFrame:
    """(doc, line, n, first_at): lines that stand more than once among the first lines of a document's pages."""
    pages = df.select(doc, F.posexplode(F.split(text, "\n\n")).alias("page", "body"))
    lines = pages.select(doc, "page", F.posexplode(F.split("body", "\n")).alias("at", "line")).where((F.col("at") < first_lines) & (F.trim("line") != ""))
    return lines.groupBy(doc, "line").agg(F.count("*").alias("n"), F.min(F.struct("page", "at")).alias("first_at")).where("n > 1").select(doc, "line", "n", F.col("first_at.page").alias("first_page"))


def multi_column_pages(blocks: DataFrame, page: list[str], least: int = 8, side: int = 4) -> DataFrame:
    """Pages of at least `least` blocks with `side` of them wholly on each side of their middle."""
    w = Window.partitionBy(*page)
    mid = (F.min("x0").over(w) + F.max("x1").over(w)) / 2
    got = blocks.withColumn("mid", mid).groupBy(*page).agg(F.count("*").alias("n"), F.count_if(F.col("x1") <= F.col("mid")).alias("left"), F.count_if(F.col("x0") >= F.col("mid")).alias("right"))
    return got.where((F.col("n") >= least) & (F.col("left") >= side) & (F.col("right") >= side)).select(*page)
