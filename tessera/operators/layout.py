"""Layout of pages from the places of their blocks: gutters and columns by a sweep, and the order in which blocks are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Share of a page's blocks that may run across a gutter, and blocks that must stand wholly on either side.
CROSSING, SIDE = 0.1, 4


def gutters(blocks: DataFrame, page: list[str], crossing: float = CROSSING, side: int = SIDE) -> DataFrame:
    """(page, start, end, left, right): vertical stripes that hardly any block crosses, with how many blocks are wholly left and right.

    blocks: page, x0, x1. A sweep over each page's left and right edges: how many blocks have begun and ended so
    far says how many cross a place, how many are wholly left of it and how many are still to come. Stripes that touch are
    one. Blocks without a place are left out; one shuffle, by page.
    """
    edges = blocks.where("x0 is not null and x1 is not null and x0 <= x1").repartition(*page)
    ends = F.explode(F.array(F.struct(F.col("x0").alias("x"), F.lit(1).alias("begun"), F.lit(0).alias("ended")), F.struct(F.col("x1").alias("x"), F.lit(0).alias("begun"), F.lit(1).alias("ended"))))
    events = edges.select(*page, ends.alias("e")).select(*page, "e.*").groupBy(*page, "x").agg(F.sum("begun").alias("begun"), F.sum("ended").alias("ended"))
    along = Window.partitionBy(*page).orderBy("x")
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    swept = events.select(*page, "x", F.sum("begun").over(upto).alias("begun"), F.sum("ended").over(upto).alias("ended"), F.lead("x").over(along).alias("next"), F.sum("begun").over(Window.partitionBy(*page)).alias("n"))
    low = F.col("next").isNotNull() & (F.col("begun") - F.col("ended") <= F.floor(crossing * F.col("n")))
    marked = swept.withColumn("low", low).withColumn("first", F.col("low") & ~F.coalesce(F.lag("low").over(along), F.lit(False)))
    stripes = marked.withColumn("stripe", F.sum(F.col("first").cast("int")).over(upto)).where("low")
    found = stripes.groupBy(*page, "stripe").agg(F.min("x").alias("start"), F.max("next").alias("end"), F.min("ended").alias("left"), (F.max("n") - F.max("begun")).alias("right"))
    return found.where((F.col("left") >= side) & (F.col("right") >= side)).select(*page, "start", "end", "left", "right")


def reading_order(blocks: DataFrame, page: list[str], order: str, crossing: float = CROSSING, side: int = SIDE) -> DataFrame:
    """blocks with column (0 from the left; null for blocks across a gutter) and position (from 1) in which they are read.

    Blocks across a gutter, as titles are, part a page into bands from top to bottom; in a band columns are read one
    after the other, each from top to bottom. Pages without gutters have one column.
    """
    found = gutters(blocks, page, crossing, side).groupBy(*page).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("__g"))  # a few a page
    rows = blocks.join(found, page, "left").withColumn("__g", F.coalesce("__g", F.array().cast("array<struct<start:double,end:double>>")))
    middle = (F.col("x0") + F.col("x1")) / 2
    rows = rows.withColumn("__across", F.exists("__g", lambda g: (F.col("x0") < g["start"]) & (F.col("x1") > g["end"])))
    rows = rows.withColumn("column", F.when(~F.col("__across"), F.size(F.filter("__g", lambda g: (g["start"] + g["end"]) / 2 <= middle))))
    down = Window.partitionBy(*page).orderBy("y0", F.desc("__across"), "x0", order).rowsBetween(Window.unboundedPreceding, 0)
    above = F.sum(F.col("__across").cast("int")).over(down)
    rows = rows.withColumn("__band", F.when(F.col("__across"), 2 * above - 1).otherwise(2 * above))
    read = Window.partitionBy(*page).orderBy("__band", F.coalesce("column", F.lit(0)), "y0", "x0", order)
    return rows.withColumn("position", F.row_number().over(read)).drop("__g", "__across", "__band")
