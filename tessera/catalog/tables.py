"""Tables of text cells: grids are literals joined to nation, as the given tables hold none."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import grids, layout
from ..queries import query, table


def grid(spark, d):
    n = F.col("n_nationkey")
    row = lambda *xs: F.array(*[x if not isinstance(x, str) else F.lit(x) for x in xs])
    number = lambda k: F.concat((n + k).cast("string"), F.lit(" 138 763"))
    rows = F.array(
        row("", "k datu", "", "31.12.2024", "", "31.12.2023"),
        row("", "Fondový kapitál Podfondu (Kč)", "", number(4), "", number(1)),
        row("", "Fondový kapitál na 1 akcii (Kč)", "", "1,1446", "", "1,0549"),
    )
    return table(spark, d, "nation").select("n_nationkey", rows.alias("rows"))


@query("column_periods", "SELECT n_nationkey, c AS col, dt AS date FROM nation, (VALUES (3, DATE '2024-12-31'), (5, DATE '2023-12-31')) v(c, dt)")
def column_periods(spark, d):
    return grids.column_periods(grid(spark, d), ["n_nationkey"], "rows").select("n_nationkey", "col", "date")


@query("grid_unpivot", "SELECT n_nationkey, r AS row, c AS col, CASE WHEN c = 3 THEN DATE '2024-12-31' ELSE DATE '2023-12-31' END AS date, CASE WHEN r = 1 THEN (n_nationkey + CASE WHEN c = 3 THEN 4 ELSE 1 END) * 1000000 + 138763 WHEN c = 3 THEN 1.1446 ELSE 1.0549 END::DOUBLE AS value FROM nation, (VALUES (1, 3), (1, 5), (2, 3), (2, 5)) v(r, c)")
def grid_unpivot(spark, d):
    return grids.table_values(grid(spark, d), ["n_nationkey"], "rows").select("n_nationkey", "row", "col", "date", "value")


@query("labelled_rows", "SELECT n_nationkey, r AS row, l AS label, 2::BIGINT AS cells FROM nation, (VALUES (0, 'k datu'), (1, 'Fondový kapitál Podfondu (Kč)'), (2, 'Fondový kapitál na 1 akcii (Kč)')) v(r, l)")
def labelled_rows(spark, d):
    return grids.labelled_rows(grid(spark, d), ["n_nationkey"], "rows").select("n_nationkey", "row", "label", F.size("rest").cast("long").alias("cells"))


@query("table_shapes", "SELECT n_nationkey, 3::BIGINT AS height, 6::BIGINT AS width, 9::BIGINT AS filled, 6::BIGINT AS score FROM nation")
def table_shapes(spark, d):
    s = grids.shape(F.col("rows"))
    return grid(spark, d).select("n_nationkey", s["rows"].cast("long").alias("height"), s["cols"].cast("long").alias("width"), s["filled"].cast("long").alias("filled"), grids.table_score(F.col("rows"), ["fondovy kapital", "vynos"]).cast("long").alias("score"))


@query("best_table", "SELECT p_brand, arg_max(p_partkey, (p_size, -p_partkey)) AS p_partkey FROM part GROUP BY p_brand")
def best_table(spark, d):
    from ..operators import rank

    p = table(spark, d, "part")
    return rank.best(p, ["p_brand"], F.struct("p_size", -F.col("p_partkey")), ["p_partkey"])


@query("repeated_headers", "WITH l AS (SELECT conv_id, turn AS page, unnest(string_split(text, ' ')) w, unnest(range(len(string_split(text, ' ')))) i FROM conversations) SELECT conv_id, w AS line, count(*) AS n, min(page) AS first_page FROM l WHERE i < 3 AND trim(w) <> '' GROUP BY conv_id, w HAVING count(*) > 1")
def repeated_headers(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", F.replace(F.regexp_replace("text", "\n", "\u0001"), F.lit(" "), F.lit("\n")).alias("t"))
    docs = c.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "t"))), lambda x: x["t"]), "\n\n").alias("t"))
    got = grids.repeated_headers(docs.withColumn("t", F.regexp_replace("t", "\n{3,}", "\n\n")), "conv_id", "t", 3)
    return got.select("conv_id", F.regexp_replace("line", "\u0001", "\n").alias("line"), "n", F.col("first_page").cast("long").alias("first_page"))


@query("multi_column_pages", "SELECT page FROM (SELECT page, count(*) n, sum((x1 <= mid)::INT) l, sum((x0 >= mid)::INT) r FROM (SELECT *, (min(x0) OVER (PARTITION BY page) + max(x1) OVER (PARTITION BY page)) / 2 AS mid FROM (SELECT l_suppkey AS page, l_quantity AS x0, l_quantity + 10 AS x1 FROM lineitem)) GROUP BY page) WHERE n >= 8 AND l >= 4 AND r >= 4")
def multi_column_pages(spark, d):
    b = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("page"), F.col("l_quantity").alias("x0"), (F.col("l_quantity") + 10).alias("x1"))
    return grids.multi_column_pages(b, ["page"])


PLACED = """b AS (SELECT l_partkey AS page, l_orderkey * 10 + l_linenumber AS n, CASE WHEN l_quantity = 50 THEN 0 ELSE l_linenumber % 2 * 300 + l_quantity END::DOUBLE AS x0, CASE WHEN l_quantity = 50 THEN 600 ELSE l_linenumber % 2 * 300 + l_quantity + 100 + l_discount * 1000 END::DOUBLE AS x1, l_orderkey::DOUBLE AS y0 FROM lineitem),
e AS (SELECT page, x, sum(begun) AS begun, sum(ended) AS ended FROM (SELECT page, x0 AS x, 1 AS begun, 0 AS ended FROM b UNION ALL SELECT page, x1, 0, 1 FROM b) GROUP BY page, x),
s AS (SELECT page, x, sum(begun) OVER w AS begun, sum(ended) OVER w AS ended, lead(x) OVER (PARTITION BY page ORDER BY x) AS next, sum(begun) OVER (PARTITION BY page) AS n FROM e WINDOW w AS (PARTITION BY page ORDER BY x)),
l AS (SELECT *, next IS NOT NULL AND begun - ended <= floor(0.1 * n) AS low FROM s),
m AS (SELECT *, sum((NOT low)::INT) OVER (PARTITION BY page ORDER BY x) AS stripe FROM l),
g AS (SELECT page, min(x) AS start, max(next) AS "end", min(ended) AS "left", max(n) - max(begun) AS "right" FROM m WHERE low GROUP BY page, stripe HAVING min(ended) >= 4 AND max(n) - max(begun) >= 4)"""


def placed_blocks(spark, d):
    """Line items as blocks of two columns on their part's page, some across both."""
    wide, low = F.col("l_quantity") == 50, F.col("l_linenumber") % 2 * 300 + F.col("l_quantity")
    li = table(spark, d, "lineitem")
    return li.select(F.col("l_partkey").alias("page"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("n"), F.when(wide, 0.0).otherwise(low.cast("double")).alias("x0"), F.when(wide, 600.0).otherwise(low + 100 + F.col("l_discount") * 1000).alias("x1"), F.col("l_orderkey").cast("double").alias("y0"))


@query("page_gutters", f'WITH {PLACED} SELECT page, start, "end", "left"::BIGINT AS "left", "right"::BIGINT AS "right" FROM g')
def page_gutters(spark, d):
    return layout.gutters(placed_blocks(spark, d), ["page"])


@query("page_columns", f"""WITH {PLACED}, a AS (SELECT page, list(struct_pack(s := start, e := "end")) AS g FROM g GROUP BY page),
c AS (SELECT b.page, x0, x1, coalesce(len(list_filter(g, lambda k: x0 < k.s AND x1 > k.e)), 0) AS across, coalesce(len(list_filter(g, lambda k: (k.s + k.e) / 2 <= (x0 + x1) / 2)), 0) AS col FROM b LEFT JOIN a USING (page))
SELECT page, count(*) FILTER (WHERE across > 0) AS across, count(*) FILTER (WHERE across = 0 AND col = 0) AS first_column, count(*) FILTER (WHERE across = 0 AND col > 0) AS other_columns FROM c GROUP BY page""")
def page_columns(spark, d):
    read = layout.reading_order(placed_blocks(spark, d), ["page"], "n")
    return read.groupBy("page").agg(F.count_if(F.col("column").isNull()).alias("across"), F.count_if(F.col("column") == 0).alias("first_column"), F.count_if(F.col("column") > 0).alias("other_columns"))
