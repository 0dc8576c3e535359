"""Gutters and reading order against plain Python, and the measure of whole documents."""

from __future__ import annotations

import math
import random

import pytest

from tessera.operators import layout
from tessera.plans import documents

BLOCKS = "page int, n int, x0 double, x1 double, y0 double"


def brute_gutters(blocks, crossing, side):
    """Every stripe between two edges, tried on its own; touching ones joined."""
    xs = sorted({x for b in blocks for x in (b[2], b[3])})
    low = []
    for a, b in zip(xs, xs[1:]):
        across = sum(k[2] <= a and k[3] >= b for k in blocks)
        low.append((a, b, across <= math.floor(crossing * len(blocks))))
    out, k = [], 0
    while k < len(low):
        if low[k][2]:
            m = k
            while m + 1 < len(low) and low[m + 1][2]:
                m += 1
            s, e = low[k][0], low[m][1]
            left, right = sum(b[3] <= s for b in blocks), sum(b[2] >= e for b in blocks)
            if left >= side and right >= side:
                out.append((s, e, left, right))
            k = m
        k += 1
    return out


def page_of(r, k):
    columns, out = r.randint(1, 3), []
    for n in range(r.randint(0, 40)):
        if r.random() < 0.08:
            x0, x1 = 0.0, 600.0
        else:
            x0 = r.randint(0, columns - 1) * 200 + r.randint(0, 15)
            x1 = x0 + r.randint(1, 170)
        out.append((k, n, float(x0), float(x1), float(r.randint(0, 30) * 20)))
    return out


def brute_order(blocks, found):
    across = {b[1]: any(b[2] < s and b[3] > e for s, e, _, _ in found) for b in blocks}
    column = {b[1]: None if across[b[1]] else sum((s + e) / 2 <= (b[2] + b[3]) / 2 for s, e, _, _ in found) for b in blocks}
    order, above = [], 0
    for b in sorted(blocks, key=lambda b: (b[4], not across[b[1]], b[2], b[1])):
        above += across[b[1]]
        order.append(((2 * above - 1 if across[b[1]] else 2 * above), column[b[1]] or 0, b[4], b[2], b[1]))
    return {n: (column[n], k) for k, (*_, n) in enumerate(sorted(order), 1)}


@pytest.mark.parametrize("crossing, side", [(0.1, 4), (0.0, 1), (0.3, 2)])
def test_gutters_and_order(spark, crossing, side):
    r = random.Random(int(crossing * 10) + side)
    pages = [page_of(r, k) for k in range(60)]
    df = spark.createDataFrame([b for p in pages for b in p] + [(900, 0, None, 5.0, 1.0)], BLOCKS)
    got = {}
    for x in layout.gutters(df, ["page"], crossing, side).collect():
        got.setdefault(x.page, []).append((x.start, x.end, x.left, x.right))
    want = {k: brute_gutters(p, crossing, side) for k, p in enumerate(pages)}
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in want.items() if v}
    read = {(x.page, x.n): (x.column, x.position) for x in layout.reading_order(df.where("page < 900"), ["page"], "n", crossing, side).collect()}
    assert read == {(k, n): v for k, p in enumerate(pages) for n, v in brute_order(p, want[k]).items()}


PAGE = "array<struct<page_number:int,text:string,blocks:array<struct<order:int,x0:double,y0:double,x1:double,y1:double,text:string>>,tables:array<struct<rows:array<array<string>>>>>>"


def test_measure_of_documents(spark):
    block = lambda k, x0, x1: (k, float(x0), 0.0, float(x1), 1.0, "b")
    two = [block(k, 0, 200) for k in range(4)] + [block(k, 300, 500) for k in range(4, 8)]
    table = ([["Vstupní poplatek:", "3 % z částky"], ["Rok 2023", "5,1 %"], ["", "1"], ["Jen popisek", ""]],)
    rows = [
        (1, "pdf", "pymupdf", "factsheet", [(1, "Věta. pokračuje. Nová.", two, [table]), (2, "x" * 10, two[:7], [])]),
        (2, "pdf", "ocr", "priips_kid", [(1, "y" * 2500, [], [])]), (3, "html", "bs4", "statute", [(None, "z", [], [])]), (4, "pdf", "blocks", None, None),
    ]
    df = spark.createDataFrame(rows, f"source_id int, document_format string, parser_name string, document_type string, pages {PAGE}")
    got = {x.source_id: x for x in documents.measured(df).collect()}
    one = got[1]
    assert (one.page_count, one.pages_with_numbers, one.table_count, one.labelled_rows, one.fee_rows, one.year_rows, one.multi_column_pages) == (2, 2, 1, 2, 1, 1, 1)
    assert one.triggers == ["broken_reading_order", "multi_column_layout"] and one.blocked_by == "fee_rows"
    assert got[2].triggers == ["text_without_tables"] and got[2].blocked_by == "document_type"
    assert got[3].triggers == [] and got[4].triggers == [] and got[4].page_count == 0
