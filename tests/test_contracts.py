"""Contracts against a plain validator of JSON Schema; dense ids; rates of clauses against a loop."""

from __future__ import annotations

import datetime
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.operators import lines, state
from tessera.sources import contracts


def valid(x, schema) -> bool:
    """The part of JSON Schema that the compiler writes."""
    kinds = schema.get("type")
    if kinds is not None:
        of = {"string": str, "number": (int, float), "integer": int, "boolean": bool, "array": list, "object": dict, "null": type(None)}
        if not any(isinstance(x, of[k]) and not (k in ("number", "integer") and isinstance(x, bool)) for k in ([kinds] if isinstance(kinds, str) else kinds)):
            return False
    if "enum" in schema and x not in schema["enum"] or "not" in schema and valid(x, schema["not"]):
        return False
    if isinstance(x, str) and ("pattern" in schema and not re.search(schema["pattern"], x) or len(x) > schema.get("maxLength", len(x))):
        return False
    if isinstance(x, (int, float)) and not isinstance(x, bool) and not schema.get("minimum", x) <= x <= schema.get("maximum", x):
        return False
    if isinstance(x, list) and (len(x) < schema.get("minItems", 0) or not all(valid(i, schema.get("items", {})) for i in x)):
        return False
    if isinstance(x, dict):
        if any(k not in x for k in schema.get("required", [])) or not all(valid(x[k], s) for k, s in schema.get("properties", {}).items() if k in x):
            return False
        if schema.get("additionalProperties", True) is False and set(x) - set(schema["properties"]):
            return False
    if not all(valid(x, s) for s in schema.get("allOf", [])):
        return False
    return not ("if" in schema and valid(x, schema["if"])) or valid(x, schema["then"])


def made(node, r, wrong: float):
    """A value of a description; with chance `wrong` each part is null or outside its bounds."""
    if r.random() < wrong:
        return None
    bad = r.random() < wrong
    if isinstance(node, contracts.Text):
        if node.options:
            return "nothing" if bad else r.choice(node.options)
        return "?" * ((node.most or 5) + 1) if bad else {"^[A-Z]{3}$": "CZK", "^fund_[0-9a-f]{16}$": "fund_" + "0a" * 8, r"^https?://": "https://a.cz"}.get(node.pattern, "x")
    if isinstance(node, contracts.Number):
        value = (node.high or 0) + 1e3 if bad and node.high is not None else (node.low or 0) - 5 if bad else r.randint(int(node.low or 0), int(node.high or 50))
        return int(value) if node.whole else float(value)
    if isinstance(node, contracts.Day):
        return datetime.date(2024, 1, r.randint(1, 28))
    if isinstance(node, contracts.Flag):
        return r.random() < 0.5
    if isinstance(node, contracts.ListOf):
        items = [x for x in (made(node.item, r, wrong) for _ in range(r.randint(0 if bad else node.least, 3))) if x is not None]
        return items if not node.distinct else list({tuple(x[c] for c in node.distinct): x for x in items}.values())
    return {k: made(v, r, wrong) for k, v in node.parts.items()}


def tidy(x, node):
    """As JSON: days as text."""
    if isinstance(x, datetime.date):
        return x.isoformat()
    if isinstance(x, list):
        return [tidy(i, node) for i in x]
    return {k: tidy(v, node) for k, v in x.items()} if isinstance(x, dict) else x


def test_schema_and_column_refuse_the_same_records(spark):
    node, r = contracts.FUND_RECORD, random.Random(9)
    records = [made(node, r, wrong) for wrong in (0.0, 0.01, 0.05, 0.3) for _ in range(150)]
    records = [x for x in records if x is not None]
    good = {"status": "found", "raw_value": "x", "source": {"url": "https://a.cz", "quote": None, "page": 1}, "extraction": {"method": "m", "confidence": "low", "review_required": False}, "reason": None}
    history = {"observations": [{"amount": 1.0, "currency": "CZK", "as_of": datetime.date(2024, 1, 1)}]}
    whole = {"fund_id": "fund_" + "0" * 16, "name": "Alfa", "investment_horizon": good | {"value": {"recommended_years": 5.0, "kind": "exact"}}, "minimum_investment": good | {"value": {"amount": 1.0, "currency": "CZK"}}, "aum_history": good | {"value": history}}
    pending = {**whole, "investment_horizon": {"status": "pending", "value": None, "raw_value": None, "source": None, "extraction": None, "reason": None}}
    records += [whole, pending, {**whole, "investment_horizon": {**pending["investment_horizon"], "status": "not_found"}}]
    schema = contracts.json_schema(node, False)
    df = spark.createDataFrame([(k, x) for k, x in enumerate(records)], contracts.T.StructType().add("k", "long").add("x", contracts.spark_type(node)))
    got = {row.k: row.v for row in df.select("k", contracts.checked(F.col("x"), node).alias("v")).collect()}
    want = {k: valid(tidy(x, node), schema) for k, x in enumerate(records)}
    assert {k: not v for k, v in got.items()} == want
    assert want[len(records) - 3] and want[len(records) - 2] and not want[len(records) - 1] and 20 < sum(not v for v in want.values())


def test_violations_say_where(spark):
    record = {"observations": [{"amount": 1.0, "currency": "CZK", "as_of": datetime.date(2024, 1, 1)}, {"amount": None, "currency": "czk", "as_of": datetime.date(2024, 1, 2)}, {"amount": 3.0, "currency": "CZK", "as_of": datetime.date(2024, 1, 1)}]}
    df = spark.createDataFrame([(record,), (None,)], contracts.T.StructType().add("x", contracts.spark_type(contracts.HISTORY)))
    got = [sorted(r.v) for r in df.select(contracts.checked(F.col("x"), contracts.HISTORY).alias("v")).collect()]
    assert got == [sorted(["$.observations: repeated", "$.observations[1].amount: missing", "$.observations[1].currency: not as its pattern"]), ["$: missing"]]


def test_schema_file(tmp_path):
    contracts.write_json_schema(contracts.FUND_RECORD, str(tmp_path / "s.json"), "fund")
    written = json.loads((tmp_path / "s.json").read_text())
    assert written["title"] == "fund" and written["properties"]["name"] == {"type": "string", "maxLength": 300} and written["additionalProperties"] is False


def test_ids_are_dense_and_stable(spark):
    r = random.Random(2)
    rows = [(k, r.randint(0, 50)) for k in range(500)]
    df = spark.createDataFrame(rows, "e long, t int").repartition(7)
    got = {x.e: x.id for x in state.numbered(df, ["t", "e"]).collect()}
    assert got == {e: k for k, (e, t) in enumerate(sorted(rows, key=lambda x: (x[1], x[0])), 1)}
    assert got == {x.e: x.id for x in state.numbered(df.repartition(3), ["t", "e"]).collect()}
    assert state.numbered(df.limit(0), ["t", "e"]).collect() == []


def test_appending_again_changes_nothing(spark):
    none = spark.createDataFrame([], "e long, t int, id long")
    first = spark.createDataFrame([(5, 1), (None, 2), (5, 0)], "e long, t int")
    log = none.unionByName(state.appended(none, first, ["e"], ["t"]))
    assert sorted((x.e or -1, x.t, x.id) for x in log.collect()) == [(-1, 2, 2), (5, 0, 1)]
    more = state.appended(log, first.union(spark.createDataFrame([(9, 0)], "e long, t int")), ["e"], ["t"])
    assert [(x.e, x.id) for x in more.collect()] == [(9, 3)]
    assert state.appended(log, first, ["e"], ["t"]).collect() == []


def test_each_period_takes_a_rate(spark):
    r = random.Random(7)
    rows = []
    for k in range(300):
        places = r.sample(range(60), r.randint(0, 9))
        cut = r.randint(0, len(places))
        rows.append((k, sorted(places[:cut]), sorted(places[cut:])))
    df = spark.createDataFrame(rows, "k int, p array<int>, r array<int>")
    of = lambda c: F.transform(c, lambda x: F.struct(x.alias("at")))
    got = {x.k: [(y.period.at, y.rate.at) for y in x.v] for x in df.select("k", lines.greedy_pairs(of("p"), of("r")).alias("v")).collect()}
    for k, periods, rates in rows:
        left, want = list(rates), []
        for p in periods:
            after, before = [x for x in left if x >= p], [x for x in left if x < p]
            pick = after[0] if after else before[-1] if before else None
            if pick is not None:
                left.remove(pick)
                want.append((p, pick))
        assert got[k] == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("vystupni poplatek 0 % po 3 letech, 5 % do 3 let", [(0, 36, 5.0), (36, None, 0.0)]),
        ("do 1 roku 10 %, od 1 do 2 let 5,5 %, po 2 letech 0 %", [(0, 12, 10.0), (12, 24, 5.5), (24, None, 0.0)]),
        ("do 6 mesicu 2 % a po 6 mesicich 0 %", [(0, 6, 2.0), (6, None, 0.0)]), ("bez poplatku", []), ("", []),
    ],
)
def test_tiers_of_clauses(spark, text, want):
    row = spark.createDataFrame([(text,)], "x string").select(lines.clause_tiers(F.col("x")).alias("v")).first()
    assert [tuple(t) for t in row.v] == want
