"""A record's contract, stated once: compiled to a JSON Schema, to a Spark type, and to a column of violations.

What the schema refuses, the column names, and the other way round: both come from the same description.
Numbers, texts, days, flags, lists and records have the constraints of their kind; anything but a
required part may be null. `when` states what must hold between parts of one record.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import once
from .schemas import DOMAINS


@dataclass(frozen=True)
class Text:
    pattern: str | None = None
    options: tuple[str, ...] = ()
    most: int | None = None


@dataclass(frozen=True)
class Number:
    low: float | None = None
    high: float | None = None
    whole: bool = False


@dataclass(frozen=True)
class Day:
    pass


@dataclass(frozen=True)
class Flag:
    pass


@dataclass(frozen=True)
class ListOf:
    item: object
    least: int = 0
    distinct: tuple[str, ...] = ()  # parts of the items that no two items share


@dataclass(frozen=True)
class Record:
    parts: dict[str, object]
    required: tuple[str, ...] = ()
    when: tuple[tuple[str, tuple[str, ...], tuple[str, ...], tuple[str, ...]], ...] = field(default=())  # (part, its values, parts it needs, parts it forbids)


ISO_DAY = r"^\d{4}-\d{2}-\d{2}$"


def json_schema(node: object, nullable: bool = True) -> dict:
    """The JSON Schema (draft 2020-12) of a description. Distinct parts of list items have no word there; it says so in `x-distinct`."""
    kinds = lambda k: [k, "null"] if nullable else k
    if isinstance(node, Text):
        out = {"type": kinds("string")}
        out |= {"pattern": node.pattern} if node.pattern else {}
        out |= {"maxLength": node.most} if node.most is not None else {}
        return out | ({"enum": [*node.options, None] if nullable else list(node.options)} if node.options else {})
    if isinstance(node, Number):
        out = {"type": kinds("integer" if node.whole else "number")}
        return out | ({"minimum": node.low} if node.low is not None else {}) | ({"maximum": node.high} if node.high is not None else {})
    if isinstance(node, Day):
        return {"type": kinds("string"), "format": "date", "pattern": ISO_DAY}
    if isinstance(node, Flag):
        return {"type": kinds("boolean")}
    if isinstance(node, ListOf):
        return {"type": kinds("array"), "items": json_schema(node.item, False), "minItems": node.least} | ({"x-distinct": list(node.distinct)} if node.distinct else {})
    own = {"type": kinds("object"), "properties": {k: json_schema(v, k not in node.required) for k, v in node.parts.items()}, "required": list(node.required), "additionalProperties": False}
    there = lambda p: {"properties": {p: {"not": {"type": "null"}}}, "required": [p]}
    rules = []
    for part, values, needed, banned in node.when:
        then = {"allOf": [*map(there, needed), *[{"not": there(p)} for p in banned]]}
        rules.append({"if": {"properties": {part: {"enum": list(values)}}, "required": [part]}, "then": then})
    return own | ({"allOf": rules} if rules else {})


def write_json_schema(node: object, path: str, title: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        json.dump({"$schema": "https://json-schema.org/draft/2020-12/schema", "title": title, **json_schema(node, False)}, f, ensure_ascii=False, indent=2)


def spark_type(node: object) -> T.DataType:
    """The type of a column that holds such records."""
    if isinstance(node, Number):
        return T.LongType() if node.whole else T.DoubleType()
    if isinstance(node, ListOf):
        return T.ArrayType(spark_type(node.item))
    if isinstance(node, Record):
        return T.StructType([T.StructField(k, spark_type(v)) for k, v in node.parts.items()])
    return {Text: T.StringType(), Day: T.DateType(), Flag: T.BooleanType()}[type(node)]


def violations(x: Column, node: object, path: Column | str = "$", required: bool = False) -> Column:
    """array<string> of what in x breaks the description, as `path: what`; empty if nothing does. x has spark_type(node)."""
    path = F.lit(path) if isinstance(path, str) else path
    say = lambda broken, what: F.when(broken, F.concat(path, F.lit(f": {what}")))
    there = lambda *found: F.filter(F.array(*found), lambda v: v.isNotNull())
    none = F.array().cast("array<string>")
    if isinstance(node, Text):
        checks = [say(~x.rlike(node.pattern), "not as its pattern")] if node.pattern else []
        checks += [say(~x.isin(*node.options), "not one of its values")] if node.options else []
        checks += [say(F.length(x) > node.most, "too long")] if node.most is not None else []
        found = there(*checks) if checks else none
    elif isinstance(node, Number):
        checks = [say(x < node.low, "too small")] if node.low is not None else []
        checks += [say(x > node.high, "too large")] if node.high is not None else []
        found = there(*checks) if checks else none
    elif isinstance(node, ListOf):
        each = F.flatten(F.transform(x, lambda item, k: violations(item, node.item, F.concat(path, F.lit("["), k.cast("string"), F.lit("]")), True)))
        keys = F.transform(x, lambda item: F.struct(*[item[c].alias(c) for c in node.distinct])) if node.distinct else None
        whole = [say(F.size(x) < node.least, "too few")] if node.least else []
        whole += [say(F.size(F.array_distinct(keys)) < F.size(x), "repeated")] if keys is not None else []
        found = F.concat(there(*whole), each) if whole else each
    elif isinstance(node, Record):
        parts = [violations(x[k], v, F.concat(path, F.lit(f".{k}")), k in node.required) for k, v in node.parts.items()]
        rules = []
        for part, values, needed, banned in node.when:
            on = F.coalesce(x[part].isin(*values), F.lit(False))
            rules += [F.when(on & x[p].isNull(), F.concat(path, F.lit(f".{p}: missing with this {part}"))) for p in needed]
            rules += [F.when(on & x[p].isNotNull(), F.concat(path, F.lit(f".{p}: not with this {part}"))) for p in banned]
        found = reduce(lambda a, b: F.concat(a, b), parts + ([there(*rules)] if rules else []))
    else:
        found = none
    missing = there(say(F.lit(True), "missing")) if required else none
    return F.when(x.isNull(), missing).otherwise(found)


def checked(x: Column, node: object) -> Column:
    """`violations` of a whole record, evaluated once."""
    return once(x, lambda v: violations(v, node, required=True))


CURRENCY = Text(DOMAINS["currency"])
PLACE = Record({"url": Text(r"^https?://"), "quote": Text(most=2000), "page": Number(1, whole=True)}, ("url",))
EXTRACTION = Record({"method": Text(), "confidence": Text(options=("high", "medium", "low")), "review_required": Flag()}, ("method", "confidence", "review_required"))
REASON = Record({"code": Text(most=100), "detail": Text()}, ("code",))
#: The states of a field, and what each of them asks for.
STATES = ("found", "pending", "not_found", "ambiguous", "conflicting", "error")


def field_contract(value: object) -> Record:
    """A field of a record: found has value, source and extraction and no reason; pending nothing; other states a reason and no value."""
    parts = {"status": Text(options=STATES), "value": value, "raw_value": Text(), "source": PLACE, "extraction": EXTRACTION, "reason": REASON}
    return Record(parts, ("status",), (
        ("status", ("found",), ("value", "raw_value", "source", "extraction"), ("reason",)), ("status", ("pending",), (), ("value", "source", "reason")),
        ("status", STATES[2:], ("reason",), ("value",)),
    ))


HORIZON = Record({"recommended_years": Number(0, 100), "kind": Text(options=("exact", "minimum"))}, ("recommended_years",))
MINIMUM = Record({"amount": Number(0), "currency": CURRENCY}, ("amount", "currency"))
HISTORY = Record({"observations": ListOf(Record({"amount": Number(), "currency": CURRENCY, "as_of": Day()}, ("amount", "currency", "as_of")), 1, ("currency", "as_of"))}, ("observations",))
FUND_RECORD = Record({
    "fund_id": Text(DOMAINS["fund_id"]), "name": Text(most=300), "investment_horizon": field_contract(HORIZON), "minimum_investment": field_contract(MINIMUM), "aum_history": field_contract(HISTORY),
}, ("fund_id", "name", "investment_horizon", "minimum_investment", "aum_history"))
