"""What to do next: second passes, fallback actions, authoritative copies, quotas and samples."""

from __future__ import annotations

from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.deltas import union_all
from ..operators.rank import cap

# Fields by class, what an open one weighs, and states that leave it open or unconfirmed.
PRIORITY = ["minimum_investment", "target_return", "fees", "assets_under_management"]
SUPPORTING = ["investment_horizon", "manager", "administrator"]
SERIES = ["aum_history", "annual_returns", "historical_values"]
WEIGHTS = {**dict.fromkeys(PRIORITY, 10), **dict.fromkeys(SUPPORTING, 3), **dict.fromkeys(SERIES, 1)}
UNANSWERED = ["pending", "not_found", "ambiguous", "conflicting", "error"]
UNCONFIRMED = ["ambiguous", "conflicting", "error"]
SINGLE_REVISION = ["priips_kid", "statute", "subfund_statute", "memorandum", "prospectus", "price_list"]


def weight(field: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in WEIGHTS.items() for x in kv]), field), F.lit(0))


def unanswered_trigger(field: Column, status: Column, sufficient: Column, exhausted: Column, reports_unreached: Column) -> Column:
    """Why an open field is worth another crawl, null if it isn't."""
    return F.when(~status.isin(UNANSWERED), None).when(status.isin(UNCONFIRMED), "value_unconfirmed").when(field.isin(SERIES), F.when(reports_unreached, "series_sources_unreached")).when(sufficient & exhausted, None).when(field.isin(PRIORITY + SUPPORTING), "field_unanswered")


def audit_trigger(status: Column, reason: Column, fixable: list[str]) -> Column:
    return F.when(status == "rejected", "audit_rejected").when(status == "conflicting", "audit_conflicting").when((status == "suspicious") & reason.isin(fixable), "source_fixable_finding")


def between_sources(urls: Column) -> Column:
    """Whether a conflict's alternatives come from more than one address."""
    return F.size(F.array_distinct(F.filter(urls, lambda u: u.isNotNull() & (u != "")))) > 1


def deep_pass(reasons: list[DataFrame], fund: str) -> DataFrame:
    """(fund, weight, n, triggers) from reasons (fund, field, trigger); order by falling weight, n, then fund."""
    every = union_all(reasons)
    return every.groupBy(fund).agg(F.sum(weight(F.col("field"))).alias("weight"), F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("trigger")), ",").alias("triggers"))


def authoritative(df: DataFrame, fund: str, url: str, text: str, kind: str, score: str, rank: Column) -> DataFrame:
    """df with `kept`: of each fund's documents one copy of a kind of a single revision, one of each year or file name of others."""
    years = F.regexp_extract_all(F.concat_ws(" ", url, text), F.lit(r"(?<!\d)((?:19|20)\d{2})(?!\d)"), 1)
    year = F.array_max(years)
    slug = F.regexp_extract(url, r"([^/]*)/*$", 1)
    revision = F.when(F.col(kind).isin(SINGLE_REVISION), F.lit("current")).otherwise(F.coalesce(year, slug))
    order = Window.partitionBy(fund, kind, "revision").orderBy(F.desc(F.coalesce(year.cast("int"), F.lit(0))), F.desc(F.col(score) + rank), F.desc(url))
    return df.withColumn("revision", revision).withColumn("kept", F.row_number().over(order) == 1)


def fallback_actions(df: DataFrame, fund: str, field: str, domain: str, has_scanned: str, has_parsed: str, approved: list[tuple[str, int, list[str]]] = ()) -> DataFrame:
    """(fund, field, action, priority): ordered actions for each missing field of each fund.

    A domain is shared where two funds have it; the empty domain counts as one.
    """
    sharing = df.select(fund, domain).distinct().groupBy(domain).agg(F.count("*").alias("__n"))
    own = df.join(sharing, domain)
    act = lambda name, p, when: F.when(when, F.struct(F.lit(name).alias("action"), F.lit(p).alias("priority")))
    actions = [act("expanded_crawl", 10, F.lit(True)), act("domain_adapter", 20, F.col("__n") >= 2), act("ocr", 30, F.col(has_scanned))]
    actions += [act(f"approved_source:{name}", 100 + p, F.col(field).isin(fields)) for name, p, fields in approved]
    actions += [act("grounded_llm", 500, F.col(has_parsed)), act("manual_review", 900, F.lit(True))]
    rows = own.select(fund, field, F.explode(F.filter(F.array(*actions), lambda a: a.isNotNull())).alias("a"))
    return rows.select(fund, field, "a.action", "a.priority")


#: The share of a field's quota that the hardest rows fill, and how many rows of a fund a sample may have.
HARD_SHARE, ROWS_OF_A_FUND = 0.45, 3


def quotas(available: dict[str, int], size: int, floor: int = 1) -> dict[str, int]:
    """Proportional shares of a sample with a floor, none above what there is; what rounding leaves goes to the largest rest.

    Works on one number for each field.
    """
    total = sum(available.values())
    exact = {k: size * n / total for k, n in available.items()} if total else dict.fromkeys(available, 0.0)
    own = {k: min(n, max(min(floor, n), int(exact[k]))) for k, n in available.items()}
    order = sorted(available, key=lambda k: (-(exact[k] - int(exact[k])), k))
    while sum(own.values()) < min(size, total):
        room = [k for k in order if own[k] < available[k]]
        own[room[0]] += 1
        order.append(order.pop(order.index(room[0])))
    while sum(own.values()) > size:
        k = max(own, key=lambda x: (own[x], x))
        own[k] -= 1
    return own


def field_quotas(counts: DataFrame, field: str, n: str, size: int, floor: int = 1) -> DataFrame:
    """(field, quota) of counts (one row a field) by `quotas`, in a task."""

    def shares(part: pa.Table) -> pa.Table:
        own = quotas(dict(zip(part.column(0).to_pylist(), part.column(1).to_pylist())), size, floor)
        return pa.table({"field": pa.array(own.keys(), part.schema.field(0).type), "quota": pa.array(own.values(), pa.int32())})

    own = counts.select(F.col(field).alias("field"), F.col(n).cast("long").alias("n"))
    return own.groupBy(F.lit(0).alias("all")).applyInArrow(shares, own.select("field").schema.add("quota", "integer"))


def _selected(rows: list[dict], quota: dict[str, int], share: dict[str, float], size: int, hard: float, most: int) -> list[tuple]:
    """(row's key, pass) of the sample: each field's hardest rows up to its hard share, then always the type furthest below its share."""
    by_fund, by_field, by_type, taken, out = Counter(), Counter(), Counter(), set(), []

    def accept(r: dict, turn: str) -> None:
        by_fund[r["fund"]] += 1
        by_field[r["field"]] += 1
        by_type[r["type"]] += 1
        taken.add(r["key"])
        out.append((r["key"], turn))

    order = sorted(rows, key=lambda r: (r["field"], -r["difficulty"], r["h"], r["key"]))
    for r in order:
        if by_field[r["field"]] < round(quota[r["field"]] * hard) and by_fund[r["fund"]] < most:
            accept(r, "hard")
    lanes = defaultdict(list)  # of each type and field, in the order in which rows would be taken
    for r in sorted(rows, key=lambda r: (-r["difficulty"], r["fund"], r["field"], r["key"]), reverse=True):
        lanes[r["type"], r["field"]].append(r)
    while len(out) < size:
        heads = []
        for (kind, field), lane in lanes.items():
            while lane and (lane[-1]["key"] in taken or by_fund[lane[-1]["fund"]] >= most):
                lane.pop()
            if lane and by_field[field] < quota[field]:
                r = lane[-1]
                heads.append(((-(share[kind] * size - by_type[kind]), -r["difficulty"], r["fund"], r["field"], r["key"]), r))
        if not heads:
            break
        accept(min(heads, key=lambda x: x[0])[1], "spread")
    return out


def sample(df: DataFrame, key: str, fund: str, field: str, kind: str, difficulty: str, size: int, seed: str, hard: float = HARD_SHARE, most: int = ROWS_OF_A_FUND) -> DataFrame:
    """(key, fund, field, kind, pass): a sample for review under several constraints at once.

    Each field gets its quota; of it the share `hard` goes to the field's most difficult rows (fields in
    order, equal rows by a hash of seed and key), the rest to the most difficult rows of whichever type of
    document the sample is then furthest below its share of all rows; no fund has more than `most` rows.
    Taking a row at a time looks at few rows. In a field's list of the hardest, `most` of a fund can count; at most size
    of them are taken and at most size belong to full funds, so its first 2 * size hold every row that can be taken.
    In a list of a field and type 2 * most of a fund can count (some are taken before), at most 2 * size belong to
    full funds and size are taken. Group limits reduce each list to that, and what is left, at most 5 * size + 1 rows
    for a field and type whatever the data, is settled in one task. Rows with a null key, fund, field or type can't be asked for and are left out.
    """
    own = df.select(F.col(key).alias("key"), F.col(fund).alias("fund"), F.col(field).alias("field"), F.col(kind).alias("type"), F.col(difficulty).cast("long").alias("difficulty"))
    own = own.where("key is not null and fund is not null and field is not null and type is not null").fillna({"difficulty": 0})
    own = own.withColumn("h", F.md5(F.concat_ws("/", F.lit(seed), F.col("key").cast("string"))))
    hardest, spread = [F.desc("difficulty"), "h", "key"], [F.desc("difficulty"), "fund", "key"]
    first = cap(cap(own, ["field", "fund"], hardest, most), ["field"], hardest, 2 * size)
    # a pair's list also loses the rows of the first pass, at most size
    second = cap(cap(own, ["field", "type", "fund"], spread, 2 * most), ["field", "type"], spread, 3 * size + 1)
    rows = first.union(second).distinct()
    counts = own.groupBy("field", "type").agg(F.count("*").alias("n"))
    shares = counts.groupBy("type").agg(F.sum("n").alias("n")).select("type", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"))
    asked = field_quotas(counts.groupBy("field").agg(F.sum("n").alias("n")), "field", "n", size)
    joined = rows.join(asked, "field").join(shares, "type")

    def settle(part):
        given = part.to_pylist()
        got = dict(_selected(given, {r["field"]: r["quota"] for r in given}, {r["type"]: r["share"] for r in given}, size, hard, most))
        keep = [r | {"pass": got[r["key"]]} for r in given if r["key"] in got]
        return pa.Table.from_pylist([{c: r[c] for c in ("key", "fund", "field", "type", "pass")} for r in keep], schema=pa.schema([*[part.schema.field(c) for c in ("key", "fund", "field", "type")], ("pass", pa.string())]))

    schema = joined.select("key", "fund", "field", "type").schema.add("pass", "string")
    return joined.groupBy(F.lit(0).alias("all")).applyInArrow(settle, schema).select(F.col("key").alias(key), F.col("fund").alias(fund), F.col("field").alias(field), F.col("type").alias(kind), "pass")


def stratified(df: DataFrame, stratum: str, key: str, seed: str, per: int, group: str | None = None, per_group: int = 3) -> DataFrame:
    """The `per` rows of each stratum with the smallest hashes of seed and key, at most `per_group` of a group in each.

    The order is a fixed hash, so a sample is the same on every run and of any partitioning.
    """
    rows = df.withColumn("__h", F.md5(F.concat_ws("/", F.lit(seed), F.col(key).cast("string"))))
    if group:
        rows = cap(rows, [stratum, group], ["__h", key], per_group)
    return cap(rows, [stratum], ["__h", key], per).drop("__h")


def difficulty(weights: list[tuple[Column, int]]) -> Column:
    return sum((F.when(c, w).otherwise(0) for c, w in weights), F.lit(0))
