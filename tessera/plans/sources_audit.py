"""Audits of what stands behind a value: who published it, for how many funds, and whether its line supports it.

Findings are arrays of (code, severity), as in `rules`; texts are folded here.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import distinctive_tokens, fold, has_any, once
from . import rules
from .rules import exploded, findings, rule

# The words of a fee's line, and how far a rate may stand from its label.
FEE_LABELS = ["poplatek", "odmena", "naklady", "srazka", "prirazka", "fee", "charges"]
INCOME_SHARE = ["je prijmem", "prijmem", "prijmem spolecnosti", "nalezi", "pripise", "ve prospech"]
FEE_MAXIMUM = ["max.", "max ", "maximaln", "nejvyse", " az ", "up to"]
FEE_DISTANCE = 60
RANGE_END = r"(?:-|az|do|to)\s*(\d+(?:[.,]\d+)?)\s*%"
#: Kinds of series that are worth one share, and of target returns that state no single value.
PER_SHARE = ["nav_per_share", "investment_share_value"]
NO_SINGLE_TARGET = ["range", "not_published"]


def plain_number(rate: Column) -> Column:
    """A rate as it is written with a point, four decimals at most and no zeros behind them."""
    return F.regexp_replace(F.format_string("%.4f", rate.cast("double")), r"\.?0+$", "")


def _first(text: Column, written: list[Column]) -> Column:
    """(start, length) of the first spelling that the text holds, null if it holds none; starts count from 1."""
    return F.coalesce(*[F.when(F.position(w, text) > 0, F.struct(F.position(w, text).alias("start"), F.length(w).alias("size"))) for w in written])


def _places(text: Column, words: list[str]) -> Column:
    """Where each of the words that the text holds stands first."""
    return F.filter(F.transform(F.array(*map(F.lit, words)), lambda w: F.position(w, text)), lambda p: p > 0)


def fee_evidence(rate: Column, basis: Column, maximum: Column) -> Column:
    """Findings of a rate against the line it was read from; a missing rate or line has none.

    A line without the number supports nothing, and no other rule is tried. Else the number may stand too
    far from every label (unless it ends a range), belong to a clause on who receives the income, or be an
    upper limit that isn't marked as one.
    """
    rate, plain = rate.cast("double"), plain_number(rate)
    comma = lambda x: F.replace(x, F.lit("."), F.lit(","))
    spellings = [plain, comma(plain), comma(F.format_string("%.1f", rate)), comma(F.format_string("%.2f", rate))]

    def judged(line: Column) -> Column:
        numbers = F.transform(F.regexp_extract_all(line, F.lit(r"\d+(?:[.,]\d+)?"), F.lit(0)), lambda n: F.replace(n, F.lit(","), F.lit(".")))
        points = F.array(*[F.replace(s, F.lit(","), F.lit(".")) for s in spellings])
        there = reduce(lambda a, s: a | F.contains(line, s), spellings, F.arrays_overlap(numbers, points))
        ends = F.transform(F.regexp_extract_all(line, F.lit(RANGE_END), F.lit(1)), lambda n: F.replace(n, F.lit(","), F.lit(".")).cast("double"))
        range_end = F.exists(ends, lambda e: F.abs(e - rate) < 0.001)
        at, labels, shares = _first(line, spellings[:2]), _places(line, FEE_LABELS), _places(line, INCOME_SHARE)
        label, share = F.array_min(labels), F.array_min(shares)
        distance = F.array_min(F.transform(labels, lambda p: F.abs(at["start"] - p)))
        after = share - at["start"] - at["size"]
        governed = F.when(label.isNull(), share < at["start"]).otherwise((label < at["start"]) & ((share.between(label + 1, at["start"] - 1)) | after.between(0, 3)))
        checks = findings(
            rule("value_far_from_fee_label", "review", (distance > FEE_DISTANCE) & ~range_end),
            rule("percentage_describes_income_share", "review", governed),
            rule("maximum_flag_contradicts_source", "conflict", has_any(line, FEE_MAXIMUM) & ~F.coalesce(maximum, F.lit(False))),
        )
        return F.when(there, checks).otherwise(findings(rule("value_not_present_in_evidence", "review", ~there)))

    none = F.array().cast("array<struct<code:string,severity:string>>")
    return F.when(rate.isNull() | basis.isNull(), none).otherwise(once(fold(basis), judged))


def decoded(url: Column) -> Column:
    """An address with its percent escapes read, as it is where they are broken; a plus sign stays one."""
    return F.coalesce(F.try_url_decode(F.replace(url, F.lit("+"), F.lit("%2B"))), url)


def source_evidence(values: DataFrame, keys: list[str], name: str, url: str, source: str) -> DataFrame:
    """(keys, code, severity, other_names) of values with an address; those without one have no finding here.

    An address that stands behind values of several names is wrong for all of them but one. Names are counted for each
    address before the join, so that an address of very many values is one row on its side.
    """
    known = values.where(F.coalesce(F.col(url), F.lit("")) != "")
    names = known.where(F.col(name).isNotNull()).select(F.col(url), F.col(name)).distinct().groupBy(url).agg(F.count("*").alias("__names"))
    tokens = distinctive_tokens(name)
    named = once(fold(decoded(F.col(url))), lambda u: F.exists(tokens, lambda t: F.contains(u, t)))
    checks = findings(
        rule("third_party_source", "review", F.col(source) == "third_party"),
        rule("source_shared_across_funds", "conflict", F.col("__names") > 1),
        rule("source_does_not_name_the_fund", "review", (F.col(source) == "manager_or_administrator") & (F.size(tokens) > 0) & ~named),
    )
    found = known.join(names, url, "left").select(*keys, "__names", F.explode(checks).alias("f"))
    others = F.when(F.col("f.code") == "source_shared_across_funds", F.col("__names") - 1).otherwise(0)
    return found.select(*keys, "f.code", "f.severity", others.alias("other_names"))


def cross_fields(assets: DataFrame, capital: DataFrame, shares: DataFrame, targets: DataFrame, returns: DataFrame, parties: DataFrame, fund: str) -> DataFrame:
    """(fund, field, code, severity): the findings between fields, each sent to the field that is to be corrected.

    assets(fund, amount, currency, metric, as_of), capital like it, shares(fund, kind, currency, value),
    targets(fund, kind, value), returns(fund, series, rate), parties(fund, role, name, ico).
    """

    def sent(funds: DataFrame, field: str, code: str, severity: str) -> DataFrame:
        return funds.select(fund, F.lit(field).alias("field"), F.lit(code).alias("code"), F.lit(severity).alias("severity"))

    share_values = shares.where(F.col("kind").isin(PER_SHARE))
    single = targets.where(F.col("value").isNotNull() & ~F.col("kind").isin(NO_SINGLE_TARGET))
    reached = returns.where("series = 'calendar_year'")
    parts = [
        sent(rules.superseded(assets, capital, fund), "assets_under_management", "newer_aum_observation_exists", "review"),
        sent(rules.disagreeing(assets, capital, fund), "assets_under_management", "conflicting_values", "conflict"),
        sent(rules.equal_within(assets, share_values, [fund, "currency"], "amount", "value"), "assets_under_management", "per_share_value_as_aum", "reject"),
        sent(rules.equal_within(single, reached, [fund], "value", "rate"), "target_return", "historical_return_as_target_return", "review"),
        sent(rules.same_company_other_number(parties, fund), "administrator", "conflicting_values", "conflict"),
    ]
    return reduce(DataFrame.union, parts).distinct()


def fee_findings(fees: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, code, severity) of fees(keys, rate, basis, maximum)."""
    return exploded(fees, keys, fee_evidence(F.col("rate"), F.col("basis"), F.col("maximum")))
