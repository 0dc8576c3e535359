"""Validation rules as columns: each gives a finding or nothing; findings are rows in the end."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import capital_metric
from ..functions.evidence import written_forms
from ..functions.labels import AMOUNT_UNITS, ANNUAL_REPORT_ADDRESSES, CAPITAL_SUBJECTS, STATUTORY
from ..functions.text import canonical_domain, company_key, distinctive_tokens, fold, has_any, once, words
from ..functions.values import supports

# The bounds of the rules.
CURRENCIES = ["CZK", "EUR", "USD"]
YEARS = (1900.0, 2100.0)
LONGEST_HORIZON = 30.0
STATUTORY_CAPITAL = {"EUR": 1_250_000.0, "CZK": 32_000_000.0}
SMALLEST_INVESTMENT = {"CZK": 1_000.0, "EUR": 100.0, "USD": 100.0}
QUALIFIED_INVESTMENT = {"CZK": 100_000.0, "EUR": 5_000.0, "USD": 5_000.0}
PER_SHARE_LIMIT, SMALL_AUM, LARGE_AUM = 1_000.0, 1_000_000.0, 500_000_000_000.0
OLDEST_DAYS = 5 * 365
RETURN_LIMIT, RETURN_TOLERANCE = 60.0, 0.05
AUM_TOLERANCE = 0.01
HIGH_FEE = {"entry": 10.0, "management": 10.0, "administration": 10.0, "depositary": 10.0, "ongoing": 15.0, "transaction": 15.0}
IMPLAUSIBLE_FEE = 100.0
NOT_THE_FUNDS = ["registered_capital", "statutory_minimum_capital", "manager_aum"]
SEVERITY = {"review": 1, "conflict": 2, "reject": 3}
STATUS = {"review": "suspicious", "conflict": "conflicting", "reject": "rejected"}


def rule(code: str, severity: str, broken: Column) -> Column:
    """A finding where the condition holds (not where it is unknown)."""
    return F.when(broken, F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity")))


def findings(*rules: Column) -> Column:
    """The findings of some rules as an array."""
    return F.filter(F.array(*rules), lambda f: f.isNotNull())


def first_of(*rules: Column) -> Column:
    """The first of rules that exclude each other."""
    return F.coalesce(*rules)


def exploded(df: DataFrame, keys: list[str], checks: Column) -> DataFrame:
    return df.select(*keys, F.explode(checks).alias("f")).select(*keys, "f.code", "f.severity")


def per_currency(bounds: dict[str, float], currency: Column) -> Column:
    return reduce(lambda a, kv: F.when(currency == kv[0], kv[1]).otherwise(a), bounds.items(), F.lit(0.0))


def horizon(years: Column) -> Column:
    return findings(first_of(rule("calendar_year_as_horizon", "reject", years.between(*YEARS)), rule("implausible_horizon", "review", (years <= 0) | (years > LONGEST_HORIZON))))


def horizon_wording(kind: Column, quote: Column) -> Column:
    """A bound that the quote states and the value lost."""
    q = fold(quote)
    bound = has_any(q, ["min.", "minimalne", "nejmene", "alespon", "at least", "a vice"])
    return findings(rule("horizon_bound_lost", "review", (kind == "exact") & bound), rule("horizon_range_collapsed", "review", q.rlike(r"\d{1,2}\s*(?:-|az|do|to)\s*\d{1,2}\s*(?:let|rok|years?)")))


def minimum_investment(amount: Column, currency: Column, quote: Column) -> Column:
    statutory = reduce(or_, ((currency == c) & (amount == v) for c, v in STATUTORY_CAPITAL.items()))
    small = amount < per_currency(SMALLEST_INVESTMENT, currency)
    return findings(
        rule("unsupported_currency", "review", ~currency.isin(CURRENCIES)),
        rule("statutory_capital_as_minimum_investment", "reject", statutory & has_any(fold(F.coalesce(quote, F.lit(""))), STATUTORY)),
        first_of(rule("zero_minimum_investment", "review", amount == 0), rule("implausibly_small_minimum_investment", "review", small), rule("below_qualified_investor_threshold", "review", amount < per_currency(QUALIFIED_INVESTMENT, currency))),
        rule("non_round_minimum_investment", "review", (amount != 0) & (amount != F.floor(amount))),
    )


def target_return(value: Column, low: Column, high: Column) -> Column:
    none = value.isNull() & low.isNull() & high.isNull()
    return findings(
        rule("missing_value_component", "review", none),
        rule("collapsed_target_return_range", "review", low.isNotNull() & high.isNotNull() & value.isNotNull()),
        rule("inverted_target_return_range", "conflict", low > high),
        rule("implausible_target_return", "review", F.greatest(value, low, high) > 30),
    )


def capital(amount: Column, currency: Column, metric: Column, as_of: Column, today: Column) -> Column:
    fund = ~metric.isin(NOT_THE_FUNDS)
    return findings(
        rule("unsupported_currency", "review", ~currency.isin(CURRENCIES)),
        rule("non_fund_capital_metric", "reject", ~fund),
        first_of(rule("per_share_value_as_aum", "reject", fund & (amount < PER_SHARE_LIMIT)), rule("implausibly_small_aum", "review", fund & (amount < SMALL_AUM)), rule("implausibly_large_aum", "review", fund & (amount > LARGE_AUM))),
        *dated(as_of, today),
    )


def dated(as_of: Column, today: Column) -> list[Column]:
    return [rule("future_as_of_date", "review", as_of > today), rule("outdated_as_of_date", "review", F.datediff(today, as_of) > OLDEST_DAYS)]


def metric_wording(metric: Column, quote: Column) -> Column:
    named = capital_metric(fold(quote))
    return findings(rule("metric_differs_from_evidence", "review", named.isNotNull() & (named != metric)))


def provenance(url: Column, quote: Column, value: Column, page: Column) -> Column:
    paged = F.endswith(F.lower(F.regexp_replace(url, r"[?#].*$", "")), F.lit(".pdf"))
    return findings(
        rule("missing_source", "reject", F.coalesce(url, F.lit("")) == ""),
        rule("missing_quote", "review", F.trim(F.coalesce(quote, F.lit(""))) == ""),
        rule("number_not_in_quote", "review", (F.trim(F.coalesce(quote, F.lit(""))) != "") & ~supports(quote, value)),
        rule("missing_page", "review", paged & page.isNull()),
    )


def fee_item(kind: Column, rate: Column, low: Column, high: Column, maximum: Column, amount: Column, currency: Column) -> Column:
    usual = reduce(lambda a, kv: F.when(kind == kv[0], kv[1]).otherwise(a), HIGH_FEE.items(), F.lit(IMPLAUSIBLE_FEE))
    return findings(
        rule("collapsed_fee_range", "review", rate.isNotNull() & (low != high) & ~F.coalesce(maximum, F.lit(False))),
        first_of(rule("implausible_fee_rate", "review", rate > IMPLAUSIBLE_FEE), rule("unusually_high_fee_rate", "review", rate > usual)),
        rule("missing_currency", "review", amount.isNotNull() & currency.isNull()),
    )


def party(name: Column, fund_name: Column) -> Column:
    return findings(
        rule("missing_party_name", "reject", F.trim(F.coalesce(name, F.lit(""))) == ""),
        rule("party_name_opens_with_date", "review", name.rlike(r"^\s*(?:\d{1,2}\s*[./]\s*\d{1,2}\s*[./]\s*\d{4}|(?:19|20)\d{2})(?!\d)")),
        rule("party_is_the_fund", "reject", company_key(name) == company_key(fund_name)),
    )


def rebuilt_text(is_rebuilt: Column, confidence: Column, review: Column, placed: Column) -> Column:
    """What text rebuilt by a second parser owes: no high confidence, a review, and a page for more than low."""
    return findings(
        rule("fallback_confidence_too_high", "review", is_rebuilt & (confidence == "high")),
        rule("fallback_without_review", "review", is_rebuilt & ~F.coalesce(review, F.lit(False))),
        rule("fallback_not_placed", "review", is_rebuilt & ~F.coalesce(placed, F.lit(False)) & (confidence != "low")),
    )


# --- rules over groups


def annual_returns(df: DataFrame, fund: str) -> DataFrame:
    """(fund, code, severity) of series rows (fund, year, series, share_class, rate), each code once, at its worst."""
    share = F.coalesce("share_class", F.lit(""))
    calendar = F.col("series") == "calendar_year"
    whole = df.groupBy(fund).agg(
        F.bool_or(F.col("series") == "cumulative").alias("cumulative"),
        F.bool_or(F.col("series") == "kid_scenario").alias("scenario"),
        F.bool_or(~F.col("series").isin("calendar_year", "cumulative", "kid_scenario")).alias("mixed"),
        F.bool_or(calendar & (share == "")).alias("unnamed"),
        F.bool_or(calendar & (share != "")).alias("named"),
        F.bool_or(calendar & (F.abs("rate") > RETURN_LIMIT)).alias("large"),
    )
    series = exploded(
        whole,
        [fund],
        findings(
            first_of(rule("cumulative_as_annual_return", "reject", F.col("cumulative")), rule("cumulative_as_annual_return", "review", F.col("large"))),
            rule("kid_scenario_as_annual_return", "reject", F.col("scenario")),
            rule("mixed_metrics_in_series", "review", F.col("mixed")),
            rule("mixed_share_classes_in_series", "review", F.col("named") & F.col("unnamed")),
        ),
    )
    years = df.where(calendar).groupBy(fund, "year", share.alias("c")).agg((F.max("rate") - F.min("rate")).alias("spread"))
    unlike = years.where(F.col("spread") > RETURN_TOLERANCE).select(fund, F.lit("conflicting_annual_returns").alias("code"), F.lit("conflict").alias("severity")).distinct()
    return series.union(unlike)


def historical_series(df: DataFrame, fund: str, today: Column) -> DataFrame:
    """(fund, code, severity) of observations (fund, kind, share_class, currency, as_of, value), each code once."""
    share = F.coalesce("share_class", F.lit(""))
    kinds = df.groupBy(fund, "kind").agg(F.bool_or(share == "").alias("unnamed"), F.bool_or(share != "").alias("named"), F.countDistinct("currency").alias("currencies"), F.bool_or(F.col("as_of") > today).alias("future"), F.min("value").alias("low"))
    per_share = F.col("kind").isin("fund_capital", "fund_net_assets", "aum") & (F.col("low") < PER_SHARE_LIMIT)
    checks = findings(rule("mixed_share_classes_in_series", "review", F.col("named") & F.col("unnamed")), rule("mixed_currencies_in_series", "review", F.col("currencies") > 1), rule("future_as_of_date", "review", F.col("future")), rule("per_share_value_in_fund_series", "reject", per_share))
    twice = df.groupBy(fund, "kind", share.alias("c"), "currency", "as_of").count().where("count > 1").select(fund, F.lit("duplicate_dates_in_series").alias("code"), F.lit("review").alias("severity"))
    return exploded(kinds, [fund], checks).union(twice).distinct()


def collapse(df: DataFrame, keys: list[str]) -> DataFrame:
    """One finding of each code, the most severe."""
    rank = severity_rank(F.col("severity"))
    return df.groupBy(*keys, "code").agg(F.max_by("severity", rank).alias("severity"))


def severity_rank(severity: Column) -> Column:
    return reduce(lambda a, kv: F.when(severity == kv[0], kv[1]).otherwise(a), SEVERITY.items(), F.lit(0))


def worst(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, status): the verdict of each group of findings."""
    status = reduce(lambda a, kv: F.when(F.col("s") == kv[0], kv[1]).otherwise(a), STATUS.items(), F.lit("valid"))
    return df.groupBy(*keys).agg(F.max_by("severity", severity_rank(F.col("severity"))).alias("s")).select(*keys, status.alias("status"))


# --- rules across fields: value(fund, amount, currency, metric, as_of) against a series of the same fund


def superseded(values: DataFrame, series: DataFrame, fund: str) -> DataFrame:
    """Funds whose series holds a later observation of the fund's own capital: (fund, as_of, latest, latest_amount)."""
    own = series.where(~F.col("metric").isin(NOT_THE_FUNDS)).groupBy(fund).agg(F.max(F.struct("as_of", "amount")).alias("l"))
    return values.join(own, fund).where(F.col("l.as_of") > F.col("as_of")).select(fund, "as_of", F.col("l.as_of").alias("latest"), F.col("l.amount").alias("latest_amount"))


def disagreeing(values: DataFrame, series: DataFrame, fund: str) -> DataFrame:
    """Funds whose value has observations of its metric, date and currency, none of them within one percent."""
    s = series.where(~F.col("metric").isin(NOT_THE_FUNDS)).select(fund, "as_of", "currency", "metric", F.col("amount").alias("other"))
    larger = F.greatest("amount", "other")
    far = (larger == 0) | (F.abs(F.col("amount") - F.col("other")) / F.nullif(larger, F.lit(0.0)) > AUM_TOLERANCE)
    return values.join(s, [fund, "as_of", "currency", "metric"]).groupBy(fund).agg(F.bool_and(far).alias("far"), F.count("*").alias("n")).where("far").select(fund, "n")


def equal_within(values: DataFrame, series: DataFrame, keys: list[str], a: str, b: str, tolerance: float = 1e-6) -> DataFrame:
    """Keys whose value equals one of the series' within a tolerance.

    Values are dealt to buckets of twice the tolerance and meet those of their bucket and its neighbours:
    an equi-join, so equal keys with very many rows still make pairs only of near values.
    """
    wide = 2 * tolerance
    left = values.select(*keys, F.col(a).alias("__a")).withColumn("__b", F.explode(F.array(*[F.floor(F.col("__a") / wide) + k for k in (-1, 0, 1)])))
    right = series.select(*keys, F.col(b).alias("__v")).withColumn("__b", F.floor(F.col("__v") / wide)).distinct()
    return left.join(right, [*keys, "__b"]).where(F.abs(F.col("__a") - F.col("__v")) < tolerance).select(*keys).distinct()


def same_company_other_number(df: DataFrame, fund: str) -> DataFrame:
    """Funds whose manager and administrator have one name and two registration numbers."""
    m, a = df.where("role = 'manager'"), df.where("role = 'administrator'")
    both = m.select(fund, company_key("name").alias("k"), F.col("ico").alias("i")).join(a.select(fund, company_key("name").alias("k"), F.col("ico").alias("j")), [fund, "k"])
    return both.where(F.col("i") != F.col("j")).select(fund).distinct()


#: Fixed value: how a company's name ends.
COMPANY = r"[^\n:;()•\[\]]{2,70}?(?:a\.\s?s\.|s\.\s?r\.\s?o\.|spol\.\s*s\s*r\.\s*o\.|SE)(?![\w.])"


def capital_attribution(amount: Column, quote: Column, fund_name: Column) -> Column:
    """A finding where another company stands before the amount in the quote, and neither the fund nor a word for it stands closer."""
    plain = F.regexp_replace(F.coalesce(quote, F.lit("")), "[\u00a0\u202f]", " ")
    fund = distinctive_tokens(fund_name)
    places = F.filter(F.transform(written_forms(amount), lambda f: F.position(f, plain)), lambda p: p > 0)
    foreign = lambda n: (F.size(distinctive_tokens(n)) > 0) & (F.size(F.array_intersect(distinctive_tokens(n), fund)) == 0)

    def judged(lead: Column) -> Column:
        names, rest = F.regexp_extract_all(lead, F.lit(COMPANY), F.lit(0)), F.split(lead, COMPANY, -1)
        # the last company that isn't the fund, and what stands between it and the amount
        last = F.array_max(F.transform(names, lambda n, k: F.when(foreign(n), k)))
        between = F.array_join(F.concat(F.slice(rest, last + 2, F.size(rest)), F.slice(names, last + 2, F.size(names) + 1)), " ")
        closer = F.arrays_overlap(F.split(fold(between), r"[^a-z0-9]+"), F.array_union(fund, F.array(*map(F.lit, CAPITAL_SUBJECTS))))
        return rule("capital_of_another_company", "reject", last.isNotNull() & ~closer)

    return once(F.when(F.size(places) > 0, F.substr(plain, F.lit(1), F.array_min(places) - 1)), judged)


def explained_small_amount(code: Column, quote: Column, url: Column) -> Column:
    """The code of a finding, more exact for amounts that are too small.

    If a unit stands in the quote, a wrong amount was taken; else, in an annual report, the unit of the
    table's head is missing.
    """
    small = code == "implausibly_small_aum"
    unit = has_any(fold(F.coalesce(quote, F.lit(""))), AMOUNT_UNITS)
    report = has_any(fold(F.coalesce(url, F.lit(""))), ANNUAL_REPORT_ADDRESSES)
    return F.when(small & unit, "aum_value_not_tied_to_label").when(small & report, "thousands_unit_not_applied").otherwise(code)


def news_items(items: DataFrame, funds: DataFrame, fund: str) -> DataFrame:
    """(fund, url, code, severity) of items(fund, url, title, published_at, third_party) against funds(fund, name, web).

    An item of the fund's own host is fine; a third party's is to be reviewed; one of a shared site must
    name the fund by one of its distinctive words. url is null in the finding that a fund has undated items.
    """
    known = items.join(funds.select(fund, "name", "web"), fund)
    host = canonical_domain("web")
    foreign = ~F.coalesce((host != "") & (canonical_domain("url") == host), F.lit(False))
    tokens = distinctive_tokens("name")
    mentioned = F.size(F.array_intersect(tokens, words(F.concat_ws(" ", "title", F.regexp_replace("url", "[^A-Za-z0-9]+", " "))))) > 0
    other = rule("news_from_unofficial_source", "review", foreign & F.col("third_party"))
    shared = rule("news_of_another_fund", "reject", foreign & ~F.col("third_party") & (F.size(tokens) > 0) & ~mentioned)
    found = exploded(known, [fund, "url"], findings(other, shared))
    undated = items.where("published_at is null").select(fund).distinct()
    return found.union(undated.select(fund, F.lit(None).cast("string"), F.lit("news_without_date"), F.lit("review")))
