"""Fields of funds from lines of their documents: candidates, scores, winners.

Input rows are lines with context, (fund, source_id, document_type, page, line_no, line, context); text is folded once, and
each extractor is a projection that finds a value, a score and the claim's facts. Candidates of a field
then compete by `operators.resolve`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import BENCHMARK, CAPITAL_METRICS, FREQUENCIES, HISTORICAL_VALUES, PAST_RETURN, PER_SHARE, RETURN_SERIES, RETURN_TYPES, annualization, aum_metric, capital_metric, first_match, horizon_kind, refined_capital_metric
from ..functions.labels import HORIZON_UNITS, HORIZON_WORDS, MINIMUM_STARTS, MINIMUM_SUBJECTS, RETURN_STARTS, RETURN_SUBJECTS
from ..functions.text import cut_party_name, fold, has_any, once, registration_number, share_class
from ..functions.values import amount, confidence, currency, dated_amounts, fee, fee_tiers, first_date, money, money_after, number
from ..operators import lines
from ..operators.rank import cap

# How much a document type is worth to a field (others 10), and words of the extractors.
PRIORITIES = {
    "investment_horizon": {"priips_kid": 80, "statute": 70, "subfund_statute": 75, "memorandum": 65, "factsheet": 50, "marketing_page": 20},
    "minimum_investment": {"statute": 80, "subfund_statute": 85, "memorandum": 80, "priips_kid": 55, "factsheet": 50, "marketing_page": 30},
    "target_return": {"memorandum": 80, "factsheet": 75, "infoletter": 60, "marketing_page": 40, "statute": 40},
    "fees": {"priips_kid": 85, "statute": 80, "subfund_statute": 85, "memorandum": 70, "factsheet": 60, "marketing_page": 30},
    "assets_under_management": {"annual_report": 90, "financial_statements": 90, "half_year_report": 80, "factsheet": 70, "infoletter": 60, "marketing_page": 30},
}
FEES = {
    "performance": ["vykonnostni poplatek", "vykonnostni odmena", "performance fee", "performance remuneration"],
    "management": ["poplatek za obhospodarovani", "odmena za obhospodarovani", "management fee", "management remuneration"],
    "entry": ["vstupni poplatek", "vstupni naklady", "entry fee", "subscription fee"],
    "exit": ["vystupni poplatek", "vystupni naklady", "exit fee", "redemption fee"],
    "ongoing": ["prubezne naklady", "ongoing costs", "ongoing charges"],
    "administration": ["administracni poplatek", "administration fee"],
    "depositary": ["odmena depozitare", "poplatek depozitari", "depositary fee"],
}
PAST = ["vykonnost fondu", "za poslednich", "od zalozeni", "historicka vykonnost", "minula vykonnost", "dosazene zhodnoceni", "past performance"]
SCENARIO = ["scenar", "stresovy", "neprizniv", "umerny", "prizniv", "performance scenario", "stress scenario", "unfavourable", "moderate scenario", "favourable"]
SHARE_PRICE = ["cena investicni akcie", "hodnota investicni akcie", "hodnota akcie", "kurz akcie", "share price"]
ROLES = {"manager": "obhospodarovatel|investicni spolecnost|manager", "administrator": "administrator|administrator fondu"}
NUMBER = r"\d[\d  .,]*\d|\d"


def lines_of(pages: DataFrame, fund: str = "fund", source: str = "source_id", text: str = "text", others: tuple[str, ...] = ("document_type", "page")) -> DataFrame:
    """Lines of pages with three-line context, both folded too."""
    own = lines.lines(pages, [fund, source, *others], text, around=(1, 1), folded=True)
    return own.select(fund, source, *others, "line_no", "line", "context", "start", "folded", "near")


def found_in(df: DataFrame, found: Column, *needs: Column, name: str = "found") -> DataFrame:
    """df's rows that hold what is needed, with `found`, where that isn't null: it is evaluated once for each of them.

    The outer explode keeps Spark from evaluating it again in a filter and in each column that is made of it.
    """
    for need in needs:
        df = df.where(need)
    return df.withColumn(name, F.explode_outer(F.array(found))).where(F.col(name).isNotNull())


def priority(field: str, kind: Column) -> Column:
    table = PRIORITIES[field]
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), kind), F.lit(10))


def _got(rows: DataFrame, field: str, value: Column, bonus: Column) -> DataFrame:
    """Candidates of a field from rows of `found_in`: (fund, field, value, score, priority, confidence, source_id, page, line_no, quote)."""
    worth = priority(field, F.col("document_type"))
    out = rows.withColumn("value", value).select("fund", F.lit(field).alias("field"), "value", (worth + bonus).cast("int").alias("score"), worth.alias("priority"), "source_id", "page", "line_no", F.col("context").alias("quote"))
    return out.withColumn("confidence", confidence(F.col("score")))


HORIZON = rf"(?:{'|'.join(HORIZON_WORDS)}).{{0,100}}?(\d+(?:[,.]\d+)?)\s*(?:{'|'.join(HORIZON_UNITS)})"
MINIMUM = rf"(?:{'|'.join(MINIMUM_STARTS)}).{{0,40}}?(?:{'|'.join(MINIMUM_SUBJECTS)}).{{0,100}}?({NUMBER})\s*(tisic|tis|milionu|milion|million|mil|miliarda|miliard|mld|billion)?\.?\s*(czk|kc|eur|usd)"
RATE = r"(?<![\d.,])(\d{1,3}(?:[.,]\d+)?)"
RETURN_WORDS = rf"(?:{'|'.join(RETURN_STARTS)}).{{0,50}}?(?:{'|'.join(RETURN_SUBJECTS)}).{{0,80}}?"
RETURN_RANGE, RETURN_ONE = rf"{RETURN_WORDS}{RATE}\s*%?\s*(?:-|az|to)\s*{RATE}\s*%", rf"{RETURN_WORDS}{RATE}\s*%"
#: Words one of which a pattern needs: lines without are passed over.
HORIZON_NEEDS = ["doporucen", "investicni horizont", "minimalni doba investice", "recommended holding period", "investment horizon"]
CURRENCIES = ["kc", "czk", "eur", "usd"]
HURDLE = rf"hurdle(?:\s+rate)?\D{{0,40}}?{RATE}\s*%"


def horizon_in(near: Column) -> Column:
    """struct(years, kind, bonus) of a horizon, null without: whether it is a least one is told by the words close to the number."""

    def found(raw: Column) -> Column:
        around = F.regexp_extract(near, rf"(.{{0,40}}{HORIZON}.{{0,20}})", 1)
        bonus = 70 + F.when(F.contains(near, F.lit("doporucen")), 15).otherwise(0)
        build = lambda years: F.when((years > 0) & (years <= 100), F.struct(years.alias("years"), once(F.substring_index(around, "horizont", -1), horizon_kind).alias("kind"), bonus.alias("bonus")))
        return F.when(raw != "", once(number(raw), build))

    return once(F.regexp_extract(near, HORIZON, 1), found)


def horizons(df: DataFrame) -> DataFrame:
    rows = found_in(df, horizon_in(F.col("near")), has_any("near", HORIZON_NEEDS))
    return _got(rows, "investment_horizon", F.col("found").dropFields("bonus"), F.col("found.bonus"))


def minimum_in(near: Column) -> Column:
    """struct(amount, currency, kind) of a least subscription, null without: whole amounts, none where the words speak of a share's price."""
    parts = F.struct(*[F.regexp_extract(near, MINIMUM, k).alias(n) for k, n in ((1, "raw"), (2, "unit"), (3, "cur"))])
    kind = F.when(has_any(near, ["zakon", "kvalifikovany investor", "legal threshold"]), "legal_threshold").otherwise("initial_subscription")

    def found(p: Column) -> Column:
        build = lambda a: F.when((a == F.floor(a)) & ~has_any(near, SHARE_PRICE), F.struct(a.alias("amount"), currency(p["cur"]).alias("currency"), kind.alias("kind")))
        return F.when(p["raw"] != "", once(amount(p["raw"], p["unit"]), build))

    return once(parts, found)


def minimum_investments(df: DataFrame) -> DataFrame:
    rows = found_in(df, minimum_in(F.col("near")), has_any("near", CURRENCIES), has_any("near", MINIMUM_SUBJECTS), has_any("near", MINIMUM_STARTS))
    return _got(rows, "minimum_investment", F.col("found"), F.lit(70))


def target_in(near: Column) -> Column:
    """struct(low, high, exact, type, annualization, bonus) of a promised return, null without.

    A range comes before a hurdle, a hurdle before one value. Nothing for past results, scenarios and
    spreads over a benchmark; a range that falls is none, and its window gives nothing.
    """
    raw = F.struct(*[F.regexp_extract(near, p, k).alias(n) for n, p, k in (("low", RETURN_RANGE, 1), ("high", RETURN_RANGE, 2), ("hurdle", HURDLE, 1), ("one", RETURN_ONE, 1))])
    none = F.lit(None).cast("double")

    def judged(p: Column) -> Column:
        rate = lambda c: number(F.nullif(p[c], F.lit("")))
        facts = F.struct(rate("low").alias("low"), rate("high").alias("high"), rate("hurdle").alias("hurdle"), rate("one").alias("one"), first_match(near, RETURN_TYPES).alias("named"), annualization(near).alias("annualization"))

        def chosen(f: Column) -> Column:
            classified = F.when(f["named"].isNotNull(), 10).otherwise(0)

            def found(low: Column, high: Column, exact: Column, kind: Column, bonus: Column) -> Column:
                return F.struct(low.alias("low"), high.alias("high"), exact.alias("exact"), kind.alias("type"), f["annualization"].alias("annualization"), bonus.alias("bonus"))

            return (
                F.when(f["low"].isNotNull() & (f["low"] <= f["high"]), found(f["low"], f["high"], none, F.coalesce(f["named"], F.lit("range")), 80 + classified))
                .when(f["low"].isNotNull(), None).when(f["hurdle"].isNotNull(), found(none, none, f["hurdle"], F.lit("hurdle"), F.lit(85)))
                .when(f["one"].isNotNull(), found(none, none, f["one"], F.coalesce(f["named"], F.lit("target")), 70 + classified))
            )

        return F.when((p["one"] != "") | (p["hurdle"] != "") | (p["low"] != ""), once(facts, chosen))

    return F.when(~has_any(near, PAST) & ~has_any(near, SCENARIO) & ~has_any(near, BENCHMARK), once(raw, judged))


def target_returns(df: DataFrame) -> DataFrame:
    rows = found_in(df, target_in(F.col("near")), F.contains("near", F.lit("%")), has_any("near", [*RETURN_SUBJECTS, "hurdle"]))
    return _got(rows, "target_return", F.col("found").dropFields("bonus"), F.col("found.bonus"))


def fees(df: DataFrame) -> DataFrame:
    of_kind = found_in(df, first_match("folded", FEES), name="kind")
    rows = found_in(of_kind, fee("folded")).where("found.rate IS NOT NULL OR found.amount IS NOT NULL OR found.negotiated")
    own = [F.col(f"found.{c}").alias(c) for c in ("rate", "maximum", "amount", "currency")]
    return _got(rows, "fees", F.struct(F.col("kind").alias("type"), *own, fee_tiers("folded").alias("tiers")), F.lit(60))


def fee_schedule(candidates: DataFrame, from_tables: DataFrame | None = None) -> DataFrame:
    """One fee of each kind for a page: of lines the last counts, of tables the first, and tables are worth 30 more."""
    own = cap(candidates.withColumn("kind", F.col("value.type")), ["fund", "source_id", "page", "kind"], [F.desc("line_no")], 1)
    if from_tables is not None:
        first = cap(from_tables.withColumn("kind", F.col("value.type")).withColumn("score", F.col("score") + 30), ["fund", "source_id", "page", "kind"], ["line_no"], 1)
        own = own.unionByName(first)
    return cap(own, ["fund", "kind"], [F.desc("score"), F.desc("source_id"), "page", "line_no"], 1)


FUND_LABELS = [w for m in ("fund_capital", "nav", "net_assets", "assets_under_management") for w in CAPITAL_METRICS[m]] + ["majetek fondu", "hodnota majetku fondu", "fund assets"]


def assets(df: DataFrame, newest: int) -> DataFrame:
    """An amount close after a label of the fund's capital, with the date of its words; those close to the year `newest` are worth more, to 50."""
    dated = found_in(df, first_date("near"), has_any("near", CURRENCIES), has_any("near", FUND_LABELS), ~has_any("near", PER_SHARE), name="day")
    rows = found_in(dated, money_after("near", FUND_LABELS))
    value = F.struct(F.col("found.amount").alias("amount"), F.col("found.currency").alias("currency"), aum_metric("near").alias("metric"), F.col("day").alias("as_of"))
    fresh = F.greatest(F.lit(0), F.least(F.lit(50), 50 - 10 * (newest - F.year("day"))))
    return _got(rows, "assets_under_management", value, 60 + fresh)


COMPANY = r"([\p{Lu}][\p{L}\p{N}&.\- ]{2,60}?,?\s*(?:a\.\s?s\.|s\.\s?r\.\s?o\.|SICAV|SE))"


def parties(df: DataFrame, role: str, reach: int = 120) -> DataFrame:
    """The company named at most `reach` letters after a role's label, and its registration number if near."""
    rest = F.regexp_extract("context", rf"(?iu)(?:{'obhospodařovatel' if role == 'manager' else 'administrátor'}|{ROLES[role]})[^\p{{L}}]{{1,5}}(.{{0,{reach}}})", 1)
    name = cut_party_name(F.regexp_extract(rest, COMPANY, 1))
    ico = registration_number(F.regexp_extract(rest, r"I[ČC]O?:?\s*([\d ]{8,11})", 1))
    return df.where(rest != "").select("fund", F.lit(role).alias("role"), name.alias("name"), ico.alias("ico"), "source_id", "page", "line_no").where("name is not null")


def capital_history(df: DataFrame, most: int = 400) -> DataFrame:
    """(fund, metric, as_of, currency, amount): the best-scored observation of each key, the first among equals.

    A fund's history is reported with its `most` earliest points at most; the cap is the feature's.
    """
    priced = found_in(df, money("folded"), has_any("folded", CURRENCIES), ~has_any("folded", PER_SHARE), name="m")
    dated = found_in(priced, first_date(F.concat_ws(" ", "folded", "near")), name="as_of")
    rows = found_in(dated, refined_capital_metric(capital_metric("folded"), F.col("folded"), F.col("near")), name="metric")
    own = cap(rows.withColumn("score", priority("assets_under_management", F.col("document_type"))), ["fund", "metric", "as_of", F.col("m.currency")], [F.desc("score"), "source_id", "line_no"], 1)
    return cap(own.select("fund", "metric", "as_of", F.col("m.currency").alias("currency"), F.col("m.amount").alias("amount")), ["fund"], ["as_of", "metric", "currency"], most)


def annual_returns(df: DataFrame, memory: int = 12, most: float = 300.0) -> DataFrame:
    """(fund, year, series, share_class, rate): years paired with percentages of a line, under the last heading of `memory` lines."""
    key = F.struct("fund", "source_id", "document_type", "page")
    carried = lines.carried(df.withColumn("__key", key), "__key", "line_no", first_match("folded", RETURN_SERIES), memory)
    told = has_any("folded", PAST_RETURN) | (F.size(F.split("folded", " ")) <= 20)
    rows = carried.where(F.col("heading").isNotNull() & told).select("fund", "source_id", "document_type", "line_no", F.col("heading").alias("series"), share_class("context").alias("share_class"), F.explode(lines.years_and_rates(F.col("folded"))).alias("p"))
    rows = rows.where(F.abs("p.rate") <= most).select("fund", "source_id", "line_no", F.col("p.year").alias("year"), "series", "share_class", F.col("p.rate").alias("rate"), F.lit(1).alias("score"))
    return cap(rows, ["fund", "year", "series", "share_class"], [F.desc("score"), "source_id", "line_no"], 1).select("fund", "year", "series", "share_class", "rate")


def historical_values(df: DataFrame, memory: int = 12) -> DataFrame:
    """(fund, kind, share_class, currency, as_of, value, declared): dated values under the last heading that names a kind."""
    key = F.struct("fund", "source_id", "document_type", "page")
    carried = lines.carried(df.withColumn("__key", key), "__key", "line_no", first_match("folded", HISTORICAL_VALUES), memory)
    rows = carried.where("heading is not null").withColumn("d", F.explode(dated_amounts("folded"))).withColumn("m", F.col("d")).withColumn("as_of", F.col("d.as_of"))
    per_share = F.col("heading").isin("nav_per_share", "investment_share_value")
    rows = rows.where((F.col("m.amount") > 0) & (~per_share | (F.col("m.amount") <= 100_000)))
    own = rows.select("fund", F.col("heading").alias("kind"), share_class("context").alias("share_class"), F.col("m.currency").alias("currency"), "as_of", F.col("m.amount").alias("value"), first_match("near", FREQUENCIES).alias("declared"), "source_id", "line_no")
    return cap(own, ["fund", "kind", "share_class", "currency", "as_of"], ["source_id", "line_no"], 1).drop("source_id", "line_no")


def claims(candidates: DataFrame, value: Column, scope: Column | int = 1, authority: Column | int = 3, rebuilt: Column | bool = False) -> DataFrame:
    """Candidates as claims for `operators.resolve`."""
    as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
    return candidates.select("fund", "field", value.alias("value"), as_column(rebuilt).alias("rebuilt"), as_column(authority).alias("authority"), as_column(scope).alias("scope"), "priority", F.lit(2).alias("evidence"), "score", "source_id", F.lit("unknown").alias("date_kind"), F.lit(None).cast("date").alias("date_value"))


def news_date(url: Column, title: Column) -> Column:
    """The day of a news item: from its address (the first of a month without a day), else from its title."""
    p = r"(?<!\d)(20\d{2})[/-](\d{1,2})(?:[/-](\d{1,2}))?(?!\d)"
    part = lambda k: F.regexp_extract(url, p, k)
    named = F.try_to_date(F.format_string("%s-%02d-%02d", part(1), F.coalesce(part(2).try_cast("int"), F.lit(0)), F.coalesce(part(3).try_cast("int"), F.lit(1))), "yyyy-MM-dd")
    return F.coalesce(F.when(part(1) != "", named), first_date(fold(title)))


def news(items: DataFrame, noise: list[str] = ("kontakt", "cookies", "gdpr", "login"), most: int = 25) -> DataFrame:
    """(fund, url, title, published_at) of links (fund, seq, url, title): the first of each address, newest first, at most `most`.

    Undated items come last; the cap is the feature's.
    """
    rows = items.where(~has_any(fold(F.concat_ws(" ", "url", "title")), list(noise)) & (F.trim("title") != ""))
    once = rows.groupBy("fund", "url").agg(F.min_by("title", "seq").alias("title")).withColumn("published_at", news_date(F.col("url"), F.col("title")))
    return cap(once, ["fund"], [F.desc(F.coalesce("published_at", F.lit("0001-01-01").cast("date"))), F.desc("title"), "url"], most)


def fields_in_long_form(candidates: list[DataFrame], display: dict[str, Column]) -> DataFrame:
    """(fund, field, value text, score, ...) of candidates of different fields, as claims whose value is its display form."""
    parts = [c.withColumn("value", display[f]) for c, f in zip(candidates, display)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
