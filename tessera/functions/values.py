"""Numbers, money, percentages and dates read from text, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import fold, once, text

#: Units of amounts, in folded spelling.
UNITS = {1e3: ["tis", "tisic"], 1e6: ["mil", "milion", "milionu", "million"], 1e9: ["mld", "miliarda", "miliard", "billion"]}
#: Units that a table's head declares; the first found holds.
DECLARED = [("v celych tis", 1e3), ("v tisicich", 1e3), ("v tis", 1e3), ("tis. kc", 1e3), ("v milionech", 1e6), ("v mil", 1e6), ("v miliardach", 1e9), ("v mld", 1e9)]
#: Fixed value: names of months, Czech genitive and English.
MONTHS = {"ledna": 1, "unora": 2, "brezna": 3, "dubna": 4, "kvetna": 5, "cervna": 6, "cervence": 7, "srpna": 8, "zari": 9, "rijna": 10, "listopadu": 11, "prosince": 12, "january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6, "july": 7, "august": 8, "september": 9, "october": 10, "november": 11, "december": 12}

#: A day in figures.
DAY = r"(?<!\d)\d{1,2}\.\s?\d{1,2}\.\s?(?:19|20)\d{2}(?!\d)"
MONEY = r"(\d[\d  .,]*\d|\d)\s*(tisic|tis|milionu|milion|million|mil|miliarda|miliard|mld|billion)?\.?\s*(kc|czk|eur|usd)(?![a-z])"


def number(x: Column | str) -> Column:
    """A number in Czech or English spelling: the last of two separators, and one not before three digits, is the decimal one."""
    return once(F.regexp_replace(text(x), r"[\s\u00a0]", ""), _number)


def _number(v: Column) -> Column:
    comma, dot = F.contains(v, F.lit(",")), F.contains(v, F.lit("."))
    last = lambda c: F.length(v) - F.instr(F.reverse(v), c)

    def one(c: str) -> Column:
        parts = F.split(v, "[.]" if c == "." else ",")
        grouped = (F.size(parts) > 2) | ((F.length(F.element_at(parts, -1)) == 3) & (F.length(F.element_at(parts, 1)) <= 3))
        return F.when(grouped, F.replace(v, F.lit(c), F.lit(""))).otherwise(F.replace(v, F.lit(c), F.lit(".")))

    both = F.when(last(",") > last("."), F.replace(F.replace(v, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).otherwise(F.replace(v, F.lit(","), F.lit("")))
    return F.when(comma & dot, both).when(comma, one(",")).when(dot, one(".")).otherwise(v).try_cast("double")


def multiplier(unit: Column | str) -> Column:
    """What a unit multiplies by; 1 for none or another."""
    u = F.coalesce(fold(unit), F.lit(""))
    out = F
    for k, (value, names) in enumerate(UNITS.items()):
        out = (F if k == 0 else out).when(u.isin(*names), value)
    return out.otherwise(1.0)


def declared_multiplier(folded: Column | str) -> Column:
    """The unit that a table's head declares, null without."""
    return F.coalesce(*[F.when(F.contains(text(folded), F.lit(m)), F.lit(v)) for m, v in DECLARED])


def currency(x: Column | str) -> Column:
    c = fold(x)
    return F.when(c.isin("kc", "czk"), "CZK").when(c == "eur", "EUR").when(c == "usd", "USD")


def amount(raw: Column, unit: Column) -> Column:
    """A number times its unit; before a unit a comma alone is always the decimal one."""
    m = multiplier(unit)
    decimal = F.replace(F.regexp_replace(raw, r"[\s ]", ""), F.lit(","), F.lit(".")).try_cast("double") * m
    return F.when((m > 1) & F.contains(raw, F.lit(",")) & ~F.contains(raw, F.lit(".")), decimal).otherwise(number(raw) * m)


def money(folded: Column | str) -> Column:
    """struct(amount, currency) of the first amount of money in folded text."""
    bare = F.regexp_replace(text(folded), DAY, ";")
    parts = F.struct(*[F.regexp_extract(bare, MONEY, k).alias(n) for k, n in ((1, "raw"), (2, "unit"), (3, "cur"))])
    return once(parts, lambda p: F.when(p["raw"] != "", F.struct(amount(p["raw"], p["unit"]).alias("amount"), currency(p["cur"]).alias("currency"))))


def dated_amounts(folded: Column | str) -> Column:
    """array of struct(as_of, amount, currency): each amount of a line with the last day before it."""
    parts = F.regexp_extract_all(text(folded), F.lit(rf"{DAY}(?:(?!{DAY}).)*"), 0)
    each = F.transform(parts, lambda t: F.struct(first_date(t).alias("as_of"), money(t).alias("m")))
    good = F.filter(each, lambda e: e["as_of"].isNotNull() & e["m"].isNotNull())
    return F.transform(good, lambda e: F.struct(e["as_of"].alias("as_of"), e["m"]["amount"].alias("amount"), e["m"]["currency"].alias("currency")))


def money_after(folded: Column | str, labels: list[str], reach: int = 60, negated: list[str] = ("neinvesticni", "neinvesticniho")) -> Column:
    """The first amount at most `reach` letters after one of the labels that no negating word stands before."""
    label = "|".join(sorted(labels, key=len, reverse=True))
    behind = "".join(rf"(?<!{n} )" for n in negated)
    near = F.regexp_extract_all(text(folded), F.lit(rf"(?<![a-z]){behind}(?:{label})(.{{0,{reach}}})"), 1)
    amounts = F.filter(F.transform(near, lambda t: money(t)), lambda m: m.isNotNull())
    return F.get(amounts, 0)


def months(count: Column, unit: Column) -> Column:
    """Months of a period in years or months."""
    return F.when(fold(unit).rlike("^(let|rok|year)"), count * 12).otherwise(count).cast("int")


def number_key(x: Column) -> Column:
    """The form in which two sources must agree on a number."""
    return F.bround(x, 6)


def money_key(value: Column, cur: Column) -> Column:
    return F.struct(F.bround(value, 2).alias("amount"), F.upper(cur).alias("currency"))


def whole_cell_number(cell: Column | str) -> Column:
    """struct(value, unit) of a cell that is one number with an optional sign, unit and percent sign."""
    pattern = r"^\s*([-+−–]?)\s*(\d[\d  .,]*)\s*(tis\.?|mil\.?|mld\.?|%|Kč|CZK|EUR|USD)?\s*$"
    part = lambda k: F.regexp_extract(text(cell), pattern, k)
    sign = F.when(part(1).isin("-", "−", "–"), -1.0).otherwise(1.0)
    day = part(2).rlike(r"^\d{1,2}\.\s?\d{1,2}\.\s?(?:19|20)\d{2}\s*$")
    return F.when((part(2) != "") & ~day, F.struct((sign * number(F.regexp_replace(part(2), "[.,]$", ""))).alias("value"), F.nullif(part(3), F.lit("")).alias("unit")))


def leading_percentage(cell: Column | str) -> Column:
    """The percentage that a cell begins with."""
    return F.nullif(F.replace(F.regexp_extract(text(cell), r"^\s*(\d{1,3}(?:[.,]\d+)?)\s*%", 1), F.lit(","), F.lit(".")), F.lit("")).try_cast("double")


def signed_percentages(line: Column | str, most: float = 300.0) -> Column:
    """All percentages of a line, with their signs, of at most `most` either way."""
    raw = F.regexp_extract_all(text(line), F.lit(r"([-+−–]?\s?\d{1,3}(?:[.,]\d+)?)\s*%"), 1)
    values = F.transform(raw, lambda r: F.replace(F.regexp_replace(F.regexp_replace(r, r"\s", ""), "[−–]", "-"), F.lit(","), F.lit(".")).try_cast("double"))
    return F.filter(values, lambda v: v.isNotNull() & (F.abs(v) <= most))


def numbers_in(x: Column | str) -> Column:
    """All numbers of a text, groups of three digits joined."""
    joined = F.regexp_replace(text(x), r"(?<=\d)[    '](?=\d{3}(?!\d))", "")
    return F.transform(F.regexp_extract_all(joined, F.lit(r"\d+(?:[.,]\d+)?"), 0), lambda n: F.replace(n, F.lit(","), F.lit(".")).cast("double"))


SCALES = [1.0, 100.0, 1e3, 1e6, 1e9, 0.01]


def supports(quote: Column | str, value: Column, tolerance: float = 0.005) -> Column:
    """Whether a quote holds the value at some scale, within half a percent; zero needs a zero."""
    near = F.exists(numbers_in(quote), lambda n: F.exists(F.array(*map(F.lit, SCALES)), lambda s: F.abs(n - value / s) <= F.abs(value / s) * tolerance))
    return F.when(value == 0, F.contains(text(quote), F.lit("0"))).otherwise(near)


def confidence(score: Column) -> Column:
    return F.when(score >= 145, "high").when(score >= 105, "medium").otherwise("low")


# --- dates


def safe_date(y: Column, m: Column, d: Column) -> Column:
    """A date, null if there is none such."""
    return F.try_to_date(F.format_string("%04d-%02d-%02d", y, m, d), "yyyy-MM-dd")


def first_date(folded: Column | str) -> Column:
    """The first ISO date, else day.month.year, else day and month's name. One that is no real day gives null, not the next form."""
    return once(text(folded), _first_date)


def _first_date(x: Column) -> Column:
    num = lambda p, k: F.regexp_extract(x, p, k).try_cast("int")
    iso, dmy, named = r"(20\d{2})-(\d{1,2})-(\d{1,2})", r"(\d{1,2})\.\s?(\d{1,2})\.\s?(20\d{2})", rf"(\d{{1,2}})\.?\s+({'|'.join(MONTHS)})\s+(20\d{{2}})"
    month = F.try_element_at(F.create_map(*[F.lit(v) for kv in MONTHS.items() for v in kv]), F.regexp_extract(x, named, 2))
    return (
        F.when(x.rlike(iso), safe_date(num(iso, 1), num(iso, 2), num(iso, 3)))
        .when(x.rlike(dmy), safe_date(num(dmy, 3), num(dmy, 2), num(dmy, 1)))
        .when(x.rlike(named), safe_date(num(named, 3), month, num(named, 1)))
        .otherwise(F.lit(None).cast("date"))
    )


def labelled_date(folded: Column | str, label: str) -> Column:
    """The date that follows a label."""
    return first_date(F.regexp_extract(text(folded), rf"(?:{label})[^0-9]{{0,30}}(\d.{{0,24}})", 1))


def document_dates(folded: Column | str, url: Column | str) -> Column:
    """struct of a document's dates: effective, published, as of, and its reporting period."""
    x = text(folded)
    effective = labelled_date(x, "ucinn[yae] od|ucinnost|effective (?:from|as of)")
    published = labelled_date(x, "vyhotoveno|zverejneno|published|vydano")
    as_of = labelled_date(x, "udaje k|ke dni|stav k|as of|as at")
    span = r"(?:za obdobi )?od (\d{1,2}\.\s?\d{1,2}\.\s?20\d{2}) do (\d{1,2}\.\s?\d{1,2}\.\s?20\d{2})"
    year = F.regexp_extract(x, r"(?:za rok|rok|year)\s+(20\d{2})", 1).try_cast("int")
    in_name = F.regexp_extract(text(url), r"(?<!\d)(20\d{2})(?!\d)[^/]*$", 1).try_cast("int")
    end = F.coalesce(first_date(F.regexp_extract(x, span, 2)), safe_date(year, F.lit(12), F.lit(31)), safe_date(in_name, F.lit(12), F.lit(31)))
    start = F.coalesce(first_date(F.regexp_extract(x, span, 1)), safe_date(year, F.lit(1), F.lit(1)))
    return F.struct(effective.alias("effective"), published.alias("published"), as_of.alias("as_of"), start.alias("period_start"), end.alias("period_end"), (year.isNotNull() & ~x.rlike(span)).alias("derived"))


def information_date(dates: Column) -> Column:
    """struct(kind, value): the first of a document's dates that is there."""
    order = [("as_of", "as_of"), ("reporting_period_end", "period_end"), ("effective_at", "effective"), ("published_at", "published")]
    kind = F.coalesce(*[F.when(dates[c].isNotNull(), F.lit(k)) for k, c in order], F.lit("unknown"))
    return F.struct(kind.alias("kind"), F.coalesce(*[dates[c] for _, c in order]).alias("value"))


def fee_tiers(folded: Column | str) -> Column:
    """Tiers of a fee by holding period: array of struct(from_month, to_month, rate), in order of from_month."""
    x = text(folded)
    n = r"(\d{1,2}(?:[.,]\d+)?)"
    unit = r"(rok[uy]?|let(?:ech)?|mesic\w*)"
    dash = r"\s*[-–:]?\s*"
    rate = lambda s: F.replace(s, F.lit(","), F.lit(".")).cast("double")
    tier = lambda a, b, r: F.struct(a.cast("int").alias("from_month"), b.cast("int").alias("to_month"), r.alias("rate"))

    def all_of(pattern: str, build) -> Column:
        return F.transform(F.regexp_extract_all(x, F.lit(pattern), 0), lambda m: build(lambda k: F.regexp_extract(m, pattern, k)))

    none = F.lit(None).cast("int")
    spans = all_of(rf"od {n} do {n} {unit}{dash}{n}\s*%", lambda g: tier(months(rate(g(1)), g(3)), months(rate(g(2)), g(3)), rate(g(4))))
    up_to = all_of(rf"(?<!\d )do {n} {unit}{dash}{n}\s*%", lambda g: tier(F.lit(0), months(rate(g(1)), g(2)), rate(g(3))))
    after = all_of(rf"po {n} {unit}{dash}{n}\s*%", lambda g: tier(months(rate(g(1)), g(2)), none, rate(g(3))))
    rate_up_to = all_of(rf"{n}\s*% (?:pri odkupu )?do {n} {unit}", lambda g: tier(F.lit(0), months(rate(g(2)), g(3)), rate(g(1))))
    rate_after = all_of(rf"{n}\s*% po {n} {unit}", lambda g: tier(months(rate(g(2)), g(3)), none, rate(g(1))))
    rate_first = F.concat(rate_up_to, rate_after)
    period_first = F.concat(spans, up_to, after)
    return F.array_sort(F.when(F.size(rate_first) > 0, rate_first).otherwise(period_first))


def fee(folded: Column | str) -> Column:
    """struct(rate, maximum, amount, currency, negotiated) of a fee's line: a range, a rate, free, money, or by agreement."""
    x = text(folded)
    n = r"(\d{1,2}(?:[.,]\d+)?)"
    rate = lambda p, k=1: F.nullif(F.replace(F.regexp_extract(x, p, k), F.lit(","), F.lit(".")), F.lit("")).try_cast("double")
    upper = F.coalesce(rate(rf"{n}\s*%\s*(?:-|az|do)\s*{n}\s*%", 2), rate(rf"{n}\s*(?:-|az)\s*{n}\s*%", 2))
    facts = F.struct(upper.alias("upper"), rate(rf"{n}\s*%").alias("one"), x.rlike("zdarma|bez poplatku|neuctuje|free of charge").alias("free"))

    def read(f: Column) -> Column:
        stated = F.coalesce(f["upper"], f["one"])
        top = f["upper"].isNotNull() | x.rlike(r"max\.|maximaln|nejvyse|az do|up to|\bdo \d")

        def priced(paid: Column) -> Column:
            other = stated.isNull() & ~f["free"]
            return F.struct(
                F.coalesce(stated, F.when(f["free"], F.lit(0.0))).alias("rate"), (top & stated.isNotNull()).alias("maximum"), F.when(other, paid["amount"]).alias("amount"),
                F.when(other, paid["currency"]).alias("currency"), (other & paid.isNull() & x.rlike("dohod|individualn|negotiat")).alias("negotiated"),
            )

        return once(F.when(stated.isNull(), money(x)), priced)

    return once(facts, read)
