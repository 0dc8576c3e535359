"""All fields of all funds from their documents in one reading.

One pass over pages finds, by one automaton over the words of all fields, the lines worth reading, and
hands them out with their context, the headings they stand under, and whose section they are in, equal
ones of a batch of pages once. Extractors run on these lines only, each on those that hold its own words; candidates of all
fields make one long table, and one contest settles every key of every field: a field's single
value, each kind of fee, each point of a series.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.classify import CAPITAL_METRICS, HISTORICAL_VALUES, PER_SHARE, RETURN_SERIES, RETURN_TYPES, aum_metric, capital_metric, first_match, no_published_return, refined_capital_metric
from ..functions.labels import NAME_NOISE, NOT_PUBLISHED, PAST_RETURN
from ..functions.text import company_key, cut_party_name, fold_aligned, has_any, once, registration_number, share_class, words
from ..functions.values import dated_amounts, fee, first_date, money, money_after
from ..operators import mentions, resolve
from ..operators.lines import years_and_rates
from .extraction import COMPANY, FEES, FUND_LABELS, PRIORITIES, horizon_in, minimum_in, priority, target_in

#: Fields of one value, fields of one value a key, and series of points.
SINGLE = ["investment_horizon", "minimum_investment", "target_return", "assets_under_management", "manager", "administrator"]
KEYED = ["fees"]
SERIES = ["aum_history", "annual_returns", "historical_values"]
FIELDS = SINGLE + KEYED + SERIES
#: Lines that a heading is remembered for.
MEMORY = 12
#: Whose lines may speak for a fund, and how much that is worth to the contest.
SCOPES = {"exact_fund": 2, "share_class": 1}

#: Words without which a field's pattern can't match: what the automaton looks for. A word may run over a line's end.
WORDS = {
    "investment_horizon": ["doporucen", "investicni horizont", "minimalni doba investice", "recommended holding period", "investment horizon"],
    "minimum_investment": ["minimalni", "nejnizsi", "minimum", "pocatecni", "initial"],
    "target_return": [
        "cilova", "cilovy", "cilena", "cileny", "ocekavana", "ocekavany", "predpokladana", "predpokladany", "prednostn", "prioritn", "preferencn", "garantovan", "zarucen", "minimaln",
        "target", "expected", "anticipated", "preferred", "priority", "guaranteed", "minimum", "hurdle", *NOT_PUBLISHED,
    ],
    "fees": [w for own in FEES.values() for w in own],
    "assets_under_management": FUND_LABELS,
    "manager": ["obhospodarovatel", "investicni spolecnost", "manager"],
    "administrator": ["administrator"],
    "aum_history": [w for own in CAPITAL_METRICS.values() for w in own],
    "annual_returns": [w for own in RETURN_SERIES.values() for w in own],
    "historical_values": [w for own in HISTORICAL_VALUES.values() for w in own],
}
ROLE_LABELS = {"manager": "obhospodařovatel|obhospodarovatel|investiční společnost|investicni spolecnost|manager", "administrator": "administrátor fondu|administrátor|administrator"}


def _machine():
    """The automaton: word -> (bits of its fields, kind of return heading, kind of value heading); kinds by their place, -1 for none."""
    import ahocorasick

    found: dict[str, list[int]] = {}
    for bit, field in enumerate(FIELDS):
        for w in WORDS[field]:
            found.setdefault(w, [0, -1, -1])[0] |= 1 << bit
    for place, table in ((1, RETURN_SERIES), (2, HISTORICAL_VALUES)):
        for k, own in enumerate(table.values()):
            for w in own:
                if found[w][place] < 0:
                    found[w][place] = k
    out = ahocorasick.Automaton()
    for w, value in found.items():
        out.add_word(w, (len(w), *value))
    out.make_automaton()
    return out


def scope_at(start: int, named: list[tuple[int, bool]], title: bool) -> str:
    """Whose a place is: of the fund named last before it, else of the title's if the page names no other, else nobody's."""
    last = None
    for at, own in named:
        if at > start:
            break
        last = own
    if last is not None:
        return "exact_fund" if last else "another_fund"
    others = any(not own for _, own in named)
    return "exact_fund" if title and not others else "multi_fund" if others else "unknown"


def _lines_of(machine, text: str, folded: str, named: list[tuple[int, bool]], title: bool, memory: int):
    """Rows (line_no, line, context, folded, near, near_bits, line_bits, return_heading, value_heading, scope) of a page's lines worth reading."""
    raw, flat, starts, at = [], [], [], 0
    for line, own in zip(text.split("\n"), folded.split("\n")):
        if kept := line.strip():
            raw.append(kept)
            flat.append(" ".join(own.replace("ß", "ss").split()))
            starts.append(at + len(own) - len(own.lstrip()))
        at += len(own) + 1
    n = len(raw)
    near_bits, line_bits, returns, values = [0] * n, [0] * n, [-1] * n, [-1] * n
    ends, place = [], 0
    for own in flat:
        place += len(own) + 1
        ends.append(place)  # of each line and the blank behind it, in the joined text
    line_of = 0
    for last, (size, bits, back, value) in machine.iter(" ".join(flat)):
        while ends[line_of] <= last:
            line_of += 1
        first = line_of
        while first and ends[first - 1] > last - size + 1:
            first -= 1
        for k in range(max(0, line_of - 1), min(n, first + 2)):
            near_bits[k] |= bits
        if first == line_of:
            line_bits[line_of] |= bits
            for kinds, own in ((returns, back), (values, value)):
                if own >= 0 and (kinds[line_of] < 0 or own < kinds[line_of]):
                    kinds[line_of] = own
    heads = [-1, -1]
    since = [0, 0]
    for k in range(n):
        for which, kinds in enumerate((returns, values)):
            if kinds[k] >= 0:
                heads[which], since[which] = kinds[k], k
            elif k - since[which] > memory:
                heads[which] = -1
        under = max(heads) >= 0 and any(c.isdigit() for c in flat[k])
        if near_bits[k] or under:
            around = slice(max(0, k - 1), k + 2)
            yield k, raw[k], " ".join(raw[around]), flat[k], " ".join(flat[around]), near_bits[k], line_bits[k], heads[0], heads[1], scope_at(starts[k], named, title)


WINDOW = "line string, context string, folded string, near string, near_bits long, line_bits long, return_heading integer, value_heading integer, page_scope string"


def windows_worth_reading(pages: DataFrame, memory: int = MEMORY) -> DataFrame:
    """Different windows of `lines_worth_reading`, each with `places`: where it stands, (line_no and what pages have beside their texts).

    Windows that are the same in all that extractors see are one row for each batch of pages, so that what documents
    have in common is read once for all of them.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    kept = [c for c in pages.columns if c not in ("text", "title", "fund_name")]
    own = F.filter(words("fund_name"), lambda w: ~w.isin(NAME_NOISE) & (F.length(w) >= 2))
    rows = pages.withColumn("__own", own).select(
        *kept, F.col("text").alias("__text"), fold_aligned("text").alias("__folded"), "__own",
        F.coalesce((F.size("__own") > 0) & F.contains(F.array_join(words("title"), " "), F.array_join("__own", " ")), F.lit(False)).alias("__title"),
    )
    place = pages.select(*kept).schema.add("line_no", "integer")
    schema = T.StructType().add("places", T.ArrayType(place))
    for part in WINDOW.split(", "):
        schema = schema.add(*part.split(" "))
    arrow = to_arrow_schema(schema)
    machine = pages.sparkSession.sparkContext.broadcast(_machine())  # the words of the fields

    def read(batches):
        for batch in batches:
            texts, flats, owns, titles = (batch.column(len(kept) + k).to_pylist() for k in range(4))
            found: dict[tuple, list[tuple[int, int]]] = {}
            for k, text in enumerate(texts):
                if text:
                    own = owns[k]
                    named = [(start, bool(own) and tokens[-len(own) :] == own) for tokens, start, _ in mentions.named_before_forms(flats[k])]
                    for line_no, *window in _lines_of(machine.value, text, flats[k], named, titles[k], memory):
                        found.setdefault(tuple(window), []).append((k, line_no))
            at = [p for places in found.values() for p in places]
            took = batch.take(pa.array([k for k, _ in at], pa.int64()))
            inner, ends = arrow.field("places").type.value_type, [0, *accumulate(map(len, found.values()))]
            places = pa.StructArray.from_arrays([*[took.column(k) for k in range(len(kept))], pa.array([n for _, n in at], pa.int32())], fields=list(inner))
            columns = zip(*found) if found else [[]] * (len(arrow) - 1)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends, pa.int32()), places).cast(arrow.field("places").type), *[pa.array(c, arrow.field(k).type) for k, c in enumerate(columns, 1)]], schema=arrow)

    return rows.mapInArrow(read, schema)


def lines_worth_reading(pages: DataFrame, memory: int = MEMORY) -> DataFrame:
    """Lines of pages (fund, fund_name, source_id, document_type, page, title, text, and whatever else) in which some field's words stand.

    One reading, and work in proportion to it: each line's context are the lines beside it, headings are
    remembered for `memory` lines, page_scope is whose line it is. Null texts have no lines.
    """
    found = windows_worth_reading(pages, memory)
    return found.select(F.explode("places").alias("p"), *found.columns[1:]).select("p.*", *found.columns[1:])


CLAIM = "struct<field:string,point:string,low:double,high:double,word:string,bonus:int>"


def candidates(windows: DataFrame, newest: int) -> DataFrame:
    """All fields' candidates of windows, at each of their places: one long table (field, point, low, high, word, score, priority, ...), in one projection.

    point: what must be equal for two candidates to be rivals (a kind, a class, a day, a currency). low, high and
    word: the value. newest: the year at which figures of assets are fresh. A line that says that no return is published gives
    a row whose field is empty.
    """
    near, line = F.col("near"), F.col("folded")
    holds = lambda field, bits="near_bits": F.col(bits).bitwiseAND(F.lit(1 << FIELDS.index(field))) != 0
    heading = lambda c, table: F.get(F.array(*map(F.lit, table)), F.when(F.col(c) >= 0, F.col(c)))
    klass = F.coalesce(share_class("context"), F.lit(""))
    none = F.lit(None).cast("double")

    def claim(field: str | Column, point: Column, low: Column, high: Column = none, word: Column | None = None, bonus: Column | int = 70) -> Column:
        as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
        return F.struct(as_column(field).alias("field"), point.alias("point"), low.cast("double").alias("low"), high.cast("double").alias("high"), (F.lit(None).cast("string") if word is None else word).alias("word"), as_column(bonus).cast("int").alias("bonus"))

    def one(field: str, found: Column, build, bits: str = "near_bits") -> Column:
        """At most one claim: found is only evaluated on lines that hold the field's words."""
        return F.filter(F.transform(F.array(F.when(holds(field, bits), found)), lambda v: F.when(v.isNotNull(), build(v))), lambda c: c.isNotNull())

    text_of = lambda *parts: F.concat_ws("|", *parts)
    day_near = first_date(near)
    assets = F.when(~has_any(near, PER_SHARE) & day_near.isNotNull(), F.struct(money_after(near, FUND_LABELS).alias("m"), aum_metric(near).alias("metric"), day_near.alias("day")))
    fresh = lambda day: F.greatest(F.lit(0), F.least(F.lit(50), 50 - 10 * (newest - F.year(day))))
    own_fee = F.struct(first_match(line, FEES).alias("kind"), fee(line).alias("fee"))
    metric = refined_capital_metric(capital_metric(line), line, near)
    history = F.when(~has_any(line, PER_SHARE), F.struct(metric.alias("metric"), money(line).alias("m"), first_date(F.concat_ws(" ", line, near)).alias("day")))

    def party(role: str) -> Column:
        rest = F.regexp_extract("context", rf"(?iu)(?:{ROLE_LABELS[role]})[^\p{{L}}]{{1,5}}(.{{0,120}})", 1)
        return F.when(rest != "", F.struct(cut_party_name(F.regexp_extract(rest, COMPANY, 1)).alias("name"), registration_number(F.regexp_extract(rest, r"I[ČC]O?:?\s*([\d ]{8,11})", 1)).alias("ico")))

    some = lambda c, when: F.when(when, c).otherwise(F.array().cast(f"array<{CLAIM}>"))
    pairs = F.filter(years_and_rates(line), lambda p: F.abs(p["rate"]) <= 300.0)
    told = has_any(line, PAST_RETURN) | (F.size(F.split(line, " ")) <= 20)
    series, kind = heading("return_heading", RETURN_SERIES), heading("value_heading", HISTORICAL_VALUES)
    per_share = kind.isin("nav_per_share", "investment_share_value")
    values = F.filter(dated_amounts(line), lambda v: (v["amount"] > 0) & (~per_share | (v["amount"] <= 100_000)))
    every = F.concat(
        one("investment_horizon", horizon_in(near), lambda v: claim("investment_horizon", F.lit(""), v["years"], word=v["kind"], bonus=v["bonus"])),
        one("minimum_investment", minimum_in(near), lambda v: claim("minimum_investment", text_of(v["kind"], klass), v["amount"], word=v["currency"])),
        one("target_return", target_in(near), lambda v: claim("target_return", text_of(v["type"], klass), F.coalesce(v["low"], v["exact"]), v["high"], v["annualization"], v["bonus"])),
        one("fees", own_fee, lambda v: F.when(v["kind"].isNotNull() & (v["fee"]["rate"].isNotNull() | v["fee"]["amount"].isNotNull() | v["fee"]["negotiated"]), claim("fees", v["kind"], v["fee"]["rate"], v["fee"]["amount"], F.when(v["fee"]["negotiated"], "negotiated").otherwise(v["fee"]["currency"]), 60)), "line_bits"),
        one("assets_under_management", assets, lambda v: F.when(v["m"].isNotNull(), claim("assets_under_management", text_of(v["metric"], v["m"]["currency"], v["day"].cast("string")), v["m"]["amount"], word=v["m"]["currency"], bonus=60 + fresh(v["day"])))),
        one("target_return", F.when(no_published_return(near) & (F.col("page_scope") == "exact_fund"), F.lit(1)), lambda v: claim("", F.lit(""), none)),
        *[one(role, party(role), lambda v, role=role: F.when(v["name"].isNotNull(), claim(role, F.lit(""), none, none, company_key(v["name"])))) for role in ("manager", "administrator")],
        one("aum_history", history, lambda v: F.when(v["metric"].isNotNull() & v["m"].isNotNull() & v["day"].isNotNull(), claim("aum_history", text_of(v["metric"], v["m"]["currency"], v["day"].cast("string")), v["m"]["amount"], word=v["m"]["currency"], bonus=0)), "line_bits"),
        some(F.transform(pairs, lambda p: claim("annual_returns", text_of(p["year"].cast("string"), series, klass), p["rate"], bonus=0)), (F.col("return_heading") >= 0) & told),
        some(F.transform(values, lambda v: claim("historical_values", text_of(kind, klass, v["currency"], v["as_of"].cast("string")), v["amount"], word=v["currency"], bonus=0)), F.col("value_heading") >= 0),
    )
    ranked = windows.withColumn("scope", scope_rank(F.col("page_scope"), F.col("context")))  # here, where equal windows are one row
    claimed = ranked.withColumn("c", F.explode_outer(every)).where("c IS NOT NULL")  # outer: for the other, Spark evaluates the array once more, to filter by its size
    rows = claimed.withColumn("place", F.explode("places"))
    worth = reduce(lambda out, f: out.when(F.col("c.field") == f, priority(f, F.col("place.document_type"))), [f for f in PRIORITIES if f != "fees"], F.when(F.col("c.field") == "fees", priority("fees", F.col("place.document_type"))))
    worth = worth.otherwise(priority("assets_under_management", F.col("place.document_type")))
    return rows.select("place.*", "page_scope", "scope", "c.field", "c.point", "c.low", "c.high", "c.word", (worth + F.col("c.bonus")).cast("int").alias("score"), worth.alias("priority"), F.col("context").alias("quote"))


def scope_rank(page_scope: Column, quote: Column) -> Column:
    """What a line's scope is worth to the contest, one that names a share class of the fund less than the fund's own; 0: it may not speak for the fund."""
    scope = F.when((page_scope == "exact_fund") & share_class(quote).isNotNull(), "share_class").otherwise(page_scope)
    return once(scope, lambda s: reduce(lambda out, kv: out.when(s == kv[0], kv[1]), list(SCOPES.items())[1:], F.when(s == next(iter(SCOPES)), next(iter(SCOPES.values())))).otherwise(0))


def as_claims(found: DataFrame) -> DataFrame:
    """Candidates with the facts of `operators.resolve`; those of nobody's or another's section have scope 0. What found has of the facts stays."""
    evidence = F.when(F.trim("quote") == "", 0).otherwise(2)
    facts = {"scope": scope_rank(F.col("page_scope"), F.col("quote")), "evidence": evidence, "rebuilt": F.lit(False), "authority": F.lit(3), "date_kind": F.lit("unknown"), "date_value": F.lit(None).cast("date")}
    return found.withColumns({k: v for k, v in facts.items() if k not in found.columns})


def settle(claims: DataFrame) -> DataFrame:
    """(fund, field, point, low, high, word, outcome, decided_by, n_values, n_claims, source_id, page, line_no, quote) of accepted claims.

    A field of one value is contested by what claims the same as its strongest claim; keyed fields and series at
    each of their points. The evidence is the strongest claim of the value that won; without a winner value and evidence are null.
    """
    accepted = claims.where("scope > 0")
    single = F.col("field").isin(SINGLE)
    order = F.struct("scope", "score", "source_id", (-F.col("page")).alias("page"), (-F.col("line_no")).alias("line"), "point")
    leading = accepted.where(single).groupBy("fund", "field").agg(F.max_by("point", order).alias("point"))
    rivals = accepted.where(single).join(leading, ["fund", "field", "point"], "left_semi").unionByName(accepted.where(~single))
    value = ["low", "high", "word"]
    won = resolve.resolve(rivals, ["fund", "field", "point"], value)
    place = F.struct("source_id", "page", "line_no", "quote")
    strongest = F.struct(resolve.strength().alias("s"), (-F.col("page")).alias("p"), (-F.col("line_no")).alias("l"))
    shown = rivals.groupBy("fund", "field", "point", *value).agg(F.max_by(place, strongest).alias("e")).alias("x")
    same = [F.col(f"w.{c}").eqNullSafe(F.col(f"x.{c}")) for c in ("fund", "field", "point", *value)]
    settled = won.alias("w").join(shown, reduce(lambda a, b: a & b, same) & (F.col("w.outcome") != "unresolved"), "left")
    return settled.select("w.*", "x.e.*")


def all_fields(pages: DataFrame, funds: DataFrame, newest: int, memory: int = MEMORY) -> tuple[DataFrame, DataFrame]:
    """(states (fund, field, status, n_points, n_unresolved, n_candidates, n_refused), values as `settle` gives them).

    pages: fund, fund_name, source_id, document_type, page, title, text, and facts of their documents (rebuilt, authority,
    date_kind, date_value) where known; funds: fund. Each fund has a state for each field: found, conflicting (no point
    won), scope_unconfirmed (claims stand in others' or nobody's sections only), not_publicly_disclosed (a source says
    that no return is published, and no claim was accepted or refused), or not_found. Text is read once; its candidates are written.
    """
    held = candidates(windows_worth_reading(pages, memory), newest).checkpoint()
    claims = as_claims(held.where("field <> ''"))
    values = settle(claims)
    told = held.where("field = ''").select("fund").distinct().withColumn("field", F.lit("target_return")).withColumn("told", F.lit(True))
    counts = claims.groupBy("fund", "field").agg(F.count_if(F.col("scope") > 0).alias("n_candidates"), F.count_if(F.col("scope") <= 0).alias("n_refused"))
    points = values.groupBy("fund", "field").agg(F.count_if(F.col("outcome") != "unresolved").alias("n_points"), F.count_if(F.col("outcome") == "unresolved").alias("n_unresolved"))
    grid = funds.select("fund", F.explode(F.array(*map(F.lit, FIELDS))).alias("field"))
    states = grid.join(counts, ["fund", "field"], "left").join(points, ["fund", "field"], "left").join(told, ["fund", "field"], "left").fillna(0, ["n_candidates", "n_refused", "n_points", "n_unresolved"])
    status = (
        F.when(F.col("n_points") > 0, "found").when(F.col("n_unresolved") > 0, "conflicting").when(F.col("n_refused") > 0, "scope_unconfirmed")
        .when(F.col("told"), "not_publicly_disclosed").otherwise("not_found")
    )
    return states.select("fund", "field", status.alias("status"), "n_points", "n_unresolved", "n_candidates", "n_refused"), values
