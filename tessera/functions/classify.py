"""Classifiers over folded text: tables of labels, and three ways of matching them."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .labels import *  # noqa: F403
from .labels import (
    CAPITAL_METRICS, CLOSE, COMPONENTS, DOCUMENT_TYPES, HORIZON_MINIMUM, LEAST, MANAGER_LEVEL, NOT_PUBLISHED, PERIOD_END, REFINEMENTS, SIGNAL_WEIGHTS, STATUTORY,
    STRONG, WEAK,
)
from .text import has_any, once, text

def first_match(folded: Column | str, labels: dict[str, list[str]]) -> Column:
    """The first kind of which text holds a word, null without."""
    return F.coalesce(*[F.when(has_any(folded, words), F.lit(kind)) for kind, words in labels.items()])


def nearest_label(folded: Column | str, labels: dict[str, list[str]]) -> Column:
    """The kind whose word stands last in text; of words that end together the longest, of equal ones the kind listed first."""
    rows = [(kind, word, k) for k, (kind, words) in enumerate(labels.items()) for word in words]
    table = F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(word).alias("word"), F.lit(word[::-1]).alias("back"), F.lit(len(word)).alias("size"), F.lit(-k).alias("order")) for kind, word, k in rows])
    x = text(folded)
    some = F.struct(x.alias("x"), F.reverse(x).alias("back"), F.length(x).alias("n"))

    def nearest(s: Column) -> Column:
        there = F.filter(table, lambda r: F.contains(s["x"], r["word"]))
        placed = F.transform(there, lambda r: F.struct((s["n"] - F.position(r["back"], s["back"]) - r["size"] + 1).alias("at"), r["size"].alias("size"), r["order"].alias("order"), r["kind"].alias("kind")))
        return F.array_max(placed)["kind"]

    return once(some, nearest)


def capital_metric(folded: Column | str) -> Column:
    return nearest_label(folded, CAPITAL_METRICS)


def refined_capital_metric(metric: Column, line: Column, context: Column) -> Column:
    """A metric after what stands around it: the manager's, the statutory minimum, or the fund's own."""
    return F.when(has_any(line, MANAGER_LEVEL), "manager_aum").when(has_any(line, STATUTORY), "statutory_minimum_capital").when((metric == "assets_under_management") & has_any(context, MANAGER_LEVEL), "manager_aum").otherwise(metric)


def aum_metric(folded: Column | str) -> Column:
    """The metric a window names, else assets in total where it speaks of assets, else the fund's AUM."""
    x = text(folded)
    return F.coalesce(capital_metric(x), F.when(F.contains(x, F.lit("aktiva")) | F.contains(x, F.lit("fund assets")), "assets_total"), F.lit("fund_aum"))


def horizon_kind(folded: Column | str) -> Column:
    return F.when(has_any(folded, HORIZON_MINIMUM), "minimum").otherwise("exact")


def annualization(folded: Column | str) -> Column:
    x = text(folded)
    return F.when(x.rlike(r"p\. ?a\.|rocne|per annum|annually|per year"), "per_annum").when(has_any(x, ["kumulativn", "cumulative", "celkem za"]), "cumulative").when(has_any(x, ["za obdobi", "for the period"]), "period").otherwise("unknown")


def negated(folded: Column, start: Column, words: list[str] = COMPONENTS) -> Column:
    """Whether one of the words stands right before place `start` (from 0) of text."""
    lead = F.rtrim(F.substr(folded, F.greatest(start - 39, F.lit(1)), F.least(start, F.lit(40))))
    out = F.lit(False)
    for w in words:
        out = out | F.endswith(lead, F.lit(w))
    return out


def vote(signals: dict[str, Column], types: dict[str, tuple] = DOCUMENT_TYPES, refines: list[tuple[str, str]] = REFINEMENTS) -> Column:
    """struct(kind, score, second, ambiguous): each type's keywords weigh what their signal weighs.

    types: strong and weak keywords, and maybe pairs of words and words that keep a signal from counting
    for the type. A type needs LEAST points; one whose runner-up is within CLOSE is ambiguous, unless one
    of the two refines the other.
    """
    scores = []
    for k, (kind, (strong, weak, *more)) in enumerate(types.items()):
        pairs, excluded = (more + [[], []])[:2]
        total = F.lit(0)
        for name, x in signals.items():
            x = F.coalesce(x, F.lit(""))
            hits = [F.when(F.contains(x, F.lit(w)), p).otherwise(0) for words, p in ((strong, STRONG), (weak, WEAK)) for w in words]
            hits += [F.when(F.contains(x, F.lit(a)) & F.contains(x, F.lit(b)), WEAK).otherwise(0) for a, b in pairs]
            points = sum(hits, F.lit(0))
            total = total + SIGNAL_WEIGHTS[name] * (F.when(has_any(x, excluded), 0).otherwise(points) if excluded else points)
        scores.append(F.struct(total.alias("score"), F.lit(-k).alias("order"), F.lit(kind).alias("kind")))

    def decided(ranked: Column) -> Column:
        first, other = F.get(ranked, 0), F.get(ranked, 1)
        second = F.coalesce(other["score"], F.lit(0))
        refined = reduce(or_, ((first["kind"] == a) & (other["kind"] == b) for a, b in refines), F.lit(False))
        named = first["score"] >= LEAST
        close = named & (second > 0) & ~F.coalesce(refined, F.lit(False)) & (first["score"] - second < CLOSE)
        return F.struct(F.when(named, first["kind"]).alias("kind"), first["score"].alias("score"), second.alias("second"), close.alias("ambiguous"))

    return once(F.sort_array(F.array(*scores), asc=False), decided)


def document_type(signals: dict[str, Column]) -> Column:
    """The type of a document by all its signals; `other` where none has points enough."""
    return F.coalesce(vote(signals)["kind"], F.lit("other"))


def no_published_return(folded: Column | str) -> Column:
    """Whether a source says that it publishes no target return."""
    return has_any(folded, NOT_PUBLISHED)


def period_end_date(folded: Column | str, dates: Column) -> Column:
    """The end of the document's reporting period where a line dates its value by naming that period; else null."""
    return F.when(has_any(folded, PERIOD_END), dates["period_end"])
