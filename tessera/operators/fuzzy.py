"""Best fuzzy match of names against a catalogue."""

from __future__ import annotations

from difflib import SequenceMatcher
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import CATALOGUE_GENERIC
from ..functions.text import distinctive_tokens, entity_key, words


@F.arrow_udf(T.DoubleType())
def sequence_ratio(a: pa.Array, b: pa.Array) -> pa.Array:
    """Twice the letters of matching blocks over all letters; no built-in function has it."""
    return pa.array([SequenceMatcher(None, x or "", y or "", autojunk=False).ratio() for x, y in zip(a.to_pylist(), b.to_pylist())])


class Profile(NamedTuple):
    """What a catalogue's match is worth, and how much it needs (for names of one token: `single`)."""

    cover: float
    back: float
    ratio: float
    inside: float  # our key within theirs
    either: bool = False  # or theirs within ours
    held: float = 0.0  # all our tokens among theirs
    holds: float = 0.0  # all theirs among ours
    least: float = 0.74
    single: float = 0.74
    prefix: bool = False  # the one token of a name must begin the entry's key
    equal: bool = True  # equal keys are worth 1
    spaced: bool = True  # keys keep the blanks between words


#: Fixed values of the catalogues.
MANAGER = Profile(0.55, 0.15, 0.22, 0.16, either=True, least=0.72, single=0.9, equal=False, spaced=False)
AMISTA = Profile(0.55, 0.15, 0.22, 0.0, held=0.16, holds=0.08, least=0.72, single=0.9, prefix=True)
BHS = Profile(0.58, 0.17, 0.25, 0.12)
POROVNEJFONDY = Profile(0.58, 0.17, 0.25, 0.12, single=0.88, prefix=True)
#: Share of our tokens that must be covered.
COVER = 0.66


def score(own: Column, own_key: Column, theirs: Column, their_key: Column, p: Profile = MANAGER) -> Column:
    """Points of a pair of names by their tokens and keys; 0 below COVER of our tokens."""
    common = F.size(F.array_intersect(own, theirs))
    cover = F.coalesce(F.try_divide(common, F.size(own)), F.lit(0.0))
    back = F.coalesce(F.try_divide(common, F.size(theirs)), F.lit(0.0))
    held = F.contains(their_key, own_key) | F.contains(own_key, their_key) if p.either else F.contains(their_key, own_key)
    total = p.cover * cover + p.back * back + p.ratio * sequence_ratio(own_key, their_key) + F.when(held, p.inside).otherwise(0.0)
    total = total + F.when(common == F.size(own), p.held).otherwise(0.0) + F.when(common == F.size(theirs), p.holds).otherwise(0.0)
    out = cover < COVER
    if p.prefix:
        out = out | ((F.size(own) == 1) & ~F.startswith(their_key, F.get(own, 0)))
    found = F.when(out, 0.0).otherwise(F.least(F.lit(1.0), total))
    return F.when((own_key == their_key) & (own_key != ""), 1.0).otherwise(found) if p.equal else found


def catalogue_tokens(name: Column | str) -> Column:
    """Distinct folded words of two letters or more that aren't numbers or generic, in order."""
    own = F.filter(words(name), lambda w: w.rlike("^[a-z0-9]{2,}$") & ~w.rlike("^[0-9]+$"))
    return F.array_except(own, F.array(*map(F.lit, CATALOGUE_GENERIC)))


def best_match(
    names: DataFrame, catalogue: DataFrame, name: str, entry: str, least: float | None = None, least_single: float | None = None, profile: Profile = MANAGER
) -> DataFrame:
    """(name, entry, score) of each name's best entry above the threshold, the higher one for names of one token.

    A pair that covers COVER of a name's n tokens shares one of any n - ceil(COVER n) + 1 of them, so only
    the tokens that are rarest in the catalogue are joined on: a word that most entries have meets nothing.
    """
    tokens, key = (catalogue_tokens, lambda c: F.array_join(catalogue_tokens(c), " ")) if profile.spaced else (distinctive_tokens, entity_key)
    a = names.select(F.col(name).alias("name"), tokens(name).alias("a"), key(name).alias("ak")).distinct().where(F.size("a") > 0)
    b = catalogue.select(F.col(entry).alias("entry"), tokens(entry).alias("b"), key(entry).alias("bk")).distinct()
    theirs = b.select("entry", "b", "bk", F.explode("b").alias("t"))
    often = theirs.groupBy("t").agg(F.count("*").alias("n"))
    own = a.select("name", "a", "ak", F.explode("a").alias("t")).join(often, "t", "left")
    place = F.row_number().over(Window.partitionBy("name").orderBy(F.coalesce("n", F.lit(0)), "t"))
    rare = own.withColumn("place", place).where(F.col("place") <= F.size("a") - F.ceil(F.size("a") * COVER) + 1)
    shared = rare.select("name", "a", "ak", "t").join(theirs, "t").drop("t").distinct()
    scored = shared.withColumn("score", score(F.col("a"), F.col("ak"), F.col("b"), F.col("bk"), profile))
    bounds = (profile.least if least is None else least), (profile.single if least_single is None else least_single)
    good = scored.where(F.col("score") >= F.when(F.size("a") == 1, bounds[1]).otherwise(bounds[0]))
    top = good.groupBy("name").agg(F.max(F.struct("score", "entry")).alias("m"))
    return top.select(F.col("name").alias(name), F.col("m.entry").alias(entry), F.round("m.score", 6).alias("score"))
