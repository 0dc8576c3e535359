"""Which of several disagreeing claims wins, and why.

Claims of a key are grouped by normalised value and each value is led by its strongest claim. Leaders
meet in pairs on a ladder of factors, the first that separates them decides; a leader wins if it beats
every other. One value alone is `equivalent`, a winner makes `auto_resolved`, none `unresolved`.

Only a few leaders of a key can win (see `rivals`); these meet all others, so the work grows in proportion
to the different values of a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Factors in the order in which they decide.
FACTORS = ["parser_provenance", "source_authority", "scope_specificity", "document_type", "information_date", "evidence_completeness", "extraction_score"]
#: How far scores must be apart, between documents and within one.
MARGIN, SAME_DOCUMENT_MARGIN = 25, 1
AUTHORITY = {"official_fund": 4, "fund_specific_manager": 3, "generic_manager": 2, "external_fallback": 1, "unknown": 0}

#: What a claim must have, beside key and value.
FACTS = ["rebuilt", "authority", "scope", "priority", "evidence", "score", "source_id", "date_kind", "date_value"]


def authority_rank(name: Column) -> Column:
    return F.coalesce(*[F.when(name == k, v) for k, v in AUTHORITY.items()], F.lit(0))


def evidence_rank(quote: Column, paginated: Column, page: Column) -> Column:
    """0 without a quote, 1 with one whose page is missing though the document has pages, else 2."""
    return F.when(F.trim(F.coalesce(quote, F.lit(""))) == "", 0).when(paginated & page.isNull(), 1).otherwise(2)


def strength() -> Column:
    """The order of claims of one value, strongest first when falling."""
    return F.struct((~F.col("rebuilt")).cast("int"), "authority", "scope", "priority", "evidence", "score", (-F.col("source_id")))


def leaders(claims: DataFrame, key: list[str], value: list[str]) -> DataFrame:
    """The strongest claim of each value of a key, and how many claims it leads (map-side aggregation)."""
    facts = F.struct(strength().alias("strength"), *FACTS)
    got = claims.groupBy(*key, *value).agg(F.max_by(facts, strength()).alias("f"), F.count("*").alias("n_claims"), F.min("source_id").alias("first_source"), F.max("source_id").alias("last_source"))
    return got.select(*key, *value, "n_claims", "first_source", "last_source", "f.*")


def _sign(a: Column, b: Column) -> Column:
    return F.when(a > b, 1).when(a < b, -1).otherwise(0)


def ladder(left: str, right: str, margin: Column) -> list[Column]:
    """What each factor says of two claims: 1 for the left, -1 for the right, 0 for neither."""
    a, b = (lambda c: F.col(f"{left}.{c}")), (lambda c: F.col(f"{right}.{c}"))
    holds = lambda p, f: (p("authority") >= f("authority")) & (p("scope") >= f("scope"))
    parser = F.when(a("rebuilt") == b("rebuilt"), 0).when(b("rebuilt"), F.when(holds(a, b), 1).otherwise(0)).otherwise(F.when(holds(b, a), -1).otherwise(0))
    comparable = a("date_value").isNotNull() & b("date_value").isNotNull() & (a("date_kind") == b("date_kind")) & (a("date_kind") != "unknown")
    date = F.when(comparable, _sign(a("date_value"), b("date_value"))).otherwise(0)
    score = F.when(F.abs(a("score") - b("score")) < margin, 0).otherwise(_sign(a("score"), b("score")))
    return [parser, _sign(a("authority"), b("authority")), _sign(a("scope"), b("scope")), _sign(a("priority"), b("priority")), date, _sign(a("evidence"), b("evidence")), score]


def decide(factors: list[Column]) -> Column:
    """struct(favours, factor): the first factor that isn't 0."""
    found = F.coalesce(*[F.when(f != 0, F.struct(f.alias("favours"), F.lit(name).alias("factor"))) for f, name in zip(factors, FACTORS)])
    return F.coalesce(found, F.struct(F.lit(0).alias("favours"), F.lit(None).cast("string").alias("factor")))


def rivals(led: DataFrame, key: list[str]) -> DataFrame:
    """The leaders that may beat all others of their key, one at most for each kind of date.

    A winner has the highest authority, among these the widest scope, then isn't rebuilt if any isn't, and
    so on down the ladder; only dates of different kinds don't compare. So nobody but the strongest of
    each kind can win, and each key has a few rivals however many values it has.
    """
    dated = F.col("date_value").isNotNull() & (F.col("date_kind") != "unknown")
    order = F.struct("authority", "scope", (~F.col("rebuilt")).cast("int").alias("own"), "priority", F.when(dated, F.col("date_value")).alias("date"), "evidence", "score")
    own = [c for c in led.columns if c not in key]
    found = led.groupBy(*key, F.when(dated, F.col("date_kind")).alias("kind")).agg(F.max_by(F.struct(*own), order).alias("r"))
    return found.select(*key, "r.*")


def resolve(claims: DataFrame, key: list[str], value: list[str]) -> DataFrame:
    """(key, the winning value, outcome, decided_by, n_values, n_claims) of each key of claims(key, value, FACTS).

    Null parts of keys and values are values like others.
    """
    led = leaders(claims, key, value).checkpoint()  # read by each branch below
    whole = led.groupBy(*key).agg(
        F.count("*").alias("n_values"), F.sum("n_claims").alias("n_claims"), (F.min("first_source") == F.max("last_source")).alias("one_document"), F.max_by(F.struct(*value), "strength").alias("only")
    )
    alone = whole.where("n_values = 1").select(*key, *[F.col(f"only.{v}") for v in value], F.lit("equivalent_after_normalization").alias("outcome"), F.lit(None).cast("string").alias("decided_by"), "n_values", "n_claims")
    same = lambda left, right: [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in key]
    many = whole.where("n_values > 1").alias("w")
    contested = led.alias("l").join(many, same("l", "w")).select("l.*", "w.one_document")
    margin = F.when(F.col("a.one_document"), SAME_DOCUMENT_MARGIN).otherwise(MARGIN)
    other = F.lit(False)
    for v in value:
        other = other | ~F.col(f"a.{v}").eqNullSafe(F.col(f"b.{v}"))
    pairs = rivals(contested, key).alias("a").join(contested.alias("b"), [*same("a", "b"), other])
    verdicts = pairs.select(*[F.col(f"a.{c}") for c in (*key, *value)], F.col("b.strength").alias("rival"), decide(ladder("a", "b", margin)).alias("d"))
    won = verdicts.groupBy(*key, *value).agg(F.min("d.favours").alias("worst"), F.max_by("d.factor", "rival").alias("decided_by")).where("worst = 1").alias("v")
    lost = many.join(won, same("w", "v"), "left").select(*[F.col(f"w.{k}").alias(k) for k in key], *[F.col(f"v.{x}").alias(x) for x in value], "v.decided_by", "n_values", "n_claims")
    named = F.when(F.col("decided_by").isNotNull(), "auto_resolved").otherwise("unresolved").alias("outcome")
    return alone.union(lost.select(*key, *value, named, "decided_by", "n_values", "n_claims"))


def contest_leading(claims: DataFrame, key: list[str], conflict: list[str], value: list[str]) -> DataFrame:
    """`resolve` of each key's leading claim and of those that claim the same thing, that is, agree with it in `conflict`.

    A claim of another date, class or metric is no rival but a different statement. Claims of equal strength
    are led by the one with the largest conflict columns. Keys of one claim in that group have n_claims 1.
    """
    lead = claims.groupBy(*key).agg(F.max_by(F.struct(*conflict), F.struct(strength(), *conflict)).alias("lead")).alias("w")
    shared = [F.col(f"c.{k}").eqNullSafe(F.col(f"w.{k}")) for k in key]
    shared += [F.col(f"c.{x}").eqNullSafe(F.col(f"w.lead.{x}")) for x in conflict]
    return resolve(claims.alias("c").join(lead, shared, "left_semi"), [*key, *conflict], value)
