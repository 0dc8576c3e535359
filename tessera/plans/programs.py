"""Programs over whole runs: stages with isolated failures, a second pass over what the first left open, domain resolution."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import rank
from . import planning

# The points by which a domain is decided.
REVIEW_SCORE, AMBIGUITY_MARGIN = 40, 15


def run_batch(funds: DataFrame, key: str, stages: list[tuple[str, Column]]) -> DataFrame:
    """(key, step, stage, status, reason): the transitions of each fund through the stages, in one pass over the rows.

    A stage is its name and a column that gives the reason of a failure, null if it went well; it should use
    the try_ functions, so that bad rows give reasons and not exceptions. A fund stops at the first stage
    that fails, later stages aren't evaluated for it, and no other fund is touched.
    """
    names = F.array(*[F.lit(name) for name, _ in stages])
    failed = F.lit(None).cast("struct<step:int,reason:string>")
    for step, (_, reason) in reversed(list(enumerate(stages))):
        failed = F.when(reason.isNotNull(), F.struct(F.lit(step).alias("step"), reason.cast("string").alias("reason"))).otherwise(failed)
    reached = F.slice(names, F.lit(1), F.coalesce(F.col("__failed.step") + 1, F.size(names)))
    steps = funds.select(key, failed.alias("__failed")).select(key, "__failed", F.posexplode(reached).alias("step", "stage"))
    broken = F.coalesce(F.col("step") == F.col("__failed.step"), F.lit(False))
    return steps.select(key, "step", "stage", F.when(broken, "failed").otherwise("completed").alias("status"), F.when(broken, F.col("__failed.reason")).alias("reason"))


def outcomes(transitions: DataFrame, key: str) -> DataFrame:
    """(key, stage, status, reason): where each fund of `run_batch` ended."""
    last = F.max_by(F.struct("stage", "status", "reason"), "step").alias("__last")
    return transitions.groupBy(key).agg(last).select(key, "__last.*")


def two_pass(fast: DataFrame, reasons: DataFrame, crawl: Callable[[DataFrame], DataFrame], fund: str, most: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(plan, after, recovered) of a first pass and of a second one over the funds that it left open.

    fast(fund, field, status) is what the first pass found and reasons(fund, field, trigger) why fields are
    worth another try; reasons of funds that fast lacks are left out. crawl gets (fund, field) rows to try
    and returns (fund, field, status); what it says replaces the first pass's status, field by field.
    plan(fund, weight, n, triggers) has the funds tried: all, or the `most` of highest weight (ties: more fields, then
    the smaller fund). recovered(fund, field, was) are the planned fields found only by the second pass.
    Give fast and crawl's result as saved tables, as each is read more than once.
    """
    known = reasons.join(fast.select(fund).distinct(), fund, "left_semi")
    plan = planning.deep_pass([known], fund)
    if most:
        plan = plan.orderBy(F.desc("weight"), F.desc("n"), fund).limit(most)
    wanted = known.select(fund, "field").distinct().join(plan.select(fund), fund, "left_semi")
    deep = crawl(wanted).select(fund, "field", F.col("status").alias("now"))
    states = fast.join(deep, [fund, "field"], "full").select(fund, "field", F.col("status").alias("was"), "now")
    after = states.select(fund, "field", F.coalesce("now", "was").alias("status"))
    gained = states.where("now = 'found' and coalesce(was, '') <> 'found'").join(wanted, [fund, "field"], "left_semi")
    return plan, after, gained.select(fund, "field", F.coalesce("was", F.lit("unknown")).alias("was"))


def brand(domain: Column) -> Column:
    """A domain without www and its top level: one brand's domains are aliases."""
    return F.regexp_replace(F.regexp_replace(F.lower(domain), r"^www\.", ""), r"\.[^.]*$", "")


def resolve_domains(funds: DataFrame, primary: DataFrame, adapters: DataFrame, fund: str, review: int = REVIEW_SCORE, margin: int = AMBIGUITY_MARGIN) -> DataFrame:
    """(fund, status, domain, url) of each fund: verified, review_required, not_found or error; only verified ones have a domain.

    primary and adapters(fund, domain, url, score, rank, accepted, error, guessed) are verified candidates.
    Adapters are asked only about funds none of whose primary candidates was accepted, and only about new
    addresses. One accepted domain, several of one brand or a lead of `margin` points decide.
    """
    settled = primary.where("accepted").select(fund).distinct()
    extra = adapters.join(settled, fund, "left_anti").join(primary.select(fund, "url").distinct(), [fund, "url"], "left_anti")
    results = primary.unionByName(extra)
    order = [F.desc("score"), "rank", "domain", "url"]
    first = F.struct((-F.col("score")).alias("minus"), "rank", "domain", "url", "score")
    good = F.col("accepted")
    facts = results.groupBy(fund).agg(
        F.min(first).alias("top"),
        F.min(F.when(good, first)).alias("best"),
        F.count_if(good).alias("n_good"),
        (F.min(F.when(good, brand(F.col("domain")))) == F.max(F.when(good, brand(F.col("domain"))))).alias("one_brand"),
        F.bool_and(F.col("error").isNotNull()).alias("all_failed"),
        F.bool_or(~F.col("guessed")).alias("any_found"),
    )
    two = rank.cap(results.where(good), [fund], order, 2).groupBy(fund).agg(F.min("score").alias("second"))
    verified = (F.col("n_good") == 1) | ((F.col("n_good") > 1) & (F.col("one_brand") | (F.col("best.score") - F.col("second") >= margin)))
    status = (
        F.when(verified, "verified")
        .when(F.col("n_good") > 1, "review_required")
        .when(F.col("all_failed") & F.col("any_found"), "error")
        .when(F.col("top.score") >= review, "review_required")
        .otherwise("not_found")
    )
    done = funds.select(fund).join(facts, fund, "left").join(two, fund, "left").withColumn("status", status)
    sure = lambda c: F.when(F.col("status") == "verified", F.col(f"best.{c}")).alias(c)
    return done.select(fund, "status", sure("domain"), sure("url"))
