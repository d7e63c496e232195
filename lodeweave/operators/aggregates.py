"""Counts, shares, rates and verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MIN_ANCHOR_ATTEMPTS, OUTAGE_SHARE = 200, 0.5


def summarise(rows: DataFrame, domain: str = "domain", tokens: Column | None = None, images: Column | None = None) -> DataFrame:
    """By domain: n, share, tokens, token_share, image_rows, image_share, images; shares to 4 places, half to even."""
    tokens = F.col("tokens") if tokens is None else tokens
    images = F.lit(0) if images is None else images
    by = rows.groupBy(F.col(domain).alias("domain")).agg(F.count("*").alias("n"), F.sum(tokens).cast("long").alias("tokens"), F.count_if(images > 0).alias("image_rows"), F.sum(images).cast("long").alias("images"))
    whole = W.partitionBy()  # a row for each domain
    part = lambda c, total: F.when(F.sum(total).over(whole) > 0, F.bround(F.col(c) / F.sum(total).over(whole), 4)).otherwise(0.0)
    return by.select("domain", "n", part("n", "n").alias("share"), "tokens", part("tokens", "tokens").alias("token_share"), "image_rows", F.bround(F.col("image_rows") / F.col("n"), 4).alias("image_share"), "images")


def drop_counts(reasons: DataFrame, reason: str = "reason") -> DataFrame:
    return reasons.filter(F.col(reason).isNotNull()).groupBy(reason).agg(F.count("*").alias("n")).orderBy(F.desc("n"), reason)


def pass_rates(rows: DataFrame, accepted: Column, by: list[str]) -> DataFrame:
    """By source: attempted, accepted, pass_rate (4 places)."""
    return rows.groupBy(*by).agg(F.count("*").alias("attempted"), F.count_if(accepted).alias("accepted")).withColumn("pass_rate", F.bround(F.try_divide("accepted", "attempted"), 4))


def blended_rate(rates: DataFrame) -> DataFrame:
    return rates.agg(F.sum("attempted").alias("attempted"), F.sum("accepted").alias("accepted")).withColumn("blended", F.bround(F.try_divide("accepted", "attempted"), 4))


def attempt_weighted(rates: DataFrame, key: str = "key") -> DataFrame:
    """By domain, the last part of a key name|domain: attempted, and accepted over attempted."""
    domain = F.element_at(F.split(F.col(key), r"\|"), -1)
    return rates.groupBy(domain.alias("domain")).agg(F.sum("attempted").alias("attempted"), (F.sum("accepted") / F.sum("attempted")).alias("rate")).filter("attempted > 0")


def thin_samples(rates: DataFrame, least: int = MIN_ANCHOR_ATTEMPTS) -> DataFrame:
    return rates.filter(F.col("attempted") < least)


def guard_thin_samples(rates: DataFrame, least: int = MIN_ANCHOR_ATTEMPTS) -> None:
    if bad := [r["domain"] for r in thin_samples(rates, least).limit(20).collect()]:
        raise ValueError(f"too few attempts to anchor on: {bad}")


def guard_outage(stages: DataFrame, most: float = OUTAGE_SHARE) -> None:
    """stages: (stage, attempted, errors)."""
    if bad := [r["stage"] for r in stages.filter((F.col("attempted") > 0) & (F.col("errors") / F.col("attempted") > most)).limit(20).collect()]:
        raise RuntimeError(f"most attempts failed for want of a model: {bad}")


def rollout_verdicts(rollouts: DataFrame, k: int, by: str = "id", keep: str | None = None) -> DataFrame:
    """By prompt: verdict, passes and (keep) that column of the first passing rollout.

    rollouts: (by, rollout, accepted, error). Fewer than k rollouts, or an error, is a teacher_error.
    """
    found = [F.count("*").alias("n"), F.count_if("accepted").alias("p"), F.max(F.coalesce("error", F.lit(False))).alias("failed")]
    if keep:
        found.append(F.min_by(keep, F.when(F.col("accepted"), F.col("rollout"))).alias("kept"))
    by_id = rollouts.groupBy(by).agg(*found)
    verdict = F.when(F.col("failed") | (F.col("n") < k), "teacher_error").when(F.col("p") == k, "all_pass").when(F.col("p") == 0, "all_fail").otherwise("keep")
    out = by_id.withColumn("verdict", verdict).withColumn("passes", F.when(F.col("verdict") != "teacher_error", F.col("p")))
    return out.select(by, "verdict", "passes", *([F.when(F.col("verdict") == "keep", F.col("kept")).alias(keep)] if keep else []))


def perplexity(rows: DataFrame, by: list[str], nll: str = "nll", n: str = "n") -> DataFrame:
    return rows.groupBy(*by).agg(F.bround(F.exp(F.sum(nll) / F.sum(n)), 4).alias("ppl"))


def run_spread(rows: DataFrame, by: list[str], run: str = "run", value: str = "ppl") -> DataFrame:
    """Absolute difference of run 0 and run 1."""
    return rows.groupBy(*by).agg(F.abs(F.max(F.when(F.col(run) == 0, F.col(value))) - F.max(F.when(F.col(run) == 1, F.col(value)))).alias("spread"))


def accuracy(rows: DataFrame, by: list[str], hit: str = "hit") -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(hit).alias("hits")).withColumn("accuracy", F.col("hits") / F.col("n"))


def caps_by_domain(sources: DataFrame, cap: str = "cap") -> DataFrame:
    return sources.groupBy("domain").agg(F.sum(cap).alias("cap"))
