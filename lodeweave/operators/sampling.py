"""Quotas, samples and splits. Shuffles are orders of a hash of (seed, id), so a rerun draws the same rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodeweave import schema as S
from lodeweave.functions import text as T
from lodeweave.operators import windows as N
from lodeweave.sources.storage import stored


def hash_order(*ids: str, seed: int = S.SPLIT_SEED) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), *[F.col(i).cast("string") for i in ids]), 256)


def share_of(domain: Column, shares: dict[str, float]) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in shares.items() for x in kv])[domain], F.lit(0.0))


def allocate(sources: DataFrame, target: int, shares: dict[str, float] = S.DOMAIN_SHARE) -> DataFrame:
    """sources (dataset, config, domain, cap) with quota: the domain's budget in proportion to caps, rounded down."""
    total = F.sum("cap").over(W.partitionBy("domain"))
    budget = F.bround(target * share_of(F.col("domain"), shares)).cast("long")
    return sources.withColumn("quota", F.when(total > 0, F.floor(budget * F.col("cap") / total)).otherwise(0).cast("long"))


def take_quota(rows: DataFrame, quotas: DataFrame, by: str = "source") -> DataFrame:
    """The first `quota` rows of each source in the order of _seq."""
    placed = N.running_start(rows, F.lit(1), [by])
    return N.null_safe_join(placed, quotas.select(by, "quota"), [by]).filter("start < quota").drop("start", "quota")


def take_capped(rows: DataFrame, valid: Column, want: int, by: list[str]) -> DataFrame:
    """Rows in the order of _seq while fewer than `want` valid ones came before; rows that are not valid do not count."""
    return N.running_start(rows, F.when(valid, 1).otherwise(0), by).filter(F.col("start") < want).drop("start")


def first_per_group(rows: DataFrame, by: list[str], n: int, order: Column | str = "_seq") -> DataFrame:
    return rows.withColumn("__rank", F.row_number().over(W.partitionBy(*by).orderBy(order))).filter(F.col("__rank") <= n).drop("__rank")


def with_domain_rank(rows: DataFrame, seed: int, domain: str, row_id: str) -> DataFrame:
    """rows with __h, their hash, and __rank, their place in their domain by it."""
    return N.hash_rank(rows.withColumn("__h", hash_order(row_id, seed=seed)), [domain], "__h", row_id)


def downsample(rows: DataFrame, target: int, shares: dict[str, float], seed: int = S.SPLIT_SEED, domain: str = "domain", row_id: str = "id") -> DataFrame:
    """About target rows by the shares of the domains present; trimmed if over, filled from what is left if under.

    The rows within their domain's want come first, then the others, each in hash order; ranks are made by ranges of the
    hash, so no task sorts a whole domain.
    """
    present = rows.groupBy(domain).agg(F.count("*").alias("n"))
    weight = share_of(F.col(domain), shares)
    total = F.sum(weight).over(W.partitionBy())
    wants = present.withColumn("want", F.bround(target * weight / F.when(total == 0, 1.0).otherwise(total)).cast("long")).select(domain, "want")
    ranked = with_domain_rank(rows, seed, domain, row_id).join(F.broadcast(wants), domain)  # a row for each domain
    parted = ranked.withColumn("__late", F.col("__rank") > F.col("want")).drop("__rank", "want")
    in_time = parted.filter("NOT __late").agg(F.count("*").alias("n_first"))  # one row
    placed = N.hash_rank(parted, ["__late"], "__h", row_id).crossJoin(F.broadcast(in_time))
    place = F.col("__rank") + F.when(F.col("__late"), F.col("n_first")).otherwise(0)
    return placed.filter(place <= target).drop("__late", "__h", "__rank", "n_first")


def stratified_split(rows: DataFrame, val_size: int, seed: int = S.SPLIT_SEED, domain: str = "domain", row_id: str = "id", shas: str | None = None) -> DataFrame:
    """rows with `part` (train, val). Rows with images are drawn so that no two of val share one, and rows of train that
    share an image with val are dropped.

    Rows without images are settled by rank. Whether a row with images is taken depends on those before it, so for them
    the candidates within the domain's want are settled by rounds of first-wins on shared images.
    """
    ranked = with_domain_rank(rows, seed, domain, row_id)
    sizes = rows.groupBy(domain).agg(F.count("*").alias("n"))
    wants = sizes.withColumn("want", F.bround(F.lit(val_size) * F.col("n") / F.sum("n").over(W.partitionBy())).cast("long")).select(domain, "want")
    ranked = ranked.join(F.broadcast(wants), domain)  # a row for each domain
    if shas is None:
        return ranked.withColumn("part", F.when(F.col("__rank") <= F.col("want"), "val").otherwise("train")).drop("__h", "__rank", "want")
    table = stored(ranked, "split")
    chosen = _disjoint(table, domain, row_id, shas)
    marked = table.join(chosen.withColumn("part", F.lit("val")), row_id, "left").withColumn("part", F.coalesce("part", F.lit("train")))
    held = stored(table.join(chosen, row_id, "left_semi").select(F.explode(shas).alias("sha")).distinct(), "held")
    hit = marked.filter("part = 'train'").select(row_id, F.explode(shas).alias("sha")).join(held, "sha", "left_semi").select(row_id).distinct()
    return marked.join(hit, row_id, "left_anti").drop("__h", "__rank", "want")


def _disjoint(table: DataFrame, domain: str, row_id: str, shas: str) -> DataFrame:
    """(row_id) of the rows that a pass over the domains in order takes: up to `want` for each, images disjoint.

    Domains are few and come one after the other; within one, rounds take the rows up to the want that are first with all their images.
    """
    taken = table.select(row_id).limit(0)
    seen = table.select(F.explode(shas).alias("sha")).limit(0)
    for (name,) in table.select(domain).distinct().orderBy(domain).collect():  # the domains of the schema
        rest = stored(table.filter(F.col(domain).eqNullSafe(F.lit(name))).select(row_id, "__rank", "want", F.col(shas).alias("shas")), "domain")
        blocked = rest.select(row_id, F.explode("shas").alias("sha")).join(seen, "sha", "left_semi").select(row_id).distinct()
        open_rows = stored(rest.join(blocked, row_id, "left_anti"), "domain")
        pairs = open_rows.select("__rank", F.explode("shas").alias("sha")).distinct()
        edges = pairs.alias("x").join(pairs.alias("y"), (F.col("x.sha") == F.col("y.sha")) & (F.col("x.__rank") < F.col("y.__rank"))).select(F.col("x.__rank").alias("a"), F.col("y.__rank").alias("b")).distinct()
        from lodeweave.operators.dedup import first_wins

        kept = first_wins(open_rows.select(F.col("__rank").alias("k")), edges).filter("kept").select(F.col("k").alias("__rank"))
        here = open_rows.join(kept, "__rank", "left_semi")
        order = W.partitionBy().orderBy("__rank")
        here = stored(here.withColumn("__nth", F.row_number().over(order)).filter("__nth <= want").select(row_id, "shas"), "domain")
        taken, seen = taken.unionByName(here.select(row_id)), seen.unionByName(here.select(F.explode("shas").alias("sha"))).distinct()
    return taken


def hash_holdout(rows: DataFrame, is_source: Column, text: str = "text", size: int = S.REFUSAL_HOLDOUT) -> DataFrame:
    """rows with `held_out`: of a source with more than `size` rows, those with the smallest keys of their text.

    The ranks are those of a top-k by partition; only `size` rows of the source are ever gathered.
    """
    n = rows.filter(is_source).count()
    if n <= size:
        return rows.withColumn("held_out", F.lit(False))
    top = rows.filter(is_source).select("_seq", T.text_key(text).alias("h")).orderBy("h", "_seq").limit(size).select("_seq")
    return rows.join(F.broadcast(top.withColumn("held_out", F.lit(True))), "_seq", "left").withColumn("held_out", F.coalesce("held_out", F.lit(False)))  # `size` rows


def audit_sample(rows: DataFrame, per_domain: int, seed: int = S.SPLIT_SEED, domain: str = "domain", row_id: str = "id") -> DataFrame:
    return with_domain_rank(rows, seed, domain, row_id).filter(F.col("__rank") <= per_domain).drop("__h", "__rank")


def last_windows(windows: DataFrame, n: int = 64) -> DataFrame:
    """windows (_seq) with `held_out` for the last n."""
    top = windows.select("_seq").orderBy(F.desc("_seq")).limit(n).agg(F.min("_seq").alias("least"))
    return windows.crossJoin(F.broadcast(top)).withColumn("held_out", F.col("_seq") >= F.col("least")).drop("least")  # one row


def batches(rows: DataFrame, size: int, seed: int = S.SPLIT_SEED, row_id: str = "id") -> DataFrame:
    """rows with `batch`: consecutive groups of `size` in hash order; the last may be short."""
    ranked = N.hash_rank(rows.withColumn("__h", hash_order(row_id, seed=seed)), [], "__h", row_id)
    return ranked.withColumn("batch", F.floor((F.col("__rank") - 1) / size).cast("long")).drop("__h", "__rank")


def candidates_for(accepted: int, rate: float) -> int:
    if rate <= 0:
        raise ValueError("a source whose pass rate is 0 cannot be anchored")
    return math.ceil(accepted / rate)


def anchored_caps(sources: DataFrame, needs: DataFrame) -> DataFrame:
    """sources (dataset, config, domain, cap) with anchored_cap: caps scaled up so that the domain meets its `need`; never below the cap.

    needs: (domain, need), the candidates asked for; a domain that is not there keeps its caps.
    """
    total = F.sum("cap").over(W.partitionBy("domain"))
    scaled = F.expr("(need * cap + total - 1) div total")
    return sources.join(needs, "domain", "left").withColumn("total", total).withColumn("anchored_cap", F.when(F.col("need").isNull(), F.col("cap")).otherwise(F.greatest(F.col("cap"), scaled)).cast("long")).drop("need", "total")


def driver_target(anchored: DataFrame, shares: dict[str, float] = S.DOMAIN_SHARE) -> DataFrame:
    """The least total whose shares give every domain what its anchored caps add up to."""
    by = anchored.groupBy("domain").agg(F.sum("anchored_cap").alias("need")).withColumn("share", share_of(F.col("domain"), shares))
    return by.agg(F.coalesce(F.max(F.when(F.col("share") > 0, F.ceil(F.col("need") / F.col("share")))), F.sum("need")).cast("long").alias("target"))
