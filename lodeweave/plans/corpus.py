"""The prompt pipeline: sources to prompts, first-wins dedup, filters, validation, proportional downsampling, split, report."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeweave import schema as S
from lodeweave.functions import messages as M
from lodeweave.functions import text as T
from lodeweave.operators import aggregates as A
from lodeweave.operators import dedup as D
from lodeweave.operators import sampling as P
from lodeweave.operators import verification as V
from lodeweave.sources import adapters
from lodeweave.sources.sinks import image_store
from lodeweave.sources.storage import stored


def _first(rows: DataFrame, n: int) -> DataFrame:
    """The n rows with the smallest _seq: the place of the last one is looked up by numbers alone, so no task sorts rows."""
    bound = rows.select("_seq").orderBy("_seq").limit(n).agg(F.max("_seq").alias("last"))
    return rows.join(F.broadcast(bound), F.col("_seq") <= F.col("last")).drop("last")  # one row


def scanned(tables: dict[str, DataFrame], catalog: DataFrame, quotas: DataFrame, overshoot: int = 2) -> DataFrame:
    """Canonical rows of all sources up to `overshoot` times their quota, numbered on in the catalog's order.

    tables: by "dataset|config"; each has _seq from 1. The catalog is a row for each source.
    """
    out = None
    limits = {(r["dataset"], r["config"]): r["quota"] for r in quotas.collect()}  # a row for each source of the catalog
    for at, s in enumerate(catalog.collect()):
        rows = adapters.adapter(s["adapter"])(tables[f"{s['dataset']}|{s['config'] or ''}"], adapters.Context(s["dataset"], s["config"], s["domain"]))
        rows = _first(rows, overshoot * limits.get((s["dataset"], s["config"]), 0))
        rows = rows.withColumn("_seq", F.col("_seq") + F.lit(at) * F.lit(1 << 40))
        out = rows if out is None else out.unionByName(rows)
    return out


def judged(rows: DataFrame, mode: str = "md5", tokens: Callable[[str], Column] = T.count_tokens) -> DataFrame:
    """Canonical rows as prompts, with `reason`: why a row is dropped, or null.

    A row is asked in this order: has it a user turn and a text; has a kept earlier row its text, or nearly; have kept earlier
    rows all its images; do the filters and the validation pass. Only kept rows stand in another's way, so they are settled
    among sound rows first, and every row is then held against them. tokens: how the tokens of a text are counted.
    """
    rows = rows.withColumn("prompt", M.strip_to_prompt(F.col("messages")))
    text = M.prompt_text(F.col("prompt"))
    rows = rows.withColumns({"messages": F.coalesce("prompt", F.col("messages")), "text": F.when(F.col("prompt").isNotNull(), text), "no_turn": F.col("prompt").isNull()}).drop("prompt")
    shas = M.image_shas(F.col("messages"))
    rows = rows.withColumns({"shas": shas, "domain": T.assign_domain("text", "domain"), "tokens": F.coalesce(tokens("text"), F.lit(0))})
    rows = rows.withColumn("images", F.filter("images", lambda i: F.array_contains(F.col("shas"), i["sha256"])))
    own = F.when(F.col("no_turn"), "no_user_turn").when(F.col("text") == "", "empty_prompt")
    late = F.coalesce(T.prompt_reject_reason("text", F.col("tokens")), F.when(F.size(M.validate_prompt()) > 0, F.lit("invalid")))
    rows = stored(rows.withColumns({"early": own, "late": late}).drop("no_turn"), "prompts")
    asked = rows.filter("early IS NULL").select("_seq", "text", "shas", F.col("late").isNull().alias("sound"))
    signs = stored(D.signed(asked, images=F.col("shas"), mode=mode).select("_seq", "shas", "sound", "dedup_key", "dedup_images", "dedup_sig"), "signs")
    sound = signs.filter("sound")
    first = sound.join(D.settled(sound).filter("reason IS NULL").select("_seq"), "_seq", "left_semi")
    stale = D.image_novelty(first.select("_seq", "shas")).filter("NOT novel").select("_seq")
    kept = stored(first.join(stale, "_seq", "left_anti"), "kept")
    near = D.reasons_against(signs, kept).withColumnRenamed("reason", "near")
    seen = D.seen_images(signs, kept).withColumn("seen", F.lit("duplicate_images"))
    out = rows.join(near, "_seq", "left").join(seen, "_seq", "left")
    return stored(out.withColumn("reason", F.coalesce("early", "near", "seen", "late")).drop("early", "late", "near", "seen"), "judged")


def split(accepted: DataFrame, target_train: int, val_size: int, images: bool = False) -> DataFrame:
    """accepted rows of the pool, with `part`."""
    pool = stored(P.downsample(accepted, target_train + val_size, S.DOMAIN_SHARE), "pool")
    return P.stratified_split(pool, val_size, shas="shas" if images else None)


def report(rows: DataFrame, parts: DataFrame) -> dict[str, DataFrame]:
    accepted = rows.filter("reason IS NULL")
    by = lambda part: A.summarise(parts.filter(F.col("part") == part), images=F.size("images"))
    return {"drops": A.drop_counts(rows), "sources": accepted.groupBy("source.name", "source.config").agg(F.count("*").alias("kept")), "train": by("train"), "val": by("val")}


def trajectories(tables: dict[str, DataFrame], catalog: DataFrame, most: int) -> DataFrame:
    """Dialogs of all sources that are sound, up to each one's cap; those whose only fault is calls without results are kept as seeds."""
    out = None
    for s in catalog.collect():
        rows = adapters.DIALOGS[s["adapter"]](tables[f"{s['dataset']}|{s['config'] or ''}"], adapters.Context(s["dataset"], s["config"], s["domain"]))
        rows = rows.withColumn("problems", M.validate_trajectory())
        seed = M.only_unanswered(F.col("problems"), F.col("messages"), F.col("tools"))
        rows = rows.withColumn("seed_only", seed).filter((F.size("problems") == 0) | F.col("seed_only"))
        # the cap counts sound rows only, so the place of the last one is looked up rather than summed over all rows
        sound = rows.filter("NOT seed_only").select("_seq").orderBy("_seq").limit(min(s["cap"], most))
        bound = sound.agg(F.count("*").alias("n"), F.max("_seq").alias("last"))
        rows = rows.crossJoin(F.broadcast(bound)).filter((F.col("n") < min(s["cap"], most)) | (F.col("_seq") <= F.col("last"))).drop("n", "last", "problems")  # one row
        out = rows if out is None else out.unionByName(rows)
    return out


def trajectory_verdicts(rows: DataFrame, run_code: bool = False) -> DataFrame:
    rows = rows.withColumn("problems", M.validate_trajectory())
    return rows.withColumn("__r", V.trajectory_reject(F.col("verify"), F.col("messages"), F.col("tools"), F.col("problems"), run_code)).withColumns({"reason": F.col("__r.reason"), "detail": F.col("__r.detail"), "accepted": F.col("__r.reason").isNull()}).drop("__r", "problems")


def holdout(tables: dict[str, DataFrame], name: str, each: int) -> tuple[DataFrame, DataFrame]:
    """(rows, images): the first `each` sound examples of each configuration's table, and the store's entries of their images."""
    built = [adapters.image_rows(t, adapters.Context(name, config, "reasoning"), holdout=True) for config, t in tables.items()]
    whole = reduce(DataFrame.unionByName, built)
    sound = whole.filter(F.size(M.validate_example()) == 0)
    rows = P.first_per_group(sound, ["source.config"], each)
    raw = reduce(DataFrame.unionByName, [t.select(F.explode("images").alias("image")).select(F.col("image.bytes").alias("content")) for t in tables.values()])
    wanted = rows.select(F.explode(M.image_shas(F.col("messages"))).alias("sha")).distinct()
    return rows, image_store(raw.join(wanted, F.sha2("content", 256) == F.col("sha"), "left_semi"))
