"""Prompts that a provider makes up from seeds, pool by pool against one shared index, and prompts with solved examples before them."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeweave.functions import messages as M
from lodeweave.functions import text as T
from lodeweave.operators import dedup as D
from lodeweave.operators import generation as G
from lodeweave.sources.adapters import Context, canonical
from lodeweave.sources.storage import stored

SHOTS = 8


@dataclass(frozen=True)
class Pool:
    """seeds: (_seq, seed) and, for a pool whose rows carry tools, tools (JSON texts). template: with {seed} in it. limit: rows to keep."""

    kind: str
    domain: str
    seeds: DataFrame
    template: str
    limit: int


def invent_pools(pools: Iterable[Pool], cache: DataFrame, provider: G.Provider | None) -> DataFrame:
    """Canonical prompts of all pools. A text (nearly) that of one kept before, in its own pool or an earlier one, is dropped.

    A pool keeps the first `limit` texts in the order of its seeds; what lies beyond stands against no later pool. Pools
    are few and come one after the other; within one, all rows are settled together.
    """
    kept = None
    for number, pool in enumerate(pools):
        seeds = pool.seeds if "tools" in pool.seeds.columns else pool.seeds.withColumn("tools", F.lit(None).cast("array<string>"))
        made = G.invented(pool.seeds.select("seed").distinct(), pool.template, cache, provider, pool.kind)
        found = seeds.join(made, "seed").select((F.lit(number << 50) + F.col("_seq")).alias("_seq"), "seed", "text", "tools", F.lit(pool.kind).alias("kind"), F.lit(pool.domain).alias("domain"))
        found = stored(found, "invented")
        rows = found.select("_seq", "text") if kept is None else found.select("_seq", "text").unionByName(kept.select("_seq", "text"))
        new = D.dedup_reasons(rows).filter(F.col("reason").isNull() & (F.col("_seq") >= number << 50)).select("_seq")
        first = new.orderBy("_seq").limit(pool.limit)
        here = found.join(first, "_seq", "left_semi")
        kept = stored(here if kept is None else kept.unionByName(here), "pools")
    if kept is None:
        raise ValueError("no pools")
    row_id = F.concat(F.lit("invented-"), F.col("kind"), F.lit("-"), T.content_id("text"))
    out = canonical(kept, Context("", None, ""), row_id, F.array(M.text_message("user", F.col("text"))), tools=F.col("tools"), meta=F.struct(F.substring("seed", 1, 200).alias("seed")))
    own = kept.select("_seq", F.concat(F.lit("teacher:"), F.col("kind")).alias("__name"), F.col("domain").alias("__domain"))
    full = out.drop("domain").join(own, "_seq").withColumn("source", F.col("source").withField("name", F.col("__name"))).withColumnRenamed("__domain", "domain").withColumn("origin", F.lit("teacher"))
    return full.select(out.columns)


def few_shot(examples: DataFrame, n: int = SHOTS) -> DataFrame:
    """(prompt), one row: the first n examples (_seq, question, answer) with their working and, on a line of its own, their result."""
    final = F.substring_index("answer", "####", -1)
    working = F.when(F.contains("answer", F.lit("####")), F.left("answer", F.char_length("answer") - F.char_length(final) - 4)).otherwise(F.lit(""))
    shot = F.concat(F.lit("Q: "), F.col("question"), F.lit("\nA: "), T.strip(working), F.lit("\n"), T.strip(final))
    first = examples.filter("question IS NOT NULL AND answer IS NOT NULL").select("_seq", shot.alias("shot")).orderBy("_seq").limit(n)
    every = F.array_sort(F.collect_list(F.struct("_seq", "shot")))  # n rows
    return first.agg(F.concat(F.array_join(F.transform(every, lambda x: x["shot"]), "\n"), F.lit("\n\n")).alias("prompt"))


def asked(questions: DataFrame, examples: DataFrame, n: int = SHOTS) -> DataFrame:
    """questions (question) with `prompt`: the examples, and the question open."""
    head = few_shot(examples, n).withColumnRenamed("prompt", "__head")
    return questions.crossJoin(F.broadcast(head)).withColumn("prompt", F.concat("__head", F.lit("Q: "), F.col("question"), F.lit("\nA:"))).drop("__head")  # one row


def heartbeat(rows: DataFrame, label: str, every: int = 1000) -> DataFrame:
    """rows as they are; each task says on its standard error how many have passed, once in `every` rows."""

    def pulse(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        import sys

        seen = 0
        for batch in batches:
            before, seen = seen, seen + batch.num_rows
            if seen // every > before // every:
                print(f"{label}: {seen} rows", file=sys.stderr, flush=True)
            yield batch

    return rows.mapInArrow(pulse, rows.schema)
