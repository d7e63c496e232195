"""Why prompts are dropped, against a row by row version: dedup outranks the filters, and only kept rows stand in another's way."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from lodeweave.functions import messages as M
from lodeweave.functions import minhash as H
from lodeweave.functions import text as T
from lodeweave.operators import dedup as D
from lodeweave.plans import corpus
from tests.test_dialogs import dialogs, msg


def test_reasons_row_by_row(spark):
    r, rows = random.Random(6), []
    bases = ["word " * 3 + " ".join(f"term{r.randrange(10**6)}" for _ in range(40)) for _ in range(6)] + ["hi", "日本語のテキスト " * 6]
    for _ in range(70):
        t = r.choice(bases)
        t = r.choice([t, t.upper() + " ", t + " more", t + " 日本語" * r.choice([0, 1, 8]), t[:-1]])
        pictures = r.sample(["s1", "s2", "s3", "s4"], r.choice([0, 0, 0, 1, 2]))
        rows.append(([msg("user", parts=[("text", t, None), *(("image", None, s) for s in pictures)])], None))
    rows += [([msg("user", "")], None), ([msg("assistant", "x")], None)]
    image = F.transform(M.image_shas(F.col("messages")), lambda s: F.struct(s.alias("sha256"), F.lit("p").alias("path"), F.lit(1).alias("w"), F.lit(1).alias("h"), F.lit(None).cast("string").alias("origin_url")))
    table = dialogs(spark, *rows).withColumn("images", image)
    got = {x._seq: x.reason for x in corpus.judged(table).collect()}
    prompt = table.withColumn("text", M.prompt_text(F.col("messages")))
    shas = M.image_shas(F.col("messages"))
    each = D.signed(prompt, images=shas).select("_seq", "text", shas.alias("shas"), "dedup_key", "dedup_images", "dedup_sig", T.prompt_reject_reason("text", T.count_tokens("text")).alias("late"), (F.size(M.by_role(F.col("messages"), "user")) == 0).alias("none")).orderBy("_seq").collect()
    kept, images, want = [], set(), {}
    for x in each:
        if x.none or not x.text:
            want[x._seq] = "no_user_turn" if x.none else "empty_prompt"
            continue
        near = [k for k in kept if k.dedup_images == x.dedup_images and sum(a == b for a, b in zip(k.dedup_sig, x.dedup_sig, strict=True)) / H.SLOTS >= H.THRESHOLD]
        reason = "duplicate_prompt" if x.dedup_key in {k.dedup_key for k in kept} else "near_duplicate" if near else "duplicate_images" if x.shas and set(x.shas) <= images else x.late
        want[x._seq] = reason
        if reason is None:
            kept.append(x)
            images |= set(x.shas)
    assert got == want and {"duplicate_prompt", "near_duplicate", "duplicate_images", "non_english", "prompt_too_short", None} <= set(want.values())
