"""Exact and near-duplicate rejection where the first row wins.

A sequential pass that accepts a row unless an accepted earlier row conflicts with it keeps the lexicographically first
maximal independent set of the conflict graph in the order of `_seq`. That set is found in rounds: a row stays when
all its earlier neighbours are out, and is out when one of them stays. Rows with one key are one group: its first row
alone takes part in the near-duplicate graph with the rest settled by it, so copies make no pairs.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeweave.functions import minhash as M
from lodeweave.functions import text as T
from lodeweave.sources.storage import small_batches, stored

#: Rounds after which open edges are counted, and how many of them are settled in order at once.
ROUNDS, MOST_LEFT = 8, 100_000


def signed(rows: DataFrame, text: Column | str = "text", images: Column | None = None, mode: str = "md5") -> DataFrame:
    """rows with dedup_key, dedup_images (the image identity) and dedup_sig."""
    images = F.array().cast("array<string>") if images is None else images
    small_batches(rows.sparkSession)
    return rows.withColumns({"dedup_key": T.row_key(text, images), "dedup_images": F.array_join(F.array_sort(images), ","), "dedup_sig": M.signature(text, mode)})


def _differ(threshold: float) -> int:
    """The most slots, and so bands, in which two signatures within the threshold differ."""
    if threshold <= 0.75:
        raise ValueError("below this threshold bands can miss pairs")
    return M.SLOTS - math.ceil(M.SLOTS * threshold)


def _rare_bands(tables: list[DataFrame], threshold: float) -> list[DataFrame]:
    """(k, key) of each table of signed rows: band keys of which any two rows within the threshold have one in common.

    Signatures within the threshold differ in few bands, so of each row as many bands and one more will do, if all rows
    choose alike: they take the rarest, and of these only such as occur again.
    """
    differ = _differ(threshold)
    # ids may repeat, so the signature's hash tells rows apart
    keyed = [d.select("k", F.xxhash64("dedup_sig", "dedup_images").alias("row"), F.explode(M.band_keys(F.col("dedup_sig"), F.col("dedup_images"))).alias("key")) for d in tables]
    often = reduce(DataFrame.unionByName, [d.select("key") for d in keyed]).groupBy("key").agg(F.count("*").alias("n"))
    chosen = F.slice(F.array_sort(F.collect_set(F.struct("n", "key"))), 1, differ + 1)
    few = [d.join(often, "key").groupBy("k", "row").agg(chosen.alias("keys")) for d in keyed]
    return [d.select("k", F.explode("keys").alias("x")).filter("x.n > 1").select("k", "x.key") for d in few]


def _within(pairs: DataFrame, left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """(a, b, est) of the pairs (a, b) of signed rows that have the same images and are within the threshold."""
    sig = lambda d, name, out: d.select(F.col("k").alias(name), F.struct("dedup_images", "dedup_sig").alias(out))
    full = pairs.join(sig(left, "a", "sa"), "a").join(sig(right, "b", "sb"), "b").filter("sa.dedup_images = sb.dedup_images")
    return full.withColumn("est", M.estimate(F.col("sa.dedup_sig"), F.col("sb.dedup_sig"))).filter(F.col("est") >= threshold).select("a", "b", "est")


def _in_bands(left: DataFrame, right: DataFrame) -> DataFrame:
    """(a, b) of rows (k, key) with a key in common."""
    return left.withColumnRenamed("k", "a").join(right.withColumnRenamed("k", "b"), "key")


def band_pairs(left: DataFrame, right: DataFrame, threshold: float = M.THRESHOLD, ordered: bool = True) -> DataFrame:
    """(a, b, est): rows of left and right (k, dedup_images, dedup_sig) that share a band, the images and the threshold.

    ordered: left and right are one table, and a comes before b. Only band keys and row keys are joined on bands; the
    signatures are joined to the distinct pairs.
    """
    if ordered:
        rare = stored(_rare_bands([left], threshold)[0], "bands")
        pairs = _in_bands(rare, rare).filter("a < b")
    else:
        pairs = _in_bands(*_rare_bands([left, right], threshold))
    return _within(pairs.select("a", "b").distinct(), left, right, threshold)


def first_of(rows: DataFrame, threshold: float = M.THRESHOLD) -> DataFrame:
    """(k, kept) of signed rows (k, dedup_images, dedup_sig): `first_wins` on the pairs within the threshold.

    A row that is the first in all its bands stays, and what is near it goes; comparing it with the rows of its bands makes
    no more pairs than there are band keys. This is repeated on what is left, as long as bands hold many pairs and a round
    takes a quarter of them away; the pairs of the rest are then made, so large groups of near copies are not.
    """
    live = stored(_rare_bands([rows], threshold)[0], "bands")
    most, settled_rows, before = 2 * live.count(), [], None
    while True:
        led = live.groupBy("key").agg(F.min("k").alias("lead"), F.count("*").alias("n"))
        inside = led.agg(F.coalesce(F.sum(F.col("n") * (F.col("n") - 1) / 2), F.lit(0.0))).first()[0]
        if inside <= most or (before is not None and inside > 0.75 * before):
            break
        before = inside
        marked = stored(live.join(led.select("key", "lead"), "key"), "marked")
        stay = stored(marked.groupBy("k").agg(F.min(F.col("k") == F.col("lead")).alias("first")).filter("first").select("k"), "first")
        pairs = marked.filter("lead < k").select(F.col("lead").alias("a"), F.col("k").alias("b")).distinct().join(stay.withColumnRenamed("k", "a"), "a", "left_semi")
        out = _within(pairs, rows, rows, threshold).select(F.col("b").alias("k")).distinct()
        step = stored(stay.withColumn("kept", F.lit(True)).unionByName(out.withColumn("kept", F.lit(False))), "settled")
        settled_rows.append(step)
        live = stored(live.join(step, "k", "left_anti"), "bands")
    edges = _within(_in_bands(live, live).filter("a < b").select("a", "b").distinct(), rows, rows, threshold)
    if not settled_rows:
        return first_wins(rows, edges)
    done = reduce(DataFrame.unionByName, settled_rows)
    return done.unionByName(first_wins(rows.select("k").join(done, "k", "left_anti"), edges))


def near_pairs(rows: DataFrame, threshold: float = M.THRESHOLD) -> DataFrame:
    """All pairs of rows (_seq, dedup_images, dedup_sig) within the threshold: (a, b, est) with a before b."""
    slim = rows.select(F.col("_seq").alias("k"), "dedup_images", "dedup_sig")
    return band_pairs(slim, slim, threshold)


def first_wins(nodes: DataFrame, edges: DataFrame, most_left: int = MOST_LEFT) -> DataFrame:
    """(k, kept) for nodes (k) with conflicts edges (a, b), a before b.

    Each round settles the first open row at least; after some rounds, a rest of at most `most_left` edges is settled in order.
    """
    edges = stored(edges.select("a", "b"), "edges")
    state = stored(nodes.select("k").join(edges.select(F.col("b").alias("k")).distinct(), "k", "left_semi").withColumn("kept", F.lit(None).cast("boolean")), "state")
    free = nodes.select("k").join(edges.select(F.col("b").alias("k")).distinct(), "k", "left_anti").withColumn("kept", F.lit(True))
    done = stored(free, "state")
    for turn in count(1):
        open_edges = edges.join(state.select(F.col("k").alias("b")), "b", "left_semi")
        seen = open_edges.join(done.select(F.col("k").alias("a"), "kept"), "a", "left")
        if turn % ROUNDS == 0:
            left = seen.select("a", "b", "kept").limit(most_left + 1).count()
            if left <= most_left:
                return done.unionByName(_in_order(seen, done))
            done = stored(done, "state")  # or its plan would grow with the rounds
        by = seen.groupBy(F.col("b").alias("k")).agg(F.max(F.coalesce("kept", F.lit(False))).alias("hit"), F.count_if(F.col("kept").isNull()).alias("unknown"))
        step = stored(by.withColumn("kept", F.when(F.col("hit"), F.lit(False)).when(F.col("unknown") == 0, F.lit(True))), "state")
        settled = step.filter("kept IS NOT NULL").select("k", "kept")
        done = done.unionByName(settled)
        state = step.filter("kept IS NULL").select("k", "kept")
        if state.limit(1).count() == 0:
            return done


def _in_order(seen: DataFrame, done: DataFrame) -> DataFrame:
    """(k, kept) of the open rows b, from their edges (a, b, kept of a or null), row by row."""
    kept: dict = {}
    for a, b, known in seen.select("a", "b", "kept").orderBy("b").collect():  # few: see most_left
        kept[b] = kept.get(b, True) and not (kept[a] if known is None else known)
    return seen.sparkSession.createDataFrame(list(kept.items()), done.schema)


def dedup_reasons(rows: DataFrame, threshold: float = M.THRESHOLD, mode: str = "md5", text: str = "text", images: Column | None = None) -> DataFrame:
    """(_seq, reason): duplicate_prompt, near_duplicate, or null for a row that is kept.

    A copy of a kept row is a duplicate; a copy of a rejected one is rejected for the same neighbour. rows: _seq and the text.
    """
    return settled(stored(signed(rows.filter(F.col(text).isNotNull()), text, images, mode).select("_seq", "dedup_key", "dedup_images", "dedup_sig"), "signs"), threshold)


def settled(signs: DataFrame, threshold: float = M.THRESHOLD) -> DataFrame:
    """The reasons of `dedup_reasons` for signed rows."""
    heads = signs.groupBy("dedup_key").agg(F.min("_seq").alias("head"))
    first = stored(signs.join(heads, (signs["dedup_key"] == heads["dedup_key"]) & (signs["_seq"] == heads["head"]), "left_semi").select(F.col("_seq").alias("k"), "dedup_images", "dedup_sig"), "heads")
    # rows of one signature stand against the same rows, so all but the first of them are out, whether it is kept or not
    classes = stored(first.groupBy("dedup_images", "dedup_sig").agg(F.min("k").alias("k")), "classes")
    verdict = first_of(classes, threshold)
    every = signs.select("_seq", "dedup_key").join(heads, "dedup_key").join(verdict.select(F.col("k").alias("head"), "kept"), "head", "left")
    reason = F.when(~F.coalesce("kept", F.lit(False)), "near_duplicate").when(F.col("_seq") != F.col("head"), "duplicate_prompt")
    return every.select("_seq", reason.alias("reason"))


def reasons_against(signs: DataFrame, kept: DataFrame, threshold: float = M.THRESHOLD) -> DataFrame:
    """(_seq, reason) of signed rows that an earlier one of the signed rows `kept` stands against; the others are not in it.

    Rows with one key are compared once, with the earliest kept neighbour of the key.
    """
    copies = kept.groupBy("dedup_key").agg(F.min("_seq").alias("copy"))
    keys = signs.groupBy("dedup_key").agg(F.first("dedup_images").alias("dedup_images"), F.first("dedup_sig").alias("dedup_sig")).withColumnRenamed("dedup_key", "k")
    pairs = band_pairs(kept.select(F.col("_seq").alias("k"), "dedup_images", "dedup_sig"), keys, threshold, ordered=False)
    near = pairs.groupBy(F.col("b").alias("dedup_key")).agg(F.min("a").alias("near"))
    every = signs.select("_seq", "dedup_key").join(copies, "dedup_key", "left").join(near, "dedup_key", "left")
    reason = F.when(F.col("copy") < F.col("_seq"), "duplicate_prompt").when(F.col("near") < F.col("_seq"), "near_duplicate")
    return every.select("_seq", reason.alias("reason")).filter("reason IS NOT NULL")


def seen_images(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """(_seq) of rows (_seq, shas) with images, all of which earlier rows of `kept` (_seq, shas) have."""
    first = kept.select("_seq", F.explode("shas").alias("sha")).groupBy("sha").agg(F.min("_seq").alias("first"))
    each = rows.select("_seq", F.explode("shas").alias("sha")).join(first, "sha", "left")
    return each.groupBy("_seq").agg(F.min(F.coalesce(F.col("first") < F.col("_seq"), F.lit(False))).alias("seen")).filter("seen").select("_seq")


def image_novelty(rows: DataFrame) -> DataFrame:
    """(_seq, novel) of rows (_seq, shas): a row with images is novel if one of them is in no novel earlier row.

    In rounds, as a row is settled once, for each of its images, the first row that is novel with it is known: a row is
    novel if it is the first undecided or novel row for one of its images.
    """
    pairs = stored(rows.select("_seq", F.explode("shas").alias("sha")).distinct(), "images")
    out = None
    while True:
        first = pairs.groupBy("sha").agg(F.min("_seq").alias("first"))
        marked = pairs.join(first, "sha")
        novel = marked.filter("_seq = first").select("_seq").distinct()
        step = stored(novel.withColumn("novel", F.lit(True)), "novel")
        out = step if out is None else out.unionByName(step)
        # images that a novel row has are seen for all rows after it; what is left of the others decides them
        seen = pairs.join(step, "_seq").groupBy("sha").agg(F.min("_seq").alias("seen"))
        left = pairs.join(step, "_seq", "left_anti").join(seen, "sha", "left").filter("seen IS NULL OR _seq < seen").select("_seq", "sha")
        pairs = stored(left, "images")
        if pairs.limit(1).count() == 0:
            break
    has = rows.filter(F.size("shas") > 0).select("_seq").distinct()
    return has.join(out.groupBy("_seq").agg(F.max("novel").alias("novel")), "_seq", "left").select("_seq", F.coalesce("novel", F.lit(False)).alias("novel"))
