"""Group-wise quantization of vectors, channel choice and counters, as array expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodeweave.functions.text import let

EPS_HALF, EPS_FLOAT = 1e-4, 1e-6


def fake_quant(x: Column, size: int, group: int, bits: int, eps: float = EPS_FLOAT) -> Column:
    """x (of `size` values) quantized in groups of `group` to 2^bits levels between each group's least and greatest, and back."""
    if size % group:
        raise ValueError("the length is no multiple of the group")
    if bits >= 16:
        return x
    top = float(2**bits - 1)

    def one(g: Column) -> Column:
        least = F.array_min(g)
        scale = F.greatest(F.array_max(g) - least, F.lit(eps)) / top
        return F.transform(g, lambda v: F.bround(F.least(F.greatest((v - least) / scale, F.lit(0.0)), F.lit(top))) * scale + least)

    wide = x.cast("array<double>")
    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(size // group - 1)), lambda k: one(F.slice(wide, k * group + 1, group))))


def promoted_channels(vectors: DataFrame, column: str, ratio: float, strategy: str = "magnitude", seed: int = 0) -> DataFrame:
    """(channel, promoted): the int(D * ratio + 1e-6) channels with the most mean |x|, variance, or by a hash (random)."""
    each = vectors.select(F.posexplode(column).alias("channel", "x"))
    score = {"magnitude": F.avg(F.abs("x")), "variance": F.var_pop("x"), "random": F.min(F.crc32(F.concat(F.lit(f"{seed}|"), F.col("channel").cast("string")).cast("binary")))}[strategy]
    by = each.groupBy("channel").agg(score.alias("score"))
    whole = W.partitionBy()  # a row for each channel
    k = F.floor(F.count("*").over(whole) * ratio + 1e-6)
    return by.select("channel", (F.row_number().over(whole.orderBy(F.desc("score"), "channel")) <= k).alias("promoted"))


def pages_retired(length: Column, sink: int = 32, buffer: int = 128) -> Column:
    """Key pages quantized once `length` tokens are cached."""
    return F.greatest(F.lit(0), F.floor((length - sink - 1) / buffer)).cast("long")


def values_retired(length: Column, sink: int = 32, buffer: int = 128) -> Column:
    """Single value tokens quantized once `length` tokens are cached."""
    return F.greatest(F.lit(0), length - sink - buffer).cast("long")


def kl(p_logits: Column, q_logits: Column) -> Column:
    """Sum of p (log p - log q) over the classes of two rows of logits."""
    def log_softmax(x: Column) -> Column:
        less = lambda top: F.transform(x, lambda v: v - top)
        return let(let(F.array_max(x), less), lambda y: let(F.log(F.aggregate(y, F.lit(0.0), lambda s, v: s + F.exp(v))), lambda total: F.transform(y, lambda v: v - total)))

    pairs = F.zip_with(log_softmax(p_logits), log_softmax(q_logits), lambda a, b: F.exp(a) * (a - b))
    return F.aggregate(pairs, F.lit(0.0), lambda s, v: s + v)


def window_nll(tokens: DataFrame, prefill: int) -> DataFrame:
    """tokens (window, pos, nll): by window, sums over prefill and decode positions; position `prefill` is the first decode term."""
    decode = F.col("pos") >= prefill
    return tokens.filter("pos > 0").groupBy("window").agg(
        F.sum(F.when(~decode, F.col("nll"))).alias("prefill_nll"), F.count_if(~decode).alias("prefill_n"), F.sum(F.when(decode, F.col("nll"))).alias("decode_nll"), F.count_if(decode).alias("decode_n"),
    )
