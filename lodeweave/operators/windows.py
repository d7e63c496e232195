"""Ordered operators: row numbers, token windows, the packer that resets, runs, and top channels."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MIN_CHARS, MAX_CHARS = 8000, 16000


def row_index(rows: DataFrame, by: list[str], start: int = 1) -> DataFrame:
    return running_start(rows, F.lit(1), by).withColumn("row", F.col("start") + start).drop("start")


def running_start(rows: DataFrame, size: Column, by: list[str] | None = None, order: str = "_seq", width: int = 4096) -> DataFrame:
    """rows with `start`: the sum of `size` over the rows before, by order, within each group of `by` (null is one).

    The order's values (integers, each once in a group) are cut into ranges; a sum for each range, and running sums of
    these, leave only the rows of one range to a task, so one long series is no single task.
    """
    by = by or []
    ranged = rows.withColumn("__size", size).withColumn("__range", F.floor(F.col(order) / width))
    sums = ranged.groupBy(*by, "__range").agg(F.sum("__size").alias("__sum"))
    first = sums.select(*by, "__range", (F.sum("__sum").over(W.partitionBy(*by).orderBy("__range")) - F.col("__sum")).alias("__first"))
    inner = W.partitionBy(*by, "__range").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    own = ranged.withColumn("__own", F.sum("__size").over(inner) - F.col("__size"))
    return null_safe_join(own, first, [*by, "__range"]).withColumn("start", F.col("__first") + F.col("__own")).drop("__range", "__size", "__first", "__own")


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """An inner join on keys in which null equals null; the left side's columns and the right side's others."""
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    return left.alias("l").join(right.alias("r"), same).select("l.*", *(F.col(f"r.{c}") for c in right.columns if c not in keys))


def hash_rank(rows: DataFrame, by: list[str], h: str, tie: str, ranges: int = 256) -> DataFrame:
    """rows with `__rank`: their place (from 1) by (h, tie) within each group of `by`; h is a column of hex digits.

    Hashes are uniform, so equal ranges of their first digits hold about as many rows each; a count for each range gives
    its rows' offset, and only the rows of one range are sorted together.
    """
    ranged = rows.withColumn("__range", F.floor(F.conv(F.substring(h, 1, 6), 16, 10).cast("long") * ranges / (1 << 24)))
    counts = ranged.groupBy(*by, "__range").agg(F.count("*").alias("__n"))
    starts = counts.select(*by, "__range", (F.sum("__n").over(W.partitionBy(*by).orderBy("__range")) - F.col("__n")).alias("__start"))
    nth = F.row_number().over(W.partitionBy(*by, "__range").orderBy(h, tie))
    return null_safe_join(ranged.withColumn("__nth", nth), starts, [*by, "__range"]).withColumn("__rank", F.col("__start") + F.col("__nth")).drop("__range", "__start", "__nth")


def token_windows(rows: DataFrame, tokens: str, length: int, order: str = "_seq") -> DataFrame:
    """(window, tokens): all token lists in a row, cut into windows of exactly `length`; the remainder is dropped."""
    placed = running_start(rows.filter(F.size(tokens) > 0), F.size(tokens), order=order)
    # a list gives one piece to each window that it reaches into
    first, last = F.floor(F.col("start") / length), F.floor((F.col("start") + F.size(tokens) - 1) / length)
    pieces = placed.withColumn("window", F.explode(F.sequence(first, last))).withColumn("at", F.greatest(F.col("start"), F.col("window") * length))
    ends = F.least(F.col("start") + F.size(tokens), (F.col("window") + 1) * length)
    cut = F.slice(F.col(tokens), (F.col("at") - F.col("start") + 1).cast("int"), (ends - F.col("at")).cast("int"))
    out = pieces.select("window", "at", cut.alias("piece")).groupBy("window").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "piece"))), lambda x: x["piece"])).alias("tokens"))
    return out.filter(F.size("tokens") == length)


def pack_chunks(rows: DataFrame, text: str = "text", chunks: int | None = None, least: int = MIN_CHARS, most: int = MAX_CHARS, by: str | None = None) -> DataFrame:
    """(chunk, text): texts in the order of _seq, joined by spaces until they have `least` characters, cut to `most`.

    The count starts anew behind each chunk, so where a chunk ends depends on all before it: rows of one series (by)
    are packed one after the other in one task, in batches; only sizes decide, and the texts are joined to them behind.
    The series' sizes are 16 bytes a row; many series are packed side by side.
    """
    key = F.lit(0) if by is None else F.col(by)
    sizes = rows.filter(F.coalesce(F.col(text), F.lit("")) != "").select(key.alias("series"), F.col("_seq").cast("long").alias("_seq"), F.char_length(text).cast("long").alias("size"))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        series, chunk, size = None, 0, 0
        for batch in batches:
            out = []
            for s, n in zip(batch["series"], batch["size"], strict=True):
                if s != series:
                    series, chunk, size = s, 0, 0
                out.append(chunk)
                size += n
                if size >= least:
                    chunk, size = chunk + 1, 0
            yield batch.assign(chunk=out)

    kind = sizes.schema["series"].dataType.simpleString()
    ordered = sizes.repartition("series").sortWithinPartitions("series", "_seq")
    placed = ordered.mapInPandas(pack, f"series {kind}, _seq long, size long, chunk long")
    if chunks is not None:
        placed = placed.filter(F.col("chunk") < chunks)
    texts = rows.select(key.alias("series"), F.col("_seq").cast("long").alias("_seq"), F.col(text).alias("text"))
    joined = placed.join(texts, ["series", "_seq"]).groupBy("series", "chunk").agg(F.sum("size").alias("n"), F.array_sort(F.collect_list(F.struct("_seq", "text"))).alias("x"))
    out = joined.filter(F.col("n") >= least).select("series", "chunk", F.substring(F.array_join(F.transform("x", lambda x: x["text"]), " "), 1, most).alias("text"))
    return out if by is not None else out.drop("series")


def runs(turns: DataFrame, by: list[str], order: str, value: Column) -> DataFrame:
    """turns with `run`: a number for each stretch of equal values."""
    w = W.partitionBy(*by).orderBy(order)
    changed = F.when(value.eqNullSafe(F.lag(value).over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    return turns.withColumn("__changed", changed).withColumn("run", F.sum("__changed").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("__changed")


def most_common(rows: DataFrame, column: str, n: int | None = None) -> DataFrame:
    out = rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)
    return out if n is None else out.limit(n)
