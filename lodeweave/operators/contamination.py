"""The evaluation-set guard: exact hits by key, near hits by bands, and whole passages contained in a text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeweave.functions import minhash as M
from lodeweave.functions import text as T
from lodeweave.operators.dedup import band_pairs
from lodeweave.sources.storage import small_batches, stored

#: Bytes of evaluation texts up to which they are sent to all tasks.
SENT = 8 << 20


def exact_hits(rows: DataFrame, evals: DataFrame, row_id: str = "id", text: str = "text") -> DataFrame:
    keys = evals.select(T.text_key("text").alias("key")).distinct()
    return rows.withColumn("key", T.text_key(text)).join(keys, "key", "left_semi").select(row_id)


def near_hits(rows: DataFrame, evals: DataFrame, threshold: float = M.THRESHOLD, mode: str = "md5", row_id: str = "id", text: str = "text") -> DataFrame:
    """Rows within the threshold of an evaluation text."""
    small_batches(rows.sparkSession)
    signed = lambda d, k, x: stored(d.select(F.col(k).alias("k"), F.lit("").alias("dedup_images"), M.signature(x, mode).alias("dedup_sig")), "signs")
    pairs = band_pairs(signed(rows, row_id, text), signed(evals.withColumn("eval_id", F.xxhash64("text")).dropDuplicates(["eval_id"]), "eval_id", "text"), threshold, ordered=False)
    return pairs.select(F.col("a").alias(row_id)).distinct()


def collisions(rows: DataFrame, evals: DataFrame, threshold: float = M.THRESHOLD, mode: str = "md5", row_id: str = "id", text: str = "text") -> DataFrame:
    """(row_id, kind): exact, or else near. Rows without text are left out; exact hits take no part in the near search."""
    rows = rows.filter(F.col(text) != "")
    exact = stored(exact_hits(rows, evals, row_id, text), "exact")
    rest = rows.join(exact, row_id, "left_anti")
    return exact.withColumn("kind", F.lit("exact")).unionByName(near_hits(rest, evals, threshold, mode, row_id, text).withColumn("kind", F.lit("near")))


def contained(rows: DataFrame, evals: DataFrame, row_id: str = "doc_id", text: str = "text", words: int = 4) -> DataFrame:
    """(row_id, item_id): evaluation texts that a row contains, both in their normal form.

    An evaluation text of `words` words or more meets a row by the first whole run of words in it, as an equi-join, and is then
    looked for; only shorter ones (which a broadcast of a checked size takes) are looked for in every row.
    """
    items = stored(evals.select("item_id", T.normalise("text").alias("item")).filter("item <> ''"), "items")
    texts = rows.select(F.col(row_id).alias("row_id"), T.normalise(text).alias("row_text"))
    runs = lambda y: T.let(y, lambda x: F.transform(F.sequence(F.lit(1), F.greatest(F.size(x) - words + 1, F.lit(1))), lambda i: F.xxhash64(F.array_join(F.slice(x, i, words), " "))))
    # the words at both ends may be parts of words in the row, so the run starts at the second word
    tokens = F.split("item", " ")
    long_enough = F.size(tokens) >= words + 2
    keyed = items.filter(long_enough).withColumn("key", F.xxhash64(F.array_join(F.slice(tokens, 2, words), " ")))
    hits = texts.select("row_id", F.explode(F.array_distinct(runs(F.split("row_text", " ")))).alias("key")).join(keyed.select("item_id", "key"), "key").select("row_id", "item_id").distinct()
    full = hits.join(keyed.select("item_id", "item"), "item_id").join(texts, "row_id").filter(F.contains("row_text", F.col("item"))).select("row_id", "item_id")
    short = items.filter(~long_enough)
    size = short.agg(F.coalesce(F.sum(F.octet_length("item")), F.lit(0))).first()[0]
    if size > SENT:
        raise ValueError("too many evaluation texts of a few words")
    few = texts.join(F.broadcast(short), F.contains("row_text", F.col("item"))).select("row_id", "item_id")
    return full.unionByName(few).distinct().withColumnRenamed("row_id", row_id)


def field_text(row: Column) -> Column:
    """The text of a field that holds (user, assistant) pairs: the first pair's user, or else its assistant."""
    first = F.try_element_at(row, F.lit(1))
    return T.strip(F.coalesce(F.when(first["user"] != "", first["user"]), first["assistant"], F.lit("")))
