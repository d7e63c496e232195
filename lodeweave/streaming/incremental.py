"""Streams: an incremental dedup index, a first-write-wins cache, an append ledger, and event-time windows.

Incremental dedup runs one micro-batch at a time against the stored signatures of all rows accepted so far: the batch's
conflicts with the index are a band join, its conflicts within itself are settled first-wins, and the survivors are
appended under the batch's number. A batch that is run again after a failure overwrites its own part, so nothing is
counted twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from lodeweave.functions import minhash as M
from lodeweave.operators import dedup as D
from lodeweave.sources.sinks import exists
from lodeweave.sources.storage import stored


def accept_batch(batch: DataFrame, number: int, path: str, threshold: float = M.THRESHOLD, mode: str = "md5") -> DataFrame:
    """Settles a batch (_seq, text) against the index under path, appends its survivors, and returns (_seq, reason)."""
    spark = batch.sparkSession
    new = stored(D.signed(batch, mode=mode).select(F.col("_seq").cast("long").alias("_seq"), "dedup_key", "dedup_images", "dedup_sig"), "batch")
    none = new.select(F.col("_seq"), F.lit("").alias("reason")).limit(0)
    hit = none
    if exists(spark, path):
        index = spark.read.parquet(path).filter(F.col("batch") < number)
        exact = new.join(index.select("dedup_key").distinct(), "dedup_key", "left_semi").select("_seq", F.lit("duplicate_prompt").alias("reason"))
        slim = lambda d: d.select(F.col("_seq").alias("k"), "dedup_images", "dedup_sig")
        near = D.band_pairs(slim(new), slim(index), threshold, ordered=False).select(F.col("a").alias("_seq")).distinct().withColumn("reason", F.lit("near_duplicate"))
        hit = stored(exact.unionByName(near.join(exact.select("_seq"), "_seq", "left_anti")), "hits")
    rest = new.join(hit.select("_seq"), "_seq", "left_anti")
    heads = rest.groupBy("dedup_key").agg(F.min("_seq").alias("head"))
    first = stored(rest.join(heads, F.col("_seq") == F.col("head"), "left_semi").select(F.col("_seq").alias("k"), "dedup_images", "dedup_sig"), "heads")
    verdict = D.first_wins(first, D.band_pairs(first, first, threshold))
    inside = rest.join(heads, "dedup_key").join(verdict.select(F.col("k").alias("head"), "kept"), "head")
    reason = F.when(~F.col("kept"), "near_duplicate").when(F.col("_seq") != F.col("head"), "duplicate_prompt")
    reasons = stored(inside.select("_seq", reason.alias("reason")).unionByName(hit), "reasons")
    kept = new.join(reasons.filter("reason IS NULL").select("_seq"), "_seq", "left_semi")
    kept.write.mode("overwrite").parquet(f"{path}/batch={number}")
    return reasons


def dedup_stream(rows: DataFrame, path: str, ledger: str, checkpoint: str, **how) -> DataStreamWriter:
    """A writer that settles each micro-batch of rows (_seq, text) and appends its rejections to the ledger."""

    def settle(batch: DataFrame, number: int) -> None:
        accept_batch(batch, number, path, **how).filter("reason IS NOT NULL").write.mode("overwrite").json(f"{ledger}/batch={number}")

    return rows.writeStream.foreachBatch(settle).option("checkpointLocation", checkpoint)


def first_seen(events: DataFrame, key: str) -> DataFrame:
    """The first row of each key that arrives, on a stream or a table (there by no particular order)."""
    return events.dropDuplicates([key])


def append_ledger(rows: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    return rows.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")


# Extensions: event-time windows. The same expressions serve tables and streams.


def _watermarked(events: DataFrame, late: str | None, ts: str) -> DataFrame:
    """A stream's watermark, which asks for a time with a zone (that of the session)."""
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late) if late and events.isStreaming else events


def windowed(events: DataFrame, window: Column, late: str | None = None, ts: str = "ts") -> DataFrame:
    events = _watermarked(events, late, ts)
    by = events.groupBy(window.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return by.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_type", "n", "total")


def tumbling(events: DataFrame, size: str = "1 hour", late: str | None = "1 hour") -> DataFrame:
    return windowed(events, F.window("ts", size), late)


def sliding(events: DataFrame, size: str = "1 hour", step: str = "30 minutes", late: str | None = "1 hour") -> DataFrame:
    return windowed(events, F.window("ts", size, step), late)


def sessions(events: DataFrame, gap: str = "30 minutes", late: str | None = "1 hour") -> DataFrame:
    events = _watermarked(events, late, "ts")
    by = events.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))
    return by.select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")
