"""Scans: JSON lines in two modes, caches that may be torn, source catalogs and quotas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodeweave import schema as S
from lodeweave.functions import messages as M
from lodeweave.functions import text as T

SOURCE_COLUMNS = "dataset string, config string, split string, domain string, cap bigint, adapter string, teacher boolean, anchored_on double"
CACHE = f"key string, completion struct<content: string, tool_calls: array<{S.CALL}>>, accepted boolean"


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Blank lines are skipped; a line that is no JSON fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_canonical(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, S.CANONICAL)


def with_seq(rows: DataFrame, *order: str) -> DataFrame:
    """rows with _seq, their place by the given columns.

    Ranges of the first column's hash-free order are counted first, so that no task numbers all rows: `order` must be
    what makes a row's place unique.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33))
    from lodeweave.sources.storage import stored

    ranged = stored(ranged, "seq")
    counts = ranged.groupBy("__part").agg(F.count("*").alias("n"))
    starts = counts.select("__part", (F.sum("n").over(W.partitionBy().orderBy("__part")) - F.col("n")).alias("__start"))  # a row for each partition
    return ranged.join(F.broadcast(starts), "__part").withColumn("_seq", F.col("__start") + F.col("__at")).drop("__part", "__at", "__start")


def catalog(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """The source table; missing fields are null."""
    names = [x.split()[0] for x in SOURCE_COLUMNS.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], SOURCE_COLUMNS)


def source_metadata(sources: DataFrame, known: DataFrame) -> DataFrame:
    """sources with license and revision where they are known."""
    return sources.join(F.broadcast(known), "dataset", "left")  # the catalog: a row for each dataset


def harvest_seeds(rows: DataFrame, name: str, config: str | None, split: str, field: str, cap: int) -> DataFrame:
    """(id, source, config, text, _seq): the first `cap` texts that are not blank; the running number is part of the id."""
    text = T.strip(F.coalesce(F.col(field), F.lit("")))
    first = rows.select("_seq", text.alias("text")).filter("text <> ''").orderBy("_seq").limit(cap)
    number = F.row_number().over(W.partitionBy().orderBy("_seq")) - 1  # `cap` rows at most
    return first.withColumn("id", F.concat(F.lit(f"{name.split('/')[-1]}-{config or 'default'}-{split}-"), number.cast("string"))).select("id", F.lit(name).alias("source"), F.lit(config).cast("string").alias("config"), "text", "_seq")


def eval_set(rows: DataFrame, text: Column, most: int = 2000) -> DataFrame:
    """(text) of the first `most` rows scanned; blank ones count and go."""
    return rows.orderBy("_seq").limit(most).select(T.strip(F.coalesce(text, F.lit(""))).alias("text")).filter("text <> ''")


def local_prompts(rows: DataFrame) -> DataFrame:
    """(text): the column text where there is one, else all user turns of messages."""
    x = F.col("text") if "text" in rows.columns else F.lit(None).cast("string")
    if "messages" in rows.columns:
        x = F.coalesce(x, M.user_text(F.col("messages")))
    return rows.select(x.alias("text")).filter("text <> ''")


def read_cache(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(entries, bad): one entry for each key, and the lines that are none.

    The first entry of a key wins, but one that holds a completion comes before one that does not. The order of lines is
    that of files by name and places within them.
    """
    raw = spark.read.schema(CACHE + ", _corrupt_record string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    raw = raw.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__at"))
    from lodeweave.sources.storage import stored

    lines = stored(raw, "cache")
    return first_entries(lines.filter("_corrupt_record IS NULL AND key IS NOT NULL"), "__file", "__block", "__at").drop("_corrupt_record", "__file", "__block", "__at"), lines.filter("_corrupt_record IS NOT NULL OR key IS NULL").select("_corrupt_record")


def first_entries(lines: DataFrame, *order: str) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("key").orderBy(F.col("completion").isNull(), *order))
    return lines.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")
