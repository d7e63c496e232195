"""Scratch tables: results that are reused or that end a lineage are written to the folder all nodes share."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession


#: A scan of fewer files than cores and of at most so many bytes is dealt out.
FEW_BYTES = 64 << 20


def shared_dir(spark: SparkSession) -> str:
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all nodes share")
    return (at or "file:///tmp/checkpoints/lodeweave").rstrip("/")


def dealt(df: DataFrame) -> DataFrame:
    """A small table in few files, dealt out to all cores: its row groups fill few tasks. Anything larger stays as it is scanned."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores) if size <= FEW_BYTES and len(df.inputFiles()) < cores else df


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of 8 MB at most, whatever their rows weigh."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def stored(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lodeweave-{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # noqa: BLE001  the session has ended before
        pass
