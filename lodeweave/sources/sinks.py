"""Sinks: JSON lines, manifests, append-only tables, content-addressed images, reports. Guards run before anything is written."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeweave.functions import parsing as P


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _path(spark, path)
    return fs.exists(at)


def write_jsonl(rows: DataFrame, path: str) -> int:
    """Overwrites; the number of rows, counted while they are written."""
    from pyspark.sql import Observation

    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(path)
    return seen.get["n"]


def guard_shrink(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """Refuses to put fewer rows in place of what is there."""
    if exists(spark, path) and rows.count() < (had := spark.read.text(path).count()):
        raise ValueError(f"{path} has {had} rows, more than would take their place")


def write_text(path: str, text: str, spark: SparkSession) -> None:
    at, fs = _path(spark, path)
    out = fs.create(at, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(path: str, spark: SparkSession) -> str:
    return "\n".join(r[0] for r in spark.read.option("wholetext", True).text(path).collect())  # one small file


def manifest(run: dict, sources: DataFrame, drops: DataFrame, train: DataFrame, val: DataFrame) -> dict[str, Any]:
    """The run's report; all parts are tables of a row for each source, reason or domain."""
    rows = lambda d: [r.asDict() for r in d.collect()]
    return {"run": run, "sources": rows(sources), "drops": {r[0]: r[1] for r in drops.collect()}, "train": rows(train), "val": rows(val)}


def write_manifest(spark: SparkSession, path: str, report: dict) -> None:
    write_text(path, json.dumps(report, indent=2, ensure_ascii=False), spark)


def merge_manifest(spark: SparkSession, path: str, more: dict) -> dict:
    """The manifest with further entries."""
    report = json.loads(read_text(path, spark)) | more
    write_manifest(spark, path, report)
    return report


def put_cache(spark: SparkSession, path: str, entries: DataFrame, upgrade: bool = False) -> None:
    """Appends entries whose key is not there; with upgrade also those that bring a completion to a key without one."""
    from lodeweave.sources.readers import first_entries, read_cache

    new = first_entries(entries.withColumn("__at", F.monotonically_increasing_id()), "__at").drop("__at")
    if exists(spark, path):
        had, _ = read_cache(spark, path)
        keys = had.filter("completion IS NOT NULL") if upgrade else had
        new = new.join(keys.select("key"), "key", "left_anti")
    new.write.mode("append").json(path)


def append_rejects(rejects: DataFrame, path: str) -> None:
    """rejects: (stage, reason, detail, pool, id, record)."""
    rejects.select("stage", "reason", "detail", "pool", "id", "record").write.mode("append").partitionBy("stage").json(path)


_MAGIC = {b"\x89PNG\r\n\x1a\n": "png", b"\xff\xd8\xff": "jpg", b"GIF8": "gif", b"BM": "bmp"}


def _sniff(raw: bytes) -> tuple[str, int | None, int | None]:
    """Format, width and height from the head of an image; sizes for PNG, GIF and JPEG."""
    kind = next((k for magic, k in _MAGIC.items() if raw.startswith(magic)), "webp" if raw[:4] == b"RIFF" and raw[8:12] == b"WEBP" else "bin")
    if kind == "png":
        return kind, int.from_bytes(raw[16:20], "big"), int.from_bytes(raw[20:24], "big")
    if kind == "gif":
        return kind, int.from_bytes(raw[6:8], "little"), int.from_bytes(raw[8:10], "little")
    if kind == "jpg":
        at = 2
        while at + 9 < len(raw) and raw[at] == 0xFF:
            if 0xC0 <= raw[at + 1] <= 0xCF and raw[at + 1] not in (0xC4, 0xC8, 0xCC):
                return kind, int.from_bytes(raw[at + 7 : at + 9], "big"), int.from_bytes(raw[at + 5 : at + 7], "big")
            at += 2 + int.from_bytes(raw[at + 2 : at + 4], "big")
    return kind, None, None


def image_store(images: DataFrame) -> DataFrame:
    """(sha256, path, w, h, content): each image (content) once, under aa/<sha>.<format>."""

    def sniff(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_sniff(bytes(x)) for x in batch["content"]]
            yield batch.assign(path=[f"{s[:2]}/{s}.{k}" for s, (k, _, _) in zip(batch["sha256"], found, strict=True)], w=pd.array([w for _, w, _ in found], "Int32"), h=pd.array([h for _, _, h in found], "Int32"))[["sha256", "path", "w", "h", "content"]]

    # the store is keyed before contents move: copies are dropped by their key
    keyed = images.select(F.sha2("content", 256).alias("sha256"), "content").dropDuplicates(["sha256"])
    return keyed.mapInPandas(sniff, "sha256 string, path string, w int, h int, content binary")


def unresolved_images(rows: DataFrame, store: DataFrame, shas: str) -> DataFrame:
    return rows.select(F.explode(shas).alias("sha256")).distinct().join(store.select("sha256"), "sha256", "left_anti")


def guard_images(rows: DataFrame, store: DataFrame, shas: str) -> None:
    if missing := [r[0] for r in unresolved_images(rows, store, shas).limit(5).collect()]:
        raise ValueError(f"images are not in the store, such as {missing}")


def write_chunks(chunks: DataFrame, path: str) -> None:
    """One chunk a line."""
    chunks.select(F.regexp_replace("text", r"\R", " ").alias("value")).write.mode("overwrite").text(path)


def audit_report(sample: DataFrame) -> str:
    """Markdown of a sample (a few rows for each domain): id, domain, text."""
    out, last = ["# Audit sample"], None
    for r in sample.select("domain", "id", "text").orderBy("domain", "id").collect():
        if r["domain"] != last:
            out.append(f"\n## {r['domain']}")
            last = r["domain"]
        out.append(f"\n### {r['id']}\n\n{r['text']}")
    return "\n".join(out) + "\n"


def repair_tools(rows: DataFrame) -> DataFrame:
    """rows with canonical tools, and `fixed` where that changed them."""
    return rows.withColumn("__found", P.aliases_in("tools")).withColumn("tools", F.when(F.size("__found") > 0, P.canonical_tools("tools")).otherwise(F.col("tools"))).withColumn("fixed", F.size("__found") > 0).drop("__found")


def alias_counts(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode(P.aliases_in("tools")).alias("type")).groupBy("type").agg(F.count("*").alias("n"))


def repair_table(spark: SparkSession, path: str, dry_run: bool = False) -> tuple[int, int]:
    """(rows, fixed) of canonical rows under path; written anew beside it and swapped, if something changed."""
    from lodeweave.sources.readers import read_canonical

    repaired = repair_tools(read_canonical(spark, path))
    n, fixed = repaired.agg(F.count("*"), F.count_if("fixed")).first()
    if fixed and not dry_run:
        repaired.drop("fixed").write.mode("overwrite").json(path + ".new")
        at, fs = _path(spark, path)
        old, _ = _path(spark, path + ".old")
        fs.rename(at, old)
        fs.rename(_path(spark, path + ".new")[0], at)
        fs.delete(old, True)
    return n, fixed
