"""A quality classifier: histogram gradient-boosted trees over statistics of a document's text.

The statistics come from the text alone, are made in one pass over all whole texts, and are stored (some 30 numbers a
document). The trees are fitted on the driver on TRAIN_ROWS labelled rows at most, those with the smallest hash, of the
rows not held out; the bound is the parameter `train_rows`. The rows are counted first, and only those whose hash is
below the share that gives `train_rows` (and a few standard deviations) leave the executors, so what the driver gets
does not grow with the input or its partitions. Scores are made from the stored statistics by walking all trees for a
batch at a time.

Cases: a null text is empty and is scored like any text; a label of null or for no document is not learned from; a
document that has several labels is learned from with each; a null id counts as the empty text for the choice of rows;
rows that repeat are scored each, and those alike in id, label and statistics are learned from once; no labels, or
labels of one kind, give a constant score; long texts are never cut; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeweave.llm.common import SpanHash, code_points, flat_bytes, lowered, mix, pieces_of, read_table, remainder, small_batches, stored, sums_by
from lodeweave.llm.quality import Lines
from lodeweave.llm.trees import Trees, fit

MODULUS, HELD_OUT = 3, 1
TRAIN_ROWS = 20_000
#: Kinds of bytes whose shares are features.
_KINDS = [b"#", b"*", b"$", b"%", b"&", b"|", b"<>", b"!", b"?", b".", b",", b";:", b"\"'()[]{}", b"/\\@_=+~^`-", b"0123456789", bytes(range(65, 91)), bytes(range(97, 123)), b" ", b"\n", b"\t\r\x0b\x0c"]
_TABLES = np.zeros((len(_KINDS) + 1, 256), bool)
for _i, _kind in enumerate(_KINDS):
    _TABLES[_i, list(_kind)] = True
_TABLES[-1, 128:] = True


def statistics(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of numbers for each text."""
    lines = Lines(buf, offsets)
    base = lines.base()
    n = len(offsets) - 1
    n_bytes = np.diff(offsets)
    words = np.maximum(base["n_words"], 1)
    count = np.bincount(lines.row, minlength=n)
    some = np.maximum(count, 1)
    sizes = lines.ends - lines.starts
    row = np.repeat(np.arange(n), base["n_words"])
    longest = np.zeros(n)
    np.maximum.at(longest, row, sizes)
    spread = np.bincount(row, (sizes - (np.bincount(row, sizes, n) / words)[row]) ** 2, n) / words
    hashes = SpanHash(lowered(buf)).of(lines.starts, lines.ends)
    # one hash for row and word: a sort of single numbers, where equal ones count once
    _, at = np.unique(mix(hashes + np.uint64(0x9E3779B97F4A7C15) * row.astype(np.uint64)), return_index=True)
    distinct = row[at]
    first = buf[lines.starts] if len(row) else np.zeros(0, np.uint8)
    upper = ((first >= 65) & (first <= 90)).astype(np.float64)
    columns = [np.log1p(n_bytes), np.log1p(base["n_words"]), base["word_chars"] / words, longest, np.sqrt(spread), base["n_symbols"] / words, count / words, base["n_dup_lines"] / some, base["n_repeat_words"] / words, np.bincount(distinct, minlength=n) / words, np.bincount(row, upper, n) / words, sums_by(code_points(buf), offsets) / np.maximum(n_bytes, 1)]
    columns += [sums_by(t[buf], offsets) / np.maximum(n_bytes, 1) for t in _TABLES]
    return np.stack(columns, 1).astype(np.float32)


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, x (array of float) of each row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, buf, offsets in pieces_of(*flat_bytes(batch.column(1)), 1 << 20):
                x = statistics(buf, offsets)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), lists], ["doc_id", "x"])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, x array<float>")


def chosen(rows: DataFrame, labels: DataFrame, label: str = "quality", train_rows: int = TRAIN_ROWS) -> list[tuple[list[float], int]]:
    """(statistics, label) of the train_rows labelled rows with the smallest hash, in that order; all of them if there are fewer."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).filter(F.col("label").isNotNull() & (remainder("doc_id", MODULUS) != HELD_OUT))
    known = rows.join(marked.distinct(), "doc_id").withColumn("h", F.xxhash64("doc_id", "label", "x")).dropDuplicates(["h", "doc_id", "label", "x"])
    known = stored(known.select("h", "doc_id", "label", "x"), "labelled")
    n = known.count()
    share = (train_rows + 6 * train_rows**0.5 + 50) / max(n, 1)
    if share < 1:
        known = known.filter(F.col("h") < -(1 << 63) + int(share * (1 << 64)))
    some = sorted(known.collect(), key=lambda r: (r.h, r.doc_id, r.label, r.x))  # about train_rows rows: the hashes are uniform
    return [(r.x, r.label) for r in some[:train_rows]]


def fitted(rows: DataFrame, labels: DataFrame, label: str = "quality", train_rows: int = TRAIN_ROWS, **how) -> Trees:
    """Trees for the stored statistics and labels; at most train_rows rows are learned from."""
    some = chosen(rows, labels, label, train_rows)
    x = np.array([x for x, _ in some], np.float32) if some else np.zeros((0, len(_KINDS) + 13), np.float32)
    return fit(x, np.array([y for _, y in some], np.float64), **how)


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of each row."""
    rows = stored(document_statistics(docs), "statistics")
    sent = docs.sparkSession.sparkContext.broadcast(fitted(rows, labels, label, train_rows))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1) if len(batch) else np.zeros((0, 1), np.float32)
            score = sent.value.probability(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return rows.select("doc_id", (remainder("doc_id", MODULUS) == HELD_OUT).alias("held_out"), "x").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
