"""Shared parts of the training-data operators: scratch folders, batches of text as flat bytes, hashes of spans.

Texts reach Python as Arrow batches and are handled as one flat byte array with offsets, so that the work per
byte is done by numpy. `pieces_of` cuts a batch into pieces of a few MB, so temporaries stay small however
many rows a batch has; one document is never cut.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeweave.sources.storage import dealt

#: The white space that separates words in the query contracts: space and U+0009 to U+000D.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: An odd multiplier and its inverse modulo 2^64, for hashes of spans by differences of prefix sums.
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; a small one in few files is dealt out to all cores, as its row groups would fill few tasks."""
    return dealt(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where that is unset."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all nodes share")
        at = "file:///tmp/checkpoints/lodeweave"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; it is removed when the driver ends."""
    path = f"{shared_dir(spark)}/lodeweave-{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def released(spark: SparkSession, df: DataFrame) -> None:
    """The files behind a stored table that nothing reads any more are removed now, not at the driver's end."""
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if "/lodeweave-" in path:
            _remove(spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # noqa: BLE001  the session has ended before: the cluster's own clean-up takes over
        pass


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """df as written to the shared folder: its lineage ends there, and no lost executor takes it along."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts_for(spark: SparkSession, total_bytes: int, each: int) -> int:
    """Enough partitions for `each` bytes in each, and no fewer than the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(total_bytes) // each))


#: Keys that have over 1/MOST_KEYS of all rows are joined by broadcast; there cannot be more of them than that.
MOST_KEYS = 4096


def join_spread(left: DataFrame, right: DataFrame, key: str, n: str, total: int) -> DataFrame:
    """left with right's other columns by `key`, which is unique in right and never null; n: how many of left's `total` rows have it.

    A key that holds a third of all rows would fill one task of a join. Keys with over total / MOST_KEYS rows go to all
    tasks instead, so their rows stay where they are, whatever the size; the others are dealt by key. Both sides are read twice.
    """
    crowded = F.col(n) * MOST_KEYS > total
    few = F.broadcast(right.filter(crowded).drop(n))  # MOST_KEYS rows at most
    rest = left.join(F.broadcast(right.filter(crowded).select(key)), key, "left_anti")
    return left.join(few, key).unionByName(rest.join(right.filter(~crowded).drop(n), key))


def as_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of 8 MB at most, whatever their rows weigh."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """_BASE (or its inverse) to the power 0 .. n-1, modulo 2^64."""
    have = _powers.get(inverse)
    if have is None or len(have) < n:
        size = max(n, 1 << 20)
        steps = np.full(size, _BASE_INVERSE if inverse else _BASE, np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if size <= 1 << 23:
            _powers[inverse] = have
    return have[:n]


class SpanHash:
    """Hashes of any spans of a sequence, each in constant time."""

    def __init__(self, values: np.ndarray):
        self.sums = np.zeros(len(values) + 1, np.uint64)
        # a value of 0 must count, or spans of different lengths would agree
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(len(values)), out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.sums[ends] - self.sums[starts]) * powers(len(self.sums), True)[starts]
        return mix(h + (ends - starts).astype(np.uint64))

    def every(self, k: int) -> np.ndarray:
        """Of each span of k values."""
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[k:] - self.sums[:n]) * powers(n, True))


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column's bytes and offsets (n + 1); null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces_of(buf: np.ndarray, offsets: np.ndarray, most: int = 2 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) for runs of rows of about `most` bytes together."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, to, buf[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def sums_by(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values between neighbouring offsets."""
    c = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=c[1:])
    return c[offsets[1:]] - c[offsets[:-1]]


def words_in(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of bytes that are no white space, within a row), and each row's first word (n + 1)."""
    inside = np.zeros(len(buf) + 2, bool)
    inside[1:-1] = ~_IS_SPACE[buf]
    cut = np.zeros(len(buf) + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    return starts, ends, np.searchsorted(starts, offsets)


def lowered(buf: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return _LOWER[buf]


def code_points(buf: np.ndarray) -> np.ndarray:
    """True at the first byte of each code point."""
    return (buf & 0xC0) != 0x80


def windows_in(first: np.ndarray, n: int, size: int) -> np.ndarray:
    """True for each position at which `size` neighbours from there stay within one row; first: rows' first positions (r + 1)."""
    ok = np.zeros(max(n - size + 1, 0), bool)
    if len(ok):
        step = np.zeros(n + 1, np.int64)
        lasts = first[1:] - size + 1
        has = lasts > first[:-1]
        np.add.at(step, first[:-1][has], 1)
        np.add.at(step, lasts[has], -1)
        ok[:] = np.cumsum(step[: len(ok)]) > 0
    return ok


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """True for each of n positions within `size` of a start."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + size, n), -1)
    return np.cumsum(step[:n]) > 0


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))
