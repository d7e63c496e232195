"""SimHash near-duplicates: 64-bit fingerprints of word shingles, compared exactly tile by tile, and their components.

Fingerprints are reduced to distinct ones first (a group of copies is one). A tile holds the fingerprints whose
parts have the same population counts, at most TILE of them; two tiles are compared, by numpy exclusive-or and bit
counts, only if the differences of their population counts add up to no more than the radius, as more would mean
more differing bits. With more fingerprints the counts are taken over more parts, so tiles stay filled and more
pairs are skipped; no pair within the radius ever is. From each tile pair comes a spanning forest of its links, not
the links themselves, so dense groups stay small; components are then found without gathering anything.

The comparison still grows with the square of the distinct fingerprints, times the share of pairs not skipped
(about 0.37, 0.1 and 0.01 for 2, 4 and 8 parts).

Cases: a null or empty text has the fingerprint zero, as have all texts without words, which link like any other;
texts shorter than a shingle are one shingle; rows that repeat an id are handled each, by their texts; a null id is
never the component's id unless all are null; `deduplicated` keeps exactly one row of each component, that with the
least id (a null id last), then text hash, whatever ids other components have; other columns are ignored by
`near_duplicates` and kept by `deduplicated`; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeweave.llm.common import join_spread, read_table, small_batches, stored
from lodeweave.llm.components import components

WORDS, RADIUS, SEED = 4, 4, 42
TILE = 4096
_TEXT_KEY = ["__lw_text1", "__lw_text2"]
#: Distinct fingerprints from which population counts are taken over 4 and over 8 parts.
MORE_PARTS = ((2_000_000, 4), (500_000_000, 8))


def fingerprint(text: str | None, size: int = WORDS) -> int:
    """The bits that over half the shingles' hashes have."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()  # of bytes: A-Z, and the white space of the contract
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < size:
        return xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    n, total = len(words) - size + 1, np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):
        to = min(n, at + (1 << 15))
        parts = map(joined.__getitem__, map(slice, starts[at:to].tolist(), ends[at + size - 1 : to + size - 1].tolist()))
        h = np.fromiter(map(xxh64_intdigest, parts, repeat(SEED)), np.uint64, to - at)
        total += np.unpackbits(h.byteswap().view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = WORDS, keyed: bool = False) -> DataFrame:
    """doc_id, fp (64 bits as a signed number) of each row; keyed: and the text's hashes."""
    more = _TEXT_KEY if keyed else []

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(x, size) for x in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64)), *batch.columns[2:]], ["doc_id", "fp", *more])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *(_text_key() if keyed else [])).mapInArrow(run, ", ".join(f"{c} long" for c in ["doc_id", "fp", *more]))


def _text_key() -> list:
    """Two hashes of the text, 128 bits together."""
    text = F.col("text").cast("string")
    return [F.xxhash64(text).alias(_TEXT_KEY[0]), F.xxhash64(F.lit(1), text).alias(_TEXT_KEY[1])]


def _counts(parts: int) -> list:
    """The population counts of fp's parts."""
    width = 64 // parts
    return [F.bit_count(F.shiftrightunsigned("fp", width * i).bitwiseAND(F.lit((1 << width) - 1))) if width < 64 else F.bit_count("fp") for i in range(parts)]


def _steps(parts: int, radius: int) -> list[tuple[int, ...]]:
    """Differences of population counts that add up to the radius at most, one of each pair of opposites."""
    some = [()]
    for _ in range(parts):
        some = [(*x, d) for x in some for d in range(-radius, radius + 1) if sum(map(abs, x)) + abs(d) <= radius]
    return [x for x in some if x >= (0,) * parts]


def linked_in(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> list[tuple[int, int]]:
    """A spanning forest of the links between a and b (places in a, and in b behind len(a)); same: a and b are one tile."""
    parent = list(range(len(a) + (0 if same else len(b))))
    shift, forest = 0 if same else len(a), []

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for at in range(0, len(a), 64):
        left, right = np.nonzero(np.bitwise_count(a[at : at + 64, None] ^ b[None, :]) <= radius)
        left, right = left + at, right + shift
        if same:
            left, right = left[left < right], right[left < right]
        if len(left):
            root = np.array(parent)
            while (root[root] != root).any():
                root = root[root]
            new = root[left] != root[right]
            for x, y in zip(left[new].tolist(), right[new].tolist(), strict=True):
                if (rx := find(x)) != (ry := find(y)):
                    parent[max(rx, ry)] = min(rx, ry)
                    forest.append((x, y))
    return forest


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE, parts: int | None = None) -> DataFrame:
    """(a, b): spanning forests of the links within the radius between distinct fingerprints (fp)."""
    n = distinct.count()
    if parts is None:
        parts = max([2, *(p for least, p in MORE_PARTS if n >= least)])
    counted = distinct.select("fp", F.array(*_counts(parts)).alias("tile"))
    shares = stored(counted.groupBy("tile").agg(F.count("*").alias("n")).withColumn("shares", F.ceil(F.col("n") / tile).cast("int")), "shares")
    # crowded tiles learn their shares where their rows are, so these are gathered to lists before they move
    tiles = join_spread(counted, shares, "tile", "n", n).groupBy("tile", F.pmod(F.xxhash64("fp"), F.col("shares")).alias("share")).agg(F.collect_list("fp").alias("fps"))
    tiles = stored(tiles, "tiles")
    steps = F.array(*[F.array(*map(F.lit, x)) for x in _steps(parts, radius)])
    # the pairs to be compared, without their contents, dealt out evenly before the contents are joined
    names = tiles.select("tile", "share")
    wanted = names.withColumn("step", F.explode(steps)).select("tile", "share", F.zip_with("tile", "step", lambda x, d: x + d).alias("other"))
    pairs = wanted.join(names.select(F.col("tile").alias("other"), F.col("share").alias("other_share")), "other")
    pairs = pairs.filter((F.col("tile") != F.col("other")) | (F.col("share") <= F.col("other_share")))
    full = pairs.join(tiles.withColumnRenamed("fps", "a"), ["tile", "share"])
    full = full.join(tiles.select(F.col("tile").alias("other"), F.col("share").alias("other_share"), F.col("fps").alias("b")), ["other", "other_share"])
    full = full.select(((F.col("tile") == F.col("other")) & (F.col("share") == F.col("other_share"))).alias("same"), "a", "b").repartition(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                a, b = (batch.column(k)[i].values.to_numpy(zero_copy_only=False) for k in (1, 2))
                if found := linked_in(a.view(np.uint64), b.view(np.uint64), radius, batch.column(0)[i].as_py()):
                    every = a if batch.column(0)[i].as_py() else np.concatenate([a, b])
                    at = np.array(found)
                    yield pa.RecordBatch.from_arrays([pa.array(every[at[:, 0]]), pa.array(every[at[:, 1]])], ["a", "b"])

    return full.mapInArrow(run, "a long, b long")


def _rooted(distinct: DataFrame, radius: int) -> DataFrame:
    """distinct fingerprints (fp, and others) with their root."""
    roots = components(links(distinct.select("fp"), radius))
    return distinct.join(roots, F.col("fp") == F.col("node"), "left").select(*distinct.columns, F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, size: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id that can be reached) of each row."""
    each = stored(fingerprints(docs, size), "fingerprints")
    distinct = stored(each.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "distinct")
    rooted = stored(_rooted(distinct, radius), "rooted")
    ids = stored(rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("members")), "roots")
    # one component may have a third of all fingerprints, and one fingerprint a third of all rows
    named = stored(join_spread(rooted, ids, "root", "members", rooted.count()).select("fp", "n", "component_id"), "named")
    return join_spread(each, named, "fp", "n", each.count()).select("doc_id", "fp", "component_id")


def deduplicated(docs: DataFrame, size: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """Exactly one row of each component, that with the smallest id (null last), then text hash; columns as they were."""
    keys = fingerprints(docs, size, True).groupBy("fp", "doc_id", *_TEXT_KEY).agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *_TEXT_KEY, "n")).alias("first")
    distinct = stored(keys.groupBy("fp").agg(first), "distinct")
    keep = stored(_rooted(distinct, radius).groupBy("root").agg(F.min("first").alias("first")).select("first.*"), "keep")
    # one plan for all sizes: both sides are dealt by key, and only keys are hashed, so texts are neither sorted nor held
    kept = keep.select(F.col("doc_id").alias("__lw_keep"), *(F.col(c).alias(f"{c}k") for c in _TEXT_KEY)).hint("shuffle_hash")
    left = docs.select("*", F.col("doc_id").cast("long").alias("__lw_id"), *_text_key())
    same = F.col("__lw_id").eqNullSafe(F.col("__lw_keep"))
    for c in _TEXT_KEY:
        same &= F.col(c) == F.col(f"{c}k")
    left = left.join(kept, same, "left_semi")
    if keep.filter("n > 1").limit(1).count():  # rows that repeat both id and text
        left = left.dropDuplicates(["__lw_id", *_TEXT_KEY])
    return left.select(docs.columns)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
