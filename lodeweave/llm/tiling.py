"""Benchmark decontamination by greedy string tiling (Wise, 1993) over running Karp-Rabin hashes.

Words are runs of letters, digits and non-ASCII bytes, A-Z in lower case. A rolling hash of SEED words runs over
every document and is joined with the benchmark's; hits on one diagonal that follow each other make a match. For each
document and item the longest match whose words are all free is marked as a tile, again and again; what a mark
leaves of a longer match, if it still has SEED words, waits its turn. The tiles' share of the item's words is the
coverage, which reordered passages do not lower. A document is contaminated if an item is covered to COVERAGE.

The benchmark goes to all tasks as an index, in blocks of SENT bytes of text at most; a larger benchmark takes more passes over
the documents, never a larger index. Pairs whose seeds could not cover enough even if all were tiles are left out
before tiling; that loses none.

Cases: a null text has no words and is clean; an item shorter than SEED words must occur as a whole; an item without
words never matches; items that repeat are judged each, and the smallest id wins a tie; rows that repeat are judged
each; texts are never cut; empty tables give an empty or a clean result; other columns are kept by `decontaminated`
and ignored by `leaks`.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeweave.llm.common import SpanHash, flat_bytes, lowered, pieces_of, read_table, small_batches, stored

SEED, COVERAGE = 5, 0.8
SENT = 16 << 20
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_FOUND = {"__lw_item": "long", "__lw_coverage": "double", "__lw_items": "long"}


def word_hashes(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, and each row's first word (n + 1)."""
    inside = np.zeros(len(buf) + 2, bool)
    inside[1:-1] = _WORD[buf]
    cut = np.zeros(len(buf) + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    return SpanHash(lowered(buf)).of(starts, ends), np.searchsorted(starts, offsets)


class Index:
    """Seeds of a block of items, by size."""

    def __init__(self, items: list[tuple[int | None, str | None]], seed: int):
        self.ids = [i for i, _ in items]
        self.words = []
        for _, text in items:
            raw = np.frombuffer((text or "").encode(), np.uint8)
            self.words.append(word_hashes(raw, np.array([0, len(raw)]))[0])
        self.lens = np.array([len(x) for x in self.words], np.int64)
        self.sizes = {}
        for size in sorted({min(seed, int(n)) for n in self.lens if n}):
            mine = [i for i, n in enumerate(self.lens) if min(seed, n) == size]
            hashes = [SpanHash(self.words[i]).every(size) for i in mine]
            value = np.concatenate(hashes)
            item = np.repeat(mine, [len(x) for x in hashes])
            place = np.concatenate([np.arange(len(x)) for x in hashes])
            order = np.argsort(value, kind="stable")
            value, item, place = value[order], item[order], place[order]
            bits = max(16, int(len(value) * 16).bit_length())
            seen = np.zeros(1 << bits, bool)
            seen[(value >> np.uint64(64 - bits)).astype(np.int64)] = True
            self.sizes[size] = value, item, place, seen, np.uint64(64 - bits)

    def hits(self, size: int, words: np.ndarray, first: np.ndarray, coverage: float) -> tuple[np.ndarray, ...]:
        """(row, item, place in the item, place among the words) of the seeds of pairs that could be covered enough.

        A seed that a row repeats is looked up once: pairs are judged by the places in the item that its seeds would cover, and
        only those that are left are spread over all places in the row. So a stock phrase of many items and many places in
        a text makes no product of them.
        """
        value, item, place, seen, shift = self.sizes[size]
        h = SpanHash(words).every(size)
        at = np.flatnonzero(seen[(h >> shift).astype(np.int64)])
        row = np.searchsorted(first, at, "right") - 1
        inside = at + size <= first[row + 1]
        at, row = at[inside], row[inside]
        low = np.searchsorted(value, h[at])
        real = (low < len(value)) & (value[np.minimum(low, len(value) - 1)] == h[at])
        at, row, low = at[real], row[real], low[real]
        order = np.lexsort((at, low, row))
        at, row, low = at[order], row[order], low[order]
        heads = np.flatnonzero(np.append(True, (np.diff(row) != 0) | (np.diff(low) != 0))) if len(at) else at
        times = np.diff(np.append(heads, len(at)))
        n = np.searchsorted(value, value[low[heads]], "right") - low[heads]
        seed, which = _spread(n, low[heads])
        pair = row[heads][seed] * len(self.ids) + item[which]
        order = np.lexsort((place[which], pair))
        seed, which, pair = seed[order], which[order], pair[order]
        if not len(pair):
            return at, at, at, at
        ends = np.flatnonzero(np.append(pair[1:] != pair[:-1], True))
        step = np.full(len(pair), size)  # words that the seeds cover: up to the next seed of the pair, `size` at most
        step[:-1] = np.minimum(size, np.diff(place[which]))
        step[ends] = size
        starts = np.append(0, ends[:-1] + 1)
        enough = np.add.reduceat(step, starts) >= coverage * self.lens[item[which[starts]]]
        left = np.repeat(enough, ends - starts + 1)
        seed, which = seed[left], which[left]
        back, where = _spread(times[seed], heads[seed])
        return row[where], item[which[back]], place[which[back]], at[where]


def _spread(n: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i, n[i] times: i, and the numbers from start[i] on."""
    source = np.repeat(np.arange(len(n)), n)
    return source, np.arange(len(source)) + np.repeat(start - np.append(0, np.cumsum(n)[:-1]), n) if len(n) else source


def tiles(item_at: np.ndarray, doc_at: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """(place in the item, place in the document, words) of the tiles, from the places of seed hits."""
    order = np.lexsort((item_at, doc_at - item_at))
    a, b = item_at[order], doc_at[order]
    heads = np.flatnonzero(np.append(True, (np.diff(b - a) != 0) | (np.diff(a) != 1)))
    runs = np.diff(np.append(heads, len(a))) + size - 1
    waiting = [(-n, i, d) for n, i, d in zip(runs.tolist(), a[heads].tolist(), b[heads].tolist(), strict=True)]
    heapify(waiting)
    item_marked, doc_marked, out = set(), set(), []
    while waiting:
        n, i, d = heappop(waiting)
        free = [i + k not in item_marked and d + k not in doc_marked for k in range(-n)]
        if all(free):
            out.append((i, d, -n))
            item_marked.update(range(i, i - n))
            doc_marked.update(range(d, d - n))
            continue
        start = None
        for k, ok in enumerate([*free, False]):
            if ok and start is None:
                start = k
            elif not ok and start is not None:
                if k - start >= size:
                    heappush(waiting, (start - k, i + start, d + start))
                start = None
    return out


def _matches(index: Index, buf: np.ndarray, offsets: np.ndarray, coverage: float) -> dict[int, list[tuple[int, float]]]:
    """By row, the items that are covered enough."""
    words, first = word_hashes(buf, offsets)
    out: dict[int, list[tuple[int, float]]] = {}
    for size in index.sizes:
        row, item, item_at, doc_at = index.hits(size, words, first, coverage)
        if not len(row):
            continue
        order = np.lexsort((doc_at, item_at, item, row))
        row, item, item_at, doc_at = (x[order] for x in (row, item, item_at, doc_at))
        heads = np.flatnonzero(np.append(True, (np.diff(row) != 0) | (np.diff(item) != 0)))
        for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(row)], strict=True):
            length = int(index.lens[item[a]])
            share = sum(x[2] for x in tiles(item_at[a:b], doc_at[a:b], size)) / length
            if share >= coverage:
                out.setdefault(int(row[a]), []).append((index.ids[item[a]], share))
    return out


def _scanned(docs: DataFrame, items: list, seed: int, coverage: float) -> DataFrame:
    """docs, which has the columns of _FOUND, with these brought up to date by a block of items."""
    sent = docs.sparkSession.sparkContext.broadcast(items)
    at = docs.columns.index("text")
    ready: list[Index] = []

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready[:] = ready or [Index(sent.value, seed)]
        for batch in batches:
            item, best, count = (batch.column(k).to_pylist() for k in _FOUND)
            for start, _, buf, offsets in pieces_of(*flat_bytes(batch.column(at))):
                for row, found in _matches(ready[0], buf, offsets, coverage).items():
                    i = start + row
                    for name, share in found:
                        if share > best[i] or share == best[i] and name is not None and (item[i] is None or name < item[i]):
                            item[i], best[i] = name, share
                    count[i] += len(found)
            columns = dict(zip(batch.schema.names, batch.columns, strict=True)) | {k: pa.array(v, batch.schema.field(k).type) for k, v in zip(_FOUND, (item, best, count), strict=True)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def _with_leaks(docs: DataFrame, bench: DataFrame, seed: int, coverage: float, sent: int) -> DataFrame:
    """docs with the columns of _FOUND."""
    items = bench.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-int(total) // sent))
    docs = docs.withColumns({"__lw_item": F.lit(None).cast("long"), "__lw_coverage": F.lit(0.0), "__lw_items": F.lit(0).cast("long")})
    for block in range(blocks):
        if block:
            docs = stored(docs, "tiling")
        docs = _scanned(docs, [tuple(x) for x in items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()], seed, coverage)
    return docs


def leaks(docs: DataFrame, bench: DataFrame, seed: int = SEED, coverage: float = COVERAGE, sent: int = SENT) -> DataFrame:
    """doc_id, contaminated, item_id and coverage (of the item covered most), n_items (covered enough) of each row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = _with_leaks(docs, bench, seed, coverage, sent)
    return found.select("doc_id", (F.col("__lw_items") > 0).alias("contaminated"), F.col("__lw_item").alias("item_id"), F.col("__lw_coverage").alias("coverage"), F.col("__lw_items").alias("n_items"))


def decontaminated(docs: DataFrame, bench: DataFrame, seed: int = SEED, coverage: float = COVERAGE, sent: int = SENT) -> DataFrame:
    """The documents that cover no item enough; columns as they were."""
    return _with_leaks(docs, bench, seed, coverage, sent).filter(F.col("__lw_items") == 0).select(docs.columns)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
