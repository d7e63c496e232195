"""Removal of repeated passages: bytes covered by a string of LENGTH bytes that also starts earlier.

Exact whole copies are settled first, by hash: a copy of an earlier document is covered altogether (if it is as long
as LENGTH) and takes no further part. The other texts are packed into blocks of about BLOCK bytes, stored as a
bucketed table, so later passes read them in place and only small things move.

1. Anchors. The anchor of a window of LENGTH bytes is its smallest hash of SEED bytes (leftmost if equal). Equal
   windows have equal anchors at equal places, so only windows with a repeated anchor can be repeats. Each block sends
   its anchors' hashes (5 bytes each) once; back come those that other blocks have too.
2. Excerpts. Neighbouring windows with one anchor make one excerpt. Of equal excerpts a block keeps the first; the
   rest are repeats. What stands under a repeated anchor goes to the anchor's bucket.
3. Suffix sorting. A bucket joins its excerpts to one text, some anchors at a time, sorts its suffixes in two stages,
   and computes adjacent common prefixes; suffixes that share LENGTH bytes are one string, and all but its earliest
   place are repeats.
4. Each block unites its repeats, and cuts.

An anchor in more than HOT blocks (a passage that very many documents share) could gather much in one bucket: its
windows are sent one by one as 128-bit hashes, equal ones once for each block, and dealt out by that hash.

Order is by doc_id, then place; rows that share an id but not the text are ordered by a hash of the text, null ids
come last. Cases: a null text is empty; rows with equal id and text are one document, given for each row; texts below
LENGTH lose nothing; texts are never cut apart; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeweave.llm.common import SpanHash, as_text, mix, parts_for, pieces_of, read_table, released, scratch_path, small_batches, stored, windows_in
from lodeweave.llm.suffixes import common_prefixes, runs_of, suffix_array, words_at

LENGTH, SEED = 100, 50
BLOCK, BUCKET = 4 << 20, 16 << 20
HOT = 64
#: Bytes of excerpts whose suffixes are sorted at once.
AT_ONCE = 1 << 20
_SPREAD = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BITS = np.uint64((1 << 40) - 1)
_SENT = "bucket long, block long, kind int, text binary, keys array<long>, more array<long>, lens array<int>, docs array<long>, places array<int>"
_MARKS = "block long, places array<int>, lens array<int>"
#: The place of a null id in the order.
_LAST = (1 << 63) - 1
_EXCERPTS, _FOUND, _WINDOWS = 0, 1, 2


def _lists(arrays: list[np.ndarray], kind) -> pa.Array:
    values = np.concatenate(arrays) if arrays else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum([len(x) for x in arrays])).astype(np.int32)), pa.array(values.astype(kind)))


def _joined(column: pa.ChunkedArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """A list column's values, and the row of each."""
    column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks else pa.array([], column.type)
    n = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind), np.repeat(np.arange(len(n)), n)


def _packed(docs: pa.Table, firsts: pa.Table) -> pa.Table:
    """A block: the texts of the documents that are first, in order, with their ids, copies in rows, and lengths."""
    want = {(x["place"], x["hash"]): x["n"] for x in firsts.to_pylist()}
    found = {(x["place"], x["hash"]): x["text"] for x in docs.to_pylist() if (x["place"], x["hash"]) in want}
    order = sorted(found)
    text = "".join(found[k] for k in order).encode()
    names = ["block", "ids", "hashes", "rows", "lens", "size", "text"]
    if not order:
        return pa.table({k: [] for k in names}).cast(_block_schema())
    return pa.table([[docs["block"][0].as_py()], [[k[0] for k in order]], [[k[1] for k in order]], [[want[k] for k in order]], [[len(found[k].encode()) for k in order]], [len(text)], [pa.compress(text, "zstd", asbytes=True)]], names=names).cast(_block_schema())


def _block_schema() -> pa.Schema:
    return pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("hashes", pa.list_(pa.string())), ("rows", pa.list_(pa.int64())), ("lens", pa.list_(pa.int64())), ("size", pa.int64()), ("text", pa.binary())])


_BLOCKS = "block long, ids array<long>, hashes array<string>, rows array<long>, lens array<long>, size long, text binary"


def _unpacked(columns, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's bytes, offsets and ids."""
    size = columns["size"][i].as_py()
    text = np.frombuffer(pa.decompress(columns["text"][i].as_buffer(), size, "zstd"), np.uint8) if size else np.zeros(0, np.uint8)
    lens = columns["lens"][i].values.to_numpy(zero_copy_only=False)
    return text, np.append(0, np.cumsum(lens)), columns["ids"][i].values.to_numpy(zero_copy_only=False)


def anchors(buf: np.ndarray, offsets: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window, last window) for each run of windows with one anchor."""
    value = SpanHash(buf).every(seed)
    wide = length - seed + 1
    ok = windows_in(offsets, len(buf), length)
    if not ok.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    least, at, have = value, np.arange(len(value), dtype=np.int32), 1
    while have < wide:
        step = min(have, wide - have)
        n = len(least) - step
        right = least[step:] < least[:n]
        least, at = np.where(right, least[step:], least[:n]), np.where(right, at[step:], at[:n])
        have += step
    starts = np.flatnonzero(ok)
    at, least = at[starts], least[starts]
    heads = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    return least[heads], starts[heads], starts[np.append(heads[1:], len(starts)) - 1]


def _anchors_of(text: np.ndarray, offsets: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found = []
    for row, _, buf, own in pieces_of(text, offsets, 1 << 20):
        value, first, last = anchors(buf, own, length, seed)
        found.append((value, first + offsets[row], last + offsets[row]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))


def _short(value: np.ndarray, buckets: int) -> np.ndarray:
    """A hash as (40 of its bits, bucket) in one number."""
    n = np.uint64(buckets)
    return ((value // n) & _BITS) * n + value % n


def _five(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _from_five(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return out.reshape(-1).view("<u8")


def _by_bucket(values: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places of its values), in order of place."""
    bucket = (values % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    for a, b in runs_of(bucket[order]):
        yield int(bucket[order[a]]), order[a:b]


def _seen(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """128 bits for each span, as two columns."""
    return np.stack([SpanHash(text).of(starts, ends), SpanHash(_SPREAD[text]).of(starts, ends)])


def _earlier(keys: np.ndarray, order: tuple[np.ndarray, ...] = ()) -> np.ndarray:
    """True for columns of keys that occur earlier, by `order` (most important last) or else by place."""
    by = np.lexsort((*order, *keys))
    same = (keys[:, by][:, 1:] == keys[:, by][:, :-1]).all(axis=0)
    out = np.zeros(keys.shape[1], bool)
    out[by[1:][same]] = True
    return out


def _ask(batches: Iterable[pa.RecordBatch], buckets: int, length: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(len(batch)):
            text, offsets, _ = _unpacked(batch, i)
            value = np.unique(_short(_anchors_of(text, offsets, length, seed)[0], buckets))
            rows = [(b, _five(value[at] // np.uint64(buckets))) for b, at in _by_bucket(value, buckets)]
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int64()), pa.array([batch["block"][i].as_py()] * len(rows), pa.int64()), pa.array([x for _, x in rows], pa.binary())], ["bucket", "block", "hashes"])


def _answer(group: pa.Table, hot: int) -> pa.Table:
    """For each block, which of its hashes others have too, and which very many have. Two sorts, whatever the number of blocks."""
    lists = group["hashes"].to_pylist()
    value, row = _from_five(b"".join(lists)), np.repeat(np.arange(len(lists)), [len(x) // 5 for x in lists])
    order = np.argsort(value, kind="stable")
    heads = np.flatnonzero(np.append(True, value[order][1:] != value[order][:-1])) if len(value) else order
    count = np.zeros(len(value), np.int64)
    size = np.diff(np.append(heads, len(value)))
    count[order] = np.repeat(size, size)

    def cut(some: np.ndarray) -> pa.Array:  # rows are in order, so each block's values are a run
        ends = np.searchsorted(row[some], np.arange(len(lists) + 1)) * 5
        raw = _five(value[some])
        return pa.array([raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.binary())

    return pa.table([group["block"], group["bucket"], cut((count > 1) & (count <= hot)), cut(count > hot)], names=["block", "bucket", "shared", "hot"])


def _send(block: pa.Table, answers: pa.Table, buckets: int, length: int, seed: int) -> pa.Table:
    """Excerpts, windows of hot anchors, and repeats within the block."""
    rows: dict[str, list] = {k: [] for k in ("bucket", "kind", "text", "keys", "more", "lens", "docs", "places")}
    none = np.zeros(0, np.int64)

    def add(bucket: int, kind: int, text: bytes = b"", keys=none, more=none, lens=none, docs=none, places=none) -> None:
        for k, v in zip(rows, (bucket, kind, text, keys.view(np.int64), more.view(np.int64), lens, docs, places), strict=True):
            rows[k].append(v)

    if len(block):
        text, offsets, ids = _unpacked(block, 0)
        value, first, last = _anchors_of(text, offsets, length, seed)
        key = _short(value, buckets)
        n = np.uint64(buckets)
        known = {c: np.concatenate([np.zeros(0, np.uint64), *(_from_five(x) * n + np.uint64(b) for x, b in zip(answers[c].to_pylist(), answers["bucket"].to_pylist(), strict=True))]) for c in ("shared", "hot")}
        hot = np.isin(key, known["hot"])
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        some = ~hot & ((count[inverse] > 1) | np.isin(key, known["shared"]))
        first_hot, last_hot = first[hot], last[hot]
        key, first, last = key[some], first[some], last[some]
        again = _earlier(_seen(text, first, last + length)) if len(first) else np.zeros(0, bool)
        marks = [first[again]], [(last - first + 1)[again]]
        key, first, last = key[~again], first[~again], last[~again]
        doc = ids[np.searchsorted(offsets, first, "right") - 1] if len(first) else none
        for bucket, at in _by_bucket(key, buckets):
            lens = (last - first)[at] + length
            places = np.repeat(first[at] - np.append(0, np.cumsum(lens)[:-1]), lens) + np.arange(lens.sum())
            add(bucket, _EXCERPTS, pa.compress(text[places].tobytes(), "zstd", asbytes=True), key[at], none, lens, doc[at], first[at])
        if len(first_hot):
            sizes = last_hot - first_hot + 1
            start = np.repeat(first_hot - np.append(0, np.cumsum(sizes)[:-1]), sizes) + np.arange(sizes.sum())
            both = _seen(text, start, start + length)
            again = _earlier(both)
            marks[0].append(start[again])
            marks[1].append(np.ones(again.sum(), np.int64))
            both, start = both[:, ~again], start[~again]
            doc = ids[np.searchsorted(offsets, start, "right") - 1]
            for bucket, at in _by_bucket(both[0], buckets):
                add(bucket, _WINDOWS, b"", both[0][at], both[1][at], none, doc[at], start[at])
        if sum(map(len, marks[0])):
            add(block["block"][0].as_py() % buckets, _FOUND, lens=np.concatenate(marks[1]), places=np.concatenate(marks[0]))
    size = len(rows["bucket"])
    number = block["block"][0].as_py() if len(block) else 0
    columns = [pa.array(rows["bucket"], pa.int64()), pa.array([number] * size, pa.int64()), pa.array(rows["kind"], pa.int32()), pa.array(rows["text"], pa.binary()), _lists(rows["keys"], np.int64), _lists(rows["more"], np.int64), _lists(rows["lens"], np.int32), _lists(rows["docs"], np.int64), _lists(rows["places"], np.int32)]
    return pa.table(columns, names=["bucket", "block", "kind", "text", "keys", "more", "lens", "docs", "places"])


def repeats_in(text: np.ndarray, starts: np.ndarray, lens: np.ndarray, order: tuple[np.ndarray, ...], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(excerpt, window in it) of the windows that occur at an earlier place, by suffix sorting.

    order: arrays by excerpt, the most important last, that with the window's place in its excerpt tell which is earlier.
    """
    ends = np.cumsum(lens + 1)
    joined = np.full(int(ends[-1]), 0xFF, np.uint8)  # no UTF-8 text has this byte
    own = np.arange(len(joined)) - np.repeat(ends - lens - 1, lens + 1)
    excerpt = np.repeat(np.arange(len(lens)), lens + 1)
    real = own < lens[excerpt]
    joined[real] = text[(starts[excerpt] + own)[real]]
    words = words_at(joined)
    sorted_all = suffix_array(joined, words, length + 4)
    sorted_all = sorted_all[own[sorted_all] <= lens[excerpt[sorted_all]] - length]
    if not len(sorted_all):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    string = np.cumsum(common_prefixes(sorted_all, words, length) < length)
    by = np.lexsort((own[sorted_all], *(x[excerpt[sorted_all]] for x in order), string))
    again = sorted_all[by[1:][string[by][1:] == string[by][:-1]]]
    return excerpt[again], own[again]


def _found(group: pa.Table, length: int) -> pa.Table:
    """The repeats among what has come to a bucket, by block."""
    kinds = group["kind"].to_numpy()
    marks: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if (kinds == _FOUND).any():
        own = group.filter(pa.array(kinds == _FOUND))
        places, row = _joined(own["places"], np.int64)
        marks.append((own["block"].to_numpy()[row], places, _joined(own["lens"], np.int64)[0]))
    if (kinds == _WINDOWS).any():
        own = group.filter(pa.array(kinds == _WINDOWS))
        key, row = _joined(own["keys"], np.int64)
        block, places = own["block"].to_numpy()[row], _joined(own["places"], np.int64)[0]
        again = _earlier(np.stack([key, _joined(own["more"], np.int64)[0]]), (places, block, _joined(own["docs"], np.int64)[0]))
        marks.append((block[again], places[again], np.ones(again.sum(), np.int64)))
    if (kinds == _EXCERPTS).any():
        own = group.filter(pa.array(kinds == _EXCERPTS))
        key, row = _joined(own["keys"], np.int64)
        lens, docs, places = (_joined(own[c], np.int64)[0] for c in ("lens", "docs", "places"))
        sizes = np.bincount(row, lens, len(own)).astype(np.int64)
        text = np.frombuffer(b"".join(bytes(pa.decompress(x, int(n), "zstd", asbytes=True)) for x, n in zip(own["text"].to_pylist(), sizes, strict=True)), np.uint8)
        starts, block = np.append(0, np.cumsum(lens)[:-1]), own["block"].to_numpy()[row]
        by_key = np.lexsort((places, block, docs, key))
        at = 0
        weight = np.cumsum(lens[by_key])
        heads = np.flatnonzero(np.append(True, key[by_key][1:] != key[by_key][:-1]))
        bounds = np.append(heads, len(by_key))
        while at < len(by_key):  # whole anchors, about AT_ONCE bytes of them
            limit = (weight[at - 1] if at else 0) + AT_ONCE
            to = int(bounds[max(np.searchsorted(bounds, at, "right"), np.searchsorted(bounds, np.searchsorted(weight, limit), "right") - 1)])
            some = by_key[at:to]
            at = to
            low, high = starts[some].min(), (starts[some] + lens[some]).max()
            if high - low > 4 * AT_ONCE:  # what is joined lies far apart
                own_text = np.concatenate([text[s : s + n] for s, n in zip(starts[some], lens[some], strict=True)])
                own_starts = np.append(0, np.cumsum(lens[some])[:-1])
            else:
                own_text, own_starts = text[low:high], starts[some] - low
            again = _earlier(np.concatenate([_seen(own_text, own_starts, own_starts + lens[some]), key[some][None].view(np.uint64)]))
            whole = some[again]
            marks.append((block[whole], places[whole], lens[whole] - length + 1))
            some, own_starts = some[~again], own_starts[~again]
            _, inverse, count = np.unique(key[some], return_inverse=True, return_counts=True)
            several = count[inverse] > 1
            some, own_starts = some[several], own_starts[several]
            if len(some):
                which, window = repeats_in(own_text, own_starts, lens[some], (places[some], block[some], docs[some]), length)
                marks.append((block[some[which]], places[some[which]] + window, np.ones(len(which), np.int64)))
    block, places, lens = (np.concatenate(x) for x in zip(*marks, strict=True))
    order = np.argsort(block, kind="stable")
    block, places, lens = block[order], places[order], lens[order]
    spans = runs_of(block)
    return pa.table([pa.array([block[a] for a, _ in spans], pa.int64()), _lists([places[a:b] for a, b in spans], np.int32), _lists([lens[a:b] for a, b in spans], np.int32)], names=["block", "places", "lens"])


_RESULT = "doc_id long, rows long, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept_sha256 string"


def _cut(block: pa.Table, marks: pa.Table, length: int) -> pa.Table:
    """Each document's removed spans."""
    if not len(block):
        return pa.table({"doc_id": [], "rows": [], "n_bytes": [], "n_removed": [], "spans": [], "kept_sha256": []}).cast(pa.schema([("doc_id", pa.int64()), ("rows", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_sha256", pa.string())]))
    text, offsets, ids = _unpacked(block, 0)
    places, _ = _joined(marks["places"], np.int64)
    lens, _ = _joined(marks["lens"], np.int64)
    step = np.zeros(len(text) + 1, np.int64)
    np.add.at(step, places, 1)
    np.add.at(step, places + lens + length - 1, -1)
    gone = np.cumsum(step[:-1]) > 0
    spans, removed, digests, raw = [], [], [], text.tobytes()
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        own = gone[a:b]
        if own.any():
            edges = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]]))).reshape(-1, 2)
            spans.append([{"start": int(x), "end": int(y)} for x, y in edges])
            removed.append(int(own.sum()))
            digests.append(hashlib.sha256(text[a:b][~own].tobytes()).hexdigest())
        else:
            spans.append([])
            removed.append(0)
            digests.append(hashlib.sha256(raw[a:b]).hexdigest())
    top = _LAST
    return pa.table([pa.array([None if x == top else x for x in ids.tolist()], pa.int64()), pa.array(block["rows"][0].as_py(), pa.int64()), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(digests, pa.string())], names=["doc_id", "rows", "n_bytes", "n_removed", "spans", "kept_sha256"])


def repeated_spans(docs: DataFrame, length: int = LENGTH, seed: int = SEED, block: int = BLOCK, bucket: int = BUCKET, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (removed, in bytes) and kept_sha256 of each row."""
    spark = docs.sparkSession
    small_batches(spark)
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))
    text = as_text()
    named = docs.select(place.alias("place"), F.sha2(text.cast("binary"), 256).alias("hash"), text.alias("text"))
    ids = stored(named.select("place", "hash", F.octet_length("text").cast("long").alias("n_bytes")).groupBy("place", "hash").agg(F.count("*").alias("n"), F.first("n_bytes").alias("n_bytes")), "ids")
    firsts = ids.groupBy("hash").agg(F.min("place").alias("place"), F.min_by("n", "place").alias("n"))
    total = ids.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    buckets, n_blocks = parts_for(spark, total, bucket), max(1, -(-total // block))
    # by id and hash, so that copies are spread
    number = F.pmod(F.xxhash64("place", "hash"), F.lit(n_blocks)).alias("block")
    packed = named.select(number, "*").groupBy("block").cogroup(firsts.select(number, "place", "hash", "n").groupBy("block")).applyInArrow(_packed, _BLOCKS)
    name = f"lodeweave_blocks_{uuid.uuid4().hex}"
    path = scratch_path(spark, "blocks")
    packed.write.bucketBy(buckets, "block").option("path", path).option("compression", "uncompressed").saveAsTable(name)
    blocks, blocks_at = spark.table(name), spark.read.schema(_BLOCKS).parquet(path)
    asked = blocks.select("block", "size", "lens", "ids", "text").mapInArrow(lambda x: _ask(x, buckets, length, seed), "bucket long, block long, hashes binary")
    # by count of buckets, not the session's: a task holds a bucket's share however large the corpus is
    answers = asked.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(lambda x: _answer(x, hot), "block long, bucket long, shared binary, hot binary")
    sent = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(lambda x, y: _send(x, y, buckets, length, seed), _SENT)
    marks = sent.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(lambda x: _found(x, length), _MARKS)
    cut = blocks.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(lambda x, y: _cut(x, y, length), _RESULT)
    each = cut.select("doc_id", F.explode(F.sequence(F.lit(1).cast("long"), "rows")).alias("row"), "n_bytes", "n_removed", "spans", "kept_sha256").drop("row")
    copies = ids.join(firsts.select("hash", "place"), ["hash", "place"], "left_anti")
    long_enough = F.col("n_bytes") >= length
    copies = copies.select(
        F.when(F.col("place") < _LAST, F.col("place")).alias("doc_id"), F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("row"), "n_bytes",
        F.when(long_enough, F.col("n_bytes")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.when(long_enough, F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))).otherwise(F.array().cast("array<struct<start: bigint, end: bigint>>")).alias("spans"),
        F.when(long_enough, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.col("hash")).alias("kept_sha256"),
    ).drop("row")
    done = stored(each.unionByName(copies), "repeats")
    spark.sql(f"DROP TABLE {name}")
    for table in (blocks_at, ids):
        released(spark, table)
    return done


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_spans(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
