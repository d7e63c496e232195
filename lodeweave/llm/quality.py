"""Quality rules: repetition in a document, and lines that too many documents of a host share.

Lines are compared by a 64-bit hash of their words in lower case. A first pass over the texts counts, for each
host and line, the documents that carry it; a line above the limits is boilerplate and goes; a document that loses
most of its words that way is depleted and goes as a whole. The counts are summed in each piece of a batch, then
map-side, then by key, so a line of every document costs one row for each task.

Limits of the query and of the pipeline: a host's distinct texts are counted (by hash), so a group of copies counts
once, and a line goes if more than TEXTS_SHARE of them carry it, and more than TEXTS_DOCS. Counted by documents instead
(`distinct=False`), one group of copies may hold a third of a host, so the share is MOST_SHARE there. A host has at most
(its mean number of lines in a text) / TEXTS_SHARE such lines however large it is, so the set is small and is sent to
all tasks; its size is checked, and a set beyond MOST_SENT is joined instead.

Cases: a null text has no words and fails the base rules; a null host is a host of its own; rows that repeat an id
are separate documents; long texts are never cut; an empty table gives an empty result; other columns are ignored
by `quality_rules` and kept by `filtered`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeweave.llm.common import SpanHash, code_points, covered, flat_bytes, lowered, mix, pieces_of, read_table, small_batches, stored, sums_by, windows_in, words_in

HOST = "source"
MOST_SHARE, MOST_DOCS = 0.4, 20
TEXTS_SHARE, TEXTS_DOCS = 0.05, 5
LEAST_WORDS, LEAST_LEFT = 10, 0.2
MOST_REPEATED = 20
MOST_SENT = 500_000
_SYMBOLS = np.zeros(256, np.uint8)
_SYMBOLS[list(b"#*$%&|<>")] = 1
_BASE_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


class Lines:
    """The words and lines of a piece of texts: word starts, lines that hold a word, and their hashes."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        self.buf, self.offsets = buf, offsets
        self.starts, self.ends, self.first_word = words_in(buf, offsets)
        rows = np.flatnonzero(np.diff(offsets))  # rows that have bytes
        breaks = np.flatnonzero(buf == 10)
        self.line_starts = np.union1d(offsets[rows], breaks + 1)
        self.line_starts = self.line_starts[self.line_starts < len(buf)]
        nxt = np.append(self.line_starts[1:], len(buf))
        # a line ends before its break; a row's last line has none
        self.line_ends = np.where((nxt > 0) & (buf[np.maximum(nxt, 1) - 1] == 10), nxt - 1, nxt) if len(nxt) else nxt
        word = np.searchsorted(self.starts, self.line_starts), np.searchsorted(self.starts, self.line_ends)
        has = word[1] > word[0]
        self.line_starts, self.line_ends = self.line_starts[has], np.maximum(self.line_ends[has], self.line_starts[has])
        self.word_from, self.word_to = word[0][has], word[1][has]
        self.row = np.searchsorted(offsets, self.line_starts, "right") - 1

    def keys(self) -> np.ndarray:
        """A hash of each line's words in lower case."""
        words = SpanHash(lowered(self.buf)).of(self.starts, self.ends)
        return SpanHash(words).of(self.word_from, self.word_to).view(np.int64)

    def base(self) -> dict[str, np.ndarray]:
        n_words = np.diff(self.first_word)
        in_word = np.zeros(len(self.buf) + 1, np.int32)
        np.add.at(in_word, self.starts, 1)
        np.subtract.at(in_word, self.ends, 1)
        in_word = np.cumsum(in_word[:-1]) > 0
        bytes_hash = SpanHash(self.buf)
        exact = bytes_hash.of(self.line_starts, self.line_ends)
        again = _seen_before(self.row, exact)
        words = bytes_hash.of(self.starts, self.ends)
        n, first = len(words), self.first_word
        ok = windows_in(first, n, 5)
        at = np.flatnonzero(ok)
        word_row = np.searchsorted(first, at, "right") - 1
        five = SpanHash(words).every(5)[at] if len(at) else np.zeros(0, np.uint64)
        _, inverse, counts = np.unique(mix(five + np.uint64(0x9E3779B97F4A7C15) * word_row.astype(np.uint64)), return_inverse=True, return_counts=True)
        twice = covered(at[counts[inverse] > 1], 5, n) if len(at) else np.zeros(n, bool)
        return {
            "n_words": n_words.astype(np.int64),
            "word_chars": sums_by(code_points(self.buf) & in_word, self.offsets),
            "n_symbols": sums_by(_SYMBOLS[self.buf], self.offsets),
            "n_dup_lines": np.bincount(self.row[again], minlength=len(self.offsets) - 1).astype(np.int64),
            "n_repeat_words": sums_by(twice, first),
        }


def _seen_before(row: np.ndarray, key: np.ndarray) -> np.ndarray:
    """True where the same row has had the same key before."""
    order = np.lexsort((np.arange(len(row)), key, row))
    again = np.zeros(len(row), bool)
    same = (row[order][1:] == row[order][:-1]) & (key[order][1:] == key[order][:-1])
    again[order[1:][same]] = True
    return again


def line_counts(docs: DataFrame, host: str = HOST, distinct: bool = False) -> DataFrame:
    """host, line, n_docs: how many documents of a host carry a line.

    distinct: how many distinct texts do; the row with a null line counts all distinct texts of the host.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = pc.dictionary_encode(batch.column(0), null_encoding="encode")
            code = coded.indices.to_numpy(zero_copy_only=False)
            for at, to, buf, offsets in pieces_of(*flat_bytes(batch.column(1))):
                lines = Lines(buf, offsets)
                if not len(lines.row):
                    continue
                key = lines.keys()
                new = ~_seen_before(lines.row, key)
                pair = np.stack([code[at:to][lines.row[new]].astype(np.int64), key[new]])
                order = np.lexsort(pair)
                pair = pair[:, order]
                heads = np.flatnonzero(np.append(True, (pair[:, 1:] != pair[:, :-1]).any(axis=0)))
                yield pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(pair[0, heads])), pa.array(pair[1, heads]), pa.array(np.diff(np.append(heads, pair.shape[1])))], ["host", "line", "n"])

    def run_distinct(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = pc.dictionary_encode(batch.column(0), null_encoding="encode")
            code = coded.indices.to_numpy(zero_copy_only=False)
            for at, to, buf, offsets in pieces_of(*flat_bytes(batch.column(1))):
                text, mine = SpanHash(buf).of(offsets[:-1], offsets[1:]).view(np.int64), code[at:to]
                first, lines = ~_seen_before(mine, text), Lines(buf, offsets)
                key = lines.keys() if len(lines.row) else np.zeros(0, np.int64)
                new = first[lines.row] & ~_seen_before(lines.row, key)
                rows = np.concatenate([np.flatnonzero(first), lines.row[new]])
                line = pa.concat_arrays([pa.nulls(int(first.sum()), pa.int64()), pa.array(key[new])])
                yield pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(mine[rows])), line, pa.array(text[rows])], ["host", "line", "text"])

    small_batches(docs.sparkSession)
    texts = docs.select(F.col(host).cast("string").alias("host"), F.col("text").cast("string").alias("text"))
    if distinct:  # dealt by line and text first, so a line of every text is no hot key
        return texts.mapInArrow(run_distinct, "host string, line long, text long").distinct().groupBy("host", "line").agg(F.count("*").alias("n_docs"))
    found = texts.mapInArrow(run, "host string, line long, n long")
    return found.groupBy("host", "line").agg(F.sum("n").alias("n_docs"))


def boilerplate(docs: DataFrame, host: str = HOST, share: float = MOST_SHARE, least: int = MOST_DOCS, distinct: bool = False) -> DataFrame:
    """host, line: the lines above the limits; distinct: of the host's distinct texts."""
    if distinct:
        counts = stored(line_counts(docs, host, True).filter(F.col("n_docs") > least), "counts")
        sizes = counts.filter("line IS NULL").select("host", F.col("n_docs").alias("host_docs"))
        counts = counts.filter("line IS NOT NULL")
        return counts.alias("c").join(sizes.alias("s"), F.col("c.host").eqNullSafe(F.col("s.host"))).filter(F.col("n_docs") > share * F.col("host_docs")).select("c.host", "line")
    sizes = docs.groupBy(F.col(host).cast("string").alias("host")).agg(F.count("*").alias("host_docs"))
    counts = line_counts(docs, host).filter(F.col("n_docs") > least)
    return counts.alias("c").join(sizes.alias("s"), F.col("c.host").eqNullSafe(F.col("s.host"))).filter(F.col("n_docs") > share * F.col("host_docs")).select("c.host", "line")


def _sent(lines: DataFrame, most: int) -> dict[str | None, np.ndarray] | None:
    """The set of lines by host, sorted, or None if it is too large to send."""
    if lines.limit(most + 1).count() > most:
        return None
    by: dict[str | None, list[int]] = {}
    for host, line in lines.collect():  # at most `most` rows
        by.setdefault(host, []).append(line)
    return {host: np.sort(np.array(x, np.int64)) for host, x in by.items()}


def _fails(base: dict[str, np.ndarray]) -> np.ndarray:
    return (base["n_words"] < LEAST_WORDS) | (100 * base["n_repeat_words"] > MOST_REPEATED * base["n_words"])


def _depleted(n_words, gone):
    """Of documents that lose words: too few are left."""
    left = n_words - gone
    return (gone > 0) & ((left < LEAST_WORDS) | (left < LEAST_LEFT * n_words))


def _gone(lines: Lines, hosts: list, bad: dict) -> np.ndarray:
    """True for the lines that go."""
    out = np.zeros(len(lines.row), bool)
    if bad and len(out):
        key, codes = lines.keys(), np.array([i if h in bad else -1 for i, h in enumerate(hosts)])
        for i in set(codes[lines.row].tolist()) - {-1}:
            mine = codes[lines.row] == i
            out[mine] = np.isin(key[mine], bad[hosts[i]])
    return out


def judged(docs: DataFrame, bad: dict, make: Callable, schema, host: str = HOST) -> DataFrame:
    """make(batch rows, lines, base, lines that go) for each piece, with the set of lines sent to all tasks."""
    sent = docs.sparkSession.sparkContext.broadcast(bad)
    text_at, host_at = docs.columns.index("text"), docs.columns.index(host)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, buf, offsets in pieces_of(*flat_bytes(batch.column(text_at))):
                rows = batch.slice(at, to - at)
                names = pc.cast(rows.column(host_at), pa.string()).to_pylist()
                lines = Lines(buf, offsets)
                base = lines.base()
                yield make(rows, lines, base, _gone(lines, names, sent.value))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, schema)


def quality_rules(docs: DataFrame, host: str = HOST, share: float = MOST_SHARE, least: int = MOST_DOCS, most_sent: int = MOST_SENT, distinct: bool = False) -> DataFrame:
    """doc_id, the base figures, base_failed, n_left (words left after the lines that go) and kept, for each row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col(host).cast("string").alias(host))
    lines = stored(boilerplate(docs, host, share, least, distinct), "lines")
    bad = _sent(lines, most_sent)
    figures = "doc_id long, " + ", ".join(f"{c} long" for c in _BASE_COLUMNS)

    def make(rows, found, base, gone):
        lost = np.bincount(found.row[gone], (found.word_to - found.word_from)[gone], len(rows)).astype(np.int64)
        fails = _fails(base)
        columns = [rows.column(0), *(pa.array(base[c]) for c in _BASE_COLUMNS), pa.array(base["n_words"] - lost), pa.array(fails), pa.array(~fails & ~_depleted(base["n_words"], lost))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", *_BASE_COLUMNS, "n_left", "base_failed", "kept"])

    if bad is not None:
        return judged(docs, bad, make, figures + ", n_left long, base_failed boolean, kept boolean", host)

    def with_lines(rows, found, base, _):
        ends = np.searchsorted(found.row, np.arange(len(rows) + 1))
        line = pa.StructArray.from_arrays([pa.array(found.keys() if len(found.row) else np.zeros(0, np.int64)), pa.array((found.word_to - found.word_from).astype(np.int64))], ["line", "n"])
        columns = [rows.column(0), *(pa.array(base[c]) for c in _BASE_COLUMNS), pa.array(_fails(base)), pc.cast(rows.column(2), pa.string()), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), line)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", *_BASE_COLUMNS, "base_failed", "host", "lines"])

    each = judged(docs, {}, with_lines, figures + ", base_failed boolean, host string, lines array<struct<line: long, n: long>>", host).withColumn("row", F.monotonically_increasing_id())
    apart = each.select("row", "doc_id", *_BASE_COLUMNS, "base_failed", "host", F.explode_outer("lines").alias("x")).select("*", "x.line", "x.n").drop("x")
    # a line of a third of all rows is a hot key of this join: the adaptive plan splits it
    hits = apart.alias("a").join(lines.withColumn("bad", F.lit(True)).alias("b"), F.col("a.host").eqNullSafe(F.col("b.host")) & (F.col("a.line") == F.col("b.line")), "left")
    sums = hits.groupBy("row").agg(*(F.first(F.col(f"a.{c}")).alias(c) for c in ["doc_id", *_BASE_COLUMNS, "base_failed"]), F.coalesce(F.sum(F.when(F.col("bad"), F.col("a.n"))), F.lit(0)).alias("gone"))
    left = F.col("n_words") - F.col("gone")
    depleted = (F.col("gone") > 0) & ((left < LEAST_WORDS) | (left < LEAST_LEFT * F.col("n_words")))
    return sums.select("doc_id", *_BASE_COLUMNS, left.alias("n_left"), "base_failed", (~F.col("base_failed") & ~depleted).alias("kept"))


def _cut(rows: pa.RecordBatch, found: Lines, base: dict[str, np.ndarray], gone: np.ndarray) -> pa.RecordBatch:
    """The rows that are kept, without the lines that go."""
    lost = np.bincount(found.row[gone], (found.word_to - found.word_from)[gone], len(rows)).astype(np.int64)
    keep = ~_fails(base) & ~_depleted(base["n_words"], lost)
    columns, names = list(rows.columns), rows.schema.names
    if gone.any():
        text_at = names.index("text")
        texts, cuts = rows.column(text_at).to_pylist(), {}
        for row, start, end in zip(found.row[gone].tolist(), found.line_starts[gone].tolist(), found.line_ends[gone].tolist(), strict=True):
            cuts.setdefault(row, []).append((start - int(found.offsets[row]), end - int(found.offsets[row])))
        for row, spans in cuts.items():
            raw, at, out = texts[row].encode(), 0, []
            for start, end in spans:
                out.append(raw[at:start])
                at = min(end + 1, len(raw))
            texts[row] = b"".join([*out, raw[at:]]).decode()
        columns[text_at] = pa.array(texts, rows.column(text_at).type)
        if "n_chars" in names:
            chars_at = names.index("n_chars")
            old = columns[chars_at].to_pylist()
            columns[chars_at] = pa.array([len(texts[i]) if i in cuts else x for i, x in enumerate(old)], columns[chars_at].type)
    return pa.RecordBatch.from_arrays(columns, names).filter(pa.array(keep))


def filtered(docs: DataFrame, host: str = HOST, share: float = MOST_SHARE, least: int = MOST_DOCS, distinct: bool = False, most_sent: int = MOST_SENT) -> DataFrame:
    """The documents that are kept, without the lines that go; columns as they were, n_chars (if there) made anew.

    A set of lines too large to send is joined with the lines of numbered rows; each row then has its own lines that go.
    """
    lines = stored(boilerplate(docs, host, share, least, distinct), "lines")
    bad = _sent(lines, most_sent)
    if bad is not None:
        return judged(docs, bad, _cut, docs.schema, host)

    # the numbers must be the same in both reads, so the rows are stored with them
    numbered = stored(docs.withColumn("__lw_row", F.monotonically_increasing_id()), "numbered")

    def lines_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, buf, offsets in pieces_of(*flat_bytes(batch.column(2))):
                found = Lines(buf, offsets)
                if len(found.row):
                    places = pa.array(found.row + at)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(places), batch.column(1).take(places), pa.array(found.keys())], ["row", "host", "line"])

    small_batches(docs.sparkSession)
    apart = numbered.select("__lw_row", F.col(host).cast("string"), F.col("text").cast("string")).mapInArrow(lines_of, "row long, host string, line long")
    # distinct on the side of the rows: no list is longer than the lines of its text
    hits = apart.distinct().alias("a").join(lines.alias("b"), F.col("a.host").eqNullSafe(F.col("b.host")) & (F.col("a.line") == F.col("b.line")))
    going = hits.groupBy(F.col("a.row").alias("__lw_of")).agg(F.collect_list("a.line").alias("__lw_gone"))
    each = numbered.join(going, F.col("__lw_row") == F.col("__lw_of"), "left").select(*docs.columns, "__lw_gone")
    columns, text_at = docs.columns, docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, buf, offsets in pieces_of(*flat_bytes(batch.column(text_at))):
                rows, found = batch.slice(at, to - at), Lines(buf, offsets)
                gone, listed = np.zeros(len(found.row), bool), rows.column(len(columns))
                if len(gone) and listed.null_count < len(listed):
                    key, ends = found.keys(), np.searchsorted(found.row, np.arange(len(rows) + 1))
                    for i in np.flatnonzero(listed.is_valid().to_numpy(zero_copy_only=False)).tolist():
                        gone[ends[i] : ends[i + 1]] = np.isin(key[ends[i] : ends[i + 1]], listed[i].values.to_numpy(zero_copy_only=False))
                yield _cut(rows.select(columns), found, found.base(), gone)

    return each.mapInArrow(run, docs.schema)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents"), share=TEXTS_SHARE, least=TEXTS_DOCS, distinct=True)


OP4_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, md5(coalesce(text, '')) AS m, row_number() OVER (ORDER BY doc_id, text, source) AS rid FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
g AS (SELECT rid, p, count(*) OVER (PARTITION BY rid, array_to_string(w[p:p + 4], ' ')) AS n FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 3, 1))) AS p FROM w)),
r AS (SELECT rid, count(DISTINCT q) AS n_repeat_words FROM (SELECT rid, unnest(range(p, p + 5)) AS q FROM g WHERE n > 1) GROUP BY rid),
l AS (SELECT rid, source, m, l, regexp_extract_all(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS k FROM (SELECT rid, source, m, unnest(string_split(t, chr(10))) AS l FROM d)),
f AS (SELECT rid, source, m, l, len(k) AS n, array_to_string(k, ' ') AS k FROM l WHERE len(k) > 0),
h AS (SELECT source, count(DISTINCT m) AS host_texts FROM d GROUP BY source),
b AS (SELECT c.source, c.k FROM (SELECT source, k, count(DISTINCT m) AS n FROM f GROUP BY source, k) c JOIN h ON c.source IS NOT DISTINCT FROM h.source WHERE n > 5 AND n > CAST(0.05 AS DOUBLE) * host_texts),
u AS (SELECT rid, count(*) - count(DISTINCT l) AS n_dup_lines FROM f GROUP BY rid),
o AS (SELECT f.rid, sum(f.n) AS gone FROM f JOIN b ON f.source IS NOT DISTINCT FROM b.source AND f.k = b.k GROUP BY f.rid),
a AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(gone, 0) AS gone
      FROM d JOIN w USING (rid) LEFT JOIN r USING (rid) LEFT JOIN u USING (rid) LEFT JOIN o USING (rid)),
v AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, CAST(n_words - gone AS BIGINT) AS n_left, base_failed,
       NOT base_failed AND NOT (gone > 0 AND (n_words - gone < 10 OR n_words - gone < 0.2 * n_words)) AS kept FROM v
"""
