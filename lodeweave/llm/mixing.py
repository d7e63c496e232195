"""Mixing sources to target weights: hash-random keys, range sort within each source, prefix sums, exact cuts.

All of it is DataFrame operations. A document's key is a hash of the seed and its id; equal ranges of the key
are a range partitioning, as hashes are uniform, so no sampling is needed and a source with a third of all rows
is spread over as many ranges as its size asks for. Sums of (source, range) and their running sums give each
range its offset; a window within a range, whose size is bounded, gives the rest.

Cases: a null text has size 0; a null source is a source of its own and comes last; rows that repeat an id are
separate rows (ties go by size, then text hash); an empty table gives an empty mix; other columns are ignored
by `take` and kept by `mixed`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodeweave.llm.common import WORD_PATTERN, as_text, read_table, stored

MOST_REPEATS = 3
SEED = 17
RANGE_ROWS = 4096
#: Sources whose cuts are sent to all tasks.
MOST_SENT = 100_000


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """sizes (source, source_size) with `target`: by weight, at most MOST_REPEATS times the size, excess reshared by weight.

    The sources that stop are those with the largest weight for their size, so one sort by that ratio finds them:
    the first k stop, where k is the least for which the next one, at the weight's share of the rest, does not.
    """
    everything = W.partitionBy()
    name = [F.col("source").isNull(), F.hex(F.encode(F.col("source"), "UTF-8"))]
    pick = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("w", F.element_at(pick, (F.pmod(F.row_number().over(everything.orderBy(*name)) - 1, F.lit(len(weights))) + 1).cast("int")))
    steepest = everything.orderBy(F.when(F.col("source_size") == 0, F.lit(float("inf"))).otherwise(F.col("w") / F.col("source_size")).desc(), *name)
    before = steepest.rowsBetween(W.unboundedPreceding, -1)
    rest = (
        ranked.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("k", F.row_number().over(steepest))
        .withColumn("stopped", F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("w_rest", F.sum("w").over(steepest.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("share", (F.col("total") - MOST_REPEATS * F.col("stopped")) / F.col("w_rest"))
        .withColumn("stops", F.col("share") * F.col("w") > MOST_REPEATS * F.col("source_size"))
        .withColumn("first_free", F.min(F.when(~F.col("stops"), F.col("k"))).over(everything))
        .withColumn("level", F.max(F.when(F.col("k") == F.col("first_free"), F.col("share"))).over(everything))
    )
    return rest.select("source", "source_size", F.when(F.col("k") < F.coalesce("first_free", F.lit(1 << 30)), (MOST_REPEATS * F.col("source_size")).cast("double")).otherwise(F.col("level") * F.col("w")).alias("target"))


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """docs with mix_size (words of the text) and mix_key (uniform in 0 .. 2^60)."""
    tie = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return docs.withColumn("mix_size", F.regexp_count(as_text(), F.lit(WORD_PATTERN)).cast("long")).withColumn("mix_key", F.conv(F.substring(tie, 1, 15), 16, 10).cast("long"))


def take(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, text_hash, key, whole (times that all of it is taken).

    A source whose target is more than its size is taken whole as often as that goes; the rest of the target is
    taken in the order of the keys. The document at the cut gives its first words only, so a source's taken
    words are its target, rounded down.
    """
    slim = sized(docs, seed).select("doc_id", F.col("source").cast("string").alias("source"), F.col("mix_size").alias("size"), F.col("mix_key").alias("key"), F.md5(as_text()).alias("text_hash"))
    slim = stored(slim, "mix")  # the texts are read once
    n = F.greatest(F.lit(1), F.ceil(F.count("*") / RANGE_ROWS)).cast("long")
    per_source = slim.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"), n.alias("ranges"))
    goal = targets(per_source.select("source", "source_size")).alias("t").join(per_source.select("source", "ranges").alias("p"), F.col("t.source").eqNullSafe(F.col("p.source"))).select("t.source", "source_size", "target", "ranges")
    ranged = (
        slim.alias("d").join(goal.alias("g"), F.col("d.source").eqNullSafe(F.col("g.source")))
        .select("d.*", "source_size", "target", "ranges")
        .withColumn("range", F.floor(F.col("key") / F.floor(F.lit(1 << 60) / F.col("ranges") + 1)).cast("long"))
    )
    sums = ranged.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    starts = sums.select("source", "range", (F.sum("range_size").over(W.partitionBy("source").orderBy("range")) - F.col("range_size")).alias("range_start"))
    order = W.partitionBy("source", "range").orderBy("key", "doc_id", "size", "text_hash")
    placed = (
        ranged.alias("d").join(starts.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")) & (F.col("d.range") == F.col("s.range")))
        .select("d.*", "range_start")
        .withColumn("start", F.col("range_start") + F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("size"))
    )
    whole = F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1))).cast("long")
    left = F.floor(F.col("target")).cast("long") - whole * F.col("source_size")
    part = F.least(F.greatest(left - F.col("start"), F.lit(0)), F.col("size"))
    return placed.select("doc_id", "source", "size", "source_size", "target", (whole * F.col("size") + part).cast("long").alias("taken"), "text_hash", "key", whole.alias("whole"))


def _order(size, text_hash, key, doc_id):
    """A row's place in its source."""
    return F.struct(key.alias("key"), doc_id.alias("doc_id"), size.alias("size"), text_hash.alias("text_hash"))


def cuts(found: DataFrame) -> DataFrame:
    """(source, whole, cut, part) of each source: from the row `cut` on, rows are no more taken once more; that row gives `part` words."""
    place = _order(F.col("size"), F.col("text_hash"), F.col("key"), F.col("doc_id"))
    part = F.col("taken") - F.col("whole") * F.col("size")
    open_row = F.when(part < F.col("size"), place)
    return found.groupBy("source").agg(F.first("whole").alias("whole"), F.min(open_row).alias("cut"), F.min_by(part, open_row).alias("part"))


def _each_by_cuts(docs: DataFrame, edges: DataFrame, seed: int) -> DataFrame:
    """docs as often as they are taken, with __lw_part; the cuts, a row for each source, are sent to all tasks, so no text moves."""
    own = docs.select(*(F.col(f"`{c}`") for c in docs.columns), F.col("source").cast("string").alias("__lw_source"), F.col("doc_id").alias("__lw_id"), F.md5(as_text()).alias("__lw_hash"))
    own = sized(own, seed).withColumnsRenamed({"mix_size": "__lw_size", "mix_key": "__lw_key"})
    small = F.broadcast(edges.select(F.col("source").alias("__lw_of"), F.col("whole").alias("__lw_whole"), F.col("cut").alias("__lw_cut"), F.col("part").alias("__lw_at_cut")))
    placed = own.join(small, F.col("__lw_source").eqNullSafe(F.col("__lw_of")))
    place = _order(F.col("__lw_size"), F.col("__lw_hash"), F.col("__lw_key"), F.col("__lw_id"))
    once_more = F.when(F.col("__lw_cut").isNull() | (place < F.col("__lw_cut")), F.col("__lw_size")).when(place == F.col("__lw_cut"), F.col("__lw_at_cut")).otherwise(0)
    copies = _copies(F.col("__lw_size"), F.col("__lw_whole") * F.col("__lw_size") + once_more)
    return placed.select(*(F.col(f"`{c}`") for c in docs.columns), F.explode(copies).alias("__lw_part"))


def _copies(size, taken):
    """0 for each whole copy, and the words of one that is cut. A text without words is one copy."""
    whole = F.when(size > 0, F.floor(taken / size)).otherwise(F.lit(1)).cast("int")
    part = F.when(size > 0, taken % size).otherwise(F.lit(0)).cast("int")
    return F.concat(F.array_repeat(F.lit(0), whole), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>")))


def _each_by_rows(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The same by a join of rows: where more sources than can be sent, or rows alike in all at a cut."""
    alike = W.partitionBy("doc_id", "source", "text_hash")
    same = F.col("d.doc_id").cast("string").eqNullSafe(F.col("m.doc_id").cast("string")) & F.col("d.source").cast("string").eqNullSafe(F.col("m.source")) & (F.md5(as_text("d.text")) == F.col("m.text_hash"))
    rows = docs
    if found.groupBy("doc_id", "source", "text_hash").count().filter("count > 1").limit(1).count():
        found = found.withColumn("__lw_nth", F.row_number().over(alike.orderBy(F.col("taken").desc())))
        rows = docs.withColumn("__lw_nth", F.row_number().over(W.partitionBy("doc_id", F.col("source").cast("string"), F.md5(as_text())).orderBy("doc_id")))
        same = same & (F.col("d.__lw_nth") == F.col("m.__lw_nth"))
    return rows.alias("d").join(found.alias("m"), same).select(*(F.col(f"d.`{c}`") for c in docs.columns), F.explode(_copies(F.col("m.size"), F.col("m.taken"))).alias("__lw_part"))


def mixed(docs: DataFrame, seed: int = SEED, most_sent: int = MOST_SENT) -> DataFrame:
    """The mix itself: each document as often as it is taken, the one at a source's cut with its first words only.

    Columns as they were; n_chars (if there) is made anew for a text that is cut. A document whose `taken` is 0 is
    not in the mix; one without words is in it once, as it costs nothing. A mix is a cut for each source, so the
    cuts are sent and texts stay where they are; with more than most_sent sources, or with rows alike in id, source and
    text at a cut, rows are numbered and joined instead, so that each meets one decision.
    """
    found = stored(take(docs, seed), "taken")
    edges = stored(cuts(found), "cuts")
    edge = F.col("e.cut")
    at_cut = found.alias("f").join(edges.alias("e"), F.col("f.source").eqNullSafe(F.col("e.source")) & (_order(F.col("f.size"), F.col("f.text_hash"), F.col("f.key"), F.col("f.doc_id")) == edge))
    if edges.count() <= most_sent and not at_cut.groupBy(F.hex(F.encode("f.source", "UTF-8"))).count().filter("count > 1").limit(1).count():
        each = _each_by_cuts(docs, edges, seed)
    else:
        each = _each_by_rows(docs, found)
    cut = F.col("__lw_part") > 0
    words = F.regexp_extract_all(as_text(), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    out = each.withColumn("text", F.when(cut, F.array_join(F.slice(words, F.lit(1), F.greatest(F.col("__lw_part"), F.lit(1))), "")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(cut, F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return take(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5('17|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS key, md5(coalesce(text, '')) AS text_hash
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, CAST([1.0, 2.0, 3.0][1 + CAST((row_number() OVER (ORDER BY source IS NULL, hex(encode(source))) - 1) % 3 AS INT)] AS DOUBLE) AS w FROM s),
q AS (SELECT *, row_number() OVER o AS k, sum(source_size) OVER () AS total,
             coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped,
             sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_rest
      FROM r WINDOW o AS (ORDER BY CASE WHEN source_size = 0 THEN CAST('inf' AS DOUBLE) ELSE w / source_size END DESC, source IS NULL, hex(encode(source)))),
h AS (SELECT *, CAST(total - 3 * stopped AS DOUBLE) / w_rest AS share FROM q),
f AS (SELECT *, min(CASE WHEN NOT share * w > 3 * source_size THEN k END) OVER () AS first_free FROM h),
t AS (SELECT source, source_size,
             CASE WHEN k < coalesce(first_free, 1000000000) THEN CAST(3 * source_size AS DOUBLE)
                  ELSE max(CASE WHEN k = first_free THEN share END) OVER () * w END AS target FROM f),
p AS (SELECT d.*, t.source_size, t.target,
             sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size, text_hash ROWS UNBOUNDED PRECEDING) - size AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(CAST(floor(target / greatest(source_size, 1)) AS BIGINT) * size
            + least(greatest(CAST(floor(target) AS BIGINT) - CAST(floor(target / greatest(source_size, 1)) AS BIGINT) * source_size - start, 0), size) AS BIGINT) AS taken
FROM p
"""
