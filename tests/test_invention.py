"""Invented pools, prompts with examples, counters, the render gate, and caches on streams."""

from __future__ import annotations

import json
import time

from pyspark.sql import functions as F

from lodeweave.functions import messages as M
from lodeweave.functions import tokens as N
from lodeweave.operators import aggregates as A
from lodeweave.operators import generation as G
from lodeweave.operators import invention as V
from lodeweave.operators import windows as W
from lodeweave.plans import corpus
from lodeweave.sources import adapters
from lodeweave.sources import readers as R
from lodeweave.sources import sinks as K
from lodeweave.streaming import caches as C

LONG = "Please describe how the old harbour of the town was built, who paid for it and what it cost at the time"


class Makes:
    """Answers by the last word of the request."""

    def __init__(self, texts):
        self.texts = texts

    def __call__(self, messages, tools, seed):
        said = messages[-1]["text"].split()[-1]
        if self.texts[said] is None:
            raise ValueError("no")
        return {"content": self.texts[said] + "\nsecond line", "tool_calls": []}


def seeds(spark, *names, tools=False):
    rows = [(i, x, ["{}"]) if tools else (i, x) for i, x in enumerate(names)]
    return spark.createDataFrame(rows, "_seq long, seed string" + (", tools array<string>" if tools else ""))


def test_pools_share_one_index(spark):
    texts = {"a": LONG, "b": LONG + ".", "c": "What is the weather like in the far north today", "d": None, "e": "e", "f": "Which of these three numbers is the greatest one", "g": LONG.upper(), "h": "Which of these three numbers is the greatest one", "i": "Say how far it is from here to the next station"}
    pools = [V.Pool("free", "uncensored", seeds(spark, "a", "b", "d", "e", "c", "f"), "Make one like {seed}", 2), V.Pool("tools", "coding", seeds(spark, "g", "h", "i", tools=True), "Ask for {seed}", 9)]
    got = {r.messages[0].parts[0].text: r for r in V.invent_pools(pools, G.no_cache(spark), Makes(texts)).collect()}
    # b is near a, d fails, e is its own seed; f lies beyond the limit of its pool, so h is free to stay; g is a
    assert set(got) == {texts[x] for x in "achi"}
    assert (got[LONG].source.name, got[LONG].domain, got[LONG].origin, got[LONG].tools) == ("teacher:free", "uncensored", "teacher", None)
    assert (got[texts["h"]].source.name, got[texts["h"]].domain, got[texts["h"]].tools) == ("teacher:tools", "coding", ["{}"])
    assert got[texts["h"]].id.startswith("invented-tools-") and len(got[texts["h"]].id) == 15 + 12


def test_few_shot(spark):
    examples = spark.createDataFrame([(i, f"q{i}", f" why {i} #### no\n#### {i} " if i else "bare") for i in range(10)] + [(-1, None, "x")], "_seq long, question string, answer string")
    (row,) = V.few_shot(examples, 3).collect()
    assert row.prompt == "Q: q0\nA: \nbare\nQ: q1\nA: why 1 #### no\n1\nQ: q2\nA: why 2 #### no\n2\n\n"
    assert V.asked(spark.createDataFrame([("z",)], "question string"), examples, 3).first().prompt == row.prompt + "Q: z\nA:"


def test_heartbeat_and_counters(spark):
    rows = spark.range(50).withColumn("t", F.concat(F.lit("a b "), F.col("id").cast("string")))
    assert sorted(V.heartbeat(rows, "rows", 7).collect()) == sorted(rows.collect())
    count = N.counter(str.split)
    some = spark.createDataFrame([("a b c",), ("",), (None,)], "t string")
    assert [r.n for r in some.select(count("t").alias("n")).collect()] == [3, 1, None]
    prompts = adapters.canonical(spark.createDataFrame([(1, "one two three four five six"), (2, "extraordinarily long words")], "_seq long, text string"), adapters.Context("s", None, "coding"), F.col("_seq").cast("string"), F.array(M.text_message("user", F.col("text"))))
    assert {r._seq: (r.tokens, r.reason) for r in corpus.judged(prompts, tokens=count).collect()} == {1: (6, None), 2: (3, "prompt_too_short")}


def test_render_gate(spark):
    from tests.test_dialogs import GOOD, TOOL, dialogs, msg

    report = M.render_report(dialogs(spark, (GOOD, [TOOL]), ([msg("assistant", "x")], None), ([msg("user", "q"), msg("assistant", "<think>\na\n</think>\n\nb")], None))).first()
    assert report.rows == 3 and report.failures == 1 and report.opened == report.closed == 3 and report.balanced and report.probe and report.opens


def test_small_counts(spark):
    sources = spark.createDataFrame([("a", "x", 3), ("b", "x", 4), ("c", "y", 5)], "dataset string, domain string, cap long")
    assert {tuple(r) for r in A.caps_by_domain(sources).collect()} == {("x", 7), ("y", 5)}
    known = spark.createDataFrame([("a", "mit", "1")], "dataset string, license string, revision string")
    assert {r.dataset: r.license for r in R.source_metadata(sources, known).collect()} == {"a": "mit", "b": None, "c": None}
    assert [tuple(r) for r in W.most_common(sources, "domain").collect()] == [("x", 2), ("y", 1)]
    G.guard_fingerprint(3, 3)
    try:
        G.guard_fingerprint(3, 4)
    except ValueError as e:
        assert "3" in str(e) and "4" in str(e)
    else:
        raise AssertionError("no error")


def test_texts_and_reports(spark, tmp_path):
    K.write_chunks(spark.createDataFrame([("a\nb",), ("c",)], "text string"), str(tmp_path / "chunks"))
    assert {r.value for r in spark.read.text(str(tmp_path / "chunks")).collect()} == {"a b", "c"}
    report = K.audit_report(spark.createDataFrame([("y", "2", "t2"), ("x", "1", "t1")], "domain string, id string, text string"))
    assert report == "# Audit sample\n\n## x\n\n### 1\n\nt1\n\n## y\n\n### 2\n\nt2\n"


def test_paged_steps():
    def plain(first, more, sink, buffer):
        """A token at a time, each position marked."""
        n, keys, values = first, set(), set()
        if n > sink + buffer:
            whole = (n - sink) // buffer
            keys |= set(range(sink, sink + whole * buffer))
            values |= set(range(sink, n - buffer))
        for _ in range(more):
            n += 1
            past = n - sink - buffer
            if past > 0:
                if past % buffer == 1 or buffer == 1:
                    keys |= set(range(n - buffer - 1, n - 1))
                values.add(n - buffer - 1)
        return n, len(keys), len(values)

    for sink, buffer in ((2, 3), (4, 8), (1, 2)):
        for first in range(sink + 1, sink + 4 * buffer):
            for parts in ((0,), (1,), (5, 1), (2, 9, 4), (1, 1, 1, 20)):
                at = C.after(None, first, sink, buffer)
                for n in parts:
                    at = C.after(at, n, sink, buffer)
                assert (at[0], at[1] - sink, at[2] - sink) == plain(first, sum(parts), sink, buffer), (sink, buffer, first, parts)


def files(folder, *batches):
    folder.mkdir()
    for k, rows in enumerate(batches):
        (folder / f"{k}.json").write_text("\n".join(json.dumps(r) for r in rows))
        time.sleep(1.1)  # files are taken in the order of their times
    return str(folder)


def test_paged_stream(spark, tmp_path):
    at = files(tmp_path / "in", [{"sequence": 1, "step": 0, "tokens": 300}, {"sequence": 2, "step": 0, "tokens": 40}], [{"sequence": 1, "step": 2, "tokens": 7}, {"sequence": 1, "step": 1, "tokens": 1}])
    stream = spark.readStream.schema("sequence long, step long, tokens long").option("maxFilesPerTrigger", 1).json(at)
    query = C.paged(stream).writeStream.format("memory").queryName("paged").outputMode("update").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    want = [C.after(None, 300), C.after(None, 40), C.after(C.after(None, 300), 8)]
    assert sorted(tuple(r) for r in spark.sql("SELECT length, keys, values FROM paged").collect()) == sorted((n, k - C.SINK, v - C.SINK) for n, k, v in want)


def test_cache_stream_upgrades(spark, tmp_path):
    said = lambda x: {"content": x, "tool_calls": []}
    at = files(tmp_path / "in", [{"key": "a", "completion": said("1")}, {"key": "b"}], [{"key": "a", "completion": said("2")}, {"key": "b", "completion": said("3")}, {"key": "b"}])
    stream = spark.readStream.schema(R.CACHE).option("maxFilesPerTrigger", 1).json(at)
    C.cache_stream(stream, str(tmp_path / "cache"), str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    entries, bad = R.read_cache(spark, str(tmp_path / "cache"))
    assert {r.key: r.completion.content for r in entries.collect()} == {"a": "1", "b": "3"} and bad.count() == 0
