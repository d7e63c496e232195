"""Dedup, sampling, aggregation, windows, quantization, storage and streams."""

from __future__ import annotations

import json
import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodeweave import schema as S
from lodeweave.functions import minhash as H
from lodeweave.functions import quant as Q
from lodeweave.operators import aggregates as A
from lodeweave.operators import contamination as C
from lodeweave.operators import dedup as D
from lodeweave.operators import sampling as P
from lodeweave.operators import windows as W
from lodeweave.sources import readers as R
from lodeweave.sources import sinks as K
from lodeweave.streaming import incremental as I


def near_texts(n=60):
    r = random.Random(11)
    base = [" ".join(r.choice("abcdefghij") * r.randint(1, 6) for _ in range(60)) for _ in range(8)]
    out = []
    for i in range(n):
        words = r.choice(base).split()
        for _ in range(r.choice([0, 0, 1, 2, 4])):
            words[r.randrange(len(words))] = r.choice(["zz", "qq", "xx"])
        out.append((i, " ".join(words).upper() if r.random() < 0.2 else " ".join(words)))
    return out


def greedy(rows, sig):
    """A pass in order, as the operator is defined."""
    kept, keys, out = [], set(), {}
    for i, t in rows:
        key = " ".join(t.lower().split())
        if key in keys:
            out[i] = "duplicate_prompt"
        elif any(sum(a == b for a, b in zip(sig[i], sig[j], strict=True)) / 64 >= 0.85 for j in kept):
            out[i] = "near_duplicate"
        else:
            out[i] = None
            kept.append(i)
            keys.add(key)
    return out


@pytest.mark.parametrize("mode", ["md5", "blake2b"])
def test_first_wins_is_greedy(spark, mode):
    rows = near_texts()
    df = spark.createDataFrame(rows, "_seq long, text string")
    sig = {r._seq: r.s for r in df.select("_seq", H.signature("text", mode).alias("s")).collect()}
    want = greedy(rows, sig)
    assert {r._seq: r.reason for r in D.dedup_reasons(df, mode=mode).collect()} == want
    assert {"duplicate_prompt", "near_duplicate"} < set(want.values())
    pairs = {(r.a, r.b) for r in D.near_pairs(D.signed(df, mode=mode)).collect()}
    assert pairs == {(i, j) for i in sig for j in sig if i < j and sum(a == b for a, b in zip(sig[i], sig[j], strict=True)) / 64 >= 0.85}


def test_images_are_part_of_a_row(spark):
    df = spark.createDataFrame([(1, "same text here", ["a"]), (2, "same text here", ["b"]), (3, "same text here", ["a"])], "_seq long, text string, shas array<string>")
    assert {r._seq: r.reason for r in D.dedup_reasons(df, images=F.col("shas")).collect()} == {1: None, 2: None, 3: "duplicate_prompt"}


def test_chains_keep_both_ends(spark):
    nodes = spark.createDataFrame([(i,) for i in range(5)], "k long")
    edges = spark.createDataFrame([(i, i + 1) for i in range(4)], "a long, b long")
    assert {r.k for r in D.first_wins(nodes, edges).filter("kept").collect()} == {0, 2, 4}


def test_image_novelty(spark):
    r = random.Random(3)
    rows = [(i, [str(x) for x in {r.randrange(12) for _ in range(r.randint(0, 3))}]) for i in range(40)]
    seen, want = set(), {}
    for i, shas in rows:
        if shas:
            want[i] = not set(shas) <= seen
            seen |= set(shas) if want[i] else set()
    got = D.image_novelty(spark.createDataFrame(rows, "_seq long, shas array<string>"))
    assert {x._seq: x.novel for x in got.collect()} == want


def test_allocation(spark):
    sources = spark.createDataFrame([("a", None, "reasoning", 8000), ("b", None, "reasoning", 2000), ("c", None, "coding", 1), ("d", None, "other", 5)], "dataset string, config string, domain string, cap long")
    assert {r.dataset: r.quota for r in P.allocate(sources, 1000).collect()} == {"a": 240, "b": 60, "c": 300, "d": 0}
    rows = spark.createDataFrame([("a", i) for i in range(9)], "source string, _seq long")
    assert P.take_quota(rows, spark.createDataFrame([("a", 4)], "source string, quota long")).count() == 4
    assert [r._seq for r in P.take_capped(rows, F.col("_seq") % 2 == 1, 2, ["source"]).orderBy("_seq").collect()] == [0, 1, 2, 3]


def test_anchoring(spark):
    assert P.candidates_for(7500, 0.70) == 10715
    with pytest.raises(ValueError):
        P.candidates_for(1, 0)
    sources = spark.createDataFrame([("t", None, "coding", 1000), ("u", None, "reasoning", 10)], "dataset string, config string, domain string, cap long")
    needs = spark.createDataFrame([("coding", 1049)], "domain string, need long")
    anchored = P.anchored_caps(sources, needs)
    assert {r.dataset: r.anchored_cap for r in anchored.collect()} == {"t": 1049, "u": 10}
    assert P.driver_target(anchored).first().target == math.ceil(1049 / 0.3)


def test_splits(spark):
    r = random.Random(5)
    rows = [(f"i{k}", r.choice(["coding", "reasoning", "roleplay"]), [str(r.randrange(9))] if r.random() < 0.4 else []) for k in range(90)]
    df = spark.createDataFrame(rows, "id string, domain string, shas array<string>")
    plain = P.stratified_split(df, 20)
    assert plain.count() == 90 and 18 <= plain.filter("part = 'val'").count() <= 22
    split = P.stratified_split(df, 20, shas="shas").collect()
    val = [s for x in split if x.part == "val" for s in x.shas]
    assert len(val) == len(set(val)) and not set(val) & {s for x in split if x.part == "train" for s in x.shas}
    # as a pass over domains and hash order takes them
    order = {x.id: x.h for x in df.select("id", P.hash_order("id").alias("h")).collect()}
    seen, want = set(), set()
    for domain in ("coding", "reasoning", "roleplay"):
        own = sorted((x for x in rows if x[1] == domain), key=lambda x: (order[x[0]], x[0]))
        n = round(20 * len(own) / 90)
        for x in own:
            if n and not set(x[2]) & seen:
                want.add(x[0])
                seen |= set(x[2])
                n -= 1
    assert {x.id for x in split if x.part == "val"} == want
    assert P.downsample(df, 30, S.DOMAIN_SHARE).count() == 30 == P.downsample(df.repartition(5), 30, S.DOMAIN_SHARE).join(P.downsample(df, 30, S.DOMAIN_SHARE), "id").count()
    assert P.batches(df, 7).groupBy("batch").count().filter("count = 7").count() == 12
    assert P.last_windows(spark.range(100).withColumnRenamed("id", "_seq"), 64).filter("held_out").count() == 64


def test_reports(spark):
    rows = spark.createDataFrame([("a", 10, 1), ("a", 20, 0), ("b", 30, 2)], "domain string, tokens long, k int")
    got = {r.domain: tuple(r)[1:] for r in A.summarise(rows, images=F.col("k")).collect()}
    assert got == {"a": (2, 0.6667, 30, 0.5, 1, 0.5, 1), "b": (1, 0.3333, 30, 0.5, 1, 1.0, 2)}
    rolls = spark.createDataFrame([(1, 0, True, False, "x"), (1, 1, False, False, "y"), (2, 0, True, False, "p"), (2, 1, True, False, "q"), (3, 0, False, False, "r"), (3, 1, False, False, "s"), (4, 0, True, True, "t"), (4, 1, True, False, "u"), (5, 0, True, False, "v")], "id int, rollout int, accepted boolean, error boolean, example string")
    got = {r.id: (r.verdict, r.passes, r.example) for r in A.rollout_verdicts(rolls, 2, keep="example").collect()}
    assert got == {1: ("keep", 1, "x"), 2: ("all_pass", 2, None), 3: ("all_fail", 0, None), 4: ("teacher_error", None, None), 5: ("teacher_error", None, None)}
    with pytest.raises(RuntimeError):
        A.guard_outage(spark.createDataFrame([("seeded", 10, 6)], "stage string, attempted int, errors int"))
    with pytest.raises(ValueError):
        A.guard_thin_samples(spark.createDataFrame([("coding", 12)], "domain string, attempted int"))
    spread = A.run_spread(spark.createDataFrame([("c", 0, 3.5), ("c", 1, 3.25)], "config string, run int, ppl double"), ["config"])
    assert spread.first().spread == 0.25
    assert A.accuracy(spark.createDataFrame([("c", True), ("c", False)], "config string, hit boolean"), ["config"]).first().accuracy == 0.5


def test_windows(spark):
    r = random.Random(1)
    lists = [[r.randrange(99) for _ in range(r.randint(0, 40))] for _ in range(60)]
    df = spark.createDataFrame([(i * 50, x) for i, x in enumerate(lists)], "_seq long, tokens array<int>")
    flat = [v for x in lists for v in x]
    got = [x.tokens for x in W.token_windows(df, "tokens", 16).orderBy("window").collect()]
    assert got == [flat[k : k + 16] for k in range(0, len(flat) - 15, 16)]
    texts = ["x" * r.randint(0, 30) for _ in range(50)]
    want, buffer, size = [], [], 0
    for t in texts:
        if t:
            buffer.append(t)
            size += len(t)
            if size >= 40:
                want.append(" ".join(buffer)[:55])
                buffer, size = [], 0
    df = spark.createDataFrame(list(enumerate(texts)), "_seq long, text string").repartition(3)
    assert [x.text for x in W.pack_chunks(df, least=40, most=55).orderBy("chunk").collect()] == want
    assert W.pack_chunks(df, least=40, most=55, chunks=3).count() == 3


def test_quantization(spark):
    r = np.random.default_rng(0)
    x = r.normal(size=64)
    (got,) = spark.createDataFrame([(x.tolist(),)], "x array<double>").select(Q.fake_quant(F.col("x"), 64, 16, 2)).first()
    g = x.reshape(4, 16)
    least = g.min(1, keepdims=True)
    scale = np.maximum(g.max(1, keepdims=True) - least, 1e-6) / 3
    assert np.allclose(got, (np.round(np.clip((g - least) / scale, 0, 3)) * scale + least).ravel())
    with pytest.raises(ValueError):
        Q.fake_quant(F.col("x"), 64, 10, 2)
    steps = spark.range(700).select("id", Q.pages_retired(F.col("id")).alias("p"), Q.values_retired(F.col("id")).alias("v")).collect()
    pages = values = 0
    for s in steps:  # a decode step at a time
        q = s.id - 32 - 128
        if q > 0:
            pages += q % 128 == 1
            values += 1
        assert (s.p, s.v) == (pages, values)
    (kl,) = spark.createDataFrame([([1.0, 2.0], [2.0, 1.0])], "p array<double>, q array<double>").select(Q.kl(F.col("p"), F.col("q"))).first()
    p, q = (np.exp(v) / np.exp(v).sum() for v in (np.array([1.0, 2.0]), np.array([2.0, 1.0])))
    assert math.isclose(kl, (p * np.log(p / q)).sum())
    nll = spark.createDataFrame([(0, i, 1.0) for i in range(10)], "window int, pos int, nll double")
    assert tuple(Q.window_nll(nll, 4).first())[1:] == (3.0, 3, 6.0, 6)
    promoted = Q.promoted_channels(spark.createDataFrame([([0.0, 5.0, -9.0, 1.0],)], "e array<double>"), "e", 0.5)
    assert {c.channel for c in promoted.filter("promoted").collect()} == {1, 2}


def test_contamination(spark):
    long = " ".join(f"word{i}" for i in range(60))
    rows = spark.createDataFrame([(1, "Eval  text one"), (2, long + " x"), (3, "other words entirely " * 3), (4, ""), (5, f"before {long} after")], "id long, text string")
    evals = spark.createDataFrame([("eval text ONE", 1), (long, 2), ("tiny", 3)], "text string, item_id long")
    assert {(r.id, r.kind) for r in C.collisions(rows, evals).collect()} >= {(1, "exact"), (2, "near")}
    assert 3 not in {r.id for r in C.collisions(rows, evals).collect()}
    assert {(r.id, r.item_id) for r in C.contained(rows, evals, "id").collect()} == {(1, 1), (2, 2), (5, 2)}


def test_storage(spark, tmp_path):
    path = str(tmp_path / "rows.json")
    rows = spark.createDataFrame([(1, "a b"), (2, "é")], "i int, t string")
    assert K.write_jsonl(rows, path) == 2
    assert sorted(tuple(r) for r in R.read_jsonl(spark, path, "i int, t string").collect()) == [(1, "a b"), (2, "é")]
    with pytest.raises(ValueError):
        K.guard_shrink(spark, path, rows.limit(1))
    cache = tmp_path / "cache"
    cache.mkdir()
    done = lambda x: {"content": x, "tool_calls": []}
    lines = [{"key": "a", "accepted": True}, {"key": "a", "completion": done("late")}, {"key": "b", "completion": done("first")}, {"key": "b", "completion": done("second")}]
    (cache / "part-0.json").write_text("\n".join(map(json.dumps, lines)) + '\n\n{"key": "torn\n')
    entries, bad = R.read_cache(spark, str(cache))
    assert {r.key: r.completion.content for r in entries.collect()} == {"a": "late", "b": "first"} and bad.count() == 1
    new = spark.createDataFrame([("b", done("third"), None), ("c", done("new"), None)], R.CACHE)
    K.put_cache(spark, str(cache), new)
    entries, _ = R.read_cache(spark, str(cache))
    assert {r.key: r.completion.content for r in entries.collect()} == {"a": "late", "b": "first", "c": "new"}
    at = str(tmp_path / "manifest.json")
    K.write_manifest(spark, at, {"run": 1})
    assert K.merge_manifest(spark, at, {"m2": {"x": "é"}}) == {"run": 1, "m2": {"x": "é"}} == json.loads(K.read_text(at, spark))
    numbered = R.with_seq(spark.createDataFrame([(k,) for k in "dbca"], "k string"), "k")
    assert [(r.k, r._seq) for r in numbered.orderBy("_seq").collect()] == [("a", 0), ("b", 1), ("c", 2), ("d", 3)]
    seeds = spark.createDataFrame([(0, " "), (1, " x "), (2, "y"), (3, "z")], "_seq long, q string")
    assert [(r.id, r.text) for r in R.harvest_seeds(seeds, "org/n", None, "train", "q", 2).orderBy("_seq").collect()] == [("n-default-train-0", "x"), ("n-default-train-1", "y")]


def test_incremental_dedup_stream(spark, tmp_path):
    rows = near_texts(40)
    source = tmp_path / "in"
    source.mkdir()
    for k in range(2):
        (source / f"{k}.json").write_text("\n".join(json.dumps({"_seq": i, "text": t}) for i, t in rows[k * 20 : k * 20 + 20]))
        time.sleep(1.1)  # files are taken in the order of their times
    stream = spark.readStream.schema("_seq long, text string").option("maxFilesPerTrigger", 1).json(str(source))
    index, ledger = str(tmp_path / "index"), str(tmp_path / "ledger")
    query = I.dedup_stream(stream, index, ledger, str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    query.awaitTermination()
    whole = {r._seq: r.reason for r in D.dedup_reasons(spark.createDataFrame(rows, "_seq long, text string")).collect()}
    assert {r._seq for r in spark.read.parquet(index).collect()} == {i for i, x in whole.items() if x is None}
    assert {r._seq: r.reason for r in spark.read.json(ledger).collect()} == {i: x for i, x in whole.items() if x}


def test_event_windows_on_a_stream(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    query = I.tumbling(stream).writeStream.format("memory").queryName("tumbled").outputMode("complete").start()
    query.processAllAvailable()
    query.stop()
    assert sorted(map(str, spark.sql("SELECT window_start, event_type, n FROM tumbled").collect())) == sorted(map(str, I.tumbling(events).select("window_start", "event_type", "n").collect()))
