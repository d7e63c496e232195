"""The quality classifier against plain Python: statistics, the choice of rows, splits, and the walk down flat trees."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodeweave.llm import classify
from lodeweave.llm.common import flat_bytes
from lodeweave.llm.trees import fit

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def plain_statistics(text):
    """The twelve figures that are no shares of byte kinds, and then those."""
    words, lines, raw = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)], text.encode()
    sizes, grams = [len(w.encode()) for w in words], {}
    for k in range(len(words) - 4):
        grams.setdefault(tuple(words[k : k + 5]), []).append(k)
    twice = {k + j for v in grams.values() if len(v) > 1 for k in v for j in range(5)}
    n, mean = max(len(words), 1), sum(sizes) / max(len(words), 1)
    out = [
        math.log1p(len(raw)), math.log1p(len(words)), sum(map(len, words)) / n, max(sizes, default=0), math.sqrt(sum((x - mean) ** 2 for x in sizes) / n), len(re.findall(r"[#*$%&|<>]", text)) / n,
        len(lines) / n, (len(lines) - len(set(lines))) / max(len(lines), 1), len(twice) / n, len({w.translate(LOWER) for w in words}) / n, sum("A" <= w[0] <= "Z" for w in words) / n, len(text) / max(len(raw), 1),
    ]
    return out + [sum(b in kind for b in raw) / max(len(raw), 1) for kind in classify._KINDS] + [sum(b > 127 for b in raw) / max(len(raw), 1)]


def test_statistics_agree_with_plain_ones():
    import pyarrow as pa

    r = random.Random(3)
    parts = ["the ", "Cat ", "é", "\n", "\n\n", "a b c d e f\n", "$#|", "<x>", "\t", "12.", " ", "A B C\n", "日本 "]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 50))) for _ in range(200)] + ["", "word " * 30_000]
    got = classify.statistics(*flat_bytes(pa.array(texts)))
    assert np.allclose(got, np.array([plain_statistics(t) for t in texts]), rtol=1e-5, atol=1e-6)


def plain_fit(x, y, trees, depth, rate, l2, least):
    """Trees as nested tuples (feature, threshold, left, right) or leaf values; every value of a feature is a cut."""
    raw, out = [math.log((sum(y) + 1) / (len(y) - sum(y) + 1))] * len(y), []
    start = raw[0]

    def grow(rows, level, grad, hess):
        g, h = sum(grad[i] for i in rows), sum(hess[i] for i in rows)
        best = (1e-9, None, None)
        if level < depth:
            for f in range(len(x[0])):
                for cut in sorted({v[f] for v in x})[:-1]:
                    left = [i for i in rows if x[i][f] <= cut]
                    gl, hl = sum(grad[i] for i in left), sum(hess[i] for i in left)
                    if hl >= least and h - hl >= least and (gain := gl**2 / (hl + l2) + (g - gl) ** 2 / (h - hl + l2) - g**2 / (h + l2)) > best[0] + 1e-9:
                        best = (gain, f, cut)
        if best[1] is None:
            return -rate * g / (h + l2)
        _, f, cut = best
        return f, cut, grow([i for i in rows if x[i][f] <= cut], level + 1, grad, hess), grow([i for i in rows if x[i][f] > cut], level + 1, grad, hess)

    for _ in range(trees):
        p = [1 / (1 + math.exp(-v)) for v in raw]
        tree = grow(range(len(y)), 0, [a - b for a, b in zip(p, y, strict=True)], [a * (1 - a) for a in p])
        out.append(tree)
        raw = [v + plain_walk(tree, xs) for v, xs in zip(raw, x, strict=True)]
    return start, out


def plain_walk(tree, x):
    while isinstance(tree, tuple):
        f, cut, left, right = tree
        tree = right if x[f] > cut else left
    return tree


@pytest.mark.parametrize("seed", range(4))
def test_flat_trees_agree_with_nested_ones(seed):
    r = random.Random(seed)
    x = [[r.randrange(6), r.random() // 0.2, r.randrange(2)] for _ in range(120)]
    y = [float((a > 2) ^ (c == 1) if r.random() < 0.9 else r.random() < 0.5) for a, _, c in x]
    flat = fit(np.array(x, np.float32), np.array(y), trees=6, depth=3, bins=256, rate=0.3, l2=1.0, least=1.0)
    start, nested = plain_fit(np.array(x, np.float32).tolist(), y, 6, 3, 0.3, 1.0, 1.0)
    fresh = [[r.uniform(-1, 7), r.uniform(-1, 6), r.uniform(-1, 2)] for _ in range(300)] + x
    fresh = np.array(fresh, np.float32)
    want = [start + sum(plain_walk(t, v) for t in nested) for v in fresh.tolist()]
    assert np.allclose(flat.raw(fresh), want, rtol=1e-9, atol=1e-9)


def test_rows_learned_from_are_those_with_the_smallest_hash(spark):
    r = random.Random(4)
    data = [(i, [float(r.randrange(9)), float(i)]) for i in range(3000)] + [(5, [1.0, 1.0])] * 1000 + [(None, [0.0, 0.0])]
    rows = spark.createDataFrame(data, "doc_id long, x array<float>").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in range(3000)] + [(5, 1)] * 1000 + [(9, None), (None, 1), (99_999, 1)], "doc_id long, quality int")
    kept = labels.filter("quality IS NOT NULL AND pmod(crc32(cast(cast(doc_id AS string) AS binary)), 3) <> 1").distinct()
    every = rows.distinct().join(kept, "doc_id").select(F.xxhash64("doc_id", "quality", "x").alias("h"), "x", "quality").orderBy("h").collect()
    for most in (100, 10_000):
        got = classify.chosen(rows, labels, train_rows=most)
        assert [(list(x), y) for x, y in got] == [(list(e.x), e.quality) for e in every[:most]]


def test_scores_of_repeated_and_long_rows(spark):
    long = "plain words of a report. " * 20_000
    docs = spark.createDataFrame([(1, "good text here"), (1, "good text here"), (2, long), (3, long), (None, None), (4, "$$$ ###")], "doc_id long, text string").withColumn("label", F.lit("clash"))
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (4, 0)], "doc_id long, quality int")
    got = [(x.doc_id, x.score) for x in classify.quality_scores(docs, labels).collect()]
    by = dict(got)
    assert len(got) == 6 and by[2] == by[3] and [s for i, s in got if i == 1] == [by[1]] * 2 and all(0 <= s <= 1 for s in by.values())
