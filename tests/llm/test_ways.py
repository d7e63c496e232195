"""Two ways to one result, and phrases that very many items and places share."""

from __future__ import annotations

import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodeweave.llm import mixing, tiling
from tests.llm.test_tables import WORD, frame


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_by_cuts_and_by_rows(spark, seed):
    r = random.Random(seed)
    rows = [(r.choice([i, i, i, None]), None if r.random() < 0.05 else r.choice([" ", "\n"]).join(f"w{r.randrange(99)}" for _ in range(r.randint(0, 30))), r.choice(["a", "b", "big", "big", "big", None])) for i in range(300)]
    df = frame(spark, rows, "doc_id long, text string, source string").withColumn("n_chars", F.length("text")).withColumn("key", F.lit("clash"))
    sent, joined = (Counter(map(tuple, mixing.mixed(df, most_sent=n).collect())) for n in (mixing.MOST_SENT, 0))
    assert sent == joined and sent
    want = Counter()
    for x in mixing.take(df).collect():
        want[x.source] += x.taken
    got = Counter()
    for (_, text, source, *_), n in sent.items():
        got[source] += n * len(WORD.findall(text or ""))
    assert got == Counter({k: v for k, v in want.items() if v})


def test_mix_of_long_and_equal_rows(spark):
    long = "x " * 100_000
    df = frame(spark, [(1, long, "a")] * 3 + [(2, "y " * 1000, "b")] * 50 + [(None, None, None)] * 4, "doc_id long, text string, source string")
    want = Counter()
    for x in mixing.take(df).collect():
        want[x.doc_id] += x.taken
    got = Counter()
    for x in mixing.mixed(df).collect():
        got[x.doc_id] += len(WORD.findall(x.text or ""))
    assert +got == +want


def test_stock_phrases_make_no_product():
    phrase = "please answer the question below"
    items = [(i, f"{phrase} number{i} " + " ".join(f"item{i}word{j}" for j in range(20))) for i in range(2000)]
    index = tiling.Index(items, tiling.SEED)
    text = " and ".join([phrase] * 2000) + " " + items[7][1]
    raw = np.frombuffer(text.encode(), np.uint8)
    words, first = tiling.word_hashes(raw, np.array([0, len(raw)]))
    began = time.time()
    row, item, _, _ = index.hits(5, words, first, tiling.COVERAGE)
    assert len(row) < 5000 and set(item.tolist()) == {7} and time.time() - began < 20
    assert tiling._matches(index, raw, np.array([0, len(raw)]), tiling.COVERAGE) == {0: [(7, 1.0)]}


def test_leaks_of_odd_rows(spark):
    item = " ".join(f"w{i}" for i in range(12))
    long = "filler " * 100_000 + item + " filler" * 100_000
    df = frame(spark, [(None, item), (None, "x"), (1, long), (1, long), (2, item.upper()), (2, item.upper())], "doc_id long, text string").withColumn("coverage", F.lit("clash"))
    bench = frame(spark, [(5, item), (4, item), (None, item), (6, None)], "item_id long, text string")
    got = sorted((str(x.doc_id), x.contaminated, x.item_id, x.coverage, x.n_items) for x in tiling.leaks(df, bench).collect())
    assert got == [("1", True, 4, 1.0, 3)] * 2 + [("2", True, 4, 1.0, 3)] * 2 + [("None", False, None, 0.0, 0), ("None", True, 4, 1.0, 3)]
    assert [tuple(x) for x in tiling.decontaminated(df, bench).collect()] == [(None, "x", "clash")]
