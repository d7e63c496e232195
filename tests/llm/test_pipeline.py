"""The pipeline against one made of the plain versions of its stages."""

from __future__ import annotations

import re
from collections import Counter

import pytest

from lodeweave.llm import mixing, pii
from tests.llm.test_tables import plain_components, plain_quality, plain_tiling

SF = "/root/testdata/sf0.001"


def words(t):
    return re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").encode().lower())


def test_pipeline(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    bench = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    verdict, _ = plain_quality([(r.doc_id, r.text, r.source) for r in rows.values()], 0.4, 20)
    kept = sorted(i for i, x in verdict.items() if x[-1])
    component = plain_components([(i, rows[i].text) for i in kept])
    kept = [i for i in kept if component[i][1] == i]
    grams = lambda w: {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    leaky = set()
    for i in kept:
        own = words(rows[i].text)
        have = grams(own)
        for item in bench:
            if have & grams(item) and plain_tiling(item, own, 5) / len(item) >= 0.8:
                leaky.add(i)
    kept = [i for i in kept if i not in leaky]
    got = pipeline.run(spark, SF)
    assert got.columns == docs.columns
    pool = spark.createDataFrame([(i, pii.mask(rows[i].text), rows[i].source) for i in kept], "doc_id long, text string, source string")
    want = Counter({r.doc_id: r.taken for r in mixing.take(pool).collect() if r.taken})
    found = Counter()
    for r in got.collect():
        found[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    assert {k: v for k, v in found.items() if v} == dict(want)
    assert leaky and len(kept) < len(rows)


def test_entry_lists_all_eleven():
    import __spark_entry__ as entry

    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)
