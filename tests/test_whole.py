"""Cases in which an operator did less than the whole job before."""

from __future__ import annotations

import random

import pytest

from lodeweave.operators import dedup as D


@pytest.mark.parametrize(("size", "more"), [(300, {}), (20, {"most_left": 0})])
def test_first_wins_settles_long_chains(spark, size, more):
    r = random.Random(size)
    edges = [(i, i + 1) for i in range(size)] + [(a, b) for a, b in ((r.randrange(size), r.randrange(size)) for _ in range(3)) if a < b]
    want = {}
    for b in range(size + 1):
        want[b] = not any(want[a] for a, x in edges if x == b)
    got = D.first_wins(spark.range(size + 1).withColumnRenamed("id", "k"), spark.createDataFrame(edges, "a long, b long"), **more).collect()
    assert len(got) == size + 1 and {x.k: x.kept for x in got} == want
