"""Joins on keys of which some hold a large share of all rows."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from lodeweave.llm import common, simhash
from tests.llm.test_tables import frame, plain_components


@pytest.mark.parametrize("most", [2, 4096, 1 << 40])
def test_join_spread_is_a_join(spark, monkeypatch, most):
    monkeypatch.setattr(common, "MOST_KEYS", most)
    r = random.Random(5)
    left = [(r.choice([0] * 6 + [1] * 3 + list(range(2, 20))), i) for i in range(300)]
    counts = Counter(k for k, _ in left)
    right = [(k, n, f"v{k}") for k, n in counts.items()] + [(99, 0, "none")]
    got = common.join_spread(frame(spark, left, "k long, i long"), frame(spark, right, "k long, n long, v string"), "k", "n", len(left))
    assert sorted(map(tuple, got.select("k", "i", "v").collect())) == sorted((k, i, f"v{k}") for k, i in left)
    assert not common.join_spread(frame(spark, [], "k long, i long"), frame(spark, [], "k long, n long, v string"), "k", "n", 0).count()


@pytest.mark.parametrize("most", [3, 1 << 40])
def test_components_with_crowded_keys(spark, monkeypatch, most):
    monkeypatch.setattr(common, "MOST_KEYS", most)
    r = random.Random(6)
    base = [f"w{r.randrange(10**6)}" for _ in range(300)]
    docs = [(i, "") for i in range(40)] + [(100 + i, " ".join(base)) for i in range(40)] + [(200 + i, " ".join(base[:-1] + [f"z{i}"])) for i in range(20)]
    docs += [(300 + i, " ".join(f"w{r.randrange(10**6)}" for _ in range(30))) for i in range(20)] + [(5, "other words of a repeated id"), (None, None)]
    got = {(x.doc_id, x.fp & (1 << 64) - 1, x.component_id) for x in simhash.near_duplicates(frame(spark, docs, "doc_id long, text string")).collect()}
    known = [d for d in docs if d[0] is not None and d[1] != docs[-2][1]]
    want = plain_components(known)
    assert {x for x in got if x[0] is not None and x[1] != simhash.fingerprint(docs[-2][1])} == {(i, simhash.fingerprint(t), want[i][1]) for i, t in known}
    assert (None, 0, 0) in got and any(x[0] == 5 and x[1] for x in got)
