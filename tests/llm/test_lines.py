"""The line rule at the limits of the query: boilerplate is cut, documents made of it go, copies count once."""

from __future__ import annotations

import random

import pytest

from lodeweave.llm import quality
from tests.llm.test_tables import frame

LIMITS = {"share": quality.TEXTS_SHARE, "least": quality.TEXTS_DOCS, "distinct": True}


def planted():
    """300 rows of a host of fresh texts, a third of them copies of one, 20 with a footer, two made of the footer."""
    r = random.Random(12)
    fresh = lambda n: " ".join(f"w{r.randrange(10**9)}" for _ in range(n))
    footer, copy = "all rights are reserved by the owner of this very page and by nobody else", fresh(15) + "\n" + fresh(15)
    rows = [(i, copy, "h") for i in range(100)]
    rows += [(100 + i, fresh(30) + ("\n" + footer.upper() if i < 20 else ""), "h") for i in range(198)]
    rows += [(900, footer + "\n" + fresh(4), "h"), (901, footer + "\n" + fresh(9), "h")]
    return rows + [(950, footer + "\n" + fresh(4), "other"), (None, fresh(20), None), (960, fresh(20), None), (960, None, None)]


@pytest.mark.parametrize("sent", [quality.MOST_SENT, 0])
def test_boilerplate_goes_and_copies_stay(spark, sent):
    rows = planted()
    got = {r.doc_id: r for r in quality.quality_rules(frame(spark, rows, "doc_id long, text string, source string"), most_sent=sent, **LIMITS).collect() if r.doc_id != 960}
    assert {i for i, r in got.items() if not r.kept and not r.base_failed} == {900, 901}  # the footer's documents, not that of the other host
    assert all(got[i].kept and got[i].n_left == 30 for i in range(100))  # copies of a third of the host: one text
    assert all(got[i].n_left == 30 and got[i].n_words == (45 if i < 120 else 30) for i in range(100, 298))
    assert got[950].kept and got[950].n_left == 19 and got[None].kept


def test_long_and_repeated_rows(spark):
    r = random.Random(5)
    long = "\n".join(" ".join(f"w{r.randrange(10**9)}" for _ in range(20)) for _ in range(20_000))
    rows = [(1, long, "h"), (1, long, "h"), (None, long, "h"), (2, "x " * 200_000, "h")]
    got = quality.quality_rules(frame(spark, rows, "doc_id long, text string, source string"), **LIMITS).collect()
    assert sorted((str(x.doc_id), x.n_words, x.n_left, x.kept) for x in got) == [("1", 400_000, 400_000, True)] * 2 + [("2", 200_000, 200_000, False), ("None", 400_000, 400_000, True)]
    assert quality.quality_rules(frame(spark, rows, "doc_id long, text string, source string").filter("false"), **LIMITS).count() == 0
