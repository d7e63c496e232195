"""Cases in which an operator did less than the whole job before."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lodeweave.llm import pii, quality, simhash
from tests.llm.test_tables import frame, quality_docs


def test_pipeline_cuts_boilerplate_but_not_copies(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    r, footer = random.Random(11), "all rights are reserved by the owner of this very page and of all others"
    fresh = lambda n: " ".join(f"w{r.randrange(10**9)}" for _ in range(n))
    copy = fresh(15) + "\n" + fresh(15)
    docs = [(i, copy, "h") for i in range(100)]  # a third of the host: one text
    docs += [(100 + i, fresh(30) + ("\n" + footer.title() if i < 30 else ""), "h") for i in range(200)]
    docs += [(900, footer + "\n" + fresh(3), "h"), (901, footer + "\n" + fresh(3), "few"), (902, None, None)]
    got = {x.doc_id: x.text for x in pipeline.quality_rules(spark, frame(spark, docs, "doc_id long, text string, source string"), "").collect()}
    assert set(got) == {i for i, *_ in docs} - {900, 902}  # 900 is depleted, 902 has no words
    assert all(got[i] == copy for i in range(100)) and got[901] == docs[-2][1]
    assert not [i for i in range(100, 300) if footer.title() in got[i]] and got[100].strip() == docs[100][1].split("\n")[0]


def test_one_row_of_each_component_whatever_the_ids(spark):
    r = random.Random(13)
    a, b, c, d, e = (" ".join(f"w{r.randrange(10**9)}" for _ in range(30)) for _ in range(5))
    docs = [(1, a), (1, b), (None, c), (None, d), (None, None), (2, c.upper()), (3, a), (1, a), (4, e), (5, e), (5, d)]
    got = sorted((str(x.doc_id), x.text) for x in simhash.deduplicated(frame(spark, docs, "doc_id int, text string")).collect())
    assert got == sorted([("1", a), ("1", b), ("2", c.upper()), ("5", d), ("None", None), ("4", e)], key=lambda x: (x[0], str(x[1])))
    apart = [(None, a), (None, b), (None, c), (None, b)]
    assert sorted(x.text for x in simhash.deduplicated(frame(spark, apart, "doc_id long, text string")).collect()) == sorted([a, b, c])


@pytest.mark.parametrize("distinct", [False, True])
def test_lines_too_many_to_send_are_joined(spark, distinct):
    docs = quality_docs()
    length = {i: len(text or "") for i, text, _ in docs}
    df = frame(spark, docs, "doc_id long, text string, source string").withColumn("n_chars", F.length("text"))
    sent, joined = (sorted(map(tuple, quality.filtered(df, share=0.1, least=3, distinct=distinct, **more).collect())) for more in ({}, {"most_sent": 0}))
    assert joined == sent and any(n_chars < length[i] for i, _, _, n_chars in sent)


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("IBAN: DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX", "DE89 3704 0044 0532 0130 00"),
        ("IBAN DE89370400440532013000 EUR 500", "DE89370400440532013000"),
        ("iban no. GB82 WEST 1234 5698 7654 32", "GB82 WEST 1234 5698 7654 32"),
        ("IBAN NO9386011117947 KID 12345678901234567890", "NO9386011117947"),
        ("IBAN DE89370400440532013001 EUR 500", None),
        ("IBAN DE89370400440532013000x", None),
    ],
)
def test_ibans_before_other_capitals(text, found):
    assert [text[a:b] for kind, a, b in pii.spans_of(text)[1] if kind == "iban"] == ([found] if found else [])
    assert ("[IBAN]" in pii.mask(text)) == bool(found) and not (found and found in pii.mask(text))
