"""Column functions on texts, against small literals and plain Python."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from lodeweave import schema as S
from lodeweave.functions import minhash as H
from lodeweave.functions import text as T


def ev(spark, column, **values):
    """A column's value over one row of texts."""
    row = spark.range(1)
    for k, v in values.items():
        row = row.withColumn(k, F.lit(v))
    return row.select(column.alias("x")).first()[0]


@pytest.mark.parametrize(("given", "want"), [("  The QUICK \n fox　", "the quick fox"), ("", ""), ("a\tb", "a b")])
def test_normalise(spark, given, want):
    assert ev(spark, T.normalise("x"), x=given) == want
    assert ev(spark, T.text_key("x"), x=given) == hashlib.sha256(want.encode()).hexdigest()


def test_row_key_holds_images(spark):
    key = T.row_key("x", F.array(F.lit("b"), F.lit("a")))
    assert ev(spark, key, x="Hi") == hashlib.sha256(b"hi").hexdigest() + "|a,b"


@pytest.mark.parametrize(("given", "tokens", "want"), [("  ", 9, "empty_prompt"), ("hi", 3, "prompt_too_short"), ("hi", 8193, "prompt_too_long"), ("мама", 9, "non_english"), ("alpha α → beta", 9, None)])
def test_prompt_reasons(spark, given, tokens, want):
    assert ev(spark, T.prompt_reject_reason("x", F.lit(tokens)), x=given) == want


@pytest.mark.parametrize(("given", "tokens", "want"), [("", 99, "empty_assistant"), ("<think>a", 99, "unbalanced_think_tags"), ("ok", 15, "too_short"), ("ok", 16385, "too_long"), ("<think>a</think>b", 99, None)])
def test_response_reasons(spark, given, tokens, want):
    assert ev(spark, T.response_reject_reason("x", F.lit(tokens)), x=given) == want


def test_repeat_ratio(spark):
    assert ev(spark, T.repeat_ratio("x"), x="a b c") == 0
    words = ("w " * 40).split()
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    assert ev(spark, T.repeat_ratio("x"), x=" ".join(words)) == pytest.approx(1 - len(set(grams)) / len(grams))


@pytest.mark.parametrize(("given", "declared", "want"), [("Solve and refactor", "mixed", "reasoning"), ("please refactor it", "mixed", "coding"), ("hello", "mixed", "mixed"), ("solve", "roleplay", "roleplay")])
def test_domains(spark, given, declared, want):
    assert ev(spark, T.assign_domain("x", "d"), x=given, d=declared) == want


@pytest.mark.parametrize(("completion", "gold", "want"), [
    ("<think>7</think>so \\boxed{1,260}.", "1260", True), ("Sum\n#### 5.", "5", True), ("He made **$126** from it.", "126", True),
    ("He made 125.", "126", False), ("yes", "Yes.", True), ("12\\%", "12%", True), ("text", "", False),
])
def test_answers(spark, completion, gold, want):
    assert ev(spark, T.check_answer("c", "g"), c=completion, g=gold) is want


def test_extracted_parts(spark):
    code = "x\n```python\ndef a():\n  pass\n```\n```\ndef b(q):\n  return 1\n```\n```\nb(2)\n```"
    assert ev(spark, T.extract_code("x"), x=code).startswith("def a")
    assert ev(spark, T.extract_code("x", F.lit("b")), x=code).startswith("def b")
    assert ev(spark, T.extract_code("x"), x="<think>t</think> y = 1") == "y = 1"
    assert ev(spark, T.signature("x"), x="import q\ndef  sub( a,\n b, ):\n  pass").rendered == "sub(a, b)"
    assert ev(spark, T.signature("x"), x="none") is None
    assert ev(spark, T.blocks_of("x", "t"), x="a<t> b </t>c<t>d") == ["b", "d"]
    assert ev(spark, T.first_line("x"), x=" one \ntwo") == "one"
    assert ev(spark, T.final_number("x"), x="1,234 and -5.5 left") == "-5.5"
    assert ev(spark, T.clean_markup("x"), x=" Hello<|im_end|> ") == "Hello"
    assert ev(spark, T.pad_to("x", "ab", 5), x="xyz") == "xyz" + "ab" * 9
    assert ev(spark, T.contains_text("x", T.haystack(F.lit("N"), "f", 4, 0.5)), x="ffNff")
    assert ev(spark, T.fold_reasoning("c", "r"), c="ok", r=" why ") == "<think>\nwhy\n</think>\n\nok"
    assert ev(spark, T.seed_number("x"), x="0000000a" + "f" * 56) == 10


def test_greetings(spark):
    assert all(ev(spark, T.is_greeting("x"), x=g.upper() + "!.") for g in S.GREETINGS)
    assert not ev(spark, T.is_greeting("x"), x="hi, solve this")


def test_minhash_modes(spark):
    a = "The quick brown fox jumps over the lazy dog, again and again."
    rows = spark.createDataFrame([(1, a), (2, a.upper().replace("JUMPS", "JUMPS  ")), (3, "Completely unrelated content about tides."), (4, "abc"), (5, None)], "i int, t string")
    signed = {r.i: r for r in rows.select("i", H.signature("t").alias("u"), H.native_signature(F.col("t")).alias("n"), H.signature("t", "blake2b").alias("b")).collect()}
    assert all(signed[i].u == signed[i].n for i in (1, 2, 3, 4)) and signed[5].u is None
    assert signed[1].u == signed[2].u and signed[1].b == signed[2].b != signed[1].u
    x = [int.from_bytes(hashlib.blake2b(b"abc", digest_size=8).digest(), "big")]
    assert signed[4].b == [min((p * v + q) % H.MERSENNE for v in x) for p, q in H.planes()]
    est = spark.createDataFrame([([1] * 64, [1] * 60 + [2] * 4), ([], [])], "a array<int>, b array<int>").select(H.estimate(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in est] == [60 / 64, 0]
