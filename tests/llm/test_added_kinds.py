"""What the method adds to the base kinds: recall over planted spans, clean texts untouched, odd rows."""

from __future__ import annotations

import random

import pytest

from lodeweave.llm import pii
from tests.llm.test_tables import frame

PROSE = ["the token of their thanks was kept secret", "she paid on account and the password is long forgotten", "routing tables and api key holders met", "a bearer of news arrived", "item 12 of 300 was sold", "sk-learn is fun", "tokens and secrets: none were told here"]


def code(r, n, alphabet="abcdefghijklmnopqrstuvwxyz0123456789"):
    return "".join(r.choice(alphabet) for _ in range(n - 2)) + "7a"


def iban(r):
    rest = "".join(r.choice("0123456789") for _ in range(18))
    check = 98 - int(rest + "131400") % 97
    return f"DE{check:02d}{rest}"


def planted(r):
    """(text before, the secret, text behind) by kind."""
    hexes, digits = "0123456789abcdef", "0123456789"
    return {
        "key": r.choice([
            ('token = "', code(r, 40, hexes), '"'), ("TOKEN: ", code(r, 40, hexes).upper(), ""), ("Authorization: Bearer ", code(r, 30), " end"), ('"api_key": "', code(r, 24), '",'), ("secret=", code(r, 20), "\n"),
            ("password: ", code(r, 10), ", then"), ("passwd = '", "correct!horse", "'"), ("use ", "AKIA" + code(r, 16).upper(), " now"), ("use ", "ghp_" + code(r, 36), "."), ("the access key is ", code(r, 20), ". So"),
        ]),
        "account": r.choice([("account number: ", code(r, 9, digits)[:-1] + "0", ", please"), ("Acct no. ", "12-3456-7890", " was"), ("Konto ", "0532013000", " bei"), ("routing # ", "021000021", "")]),
        "tel": ("call ", "+1 (826) 555-" + "".join(r.choice(digits) for _ in range(4)), f" 10{r.randrange(10)}.1{r.randrange(10)}.20{r.randrange(6)}.17"),
        "iban": ("IBAN: ", iban(r), " BIC"),
        "ssn": ("SSN is ", f"{r.randrange(100, 600)}-45-{r.randrange(1000, 9999)}", "."),
        "mail2": ("write to ", f"jo{r.randrange(99)} (at) mail (dot) org", " soon"),
        "user": ("see http://", f"bob{r.randrange(99)}:pw{r.randrange(99)}", "@host.example/x"),
    }


def test_planted_spans_are_found():
    r, found, made, leaked = random.Random(21), 0, 0, 0
    for _ in range(400):
        kinds = planted(r)
        for kind in r.sample(sorted(kinds), 3):
            before, value, behind = kinds[kind]
            lead = " ".join(r.choice(PROSE) for _ in range(2)) + " "
            text = f"{lead}{before}{value}{behind} {r.choice(PROSE)}"
            at = len(lead + before)
            made += 1
            found += any(s <= at and e >= at + len(value) for _, s, e in pii.spans_of(text)[1])
            leaked += value in pii.mask(text)
            base, every = pii.spans_of(text)
            assert set(base) <= set(every) and all(k in pii.BASE_KINDS for k, _, _ in base)
    assert found / made >= 0.98 and leaked / made <= 0.02


def test_clean_prose_is_left_alone():
    r = random.Random(22)
    for _ in range(300):
        text = r.choice([" ", "\n", ". "]).join(r.choice(PROSE) for _ in range(r.randint(1, 20)))
        assert pii.mask(text) == text and pii.spans_of(text) == ([], [])
    for text in ("token = abc", "token: aaaaaaaaaaaaaaaaaaaaaaaaa", "secret = 1234567890123456789012", "account 12", "AKIA1", "+1 2 3", "account 1234567.89"):
        assert not [k for k, _, _ in pii.spans_of(text)[1] if k in ("key", "account", "tel")], text


@pytest.mark.parametrize("text", ["token =", "password: '", "bearer ", "account number:", "AKIA", "+", "+1", "iban", "token = \"" + "a1" * 100_000 + '"', "+1 " * 20_000])
def test_anchors_at_the_end_and_long_runs(text):
    pii.mask(text)


def test_repeated_and_long_rows(spark):
    secret = "f" * 5 + "0123456789abcdef" * 2 + "abc"
    long = "word " * 100_000 + f'token = "{secret}"' + " word" * 100_000
    df = frame(spark, [(1, long, "s"), (1, long, "s"), (None, "x", None), (None, "x", None)], "doc_id long, text string, source string")
    got = pii.personal_data(df).collect()
    assert sorted(x.spans for x in got) == ["", "", f"key:{500_009}:{500_009 + len(secret)}", f"key:{500_009}:{500_009 + len(secret)}"]
    clean = [x.text for x in pii.redacted(df).collect()]
    assert len(clean) == 4 and not any(secret in t for t in clean) and sum("[KEY]" in t for t in clean) == 2
