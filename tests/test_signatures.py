"""Signatures against a plain version, and the band join against all pairs."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from lodeweave.functions import minhash as M
from lodeweave.operators import dedup as D


def plain(text: str, mode: str) -> list[int]:
    shingles = {text} if len(text) < M.SHINGLE else {text[i : i + M.SHINGLE] for i in range(len(text) - M.SHINGLE + 1)}
    if mode == "md5":
        hashes = [int(hashlib.md5(s.encode()).hexdigest()[:15], 16) % M.MERSENNE for s in shingles]
    else:
        hashes = [int.from_bytes(hashlib.blake2b(s.encode(), digest_size=8).digest(), "big") % M.MERSENNE for s in shingles]
    return [min((a * h + b) % M.MERSENNE for h in hashes) for a, b in M.planes()]


@pytest.mark.parametrize("mode", ["md5", "blake2b"])
@pytest.mark.parametrize("piece", [5, 6, 37, 1 << 18])
def test_signatures(mode, piece, monkeypatch):
    monkeypatch.setattr(M, "PIECE", piece)
    r = random.Random(3)
    texts = ["", "a", "abcd", "abcde", "abcde", "aaaaaaaaaa", None, "\U0001f600" * 7 + "é", "漢字かな交じり文の例です"]
    texts += ["".join(r.choice("ab cé\U0001f600") for _ in range(r.randint(0, 90))) for _ in range(40)]
    signer = M.Signer(mode)
    for some in (texts, texts[20:], texts[:9], [], [None]):  # the table is used again, and starts anew where it is small
        assert [None if x is None else x.tolist() for x in signer(some)] == [None if t is None else plain(t, mode) for t in some]


def test_signatures_of_many_letters():
    text = "".join(map(chr, range(0x4E00, 0x9E00))) * 2 + "end"
    assert M.Signer("blake2b")([text])[0].tolist() == plain(text, "blake2b")


def _signed(spark, n: int, seed: int):
    """Rows whose signatures share many bands: groups of near copies, and a third of all rows with the same first bands."""
    r = np.random.RandomState(seed)
    rows, base = [], r.randint(0, 1 << 30, 64)
    for i in range(n):
        sig = r.randint(0, 1 << 30, 64)
        if i % 3 == 0:
            sig[:32] = base[:32]
        elif rows and i % 3 == 1:
            sig = np.array(rows[r.randint(len(rows))][2])
            sig[r.permutation(64)[: r.randint(0, 14)]] = 7
        rows.append((i, ["", "x"][i % 7 == 0], sig.tolist()))
    return rows, spark.createDataFrame(rows, "k long, dedup_images string, dedup_sig array<int>")


@pytest.mark.parametrize("threshold", [0.76, 0.85, 0.95, 1.0])
def test_band_pairs_lose_none(spark, threshold):
    rows, df = _signed(spark, 150, 5)
    near = lambda x, y: sum(p == q for p, q in zip(x[2], y[2], strict=True)) / 64
    every = {(x[0], y[0]): near(x, y) for x in rows for y in rows if x[1] == y[1]}
    want = {k: v for k, v in every.items() if v >= threshold}
    got = D.band_pairs(df, df, threshold).collect()
    assert {(p.a, p.b): p.est for p in got} == {k: v for k, v in want.items() if k[0] < k[1]} and len(got) == len({(p.a, p.b) for p in got})
    half = df.filter("k % 2 = 0")
    both = {(p.a, p.b): p.est for p in D.band_pairs(half, df.filter("k < 60"), threshold, ordered=False).collect()}
    assert both == {k: v for k, v in want.items() if k[0] % 2 == 0 and k[1] < 60}


def test_band_pairs_of_repeated_ids(spark):
    rows, df = _signed(spark, 40, 6)
    odd = df.selectExpr("k div 2 AS k", "dedup_images", "dedup_sig").union(df.selectExpr("k div 2 AS k", "dedup_images", "dedup_sig"))
    got = {(p.a, p.b) for p in D.band_pairs(odd, df, 0.85, ordered=False).collect()}
    want = {(x[0] // 2, y[0]) for x in rows for y in rows if x[1] == y[1] and sum(p == q for p, q in zip(x[2], y[2], strict=True)) >= 55}
    assert got == want


def test_reasons_of_equal_signatures(spark):
    # one set of shingles, four texts: only the first of them stays, and a copy of a later one goes for the same reason
    loop = "abcdef" * 4
    texts = [loop, loop + "abcdef", loop + "abc", loop * 2, loop + "abc", loop, "something else altogether", None]
    df = spark.createDataFrame(list(enumerate(texts)), "_seq long, text string")
    got = {x._seq: x.reason for x in D.dedup_reasons(df).collect()}
    assert got == {0: None, 1: "near_duplicate", 2: "near_duplicate", 3: "near_duplicate", 4: "near_duplicate", 5: "duplicate_prompt", 6: None}


@pytest.mark.parametrize("spread", [6, 12, 20])
def test_first_of_large_groups(spark, spread):
    """Groups of near copies make no square of pairs, and chains through them end as in a pass row by row."""
    r = np.random.RandomState(spread)
    bases, rows = r.randint(0, 1 << 30, (3, 64)), []
    for i in range(240):
        sig = bases[min(i % 5, 2)].copy()
        sig[r.permutation(64)[: r.randint(0, spread)]] = r.randint(0, 1 << 30)
        rows.append((int(1000 - 3 * i if i % 2 else i), "", sig.tolist()))
    rows.sort()
    kept: dict[int, list] = {}
    for k, _, sig in rows:
        if all(sum(p == q for p, q in zip(sig, other, strict=True)) < 55 for other in kept.values()):
            kept[k] = sig
    got = D.first_of(spark.createDataFrame(rows, "k long, dedup_images string, dedup_sig array<int>")).collect()
    assert sorted(x.k for x in got) == [k for k, _, _ in rows] and {x.k for x in got if x.kept} == set(kept)
