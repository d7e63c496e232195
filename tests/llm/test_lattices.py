"""Lattice scores end to end against a plain version: Zipf weights of the ranks, expected counts, forward sums."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lodeweave.llm import lattice
from tests.llm.test_tables import frame, model

WORD, LOWER = re.compile(r"[^\x20\x09-\x0D]+"), {i: i + 32 for i in range(65, 91)}


def plain_paths(text, pieces):
    """All segmentations of a text, as lists of pieces."""
    if not text:
        yield []
    for k in range(1, len(text) + 1):
        if text[:k] in pieces.ids or k == 1:
            head = [pieces.ids[text[:k]]] if text[:k] in pieces.ids else [pieces.byte_ids[b] for b in text[0].encode()]
            for rest in plain_paths(text[k:], pieces):
                yield head + rest


def plain_scores(rows, pieces):
    import sentencepiece

    ranks = sentencepiece.SentencePieceProcessor(model_file=model())
    weight = {i: 1 / (1 - ranks.get_score(i)) for i in pieces.ids.values()} | {i: 1 / (pieces.size + 1) for i in pieces.byte_ids.values()}
    whole = sum(weight.values()) + 1 / (pieces.size + 1)  # and the end
    words = lambda t: WORD.findall((t or "").translate(LOWER))
    train = [t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    count = Counter(w for t in train for w in words(t))
    paths = {w: list(plain_paths("▁" + w.replace("▁", "�"), pieces)) for w in {w for _, t in rows for w in words(t)}}
    expected = Counter({pieces.end: len(train)})
    for w, c in count.items():
        p = [math.prod(weight[x] / whole for x in path) for path in paths[w]]
        for path, q in zip(paths[w], p, strict=True):
            for x in path:
                expected[x] += c * q / sum(p)
    total = sum(expected.values()) + pieces.known()
    log10 = lambda w: math.log10(sum(math.prod((expected[x] + 1) / total for x in path) for path in paths[w]))
    return [(i, sum(map(log10, words(t))) + math.log10((expected[pieces.end] + 1) / total)) for i, t in rows]


def test_scores_agree_with_all_segmentations(spark):
    r, pieces = random.Random(3), lattice.pieces_at(model())
    vocabulary = ["the", "Cat", "sat", "é🙂", "xyzzy", "▁", "a▁b", "1,000", "thonst", "日本", "Ünd", "ing's"]
    rows = [(i, None if r.random() < 0.05 else r.choice([" ", "\n", "\x0b"]).join(r.choice(vocabulary) for _ in range(r.randint(0, 25)))) for i in range(120)]
    rows += [(7, "the cat"), (7, "the cat"), (None, "sat")]
    got = sorted(((x.doc_id is None, x.doc_id or 0, x.score) for x in lattice.lattice_scores(frame(spark, rows, "doc_id long, text string"), model()).collect()))
    want = sorted((i is None, i or 0, s) for i, s in plain_scores([("" if i is None else i, t) for i, t in rows], pieces) for i in [None if i == "" else i])
    assert [x[:2] for x in got] == [x[:2] for x in want] and np.allclose([x[2] for x in got], [x[2] for x in want], rtol=2e-6)


def test_words_together_are_as_words_alone():
    r, pieces = random.Random(4), lattice.pieces_at(model())
    scores = np.log(np.array([r.random() for _ in range(pieces.size)]))
    words = ["".join(r.choice("abcdethingsonéß🙂�日,1") for _ in range(r.choice([1, 2, 3, 5, 8, 13, 30, 62, 63, 64, 80]))) for _ in range(400)] + ["a", "▁", "\x00", "x" * 3000]
    together = lattice.log_probabilities(words, pieces, scores)
    assert np.allclose(together, [lattice.word_log_probability(w, pieces, scores) for w in words], rtol=1e-9)
    times = np.array([r.randrange(1, 1000) for _ in words])
    total, alone = lattice.expected_counts(words, times, pieces, scores), np.zeros(pieces.size)
    for w, n in zip(words, times.tolist(), strict=True):
        lattice._expected_one(lattice._marked(w), n, pieces, scores, alone)
    assert np.abs(total - alone).max() <= 2 + 1e-9 * alone.max() and not lattice.expected_counts([], times[:0], pieces, scores).any()


@pytest.mark.parametrize("lot", [["the"], ["the", "thing", "a"]])
def test_expected_counts_are_of_all_segmentations(lot):
    pieces = lattice.pieces_at(model())
    got, want = lattice.expected_counts(lot, np.full(len(lot), 3), pieces, pieces.first) / lattice.FIXED, np.zeros(pieces.size)
    for w in lot:
        paths = list(plain_paths("▁" + w, pieces))
        p = np.array([math.exp(sum(pieces.first[x] for x in path)) for path in paths])
        for path, q in zip(paths, p / p.sum(), strict=True):
            for x in path:
                want[x] += 3 * q
    assert np.allclose(got, want, atol=1e-3)


def test_long_texts(spark):
    long = "the cat " * 60_000
    got = {x.doc_id: x for x in lattice.lattice_scores(frame(spark, [(1, long), (2, long), (3, "the cat"), (4, "")], "doc_id long, text string"), model()).collect()}
    assert got[1].score == got[2].score and got[1].n_tokens == 120_001
    assert math.isclose(got[1].score - got[4].score, 60_000 * (got[3].score - got[4].score), rel_tol=1e-9)
