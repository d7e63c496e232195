"""Operators whose results plain Python can work out for a whole small table."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lodeweave.llm import classify, lattice, mixing, pii, quality, repeats, simhash, tiling, tokens, warc
from lodeweave.llm.common import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(3)


def model():
    public = pytest.importorskip("public_tokenizers")
    return public.path(tokens.MODEL)


# Token counts


def test_token_counts_agree_with_the_library(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    library, own, r = sentencepiece.SentencePieceProcessor(model_file=model()), tokens.BytePairs(model()), random.Random(1)
    alphabet = "abcdethe   \n\t▁éあ<>s0x 梦🙂 \x00ing日本  ||$%.,"
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 60))) for _ in range(3000)]
    texts += ["", " ", "\n", "▁", "<s> </s> <unk> <0x41>", "ab" * 20000, "x" * 5000, "the end. " * 300]
    assert [own.count(t) for t in texts] == [len(library.encode(t)) for t in texts]
    df = frame(spark, [(1, None, "a"), (2, "", "b"), (3, "the cat", "c"), (3, "the cat", "c")], "doc_id long, text string, n_tokens string")
    got = sorted(map(tuple, tokens.token_counts(df, model(), over=1).collect()))
    assert got == [(1, 0, 0, False), (2, 0, 0, False), (3, 7, 2, True), (3, 7, 2, True)]
    assert tokens.token_counts(df.filter("false"), model()).count() == 0


# Quality rules


def line_key(line):
    return " ".join(w.translate(LOWER) for w in WORD.findall(line))


def plain_quality(docs, share, least):
    base, lines_of, hosts = {}, Counter(), Counter()
    for i, text, host in docs:
        text = text or ""
        words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
        seen, again = set(), 0
        for x in lines:
            again += x in seen
            seen.add(x)
        grams = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        hit = {k + j for k in range(len(words) - 4) if grams[tuple(words[k : k + 5])] > 1 for j in range(5)}
        base[i] = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(hit))
        hosts[host] += 1
        lines_of.update((host, k) for k in {line_key(x) for x in lines})
    bad = {k for k, n in lines_of.items() if n > least and n > share * hosts[k[0]]}
    out = {}
    for i, text, host in docs:
        n, *_, twice = base[i]
        gone = sum(len(line_key(x).split(" ")) for x in (text or "").split("\n") if (host, line_key(x)) in bad)
        fails = n < 10 or 100 * twice > 20 * n
        out[i] = (*base[i], n - gone, fails, not fails and not (gone and (n - gone < 10 or n - gone < 0.2 * n)))
    return out, bad


def quality_docs():
    r = random.Random(3)
    parts = ["a", "b", "é ", " ", "\n", "\n\n", "a b c d e f\n", "#", "<x>", "\t", "\x0b", " ", "A B C\n"]
    return [(i, None if r.random() < 0.05 else "".join(r.choice(parts) for _ in range(r.randint(0, 40))), r.choice(["x", "y", None])) for i in range(300)]


@pytest.mark.parametrize("sent", [quality.MOST_SENT, 0])
def test_quality_rules(spark, sent):
    docs = quality_docs()
    want, bad = plain_quality(docs, 0.1, 3)
    df = frame(spark, docs, "doc_id long, text string, source string").withColumn("kept", F.lit("clash"))
    got = {r[0]: tuple(r)[1:] for r in quality.quality_rules(df, share=0.1, least=3, most_sent=sent).collect()}
    assert bad and got == want


def test_quality_filter_cuts_lines(spark):
    docs = quality_docs()
    want, bad = plain_quality(docs, 0.1, 3)
    df = frame(spark, docs, "doc_id long, text string, source string")
    kept = {r[0]: r[1] for r in quality.filtered(df, share=0.1, least=3).collect()}
    assert set(kept) == {i for i, x in want.items() if x[-1]}
    for i, text, host in docs:
        if i in kept:
            assert [x for x in kept[i].split("\n") if WORD.search(x)] == [x for x in text.split("\n") if WORD.search(x) and (host, line_key(x)) not in bad]
    assert quality.filtered(df.filter("false")).count() == 0 and quality.quality_rules(df.filter("false")).count() == 0


def test_copies_of_a_third_of_a_host_stay(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = [(i, text if i < 30 else " ".join(f"v{i}x{j}" for j in range(30)), "h") for i in range(90)]
    assert quality.quality_rules(frame(spark, docs, "doc_id long, text string, source string")).filter("kept").count() == 90


# Personal data


def plain_spans(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(d := re.sub(r"\D", "", m[0])) <= 19 and pii.luhn(d)]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub(r"\D", "", m[0])) <= 15]


def test_base_spans_agree_with_patterns():
    r = random.Random(5)
    for _ in range(20_000):
        alphabet = r.choice(["a.@-b1_ ", "0123456789 -", "+12 ().-a", "1.2555.3", "0 -1+@a.é"])
        t = "".join(r.choice(alphabet) for _ in range(r.randint(0, 30))) + r.choice(["", " 4111 1111 1111 1111", "-4111111111111111a"])
        base, every = pii.spans_of(t)
        assert base == plain_spans(t) and set(base) <= set(every), t


def test_personal_data(spark):
    t = "mailto:jo@x.org http://bob:pw@h.example joe (at) mail (dot) com IBAN: DE89 3704 0044 0532 0130 00, SSN 123-45-6789 end"
    df = frame(spark, [(1, t, "x"), (2, None, "x"), (3, "", "x"), (None, "a@b.c", "x")], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in pii.personal_data(df).collect()}
    assert got[1].n_email == 2 and "iban:70:97" in got[1].spans and "ssn:" in got[1].spans
    assert got[2].base_sha256 == got[3].base_sha256 == hashlib.sha256(b"").hexdigest() and got[2].spans == ""
    assert got[None].base_sha256 == hashlib.sha256(b"email:0:5").hexdigest()
    clean = {r.doc_id: r.text for r in pii.redacted(df).collect()}
    assert clean[1] == "mailto:[EMAIL] http://[USER] [MAIL2] IBAN: [IBAN], SSN [SSN] end" and clean[2] is None
    assert pii.personal_data(df.filter("false")).count() == 0
    bad = "IBAN: DE89 3704 0044 0532 0130 01, SSN 000-45-6789, 4111 1111 1111 1112"
    assert pii.spans_of(bad) == ([], []) and pii.mask(bad) == bad


# Repeated passages


def plain_repeats(rows, length):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda x: x[0]):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if b[p : p + length] in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(b[p : p + length])
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out[i] = (len(b), sum(gone), sum(1 for j in range(len(gone)) if gone[j] and not (j and gone[j - 1])), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [64, 2])
def test_repeated_spans(spark, hot):
    r = random.Random(2)
    passages = ["".join(r.choice("abcd é") for _ in range(r.randint(10, 60))) for _ in range(30)]
    rows = []
    for i in range(200):
        t = "".join(r.choice([r.choice(passages), "".join(r.choice("abc") for _ in range(r.randint(0, 30))), "a" * r.randint(0, 30), "ab" * r.randint(0, 15)]) for _ in range(r.randint(0, 8)))
        rows += [(i * 3, None if r.random() < 0.03 else t)] + [(i * 3 + 1, t)] * (r.random() < 0.1)
    found = repeats.repeated_spans(frame(spark, rows, "doc_id long, text string"), 20, 10, block=3000, bucket=8000, hot=hot)
    got = {x.doc_id: (x.n_bytes, x.n_removed, len(x.spans), x.kept_sha256) for x in found.collect()}
    assert got == plain_repeats(rows, 20)


def test_repeated_spans_of_odd_rows(spark):
    df = frame(spark, [(1, None), (2, "x" * 150), (2, "x" * 150), (None, "x" * 150), (4, "")], "doc_id long, text string").withColumn("spans", F.lit(1))
    got = sorted((x.doc_id or 99, x.n_bytes, x.n_removed) for x in repeats.repeated_spans(df).collect())
    assert got == [(1, 0, 0), (2, 150, 149), (2, 150, 149), (4, 0, 0), (99, 150, 150)]
    assert repeats.repeated_spans(df.filter("false")).count() == 0


def test_suffix_arrays():
    from lodeweave.llm.suffixes import common_prefixes, suffix_array, words_at

    r = random.Random(2)
    for _ in range(100):
        raw = bytes(r.choice(b"abcdefgh\xff") for _ in range(r.randint(1, 300)))
        text = np.frombuffer(raw, np.uint8)
        order = suffix_array(text)
        padded = [(raw + b"\0" * 200)[i : i + 104] for i in order]
        assert sorted(order.tolist()) == list(range(len(raw))) and padded == sorted(padded)
        prefix = common_prefixes(order, words_at(text), 100)
        for k in range(1, len(order)):
            a, b = padded[k - 1], padded[k]
            assert prefix[k] == next((j for j in range(100) if a[j] != b[j]), 100)


# SimHash


def plain_fingerprint(text, size=4):
    words = [w.encode() for w in WORD.findall((text or "").translate(LOWER))]
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + size]), 42) for i in range(len(words) - size + 1)] or [xxhash.xxh64_intdigest(b" ".join(words), 42)]
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))


def plain_components(rows):
    f = [plain_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (f[i] ^ f[j]).bit_count() <= 4:
                parent[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), k), k)
    return {k: (f[i], least[find(i)]) for i, (k, _) in enumerate(rows)}


def test_near_duplicates(spark):
    r = random.Random(7)
    rows = []
    for i in range(60):
        words = [r.choice("abcdefghijklmnop") + str(r.randrange(50)) for _ in range(r.choice([0, 1, 3, 4, 60]))]
        rows.append((100 + 2 * i, r.choice([" ", "\n", "\x0b"]).join(words)))
        if r.random() < 0.4 and words:
            words[r.randrange(len(words))] = "Z"
            rows.append((2 * i + 1, " ".join(words).upper()))
    rows += [(9001, None), (9002, "É é " * 30)]
    df = frame(spark, rows, "doc_id long, text string").withColumn("fp", F.lit("clash"))
    got = {x.doc_id: (x.fp % 2**64, x.component_id) for x in simhash.near_duplicates(df).collect()}
    want = plain_components(rows)
    assert got == want
    assert {x.doc_id for x in simhash.deduplicated(df).collect()} == {c for _, c in want.values()}


def test_tiles_lose_no_pair(spark):
    rng = np.random.default_rng(1)
    f = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    g = np.concatenate([f, f ^ np.uint64(0b1011), f ^ np.uint64(0xF << 40), f ^ np.uint64(0x1F << 20)])
    distinct = spark.createDataFrame([(int(x),) for x in g.view(np.int64)], "fp long").distinct()
    for parts in (2, 4, 8):
        from lodeweave.llm.components import components

        roots = {r.node: r.root for r in components(simhash.links(distinct, tile=16, parts=parts)).collect()}
        same = lambda a, b: roots.get(int(a.view(np.int64)), int(a.view(np.int64))) == roots.get(int(b.view(np.int64)), int(b.view(np.int64)))  # noqa: B023, E731
        assert all(same(a, a ^ np.uint64(0b1011)) and same(a, a ^ np.uint64(0xF << 40)) for a in f)
        assert not any(same(a, a ^ np.uint64(0x1F << 20)) for a in f)


def test_near_duplicates_of_odd_rows(spark):
    df = frame(spark, [(7, "a b c d e"), (7, "a b c d e"), (None, "zz"), (5, None), (3, "")], "doc_id long, text string")
    got = sorted((str(x.doc_id), x.component_id) for x in simhash.near_duplicates(df).collect())
    assert got == [("3", 3), ("5", 3), ("7", 7), ("7", 7), ("None", None)]
    assert sorted(str(x.doc_id) for x in simhash.deduplicated(df).collect()) == ["3", "7", "None"]
    assert simhash.near_duplicates(df.filter("false")).count() == 0


# Decontamination


def plain_tiling(a, b, least):
    marked_a, marked_b, total = [False] * len(a), [False] * len(b), 0
    while True:
        best, at = 0, []
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and not marked_a[i + k] and not marked_b[j + k]:
                    k += 1
                if k >= least and k >= best:
                    at = [*at, (i, j)] if k == best else [(i, j)]
                    best = k
        if not at:
            return total
        for i, j in at:
            if not any(marked_a[i : i + best]) and not any(marked_b[j : j + best]):
                marked_a[i : i + best] = marked_b[j : j + best] = [True] * best
                total += best


@pytest.mark.parametrize("sent", [tiling.SENT, 400])
def test_leaks(spark, sent):
    r = random.Random(4)
    vocabulary = [f"w{i}" for i in range(25)] + ["É", "x1"]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.choice([0, 1, 3, 4, 5, 8, 12, 20, 30])))) for i in range(25)] + [(99, None)]

    def text():
        out = []
        for _ in range(r.randint(0, 4)):
            if r.random() < 0.6:
                t = (r.choice(items)[1] or "").split()
                if len(t) > 12:  # reordered
                    c = r.randint(5, len(t) - 5)
                    t = t[c:] + ["zz"] + t[:c]
                if r.random() < 0.3 and t:
                    t[r.randrange(len(t))] = "Q"
                out += t
            out += [r.choice(vocabulary) for _ in range(r.randint(0, 6))]
        return r.choice([" ", ", ", "\n"]).join(out).upper()

    docs = [(i, None if r.random() < 0.05 else text()) for i in range(120)]
    words = lambda t: re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").encode().lower())
    want = {}
    for i, t in docs:
        best, n = (0.0, None), 0
        for k, x in items:
            a = words(x)
            share = plain_tiling(a, words(t), min(5, len(a))) / len(a) if a else 0
            n += share >= 0.8
            if share >= 0.8 and share > best[0]:
                best = (share, k)
        want[i] = (n > 0, best[1], best[0], n)
    df, bench = frame(spark, docs, "doc_id long, text string").withColumn("item_id", F.lit(1)), frame(spark, items, "item_id long, text string")
    assert {x[0]: tuple(x)[1:] for x in tiling.leaks(df, bench, sent=sent).collect()} == want
    assert {x.doc_id for x in tiling.decontaminated(df, bench, sent=sent).collect()} == {i for i, x in want.items() if not x[0]}
    assert tiling.leaks(df.filter("false"), bench).count() == 0
    assert not tiling.leaks(df, bench.filter("false")).filter("contaminated").count()


# Mixing


def test_mixing(spark):
    r = random.Random(6)
    docs = [(i, None if r.random() < 0.02 else "w " * r.randint(0, 40), r.choice(["a", "b", "big", "big", "big", None, "Z"])) for i in range(400)]
    df = frame(spark, docs, "doc_id long, text string, source string").withColumn("taken", F.lit("clash"))
    rows = mixing.take(df).collect()
    assert sorted(map(str, rows)) == sorted(map(str, mixing.take(df.repartition(7)).collect()))
    size, taken, target = Counter(), Counter(), {}
    for x in rows:
        assert x.size == len(WORD.findall(docs[x.doc_id][1] or "")) and x.taken <= 3 * x.size
        size[x.source] += x.size
        taken[x.source] += x.taken
        target[x.source] = x.target
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    weight, want, total = {s: 1 + k % 3 for k, s in enumerate(names)}, {}, sum(size.values())
    free, left = set(names), total
    while True:  # as the contract says it: share, stop, share again
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] > 3 * size[s]}
        if not over:
            want |= share
            break
        want |= {s: 3.0 * size[s] for s in over}
        left -= sum(3 * size[s] for s in over)
        free -= over
    for s in names:
        assert math.isclose(target[s], want[s]) and taken[s] == math.floor(target[s])
    mixed = mixing.mixed(df)
    assert mixed.columns == df.columns
    words = Counter()
    for x in mixed.collect():
        words[x.source] += len(WORD.findall(x.text or ""))
    assert words == Counter({s: n for s, n in taken.items() if n})
    assert mixing.mixed(df.filter("false")).count() == 0


def test_mixing_repeated_rows(spark):
    df = frame(spark, [(1, "a b c", "x"), (1, "a b c", "x"), (None, None, None), (2, " d  e f\ng h", "y"), (3, "z " * 40, None)], "doc_id long, text string, source string")
    rows = mixing.take(df).collect()
    got = Counter()
    for x in mixing.mixed(df).collect():
        got[x.doc_id] += len(WORD.findall(x.text or ""))
    want = Counter()
    for x in rows:
        want[x.doc_id] += x.taken
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


# Language-model scores


def test_lattice_scores(spark):
    r = random.Random(8)
    rows = [(i, None if r.random() < 0.05 else " ".join(r.choice(["the", "Cat", "sat", "on", "é🙂", "xyzzy" * 3]) for _ in range(r.randint(0, 30)))) for i in range(80)] + [(1000, "▁ a▁b " + "x" * 3000)]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    words = lambda t: [*WORD.findall((t or "").translate(LOWER)), "\n"]
    c = Counter(w for i, t in rows if not held(i) for w in words(t))
    n, v = sum(c.values()), len(c)
    df = frame(spark, rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    got = {x.doc_id: x for x in lattice.lattice_scores(df, model()).collect()}
    for i, t in rows:
        x = got[i]
        assert (x.held_out, x.n_tokens, x.n_known, x.train_tokens) == (held(i), len(words(t)), sum(c[w] > 0 for w in words(t)), n)
        assert math.isclose(x.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words(t)), rel_tol=1e-9)
        assert x.score < 0
    assert lattice.lattice_scores(df.filter("false"), model()).count() == 0


def test_words_are_summed_over_all_segmentations():
    pieces, r = lattice.pieces_at(model()), random.Random(1)
    scores = [math.log(r.random()) for _ in range(pieces.size)]

    def total(t):
        if not t:
            return 1.0
        out = sum(math.exp(scores[pieces.ids[t[:k]]]) * total(t[k:]) for k in range(1, len(t) + 1) if t[:k] in pieces.ids)
        return out if t[0] in pieces.ids else out + math.exp(sum(scores[pieces.byte_ids[b]] for b in t[0].encode())) * total(t[1:])

    for w in ("the", "hello", "thonst", "é🙂a", "1234,"):
        assert math.isclose(math.log(total("▁" + w)), lattice.word_log_probability(w, pieces, scores), rel_tol=1e-9)


# Quality classifier


def test_classifier_on_rows_held_out(spark):
    r = random.Random(9)
    good = lambda: " ".join(r.choice(["the", "report", "says", "that", "rain", "fell"]) for _ in range(r.randint(5, 80))) + "."
    junk = lambda: " ".join(r.choice(["BUY!!", "$$$", "###", "now%%%"]) for _ in range(r.randint(5, 80)))
    truth = {i: int(r.random() < 0.7) for i in range(400)}
    rows = [(i, good() if y else junk()) for i, y in truth.items()] + [(900, None), (901, ""), (None, "x")]
    labels = [(i, y) for i, y in truth.items()] + [(5000, 1), (3, None), (None, 0)]
    df, marked = frame(spark, rows, "doc_id long, text string").withColumn("score", F.lit(1)), frame(spark, labels, "doc_id long, quality int")
    got = classify.quality_scores(df, marked).collect()
    assert len(got) == len(rows) and all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.5) for x in got)
    held = [x for x in got if x.doc_id is not None and x.doc_id < 400 and x.held_out]
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 3 == 1) for x in got if x.doc_id is not None)
    assert np.mean([x.predicted == truth[x.doc_id] for x in held]) > 0.97
    assert len({x.score for x in classify.quality_scores(df, marked.filter("false")).collect()}) == 1
    assert classify.quality_scores(df.filter("false"), marked).count() == 0


# Archives


def test_archives(spark):
    rows = [(5, "u\r\nx", None), (3, None, ""), (9, "é b", "hi\r\n\r\nWARC/1.1\r\n"), (7, "a", "hi\r\n\r\nWARC/1.1\r\n"), (None, "n", ""), (11, "c", "x" * 300_000), (12, "d", "e")]
    df = frame(spark, rows, "page_id long, url string, html string").withColumn("record_type", F.lit("clash"))
    raw, done, twice = (scratch_path(spark, "test") for _ in range(3))
    warc.write_pages(df, raw, most=100)
    assert warc.read_archives(spark, raw).filter("record_type = 'response'").count() == len(rows)
    warc.resolve(spark, raw, done)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    got = {x.page_id: tuple(x)[1:] for x in warc.read_archives(spark, done).select(columns).collect()}
    first: dict[bytes, int] = {}
    for page, _, html in rows:
        if page is not None:
            first[(html or "").encode()] = min(first.get((html or "").encode(), page), page)
    for page, _, html in rows:
        b = (html or "").encode()
        sha = base64.b32encode(hashlib.sha1(b).digest()).decode()
        assert got[page] == ((len(b), sha, "response", None) if first[b] == page else (len(b), sha, "revisit", first[b]))
    warc.resolve(spark, done, twice)  # revisits stay revisits
    assert {x.page_id: tuple(x)[1:] for x in warc.read_archives(spark, twice).select(columns).collect()} == got
    payload = [warc.payload_of(warc.parsed(__import__("gzip").decompress(x.member))[1]) for x in warc.read_archives(spark, done, True).filter("page_id = 11").collect()]
    assert payload == [b"x" * 300_000]
    none = scratch_path(spark, "test")
    warc.write_pages(df.filter("false"), none)
    warc.resolve(spark, none, none + "x")
    assert warc.read_archives(spark, none + "x").count() == 0
