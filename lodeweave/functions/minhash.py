"""MinHash signatures of character shingles: 64 slots in 16 bands.

Two hash modes: `blake2b` (8 bytes, big-endian; an Arrow UDF over numpy, whose signatures agree with those of the
published scheme) and `md5` (the first 15 hex digits; the same numbers can be had in SQL). The planes are a constant:
64 pairs from CPython's generator seeded with 1.

At a threshold of 0.85 two signatures differ in at most 9 of 64 slots, so at least 7 of the 16 bands agree: joining on
bands loses no pair. That holds for every threshold above 0.75.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from lodeweave.functions import text as T

SLOTS, BANDS, SHINGLE, THRESHOLD = 64, 16, 5, 0.85
MERSENNE = (1 << 31) - 1
#: Code points that are signed together; the slots of a distinct shingle take 256 bytes, and a table of twice as many is kept.
PIECE = 1 << 18


def planes() -> list[tuple[int, int]]:
    rnd = random.Random(1)
    return [(rnd.randrange(1, MERSENNE), rnd.randrange(1, MERSENNE)) for _ in range(SLOTS)]


def shingles(x: Column, n: int = SHINGLE) -> Column:
    """Distinct shingles of the normal form; a text below n characters is one."""
    def of(t: Column) -> Column:
        return F.when(F.char_length(t) < n, F.array(t)).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(t) - n + 1, F.lit(1))), lambda i: F.substr(t, i, F.lit(n)))))

    return T.let(T.normalise(x), of)


def native_signature(x: Column) -> Column:
    """md5 mode without Python; slower than the UDF, and the measure for it."""
    hashes = F.transform(shingles(x), lambda s: F.conv(F.substring(F.md5(s), 1, 15), 16, 10).cast("long") % MERSENNE)
    pairs = F.array(*[F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b")) for a, b in planes()])
    return T.let(hashes, lambda hs: F.transform(pairs, lambda p: F.array_min(F.transform(hs, lambda h: (p["a"] * h + p["b"]) % MERSENNE)).cast("int")))


def _digest_md5(s: bytes) -> bytes:
    return hashlib.md5(s).digest()[:8]


def _digest_blake2b(s: bytes) -> bytes:
    return hashlib.blake2b(s, digest_size=8).digest()


def _kinds(codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the shingles of code points that start at `at`: the place in `at` of one of each kind, and the kind of each."""
    there = np.zeros(0x110000, bool)
    there[codes] = True
    letters = (np.cumsum(there) - 1)[codes]
    bits = int(letters.max()).bit_length()
    key, width = letters[at], bits
    for i in range(1, SHINGLE):
        if width + bits > 63:  # kinds so far take their numbers, which are few
            key = np.unique(key, return_inverse=True)[1]
            width = len(at).bit_length()
        key, width = (key << bits) | letters[at + i], width + bits
    return np.unique(key, return_index=True, return_inverse=True)[1:]


class Signer:
    """Signatures of normal forms in one hash mode.

    Equal texts of a batch are signed once; the others go through in pieces of PIECE code points, so a long text takes no
    more memory than others. The slot values of a shingle, before minima are taken, are a row of `table`, which later pieces
    look up; the table starts anew when a piece may not fit in it.
    """

    def __init__(self, mode: str):
        self.digest, self.shift = {"md5": (_digest_md5, 4), "blake2b": (_digest_blake2b, 0)}[mode]
        self.a, self.b = (np.array(x, np.uint64) for x in zip(*planes(), strict=True))
        self.known: dict[str, int] = {}
        self.table = np.empty((2 * PIECE, SLOTS), np.int32)

    def places(self, shingles: list[str]) -> np.ndarray:
        """Rows of the table for distinct shingles, no more than PIECE."""
        if len(self.known) + len(shingles) > len(self.table):
            self.known.clear()
        known, at = self.known, len(self.known)
        new = [s for s in shingles if s not in known]
        raw = b"".join(self.digest(s.encode()) for s in new)
        hashes = (np.frombuffer(raw, ">u8").astype(np.uint64) >> np.uint64(self.shift)) % np.uint64(MERSENNE)
        for k in range(0, len(new), 4096):
            part = hashes[k : k + 4096, None]
            self.table[at + k : at + k + len(part)] = (part * self.a + self.b) % np.uint64(MERSENNE)
        known.update(zip(new, range(at, at + len(new)), strict=True))
        return np.fromiter(map(known.__getitem__, shingles), np.int64, len(shingles))

    def __call__(self, texts: list[str | None]) -> list[np.ndarray | None]:
        least = {t: np.full(SLOTS, MERSENNE, np.int32) for t in texts if t is not None}
        short = [t for t in least if len(t) < SHINGLE]
        for k in range(0, len(short), PIECE):
            some = short[k : k + PIECE]
            least.update(zip(some, self.table[self.places(some)], strict=True))
        step = PIECE - SHINGLE + 1
        parts = [(t, at) for t in least if len(t) >= SHINGLE for at in range(0, len(t) - SHINGLE + 1, step)]
        piece, size = [], 0
        for t, at in parts:
            part = t[at : at + PIECE]
            if size + len(part) > PIECE:
                self.piece(piece, least)
                piece, size = [], 0
            piece.append((t, part))
            size += len(part)
        if piece:
            self.piece(piece, least)
        return [None if t is None else least[t] for t in texts]

    def piece(self, parts: list[tuple[str, str]], least: dict[str, np.ndarray]) -> None:
        """Takes the shingles of the parts (text, part of it) into their texts' minima."""
        whole = "".join(part for _, part in parts)
        ends = np.cumsum([len(part) for _, part in parts])
        inside = np.ones(len(whole), bool)
        for back in range(1, SHINGLE):
            inside[ends - back] = False
        at = np.flatnonzero(inside)
        one, kind = _kinds(np.frombuffer(whole.encode("utf-32-le"), np.uint32), at)
        rows = self.places([whole[i : i + SHINGLE] for i in at[one].tolist()])[kind]
        cuts = np.searchsorted(at, np.append(0, ends)).tolist()
        for (t, _), lo, hi in zip(parts, cuts[:-1], cuts[1:], strict=True):
            for k in range(lo, hi, 8192):
                np.minimum(least[t], self.table[rows[k : min(hi, k + 8192)]].min(axis=0), out=least[t])


def signature_udf(mode: str = "md5"):
    """Of normal forms."""

    @F.pandas_udf(Ty.ArrayType(Ty.IntegerType()))
    def signature(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = Signer(mode)
        for batch in batches:
            yield pd.Series(of(batch.tolist()), dtype=object)

    return signature


def signature(x: Column | str, mode: str = "md5") -> Column:
    return signature_udf(mode)(T.normalise(x))


def band_keys(sig: Column, images: Column, n: int = BANDS) -> Column:
    """A key of each band, which the images are part of."""
    width = SLOTS // n
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.xxhash64(k, F.slice(sig, k * width + 1, width), images))


def estimate(a: Column, b: Column) -> Column:
    """Share of equal slots; 0 if either is empty."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), same / F.size(a)).otherwise(F.lit(0.0))

