"""Two-stage suffix sorting of bytes (Itoh and Tanaka, 1999), to a bounded depth, by numpy.

A suffix is of type B if it is smaller than its successor (the suffix one byte on), else of type A. Only the type B
suffixes are sorted directly. A scan over the buckets of equal first bytes, in order, then places the rest: when a
suffix is met, the one a byte before it, if of type A, takes the next place in its own bucket. Each bucket's scan is
one vector step, and one more for each repeat of the bucket's byte in a run.
"""

from __future__ import annotations

import numpy as np


def runs_of(values: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of each run of equal values."""
    if not len(values):
        return []
    heads = [*np.flatnonzero(np.append(True, values[1:] != values[:-1])).tolist(), len(values)]
    return list(zip(heads[:-1], heads[1:], strict=True))


def words_at(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one number, so that numbers compare as bytes do; zeros follow the end."""
    padded = np.append(text, np.zeros(136, np.uint8))
    out = np.zeros(len(padded) - 8, np.uint64)
    for j in range(8):
        out |= padded[j : j + len(out)].astype(np.uint64) << np.uint64(56 - 8 * j)
    return out


def type_b(text: np.ndarray) -> np.ndarray:
    n = len(text)
    out = np.zeros(n, bool)
    if n > 1:
        differs = np.flatnonzero(text[1:] != text[:-1])
        at = np.searchsorted(differs, np.arange(n))
        has = at < len(differs)
        j = differs[at[has]]
        out[has] = text[j] < text[j + 1]
    return out


def _sorted_directly(places: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """places in the order of their first `depth` bytes at least."""
    order = places[np.argsort(words[places], kind="stable")]
    group = np.cumsum(np.append(0, words[order][1:] != words[order][:-1])) if len(order) else order
    at = np.arange(len(order))
    for skip in range(8, depth, 8):
        tied = np.zeros(len(at), bool)
        same = group[1:] == group[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        at, group = at[tied], group[tied]
        if not len(at):
            break
        some = order[at]
        key = words[some + skip]
        new = np.lexsort((key, group))
        order[at] = some[new]
        key = key[new]
        # groups keep their places, so their order stands; each splits where the key differs
        group = np.cumsum(np.append(0, (group[1:] != group[:-1]) | (key[1:] != key[:-1])))
    return order


def suffix_array(text: np.ndarray, words: np.ndarray | None = None, depth: int = 104) -> np.ndarray:
    """All suffixes of text in the order of their first `depth` bytes at least."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    words = words_at(text) if words is None else words
    direct = _sorted_directly(np.flatnonzero(type_b(text)), words, depth)
    first = text[direct]
    cut = np.searchsorted(first, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[-1]].append(np.array([n - 1]))
    out = []
    for c in np.flatnonzero(np.bincount(text, minlength=256)).tolist():
        bucket = waiting[c]
        front = np.concatenate(bucket) if bucket else np.zeros(0, np.int64)
        bucket = [front]
        while len(front):  # a run of this bucket's own byte
            front = front[front > 0] - 1
            front = front[text[front] == c]
            bucket.append(front)
        bucket.append(direct[cut[c] : cut[c + 1]])
        full = np.concatenate(bucket)
        out.append(full)
        before = full[full > 0] - 1
        head = text[before]
        larger = head > c
        before, head = before[larger], head[larger]
        order = np.argsort(head, kind="stable")
        before, head = before[order], head[order]
        for a, b in runs_of(head):
            waiting[head[a]].append(before[a:b])
    return np.concatenate(out)


def common_prefixes(order: np.ndarray, words: np.ndarray, most: int) -> np.ndarray:
    """Of each suffix with the one before it in the order (0 for the first), up to `most` (no less than 8)."""
    out = np.zeros(len(order), np.int64)
    live = np.arange(1, len(order))
    for skip in range(0, most, 8):
        x = words[order[live] + skip] ^ words[order[live - 1] + skip]
        same = x == 0
        ended = live[~same]
        some = x[~same]
        bytes_same = np.zeros(len(some), np.int64)
        for j in range(7):
            bytes_same += (some >> np.uint64(56 - 8 * j)) == 0
        out[ended] = skip + bytes_same
        live = live[same]
    out[live] = most
    return np.minimum(out, most)
