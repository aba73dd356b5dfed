"""Two-stage suffix sorting of a set of strings, and their equal windows.

A suffix is *small* if it is less than its successor (the suffix one symbol
later), else *large*.  Only the small ones are sorted directly; the large ones
are induced by scanning the buckets of first symbols upwards: when a suffix has
its final place, its predecessor, if large, takes the next place at the front of
its own bucket.  A bucket is scanned as arrays, round by round for runs of one
symbol.  Suffixes are sorted by their first ``length`` symbols, which is all
that equal windows of that length need.
"""

from __future__ import annotations

import numpy as np


def small_suffixes(x: np.ndarray) -> np.ndarray:
    """Whether each suffix is less than its successor; the last one counts as small."""
    n = len(x)
    step = np.sign(x[1:].astype(np.int32) - x[:-1].astype(np.int32))
    # in a run of one symbol the symbol after the run decides
    after = np.where(step != 0, np.arange(n - 1), n)
    after = np.minimum.accumulate(after[::-1])[::-1]
    small = np.ones(n, dtype=bool)
    known = after < n
    small[:-1][known] = step[after[known]] > 0
    return small


def sort(x: np.ndarray, raw: np.ndarray, length: int) -> np.ndarray:
    """Suffix array of symbols ``x`` by the first ``length`` symbols.

    ``raw``: the symbols as bytes, padded by ``length`` at the end; separators,
    the least symbol of ``x``, are zero bytes there.
    """
    small = small_suffixes(x)
    at = np.flatnonzero(small)
    keys = np.lib.stride_tricks.sliding_window_view(raw, length)[at]
    order = np.argsort(np.ascontiguousarray(keys).view(f"S{length}").ravel(), kind="stable")
    direct = at[order]
    head = x[direct]
    direct = direct[np.argsort(head, kind="stable")]  # a zero byte isn't a separator
    symbols = np.unique(x)
    low, high = np.searchsorted(x[direct], symbols, "left"), np.searchsorted(x[direct], symbols, "right")
    waiting: dict[int, list[np.ndarray]] = {int(s): [] for s in symbols}
    done = []
    for s, a, b in zip(symbols.tolist(), low.tolist(), high.tolist()):
        front = waiting.pop(s)
        now = np.concatenate(front) if front else direct[:0]
        while len(now):  # predecessors in the same bucket follow in order
            now = now[now > 0] - 1
            now = now[x[now] == s]
            if len(now):
                front.append(now)
        bucket = np.concatenate([*front, direct[a:b]])
        done.append(bucket)
        before = bucket[bucket > 0] - 1
        first = x[before]
        large = first > s
        before, first = before[large], first[large]
        if len(before):
            order = np.argsort(first, kind="stable")
            before, first = before[order], first[order]
            cuts = np.flatnonzero(np.diff(first)) + 1
            for part in np.split(before, cuts):
                waiting[int(x[part[0]])].append(part)
    return np.concatenate(done)


def words(raw: np.ndarray, n: int) -> np.ndarray:
    """The eight bytes from each of the first n positions as one number."""
    out = np.zeros(n, dtype=np.uint64)
    for j in range(8):
        out |= raw[j:j + n].astype(np.uint64) << np.uint64(56 - 8 * j)
    return out


def common(word: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the common prefixes of positions a and b reach ``length`` (eight at least)."""
    same = np.ones(len(a), dtype=bool)
    for step in [*range(0, length - 7, 8), length - 8]:
        live = np.flatnonzero(same)
        same[live] = word[a[live] + step] == word[b[live] + step]
    return same


def equal_windows(strings: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Groups of equal windows of ``length`` bytes in strings of that length at least.

    Returns, for every window in the order of the strings, the string's number
    and the window's group.
    """
    size = np.fromiter(map(len, strings), np.int64, len(strings))
    n = int(size.sum()) + len(strings)
    raw = np.frombuffer(b"\0".join(strings) + b"\0" * (length + 9), dtype=np.uint8)
    x = raw[:n].astype(np.uint16) + 1
    ends = np.cumsum(size + 1) - 1
    x[ends] = 0
    owner = np.repeat(np.arange(len(strings)), size + 1)
    room = np.repeat(ends, size + 1) - np.arange(n)  # bytes left in the string
    window = room >= length
    order = sort(x, raw, length)
    order = order[window[order]]
    group = np.zeros(n, dtype=np.int64)
    if len(order):
        new = np.ones(len(order), dtype=np.int64)
        new[1:] = ~common(words(raw, n), order[:-1], order[1:], length)
        group[order] = np.cumsum(new) - 1
    return owner[window], group[window]
