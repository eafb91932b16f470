"""Suffix arrays in numpy: Larsson-Sadakane refinement and Kasai's common prefixes."""

from __future__ import annotations

import numpy as np

# Symbols of the first sort: 9 bits each, as 0 ends a string and bytes are 1 to 256.
FIRST = 7


def joined(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The strings one after the other, each ended by a 0, as symbols; and where they start."""
    sizes = np.fromiter(map(len, strings), np.int64, len(strings)) + 1
    starts = np.cumsum(sizes) - sizes
    symbols = np.frombuffer(b"\0".join([*strings, b""]), np.uint8).astype(np.int64) + 1
    symbols[starts + sizes - 1] = 0
    return symbols, starts


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order.

    Larsson-Sadakane: sorts by a few symbols, then again and again by the rank
    of the suffix as many symbols on, which doubles the symbols that are
    sorted by. Only groups of suffixes that are still equal take part.
    """
    n = len(symbols)
    if not n:
        return np.empty(0, np.int64)
    key = np.zeros(n, np.int64)
    for k in range(FIRST):
        key <<= 9
        if k < n:
            key[: n - k] |= symbols[k:] + 1  # 0 is beyond the end
    order = np.argsort(key)
    sorted_key = key[order]
    new = np.concatenate(([True], sorted_key[1:] != sorted_key[:-1]))
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    slots = np.arange(n)
    rank[order] = np.maximum.accumulate(np.where(new, slots, 0))
    slots = slots[~(new & np.concatenate((new[1:], [True])))]
    h = FIRST
    while len(slots):
        suffixes = order[slots]
        key = rank[suffixes] * (n + 1) + rank[np.minimum(suffixes + h, n)] + 1
        by = np.argsort(key)
        suffixes, key = suffixes[by], key[by]
        order[slots] = suffixes
        new = np.concatenate(([True], key[1:] != key[:-1]))
        rank[suffixes] = np.maximum.accumulate(np.where(new, slots, 0))
        slots = slots[~(new & np.concatenate((new[1:], [True])))]
        h *= 2
    return order


def common_prefixes(
    symbols: np.ndarray, order: np.ndarray, starts: np.ndarray, most: int, wanted: np.ndarray | None = None
) -> np.ndarray:
    """Of each suffix in order, the symbols it shares with the one before, up to ``most``.

    With ``wanted``, only of so many suffixes from each string's start on; 0 for the others.

    Kasai: going from a suffix to the next shorter one, the shared prefix is
    shorter by one at most. The strings (``starts``) are walked side by side,
    each from its own beginning.
    """
    n = len(symbols)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    text = np.concatenate((symbols, [-1]))  # nothing equals the end
    sizes = np.diff(np.concatenate((starts, [n]))) if wanted is None else wanted
    longest_first = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[longest_first], sizes[longest_first]
    shared = np.zeros(n, np.int64)
    length = np.zeros(len(starts), np.int64)
    for step in range(int(sizes.max(initial=0))):
        alive = int(np.searchsorted(-sizes, -step, side="left"))
        at = starts[:alive] + step
        other = before[at]
        length = np.maximum(length[:alive] - 1, 0)
        length[other < 0] = 0
        open_ = np.flatnonzero((other >= 0) & (length < most))
        while len(open_):
            a, b = at[open_] + length[open_], other[open_] + length[open_]
            open_ = open_[text[np.minimum(a, n)] == text[np.minimum(b, n)]]
            open_ = open_[np.maximum(at[open_], other[open_]) + length[open_] < n]
            length[open_] += 1
            open_ = open_[length[open_] < most]
        shared[at] = length
    return shared[order]
