"""Word suffix arrays by prefix doubling, for a chunk of texts at a time."""

from __future__ import annotations

import numpy as np

from . import text_batches as tb


def ranks(key: np.ndarray) -> np.ndarray:
    """For each entry, the number of entries with a smaller key."""
    order = np.argsort(key)
    s = key[order]
    first = np.concatenate(([True], s[1:] != s[:-1]))
    rank = np.empty(len(key), np.int64)
    rank[order] = np.flatnonzero(first)[np.cumsum(first) - 1]
    return rank


def following(rank: np.ndarray, pos: np.ndarray, gap: int) -> np.ndarray:
    """Rank + 1 of the suffix ``gap`` words on; 0 past the last word."""
    at = pos + gap
    out = np.zeros(len(pos), np.int64)
    ok = at < len(rank)
    out[ok] = rank[at[ok]] + 1
    return out


def prefix_ranks(words: np.ndarray, rows: np.ndarray, size: int) -> list[np.ndarray]:
    """levels[k][i] ranks the suffix at word i by its first 2^k words, up to
    2^k = size. Words of different rows are different letters."""
    key = tb.mix(words ^ (rows.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    levels = [ranks(key)]
    n, everywhere = len(words), np.arange(len(words))
    while 1 << (len(levels) - 1) < size:
        r = levels[-1]
        levels.append(ranks(r * (n + 1) + following(r, everywhere, 1 << (len(levels) - 1))))
    return levels


def refine(levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Go on doubling for the suffixes still tied until none is. Returns
    (the suffixes tied at first in suffix order, their rank at first);
    ``levels`` grows."""
    first = levels[-1]
    n = len(first)
    tied = np.flatnonzero(np.bincount(first, minlength=n)[first] > 1)
    active = tied
    while len(active):
        r, gap = levels[-1], 1 << (len(levels) - 1)
        key = r[active] * (n + 1) + following(r, active, gap)
        order = np.argsort(key)
        a, k = active[order], key[order]
        g = r[a]
        new_group = np.concatenate(([True], g[1:] != g[:-1]))
        new_key = np.concatenate(([True], k[1:] != k[:-1]))
        idx = np.arange(len(a))
        group_at = np.maximum.accumulate(np.where(new_group, idx, 0))
        key_at = np.maximum.accumulate(np.where(new_key, idx, 0))
        nxt = r.copy()
        nxt[a] = g + (key_at - group_at)
        levels.append(nxt)
        alone = new_key & np.concatenate((new_key[1:], [True]))
        active = a[~alone]
    sa = tied[np.argsort(levels[-1][tied])]
    return sa, first[sa]


def common_prefix(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words that the suffixes a and b (arrays of positions) share."""
    n = len(levels[0])
    got = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        while True:
            x, y = a + got, b + got
            ok = (x < n) & (y < n)
            same = np.zeros(len(a), bool)
            same[ok] = levels[k][x[ok]] == levels[k][y[ok]]
            if not same.any():
                break
            got[same] += 1 << k
    return got


def longest_repeats(words: np.ndarray, rows: np.ndarray, min_words: int):
    """(positions, lengths) of the suffixes whose first ``min_words`` words
    occur again in the same row, with the length of the longest prefix that
    does: the larger LCP with a neighbour in suffix order."""
    none = np.zeros(0, np.int64)
    if len(words) == 0:
        return none, none
    levels = prefix_ranks(words, rows, 1 << ((min_words).bit_length() - 1))
    sa, group = refine(levels)
    if len(sa) == 0:
        return none, none
    lcp = np.zeros(len(sa) + 1, np.int64)
    near = np.flatnonzero(group[1:] == group[:-1])
    lcp[near + 1] = common_prefix(levels, sa[near], sa[near + 1])
    longest = np.maximum(lcp[:-1], lcp[1:])
    keep = longest >= min_words
    return sa[keep], longest[keep]
