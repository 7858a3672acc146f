"""Burrows-Wheeler indexes of small shards of byte strings, and their merge by interleave refinement.

A shard holds strings and, in each, windows of ``DEPTH`` bytes. Its index sorts all
positions by their first 8, 16, ... ``DEPTH`` bytes. One pass goes from depth h to
h + step like the LF mapping: the positions q are walked in their order at depth
h, and p = q - step is dropped, in this order, into the place of p's own first h
bytes - the symbol of the transform at q, taken over blocks of bytes instead of
single bytes, so depth doubles with every pass. What remains of a pass is, per
distinct prefix, the pair (prefix of p, prefix of q): the transform by intervals.

Merging doesn't sort positions again. The interleave gives every distinct prefix
of every shard its place among those of all shards. At depth 8 the shards' sorted
prefixes are merged; a refinement replaces the pairs' shard-local numbers by
their places and merges the lists, sorted within each shard already, into the
places at the next depth. Two neighbours whose places differ first at some depth
share less than that many bytes; neighbours with one place at the last depth share
a whole window: the repeated intervals.
"""

from __future__ import annotations

import numpy as np

from shelfsense.llm.common import U

DEPTH = 200
#: (depth, step from the depth before); the last pass overlaps to reach DEPTH exactly.
PASSES = ((16, 8), (32, 16), (64, 32), (128, 64), (DEPTH, DEPTH - 128))


class Shard:
    """Index of strings: ``data`` one after the other, ``ends`` the end of the string at every position."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        size = np.diff(off)
        left = np.repeat(off[1:], size) - np.arange(len(data))  # bytes from a position to its string's end
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        head = np.zeros(len(data), U)
        for i in range(8):
            head = head << U(8) | padded[i:i + len(data)]
        at = np.flatnonzero(left >= 8)
        order = at[np.argsort(head[at], kind="stable")]
        new = np.ones(len(order), bool)
        new[1:] = head[order][1:] != head[order][:-1]
        self.heads = head[order[new]]
        #: Per pass: the number of the distinct prefix at p and at p + step.
        self.transforms: list[tuple[np.ndarray, np.ndarray]] = []
        rank = self._rank(order, new, len(data))
        for depth, step in PASSES:
            p = order - step
            p = p[p >= 0]
            p = p[left[p] >= depth]
            p = p[np.argsort(rank[p], kind="stable")]
            a, b = rank[p], rank[p + step]
            new = np.ones(len(p), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            self.transforms.append((a[new], b[new]))
            order, rank = p, self._rank(p, new, len(data))
        #: Number of the window at every position that has one, and how often each distinct window is here.
        self.windows = rank
        self.counts = np.bincount(rank[order], minlength=int(new.sum()))

    @staticmethod
    def _rank(order: np.ndarray, new: np.ndarray, n: int) -> np.ndarray:
        rank = np.full(n, -1, np.int32)
        rank[order] = np.cumsum(new) - 1
        return rank


def interleave(lists: list[np.ndarray]) -> list[np.ndarray]:
    """Place of every entry of sorted lists among the distinct entries of all (a stable merge of the runs)."""
    both = np.concatenate(lists)
    order = np.argsort(both, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = both[order][1:] != both[order][:-1]
    place = np.empty(len(both), np.int64)
    place[order] = np.cumsum(new) - 1
    return np.split(place, np.cumsum([len(x) for x in lists])[:-1])


def merge(shards: list[Shard]) -> list[np.ndarray]:
    """Per shard: how many windows of all shards equal each of its distinct windows."""
    places = interleave([s.heads for s in shards])
    for i in range(len(PASSES)):
        pairs = [(g[s.transforms[i][0]].astype(U) << U(32)) | g[s.transforms[i][1]].astype(U)
                 for s, g in zip(shards, places)]
        places = interleave(pairs)
    total = np.zeros(max((int(g.max()) + 1 for g in places if len(g)), default=0), np.int64)
    for s, g in zip(shards, places):
        np.add.at(total, g, s.counts)
    return [total[g] for g in places]


def repeated(shards: list[Shard]) -> list[np.ndarray]:
    """Per shard: at which positions a window begins that occurs more than once in all shards."""
    out = []
    for s, n in zip(shards, merge(shards)):
        again = np.append(n > 1, False)
        out.append(again[s.windows])
    return out
