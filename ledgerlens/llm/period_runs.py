"""Periodic runs of words: every maximal stretch of at least four periods, found by a descending-LCP Kruskal.

A run of smallest period q and length L starts at a word s with LCP(s, s + q) = L - q >= 3 q, LCP being the length that
two suffixes have in common.  Suffix classes (the positions whose next l words agree) are united by decreasing l, along
the neighbours in suffix order; a union-find keeps the positions of each class in order, the smaller class is put into
the larger one, and the pairs of positions that become neighbours have LCP exactly l.  Where their distance d has
d <= l / 3 and no longer run begins one word before, they are a run of length d + l.  Runs with equal ends are one, with
their smallest period.

A run has at least MOST_FEW + 1 words, so only classes of l >= MOST_FEW matter, and every word of a run starts a stretch of MOST_FEW
words that occurs twice in an unbroken series of such words.  Words outside of such series are left out first, by a sort
of hashes over many documents at a time, and each series is worked on apart; suffixes are ranked by prefix doubling.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ledgerlens.llm.common import add_columns

LEAST_LENGTH = 6  # of a run, in words
LEAST_EXPONENT = 4
GRAM = LEAST_LENGTH - 1  # LCP of the first pair of the shortest run

RUNS = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts (maximal stretches without ASCII white space), and where each text's words start and end."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    words, bounds = lists.flatten(), lists.offsets.to_numpy()
    some = pc.not_equal(pc.binary_length(words), 0)
    before = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
    return words.filter(some), before[bounds]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _twice(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _series(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, series): words that start a GRAM which occurs twice in their unbroken series of such words."""
    spread = _mixed(np.arange(int(codes.max()) + 1 if len(codes) else 0, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    value = spread[codes]
    n = len(codes) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = np.zeros(n, np.uint64)
    for k in range(GRAM):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + value[k:k + n]
    inside = np.ones(len(codes), bool)
    for k in range(1, GRAM):  # the last words of each text have no GRAM
        ends = bounds[1:] - k
        inside[ends[(ends >= bounds[:-1]) & (ends >= 0)]] = False
    at = np.flatnonzero(inside[:n])
    owner = np.searchsorted(bounds, at, "right")
    while True:
        keep = _twice(_mixed(grams[at] ^ _mixed(owner.astype(np.uint64))))
        at, owner = at[keep], owner[keep]
        if keep.all():
            return at, owner
        # a series ends where a word was left out, or its owner changes
        owner = np.cumsum(np.concatenate([[True], (np.diff(at) > 1) | (np.diff(owner) != 0)])[:len(at)])


def _ranked(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def _suffixes(codes: np.ndarray, at: np.ndarray, series: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp): suffix order of the positions, series by series, and what neighbours have in common (0 below GRAM)."""
    n = len(at)
    width = int(codes.max()) + 1
    level = series.astype(np.int64)
    for k in range(GRAM):
        level = _ranked(level * width + codes[at + k])
    last = np.searchsorted(series, series, "right")  # series are ascending: the end of each position's own
    places, levels, step = np.arange(n), [level], GRAM
    while level.max() + 1 < n:
        follow = places + step
        there = follow < last
        # without a whole second half a suffix is like no other
        second = np.where(there, level[np.where(there, follow, 0)], n + places)
        level = _ranked(level * (2 * n) + second)
        levels.append(level)
        step *= 2
    order = np.empty(n, np.int64)
    order[level] = places
    a, b = order[:-1].copy(), order[1:].copy()
    lcp = np.zeros(n - 1, np.int64)
    for height in range(len(levels) - 2, -1, -1):
        step = GRAM << height
        here = (a < last[order[:-1]]) & (b < last[order[1:]])
        same = here & (levels[height][np.where(here, a, 0)] == levels[height][np.where(here, b, 0)])
        lcp += step * same
        a += step * same
        b += step * same
    # fewer than GRAM more words may agree; a series has GRAM - 1 words behind its last position
    base, ends = order[:-1], at[last[order[1:]] - 1] + GRAM
    open_ = (lcp >= GRAM) & (series[order[:-1]] == series[order[1:]])
    left, right, stop = at[order[:-1]] + lcp, at[order[1:]] + lcp, np.minimum(at[last[base] - 1] + GRAM, ends)
    for _ in range(GRAM - 1):
        open_ &= (left < stop) & (right < stop)
        open_ &= codes[np.where(open_, left, 0)] == codes[np.where(open_, right, 0)]
        lcp += open_
        left += open_
        right += open_
    return order, lcp


def _kruskal(codes: np.ndarray, at: np.ndarray, series: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(start, end, period) of runs, as positions in `codes`; a run may come with multiples of its period, too."""
    order, lcp = _suffixes(codes, at, series)
    edges = np.flatnonzero(lcp >= GRAM)
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    first = np.concatenate([[True], series[1:] != series[:-1]]).tolist()
    word, place = codes.tolist() if len(codes) < 4 * len(at) else codes, at.tolist()
    parent = list(range(len(at)))
    members: list[list[int] | None] = [None] * len(at)

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y, common in zip(order[edges].tolist(), order[edges + 1].tolist(), lcp[edges].tolist()):
        x, y = find(x), find(y)
        large, small = members[x] or [x], members[y] or [y]
        if len(large) < len(small):
            x, y, large, small = y, x, small, large
        parent[y] = x
        reach = common // (LEAST_EXPONENT - 1)
        last = -1
        for t in small:
            p = bisect_left(large, t)
            for u, v in ((large[p - 1] if p else t, t), (t, large[p] if p < len(large) else t)):
                d = v - u
                if 0 < d <= reach and u != last and d + common >= LEAST_LENGTH:
                    s = place[u]
                    if first[u] or word[s - 1] != word[s - 1 + d]:
                        yield s, s + d + common, d
            large.insert(p, t)
            last = t
        members[x], members[y] = large, None


def find_runs(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(start, end, period) of all runs by start and period, as positions in `codes`; texts are bounds[i] to bounds[i + 1]."""
    at, series = _series(codes, bounds)
    if not len(at):
        return np.zeros((0, 3), np.int64)
    found: dict[tuple[int, int], int] = {}
    for s, e, d in _kruskal(codes, at, series):
        found[s, e] = min(d, found.get((s, e), d))
    return np.array(sorted((s, e, d) for (s, e), d in found.items()), np.int64).reshape(-1, 3)


def _work(texts: pa.Array) -> list[pa.Array]:
    words, bounds = split_words(texts)
    codes = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    runs = find_runs(codes, bounds)
    text_of = np.searchsorted(bounds, runs[:, 0], "right") - 1
    runs = runs[order := np.lexsort((runs[:, 2], runs[:, 0]))]
    text_of = text_of[order]
    cells = pa.StructArray.from_arrays([pa.array(runs[:, 0] - bounds[text_of]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])],
                                       names=["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(text_of, np.arange(len(texts) + 1)).astype(np.int32)), cells)
    change = np.zeros(len(codes) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    kept = np.cumsum(change)[:-1] == 0
    before = np.concatenate([[0], np.cumsum(kept)])
    left = pa.LargeListArray.from_arrays(pa.array(before[bounds]), words.filter(pa.array(kept)))
    return [pa.array(np.diff(bounds)), lists, pc.binary_join(left, pa.scalar(" ", pa.large_string())).cast(pa.string())]


def periodic_runs(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`df` with `n_words`, `runs` and `collapsed` of each whole text; an input column of such a name is replaced.

    Words are stretches without ASCII white space, numbered from 0.  `runs` lists (start, length, period) by start and
    period; `collapsed` joins by one space the words that are in no run or in the first period of each run that has
    them.  A NULL or empty text has no words, no runs and an empty collapsed text.  Rows never move between tasks; rows
    with equal keys or texts stay separate rows.  `keep` names the columns of `df` that come back, by default all.
    """
    return add_columns(df, text, RUNS, lambda: _work, keep=keep, arrow=True)
