"""Longest common subsequences of short lists (words, lines) on bit vectors held in integers."""

from __future__ import annotations

from collections.abc import Hashable, Sequence

import numpy as np

STORED_BITS = 1 << 28  # bits of vectors that one trace may keep; longer inputs are halved first


def _positions(b: Sequence[Hashable]) -> dict[Hashable, int]:
    at: dict[Hashable, int] = {}
    for j, x in enumerate(b):
        at[x] = at.get(x, 0) | 1 << j
    return at


def _rows(a: Sequence[Hashable], b: Sequence[Hashable]):
    """After each item of `a`: a vector whose zero bits up to j count the longest common subsequence with b[:j + 1]."""
    at, full = _positions(b), (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & at.get(x, 0)
        v = ((v + u) | (v - u)) & full
        yield v


def lcs_length(a: Sequence[Hashable], b: Sequence[Hashable]) -> int:
    v = (1 << len(b)) - 1
    for v in _rows(a, b):
        pass
    return len(b) - v.bit_count()


def lcs_members(a: Sequence[Hashable], b: Sequence[Hashable]) -> list[int]:
    """Ascending positions of `a` that one longest common subsequence with `b` uses."""
    both = set(a) & set(b)
    places = [i for i, x in enumerate(a) if x in both]
    return [places[i] for i in _members([a[i] for i in places], [x for x in b if x in both])]


def _members(a: list, b: list) -> list[int]:
    n = min(len(a), len(b))
    head = 0
    while head < n and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < n - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head:len(a) - tail], b[head:len(b) - tail]
    if not x or not y:
        inner = []
    elif len(x) == 1:
        inner = [0] if x[0] in y else []
    elif len(x) * len(y) > STORED_BITS:
        middle = len(x) // 2
        left, right = _lengths(x[:middle], y), _lengths(x[middle:][::-1], y[::-1])[::-1]
        cut = int(np.argmax(left + right))
        inner = _members(x[:middle], y[:cut]) + [middle + i for i in _members(x[middle:], y[cut:])]
    else:
        inner = _trace(x, y)
    return [*range(head), *(head + i for i in inner), *range(len(a) - tail, len(a))]


def _lengths(a: list, b: list) -> np.ndarray:
    """Length of the longest common subsequence of `a` with each prefix of `b`, the empty one included."""
    *_, v = _rows(a, b)
    bits = np.unpackbits(np.frombuffer(v.to_bytes(-(-len(b) // 8), "little"), np.uint8), bitorder="little")[:len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def _trace(a: list, b: list) -> list[int]:
    rows = list(_rows(a, b))
    i, j, used = len(a), len(b), []
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                used.append(i)
                j -= 1
    return used[::-1]
