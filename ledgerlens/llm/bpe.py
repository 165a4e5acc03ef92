"""Byte-level BPE: encode whole texts to token ids, and decode ids to text.

The merges of a pre-token run on a segment tree.  Leaf i holds the rank of the pair that starts at symbol i, with the
position in its low bits, so the minimum at the root is the leftmost pair of the lowest rank.  A merge changes at most
three leaves, each repaired in O(log n), until the root holds no mergeable pair: O(n log n) for a pre-token of any length.
Short pre-tokens share one array of trees, one step of every tree at a time.

Pre-tokens never span special strings, and a text falls apart at each single space that is followed by a non-space
character, because the split pattern cannot see across it.  The ids of such pieces are remembered per Python worker, in
a dictionary of bounded size; a forgotten piece is merged again.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame

from ledgerlens.llm.common import Known, add_columns, runs, worker_state

# Fixed value: the split pattern of this family of vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NONE = 1 << 62
SHORT = 64  # pre-tokens of at most so many bytes are merged together


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in for each byte: itself where printable, otherwise the next character from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Merges:
    """Pair ranks over token ids, and the segment-tree merge."""

    def __init__(self, pairs: list[tuple[int, int, int]]):
        """`pairs` holds (left id, right id, merged id) by rank."""
        self.results = np.array([m for _, _, m in pairs], np.int64)
        self.ranks: dict[int, int] = {}
        for rank, (left, right, _) in enumerate(pairs):
            self.ranks.setdefault(left << 20 | right, rank)
        keys = np.array(sorted(self.ranks), np.int64)
        self.bits = int(4 * len(keys) + 4).bit_length()
        self.slots = np.full(1 << self.bits, -1, np.int64)  # open addressing: a pair's slot, or one of the next
        self.slot_ranks = np.zeros(1 << self.bits, np.int64)
        left, at = keys, self._slot(keys)
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]
            lost = self.slots[at] != left
            self.slot_ranks[at[~lost]] = [self.ranks[k] for k in left[~lost].tolist()]
            left, at = left[lost], (at[lost] + 1) & (len(self.slots) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _leaves(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Leaf values of pairs that start at positions `at`; NONE where they cannot merge."""
        keys = left << 20 | right
        slot, out = self._slot(keys), np.full(len(keys), NONE, np.int64)
        todo = np.arange(len(keys))
        while len(todo):
            here = self.slots[slot[todo]]
            hit = todo[here == keys[todo]]
            out[hit] = self.slot_ranks[slot[hit]] << 32 | at[hit]
            todo = todo[(here != keys[todo]) & (here >= 0)]
            slot[todo] = (slot[todo] + 1) & (len(self.slots) - 1)
        return out

    def merge(self, ids: list[int]) -> list[int]:
        """One sequence of any length."""
        n = len(ids)
        if n < 2:
            return ids
        get, results = self.ranks.get, self.results
        size = 1 << (n - 2).bit_length() if n > 2 else 1
        tree = [NONE] * (2 * size)
        for i in range(n - 1):
            rank = get(ids[i] << 20 | ids[i + 1])
            if rank is not None:
                tree[size + i] = rank << 32 | i
        for q in range(size - 1, 0, -1):
            tree[q] = min(tree[2 * q], tree[2 * q + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def leaf(i: int, j: int) -> int:
            rank = get(ids[i] << 20 | ids[j])
            return NONE if rank is None else rank << 32 | i

        while (top := tree[1]) != NONE:
            i = top & 0xFFFFFFFF
            j = after[i]
            k = after[j]
            ids[i], ids[j], after[i] = int(results[top >> 32]), -1, k
            changed = [(i, leaf(i, k) if k < n else NONE)]
            if k < n:
                before[k] = i
                changed.append((j, NONE))
            if before[i] >= 0:
                changed.append((before[i], leaf(before[i], i)))
            for at, value in changed:
                q = size + at
                tree[q] = value
                q >>= 1
                while q:
                    low = min(tree[2 * q], tree[2 * q + 1])
                    if tree[q] == low:
                        break
                    tree[q] = low
                    q >>= 1
        return [t for t in ids if t >= 0]

    def merge_all(self, rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Many short sequences, one a row, padded to a power of two of at least one more than the longest.

        Returns the rows with -1 where a symbol was merged into one before it or never was.
        """
        count, size = rows.shape
        ids, place = rows.ravel(), np.arange(size)
        ids[(place >= lengths[:, None]).ravel()] = -1
        after = np.tile(place + 1, count)
        before = np.tile(place - 1, count)
        tree = np.full((count, 2 * size), NONE, np.int64)
        pair = np.flatnonzero((place < lengths[:, None] - 1).ravel())
        tree[pair // size, size + pair % size] = self._leaves(ids[pair], ids[pair + 1], pair % size)
        for level in range(size.bit_length() - 2, -1, -1):
            a, b = 1 << level, 2 << level
            tree[:, a:b] = np.minimum(tree[:, b:2 * b:2], tree[:, b + 1:2 * b:2])
        tree = tree.ravel()
        rest = np.arange(count)
        while True:
            top = tree[rest * (2 * size) + 1]
            rest, top = rest[top != NONE], top[top != NONE]
            if not len(rest):
                return ids.reshape(count, size)
            base = rest * size
            i = top & 0xFFFFFFFF
            j = after[base + i]
            k = after[base + j]
            ids[base + i] = self.results[top >> 32]
            ids[base + j] = -1
            after[base + i] = k
            has_next = k < lengths[rest]
            before[(base + k)[has_next]] = i[has_next]
            p = before[base + i]
            has_last = p >= 0
            p = np.where(has_last, p, i)
            q = np.where(has_last, i, k)  # without a symbol before it, leaf i is set once more
            ok = has_last | has_next
            at_p = np.where(ok, self._leaves(ids[base + p], ids[base + np.where(ok, q, i)], p), NONE)
            at_i = np.where(has_next, self._leaves(ids[base + i], ids[base + np.where(has_next, k, i)], i), NONE)
            root = rest * (2 * size)
            tree[root + size + j] = NONE
            tree[root + size + p] = at_p
            tree[root + size + i] = at_i
            root, node = np.concatenate([root, root, root]), size + np.concatenate([i, j, p])
            while size > 1 and node[0] > 1:
                node >>= 1
                both = root + 2 * node
                tree[root + node] = np.minimum(tree[both], tree[both + 1])


class Codec:
    """Encoder and decoder of one vocabulary file (JSON text of a byte-level BPE model)."""

    def __init__(self, definition: str):
        import regex
        spec = json.loads(definition)
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        pairs = [p if isinstance(p, list) else p.split(" ") for p in spec["model"]["merges"]]
        self.merges = Merges([(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs])
        self.byte_ids = np.zeros(256, np.int64)
        for char, byte in alphabet.items():
            self.byte_ids[byte] = vocab[char]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", []) if t.get("special")}
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.token_bytes = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(alphabet[c] for c in token)
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.words = regex.compile(PATTERN).findall
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, longest_first))) if longest_first else None
        self.pre_tokens = Known(self._merged)
        self.pieces = Known(self.pieces_of)

    def _merged(self, words: list[str]) -> list[bytes]:
        """Packed ids of distinct pre-tokens."""
        raw = [w.encode() for w in words]
        out: list[bytes] = [b""] * len(raw)
        by_size: dict[int, list[int]] = {}
        for n, word in enumerate(raw):
            if len(word) <= SHORT:
                by_size.setdefault(1 << len(word).bit_length(), []).append(n)
            else:
                out[n] = np.array(self.merges.merge(self.byte_ids[list(word)].tolist()), "<u4").tobytes()
        for size, numbers in by_size.items():
            for start in range(0, len(numbers), 1 << 13):
                part = numbers[start:start + (1 << 13)]
                rows = np.frombuffer(b"".join([raw[n].ljust(size, b"\0") for n in part]), np.uint8).reshape(-1, size)
                lengths = np.array([len(raw[n]) for n in part])
                merged = self.merges.merge_all(self.byte_ids[rows], lengths)
                ends = 4 * np.cumsum((merged >= 0).sum(axis=1))
                packed, begin = merged[merged >= 0].astype("<u4").tobytes(), 0
                for n, end in zip(part, ends.tolist()):
                    out[n], begin = packed[begin:end], end
        return out

    def plain(self, texts: list[str]) -> list[bytes]:
        """Packed ids of texts that are split by the pattern alone."""
        words = list(map(self.words, texts))
        found = self.pre_tokens.lookup(list(chain.from_iterable(words)))
        return list(map(b"".join, runs(found, map(len, words))))

    def pieces_of(self, parts: list[str]) -> list[bytes | bool]:
        """Packed ids of parts that follow a space; False where a run of white space goes on into the part."""
        out: list[bytes | bool] = [False] * len(parts)
        whole, ended, mixed = [], [], []
        for n, part in enumerate(parts):
            if part.isalpha():  # the part is one pre-token with its space
                whole.append(n)
            elif part.rstrip(".,").isalpha():  # and one more of the marks behind it
                ended.append(n)
            elif part and not part[0].isspace():
                mixed.append(n)
        cores = [" " + parts[n].rstrip(".,") for n in ended]
        marks = [parts[n][len(core) - 1:] for n, core in zip(ended, cores)]
        for n, core, mark in zip(ended, self.pre_tokens.lookup(cores), self.pre_tokens.lookup(marks)):
            out[n] = core + mark
        for n, packed in zip(whole, self._merged([" " + parts[n] for n in whole])):
            out[n] = packed
        for n, packed in zip(mixed, self.plain([" " + parts[n] for n in mixed])):
            out[n] = packed
        return out

    def _segments(self, texts: list[str]) -> list[bytes]:
        """Packed ids of texts without special strings."""
        parts = [t.split(" ") for t in texts]
        firsts = self.plain([p[0] for p in parts])
        found = self.pieces.lookup(list(chain.from_iterable(p[1:] for p in parts)))
        out: list[bytes | None] = []
        for first, rest in zip(firsts, runs(found, (len(p) - 1 for p in parts))):
            out.append(None if False in rest else first + b"".join(rest))
        odd = [n for n, x in enumerate(out) if x is None]
        for n, packed in zip(odd, self.plain([texts[n] for n in odd])):
            out[n] = packed
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        plan: list[list[bytes | str]] = []
        for text in texts:
            plan.append(cells := [])
            at = 0
            if text and self.cut is not None:
                for match in self.cut.finditer(text):
                    cells += [text[at:match.start()], np.array([self.special[match[0]]], "<u4").tobytes()]
                    at = match.end()
            cells.append((text or "")[at:])
        done = iter(self._segments([c for cells in plan for c in cells if isinstance(c, str)]))
        return [b"".join([next(done) if isinstance(c, str) else c for c in cells]) for cells in plan]

    def decode(self, ids: list[bytes | None]) -> list[str]:
        table = self.token_bytes.__getitem__
        return [b"".join(map(table, np.frombuffer(packed or b"", "<u4").tolist())).decode("utf-8", "replace")
                for packed in ids]


def _codec(definition: str) -> Codec:
    return worker_state(f"bpe {hash(definition)}", lambda: Codec(definition))


def vocabulary(path: str) -> str:
    """A vocabulary file of bounded size, read on the driver and sent with the tasks."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(df: DataFrame, definition: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """`df` with `ids`, the token ids of each whole text as packed little-endian unsigned 32-bit integers.

    NULL and empty texts have no ids (an empty value).  Special strings in a text become their own ids; nothing is
    added.  Other columns pass; an input column named like `ids` is replaced.  Rows never move between tasks.
    """
    return add_columns(df, text, f"`{ids}` binary", _task(definition, "encode"))


def decode(df: DataFrame, definition: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """`df` with `text`, the text of packed ids; bytes that are no UTF-8 become replacement characters.

    NULL and empty ids give an empty text.  An id outside the vocabulary is an error.
    """
    return add_columns(df, ids, f"`{text}` string", _task(definition, "decode"))


def encode_and_decode(df: DataFrame, definition: str, text: str = "text", ids: str = "ids",
                      decoded: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """`encode` and `decode` one after the other in the same task, for a check of the round trip.

    `keep` names the columns of `df` that come back, by default all.
    """
    def make():
        codec = _codec(definition)

        def work(cells: list) -> list[list]:
            packed = codec.encode(cells)
            return [packed, codec.decode(packed)]
        return work
    return add_columns(df, text, f"`{ids}` binary, `{decoded}` string", make, keep=keep)


def _task(definition: str, way: str) -> Callable:
    def make():
        work = getattr(_codec(definition), way)
        return lambda cells: [work(cells)]
    return make
