"""Alignment of two tokenizations of the same bytes: groups by pointer jumping, and corpus-wide counts of linked ids.

A text has the tokens of a byte-level vocabulary (A, over a space and the text) and of a sentence-piece vocabulary (B, which
puts the space in front itself).  Every token points to the token of either kind that overlaps it and reaches farthest
to the right, B on ties.  Successors are doubled until nothing changes, all tokens at a time; then each token points to
the last one of its group, where both tokenizations end.  The A and the B token that end a group are linked.

A text without odd spaces falls apart at each space for both vocabularies, so words are encoded and aligned once while
they are remembered, in batches; any other text is one piece.  Link counts are summed per task, then by one shuffle of
distinct id pairs.  The most frequent pairs, whose number is bounded, are looked up in place; rows of the others are joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ledgerlens.llm.bpe import Codec
from ledgerlens.llm.common import Known, add_columns, quoted, short_batches, worker_state
from ledgerlens.session import cut_lineage

FREQUENT = 1 << 20  # id pairs whose counts are sent to every task
BAD = (0, 0, -1, b"", b"")  # a text whose bytes differ
HELD = 1 << 21  # distinct id pairs that a task holds before it hands on its sums
ALIGNED = "n_a long, n_b long, n_groups long, groups string, pairs binary, times binary"


def jump(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each A and each B token, named by the number of its last B token.

    Ends are ascending byte offsets; both lists have the same last one.
    """
    na, nb = len(ends_a), len(ends_b)
    cover_a, cover_b = np.searchsorted(ends_b, ends_a), np.searchsorted(ends_a, ends_b)
    successor = np.arange(nb + na)
    successor[nb:] = cover_a
    reaches = ends_a[np.minimum(cover_b, max(na - 1, 0))] > ends_b if na else np.zeros(nb, bool)
    successor[:nb] = np.where(reaches, nb + cover_b, successor[:nb])
    while True:
        doubled = successor[successor]
        if np.array_equal(doubled, successor):
            return successor[nb:], successor[:nb]
        successor = doubled


class Aligner:
    """Both vocabularies, and what is remembered of words: (A tokens, B tokens, groups, group text, linked pairs), BAD
    where the bytes differ."""

    def __init__(self, definition: str, model: bytes):
        import sentencepiece
        self.codec = Codec(definition)
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes_b = [bytes([int(self.pieces.id_to_piece(i)[3:5], 16)]) if self.pieces.is_byte(i)
                        else self.pieces.id_to_piece(i).replace("▁", " ").encode() for i in range(len(self.pieces))]
        self.size_b = len(self.bytes_b)
        self.lengths_a = np.array([len(b) for b in self.codec.token_bytes], np.int64)
        self.lengths_b = np.array([len(b) for b in self.bytes_b], np.int64)
        a, b = range(len(self.lengths_a)), range(self.size_b)
        self.names = [b"%d%c" % (i, mark) for mark, ids in ((b",", a), (b"|", a), (b",", b), (b";", b)) for i in ids]
        self.name_lengths = np.array(list(map(len, self.names)), np.int64)
        self.words = Known(lambda words: self._aligned(words, self.codec.pieces_of), 200_000, forget=0.9)  # of distinct words many are new in any batch

    def _aligned(self, units: list[str], encode) -> list[tuple]:
        """Aligned units, each a text without its space in front; `encode` gives the packed A ids of several with it."""
        ids_b = self.pieces.encode(units, num_threads=1)
        raw = [b" " + u.encode() for u in units]
        good, out = range(len(units)), [BAD] * len(units)
        if b"".join(map(self.bytes_b.__getitem__, chain.from_iterable(ids_b))) != b"".join(raw) or not self._even(ids_b, raw):
            table = self.bytes_b.__getitem__
            good = [n for n, ids in enumerate(ids_b) if b"".join(map(table, ids)) == raw[n]]
            ids_b, units = [ids_b[n] for n in good], [units[n] for n in good]
        if not units:
            return out
        packed = encode(units)
        a = np.frombuffer(b"".join(packed), "<u4").astype(np.int64)
        b = np.fromiter(chain.from_iterable(ids_b), np.int64)
        bound_a = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])])
        bound_b = np.concatenate([[0], np.cumsum(list(map(len, ids_b)))])
        group_a, group_b = jump(np.cumsum(self.lengths_a[a]), np.cumsum(self.lengths_b[b]))
        last_a = np.append(group_a[1:] != group_a[:-1], True)
        last_b = np.append(group_b[1:] != group_b[:-1], True)
        # the place of each token where the A tokens of a group come before its B tokens
        place_a = np.arange(len(a)) + np.searchsorted(group_b, group_a, "left")
        place_b = np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")
        size_a, name = len(self.lengths_a), np.empty(len(a) + len(b), np.int64)
        name[place_a] = a + size_a * last_a
        name[place_b] = 2 * size_a + b + self.size_b * last_b
        text = b"".join(map(self.names.__getitem__, name.tolist()))
        ends = np.concatenate([[0], np.cumsum(self.name_lengths[name])])[bound_a + bound_b].tolist()
        pairs = (a[last_a] * self.size_b + b[last_b]).astype("<u8").tobytes()
        bound_g = np.concatenate([[0], np.cumsum(last_b)])[bound_b]
        bound = (8 * bound_g).tolist()
        counts = zip(np.diff(bound_a).tolist(), np.diff(bound_b).tolist(), np.diff(bound_g).tolist())
        for k, (n, (na, nb, ng)) in enumerate(zip(good, counts)):
            out[n] = na, nb, ng, text[ends[k]:ends[k + 1]], pairs[bound[k]:bound[k + 1]]
        return out

    def _even(self, ids_b: list[list[int]], raw: list[bytes]) -> bool:
        """Whether each unit's B tokens have as many bytes as it."""
        ends = np.cumsum(list(map(len, ids_b)))
        sums = np.concatenate([[0], np.cumsum(self.lengths_b[np.fromiter(chain.from_iterable(ids_b), np.int64)])])
        return np.array_equal(sums[ends], np.cumsum(list(map(len, raw))))

    def _whole(self, texts: list[str]) -> list[bytes]:
        return self.codec.plain([" " + t for t in texts])

    def align(self, texts: pa.Array) -> list[pa.Array]:
        texts = pc.fill_null(texts, "")
        lists = pc.split_pattern(texts, " ")
        coded, bounds = lists.flatten().dictionary_encode(), lists.offsets.to_numpy()
        codes, words = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        odd = [not w or w[0].isspace() for w in words]
        if True in odd:
            known = iter(self.words.lookup([w for w, o in zip(words, odd) if not o]))
            found = [BAD if o else next(known) for o in odd]
        else:
            found = self.words.lookup(words)
        *counts, lines, links = zip(*found) if found else [()] * 5
        counts = [np.array(c, np.int64) for c in counts]
        sums = np.stack([*counts, counts[2] < 0, np.array(odd, bool)])[:, codes]
        sums = np.concatenate([np.zeros((5, 1), np.int64), np.cumsum(sums, axis=1)], axis=1)[:, bounds]
        columns: list[list] = [[] for _ in range(6)]
        for n, (start, end, na, nb, ng, bad, strange) in enumerate(zip(
                bounds.tolist(), bounds[1:].tolist(), *(sums[:, 1:] - sums[:, :-1]).tolist())):
            line = link = b""
            if strange:
                text = texts[n].as_py()
                na, nb, ng, line, link = self._aligned([text], self._whole)[0] if text else BAD
                bad = ng < 0
            elif not bad:
                own = codes[start:end].tolist()
                line, link = b"".join(map(lines.__getitem__, own)), b"".join(map(links.__getitem__, own))
            if bad:
                cells = [0, 0, 0, b"", b"", b""]
            else:
                keys, times = np.unique(np.frombuffer(link, "<u8"), return_counts=True)
                cells = [na, nb, ng, line[:-1], keys.tobytes(), times.astype("<u4").tobytes()]
            for column, cell in zip(columns, cells):
                column.append(cell)
        long, text = pa.int64(), pa.array(columns[3], pa.binary()).cast(pa.string())
        return [*(pa.array(c, long) for c in columns[:3]), text, *(pa.array(c, pa.binary()) for c in columns[4:])]


def align(df: DataFrame, definition: str, model: bytes, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`df` with the alignment of each whole text: `n_a`, `n_b`, `n_groups`, `groups`, and its links as packed distinct id
    pairs (`pairs`, 64-bit: A id times the size of B's vocabulary plus B id) with their `times` (32-bit).

    `groups` is `a1,a2|b1;a3|b2,b3`: the ids of each group.  Special strings in a text are plain text.  A NULL or empty
    text, and one whose bytes B does not keep, has no tokens: zeros and empty values.  Rows never move between tasks;
    rows with equal keys stay separate.  `keep` names the columns of `df` that come back, by default all.
    """
    def make():
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        return worker_state(f"aligner {hash(definition)} {hash(model)}", lambda: Aligner(definition, model)).align
    return add_columns(df, text, ALIGNED, make, limit=4 << 20, keep=keep, arrow=True)


def vocabulary_size(model: bytes) -> int:
    import sentencepiece
    return len(sentencepiece.SentencePieceProcessor(model_proto=model))


def _summed(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, np.bincount(at, np.concatenate(times), len(distinct)).astype(np.int64)


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """(pair, n, best): how often each id pair is linked in the corpus, and whether no pair of its B id is linked more often."""
    schema = pa.schema([("pair", pa.int64()), ("n", pa.int64())])
    short_batches(aligned.sparkSession)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, times, held = [], [], 0
        for batch in batches:
            for pairs, often in zip(batch.column(0), batch.column(1)):
                if pairs.is_valid and len(pairs.as_buffer()):
                    keys.append(np.frombuffer(pairs.as_buffer(), "<u8"))
                    times.append(np.frombuffer(often.as_buffer(), "<u4"))
                    held += len(keys[-1])
                if held >= 2 * HELD:
                    distinct, sums = _summed(keys, times)
                    keys, times, held = [distinct], [sums], len(distinct)
                    if held >= HELD:
                        yield pa.RecordBatch.from_arrays([pa.array(distinct.astype(np.int64)), pa.array(sums)], schema=schema)
                        keys, times, held = [], [], 0
        if keys:
            distinct, sums = _summed(keys, times)
            for i in range(0, len(distinct), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(distinct[i:i + 50_000].astype(np.int64)), pa.array(sums[i:i + 50_000])], schema=schema)

    counts = (aligned.select("pairs", "times").mapInArrow(tally, "pair long, n long")
              .groupBy("pair").agg(F.sum("n").alias("n")))
    counts = cut_lineage(counts)
    top = counts.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("n").alias("top"))  # one row per id of B at most
    return counts.join(F.broadcast(top), F.col("pair") % size_b == F.col("b")).select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def with_link_totals(aligned: DataFrame, counts: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """`aligned` without `pairs` and `times`, with `n_links`, `n_best` (links whose pair is one of its B id's most frequent)
    and `count_sum` (over links, the count of the pair).

    Both inputs must be stored tables.  Pairs are cut by a histogram of their counts, so that at most `frequent` are sent
    to the tasks; a text's other pairs become rows that are joined.  Rows keep their number, whatever their key is.
    """
    spark = aligned.sparkSession
    short_batches(spark)
    step = F.floor(F.log2("n") * 16)  # some hundred steps at most
    histogram = counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()
    total, cut = 0, None
    for row in histogram:
        total += row["count"]
        if total > frequent:
            break
        cut = row["step"]
    rare = total > frequent
    sent = counts.where(step >= cut if cut is not None else F.lit(False)).toArrow()  # at most `frequent` rows
    order = np.argsort(sent.column("pair").to_numpy())
    table = spark.sparkContext.broadcast(tuple(
        np.ascontiguousarray(c[order]) for c in (sent.column("pair").to_numpy(), sent.column("n").to_numpy(), sent.column("best").to_numpy())))
    kept = [c for c in aligned.columns if c not in ("pairs", "times")]
    fields = aligned.select(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(kept)], "pairs", "times")
    names = [f"c{i}" for i in range(len(kept))]
    sums = [("n_links", "long"), ("n_best", "long"), ("count_sum", "long")]
    out = fields.select(*names).schema
    for name, kind in [*sums, ("row", "long"), ("pair", "long"), ("often", "long")]:
        out = out.add(name, kind)
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(out)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        known, n, best = table.value
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            size = batch.num_rows
            lists = batch.column(len(names)), batch.column(len(names) + 1)
            pairs = [np.frombuffer(c.as_buffer() if c.is_valid else b"", "<u8").astype(np.int64) for c in lists[0]]
            times = [np.frombuffer(c.as_buffer() if c.is_valid else b"", "<u4").astype(np.int64) for c in lists[1]]
            owner = np.repeat(np.arange(size), [len(p) for p in pairs])
            pair, often = np.concatenate([*pairs, np.zeros(0, np.int64)]), np.concatenate([*times, np.zeros(0, np.int64)])
            at = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
            hit = known[at] == pair if len(known) else np.zeros(len(pair), bool)
            place, here = at[hit], owner[hit]
            # sums of integers up to 2^53 are exact in double precision
            links = np.bincount(owner, often, size).astype(np.int64)
            good = np.bincount(here, often[hit] * best[place], size).astype(np.int64)
            count = np.zeros(size, np.int64)
            np.add.at(count, here, often[hit] * n[place])
            numbers = row + np.arange(size)
            # a text's own row: its pair is below zero, like no other
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(names))), *map(pa.array, (links, good, count, numbers, -1 - numbers)),
                 pa.nulls(size, pa.int64())], schema=arrow)
            lost = np.flatnonzero(~hit)
            for i in range(0, len(lost), 50_000):
                part = lost[i:i + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.nulls(len(part), f.type) for f in list(arrow)[:len(names)]), *(pa.nulls(len(part), pa.int64()) for _ in sums),
                     pa.array(numbers[owner[part]]), pa.array(pair[part]), pa.array(often[part])], schema=arrow)
            row += size

    rows = fields.mapInArrow(look_up, out)
    if rare:
        rest = counts if cut is None else counts.where(step < cut)
        rows = rows.join(rest, "pair", "left").groupBy("row").agg(
            *[F.first(c, ignorenulls=True).alias(c) for c in names], F.max("n_links").alias("n_links"),
            (F.max("n_best") + F.coalesce(F.sum(F.when(F.col("best"), F.col("often"))), F.lit(0))).alias("n_best"),
            (F.max("count_sum") + F.coalesce(F.sum(F.col("often") * F.col("n")), F.lit(0))).alias("count_sum"))
    return rows.select(*[F.col(c).alias(k) for c, k in zip(names, kept)], *[c for c, _ in sums])
