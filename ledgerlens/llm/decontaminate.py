"""Benchmark decontamination by latent semantic retrieval.

  1. Benchmark items are cut into passages of `width` words; their words are the vocabulary.  Document frequencies of
     the vocabulary are counted over all documents.
  2. A randomised SVD of the TF-IDF passages of the items gives the latent space, with a quarter as many directions as
     passages (LEAST_RANK at least).  The matrix is a table of sparse rows; each product with it is a sum of partial
     products per task.
  3. Every window (twice as wide, one `width` after the other) of every document is projected and compared by cosine with
     the item passages, or by its length along a passage, which other words of the window hardly change.  Left out
     before are only items that step 4 cannot count: under PARAPHRASE of their words occur anywhere in the text that it looks at.
  4. For each (document, item) found, the longest common subsequence of words with the text around the window is the
     check.  An item counts as contained from SAME of its words on; from PARAPHRASE on if its answer is there as well.

Items are a stated query set: they are taken in blocks of at most BLOCK items, each searched over all documents, so what
is sent to tasks is bounded.  Documents are never moved, and a document's hits are found in the task that reads it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlens.llm.common import batches_of, short_batches, slices
from ledgerlens.llm.sequences import lcs_length
from ledgerlens.session import cut_lineage

BLOCK = 500  # items searched together, and characters of them
BLOCK_CHARS = 50_000
SVD_TASKS = 2  # the matrix is small; each task sends terms x rank numbers to the driver
WIDTH = 16  # words of a passage; less if the shortest item has fewer
LEAST_RANK, RANK_SHARE = 64, 4  # directions of the latent space: a quarter of the passages, but not fewer than these
EXTRA = 16  # more random directions than the rank
POWERS = 2  # further products with the matrix, for separated directions
NEAR = 0.5  # least cosine in the latent space
WHOLE = 0.95  # of a passage's own length, along it: a window that holds the passage has 1 or more, but for rounding
GROUP = 8  # windows that are compared together
SAME = 0.8
PARAPHRASE = 0.6
ANSWER = 0.8
MARKS = ".,;:!?\"'()[]{}<>|*#$%&_-–—…«»“”„’‘¿¡`~/\\"
SENTENCE = re.compile(r"(?<=[.!?])\s+")
ANSWER_MARK = re.compile(r"\banswer\s*[:=]\s*", re.I)


def words_of(text: str | None) -> list[str]:
    """Lower-case words without the marks around them; a word of marks alone is none."""
    return [w for w in (x.strip(MARKS) for x in (text or "").lower().split()) if w]


def answer_of(text: str) -> list[str]:
    """Words behind the last `answer:`, else of the last sentence."""
    found = ANSWER_MARK.split(text)
    return words_of(found[-1]) if len(found) > 1 else words_of(SENTENCE.split(text.strip())[-1])


@dataclass(frozen=True)
class Queries:
    """A block of items: vocabulary, passages as lists of term numbers, and the words that the check needs."""
    ids: list
    words: list[list[str]]
    answers: list[list[str]]
    vocabulary: dict[str, int]
    passages: list[list[int]]
    owner: np.ndarray
    width: int


def queries(items: list[tuple]) -> Queries:
    """From (item_id, text); items without words are left out."""
    kept = [(i, t, w) for i, t in items if (w := words_of(t))]
    width = max(4, min([WIDTH, *(len(w) for _, _, w in kept)]))
    vocabulary: dict[str, int] = {}
    passages, owner = [], []
    for n, (_, _, words) in enumerate(kept):
        terms = [vocabulary.setdefault(w, len(vocabulary)) for w in words]
        starts = [*range(0, max(1, len(terms) - width + 1), width)]
        if starts[-1] + width < len(terms):
            starts.append(len(terms) - width)
        passages += [terms[s:s + width] for s in starts]
        owner += [n] * len(starts)
    return Queries([i for i, _, _ in kept], [w for _, _, w in kept], [answer_of(t) for _, t, _ in kept], vocabulary,
                   passages, np.array(owner, np.int64), width)


def _terms(text: str | None, vocabulary: dict[str, int]) -> tuple[list[str], np.ndarray]:
    """Words as they stand, and their term numbers (-1 outside the vocabulary); words of marks alone are left out."""
    raw = (text or "").lower().split()
    found = list(map(vocabulary.get, raw))
    if None in found:
        drop = False
        for i, x in enumerate(found):
            if x is None:
                word = raw[i].strip(MARKS)
                raw[i] = word
                drop = drop or not word
                found[i] = vocabulary.get(word, -1)
        if drop:
            found = [x for x, w in zip(found, raw) if w]
            raw = [w for w in raw if w]
    return raw, np.array(found, np.int64)


def _windows(n: int, width: int) -> np.ndarray:
    """Starts of windows of 2 * width words, one every width; a run of width words lies whole inside one of them."""
    return np.arange(0, max(1, n - width), width)


def document_frequencies(docs: DataFrame, vocabulary: dict[str, int], text: str = "text") -> tuple[np.ndarray, int]:
    """Documents that hold each term, and all documents."""
    size = len(vocabulary)
    schema = pa.schema([("counts", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = np.zeros(size + 1, np.int64), 0
        for whole in batches:
            for batch in slices(whole, text, 4 << 20):
                for cell in batch.column(text).to_pylist():
                    held[np.unique(_terms(cell, vocabulary)[1])] += 1  # -1 is the last place
                    total += 1
        held[size] = total
        yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()], pa.binary())], schema=schema)

    partial = docs.select(F.col(text)).mapInArrow(count, "counts binary")
    total = np.frombuffer(_summed(partial, "counts", np.int64), np.int64)
    return (total[:size], int(total[size])) if len(total) else (np.zeros(size, np.int64), 0)


def _summed(partial: DataFrame, column: str, kind: type) -> bytes:
    """Element-wise sum of binary vectors of bounded length: by tasks while there are over 64 of them, then on the driver."""
    schema = pa.schema([(column, pa.binary())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for cell in batch.column(column):
                part = np.frombuffer(cell.as_buffer(), kind)
                held = part.copy() if held is None else held + part
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()], pa.binary())], schema=schema)

    while (tasks := partial.rdd.getNumPartitions()) > 64:
        partial = partial.repartition(-(-tasks // 32)).mapInArrow(add, f"{column} binary")
    cells = [bytes(r[0]) for r in partial.collect()]  # at most 64 vectors of bounded length
    return reduce(lambda a, b: (np.frombuffer(a, kind) + np.frombuffer(b, kind)).tobytes(), cells) if cells else b""


def randomised_svd(rows: DataFrame, idf: np.ndarray, rank: int, seed: int = 42) -> np.ndarray:
    """Leading right singular vectors (terms x rank) of the TF-IDF matrix whose sparse rows are (terms).

    Rows have unit length.  Each round multiplies AᵀA with a narrow matrix: a task sums its own rows, the driver adds
    the sums and makes the directions orthonormal; what moves is terms x (rank + EXTRA) numbers per task.
    """
    size = len(idf)
    width = min(rank + EXTRA, size)
    schema = pa.schema([("part", pa.binary())])
    sc, rows = rows.sparkSession.sparkContext, rows.coalesce(SVD_TASKS)

    def product(directions: np.ndarray) -> np.ndarray:
        sent = sc.broadcast((idf, directions.astype(np.float32)))  # single precision is what moves

        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weight, basis = sent.value
            held = np.zeros(basis.shape, np.float32)
            for batch in batches:
                for terms in batch.column("terms").to_pylist():
                    distinct, times = np.unique(np.array(terms), return_counts=True)
                    x = times * weight[distinct]
                    length = np.linalg.norm(x)
                    if length:
                        x = x / length
                        held[distinct] += np.outer(x, x @ basis[distinct])
            yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()], pa.binary())], schema=schema)

        out = np.frombuffer(_summed(rows.mapInArrow(multiply, "part binary"), "part", np.float32), np.float32)
        sent.destroy()
        return out.reshape(-1, width) if len(out) else np.zeros((size, width), np.float32)

    directions = np.random.default_rng(seed).standard_normal((size, width)).astype(np.float32)
    for _ in range(1 + POWERS):
        directions = np.linalg.qr(product(directions))[0]
        width = directions.shape[1]
    small = (directions.T @ product(directions)).astype(float)
    _, vectors = np.linalg.eigh((small + small.T) / 2)
    return directions @ np.ascontiguousarray(vectors[:, ::-1][:, :rank]).astype(np.float32)


def search(docs: DataFrame, block: Queries, idf: np.ndarray, basis: np.ndarray, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """(key, item, cosine, common, answer) of every pair that passes the checks, for one block of items."""
    term_vectors = idf.astype(np.float32)[:, None] * basis
    passage = np.stack([term_vectors[p].sum(axis=0) for p in block.passages])
    length = np.linalg.norm(passage, axis=1)
    useful = length > 0
    length = length[useful]
    passage = passage[useful] / length[:, None]
    sizes = np.array([len(w) for w in block.words])
    occurs = np.zeros((len(block.vocabulary), len(sizes)), np.float32)  # of each term in each item
    for i, words in enumerate(block.words):
        np.add.at(occurs, ([block.vocabulary[w] for w in words], i), 1)
    told = SimpleNamespace(**vars(block))  # a plain object, so that workers need no class of this package
    sent = docs.sparkSession.sparkContext.broadcast((told, term_vectors, passage, length, block.owner[useful], occurs,
                                                     PARAPHRASE * sizes - 1e-3, int(sizes.max())))
    schema = pa.schema([("key", pa.int64()), ("item", pa.int32()), ("cosine", pa.float64()), ("common", pa.float64()),
                        ("answer", pa.float64())])

    def hits(k, cell) -> Iterator[tuple]:
        q, vectors, passages, lengths, owner, occurs, least, longest = sent.value
        words, terms = _terms(cell, q.vocabulary)
        n, span = len(terms), 2 * q.width
        if not n:
            return
        starts = _windows(n, q.width)
        stops = np.minimum(starts + span, n)
        best: dict[int, tuple] = {}
        for at in range(0, len(starts), GROUP):
            some = starts[at:at + GROUP]
            first, last = int(some[0]), int(stops[at + len(some) - 1])
            there = np.unique(terms[max(0, first - longest):last + longest])
            possible = occurs[there[there >= 0]].sum(axis=0) >= least
            if not possible.any():
                continue
            columns = np.flatnonzero(possible[owner])
            inside = np.flatnonzero(terms[first:last] >= 0)
            distinct, place = np.unique(terms[first + inside], return_inverse=True)
            times = np.zeros((len(some) + 1, len(distinct)), np.float32)  # one row per `width` words; a window is two
            np.add.at(times, (inside // q.width, place), 1)
            z = (times[:-1] + times[1:]) @ vectors[distinct]
            along = z @ passages[columns].T
            cosine = along / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
            for r, c in zip(*np.nonzero((cosine >= NEAR) | (along >= WHOLE * lengths[columns]))):
                item, cos = int(owner[columns[c]]), float(cosine[r, c])
                size = len(q.words[item])
                begin = max(0, int(some[r]) - size)
                region = words[begin:int(stops[at + r]) + size]
                old = best.get(item)
                if old is not None and old[3] == begin:
                    best[item] = (max(cos, old[0]), *old[1:])
                    continue
                common = lcs_length(q.words[item], region) / size
                answer = lcs_length(q.answers[item], region) / max(1, len(q.answers[item]))
                if old is None or (common, answer) > old[1:3]:
                    best[item] = (max(cos, old[0] if old else 0.0), common, answer, begin)
        for item, (cos, common, answer, _) in sorted(best.items()):
            if common >= SAME or (common >= PARAPHRASE and answer >= ANSWER):
                yield k, item, min(cos, 1.0), common, answer

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for whole in batches:
                for batch in slices(whole, "text", 4 << 20):
                    for k, cell in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                        yield from hits(k, cell)
        yield from batches_of(rows(), schema, lambda r: 40)

    found = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(
        run, "key long, item int, cosine double, common double, answer double")
    names = F.array(*[F.lit(i) for i in block.ids])
    return found.select(F.col("key").alias(key), names[F.col("item")].alias("item_id"), "cosine", "common", "answer")


def contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
                 item_text: str = "text") -> DataFrame:
    """(key, item_id, cosine, common, answer): every document with each item that it contains, in no order.

    `common` is the share of the item's words in the longest common subsequence, `answer` the same for its answer.
    NULL or empty texts and items without words give no pair; a repeated item or row gives its pairs again.  Other
    columns are not read.
    """
    spark = docs.sparkSession
    short_batches(spark)
    source = items.select(F.col(item_key).alias("id"), F.col(item_text).alias("text")).where("text is not null")
    n, chars = source.select(F.count("*"), F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()
    blocks = max(-(-n // BLOCK), -(-chars // BLOCK_CHARS))
    narrow = docs.select(F.col(key).cast("long").alias(key), F.col(text).alias(text))
    out = spark.createDataFrame([], f"`{key}` long, item_id long, cosine double, common double, answer double")
    for number in range(blocks):
        part = source.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == number).orderBy("id", "text")
        block = queries([(r["id"], r["text"]) for r in part.toLocalIterator()])
        if not block.ids:
            continue
        seen, total = document_frequencies(narrow, block.vocabulary, text)
        idf = np.log((1 + total) / (1 + seen)) + 0.1
        matrix = cut_lineage(spark.createDataFrame([(p,) for p in block.passages], "terms array<bigint>"))
        rank = max(LEAST_RANK, len(block.passages) // RANK_SHARE)
        basis = randomised_svd(matrix, idf, min(rank, len(block.passages), len(block.vocabulary)))
        out = out.unionByName(search(narrow, block, idf, basis, key, text))
    return out
