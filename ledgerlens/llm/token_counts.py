"""Token counts without token ids, for sentence-piece BPE whose pieces hold a space mark only at their start.

A text becomes its space mark and words; no merge crosses from a character to the space mark behind it, so the count of
a text is the sum over its pre-tokens (a run of space marks with the characters up to the next run).
  1. Distinct pre-tokens of the corpus with their frequency (counted per task, then summed).
  2. The pieces of each distinct pre-token, once.
  3. Pre-token frequencies per document, joined to the piece counts and summed.
The join of step 3 is done in place for the most frequent pre-tokens, whose number and length are bounded, and by a
shuffled join for all others, so no row is sent for a word that every document has.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlens.llm.common import batches_of, short_batches, slices, worker_state
from ledgerlens.session import cut_lineage

FREQUENT = 1 << 19  # pre-tokens whose counts are sent to every task; each at most FREQUENT_CHARS characters
FREQUENT_CHARS = 32
HELD = 400_000  # distinct pre-tokens a task holds before it hands on its sums
RUN = re.compile(" +[^ ]*")


def pre_tokens(text: str | None) -> list[str]:
    """Pre-tokens without their first space mark: a word, or spaces and a word after a longer run."""
    if not text:
        return []
    text = text.replace("▁", " ")
    if text[0] == " " or text[-1] == " " or "  " in text:
        return [w[1:] for w in RUN.findall(" " + text)]
    return text.split(" ")


def _pieces(model: bytes):
    def build():
        import sentencepiece
        return sentencepiece.SentencePieceProcessor(model_proto=model)
    processor = worker_state(f"sentencepiece {hash(model)}", build)

    def count(words: list[str]) -> list[int]:
        # the processor puts one space mark in front; the empty word is that mark alone
        alone = len(processor.encode(" ")) and len(processor.encode("a ")) - len(processor.encode("a"))
        return [len(ids) if word else alone for word, ids in zip(words, processor.encode(words, num_threads=1))]
    return count


def distinct_pre_tokens(df: DataFrame, text: str = "text") -> DataFrame:
    """(word, frequency): every distinct pre-token of the corpus."""
    schema = pa.schema([("word", pa.string()), ("frequency", pa.int64())])

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held: Counter = Counter()
        for whole in batches:
            for batch in slices(whole, text, 4 << 20):
                for cell in batch.column(text).to_pylist():
                    held.update(pre_tokens(cell))
                    if len(held) > HELD:
                        yield from held.items()
                        held = Counter()
        yield from held.items()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches_of(tally(batches), schema, lambda row: len(row[0]))

    return (df.select(F.col(text)).mapInArrow(run, "word string, frequency long")
            .groupBy("word").agg(F.sum("frequency").alias("frequency")))


def piece_counts(words: DataFrame, model: bytes) -> DataFrame:
    """`words` (word, frequency) with `pieces`, counted once per distinct pre-token."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _pieces(model)
        for whole in batches:
            for batch in slices(whole, "word"):
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(count(batch.column("word").to_pylist()), pa.int32())],
                    names=["word", "frequency", "pieces"])
    return words.mapInArrow(run, "word string, frequency long, pieces int")


def frequent_words(words: DataFrame, most: int) -> DataFrame:
    """The most frequent of the stored `words` (word, frequency, ...), about `most` at most, chosen without a sort.

    Words are counted per step of a sixteenth of a doubling of the frequency, some hundred rows.  The steps that fit are
    taken whole; of the first that does not, as large a share by hash as still fits.
    """
    step = F.floor(F.log2("frequency") * 16)
    room, whole = most, None
    for row in words.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        if row["count"] > room:
            # two hundredths less than fit, as a share by hash is not exact
            part = (step == row["step"]) & (F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int((1 << 20) * 0.98 * room / row["count"]))
            return words.where(part if whole is None else part | (step >= whole))
        room, whole = room - row["count"], row["step"]
    return words


def token_counts(df: DataFrame, model: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens) of every row, in no order; other columns are not read.

    NULL counts as an empty text: 0 bytes, 0 tokens.  Rows with equal or NULL keys stay separate rows.
    """
    spark = df.sparkSession
    short_batches(spark)
    docs = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    words = cut_lineage(piece_counts(distinct_pre_tokens(docs), model))
    short = words.where(F.length("word") <= FREQUENT_CHARS)
    table = frequent_words(short, FREQUENT).select("word", "pieces").toArrow()  # about FREQUENT rows of FREQUENT_CHARS characters
    sent = spark.sparkContext.broadcast((table.column("word").to_pylist(), table.column("pieces").to_numpy().tobytes()))
    name = cut_name(words)
    schema = pa.schema([("row", pa.int64()), ("key", pa.int64()), ("n_bytes", pa.int64()), ("tokens", pa.int64()),
                        ("word", pa.string()), ("times", pa.int32())])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        from pyspark import TaskContext
        known = worker_state(f"frequent {name}", lambda: dict(zip(
            sent.value[0], np.frombuffer(sent.value[1], np.int32).tolist())))
        row = TaskContext.get().partitionId() << 40
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                for k, cell in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                    counted = list(map(known.get, parts := pre_tokens(cell)))
                    rare: Counter = Counter()
                    if None in counted:
                        rare = Counter([p for p, c in zip(parts, counted) if c is None])
                        counted = [c for c in counted if c is not None]
                    # the document's own row; its word has a space inside, which no pre-token has
                    yield row, k, len((cell or "").encode()), sum(counted), f"row {row}", 0
                    for word, times in rare.items():
                        yield row, None, None, None, word, times
                    row += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches_of(split(batches), schema, lambda r: 40 + len(r[4]))

    rows = docs.mapInArrow(run, "row long, key long, n_bytes long, tokens long, word string, times int")
    return (rows.join(words.select("word", "pieces"), "word", "left")
            .groupBy("row").agg(F.max("key").alias(key), F.max("n_bytes").alias("n_bytes"),
                                F.sum(F.coalesce("tokens", F.lit(0)) + F.coalesce("pieces", F.lit(0)) * F.col("times"))
                                .alias("n_tokens"))
            .drop("row"))


def cut_name(df: DataFrame) -> str:
    """A name of a stored table, for what workers remember of it."""
    return df.inputFiles()[0].rsplit("/", 2)[0] if df.inputFiles() else "empty"
