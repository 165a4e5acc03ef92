"""Token ids as flat binary files: encode, write in key order, memory-map and read back.

A folder holds, for each part k (a range of keys in ascending order):
  part-k.ids      the ids of its documents one after another, unsigned 16 or 32 bit little-endian
  part-k.offsets  documents + 1 unsigned 64-bit offsets into part-k.ids, counted in ids
  part-k.keys     one signed 64-bit key per document (0 for a NULL key; these come first)
  index.json      id width, and for each part its documents, those of them without a key, and `base`, the ids of all parts before it (a prefix sum)
A document starts at base + offset.  Files are written under another name and renamed, so a task that runs twice leaves
one file.  The folder must be a mounted file system that all executors share, since reading maps files into memory.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlens.llm.common import Known, add_columns, batches_of, worker_state
from ledgerlens.llm.ordered import range_bounds, range_of

# Fixed value: the split pattern of vocabularies that are encoded by pieces.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


DISTINCT_MISSES = 0.9  # distinct pieces are mostly rare ones, so many are new in any batch


class Words:
    """Ids of texts by the tokenizers library, for a vocabulary in which white space only separates.

    A text is then the sequence of its pieces between spaces and line ends, and the library encodes a piece once while it is
    remembered.  New pieces go to it many at a time, in one text.  Where such a piece is a word, with marks behind it or
    not, normalising it is lower-casing alone, so it goes to the same model without the library's own normaliser; the
    last id of each word is one that ends a word, which tells the words of the joined text apart.
    """
    MARKS = ".,;:!?%&*#$"  # taken off the end of a piece
    # letters below U+0250 are as NFC has them, and all but U+0130 have a single lower-case letter
    PLAIN = "^[A-Za-zªµºÀ-ÖØ-öø-įı-ɏ]+$"

    def __init__(self, definition: str, suffix: str | None):
        """`suffix` ends the last token of a word; None if the vocabulary is not of this kind (`word_suffix`)."""
        from tokenizers import Tokenizer, pre_tokenizers
        self.whole = Tokenizer.from_str(definition)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.by_piece = suffix is not None
        if self.by_piece:
            self.words = Tokenizer(self.whole.model)
            self.words.pre_tokenizer = pre_tokenizers.Sequence([
                pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            vocab = self.whole.get_vocab(with_added_tokens=False)
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
            self.cores, self.marks = Known(self._cores, 200_000, DISTINCT_MISSES), Known(self._any, 10_000, DISTINCT_MISSES)
            self.pieces = Known(self._any, 100_000, DISTINCT_MISSES)

    def _any(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.whole.encode_batch(texts, add_special_tokens=False)]

    def _cores(self, words: list[str]) -> list[bytes]:
        """Distinct lower-case words of letters."""
        ids = np.array(self.words.encode(" ".join(words), add_special_tokens=False).ids, "<u4")
        ends = [0, *(4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()]
        if len(ends) != len(words) + 1:
            raise RuntimeError("the words of a joined text were not told apart")
        packed = ids.tobytes()
        return [packed[a:b] for a, b in zip(ends, ends[1:])]

    def _distinct(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of distinct pieces: a word and the marks behind it are looked up apart, other pieces whole."""
        core = pc.utf8_rtrim(pieces, characters=self.MARKS)
        plain = pc.match_substring_regex(core, self.PLAIN)
        plain_np = plain.to_numpy(zero_copy_only=False)
        behind = (pc.binary_length(pieces).to_numpy() - pc.binary_length(core).to_numpy()) * plain_np
        first, second = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        found: list[bytes] = [b""]  # entry 0 has no ids

        def enter(column: np.ndarray, where: np.ndarray, cells: pa.Array, known: Known) -> None:
            coded = cells.dictionary_encode()
            column[where] = coded.indices.to_numpy() + len(found)
            found.extend(known.lookup(coded.dictionary.to_pylist()))

        enter(first, plain_np, pc.utf8_lower(core.filter(plain)), self.cores)
        enter(first, ~plain_np, pieces.filter(pc.invert(plain)), self.pieces)
        for size in np.unique(behind[behind > 0]).tolist():
            enter(second, behind == size, pc.utf8_slice_codeunits(pieces.filter(pa.array(behind == size)), -size), self.marks)
        ids, ends = _gathered(found, np.stack([first, second], axis=1).ravel())
        return ids, np.concatenate([[0], ends[1::2]])

    def encode(self, texts: pa.Array, end: list[int] = (), kind: str = "<u4") -> pa.Array:
        """Packed ids of each text, with `end` behind them.  Each distinct piece of the batch is looked up once."""
        texts = pc.fill_null(texts, "")
        if self.by_piece:
            lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
            coded, bounds = lists.flatten().dictionary_encode(), lists.offsets.to_numpy().astype(np.int64)
            codes = coded.indices.to_numpy()
            ids, cuts = self._distinct(coded.dictionary)
        else:
            codes, bounds = np.arange(len(texts)), np.arange(len(texts) + 1)
            ids, ends = _gathered(self._any(texts.to_pylist()), codes)
            cuts = np.concatenate([[0], ends])
        codes = np.insert(codes, bounds[1:], len(cuts) - 1)  # the end is one more piece
        ids, cuts = np.concatenate([ids, np.array(end, "<u4")]), np.append(cuts, len(ids) + len(end))
        bounds += np.arange(len(bounds))
        ids, ends = _spread(ids, cuts[:-1], np.diff(cuts), codes)
        if len(ids) and int(ids.max()) > np.iinfo(np.dtype(kind)).max:
            raise ValueError(f"id {ids.max()} needs more than {np.dtype(kind).itemsize} bytes")
        ids = ids.astype(kind)
        offsets = np.concatenate([[0], ends])[bounds] * ids.itemsize
        return pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(ids)]).cast(pa.binary())


def _gathered(packed: list[bytes], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of packed entries in the order of `codes`, and where each code's ids end."""
    sizes = np.array(list(map(len, packed)), np.int64) // 4
    return _spread(np.frombuffer(b"".join(packed), "<u4"), np.cumsum(sizes) - sizes, sizes, codes)


def _spread(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    each = sizes[codes]
    ends = np.cumsum(each)
    return ids[np.repeat(starts[codes] - (ends - each), each) + np.arange(each.sum())], ends


def encode(df: DataFrame, definition: str, text: str = "text", ids: str = "ids", end_id: int | None = None, width: int = 4,
           keep: list[str] | None = None) -> DataFrame:
    """`df` with `ids`: packed little-endian ids of `width` bytes of each whole text by the tokenizers library, then `end_id`.

    NULL is encoded like an empty text; an id that does not fit is an error.  Other columns pass, or those named in
    `keep`; an input column named like `ids` is replaced.
    """
    end, suffix = [] if end_id is None else [int(end_id)], word_suffix(definition)

    def make():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        words = worker_state(f"tokenizer {hash(definition)}", lambda: Words(definition, suffix))
        return lambda cells: [words.encode(cells, end, f"<u{width}")]

    return add_columns(df, text, f"`{ids}` binary", make, keep=keep, arrow=True)


def word_suffix(definition: str) -> str | None:
    """The suffix that ends a word in a vocabulary that `Words` takes apart, else None: white space only separates words
    of letters, single digits and runs of marks, words are lower-cased, and the last token of a word has the suffix."""
    spec = json.loads(definition)
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    normal = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    split = steps[0] if steps else {}
    apart = (normal == ["NFC", "Replace", "Lowercase"] and [s.get("type") for s in steps] == ["Split", "ByteLevel"]
             and split["behavior"] == "Removed" and split["invert"] and split["pattern"].get("Regex") == WORD_PATTERN
             and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens", [])))
    return spec["model"].get("end_of_word_suffix") if apart else None


def local_folder(folder: str) -> str:
    if folder.startswith("file:"):
        folder = "/" + folder[5:].lstrip("/")
    if "://" in folder:
        raise ValueError(f"{folder} cannot be mapped into memory; name a mounted folder that all executors share")
    return folder


def write(df: DataFrame, folder: str, key: str = "doc_id", ids: str = "ids", width: int = 4,
          bounds: list[int] | None = None, packed_width: int = 4) -> dict:
    """Write packed ids (`packed_width` bytes each) in ascending key order and return the index.

    `bounds` cut the keys into ranges; without them `df` is run once more to draw some, so give those of the documents
    (`range_bounds`) where `df` encodes as it goes.  Rows move once, to a task per range of keys.  Rows with equal keys are in order of their ids; a NULL key is first.
    `width` is the bytes of a stored id; an id that does not fit is an error.  An empty table gives no part.
    """
    target = local_folder(folder)
    bounds = range_bounds(df, key) if bounds is None else bounds
    rows = df.select(range_of(F.col(key), bounds).cast("int").alias("part"), F.col(key).cast("long").alias("key"),
                     F.coalesce(F.col(ids), F.lit(b"")).alias("ids"))
    parts = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ordered = rows.repartition(max(int(parts), 1), "part").sortWithinPartitions("part", "key", "ids")
    summary = pa.schema([("part", pa.int32()), ("documents", pa.int64()), ("nulls", pa.int64()), ("tokens", pa.int64())])
    kind, kind_name = np.dtype(f"<u{width}"), f"u{width}"

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(target, exist_ok=True)
        now = None
        for batch in batches:
            numbers = batch.column("part").to_pylist()
            keys, packed = batch.column("key").to_pylist(), batch.column("ids")
            for n, number in enumerate(numbers):
                if now is None or now.number != number:
                    if now is not None:
                        yield now.close()
                    now = _Part(target, number, kind, f"<u{packed_width}", summary)
                now.add(keys[n], packed[n].as_buffer())
        if now is not None:
            yield now.close()

    found = sorted(tuple(r) for r in ordered.mapInArrow(save, "part int, documents long, nulls long, tokens long").collect())
    index, base = {"ids": kind_name, "parts": []}, 0
    for number, documents, nulls, tokens in found:  # one row per part: at most MOST_RANGES
        index["parts"].append({"part": number, "documents": documents, "nulls": nulls, "tokens": tokens, "base": base})
        base += tokens
    os.makedirs(target, exist_ok=True)
    temporary = f"{target}/index.{uuid.uuid4().hex}"
    with open(temporary, "w") as file:
        json.dump(index, file)
    os.replace(temporary, f"{target}/index.json")
    return index


class _Part:
    """The three files of one part, while they are written."""

    def __init__(self, folder: str, number: int, kind: np.dtype, given: str, summary: pa.Schema):
        self.number, self.kind, self.given, self.summary = number, kind, given, summary
        self.final = f"{folder}/part-{number:05d}"
        self.temporary = f"{self.final}.{uuid.uuid4().hex}"
        self.files = {name: open(f"{self.temporary}.{name}", "wb", 1 << 20) for name in ("ids", "offsets", "keys")}
        self.documents = self.nulls = self.tokens = 0
        self.files["offsets"].write(bytes(8))

    def add(self, key: int | None, packed) -> None:
        ids = np.frombuffer(packed, self.given)
        if len(ids) and int(ids.max()) > np.iinfo(self.kind).max:
            raise ValueError(f"id {ids.max()} needs more than {self.kind.itemsize} bytes")
        self.files["ids"].write(ids.astype(self.kind, copy=False).data)
        self.documents += 1
        self.tokens += len(ids)
        self.files["offsets"].write(self.tokens.to_bytes(8, "little"))
        self.nulls += key is None
        self.files["keys"].write((key or 0).to_bytes(8, "little", signed=True))

    def close(self) -> pa.RecordBatch:
        for name, file in self.files.items():
            file.close()
            os.replace(f"{self.temporary}.{name}", f"{self.final}.{name}")
        return pa.RecordBatch.from_pylist([{"part": self.number, "documents": self.documents, "nulls": self.nulls, "tokens": self.tokens}],
                                          schema=self.summary)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(key, start, ids): every document of a folder, with its ids packed as little-endian 32-bit integers.

    `start` counts the ids of all documents before it.  A task maps the files of its parts and copies a document at a
    time.
    """
    target = local_folder(folder)
    with open(f"{target}/index.json") as file:
        index = json.load(file)
    schema = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])
    kind = np.dtype("<" + index["ids"])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for part in batch.to_pylist():
                name = f"{target}/part-{part['part']:05d}"
                offsets, keys = np.memmap(f"{name}.offsets", "<u8", "r"), np.memmap(f"{name}.keys", "<i8", "r")
                ids = np.memmap(f"{name}.ids", kind, "r") if part["tokens"] else np.zeros(0, kind)
                for n in range(part["documents"]):
                    a, b = int(offsets[n]), int(offsets[n + 1])
                    yield None if n < part["nulls"] else int(keys[n]), part["base"] + a, ids[a:b].astype("<u4").tobytes()

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of(documents(batches), schema, lambda row: len(row[2]))

    names = "part int, documents long, nulls long, tokens long, base long"
    parts = spark.createDataFrame([tuple(p[n] for n in ("part", "documents", "nulls", "tokens", "base")) for p in index["parts"]], names)
    return parts.repartition(max(1, len(index["parts"]))).mapInArrow(load, "key long, start long, ids binary")


def with_crc(df: DataFrame, ids: str = "ids") -> DataFrame:
    """`df` with `ids_crc32`, the unsigned CRC-32 of packed ids; of a NULL that of no ids."""
    return df.withColumn("ids_crc32", F.crc32(F.coalesce(F.col(ids), F.lit(b""))))
