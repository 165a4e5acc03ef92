"""BPE, token files and token counts against the public libraries."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlens.llm import bpe, ordered, queries as q, token_counts as tc, token_files as tf
from tests.llm.helpers import EDGE, frame

BYTE = Tokenizer.from_file(q.BYTE_BPE)
WORD = Tokenizer.from_file(q.WORD_BPE)
PIECE = sentencepiece.SentencePieceProcessor(model_file=q.PIECE_BPE)
MODEL = open(q.PIECE_BPE, "rb").read()


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.vocabulary(q.BYTE_BPE))


def ids_of(packed):
    return np.frombuffer(packed, "<u4").tolist()


def random_texts(n, seed, alphabet):
    r = random.Random(seed)
    return ["".join(r.choice(alphabet) for _ in range(r.randint(0, 30))) for _ in range(n)]


def test_encoding_is_the_library_s(codec):
    alphabet = [*" \n\t'stre<|endoftext|>  aéñ1２.,!　\x1c\x85", "<|endoftext|>", "'s", " 've", "  "]
    texts = random_texts(4_000, 1, alphabet) + [t or "" for _, t in EDGE]
    got = codec.encode(texts)
    want = [e.ids for e in BYTE.encode_batch(texts, add_special_tokens=False)]
    assert [ids_of(p) for p in got] == want
    assert codec.decode(got) == [BYTE.decode(w, skip_special_tokens=False) for w in want]


def test_every_kind_of_character_splits_as_in_the_library(codec):
    texts = [f"a{c}b {c} 1{c}{c}2 \n{c}x" for c in map(chr, [*range(0xD800), *range(0xE000, 0x110000, 61)])]
    want = [e.ids for e in BYTE.encode_batch(texts, add_special_tokens=False)]
    assert [ids_of(p) for p in codec.encode(texts)] == want


def test_one_long_pre_token_and_a_forgotten_cache(codec):
    word = "ab" * 20_000 + "xyz" * 5_000
    assert ids_of(codec.encode([word])[0]) == BYTE.encode(word, add_special_tokens=False).ids
    small = bpe.Codec(bpe.vocabulary(q.BYTE_BPE))
    small.pieces.most = small.pre_tokens.most = 3
    texts = random_texts(200, 2, [*"abc de.f"])
    for t in texts:
        assert small.encode([t]) == codec.encode([t])


def test_segment_tree_merges_like_a_plain_loop():
    r = random.Random(3)
    pairs = [(a, b, 4 + n) for n, (a, b) in enumerate([(0, 1), (1, 1), (4, 2), (0, 0), (7, 4), (5, 3), (6, 6), (2, 3)])]
    merges = bpe.Merges(pairs)

    def plain(ids):
        ids = list(ids)
        while True:
            ranked = [(merges.ranks[p], i) for i, p in enumerate((a << 20 | b) for a, b in zip(ids, ids[1:])) if p in merges.ranks]
            if not ranked:
                return ids
            rank, i = min(ranked)
            ids[i:i + 2] = [int(merges.results[rank])]

    for _ in range(1_500):
        ids = [r.randint(0, 3) for _ in range(r.randint(1, 15))]
        want = plain(ids)
        assert merges.merge(list(ids)) == want
        size = 1 << len(ids).bit_length()
        row = merges.merge_all(np.array([ids + [0] * (size - len(ids))], np.int64), np.array([len(ids)]))[0]
        assert row[row >= 0].tolist() == want


def test_bytes_that_are_no_text_decode_with_replacement(codec):
    half = np.array([codec.byte_ids[0xC3]], "<u4").tobytes()
    assert codec.decode([half, None, b""]) == ["�", "", ""]


def test_encode_and_decode_frames(spark):
    definition = bpe.vocabulary(q.BYTE_BPE)
    df = frame(spark, EDGE)
    rows = bpe.decode(bpe.encode(df, definition), definition).collect()
    assert sorted((repr(r.doc_id), r.decoded) for r in rows) == sorted((repr(k), t or "") for k, t in EDGE)
    assert all(r.score == "mine" for r in rows)
    both = bpe.encode_and_decode(df, definition).collect()
    assert sorted((bytes(r.ids), r.decoded) for r in both) == sorted((bytes(r.ids), r.decoded) for r in rows)
    assert bpe.encode(df.limit(0), definition).count() == 0


def written(spark, rows, folder, **how):
    width = how.pop("shuffled", 4)
    docs = tf.encode(frame(spark, rows), bpe.vocabulary(q.WORD_BPE), end_id=2, width=width)
    index = tf.write(docs, str(folder), width=2, packed_width=width, **how)
    return index, tf.with_crc(tf.read(spark, str(folder))).collect()


def test_token_files(spark, tmp_path, monkeypatch):
    texts = random_texts(300, 4, [*" \n'sAbÉé1２.,<|endoftext|>", "<|endoftext|>", "́"])
    rows = [(i * 7 % 300 - 50, t) for i, t in enumerate(texts)] + [(1_000, EDGE[5][1]), (1_001, None), (1_001, None)]
    monkeypatch.setattr(ordered, "ROWS_PER_RANGE", 40)
    index, got = written(spark, rows, tmp_path / "a")
    assert sorted(map(tuple, got)) == sorted(map(tuple, written(spark, rows, tmp_path / "b", shuffled=2)[1]))
    assert len(index["parts"]) > 3
    start = 0
    by_start = sorted(got, key=lambda r: r.start)
    for (key, text), r in zip(sorted(rows, key=lambda x: x[0]), by_start):
        ids = WORD.encode(text or "", add_special_tokens=False).ids + [2]
        assert (r.key, r.start, ids_of(r.ids), r.ids_crc32) == (key, start, ids, zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(by_start) == len(rows)


def test_token_files_of_no_rows_null_keys_and_wide_ids(spark, tmp_path):
    assert written(spark, [], tmp_path / "none")[1] == []
    _, got = written(spark, [(None, "x"), (0, "y"), (-(1 << 63), "z"), (None, "x")], tmp_path / "nulls")
    assert [(r.key, r.start) for r in sorted(got, key=lambda r: r.start)] == [(None, 0), (None, 2), (-(1 << 63), 4), (0, 6)]
    wide = frame(spark, [(1, "a")]).selectExpr("doc_id", "unhex('00000100') as ids")
    with pytest.raises(Exception, match="more than 2 bytes"):
        tf.write(wide, str(tmp_path / "wide"), width=2)
    with pytest.raises(Exception, match="more than 1 bytes"):
        tf.encode(frame(spark, [(1, "a")]), bpe.vocabulary(q.WORD_BPE), end_id=300, width=1).collect()
    with pytest.raises(ValueError, match="cannot be mapped"):
        tf.write(wide, "hdfs://host/folder")


def test_pieces_are_used_only_where_space_only_separates():
    assert tf.word_suffix(bpe.vocabulary(q.WORD_BPE)) == "</w>" and tf.word_suffix(bpe.vocabulary(q.BYTE_BPE)) is None


def test_pieces_encode_like_whole_texts():
    words = tf.Words(bpe.vocabulary(q.WORD_BPE), "</w>")
    words.pieces.most = words.cores.most = 50
    letters = [t for c in map(chr, range(0x250)) for t in (c, "a" + c, c + ".", "A" + c + "b,")]
    texts = letters + random_texts(3_000, 8, [*" \n'sAbÉé1２.,%$Σσİ\x1c", "<|endoftext|>", "́"]) + [None]
    parts = [pa.array(texts[:1_000]), pa.array(texts[1_000:]), pa.array([], pa.string())]
    want = [WORD.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [ids_of(p) for part in parts for p in words.encode(part).to_pylist()] == want
    short = [p for part in parts for p in words.encode(part, [2, 3], "<u2").to_pylist()]
    assert [np.frombuffer(p, "<u2").tolist() for p in short] == [ids + [2, 3] for ids in want]


def test_other_vocabularies_get_whole_texts(spark):
    rows = tf.encode(frame(spark, EDGE[:5]), bpe.vocabulary(q.BYTE_BPE)).collect()
    assert all(ids_of(r.ids) == BYTE.encode(r.text or "", add_special_tokens=False).ids for r in rows)


def test_pre_tokens_sum_to_the_whole():
    count = tc._pieces(MODEL)
    for text in random_texts(6_000, 5, [*"  ▁a\nbé1\t☃the<s>\x00"]):
        assert sum(count(tc.pre_tokens(text))) == len(PIECE.encode(text)), repr(text)


@pytest.mark.parametrize("frequent", [1, 1 << 19])
def test_token_counts(spark, monkeypatch, frequent):
    monkeypatch.setattr(tc, "FREQUENT", frequent)
    rows = EDGE + [(i, t) for i, t in enumerate(random_texts(100, 6, [*" ab▁éc  the"]))]
    got = sorted((repr(r.doc_id), r.n_bytes, r.n_tokens) for r in tc.token_counts(frame(spark, rows), MODEL).collect())
    assert got == sorted((repr(k), len((t or "").encode()), len(PIECE.encode(t or ""))) for k, t in rows)


def test_frequent_words_are_cut_by_their_histogram(spark):
    rows = [(f"w{i}", 1 + (i % 7) ** 3) for i in range(7_000)] + [("top", 10 ** 12)]
    words = spark.createDataFrame(rows, "word string, frequency long")
    for most in (1, 500, 1_001, 3_500, 7_001, 10_000):
        got = tc.frequent_words(words, most)
        n, least = got.count(), got.agg(F.min("frequency")).first()[0]
        assert 0.9 * min(most, 7_001) - 1 <= n <= 1.05 * most
        assert words.where(F.col("frequency") > least).count() <= n  # whatever is more frequent is there, too
        assert "TakeOrdered" not in got._jdf.queryExecution().executedPlan().toString()
    assert tc.frequent_words(words.limit(0), 5).count() == 0


def test_token_counts_of_no_rows(spark):
    assert tc.token_counts(frame(spark, []), MODEL).count() == 0


def test_vocabulary_files_are_given_by_path():
    assert q.BYTE_BPE == public_tokenizers.path("byte_bpe_50k.json")
