"""Token alignment against the two libraries and plain loops."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerlens.llm import bpe, queries as q, token_alignment as ta
from tests.llm.helpers import EDGE, frame

SF = "/root/testdata/sf0.01"
A = Tokenizer.from_file(q.BYTE_BPE)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=q.PIECE_BPE)
MODEL = open(q.PIECE_BPE, "rb").read()
VOCABULARY = bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
ALPHABET = bpe.byte_alphabet()
BYTES_A = {i: bytes(ALPHABET[c] for c in t) for t, i in A.get_vocab(with_added_tokens=False).items() if "<|" not in t}


def bytes_b(i):
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def plain(text):
    """(A ids, B ids, groups): each group as its A ids and its B ids; nothing where the bytes differ."""
    if not text:
        return [], [], []
    a, b, whole = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text), (" " + text).encode()
    parts_a, parts_b = [BYTES_A[i] for i in a], [bytes_b(i) for i in b]
    if b"".join(parts_a) != whole or b"".join(parts_b) != whole:
        return [], [], []
    groups, na, nb, at_a, at_b = [([], [])], 0, 0, 0, 0
    while na < len(a) or nb < len(b):
        if at_a <= at_b:
            groups[-1][0].append(a[na])
            at_a, na = at_a + len(parts_a[na]), na + 1
        else:
            groups[-1][1].append(b[nb])
            at_b, nb = at_b + len(parts_b[nb]), nb + 1
        if at_a == at_b:
            groups.append(([], []))
    return a, b, groups[:-1]


def line(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def links(groups):
    return Counter((a[-1], b[-1]) for a, b in groups)


@pytest.fixture(scope="module")
def aligner():
    return ta.Aligner(VOCABULARY, MODEL)


def random_texts(n, seed):
    r = random.Random(seed)
    alphabet = [*" \n\t'stre<|>  aéñ1２.,!　\x1c\x85", "<|endoftext|>", "'s", " 've", "  ", "</s>", "▁", "😀", "ﬁ", "​", "é"]
    return ["".join(r.choice(alphabet) for _ in range(r.randint(0, 25))) for _ in range(n)]


def test_every_text_is_aligned_as_a_whole(aligner):
    texts = random_texts(3_000, 3) + [None, "", " ", "a" * 5_000, "日本語 " * 500, "x " * 3_000]
    na, nb, ng, lines, pairs, times = (c.to_pylist() for c in aligner.align(pa.array(texts)))
    some = 0
    for n, text in enumerate(texts):
        a, b, groups = plain(text)
        assert (na[n], nb[n], ng[n], lines[n]) == (len(a), len(b), len(groups), line(groups)), text
        got = dict(zip(np.frombuffer(pairs[n], "<u8").tolist(), np.frombuffer(times[n], "<u4").tolist()))
        assert got == {i * len(B) + j: k for (i, j), k in links(groups).items()}
        some += bool(groups)
    assert some > 1_000


def test_doubling_finds_the_groups_of_random_cuts():
    r = random.Random(4)
    for _ in range(300):
        n = r.randint(1, 40)
        cuts = [sorted({*r.sample(range(1, n + 1), r.randint(0, n)), n}) for _ in range(2)]
        group_a, group_b = ta.jump(*(np.array(c) for c in cuts))
        shared = sorted(set(cuts[0]) & set(cuts[1]))
        for ends, groups in zip(cuts, (group_a, group_b)):
            assert [cuts[1][g] for g in groups] == [next(s for s in shared if s >= e) for e in ends]


def check_rows(got, texts):
    """Rows (n_a, n_b, n_groups, n_links, n_best, count_sum) of texts against plain counts."""
    aligned = [plain(t) for t in texts]
    each = [links(groups) for _, _, groups in aligned]
    total = sum(each, Counter())
    top = {}
    for (_, b), n in total.items():
        top[b] = max(n, top.get(b, 0))
    for row, (a, b, groups), own in zip(got, aligned, each):
        assert row == (len(a), len(b), len(groups), sum(own.values()), sum(k for p, k in own.items() if total[p] == top[p[1]]),
                       sum(k * total[p] for p, k in own.items()))


@pytest.mark.parametrize("frequent", [0, 40, 1 << 20])
def test_counts_of_frequent_and_rare_pairs(spark, tmp_path, frequent):
    texts = [t for t in random_texts(400, 9)] + ["the same words again"] * 50
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    ta.align(df, VOCABULARY, MODEL, keep=["doc_id"]).drop("groups").write.parquet(str(tmp_path / "a"))
    stored = spark.read.parquet(str(tmp_path / "a"))
    ta.pair_counts(stored, len(B)).write.parquet(str(tmp_path / "c"))
    out = ta.with_link_totals(stored, spark.read.parquet(str(tmp_path / "c")), frequent)
    rows = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum) for r in out.collect()}
    assert len(rows) == len(texts)
    check_rows([rows[i] for i in range(len(texts))], texts)


def test_edges(spark, tmp_path):
    rows = EDGE + [(None, "a b")] * 2
    df = frame(spark, rows).selectExpr("*", "'mine' as pairs", "'mine' as n", "'mine' as row", "'mine' as often", "'mine' as pair", "'mine' as c1")
    out = ta.align(df, VOCABULARY, MODEL)
    got = out.collect()
    assert len(got) == len(rows) and all(r.key == "mine" and r.often == "mine" and r.c1 == "mine" for r in got)
    assert all(r.groups == line(plain(r.text)[2]) for r in got)
    out.write.parquet(str(tmp_path / "a"))
    stored = spark.read.parquet(str(tmp_path / "a"))
    ta.pair_counts(stored, len(B)).write.parquet(str(tmp_path / "c"))
    for frequent in (0, 1 << 20):
        total = ta.with_link_totals(stored, spark.read.parquet(str(tmp_path / "c")), frequent).collect()
        assert len(total) == len(rows) and all(r.row == "mine" and r.n == "mine" and r.n_links == r.n_groups for r in total)
    empty = stored.limit(0)
    assert ta.with_link_totals(empty, ta.pair_counts(empty, len(B))).count() == 0
    assert ta.align(df.limit(0), VOCABULARY, MODEL).count() == 0


def test_the_query_on_the_test_tables(spark):
    got = {r.doc_id: r for r in q.op13_align(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    check_rows([tuple(got[r.doc_id][c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")) for r in rows],
               [r.text for r in rows])
    for r in rows[::10]:
        text = line(plain(r.text)[2])
        assert got[r.doc_id].groups_sha256 == (hashlib.sha256(text.encode()).hexdigest() if text else "")
