"""Periodic runs against every period tried at every word."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa

from ledgerlens.llm import period_runs as pr, queries as q
from tests.llm.helpers import EDGE, frame

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words):
    """(start, length, period) of maximal stretches with smallest period q and at least max(6, 4 q) words."""
    ids = {w: i for i, w in enumerate(words)}
    codes = np.array([ids[w] for w in words], np.int64)
    n, found = len(words), {}
    for period in range(1, n // 4 + 1):
        same = np.concatenate([[False], codes[:n - period] == codes[period:], [False]])
        edges = np.flatnonzero(np.diff(same.astype(int)))
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - start + period >= max(6, 4 * period):
                found.setdefault((start, end + period), period)  # a multiple of a period has the same ends
    return sorted((s, e - s, p) for (s, e), p in found.items())


def plain_collapsed(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_words(r):
    out = []
    for _ in range(r.randint(0, 5)):
        unit = [r.choice("abc") for _ in range(r.randint(1, 6))]
        out += (unit * r.randint(1, 8))[:r.randint(1, 30)]
    return out


def test_runs_of_random_words():
    r = random.Random(7)
    for _ in range(300):
        docs = [random_words(r) for _ in range(8)]
        words, runs, collapsed = pr._work(pa.array([" ".join(d) for d in docs]))
        assert words.to_pylist() == [len(d) for d in docs]
        for d, got, left in zip(docs, runs.to_pylist(), collapsed.to_pylist()):
            want = plain_runs(d)
            assert [tuple(x.values()) for x in got] == want
            assert left == plain_collapsed(d, want)


def test_long_runs_and_binary_words():
    r = random.Random(8)
    docs = [["w"] * 5_000, [f"w{i % 700}" for i in range(3_000)], [r.choice("ab") for _ in range(1_500)],
            ["x", "y"] * 400 + ["z"] + ["x", "y"] * 400, [f"v{i}" for i in range(2_000)]]
    got = pr._work(pa.array([" ".join(d) for d in docs]))[1].to_pylist()
    assert [[tuple(x.values()) for x in g] for g in got] == [plain_runs(d) for d in docs]


def test_words_are_split_at_ascii_white_space_only():
    texts = [f"a{chr(c)}b  {chr(c)}" for c in [*range(1, 200), 0x2003, 0x3000, 0x85, 0x1F600]] + [None, "", " \n"]
    words, bounds = pr.split_words(pa.array(texts))
    words = words.to_pylist()
    assert [words[a:b] for a, b in zip(bounds, bounds[1:])] == [WORD.findall(t or "") for t in texts]


def test_edges(spark):
    long = "one two three " * 20_000
    rows = EDGE + [(7, long), (7, long), (None, "a a a a a a")]
    df = frame(spark, rows).selectExpr("*", "'mine' as runs", "'mine' as n_words", "'mine' as Collapsed", "'mine' as c0")
    out = pr.periodic_runs(df)
    assert [c for c in df.columns if c.lower() not in ("runs", "n_words", "collapsed")] + ["n_words", "runs", "collapsed"] == out.columns
    got = out.collect()
    assert len(got) == len(rows) and all(r.key == "mine" and r.c0 == "mine" for r in got)
    for r in got:
        words = WORD.findall(r.text or "")
        want = [(0, 60_000, 3)] if r.text == long else plain_runs(words) if len(words) < 1_000 else None
        assert r.n_words == len(words)
        if want is not None:
            assert [tuple(x) for x in r.runs] == want and r.collapsed == plain_collapsed(words, want)
    assert pr.periodic_runs(df.limit(0)).count() == 0


def test_the_query_on_the_test_tables(spark):
    got = {r.doc_id: r for r in q.op12_runs(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(rows)
    digest, edited = (lambda text: hashlib.sha256(text.encode()).hexdigest()), 0
    for row in rows:
        words, h = WORD.findall(row.text or ""), zlib.crc32(str(row.doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            edited += 1
        runs = plain_runs(words)
        top = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        r = got[row.doc_id]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *top)
        assert r.exponent_milli == (top[1] and 1000 * top[1] // top[2])
        assert r.runs_sha256 == digest("".join(f"{s},{n},{p}\n" for s, n, p in runs))
        assert r.collapsed_sha256 == digest(plain_collapsed(words, runs))
    assert edited > 50
