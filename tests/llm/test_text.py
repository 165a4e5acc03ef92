"""Language, decontamination, page text, licenses and URLs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import decontaminate as dc, language_id as li, license_scan as ls, page_text as pt, queries as q
from ledgerlens.llm import sequences as sq, url_filter as uf
from tests.llm.helpers import EDGE, LONG, frame, plan_of

SF = "/root/testdata/sf0.01"


# --- sequences

def test_common_subsequences_are_longest(monkeypatch):
    r = random.Random(3)

    def plain(a, b):
        rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
        return rows[-1][-1]

    for n in range(1_500):
        monkeypatch.setattr(sq, "STORED_BITS", 1 << 28 if n % 2 else 6)
        a, b = ([r.choice(letters) for _ in range(r.randint(0, 14))] for letters in ("abcde", "abcdf"))
        used, rest = sq.lcs_members(a, b), iter(b)
        assert sq.lcs_length(a, b) == plain(a, b) == len(used) and used == sorted(set(used))
        assert all(any(a[i] == y for y in rest) for i in used)


# --- language

@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(documents):
    return li.fit(documents.where(~li.held_out(F.col("doc_id"))))


def test_language_of_held_out_documents(spark, documents):
    rows = q.op5_language(spark, SF).join(documents, "doc_id").where("held_out").collect()
    assert len(rows) > 150 and np.mean([r.lang_pred == r.lang for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_a_fit_repeats(documents, model):
    again = li.fit(documents.where(~li.held_out(F.col("doc_id"))).repartition(7))
    assert all((model.pair_weights[f] == again.pair_weights[f]).all() for f in model.pair_weights)
    assert (model.family_weights == again.family_weights).all()


def test_language_of_edge_rows(spark, model):
    strange = [(20, "😀😀😀"), (21, "🙂 123"), (22, "𝟏𝟐 !"), (23, "\U0010ffff"), (24, "𝒜 𐐀𠀀")]
    got = {r.doc_id: r.lang_pred for r in li.predict(frame(spark, strange), model).collect()}
    assert [got[k] == "und" for k, _ in strange] == [not any(c.isalpha() for c in t) for _, t in strange] == [True] * 4 + [False]
    rows = li.predict(frame(spark, EDGE + [(9, "123 !?"), (10, "…")]), model).collect()
    assert len(rows) == len(EDGE) + 2
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and (r.score == 0.0 if not letters else 0 <= r.score <= 1)
    assert len({(r.lang_pred, r.score) for r in rows if r.doc_id == 2}) == 1
    assert li.predict(frame(spark, []), model).count() == 0


def test_counts_do_not_hang_on_blocks(monkeypatch):
    texts = ["Ab c" * 30, "", None, "été 12 x", LONG[:500], "𝒳𝒴 z"]
    whole = li.trigram_counts(texts, li._letters())
    monkeypatch.setattr(li, "BLOCK", 7)
    assert (li.trigram_counts(texts, li._letters()) == whole).all()
    assert all((li.trigram_counts([t], li._letters())[0] == w).all() for t, w in zip(texts, whole))


def test_one_language_many_languages_and_none(spark):
    one = li.fit(spark.createDataFrame([(1, "abc def", "en")], "doc_id long, text string, lang string"))
    assert li.predict(frame(spark, [(1, "xyz")]), one).first().lang_pred == "en"
    r = random.Random(1)
    letters = {"en": "abcd", "de": "efgh", "nl": "ijkl", "fr": "mnop", "xx": "qrst"}
    rows = [(i, " ".join("".join(r.choices(letters[n], k=5)) for _ in range(8)), n) for i, n in enumerate(list(letters) * 12)]
    many = li.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert many.languages["germanic"] == ["de", "en", "nl"] and many.pair_weights["germanic"].shape[1] == 3
    got = li.predict(spark.createDataFrame(rows, "doc_id long, text string, lang string"), many)
    assert got.where("lang = lang_pred").count() == len(rows)
    none = li.fit(spark.createDataFrame([(1, "abc", None), (2, None, "en"), (3, "1", "de")], "doc_id long, text string, lang string"))
    answer = li.predict(frame(spark, [(1, "xyz")]), none).first()
    assert (answer.lang_pred, answer.score) == ("und", 0.0)


# --- decontamination

def item(r, n):
    return " ".join("".join(r.choices("abcdefghijk", k=r.randint(2, 8))) for _ in range(n)) + "."


def corpus(seed=5):
    r = random.Random(seed)
    items = [(100 + i, item(r, r.choice([6, 16, 30, 60]))) for i in range(12)] + [(200, None), (201, "..."), (100, "")]
    common = item(r, 60).split()
    noise = lambda n: " ".join(r.choices(common, k=n // 2) + item(r, n - n // 2).split())
    docs, want = [], set()
    for i in range(120):
        text = noise(r.choice([1, 40, 300]))
        if i % 5 == 0:
            number, passage = items[i // 5 % 12]
            if i % 10 == 0:
                text = f"{text} {passage.upper()} {noise(50)}"
            else:  # a paraphrase: one word in seven is another one, the ending stays
                words = passage.split()
                words = [w if (n + 1) % 7 or n > len(words) - 3 else "other" for n, w in enumerate(words)]
                text = f"{text} {', '.join(words)} {noise(50)}"
            want.add((i, number))
        docs.append((i, text))
    return docs, items, want


def items_frame(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'mine' as cosine", "'mine' as doc_id")


@pytest.mark.parametrize("block", [500, 4])
def test_planted_items_are_found_and_others_are_not(spark, monkeypatch, block):
    monkeypatch.setattr(dc, "BLOCK", block)
    docs, items, want = corpus()
    rows = dc.contaminated(frame(spark, docs + EDGE), items_frame(spark, items)).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want
    assert all(0 < r.cosine <= 1 and r.common >= 0.6 for r in rows)


def test_items_of_the_test_tables(spark, documents):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    texts = [(r.doc_id, f" {' '.join(dc.words_of(r.text))} ") for r in documents.collect()]
    whole = {(k, b.item_id) for b in bench for k, t in texts if f" {' '.join(dc.words_of(b.text))} " in t}
    assert {(r.doc_id, r.item_id) for r in q.op2_decontaminate(spark, SF).collect()} == whole and whole


def test_whole_items_among_frequent_words_of_a_large_corpus(spark, monkeypatch):
    counted = dc.document_frequencies
    monkeypatch.setattr(dc, "document_frequencies", lambda *a: tuple(300 * x for x in counted(*a)))
    r = random.Random(8)
    usual = [f"usual{i}" for i in range(60)]
    items = [(i, " ".join(r.sample(usual, 15))) for i in range(20)]
    docs = [(i, " ".join(f"other{r.randrange(40)}" for _ in range(37)) + f" {items[i][1]} " + "other1 other2 " * 20) for i in range(20)]
    docs += [(20 + i, " ".join(r.sample(usual, 20) + ["other3"] * 40)) for i in range(60)]
    got = dc.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), items_frame(spark, items)).collect()
    assert {(i, i) for i in range(20)} <= {(x.doc_id, x.item_id) for x in got}
    assert all(x.common >= dc.PARAPHRASE for x in got)


def test_paraphrases_of_short_items_as_by_brute_force(spark):
    r = random.Random(9)
    usual, items, docs = [f"usual{i}" for i in range(500)], [], []
    for i in range(120):
        words = r.sample(usual, 8) + [f"rare{i}x{j}" for j in range(6)]
        r.shuffle(words)
        items.append((i, f"{' '.join(words)}. answer: so{i}"))
    for i in range(1_200):
        words = dc.words_of(items[i % 120][1])
        keep = set(r.sample(range(len(words) - 1), round(len(words) * r.uniform(0.6, 0.8)))) | {len(words) - 1}
        words = [w if n in keep else r.choice(usual) for n, w in enumerate(words)]  # in order, the answer among them
        docs.append((i, " ".join(r.choices(usual, k=30) + (words if i % 3 == 0 else []) + r.choices(usual, k=30))))
    want = set()
    for k, text in docs:
        there = dc.words_of(text)
        for n, t in items:
            own, answer = dc.words_of(t), dc.answer_of(t)
            if len(set(own) & set(there)) >= 0.6 * len(set(own)) and sq.lcs_length(own, there) >= 0.6 * len(own):
                if sq.lcs_length(answer, there) >= 0.8 * len(answer):
                    want.add((k, n))
    got = {(x.doc_id, x.item_id) for x in dc.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), items_frame(spark, items)).collect()}
    assert len(want) >= 400 and got == want


def test_no_documents_or_items(spark):
    docs, items, _ = corpus()
    assert dc.contaminated(frame(spark, docs), items_frame(spark, items[12:])).count() == 0
    assert dc.contaminated(frame(spark, docs), items_frame(spark, [])).count() == 0
    assert dc.contaminated(frame(spark, []), items_frame(spark, items)).count() == 0


def test_singular_vectors_span_the_leading_directions(spark):
    r = random.Random(2)
    rows = [[r.randrange(30) if r.random() < 0.2 else r.randrange(6) for _ in range(10)] for _ in range(200)]
    idf = np.linspace(0.5, 2, 30)
    a = np.zeros((200, 30))
    for i, row in enumerate(rows):
        for t in row:
            a[i, t] += idf[t]
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    want = np.linalg.svd(a, full_matrices=False)[2][:4].T
    frame_ = spark.createDataFrame([(x,) for x in rows], "terms array<bigint>").repartition(70)
    got = dc.randomised_svd(frame_, idf, 4)
    assert np.linalg.svd(want.T @ got)[1].min() > 0.98


def test_answers_and_words():
    assert dc.answer_of("Who did it? Answer: the Butler!") == ["the", "butler"]
    assert dc.answer_of("One two. Three four.") == ["three", "four"]
    assert dc.words_of("A, b -- «c» …") == ["a", "b", "c"] and dc.words_of(None) == []


# --- page text

PAGES = [
    ("<div>a<b>b</b>c</div>x<p>q<br>r", "abc\nx\nq r"),
    ("<article><header><h1>T</h1></header><p>x &amp;amp; y &lt;z&gt;</p><div class='comments'><p>no</p></div>"
     "<aside>no</aside>end</article><p>out", "T\nx &amp; y <z>\nend"),
    ("a < b and c > d", "a < b and c > d"),
    ("<p title='x>y'>ok</p><p class=\"ad\">no</p><nav>m</nav>z", "ok\nz"),
    ("", ""), (None, ""), ("<p>one<p>two<script>if(a<b){}</script>three", "one\ntwo\nthree"),
    ("<body><p>a\xa0 b\n c</p><form><input>no</form></body>", "a b c"),
    ("<section class=comments><article><p>no</p></article></section><main class='with-sidebar'><p>yes", "yes"),
    ("<span class=ad>x<span>y</span>z</span>w", "w"), ("<style>p{}</style><!-- no --><p>cut <a href='x", "cut"),
    ("<article><p>" + "long " * 50_000 + "</p></article>", ("long " * 50_000).strip()),
]


@pytest.mark.parametrize("page,text", PAGES)
def test_lines_of_a_page(page, text):
    lines = pt.text_lines(page)
    assert pt.article([k for k, _ in lines], [t for _, t in lines], None)[0] == text


def site():
    """Pages without <article>: every host repeats its own frame lines around a text of its own."""
    r = random.Random(4)
    pages, want = [], {}
    for n in range(90):
        host = ["hot.example.com", "b.example.com", "c.example.com"][min(2, n // 60 + (n % 20 == 0))]
        own = [f"own line {r.random()}" for _ in range(r.randint(1, 6))]
        lines = [f"{host} top", f"{host} news", *own, f"{host} bottom"]
        pages.append((n, f"http://{host}/{n % 3}/{n}", "".join(f"<div>{x}</div>" for x in lines)))
        want[n] = "\n".join(own)
    return pages, want


@pytest.mark.parametrize("per_range", [4, 1_000])
def test_lines_shared_with_the_nearest_page_go(spark, monkeypatch, per_range):
    monkeypatch.setattr(pt, "ROWS_PER_RANGE", per_range)
    pages, want = site()
    rows = pt.extract(spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit("mine"))).collect()
    assert {r.page_id: r.text for r in rows} == want


def test_copies_of_an_article_stay_and_pages_of_any_kind_pass(spark):
    page = "<nav>menu</nav><article><p>same text</p></article><footer>end</footer>"
    rows = [(i, "http://h.example/a", page) for i in range(3)] + [(None, None, None), (7, "no url", ""), (8, "http://h.example", "<p>x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = pt.extract(df).collect()
    assert sorted((repr(r.page_id), r.text) for r in got) == sorted(
        [(str(i), "same text") for i in range(3)] + [("None", ""), ("7", ""), ("8", "x")])
    assert pt.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("per_range", [4, 1_000])
def test_copies_do_not_take_an_unmarked_article_away(spark, monkeypatch, per_range):
    monkeypatch.setattr(pt, "ROWS_PER_RANGE", per_range)
    own = {n: [f"{n} line {i} of an article that is long enough to be told from its frame" for i in range(9)] for n in range(6)}
    page = lambda lines: "".join(f"<div>{x}</div>" for x in ["top of the host", "menu", *lines, "end of the host"])
    edited = own[2][:4] + ["2 line 4 has been edited"] + own[2][5:]
    rows = [(n, f"http://h.example/{n}", page(own[n])) for n in own]  # the frame is shared by all
    rows += [(100 + i, "http://h.example/1", page(own[1])) for i in range(30)]  # one URL crawled again and again
    rows += [(200, "http://h.example/2/edited", page(edited)), (201, "http://h.example/4/copy", page(own[4]))]
    rows += [(300, "http://twins.example/a", page(own[0])), (301, "http://twins.example/b", page(own[0]))]  # copies only
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = {r.page_id: r.text for r in pt.extract(df).collect()}
    want = {n: own[n] for n in own} | {100 + i: own[1] for i in range(30)} | {200: edited, 201: own[4]}
    want |= {k: ["top of the host", "menu", *own[0], "end of the host"] for k in (300, 301)}
    assert got == {k: "\n".join(v) for k, v in want.items()}


@pytest.mark.parametrize("per_range", [4, 1_000])
def test_a_page_among_many_edited_copies_is_compared_with_a_different_one(spark, monkeypatch, per_range):
    monkeypatch.setattr(pt, "ROWS_PER_RANGE", per_range)
    page = lambda lines: "".join(f"<div>{x}</div>" for x in ["top of the host", "menu", *lines, "end of the host"])
    body = [f"line {i} of an article that is long enough to be told from its frame" for i in range(12)]
    own = {n: [*body, f"edited {n}"] for n in range(100, 140)}  # copies of each other, far more than are put beside a range
    own |= {n: [f"{n} {x}" for x in body] for n in (1, 200)}
    rows = [(n, f"http://h.example/{n:03d}", page(own[n])) for n in own]
    rows += [(n, f"http://only.example/{n}", page(own[n - 200])) for n in range(300, 320)]  # nothing but copies
    got = {r.page_id: r.text for r in pt.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    want = {n: "\n".join(x) for n, x in own.items()}
    want |= {n: "\n".join(["top of the host", "menu", *own[n - 200], "end of the host"]) for n in range(300, 320)}
    assert got == want


def test_one_url_in_many_rows_is_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(pt, "ROWS_PER_RANGE", 10)
    light = spark.createDataFrame([("", "", i) for i in range(200)] + [("", "", None)], "host string, path string, key long")
    bounds = pt._bounds(light)
    assert len(bounds) >= 10 and {b[:2] for b in bounds} == {("", "")}


def test_a_short_article_element_leaves_a_longer_unmarked_body(spark):
    body = [f"sentence {i} of the body" for i in range(5)]
    page = "<article><p>Read this too</p></article>" + "".join(f"<div>{x}</div>" for x in body)
    lines = pt.text_lines(page)
    assert pt.article([k for k, _ in lines], [t for _, t in lines], None)[0] == "\n".join(["Read this too", *body])
    assert pt.article([k for k, _ in lines], [t for _, t in lines], body)[0] == "Read this too"


def test_articles_of_the_test_tables(spark):
    import html
    import re
    got = {r.page_id: r for r in q.op3_page_text(spark, SF).collect()}
    for p in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inside = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        want = "\n".join(b for b in blocks if b)
        assert got[p.page_id].text == want and got[p.page_id].n_chars == len(want)


# --- licenses

def test_spellings_and_marks_of_a_license_do_not_matter(spark):
    mit = ls.KNOWN["MIT"]
    forms = ["MIT License Copyright holder unknown", mit, mit.upper().replace("\n", " "), "Copyright (c) 2020 Someone\n\n" + mit,
             "\t© 1999-2004 A. B.\nAll rights reserved.\n" + mit.replace(",", " ,"), mit.replace("sublicense", "sub-license"),
             mit + " More.", "Licensed under CC BY-NC 4.0", "This work is licenced under the GNU General Public Licence, version 3", "", None, LONG]
    found = {r.doc_id: r.license for r in ls.scan(frame(spark, list(enumerate(forms))), ls.known_licenses(spark)).collect()}
    assert [found[i] for i in range(len(forms))] == [None, *["MIT"] * 5, None, "CC-BY-NC-4.0 notice", "GPL-3.0 notice", None, None, None]


def test_published_license_files_are_known(spark):
    line, apache = "Copyright (c) 2020 X\n\n", ls.KNOWN["Apache-2.0"]
    cases = [("MIT License\n\n" + line + ls.KNOWN["MIT"], "MIT"), ("The MIT License (MIT)\n" + line + ls.KNOWN["MIT"], "MIT"),
             ("ISC License\n\n" + line + ls.KNOWN["ISC"], "ISC"), ("BSD Zero Clause License\n\n" + line + ls.KNOWN["0BSD"], "0BSD"),
             ("BSD 3-Clause License\n\n" + line + "All rights reserved.\n" + ls.KNOWN["BSD-3-Clause"], "BSD-3-Clause"),
             (line + ls.KNOWN["BSD-2-Clause"].replace("1.", "*").replace("2. R", "* R"), "BSD-2-Clause"),
             (ls.KNOWN["Unlicense"].replace("http:", "https:"), "Unlicense"), ("zlib License\n" + line + ls.KNOWN["Zlib"], "Zlib"),
             (apache, "Apache-2.0"), (apache[:apache.index("APPENDIX")], "Apache-2.0"),
             (apache.replace("[yyyy] [name of copyright owner]", "2021 Some One"), "Apache-2.0"),
             *[(ls.KNOWN[n], n) for n in ("MPL-2.0", "GPL-2.0-only", "GPL-3.0-only", "LGPL-2.1-only", "LGPL-3.0-only", "CC0-1.0")],
             ("A text that holds a license line.\n" + ls.KNOWN["MIT notice"], None)]
    found = {r.doc_id: r.license for r in ls.scan(frame(spark, [(i, t) for i, (t, _) in enumerate(cases)]), ls.known_licenses(spark)).collect()}
    assert [found[i] for i in range(len(cases))] == [n for _, n in cases]


def test_scan_of_no_rows_repeated_rows_and_no_licenses(spark):
    known = ls.known_licenses(spark)
    assert ls.scan(frame(spark, []), known).count() == 0
    twice = ls.scan(frame(spark, [(1, ls.KNOWN["ISC"])] * 2 + [(None, "x")]), known.unionByName(known)).collect()
    assert sorted(str(r.license) for r in twice) == ["ISC", "ISC", "None"]
    assert ls.scan(frame(spark, EDGE), known.limit(0)).where("license is not null").count() == 0
    empty = spark.createDataFrame([("nothing", "...")], "license string, text string")
    assert ls.scan(frame(spark, EDGE), empty).where("license is not null").count() == 0


def test_license_scan_runs_no_python(spark):
    plan = plan_of(q.op8_licenses(spark, SF))
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


# --- URLs

URLS = [("http://A.Example.COM/en/1?x=/a#b", "a.example.com", "/en/1"), ("https://net", "net", ""), ("x://é.NET/ES/", "é.net", "/ES/"),
        ("no scheme", "", ""), (None, "", ""), ("a://b://c/d", "b:", "//c/d"), ("http://h?q=http://z/", "h", ""), ("://", "", ""),
        ("http://user@h:80/p", "user@h:80", "/p"), ("http://h/" + "p" * 100_000, "h", "/" + "p" * 100_000)]


def test_hosts_and_paths(spark):
    df = spark.createDataFrame([(u,) for u, _, _ in URLS], "url string")
    rows = df.select(uf.host_of(F.col("url")).alias("h"), uf.path_of(F.col("url")).alias("p")).collect()
    assert [(r.h, r.p) for r in rows] == [(h, p) for _, h, p in URLS]


def test_the_longest_rule_wins(spark):
    cases = [("a.com", "/x", "com/", "allow"), ("com", "/", "com/", "allow"), ("xcom", "/", None, None), ("a.com", "", None, None),
             ("example.com", "/en/1", "example.com/en/", "block"), ("b.example.com", "/en/", "example.com/en/", "block"),
             ("www.example.com", "/en/1", "www.example.com/en/", "allow"), ("m.www.example.com", "/en/", "www.example.com/en/", "allow"),
             ("www.example.com", "/en", "com/", "allow"), ("a.net", "/es/1", "net/es/", "block"), ("a.net", "/de/", None, None), ("", "", None, None)]
    df = spark.createDataFrame([c[:2] for c in cases], "host string, path string").withColumn("rule", F.lit("mine"))
    got = uf.apply_rules(df, uf.parse_rules(q.URL_RULES)).collect()
    assert [(r.host, r.path, r.rule, r.rule_verdict) for r in got] == cases
    assert uf.apply_rules(df, []).where("rule is not null").count() == 0
    with pytest.raises(ValueError):
        uf.apply_rules(df, uf.parse_rules(["allow a/", "block a/"]))


def test_trees_separate_labelled_urls(spark):
    r = random.Random(6)
    rows = []
    for i in range(600):
        bad = i % 3 == 0
        host = f"{'win-' if bad else ''}{'x' * r.randint(3, 9)}{r.randint(0, 9999) if bad else ''}.example.{'biz' if bad else 'org'}"
        rows.append((f"http://{host}/{'a/' * r.randint(1, 4)}{r.randint(0, 99)}{'?p=1&q=2' if bad and r.random() < .5 else ''}", int(bad)))
    train, test = rows[:400], rows[400:]
    model = uf.fit(spark.createDataFrame(train + [(None, 0), ("x", None)], "url string, blocked int"), rounds=5)
    df = spark.createDataFrame(test + [(u, None) for u, _, _ in URLS], "url string, blocked int").withColumn("features", F.lit("mine"))
    got = uf.score(df.drop("features"), model).collect()
    assert len(got) == len(test) + len(URLS) and all(0 <= g.score <= 1 for g in got)
    assert np.mean([(g.score > 0.5) == (g.blocked == 1) for g in got if g.blocked is not None]) > 0.95
    assert uf.score(df.limit(0).drop("features"), model).count() == 0
    with pytest.raises(ValueError):
        uf.fit(spark.createDataFrame([("a", 1), ("b", 1)], "url string, blocked int"))


def test_url_query(spark):
    rows = q.op9_urls(spark, SF).collect()
    assert len(rows) == 250
    for r in rows:
        assert r.verdict == ("allow" if r.rule in ("com/", "www.example.com/en/") else "block" if r.rule else
                             "block" if r.score > 0.5 else "allow")
    unruled = [r for r in rows if r.rule is None]
    assert {r.verdict for r in unruled if any(w in r.host for w in ("casino", "pills", "bets", "spam"))} <= {"block"}


def test_rare_labels_of_a_large_table_and_one_url_in_many_rows(spark):
    rows = [(f"http://h{i}.example.org/{i}", 0) for i in range(3_000)] + [("http://hot.example.org/", 0)] * 1_500
    rows += [(f"http://x.tail{i}.bad/", 1) for i in range(4)]
    df = spark.createDataFrame(rows, "url string, blocked int")
    model = uf.fit(df, rows=200, rounds=3)
    got = dict(map(tuple, model.rates.select("__suffix", "__all").collect()))
    assert model.base == 4 / 4_504 and len(got) == 2 + 3_000 + 1 + 1 + 4 + 4
    assert got["tail3.bad"] == pytest.approx((1 + uf.PRIOR * model.base) / (1 + uf.PRIOR))
    assert got["bad"] == pytest.approx((4 + uf.PRIOR * model.base) / (4 + uf.PRIOR))
    scored = uf.score(df, model).groupBy("blocked").agg(F.avg("score")).collect()
    assert dict(map(tuple, scored))[1] > dict(map(tuple, scored))[0]


def _labelled_urls(n, seed=8):
    """Half of the hosts end in one suffix; unwanted hosts have digits and their own suffix, some of them are wanted."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        bad = i % 4 == 0
        name = f"{r.choice('abcdef')}{i % 97}{r.randint(100, 999) if bad else ''}"
        end = "com" if i % 2 else "top" if r.random() < 0.9 * bad + 0.05 else "org"
        rows.append((f"http://{name}.{end}/{'q?x=1&y=2' if bad else 'page'}", int(bad)))
    return rows + [("http://hot.com/", 0)] * n + [(None, 0), ("", 0), ("no host", 0)]


@pytest.mark.parametrize("sent", [0, 5, 40])
def test_scores_do_not_hang_on_what_is_sent(spark, monkeypatch, sent):
    df = spark.createDataFrame(_labelled_urls(800), "url string, blocked int")
    model = uf.fit(df, rows=400, rounds=4)
    want = sorted(map(repr, uf.score(df, model).collect()))
    monkeypatch.setattr(uf, "SENT_SUFFIXES", sent)
    got = uf.score(df, model)
    assert sorted(map(repr, got.collect())) == want and len(want) == 1_603
    assert uf.score(df.limit(0), model).count() == 0


def test_scores_by_plain_python(spark):
    rows = _labelled_urls(300)
    model = uf.fit(spark.createDataFrame(rows, "url string, blocked int"), rows=300, rounds=4)
    rates, seen = dict(map(tuple, model.rates.select("__suffix", "__all").collect())), {}
    table = uf.cut_lineage(spark.createDataFrame([(h, 1) for h in ("a.b.c.d.e.com", "hot.com", "", "new.top", "x.unseen")], "__key string, __n long"))
    for row in uf.host_rates(table, model).collect():
        labels, rate, want = row["__key"].split("."), model.base, []
        for i in range(1, uf.LEVELS + 1):
            rate = rates.get(".".join(labels[-i:]), rate) if i <= len(labels) else rate
            want.append(rate)
        assert [row[f"suffix_{i}"] for i in range(1, uf.LEVELS + 1)] == pytest.approx(want)
        seen[row["__key"]] = want[-1]
    assert len(seen) == 5 and seen["new.top"] > seen["hot.com"]


def test_scores_of_a_table_with_clashing_names(spark):
    rows = _labelled_urls(200)
    model = uf.fit(spark.createDataFrame(rows, "url string, blocked int"), rows=200, rounds=3)
    plain = spark.createDataFrame(rows, "url string, blocked int")
    clash = ["features", "url_length", "entropy", "probability", "__u", "__key", "__n", "__url", "__c0", "__site", "__rate", "suffix_1",
             "a.b", "prediction", "rawPrediction", "__suffixes", "host"]
    df = plain.select("*", *[F.lit(n).alias(n) for n in clash], F.lit("old").alias("SCORE"))
    got = uf.score(df, model)
    assert got.columns == ["url", "blocked", *clash, "score"]
    out = got.collect()
    assert all(r[n] == n for r in out for n in clash)
    assert sorted(repr((r.url, r.score)) for r in out) == sorted(repr((r.url, r.score)) for r in uf.score(plain, model).collect())
    base = uf.score(df, uf.UrlModel(None, None, 0.25))
    assert base.columns == got.columns and {r.score for r in base.collect()} == {0.25}


def test_domains_are_held_out_as_a_whole(spark):
    df = spark.createDataFrame(_labelled_urls(1_500), "url string, blocked int")
    assert [r[0] for r in spark.createDataFrame([("http://a.b.co.uk/x",), ("http://one/",), (None,)], "u string").select(
        uf.domain_of(F.col("u"))).collect()] == ["co.uk", "one", ""]
    assert uf.held_out_auc(df, rows=1_000, rounds=8) > 0.9  # digits and parameters tell hosts that were never seen
    assert uf.held_out_auc(df.where("blocked = 0")) is None


@pytest.mark.parametrize("words,verdict", [([], "allow"), (["www", "h"], "block")])
def test_url_query_without_labels_of_both_kinds(spark, monkeypatch, tmp_path, words, verdict):
    monkeypatch.setattr(q, "UNWANTED_WORDS", words or ["none-such"])
    rows = [(1, "http://h.www.org/1"), (2, "http://www.com/"), (3, "http://h.net/es/1"), (4, "http://www/")]
    spark.createDataFrame(rows, "page_id long, url string").write.parquet(str(tmp_path / "a" / "pages.parquet"))
    assert {r.page_id: r.verdict for r in q.op9_urls(spark, str(tmp_path / "a")).collect()} == {1: verdict, 2: "allow", 3: "block", 4: verdict}
    spark.createDataFrame([], "page_id long, url string").write.parquet(str(tmp_path / "b" / "pages.parquet"))
    assert q.op9_urls(spark, str(tmp_path / "b")).count() == 0
