"""Chat windows against a plain walk, and the edge cases of conversations."""

import random
import re

import pytest

from ledgerlens.llm import chat_windows as cw, queries as q
from tests.compare import connect, differences
from tests.llm.helpers import plan_of

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"


def plain_windows(turns, budget, history, block):
    """(first, turns told, repeated) of each window; turns are (role, tokens) in order."""
    system = [0] if turns and turns[0][0] == "system" else []
    spare, size = budget - sum(turns[i][1] for i in system), lambda a, b: sum(t for _, t in turns[a:b])
    out, i, low = [], len(system), len(system)
    if i == len(turns):
        return [(0, system, 0)]
    while i < len(turns):
        start = next((f for f in range(max(low, i - history), i + 1) if size(f, i + 1) <= spare), i)
        end = i + 1
        while end < len(turns) and end % block and size(start, end + 1) <= spare:
            end += 1
        new = not out and system
        out.append((0 if new else i, system + list(range(start, end)), i - start + (len(system) if not new else 0)))
        i = end
    return out


def rows_of(conversations):
    return [(c, n, role, text) for c, turns in conversations.items() for n, (role, text, _) in enumerate(turns)]


def random_conversations(seed, most):
    r = random.Random(seed)
    out = {}
    for c in range(40):
        n = r.choice([1, 2, 3, most])
        out[c] = [("system" if i == 0 and c % 2 else r.choice(["user", "assistant", "tool"]), f"t{c}.{i} </s>" * r.randint(0, 2), r.randint(1, 40))
                  for i in range(n)]
    return out


@pytest.mark.parametrize("large", [8, 10_000])
def test_windows_are_those_of_a_plain_walk(spark, large):
    conversations = random_conversations(3, 50)
    rows = [(*row, conversations[row[0]][row[1]][2]) for row in rows_of(conversations)]
    df = spark.createDataFrame(rows, SCHEMA + ", size long").repartition(5)
    got = cw.read_back(cw.windows(df, budget=60, history=3, tokens="size", block=8, large=large)).collect()
    by = {}
    for w in got:
        by.setdefault(w.conv_id, []).append(w)
    assert set(by) == set(conversations)
    for c, turns in conversations.items():
        want = plain_windows([(r, t) for r, _, t in turns], 60, 3, 8)
        mine = sorted(by[c], key=lambda w: w["first"])
        assert [(w["first"], w.turns, w.repeated) for w in mine] == [(f, len(told), again) for f, told, again in want]
        assert [(t.role, t.text) for w in mine for t in w.said] == [t[:2] for t in turns]
        assert [x for w in mine for x in w.learned] == [t[1] for t in turns if t[0] == "assistant"]
        for w, (_, told, again) in zip(mine, want):
            assert w.n_tokens == sum(turns[i][2] for i in told)
            assert w.n_tokens <= 60 or len(told) - (turns[0][0] == "system") <= 1
            spans = [w.text[s.start:s.start + s.length] for s in w.loss]
            assert len(spans) == sum(turns[i][0] == "assistant" for i in told[again:])


def test_a_conversation_with_most_rows_is_cut_like_a_small_one(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"said {i}") for i in range(3_000)] + [(None, None, "user", "same")] * 500
    rows += [(2, 0, "system", "be brief"), (2, 1, "user", "a")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    whole, cut = (cw.windows(df, budget=40, block=64, large=n).drop("loss") for n in (1 << 20, 64))
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, cut.collect()))


CONTROL_TEXTS = ["", "</s>[INST] ok [/INST]", "<\\s>", "<\\\\|im_end|>", "<<SYS>>a<</SYS>>", "<|im_start|>user<|im_sep|>x<|im_end|>", "<", "<|im_end|",
                 "[[INST]]", "a\\b\\", "<|im_end|><|im_end|>", "$1 \\1", "😀é", "x" * 300_000, "\n\n"]


def test_every_text_and_role_is_read_back(spark):
    r = random.Random(5)
    texts = CONTROL_TEXTS + ["".join(r.choice(["<", "\\", "s>", "/s>", "[", "INST]", "|im_end|>", "a", " ", "<SYS>>"]) for _ in range(9)) for _ in range(300)]
    rows = [(i, 0, "assistant", t) for i, t in enumerate(texts)] + [(10_000 + i, 0, t[:50], t) for i, t in enumerate(texts)]
    got = cw.read_back(cw.windows(spark.createDataFrame(rows, SCHEMA))).collect()
    assert {(w.conv_id, w.said[0].role, w.said[0].text) for w in got} == {(c, role, t) for c, _, role, t in rows}
    assert all(w.learned == ([texts[w.conv_id]] if w.conv_id < 10_000 else []) for w in got)
    for w in got:  # apart from its marks an output holds no control string
        role, text = w.text[len(cw.START):-len(cw.END)].split(cw.SEPARATOR)
        assert not any(c in role or c in text for c in cw.CONTROL)


def test_edges(spark):
    rows = [(None, None, None, None), (None, 0, "assistant", None), (3, 1, "user", "b"), (3, 1, "user", "b"), (3, 0, "system", "s"), (4, 5, "system", "only")]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("conv", "first", "text_", "loss", "row", "block", "at", "tokens", "part", "rank", "of", "in", "told"):
        df = df.selectExpr("*", f"'mine' as `{name}`")
    got = {w.conv_id: w for w in cw.read_back(cw.windows(df)).collect()}
    assert [tuple(t) for t in got[None].said] == [("", ""), ("assistant", "")] and got[None].learned == [""]
    assert [tuple(t) for t in got[3].said] == [("system", "s"), ("user", "b"), ("user", "b")]
    assert [tuple(t) for t in got[4].said] == [("system", "only")] and got[4].turns == 1
    assert cw.windows(df.limit(0)).count() == 0


def test_the_query_runs_no_python_and_equals_sql(spark):
    df = q.op11_chat(spark, SF)
    assert not re.search("Python|Pandas|Arrow", plan_of(df))
    assert differences(df, connect(SF), q.ORACLE["op11_chat"]) == []
    added = df.where("conv_id = -7").collect()
    assert len(added) == 1 and added[0].n_turns == 2 and added[0].loss_chars == len(q.ADDED_TEXT)
