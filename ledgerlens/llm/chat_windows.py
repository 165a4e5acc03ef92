"""Conversations as budgeted training windows: DataFrame functions only.

The turns of a conversation are in order of (turn, role, hash of the text), NULL first.  Each is formatted between marks

    <|im_start|>role<|im_sep|>text<|im_end|>

and control strings inside a role or a text get a backslash behind their first character (one more, if they have some),
so a mark in the output is always a mark and `unescaped` gives back every text.

Prefix sums of the formatted turns' tokens choose the windows: a window takes turns while its tokens stay within the
budget, and the next one starts behind it.  It repeats the system turn (a conversation's first turn, if its role is
`system`) and, as far as they fit, the last `history` turns before its own.  Turns are never cut or dropped: a turn
longer than the budget has a window to itself, without history.  After every `block` turns a new window starts, so a
conversation of any length is cut into blocks that are worked on apart.  The loss mask covers the texts of assistant
turns where they are new; repeated ones are masked out.

A conversation of more than `large` turns is never gathered: its turns are numbered by one range sort of the large
conversations' rows, and its blocks are grouped one by one.  All other conversations are one group each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.session import broadcast_if_small, cut_lineage

# The marks of the template, and strings that mark turns in public chat templates.
START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL = ["<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
# A token is about four letters, three digits, or one mark.
PIECE = r"\p{L}{1,4}|\p{N}{1,3}|[^\p{L}\p{N} \t\r\n\f]"

BUDGET, HISTORY, BLOCK, LARGE = 1024, 2, 1024, 8192


def _quoted(string: str) -> str:
    return "".join("\\" + c if c in "|[]/<>" else c for c in string)


_REST = "|".join(_quoted(c[1:]) for c in CONTROL)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({_REST})", r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({_REST})", "$1$2$3")


def estimated_tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(PIECE)).cast("long")


def formatted_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                    tokens: str | None = None) -> DataFrame:
    """(conv, at, role, body, tokens): each turn with its place in the order, escaped, and its tokens.

    NULL text and role are empty.  `tokens` names a column of counts that was made elsewhere; without it they are
    estimated, the three marks counting one token each.
    """
    rows = df.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"),
                     F.coalesce(F.col(role), F.lit("")).alias("said_by"), F.coalesce(F.col(text), F.lit("")).alias("said"),
                     (F.lit(None) if tokens is None else F.col(tokens)).cast("long").alias("counted"))
    rows = rows.select("conv", F.struct("turn", "said_by", F.xxhash64("said").alias("hash")).alias("at"),
                       F.col("said_by").alias("role"), escaped(F.col("said_by")).alias("head"),
                       escaped(F.col("said")).alias("body"), "counted")
    return rows.select("conv", "at", "role", "head", "body",
                       F.coalesce("counted", estimated_tokens(F.col("head")) + estimated_tokens(F.col("body")) + 3).alias("tokens"))


def windows(df: DataFrame, budget: int = BUDGET, history: int = HISTORY, conv: str = "conv_id", turn: str = "turn",
            role: str = "role", text: str = "text", tokens: str | None = None, block: int = BLOCK, large: int = LARGE) -> DataFrame:
    """(conv, first, turns, repeated, n_tokens, text, loss): one row per window, in no order.

    `first` numbers the window's first new turn in its conversation from 0; of its `turns`, the first `repeated` ones
    occur in an earlier window.  `loss` lists (start, length), in code points of `text`, of what is trained on.
    A conversation with a NULL id is one like others; repeated rows are turns like others; without rows there is no window.
    Columns of `df` that are not named are not read.
    """
    if block < history + 2 or large < block:
        raise ValueError("a block must hold the history and two more turns, and a gathered conversation at least a block")
    rows = formatted_turns(df, conv, turn, role, text, tokens)
    sizes = df.groupBy(F.col(conv).alias("conv")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > large)
    long_ones = broadcast_if_small(sizes.select("conv"))
    blocks = _whole(rows.join(long_ones, rows["conv"].eqNullSafe(long_ones["conv"]), "left_anti"), block, history)
    if long_ones.head(1):
        blocks = blocks.unionByName(
            _cut(rows.join(long_ones, rows["conv"].eqNullSafe(long_ones["conv"]), "left_semi"), block, history))
    return _packed(blocks, budget, history, block).withColumnRenamed("conv", conv)


_TURN = ("role", "head", "body", "tokens")


def _turn(x: Column) -> Column:
    return F.struct(*[x[c].alias(c) for c in _TURN])


def _whole(rows: DataFrame, block: int, history: int) -> DataFrame:
    """(conv, block, system, before, turns) of conversations that are gathered whole: the system turn, the last turns
    before the block, and the block's own turns without the system turn."""
    told = rows.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("at", *_TURN))).alias("all"))
    numbers = F.sequence(F.lit(0), F.floor((F.size("all") - 1) / block).cast("int"))
    cut = told.select("conv", "all", F.explode(numbers).alias("block"))
    start, first = F.col("block") * block, F.col("all")[0]
    headed = (first["role"] == "system") & (F.col("block") == 0)
    return cut.select(
        "conv", F.col("block").cast("long").alias("block"), F.when(first["role"] == "system", _turn(first)).alias("system"),
        F.transform(F.slice("all", F.greatest(start - history, F.lit(0)) + 1, F.least(start, F.lit(history))), _turn).alias("before"),
        F.transform(F.slice("all", start + F.when(headed, 2).otherwise(1), F.lit(block) - headed.cast("int")), _turn).alias("turns"))


def _cut(rows: DataFrame, block: int, history: int) -> DataFrame:
    """The same for long conversations.  Rows are sorted by ranges; a conversation's place in a range is the count of its
    rows in earlier ranges, one small row per conversation and range, so no task sees a whole conversation."""
    numbered = cut_lineage(rows.withColumn("tie", F.monotonically_increasing_id()))  # identical rows are split, too
    order = ["conv", "at", "tie"]
    placed = cut_lineage(numbered.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("row", F.monotonically_increasing_id()))
    placed = placed.withColumn("part", F.shiftright("row", 33))
    parts = placed.groupBy("conv", "part").agg(F.min("row").alias("least"), F.count(F.lit(1)).alias("n"))
    earlier = parts.selectExpr("conv as of", "part as in", "least", "sum(n) over (partition by conv order by part) - n as offset")
    lowest = broadcast_if_small(earlier)
    ranked = placed.join(lowest, F.col("conv").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in"))).select(
        "conv", (F.col("offset") + F.col("row") - F.col("least")).alias("rank"), *_TURN)
    own = F.floor(F.col("rank") / block)
    # a block's last turns are told to the next one, too
    both = F.when(F.col("rank") % block >= block - history, F.array(own, own + 1)).otherwise(F.array(own))
    first = (F.col("rank") == 0) & (F.col("role") == "system")
    told = (ranked.where(~first).withColumn("block", F.explode(both))
            .groupBy("conv", "block").agg(F.sort_array(F.collect_list(F.struct("rank", *_TURN))).alias("all")))
    start = F.col("block") * block
    told = told.select("conv", "block", F.transform(F.filter("all", lambda x: x["rank"] < start), _turn).alias("before"),
                       F.transform(F.filter("all", lambda x: x["rank"] >= start), _turn).alias("turns"))
    system = broadcast_if_small(ranked.where(first).select(F.col("conv").alias("of"), F.struct(*_TURN).alias("system")))
    return (told.where(F.size("turns") > 0).join(system, F.col("conv").eqNullSafe(F.col("of")), "left")
            .select("conv", "block", "system", "before", "turns"))


def _packed(blocks: DataFrame, budget: int, history: int, block: int) -> DataFrame:
    """Windows of each block.  Steps are columns of their own, so that each is computed once per row."""
    step = blocks.withColumn("ahead", F.size("before")).withColumn("row", F.concat("before", "turns"))
    # `sums` has at i the tokens of the turns before i
    step = step.withColumn("sums", F.aggregate("row", F.array(F.lit(0).cast("long")), lambda acc, x: F.concat(
        acc, F.array(F.element_at(acc, -1) + x["tokens"]))))
    step = step.withColumn("spare", F.lit(budget).cast("long") - F.coalesce(F.col("system")["tokens"], F.lit(0)))
    at = lambda i: F.get(F.col("sums"), i)

    def opened(i: Column) -> Column:
        """The window that turn i opens: its own first turn, the first one it tells, and the sum that it may reach."""
        told = F.filter(F.sequence(F.greatest(i - history, F.lit(0)), i), lambda f: at(i + 1) - at(f) <= F.col("spare"))
        return F.coalesce(F.array_min(told), i)

    def taken(acc: Column, i: Column) -> Column:
        start = F.struct(i.alias("at"), opened(i).alias("from"))
        return F.when(at(i + 1) <= acc["most"], acc).otherwise(F.transform(F.array(start), lambda s: F.struct(
            F.concat(acc["found"], F.array(s)).alias("found"), (at(s["from"]) + F.col("spare")).alias("most")))[0])

    nothing = F.struct(F.array().cast("array<struct<at:int,from:int>>").alias("found"), F.lit(None).cast("long").alias("most"))
    numbers = F.sequence(F.col("ahead"), F.size("row") - 1)
    step = step.withColumn("starts", F.when(F.size("turns") == 0, F.array(F.struct(F.col("ahead").alias("at"), F.col("ahead").alias("from"))))
                           .otherwise(F.aggregate(numbers, nothing, taken, lambda acc: acc["found"])))
    step = step.select("conv", "block", "system", "ahead", "row", "sums", F.posexplode(F.transform("starts", lambda s, n: F.struct(
        s["at"].alias("at"), s["from"].alias("from"),
        F.coalesce(F.get(F.col("starts"), n + 1)["at"], F.size("row")).alias("until")))).alias("n", "one"))
    one, headed = F.col("one"), F.col("system").isNotNull()
    first = (F.col("block") == 0) & (F.col("n") == 0)
    step = step.select(
        "conv", F.when(first, F.lit(0)).otherwise(F.col("block") * block + one["at"] - F.col("ahead") + (
            headed & (F.col("block") == 0)).cast("int")).cast("long").alias("first"),
        F.concat(F.when(headed, F.array("system")).otherwise(F.array().cast(step.schema["row"].dataType)),
                 F.slice("row", one["from"] + 1, one["until"] - one["from"])).alias("told"),
        (one["at"] - one["from"] + (headed & ~first).cast("int")).alias("repeated"),
        (at(one["until"]) - at(one["from"]) + F.coalesce(F.col("system")["tokens"], F.lit(0))).alias("n_tokens"))
    step = step.withColumn("texts", F.transform("told", lambda t: F.concat(
        F.lit(START), t["head"], F.lit(SEPARATOR), t["body"], F.lit(END))))
    step = step.withColumn("offsets", F.aggregate("texts", F.array(F.lit(0)), lambda acc, x: F.concat(
        acc, F.array(F.element_at(acc, -1) + F.char_length(x)))))
    spans = F.transform("told", lambda t, i: F.when((i >= F.col("repeated")) & (t["role"] == "assistant"), F.struct(
        (F.get(F.col("offsets"), i) + len(START) + F.char_length(t["head"]) + len(SEPARATOR)).alias("start"),
        F.char_length(t["body"]).alias("length"))))
    return step.select("conv", "first", F.size("told").alias("turns"), "repeated", "n_tokens",
                       F.array_join("texts", "").alias("text"), F.filter(spans, lambda s: s.isNotNull()).alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """`formatted` with `said` and `learned`, read from its text: (role, text) of each new turn, and each text under the
    loss mask, both with control strings as they were."""
    step = formatted.withColumn("__parts", F.slice(F.split("text", _quoted(START)), F.col("repeated") + 2, F.col("turns")))
    body = lambda p: F.substring_index(p, SEPARATOR, -1)
    return step.withColumn("said", F.transform("__parts", lambda p: F.struct(
        unescaped(F.substring_index(p, SEPARATOR, 1)).alias("role"),
        unescaped(F.substr(body(p), F.lit(1), F.char_length(body(p)) - len(END))).alias("text")))).withColumn(
        "learned", F.transform("loss", lambda s: unescaped(F.substr(F.col("text"), s["start"] + 1, s["length"])))).drop("__parts")
