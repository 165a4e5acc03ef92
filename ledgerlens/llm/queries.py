"""One registered query per text operator: whole tables, production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerlens.llm import bpe, chat_windows as cw, decontaminate as dc, language_id as li, license_scan as ls, minhash as mh, page_text as pt, period_runs as pr
from ledgerlens.llm import simhash as sh, token_alignment as ta, token_counts as tc, token_files as tf
from ledgerlens.llm import url_filter as uf
from ledgerlens.llm.common import table
from ledgerlens.llm.ordered import range_bounds
from ledgerlens.session import cut_lineage, scratch_path

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_bpe(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return bpe.encode_and_decode(docs, bpe.vocabulary(BYTE_BPE), keep=["doc_id"]).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op2_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return dc.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op3_page_text(spark: SparkSession, sf: str) -> DataFrame:
    return pt.extract(table(spark, sf, "pages")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "lines", "shared")


def op4_token_files(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark)
    docs = table(spark, sf, "documents").select("doc_id", "text")
    encoded = tf.encode(docs, bpe.vocabulary(WORD_BPE), end_id=2, width=2, keep=["doc_id"])
    tf.write(encoded, folder, width=2, bounds=range_bounds(docs, "doc_id"), packed_width=2)
    return tf.with_crc(tf.read(spark, folder)).select(
        F.col("key").alias("doc_id"), "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids_crc32")


def op5_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", li.held_out(F.col("doc_id")).alias("held_out"))
    model = li.fit(docs.where("not held_out"))
    return li.predict(docs, model, keep=["doc_id", "held_out"])


def op6_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    with open(PIECE_BPE, "rb") as file:
        counts = tc.token_counts(table(spark, sf, "documents"), file.read())
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


def op7_minhash(spark: SparkSession, sf: str) -> DataFrame:
    rows = mh.with_next(table(spark, sf, "documents"))
    own = mh.fingerprints(rows.repartition("range"), "text", "sketch")
    order = Window.partitionBy("range").orderBy("guest", F.desc_nulls_last("doc_id"), "text")
    pairs = own.select("*", F.lead("text").over(order).alias("next_text"), F.lead("sketch").over(order).alias("next_sketch"))
    edited = pairs.where("not guest").select("doc_id", F.char_length("text").cast("long").alias("n_chars"), "sketch",
                                             "next_sketch", mh.edited_text(F.col("text"), F.col("next_text")).alias("edited"))
    both = mh.fingerprints(edited, "edited", "edited_sketch")
    return both.select("doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
                       mh.packed(F.col("sketch")).alias("fingerprint"),
                       mh.packed(F.col("edited_sketch")).alias("edited_fingerprint"),
                       mh.likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                       mh.likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))


def op8_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return ls.scan(table(spark, sf, "documents"), ls.known_licenses(spark))


# The rules of the URL query, and words in host names that label a URL as unwanted for the fit.
URL_RULES = ["allow com/", "block example.com/en/", "allow www.example.com/en/", "block net/es/", "block net/fr/"]
UNWANTED_WORDS = ["ads", "adult", "bets", "casino", "gambling", "malware", "phishing", "pills", "porn", "spam", "viagra", "xxx"]


def op9_urls(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url")
    hosted = pages.select("page_id", "url", uf.host_of(F.col("url")).alias("host"), uf.path_of(F.col("url")).alias("path"))
    words = F.split("host", "[^a-z0-9]+")
    labelled = hosted.select("url", F.arrays_overlap(words, F.array(*map(F.lit, UNWANTED_WORDS))).cast("int").alias("blocked"))
    judged = uf.apply_rules(uf.score(hosted, uf.fit_or_base(labelled)), uf.parse_rules(URL_RULES))
    own = F.when(F.col("score") > 0.5, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", own).alias("verdict"), "score")


def op10_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = sh.near_duplicates(table(spark, sf, "documents"), shingle=3, distance=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


# Fixed value: the conversation that the query adds to the table.
ADDED_CONVERSATION, ADDED_TEXT = -7, "</s>[INST] ok [/INST]"


def op11_chat(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(ADDED_CONVERSATION, 0, "user", ADDED_TEXT), (ADDED_CONVERSATION, 1, "assistant", ADDED_TEXT)],
                                  "conv_id long, turn long, role string, text string")
    read = cw.read_back(cw.windows(rows.unionByName(added)))
    lines = F.array_join(F.transform("said", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    told = read.select("conv_id", F.struct("first", F.size("said").alias("n"), lines.alias("lines"), F.array_join("learned", "").alias("learned"),
                                           F.char_length("text").cast("long").alias("chars")).alias("window"))
    # the digest of a conversation needs its whole text in one row; the windows themselves never do
    whole = told.groupBy("conv_id").agg(F.sort_array(F.collect_list("window")).alias("w"), F.sum("window.n").alias("n_turns"),
                                        F.sum("window.chars").alias("formatted_chars"))
    whole = whole.select("conv_id", "n_turns", "formatted_chars", F.array_join("w.lines", "").alias("lines"),
                         F.array_join("w.learned", "").alias("learned"))
    return whole.select("conv_id", "n_turns", F.sha2(F.encode("lines", "UTF-8"), 256).alias("turns_sha256"),
                        F.char_length("learned").cast("long").alias("loss_chars"),
                        F.sha2(F.encode("learned", "UTF-8"), 256).alias("loss_sha256"), "formatted_chars")


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in a tenth of the documents, by a digest of the id, the words from one on repeat a period."""
    digest = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", digest.alias("h"), F.floor(digest / 10).alias("g"))
    rows = rows.withColumn("words", F.when(F.col("h") % 10 == 0, F.filter(
        F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")))
    rows = rows.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    moved = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get(F.col("words"), F.when(
        i >= F.col("a"), F.col("a") + (i - F.col("a")) % F.col("p")).otherwise(i).cast("int")))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))


def op12_runs(spark: SparkSession, sf: str) -> DataFrame:
    docs = with_periodic_tails(table(spark, sf, "documents").select("doc_id", "text"))
    found = pr.periodic_runs(docs, keep=["doc_id"])
    first = F.reduce("runs", F.lit(None).cast("struct<start: long, length: long, period: long>"), lambda best, x: F.when(
        best["length"] >= x["length"], best).otherwise(x))  # runs are by start and period
    lines = F.array_join(F.transform("runs", lambda x: F.concat_ws(",", x["start"], x["length"], x["period"])), "\n")
    return found.withColumn("top", first).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.expr("top.length * 1000 div top.period").alias("exponent_milli"),
        F.sha2(F.encode(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit("")), "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"))


def op13_align(spark: SparkSession, sf: str) -> DataFrame:
    with open(PIECE_BPE, "rb") as file:
        model = file.read()
    aligned = ta.align(table(spark, sf, "documents"), bpe.vocabulary(BYTE_BPE), model, keep=["doc_id"])
    digest = F.when(F.col("n_a") > 0, F.sha2(F.encode("groups", "UTF-8"), 256)).otherwise(F.lit(""))
    stored = cut_lineage(aligned.select("doc_id", "n_a", "n_b", "n_groups", digest.alias("groups_sha256"), "pairs", "times"))
    counts = cut_lineage(ta.pair_counts(stored, ta.vocabulary_size(model)))
    return ta.with_link_totals(stored, counts)


def _license_sql() -> str:
    """The scan in SQL: the same canonical form by nested string functions, and a left join on its digest."""
    def canonical(text: str) -> str:
        pattern = ls.COPYRIGHT_LINE
        out = f"regexp_replace(lower(coalesce({text}, '')), '{pattern}', ' ', 'g')"
        out = f"' ' || trim(regexp_replace({out}, '{ls.NOT_WORD}', ' ', 'g')) || ' '"
        for spelling, usual in ls.SPELLINGS:
            for _ in range(2):
                out = f"replace({out}, ' {spelling} ', ' {usual} ')"
        return f"trim({out})"

    known = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in ls.KNOWN.items())
    return f"""with known as (select sha256({canonical('text')}) as digest, min(license) as license
                              from (values {known}) as k(license, text) group by 1),
                    docs as (select doc_id, sha256({canonical('text')}) as digest from documents)
               select doc_id, digest, license from docs left join known using (digest)"""


def _chat_sql() -> str:
    """The windows by prefix sums and a recursive walk from each window's first turn to the next one's."""
    rest = r"\|im_start\|>|\|im_sep\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>"
    piece = r"\p{L}{1,4}|\p{N}{1,3}|[^\p{L}\p{N} \t\r\n\f]"

    def safe(text: str) -> str:
        return rf"regexp_replace({text}, '([<\[])(\\*)({rest})', '\1\\\2\3', 'g')"

    return f"""with recursive
      given as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
                union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
      safe as (select *, {safe('role')} as head, {safe('text')} as body,
                      row_number() over (partition by conv_id order by turn, role, text) - 1 as i from given),
      told as (select *, len(regexp_extract_all(head, '{piece}')) + len(regexp_extract_all(body, '{piece}')) + 3 as tokens,
                      32 + length(head) + length(body) as chars from safe),
      head as (select conv_id, max(tokens) as tokens, max(chars) as chars from told where i = 0 and role = 'system' group by 1),
      sums as (select t.conv_id, t.i, t.chars, 1024 - coalesce(h.tokens, 0) as spare, sum(t.tokens) over w as until,
                      (sum(t.tokens) over w) - t.tokens as before
               from told t left join head h using (conv_id) where not (t.i = 0 and t.role = 'system')
               window w as (partition by t.conv_id order by t.i)),
      opened as (select a.conv_id, a.i, a.spare, coalesce(min(f.i) filter (a.until - f.before <= a.spare), max(a.i)) as told
                 from sums a join sums f on f.conv_id = a.conv_id and f.i between a.i - 2 and a.i group by a.conv_id, a.i, a.spare),
      bound as (select o.conv_id, o.i, o.told, f.before + o.spare as most
                from opened o join sums f on f.conv_id = o.conv_id and f.i = o.told),
      follow as (select b.conv_id, b.i, b.told, min(s.i) as next from bound b left join sums s
                 on s.conv_id = b.conv_id and s.i > b.i and (s.until > b.most or s.i % 1024 = 0) group by all),
      walk as (select conv_id, min(i) as i from sums group by 1
               union all select w.conv_id, f.next from walk w join follow f on f.conv_id = w.conv_id and f.i = w.i where f.next is not null),
      size as (select w.conv_id, w.i, max(coalesce(h.chars, 0)) + sum(s.chars) as chars
               from walk w join follow f on f.conv_id = w.conv_id and f.i = w.i left join head h on h.conv_id = w.conv_id
               join sums s on s.conv_id = w.conv_id and s.i >= f.told and (f.next is null or s.i < f.next) group by 1, 2),
      total as (select conv_id, sum(chars) as chars from size group by 1),
      whole as (select conv_id, count(*) as n_turns, string_agg(role || chr(10) || text || chr(10), '' order by i) as lines,
                       coalesce(string_agg(text, '' order by i) filter (role = 'assistant'), '') as learned from told group by 1)
      select w.conv_id, n_turns, sha256(lines) as turns_sha256, length(learned) as loss_chars, sha256(learned) as loss_sha256,
             cast(coalesce(t.chars, h.chars) as bigint) as formatted_chars
      from whole w left join total t using (conv_id) left join head h using (conv_id)"""


QUERIES = {"op1_bpe": op1_bpe, "op2_decontaminate": op2_decontaminate, "op3_page_text": op3_page_text,
           "op4_token_files": op4_token_files, "op5_language": op5_language, "op6_token_counts": op6_token_counts,
           "op7_minhash": op7_minhash, "op8_licenses": op8_licenses, "op9_urls": op9_urls, "op10_simhash": op10_simhash, "op11_chat": op11_chat, "op12_runs": op12_runs, "op13_align": op13_align}
ORACLE: dict[str, str] = {"op8_licenses": _license_sql(), "op11_chat": _chat_sql()}
