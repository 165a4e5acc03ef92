"""URL filter: rules for hosts and paths, and gradient-boosted trees on lexical features for all other URLs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.llm.common import quoted
from ledgerlens.operators.evaluate import roc_auc
from ledgerlens.session import broadcast_if_small, cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIT_ROWS = 20_000  # distinct labelled URLs that trees are fitted on, chosen by hash per label; statistics count all rows
SENT_SUFFIXES = 200_000  # so many suffixes or hosts are sent to every task, the most frequent ones; others are joined by a shuffle
LEVELS = 4  # suffixes of so many labels have statistics
PRIOR = 4.0  # pseudo-observations at the overall rate
FEATURES = ["url_length", "host_length", "path_length", "host_depth", "path_depth", "digit_ratio", "host_digit_ratio",
            "mark_ratio", "host_hyphens", "entropy", "parameters", "longest_label",
            *[f"suffix_{i}" for i in range(1, LEVELS + 1)]]


def host_of(url: Column) -> Column:
    """From behind the first `://` to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://` or for NULL."""
    return F.translate(F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """Behind the host to `?`, `#` or the end; empty without `://` or for NULL."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def suffixes(host: Column) -> Column:
    """The host and every domain above it, longest first."""
    labels = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
        F.slice(labels, i, F.size(labels) - i + 1), "."))


@dataclass(frozen=True)
class Rule:
    """`allow` or `block` for a host with its subdomains, and paths that start with `path`."""
    verdict: str
    host: str
    path: str


def parse_rules(lines: Sequence[str]) -> list[Rule]:
    """From lines like `block example.com/en/`."""
    out = []
    for line in lines:
        verdict, target = line.split(" ", 1)
        host, slash, path = target.partition("/")
        out.append(Rule(verdict, host.translate(str.maketrans(UPPER, LOWER)), slash + path))
    return out


def apply_rules(df: DataFrame, rules: Sequence[Rule], host: str = "host", path: str = "path") -> DataFrame:
    """`df` with `rule` and `rule_verdict` of the longest rule that fits (NULL where none does).

    Rules are a small list, sent with the plan; equal rules must agree.
    """
    seen: dict[str, str] = {}
    for r in rules:
        if seen.setdefault(r.host + r.path, r.verdict) != r.verdict:
            raise ValueError(f"{r.host}{r.path} is both allowed and blocked")
    fits = [F.when(((F.col(host) == r.host) | F.endswith(F.col(host), F.lit("." + r.host)))
                   & F.startswith(F.col(path), F.lit(r.path)),
                   F.struct(F.lit(len(r.host + r.path)).alias("n"), F.lit(r.host + r.path).alias("rule"),
                            F.lit(r.verdict).alias("verdict"))) for r in rules]
    best = F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<n:int,rule:string,verdict:string>")
    kept = [c for c in df.columns if c.lower() not in ("rule", "rule_verdict")]
    return df.select(*kept, best.alias("__best")).select(*kept, F.col("__best.rule").alias("rule"),
                                                         F.col("__best.verdict").alias("rule_verdict"))


def lexical(df: DataFrame, url: str = "url") -> DataFrame:
    """`df` with the lexical features of a URL (without suffix statistics) and its host suffixes, as struct `__f`."""
    text = F.lower(F.coalesce(F.col(url), F.lit("")))
    df = df.withColumn("__u", text).withColumn("__host", host_of(F.col(url))).withColumn("__path", path_of(F.col(url)))
    n = F.greatest(F.char_length("__u"), F.lit(1))
    digits = lambda c: F.char_length(F.regexp_replace(c, r"[^0-9]", ""))
    query = F.regexp_extract("__u", r"\?([^#]*)", 1)
    counts = [F.char_length("__u") - F.char_length(F.replace(F.col("__u"), F.lit(x), F.lit("")))
              for x in "abcdefghijklmnopqrstuvwxyz0123456789-._/?=&:%#"]
    entropy = sum(F.when(c > 0, -(c / n) * F.log2(c / n)).otherwise(0.0) for c in counts)
    hn = F.greatest(F.char_length("__host"), F.lit(1))
    cells = {
        "url_length": F.char_length("__u"), "host_length": F.char_length("__host"), "path_length": F.char_length("__path"),
        "host_depth": F.size(F.split("__host", r"\.")), "path_depth": F.size(F.filter(F.split("__path", "/"), lambda x: x != "")),
        "digit_ratio": digits(F.col("__u")) / n, "host_digit_ratio": digits(F.col("__host")) / hn,
        "mark_ratio": F.char_length(F.regexp_replace("__u", r"[\p{L}\p{N}]", "")) / n,
        "host_hyphens": F.char_length(F.regexp_replace("__host", "[^-]", "")), "entropy": entropy,
        "parameters": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))),
        "longest_label": F.array_max(F.transform(F.split("__host", r"\."), lambda x: F.char_length(x))),
    }
    return df.select("*", *[v.cast("double").alias(k) for k, v in cells.items()],
                     suffixes(F.col("__host")).alias("__suffixes")).drop("__u", "__host", "__path")


@dataclass(frozen=True)
class UrlModel:
    """Trees, and (__suffix, __all, __half0, __half1): the share of blocked URLs per host suffix, over all labelled rows
    and over each half of them.  Without labels of both kinds there is only `base` (None without any label)."""
    trees: GBTClassificationModel | None
    rates: DataFrame | None
    base: float | None


def _with_rates(df: DataFrame, table: DataFrame, base: float, rate: Column) -> DataFrame:
    """Add suffix_1 (last label) to suffix_LEVELS; a suffix without statistics has the rate of the one above it."""
    for i in range(1, LEVELS + 1):
        above = F.col(f"suffix_{i - 1}") if i > 1 else F.lit(base)
        named = df.withColumn("__name", F.get(F.col("__suffixes"), F.size("__suffixes") - i))
        df = (named.join(table, named["__name"] == table["__suffix"], "left")
              .withColumn(f"suffix_{i}", F.coalesce(rate, above)).drop("__name", *table.columns))
    return df


def suffix_rates(urls: DataFrame, base: float) -> DataFrame:
    """(__suffix, __all, __half0, __half1) of (url, label, times, half): the suffixes of every host, hosts counted first."""
    def share(rows: Column) -> Column:
        n = F.sum(F.when(rows, F.col("n")))
        return (F.sum(F.when(rows, F.col("bad"))) + PRIOR * base) / (n + PRIOR)

    hosts = urls.groupBy(host_of(F.col("url")).alias("host"), "half").agg(
        F.sum(F.col("label") * F.col("times")).alias("bad"), F.sum("times").alias("n"))
    last = F.slice("every", F.greatest(F.size("every") - (LEVELS - 1), F.lit(1)), LEVELS)  # longer ones are not asked for
    each = hosts.select("half", "bad", "n", suffixes(F.col("host")).alias("every")).select(
        "half", "bad", "n", F.explode(last).alias("__suffix"))
    return each.groupBy("__suffix").agg(
        share(F.lit(True)).alias("__all"), share(F.col("half") == 0).alias("__half0"), share(F.col("half") == 1).alias("__half1"))


def fit(labelled: DataFrame, url: str = "url", label: str = "blocked", rows: int = FIT_ROWS, rounds: int = 20,
        depth: int = 4, seed: int = 42) -> UrlModel:
    """Fit on (url, label), label 1 for blocked; NULL labels are left out.  One kind of label is an error."""
    model = fit_or_base(labelled, url, label, rows, rounds, depth, seed)
    if model.trees is None:
        raise ValueError("labelled URLs of both kinds are needed")
    return model


def fit_or_base(labelled: DataFrame, url: str = "url", label: str = "blocked", rows: int = FIT_ROWS, rounds: int = 20,
                depth: int = 4, seed: int = 42) -> UrlModel:
    """Like `fit`; with labels of one kind or none the model is their share alone.

    Suffix statistics count every labelled row.  Trees are fitted on at most about `rows` distinct URLs, chosen by a hash
    of the URL within each label: half of them of each kind, or all of the rarer kind and more of the other.  A drawn URL
    weighs as many rows as it has, and the URLs of a label together as many as the label has.
    """
    hashed = lambda s: F.xxhash64(F.coalesce("url", F.lit("")), F.lit(s))
    # Trees see the statistics of the half of the URLs that theirs is not in, so that a URL's own label does not explain
    # itself.
    urls = cut_lineage(labelled.select(F.col(url).alias("url"), F.col(label).cast("double").alias("label"))
                       .where("label is not null").groupBy("url", "label").agg(F.count("*").alias("times"))
                       .withColumn("half", F.pmod(hashed(seed + 1), F.lit(2))))
    kinds = {r["label"]: (r["n"], r["times"]) for r in urls.groupBy("label").agg(
        F.count("*").alias("n"), F.sum("times").alias("times")).collect()}  # a row per label
    total = sum(t for _, t in kinds.values())
    base = sum(k * t for k, (_, t) in kinds.items()) / total if total else None
    if len(kinds) < 2:
        return UrlModel(None, None, base)
    rates = broadcast_if_small(suffix_rates(urls, base), SENT_SUFFIXES)
    least = min(n for n, _ in kinds.values())
    part = lambda k: min(kinds[k][0], max(rows // 2, rows - least))
    taken = reduce(lambda a, b: a | b, [(F.col("label") == k) & (F.pmod(hashed(seed), F.lit(n)) < part(k))
                                        for k, (n, _) in kinds.items()])
    drawn = cut_lineage(_with_rates(lexical(urls.where(taken), "url"), rates, base,
                                    F.when(F.col("half") == 0, F.col("__half1")).otherwise(F.col("__half0")))
                        .select("label", "times", *FEATURES))
    held = {r["label"]: r["times"] for r in drawn.groupBy("label").agg(F.sum("times").alias("times")).collect()}
    weight = reduce(lambda e, k: e.when(F.col("label") == k, F.col("times") * (kinds[k][1] / held[k])), held, F)
    trees = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=rounds, maxDepth=depth, seed=seed,
                          stepSize=0.2, maxBins=64, cacheNodeIds=False).fit(VectorAssembler(
                              inputCols=FEATURES, outputCol="features").transform(drawn.withColumn("weight", weight))
                              .select("features", "label", "weight"))
    return UrlModel(trees, rates, base)


def _look_up(rows: DataFrame, key: str, table: DataFrame, sent: int) -> DataFrame:
    """`rows` with the other columns of the stored `table` (__key, __n, ...), which has every key of `rows` once.

    `__n` tells how often a key occurs.  Up to `sent` keys are sent to every task.  Of a larger table the most frequent ones
    are, cut by a histogram of `__n`; only rows of the others are shuffled, so no frequent key is a task of its own.
    """
    step = F.floor(F.log2("__n") * 16)  # some hundred steps at most
    values = lambda part: part.drop("__n").withColumnRenamed("__key", key)
    total, cut = 0, None
    for row in table.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        total += row["count"]
        if total > sent:
            break
        cut = row["step"]
    if total <= sent:
        return rows.join(F.broadcast(values(table)), key)
    frequent = F.broadcast(values(table.where(step >= cut if cut is not None else F.lit(False))))
    rare = values(table.where(step < cut) if cut is not None else table)
    return rows.join(frequent, key).unionByName(rows.join(F.broadcast(frequent.select(key)), key, "left_anti").join(rare, key))


def host_rates(hosts: DataFrame, model: UrlModel) -> DataFrame:
    """(__key, __n, suffix_1 ... suffix_LEVELS) of the stored distinct hosts (__key, __n)."""
    levels = [f"__l{i}" for i in range(1, LEVELS + 1)]
    every = suffixes(F.col("__key"))
    # a host of fewer labels has an empty name with a zero character, like no suffix
    named = hosts.select("*", *[F.coalesce(F.get(every, F.size(every) - i), F.lit("\0")).alias(f"__l{i}") for i in range(1, LEVELS + 1)])
    names = named.select("__n", F.explode(F.array(*levels)).alias("__name")).groupBy("__name").agg(F.sum("__n").alias("__n"))
    rates = model.rates.select("__suffix", "__all")
    table = cut_lineage(names.join(rates, F.col("__name") == rates["__suffix"], "left")
                        .select(F.col("__name").alias("__key"), "__n", F.col("__all").alias("__rate")))
    out, above = named.withColumnsRenamed({"__key": "__host", "__n": "__times"}), F.lit(model.base)
    for i, level in enumerate(levels, 1):
        out = (_look_up(out, level, table, SENT_SUFFIXES).withColumn(f"suffix_{i}", F.coalesce("__rate", above))
               .drop("__rate", level))
        above = F.col(f"suffix_{i}")
    return out.withColumnsRenamed({"__host": "__key", "__times": "__n"})


def score(df: DataFrame, model: UrlModel, url: str = "url", out: str = "score") -> DataFrame:
    """`df` with `out`, the model's probability that a URL is to be blocked: without trees its base rate, NULL without one.

    A column named like `out` is replaced; all others stay, whatever their names.  Suffix statistics are joined to distinct
    hosts, hosts to rows.  Rows are moved only for rare hosts, if there are over SENT_SUFFIXES different ones.
    """
    names = [f"__c{i}" for i in range(len(df.columns))]
    kept = [(c, n) for c, n in zip(names, df.columns) if n.lower() != out.lower()]
    rows = df.select(F.col(quoted(url)).alias("__url"), "*").toDF("__url", *names)
    back = [F.col(c).alias(n) for c, n in kept]
    if model.trees is None:
        return rows.select(*back, F.lit(model.base).cast("double").alias(out))
    hosts = cut_lineage(rows.groupBy(host_of(F.col("__url")).alias("__key")).agg(F.count("*").alias("__n")))
    table = cut_lineage(host_rates(hosts, model))
    cells = lexical(_look_up(rows.withColumn("__site", host_of(F.col("__url"))), "__site", table, SENT_SUFFIXES), "__url")
    ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(cells)
    return model.trees.transform(ready).select(*back, vector_to_array("probability")[1].alias(out))


def domain_of(url: Column) -> Column:
    """The last two labels of the host."""
    labels = F.split(host_of(url), r"\.", -1)
    return F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")


def held_out_auc(labelled: DataFrame, url: str = "url", label: str = "blocked", folds: int = 5, **how) -> float | None:
    """Area under the ROC curve over the domains of one fold of `folds`, of a model fitted on all other domains.

    A domain is held out as a whole, so no statistics of its own labels are known.  None where it has labels of one kind.
    """
    rows = labelled.select(F.col(quoted(url)).alias("url"), F.col(quoted(label)).cast("int").alias("label")).where("label is not null")
    held = F.pmod(F.xxhash64(domain_of(F.col("url"))), F.lit(folds)) == 0
    model = fit_or_base(rows.where(~held), "url", "label", **how)
    tested = cut_lineage(score(rows.where(held), model, out="p").select("label", "p"))
    if tested.select("label").distinct().count() < 2:
        return None
    return roc_auc(tested).first()["auc_roc"]
