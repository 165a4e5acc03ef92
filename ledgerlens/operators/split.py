"""Seeded stratified splits with exact per-class sizes, imbalance measures and class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerlens import schema
from ledgerlens.functions.scalar import key_hash, ratio

# Imbalance above which each method applies, its minority/majority target and neighbour counts.
STRATEGIES = [("borderline_smote", 300, 0.03, 3, 5), ("adasyn", 150, 0.05, 3, None),
              ("smote_tomek", 100, 0.08, 5, None), ("smote", None, 0.15, 5, None)]


def cut_points(keys: DataFrame, ranks: DataFrame) -> DataFrame:
    """The (h, id) found at given ranks of each group, without sorting the groups.

    keys: (grp, h, id) with a 31-bit hash h.  ranks: (grp, cut, pos), a few rows.  A histogram of the top 16 hash
    bits finds the bucket that holds each rank; only that bucket, about 1/65536 of a group, is ordered.
    """
    return keys.sparkSession.sql("""
        with hist as (select grp, shiftright(h, 15) as b, count(*) as n from {keys} group by grp, shiftright(h, 15)),
        run as (select grp, b, n, sum(n) over (partition by grp order by b
                                               rows between unbounded preceding and current row) as c from hist),
        cell as (select r.grp, r.cut, run.b, r.pos - (run.c - run.n) as within
                 from {ranks} r join run on run.grp = r.grp and run.c >= r.pos and run.c - run.n < r.pos)
        select grp, cut, h, id from (
            select /*+ broadcast(c) */ k.grp, c.cut, k.h, k.id, c.within,
                   row_number() over (partition by k.grp, c.cut order by k.h, k.id) as rn
            from {keys} k join cell c on k.grp = c.grp and shiftright(k.h, 15) = c.b)
        where rn = within""", keys=keys, ranks=ranks)


def split_sizes(counts: DataFrame, test: float = 0.2, nested: bool = True) -> DataFrame:
    """label, n_test, n_val per class from (label, n).

    The held-out part is ceil(test * rows); the rest is shared out over the classes in proportion, whole rows
    first, then one each by largest remainder.
    """
    def held_out(source: str, rows: str, out: str) -> str:
        return f"""
            select *, {rows} - (base + int(row_number() over (order by rest desc, label) <= keep - sum(base) over ())) as {out}
            from (select *, cast((keep * cast({rows} as decimal(19, 0))) div total as bigint) as base,
                         (keep * cast({rows} as decimal(19, 0))) % total as rest
                  from (select *, total - cast(ceil({test}D * total) as bigint) as keep
                        from (select *, sum({rows}) over () as total from {source})))"""

    first = held_out("{counts}", "n", "n_test")
    spark = counts.sparkSession
    if not nested:
        return spark.sql(f"select label, n, n_test, 0L as n_val from ({first})", counts=counts)
    second = held_out(f"(select label, n, n_test, n - n_test as left_over from ({first}))", "left_over", "n_val")
    return spark.sql(f"select label, n, n_test, n_val from ({second})", counts=counts)


def stratified_split(df: DataFrame, label: str = schema.LABEL, test: float = 0.2, seed: int = 42,
                     nested: bool = True) -> DataFrame:
    """Add `split`: test, val and train (or test and train) with exact per-class sizes.

    Rows of a class are ordered by a seeded hash of the key: the first ones are test, the next ones val.  The cut
    keys come from two narrow scans of key and label; the rows themselves are only labelled in place, never moved.
    """
    keys = df.selectExpr(f"cast({label} as int) as grp", f"{key_hash(schema.KEY, seed)} as h", f"{schema.KEY} as id")
    counts = keys.groupBy("grp").count().selectExpr("grp as label", "count as n")
    ranks = (split_sizes(counts, test, nested)
             .selectExpr("label as grp", "inline(array(struct('test' as cut, n_test as pos), "
                                         "struct('val' as cut, n_test + n_val as pos)))"))
    cuts = cut_points(keys, ranks.where("pos > 0"))
    # one row per class
    ends = cuts.groupBy("grp").pivot("cut", ["test", "val"]).agg({"h": "max", "id": "max"})
    ends = ends.selectExpr("grp as _g", "`test_max(h)` as _th", "`test_max(id)` as _ti", "`val_max(h)` as _vh", "`val_max(id)` as _vi")
    before = "coalesce(_h < {h} or (_h = {h} and " + schema.KEY + " <= {i}), false)"
    rows = df.selectExpr("*", f"{key_hash(schema.KEY, seed)} as _h", f"cast({label} as int) as _g")
    return (rows.join(ends.hint("broadcast"), "_g", "left")
            .selectExpr(*df.columns, f"case when {before.format(h='_th', i='_ti')} then 'test' "
                                     f"when {before.format(h='_vh', i='_vi')} then '{'val' if nested else 'train'}' "
                                     "else 'train' end as split"))


def imbalance(train: DataFrame, label: str = schema.LABEL) -> DataFrame:
    """One row: positives, rows, rate, and majority over minority."""
    return (train.selectExpr(f"coalesce(sum(cast({label} as bigint)), 0L) as positives", "count(*) as total_rows")
            .selectExpr("positives", "total_rows", f"{ratio('positives', 'total_rows')} as rate",
                        "try_divide(cast(total_rows - positives as double), positives) as imbalance"))


def choose_strategy(measured: DataFrame) -> DataFrame:
    """Add method, target ratio (minority over majority), k and m for the measured imbalance."""
    def chain(i: int, kind: str) -> str:
        def text(v):
            return f"'{v}'" if isinstance(v, str) else f"cast({'null' if v is None else v} as {kind})"
        cases = " ".join(f"when imbalance > {s[1]} then {text(s[i])}" for s in STRATEGIES if s[1] is not None)
        return f"case {cases} else {text(STRATEGIES[-1][i])} end"
    return measured.selectExpr("*", f"{chain(0, 'string')} as method", f"{chain(2, 'double')} as target_ratio",
                               f"{chain(3, 'int')} as k", f"{chain(4, 'int')} as m")


def class_weight(train: DataFrame, cap: float = 100.0, label: str = schema.LABEL) -> DataFrame:
    """One row: weight of a positive row, majority over minority, at most `cap` (the cap itself without positives)."""
    return imbalance(train, label).selectExpr(f"least(imbalance, {float(cap)!r}D) as positive_weight")


def add_class_weight(train: DataFrame, cap: float = 100.0, label: str = schema.LABEL) -> DataFrame:
    """Add `weight`: the capped class weight on positive rows, 1 elsewhere."""
    return (train.withColumn("_w", class_weight(train, cap, label).scalar())
            .selectExpr(*train.columns, f"if({label} = 1, _w, 1.0D) as weight"))
