"""Minority resampling on Spark: SMOTE, borderline SMOTE, adaptive SMOTE, Tomek links.

Distances use the features as they are, unscaled.  Every random choice is a seeded hash of the row key, so a
resampled table is the same on any cluster and after any retry.  Synthetic keys are -1 to -n: copies are numbered
through in the order of their seeds' keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.functions import expr

from ledgerlens import schema
from ledgerlens.functions.scalar import key_hash, key_unit, log_bucket, ratio
from ledgerlens.operators.neighbours import knn, vectors_of
from ledgerlens.operators.running import running_totals
from ledgerlens.operators.split import choose_strategy, class_weight, cut_points, imbalance
from ledgerlens.session import broadcast_if_small, cut_lineage


class CannotResample(ValueError):
    """The class sizes or neighbourhoods do not allow the requested resampling."""


@dataclass(frozen=True)
class _Need:
    minority: int
    majority: int
    new: int


def _need(train: DataFrame, ratio_: float, k: int) -> _Need:
    row = train.selectExpr(f"count_if({schema.LABEL} = 1) as a", f"count_if({schema.LABEL} = 0) as b").first()
    new = int(ratio_ * row["b"] - row["a"])
    if row["a"] <= k:
        raise CannotResample(f"{row['a']} minority rows cannot have {k} neighbours each")
    if ratio_ * row["b"] < row["a"]:
        raise CannotResample("the target ratio is below the present one")
    return _Need(row["a"], row["b"], new)


def _minority(train: DataFrame) -> DataFrame:
    return train.where(f"{schema.LABEL} = 1")


def even_copies(seeds: DataFrame, total: int, n_seeds: int, seed: int) -> DataFrame:
    """Add `copies`: total spread evenly over the seeds, one more for the first few in hash order."""
    each, extra = divmod(total, n_seeds)
    if extra == 0:
        return seeds.selectExpr("*", f"{each}L as copies")
    order = key_hash(schema.KEY, seed, purpose="copies")
    keys = seeds.selectExpr("1 as grp", f"{order} as h", f"{schema.KEY} as id")
    ranks = seeds.sparkSession.range(1).selectExpr("1 as grp", "'c' as cut", f"{extra}L as pos")
    last = cut_points(keys, ranks).selectExpr("struct(h, id)").scalar()
    return (seeds.withColumn("_c", last)
            .selectExpr("* except (_c)", f"{each}L + int(struct({order} as h, {schema.KEY} as id) <= _c) as copies"))


COPY_BLOCK = 10_000


def _dealt(rows: DataFrame, block: int | None = None) -> DataFrame:
    """`rows` with `first` and `last` instead of `copies`: one row per block of a seed's copies.

    The blocks of one table are numbered in order of `before`, the copies of all seeds before it, plus their own start;
    consecutive numbers go to different tasks.  Seeds with a single block stay where they are.
    """
    block = block or COPY_BLOCK
    cut = rows.selectExpr("*", f"explode(sequence(0L, (copies - 1) div {block})) as _j").selectExpr(
        "* except (copies, _j)", f"_j * {block} + 1 as first", f"least(copies, (_j + 1) * {block}) as last", f"copies > {block} as _many")
    many = cut.where("_many").withColumn("_deal", expr(f"(before + first - 1) div {block}"))
    return cut.where("not _many").drop("_many").unionByName(many.repartition("_deal").drop("_many", "_deal"))


def interpolate(seeds: DataFrame, nearest: DataFrame, k: int, seed: int,
                features: Sequence[str] = tuple(schema.FEATURES)) -> DataFrame:
    """One synthetic minority row per copy: seed + gap * (neighbour - seed), one gap for all features of a row.

    The at most k neighbours of a seed are one small array, so the only join is on the unique seed key.  A seed's copies are
    cut into blocks of COPY_BLOCK numbers that are dealt to tasks before a row is made, so few seeds with many copies
    are many tasks.
    """
    lists = nearest.groupBy("q_id").agg(expr("sort_array(collect_list(struct(rank, nn_v))) as near"))
    cells = vectors_of(seeds, features).selectExpr("id", f"array({', '.join(features)}) as v")
    numbered = running_totals(seeds.where("copies > 0").selectExpr(schema.KEY, "copies"), schema.KEY, ["copies"],
                              log_bucket(schema.KEY))
    rows = (numbered.selectExpr(schema.KEY, "copies", "c_copies - copies as before")
            .join(cells, expr(f"{schema.KEY} = id")).join(lists, expr("id = q_id"))
            .selectExpr("id", "v", "near", "before", "copies"))
    rows = _dealt(rows).selectExpr("id", "v", "near", "before", "explode(sequence(first, last)) as copy")
    rows = rows.selectExpr("id", "v", "before", "copy", f"near[cast({key_hash('id', seed, 'copy', 'pick')} % {k} as int)].nn_v as w",
                           f"{key_unit('id', seed, 'copy', 'gap')} as gap")
    return rows.selectExpr(f"-(before + copy) as {schema.KEY}",
                           *[f"cast(v[{i}] + gap * (w[{i}] - v[{i}]) as float) as {f}" for i, f in enumerate(features)],
                           f"1 as {schema.LABEL}")


def with_synthetic(train: DataFrame, synthetic: DataFrame) -> DataFrame:
    """Original rows first, then synthetic ones, told apart by `is_synthetic`."""
    columns = [schema.KEY, *schema.FEATURES, schema.LABEL]
    return (train.selectExpr(*columns, "false as is_synthetic")
            .unionByName(synthetic.selectExpr(*columns, "true as is_synthetic")))


def smote(train: DataFrame, target: float = 0.15, k: int = 5, seed: int = 42) -> DataFrame:
    """Synthetic rows only: minority seeds moved toward one of their k nearest minority rows."""
    need = _need(train, target, k)
    seeds = even_copies(_minority(train), need.new, need.minority, seed)
    return interpolate(seeds, knn(_minority(train), _minority(train), k), k, seed)


def danger_rows(train: DataFrame, m: int = 5) -> DataFrame:
    """tx_id of minority rows of whose m nearest rows at least half, but not all, are majority."""
    near = knn(_minority(train), train, m)
    return (near.groupBy("q_id").agg(expr("count_if(nn_label = 0) as others"))
            .where(f"2 * others >= {m} and others < {m}").selectExpr(f"q_id as {schema.KEY}"))


def borderline_smote(train: DataFrame, target: float = 0.03, k: int = 3, m: int = 5, seed: int = 42) -> DataFrame:
    """SMOTE whose seeds are the minority rows in danger; no such row gives no synthetic row."""
    need = _need(train, target, k)
    danger = broadcast_if_small(danger_rows(train, m))
    n = danger.count()
    if n == 0:
        return interpolate(_minority(train).selectExpr("*", "0L as copies"), knn(_minority(train), _minority(train), k), k, seed)
    rows = cut_lineage(_minority(train).join(danger, schema.KEY, "left_semi"))
    seeds = even_copies(rows, need.new, n, seed)
    return interpolate(seeds, knn(rows, _minority(train), k), k, seed)


def adaptive_copies(train: DataFrame, target: float = 0.05, k: int = 3) -> DataFrame:
    """Minority rows with `copies` in proportion to the majority share among their k nearest rows."""
    need = _need(train, target, k)
    near = knn(_minority(train), train, k)
    shares = cut_lineage(near.groupBy("q_id").agg(expr(f"count_if(nn_label = 0) / {k}.0D as share")))
    total = shares.selectExpr("sum(share)").first()[0]
    if not total:
        raise CannotResample("no majority row is near any minority row")
    copies = shares.selectExpr("q_id", f"cast(rint(share / {total!r}D * {need.new}) as bigint) as copies")
    return _minority(train).join(copies, expr(f"{schema.KEY} = q_id")).drop("q_id")


def adasyn(train: DataFrame, target: float = 0.05, k: int = 3, seed: int = 42) -> DataFrame:
    seeds = cut_lineage(adaptive_copies(train, target, k))
    return interpolate(seeds, knn(_minority(train), _minority(train), k), k, seed)


def tomek_links(rows: DataFrame) -> DataFrame:
    """(minority_id, majority_id) of opposite-class rows that are each other's nearest row.

    Only minority rows and the majority rows they hit are looked up.
    """
    hits = broadcast_if_small(knn(_minority(rows), rows, 1).where("nn_label = 0").select("q_id", "nn_id"))
    hit = cut_lineage(rows.join(hits, expr(f"{schema.KEY} = nn_id"), "left_semi"))
    back = knn(hit, rows, 1).selectExpr("q_id as nn_id", "nn_id as q_id")
    return back.join(hits, ["q_id", "nn_id"]).selectExpr("q_id as minority_id", "nn_id as majority_id")


def tomek_members(rows: DataFrame) -> DataFrame:
    """tx_id of both members of every Tomek link."""
    return tomek_links(rows).selectExpr(f"explode(array(minority_id, majority_id)) as {schema.KEY}")


@dataclass(frozen=True)
class Balanced:
    """A rebalanced train table as changes to the stored one: rows added, keys removed (both may be none).

    `positive_weight` is set where a class weight has to stand in for resampling.
    """
    train: DataFrame
    method: str
    synthetic: DataFrame | None = None
    removed: DataFrame | None = None
    positive_weight: float | None = None

    @property
    def rows(self) -> DataFrame:
        original = self.train if self.removed is None else self.train.join(self.removed, schema.KEY, "left_anti")
        if self.synthetic is None:
            return original.selectExpr(schema.KEY, *schema.FEATURES, schema.LABEL, "false as is_synthetic")
        return with_synthetic(original, self.synthetic)


def smote_tomek(train: DataFrame, target: float = 0.08, k: int = 5, seed: int = 42, method: str = "smote_tomek") -> Balanced:
    """SMOTE, then removal of both members of every Tomek link among original and synthetic rows."""
    synthetic = cut_lineage(smote(train, target, k, seed))
    gone = broadcast_if_small(tomek_members(with_synthetic(train, synthetic)))
    return Balanced(train, method, synthetic.join(gone, schema.KEY, "left_anti"), gone)


def resample(train: DataFrame, seed: int = 42, weight_cap: float = 100.0) -> Balanced:
    """Pick the method by imbalance and apply it; where it cannot apply, keep the rows and use a class weight."""
    plan = choose_strategy(imbalance(train)).first()
    target, k, m = plan["target_ratio"], plan["k"], plan["m"]
    label = f"{plan['method']} ({target:.0%})"
    try:
        if plan["imbalance"] is None:
            raise CannotResample("no positive row")
        if plan["method"] == "smote_tomek":
            return smote_tomek(train, target, k, seed, label)
        new = {"smote": lambda: smote(train, target, k, seed),
               "adasyn": lambda: adasyn(train, target, k, seed),
               "borderline_smote": lambda: borderline_smote(train, target, k, m, seed)}[plan["method"]]()
        return Balanced(train, label, cut_lineage(new))
    except CannotResample:
        weight = class_weight(train, weight_cap).first()[0]
        return Balanced(train, f"class_weight ({weight:.1f})", positive_weight=weight)


def resample_summary(original: DataFrame, balanced: DataFrame, method: str) -> DataFrame:
    """stage, rows, positives, rate before and after, with the method label."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.selectExpr(f"'{name}' as stage", "count(*) as n", f"sum(cast({schema.LABEL} as bigint)) as positives")
    return (side(original, "before").unionByName(side(balanced, "after"))
            .selectExpr("stage", "n", "positives", f"{ratio('positives', 'n')} as rate", f"'{method}' as method"))
