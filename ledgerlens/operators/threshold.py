"""Decision thresholds: confusion counts over a grid in one pass, and the constrained choice of one point."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ledgerlens.functions.scalar import ratio


@dataclass(frozen=True)
class Grid:
    """`n` evenly spaced thresholds from `low` to `high`, both included."""
    low: float
    high: float
    n: int

    @property
    def step(self) -> float:
        return (self.high - self.low) / (self.n - 1)

    def value(self, i: str) -> str:
        """Expression for the i-th point (0-based)."""
        return f"case when {i} = {self.n - 1} then {self.high!r}D else {i} * {self.step!r}D + {self.low!r}D end"


@dataclass(frozen=True)
class Preset:
    """A grid, the limits a threshold must meet, and the score to maximise."""
    grid: Grid
    limits: str
    score: str


# Grids, limits and weights of the three threshold choices.
PRESETS = {
    "device": Preset(Grid(0.01, 0.99, 200), "recall >= 0.45D and fpr <= 0.05D and precision >= 0.30D and tp + fn > 0",
                     "precision * 2.0D + recall * 0.8D + f1 * 0.6D - fpr * 3.0D"),
    "host": Preset(Grid(0.05, 0.95, 100), "recall >= 0.45D and fpr <= 0.05D",
                   "precision * 2.0D + recall * 0.5D + f1 * 0.3D - fpr * 2.0D"),
    "search": Preset(Grid(0.05, 0.95, 100), "recall >= 0.45D and fpr <= 0.05D and precision >= 0.30D",
                     "precision * 2.0D + least(recall * 0.5D, 0.3D) + f1 * 0.3D - greatest(0.0D, (fpr - 0.02D) * 5.0D)"),
}
CURVE_GRID = Grid(0.1, 0.9, 50)

RATES = [f"{ratio('tp', 'tp + fp')} as precision", f"{ratio('tp', 'tp + fn')} as recall",
         f"{ratio('2 * tp', '2 * tp + fp + fn')} as f1"]


def threshold_sweep(scored: DataFrame, grid: Grid, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn, precision, recall, f1, fpr for every threshold (positive when p >= threshold).

    Each row is counted once, under the number of grid points its score reaches; a running sum over at most
    n + 1 counts per group then gives every threshold.  The false positive rate is 1 where no negative exists.
    The grid position is never NULL, so the join on it adds no filter and the scored rows are scanned once.
    """
    by = list(by)
    guess = f"cast(floor((p - {grid.low!r}D) / {grid.step!r}D) as int)"
    reached = (f"case when p is null or isnan(p) or p < {grid.low!r}D then -1 when p >= {grid.high!r}D then {grid.n - 1} "
               f"when p < ({grid.value('_g')}) then _g - 1 when p >= ({grid.value('(_g + 1)')}) then _g + 1 else _g end")
    counts = (scored.selectExpr(*by, "label", "p", f"{guess} as _g").selectExpr(*by, "label", f"coalesce({reached}, -1) as _i")
              .groupBy(*by, "_i").agg({"label": "sum", "*": "count"})
              .selectExpr(*by, "_i", "`sum(label)` as pos", "`count(1)` - `sum(label)` as neg"))
    groups = counts.groupBy(*by).agg({"pos": "sum", "neg": "sum"}).selectExpr(*by, "`sum(pos)` as p_all", "`sum(neg)` as n_all")
    points = groups.selectExpr("*", f"explode(sequence(0, {grid.n - 1})) as _i").selectExpr("*", f"{grid.value('_i')} as threshold")
    board = points.join(counts, [*by, "_i"], "left")  # at most n rows per group on either side
    over = (f"partition by {', '.join(by)} " if by else "") + "order by _i desc rows between unbounded preceding and current row"
    return (board.selectExpr(*by, "threshold", "p_all", "n_all",
                             f"coalesce(sum(pos) over ({over}), 0L) as tp", f"coalesce(sum(neg) over ({over}), 0L) as fp")
            .selectExpr(*by, "threshold", "tp", "fp", "p_all - tp as fn", "n_all - fp as tn")
            .selectExpr("*", *RATES, f"{ratio('fp', 'fp + tn', '1.0D')} as fpr"))


def valid_thresholds(scored: DataFrame, preset: str, by: Sequence[str] = ()) -> DataFrame:
    """The thresholds of a preset that predict something and meet its limits, with their score."""
    rule = PRESETS[preset]
    return (threshold_sweep(scored, rule.grid, by).where(f"tp + fp > 0 and {rule.limits}")
            .selectExpr("*", f"{rule.score} as score"))


def choose_threshold(scored: DataFrame, preset: str, by: Sequence[str] = ()) -> DataFrame:
    """The best valid threshold; the lowest one on ties; 0.5 with score 0 where none is valid."""
    by = list(by)
    pick = ["threshold", "precision", "recall", "f1", "fpr", "score"]
    over = (f"partition by {', '.join(by)} " if by else "") + "order by score desc, threshold"
    best = (valid_thresholds(scored, preset, by).where("score > 0")
            .selectExpr(*by, *pick, f"row_number() over ({over}) as _r").where("_r = 1"))
    default = ["0.5D as threshold", "0.0D as precision", "0.0D as recall", "0.0D as f1", "1.0D as fpr", "0.0D as score"]
    if by:
        everyone = scored.select(*by).distinct()
        names = [f"coalesce({p}, {d.split(' as ')[0]}) as {p}" for p, d in zip(pick, default)]
        return everyone.join(best, by, "left").selectExpr(*by, *names)
    fallback = scored.sparkSession.range(1).selectExpr(*default)
    return best.select(*pick).unionByName(fallback).orderBy("score", ascending=False).limit(1)


def threshold_curve(scored: DataFrame, grid: Grid = CURVE_GRID) -> DataFrame:
    """Precision, recall and F1 along a grid, 0 where nothing is predicted."""
    return threshold_sweep(scored, grid).select("threshold", "precision", "recall", "f1")


def predict_at(scored: DataFrame, threshold: float | DataFrame) -> DataFrame:
    """Add `prediction`: 1 where p reaches the threshold (a number, or a one-row table with that column)."""
    if isinstance(threshold, DataFrame):
        limit = scored.withColumn("_t", threshold.select("threshold").scalar())
        return limit.selectExpr("* except (_t)", "int(p >= _t) as prediction")
    return scored.selectExpr("*", f"int(p >= {float(threshold)!r}D) as prediction")
