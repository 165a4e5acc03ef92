"""Boosted trees for a binary label, one round after the other over stored blocks of binned rows.

Rows are binned once (edges from quantiles of the training rows) and stored in blocks of at most BLOCK_ROWS rows: bin
numbers, labels, weights and margins as packed columns.  A round grows one tree level by level.  Each level is one job:
a task sums gradients and hessians of the logistic loss per node, feature and bin over its blocks, and only these
histograms leave it.  In tables of several blocks only the smaller one of two siblings is counted, the other is the
parent's histogram less it.  Splits, leaf values and pruning follow the closed forms of a second-order loss with an L1 and an L2
term, as in Chen and Guestrin, "XGBoost: a scalable tree boosting system" (2016):

    score(G, H) = soft(G, alpha)^2 / (H + lambda)       gain = (score(left) + score(right) - score(node)) / 2
    value of a leaf = -rate * soft(G, alpha) / (H + lambda)

A split needs a hessian sum of min_child_weight on both sides; splits with a gain below gamma are pruned from the leaves
up.  A tree of limited leaves keeps the splits of greatest gain first (`lossguide`) or level by level.  The job of a
round's first level also scores the validation rows after the round before, so no round is fitted or scored twice.

Margins are brought up to date every LATE rounds, when the exact values of these rounds are found, too, and at times from the stored blocks, so that a lost executor costs a
bounded number of passes.  With a ledger folder the trees of each REFRESH rounds are appended to a table there, and a later call goes on
behind the last stored round.
"""

from __future__ import annotations

import math
import pickle
import sys
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from types import ModuleType, SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, RDD, cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.storagelevel import StorageLevel

from ledgerlens.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need numpy and pyarrow but not this package

BLOCK_ROWS = 1 << 16
REFRESH = 16  # rounds that are stored together in a ledger
LATE = 8  # trees that are not in the kept margins yet; with more the margins are brought up to date
CHAIN = 16  # updates that build on each other; the next one starts from the stored blocks
FAN = 8  # sums of histograms that reach the driver from one job, if those of all tasks would be more than SENT_BYTES
SENT_BYTES = 16 << 20
HISTOGRAM_CELLS = 1 << 20  # of one job; a level with more nodes is several jobs
JOINT_CELLS = 1 << 10  # of features with few bins that are counted together, per node
JOINT_NODES = 1 << 6  # nodes up to which that many cells are counted; with more nodes fewer cells
SAMPLED_ROWS = 4_096  # training rows, about, that tell which of two siblings is the smaller one
TASK_ROWS = 1 << 22  # of one task; with fewer there are as many tasks as cores
EXACT_ROWS = 1 << 16  # validation rows whose margins are sent as they are; more are counted in buckets
RANGE_ROWS = 1 << 16  # validation rows of a task that evaluates its range of margins exactly
BUCKETS = 4_096  # equal steps of the margin from -EDGE to EDGE
EDGE = 24.0
MOST_DEPTH = 16
TREE_COLUMNS = ("feature", "threshold", "left", "right", "value", "gain", "gradient", "hessian")
NODES = "tree int, node int, " + ", ".join(f"{c} {'int' if c in ('feature', 'left', 'right') else 'double'}" for c in TREE_COLUMNS)


@dataclass(frozen=True)
class Tree:
    """Nodes by number; a leaf has the children -1.  `threshold` goes left if the feature is at most it; `cut` is its bin."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    gradient: np.ndarray
    hessian: np.ndarray
    cut: np.ndarray


@dataclass(frozen=True)
class BoostedModel:
    """Trees over named features; the margin of a row is the sum of their values."""
    features: list[str]
    trees: list[Tree] = field(default_factory=list)

    @property
    def rounds(self) -> int:
        return len(self.trees)

    def first(self, rounds: int) -> BoostedModel:
        """The model of the first trees only."""
        return self if rounds >= self.rounds else BoostedModel(self.features, self.trees[:rounds])

    def nodes(self, spark: SparkSession, start: int = 0) -> DataFrame:
        """One row per node of the trees from number `start` on."""
        rows = [(t, n, *(getattr(tree, c)[n].item() for c in TREE_COLUMNS))
                for t, tree in enumerate(self.trees) if t >= start for n in range(len(tree.left))]
        return spark.createDataFrame(rows, NODES)

    @staticmethod
    def of_nodes(features: Sequence[str], nodes: DataFrame, edges: list[np.ndarray] | None = None) -> BoostedModel:
        """The model of a table of nodes, whose size depends on rounds and depth only."""
        table, trees = nodes.orderBy("tree", "node").toPandas(), []
        for _, t in table.groupby("tree"):
            columns = [t[c].to_numpy() for c in TREE_COLUMNS]
            cut = np.zeros(len(t), np.int64)
            if edges is not None:
                cut = np.array([np.searchsorted(edges[f], x) if f >= 0 else 0 for f, x in zip(columns[0], columns[1])], np.int64)
            trees.append(Tree(*columns, cut))
        return BoostedModel(list(features), trees)

    def importances(self) -> dict[str, float]:
        """Mean gain of the splits on each feature, as a share of their sum."""
        used = [(int(f), g) for t in self.trees for f, g, inner in zip(t.feature, t.gain, t.left >= 0) if inner]
        mean = np.zeros(len(self.features))
        for f in range(len(self.features)):
            gains = [g for k, g in used if k == f]
            mean[f] = np.mean(gains) if gains else 0.0
        return dict(zip(self.features, (mean / mean.sum() if mean.sum() else mean).tolist()))


FEW_NODES = 32  # rows per node from which on rows are dealt out node by node
FEW_SPLITS = 48  # splits up to which each is held against its whole column, in numbers of one byte


def dealt(tree: Tree | SimpleNamespace, x: np.ndarray, limit: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each leaf with its rows among `rows`, in their order; leaves without rows are left out.

    Only the column that a node splits on is read there, so `x` is best held column by column.
    """
    open_ = [(0, rows)]
    while open_:
        node, own = open_.pop()
        if not len(own):
            continue
        if tree.left[node] < 0:
            yield node, own
            continue
        low = x[:, tree.feature[node]].take(own) <= limit[node]
        open_ += [(tree.right[node], own[~low]), (tree.left[node], own[low])]


def leaf_of(tree: Tree, x: np.ndarray, binned: bool = False, rows: np.ndarray | None = None) -> np.ndarray:
    """The leaf of each row of `x`, feature values or, if `binned`, bin numbers; with `rows` of these only."""
    limit = tree.cut if binned else tree.threshold
    if len(tree.left) * FEW_NODES <= len(x):
        if len(tree.left) <= 2 * FEW_SPLITS + 1:
            at = _leaf_by_columns(tree, x, limit.tolist())
        else:
            at = np.zeros(len(x), np.int64)
            for leaf, own in dealt(tree, x, limit, np.arange(len(x)) if rows is None else rows):
                at[own] = leaf
        return at if rows is None else at[rows]
    if rows is not None:
        return leaf_of(tree, x[rows], binned)
    at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
    while len(rows):
        rows = rows[tree.left[at[rows]] >= 0]
        here = at[rows]
        at[rows] = np.where(x[rows, tree.feature[here]] <= limit[here], tree.left[here], tree.right[here])
    return at


def _leaf_by_columns(tree: Tree, x: np.ndarray, limit: list) -> np.ndarray:
    """The leaf of each row, by one comparison of a whole column per split; marks of a node's rows go down to its leaves."""
    feature, left, right = (a.tolist() for a in (tree.feature, tree.left, tree.right))
    at, open_ = np.zeros(len(x), np.uint8), [(0, None)]
    while open_:
        node, here = open_.pop()
        if left[node] >= 0:
            low = x[:, feature[node]] <= limit[node]
            open_ += [(left[node], low if here is None else here & low), (right[node], ~low if here is None else here > low)]
        elif here is not None:
            at |= here.view(np.uint8) * np.uint8(node)  # a row has one leaf
    return at


def tree_values(tree: Tree, x: np.ndarray, binned: bool = False) -> np.ndarray:
    return tree.value[leaf_of(tree, x, binned)]


@dataclass(frozen=True)
class Settings:
    rate: float = 0.3
    depth: int = 6
    subsample: float = 1.0
    by_tree: float = 1.0
    by_level: float = 1.0
    least_weight: float = 1.0
    gamma: float = 0.0
    alpha: float = 0.0
    lam: float = 1.0
    bins: int = 256
    lossguide: bool = False
    leaves: int = 0  # 0: no limit
    seed: int = 42


def soft(g, alpha: float):
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def score(g, h, s: Settings):
    return soft(g, s.alpha) ** 2 / np.maximum(h + s.lam, 1e-12)


def average_precision(margin: np.ndarray, label: np.ndarray) -> float | None:
    """Exact, over distinct margins; None without a positive row."""
    order = np.argsort(-margin, kind="stable")
    last = np.append(np.diff(margin[order]) != 0, True)
    tp = np.cumsum(label[order])[last]
    if not len(tp) or tp[-1] == 0:
        return None
    return float((np.diff(tp, prepend=0) * tp / (np.flatnonzero(last) + 1)).sum() / tp[-1])


def bounds_of_precision(positive: np.ndarray, negative: np.ndarray) -> tuple[float, float] | None:
    """Least and greatest average precision of rows counted in buckets of descending margin, whatever their order inside."""
    total = int(positive.sum())
    if not total:
        return None
    below = above = 0.0
    tp = fp = 0
    for p, n in zip(positive.tolist(), negative.tolist()):
        if p:
            hits = tp + np.arange(1, p + 1)
            below, above = below + (hits / (hits + fp + n)).sum(), above + (hits / (hits + fp)).sum()
        tp, fp = tp + p, fp + n
    return below / total, above / total


# --- blocks

BLOCKS = "data binary"  # number, rows, bytes of a bin number, distinct weights (0: each row has its own), then COLUMNS
COLUMNS = "margins, draws, bin numbers by column, flags (1: train, 2: label), weights or distinct ones and their places"
HEADER = 32
REMEMBERED_BYTES = 64 << 20  # of margins that a Python worker remembers from job to job


def bin_edges(train: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """Ascending values that cut each feature into at most `bins` bins: quantiles of the training rows."""
    shares = f"array({', '.join(f'{i / bins!r}D' for i in range(1, bins))})"
    found = train.selectExpr(*[f"percentile_approx(`{f}`, {shares}, {100 * bins}) as f{i}" for i, f in enumerate(features)]).first()
    return [np.unique(np.array(q or [], float)) for q in found]


def blocks_of(rows: DataFrame, features: Sequence[str], edges: list[np.ndarray], parts: int) -> DataFrame:
    """`rows` (key, label, weight, train, features) as stored blocks of binned rows."""
    count = len(features)
    kind = np.uint8 if max((len(e) for e in edges), default=0) < 256 else np.uint16

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                columns = [np.asarray(part.column(i)) for i in range(4 + count)]
                n, x = part.num_rows, np.stack([np.searchsorted(e, c).astype(kind) for e, c in zip(edges, columns[4:])])  # by column
                weight = columns[2].astype(np.float64)
                few, place = np.unique(weight, return_inverse=True)
                weights = [few, place.astype(np.uint8)] if len(few) < 256 else [weight]
                flags = (columns[0] > 0) + 2 * (columns[1] > 0.5)
                cells = [np.array([number, n, x.itemsize, len(few) if len(weights) > 1 else 0], np.int64), np.zeros(n),
                         columns[3].astype(np.int64), x, flags.astype(np.uint8), *weights]
                yield pa.RecordBatch.from_arrays([pa.array([b"".join(c.tobytes() for c in cells)], pa.binary())], names=["data"])
                number += 1

    chosen = rows.select(F.col("train").cast("int"), "label", "weight", F.xxhash64("key").alias("draw"), *features)
    return cut_lineage(chosen.repartition(parts).mapInArrow(pack, BLOCKS))


class _Block:
    """A block's columns, with margins after `base` trees and the `late` ones behind them.

    A worker remembers the margins of its latest blocks, so that a job adds only trees that are new to it.
    """

    def __init__(self, raw: bytes, width: int, run: str = "", base: int = 0, late: Sequence[Tree] = ()):
        self.number, n, size, few = np.frombuffer(raw, np.int64, 4).tolist()
        margin, self.draw = np.frombuffer(raw, np.float64, n, HEADER), np.frombuffer(raw, np.int64, n, HEADER + 8 * n)
        start = HEADER + 16 * n
        self.x = np.frombuffer(raw, np.uint8 if size == 1 else np.uint16, n * width, start).reshape(width, n).T
        start += n * width * size
        flags = np.frombuffer(raw, np.uint8, n, start)
        self.train, self.positive = (flags & 1) > 0, flags >> 1
        self.weights = np.frombuffer(raw, np.float64, few or n, start + n)
        self.place = np.frombuffer(raw, np.uint8, n, start + n + 8 * few) if few else None  # of a row's weight
        self.margin = _remembered(run, self.number, margin, self.x, base, late) if run else _added(margin.copy(), self.x, late)


    @property
    def label(self) -> np.ndarray:
        return self.positive.astype(np.float64)

    @property
    def weight(self) -> np.ndarray:
        return self.weights if self.place is None else self.weights[self.place]

    def sums(self, rows: np.ndarray, spare: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Weighted gradients and hessians of some rows, in `spare` arrays until the next call."""
        p, h, weight = (_spare(spare, name, len(rows)) for name in ("p", "h", "weight"))
        np.take(self.weights, rows if self.place is None else self.place.take(rows), out=weight, mode="clip")
        np.negative(np.take(self.margin, rows, out=p, mode="clip"), out=p)
        np.exp(p, out=p)
        p += 1
        np.divide(1, p, out=p)
        np.subtract(1, p, out=h)
        h *= p
        np.maximum(h, 1e-16, out=h)
        h *= weight
        p -= self.positive.take(rows)
        p *= weight
        return p, h


def _spare(kept: dict, name: str, n: int, kind: type = np.float64) -> np.ndarray:
    """An array that is used again from block to block: fresh memory costs more than the sums that are put into it."""
    if name not in kept or len(kept[name]) < n:
        kept[name] = np.empty(n, kind)
    return kept[name][:n]


def _added(margin: np.ndarray, x: np.ndarray, trees: Sequence[Tree]) -> np.ndarray:
    """`margin` itself, with the values of the trees added."""
    place, value = np.empty(len(x), np.int64), np.empty(len(x))
    for tree in trees:
        place[:] = leaf_of(tree, x, True)
        margin += np.take(tree.value, place, out=value, mode="clip")
    return margin


def _remembered(run: str, number: int, margin: np.ndarray, x: np.ndarray, base: int, late: Sequence[Tree]) -> np.ndarray:
    """The margins of a block with the late trees, from the newest ones that this worker remembers."""
    kept = vars(sys.modules.setdefault("_boosting_margins", ModuleType("_boosting_margins")))
    known = kept.setdefault("known", {})
    done, old = known.pop((run, number), (base, None))
    kept["bytes"] = kept.get("bytes", 0) - (0 if old is None else old.nbytes)
    if old is None or not base <= done <= base + len(late):
        done, old = base, margin.copy()
    known[run, number] = base + len(late), _added(old, x, late[done - base:])
    kept["bytes"] += old.nbytes
    while kept["bytes"] > REMEMBERED_BYTES and len(known) > 1:
        kept["bytes"] -= known.pop(next(iter(known)))[1].nbytes
    return old


def _with_trees(blocks: RDD, width: int, trees: Sequence[Tree]) -> RDD:
    """Blocks whose margins have some trees added."""
    def add(cells: Iterator[bytes]) -> Iterator[bytes]:
        for raw in cells:
            block = _Block(raw, width, "", 0, trees)
            yield raw[:HEADER] + block.margin.tobytes() + raw[HEADER + 8 * len(block.label):]
    return blocks.mapPartitions(add)


def _unit(draw: np.ndarray, salt: int) -> np.ndarray:
    """A number from 0 to 1 per row, from the hash of its key and the round."""
    z = draw.view(np.uint64) ^ np.uint64((salt * 0x9E3779B97F4A7C15) % (1 << 64))
    moved = np.empty_like(z)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        z ^= np.right_shift(z, np.uint64(shift), out=moved)
        z *= np.uint64(factor)
    return np.divide(z, 2.0 ** 64, out=moved.view(np.float64))


Shapes = Sequence[tuple[int, ...] | None]  # of arrays that are added up; those whose shape is None are put end to end


def _added_up(found: Iterator[list[np.ndarray]], shapes: Shapes) -> list[np.ndarray]:
    held = [[] if shape is None else np.zeros(shape) for shape in shapes]
    for new in found:
        for i, (shape, a) in enumerate(zip(shapes, new)):
            if shape is None:
                held[i].append(a)
            else:
                held[i] += a.reshape(shape)
    return [np.concatenate([np.zeros(0), *h]) if shape is None else h for shape, h in zip(shapes, held)]


def _of_task(found: Iterator[list[np.ndarray]], shapes: Shapes, plan: SimpleNamespace | None) -> list[np.ndarray]:
    """The sums of a task's blocks; those of the plan's joint cells become sums by column."""
    if plan is None or not plan.joint:
        return _added_up(found, shapes)
    first, *others = _added_up(found, [plan.shape, *shapes[1:]])
    return [_spread(first, plan.groups, plan.counts), *others]


def _summed(blocks: RDD, task: Callable[[int, Iterator[bytes]], Iterator[tuple[int, list[np.ndarray]]]],
            shapes: Shapes) -> list[np.ndarray]:
    """The sums that `task` gives with the number of its partition, added up.

    Sums are added in the order of the partitions, so that a result does not hang on which task is done first.
    """
    def in_order(found: list[tuple[int, list[np.ndarray]]]) -> list[np.ndarray]:
        return _added_up((arrays for _, arrays in sorted(found, key=lambda f: f[0])), shapes)

    def sum_sums(found: Iterator[tuple[int, tuple[int, list[np.ndarray]]]]) -> Iterator[tuple[int, list[np.ndarray]]]:
        own = [f for _, f in found]  # of one partition in FAN
        if own:
            yield min(n for n, _ in own), in_order(own)

    parts, sums = blocks.getNumPartitions(), blocks.mapPartitionsWithIndex(task)
    if parts > FAN and parts * sum(8 * math.prod(s) for s in shapes if s) > SENT_BYTES:
        sums = sums.map(lambda f: (f[0] % FAN, f)).partitionBy(FAN, int).mapPartitions(sum_sums)
    return in_order(sums.collect())  # SENT_BYTES at most, or FAN sums of HISTOGRAM_CELLS pairs


# --- rounds

class _Growing:
    """A tree while its levels are added; splits are in bin numbers."""

    def __init__(self):
        self.feature, self.cut, self.left, self.right = [-1], [0], [-1], [-1]
        self.gain, self.gradient, self.hessian = [0.0], [0.0], [0.0]

    def split(self, node: int, feature: int, cut: int, gain: float, sums: list[tuple[float, float]]) -> list[int]:
        self.feature[node], self.cut[node], self.gain[node] = feature, cut, gain
        made = [len(self.feature), len(self.feature) + 1]
        self.left[node], self.right[node] = made
        for g, h in sums:
            for column, cell in ((self.feature, -1), (self.cut, 0), (self.left, -1), (self.right, -1), (self.gain, 0.0),
                                 (self.gradient, g), (self.hessian, h)):
                column.append(cell)
        return made

    def arrays(self, edges: list[np.ndarray] | None = None, s: Settings = Settings()) -> Tree:
        """The tree so far; with edges, with its thresholds and the values of its leaves."""
        feature, cut = np.array(self.feature), np.array(self.cut)
        g, h = np.array(self.gradient), np.array(self.hessian)
        left = np.array(self.left)
        threshold = np.array([edges[f][c] if edges is not None and f >= 0 else 0.0 for f, c in zip(feature, cut)], float)
        value = np.where(left < 0, -s.rate * soft(g, s.alpha) / np.maximum(h + s.lam, 1e-12), 0.0)
        return Tree(feature, threshold, left, np.array(self.right), value, np.array(self.gain), g, h, cut)

    def limited(self, s: Settings) -> _Growing:
        """With at most `leaves` leaves, the splits of greatest gain first or level by level; then without the splits
        whose gain is below gamma, from the leaves up."""
        open_, kept = [0], set()
        while open_ and (not s.leaves or len(kept) + 1 < s.leaves):
            ready = [n for n in open_ if self.left[n] >= 0]
            if not ready:
                break
            node = max(ready, key=lambda n: (self.gain[n], -n)) if s.lossguide else min(ready)
            open_.remove(node)
            kept.add(node)
            open_ += [self.left[node], self.right[node]]
        for node in sorted(kept, reverse=True):  # children have greater numbers
            if self.left[node] not in kept and self.right[node] not in kept and self.gain[node] < s.gamma:
                kept.remove(node)
        out = _Growing()
        out.gradient[0], out.hessian[0] = self.gradient[0], self.hessian[0]
        places = [(0, 0)]
        while places:
            old, new = places.pop(0)
            if old in kept:
                children = [self.left[old], self.right[old]]
                sums = [(self.gradient[c], self.hessian[c]) for c in children]
                places += zip(children, out.split(new, self.feature[old], self.cut[old], self.gain[old], sums))
        return out


def _sampled(columns: np.ndarray, share: float, seed: list[int]) -> np.ndarray:
    """A seeded share of the columns, at least one, in ascending order."""
    n = max(1, int(round(share * len(columns))))
    return columns if n == len(columns) else np.sort(np.random.default_rng(seed).choice(columns, n, replace=False))


def best_splits(histogram: np.ndarray, columns: np.ndarray, s: Settings) -> list[tuple | None]:
    """Per node (feature, cut, gain, sums left, sums right) of the greatest gain, the first one on ties; None without one.

    `histogram` holds gradient and hessian sums by node, column and bin.
    """
    before = np.cumsum(histogram, axis=2)
    total = before[:, :1, -1:, :]
    left, right = before[:, :, :-1, :], total - before[:, :, :-1, :]
    gain = (score(left[..., 0], left[..., 1], s) + score(right[..., 0], right[..., 1], s)
            - score(total[..., 0], total[..., 1], s)) / 2
    least = max(s.least_weight, 1e-12)
    gain = np.where((left[..., 1] >= least) & (right[..., 1] >= least), gain, -np.inf)
    out = []
    for n, own in enumerate(gain.reshape(len(gain), -1)):
        at = int(own.argmax()) if own.size else 0
        if not own.size or not own[at] > 1e-10:
            out.append(None)
            continue
        c, cut = divmod(at, gain.shape[2])
        out.append((int(columns[c]), cut, float(own[at]), tuple(left[n, c, cut]), tuple(right[n, c, cut])))
    return out


def bundles(counts: Sequence[int], limit: int) -> list[list[int]]:
    """Columns with these numbers of bins, in groups that have at most `limit` joint cells or are one column: the first
    group where a column fits, greatest ones first."""
    groups, cells = [], []
    for c in sorted(range(len(counts)), key=lambda c: -counts[c]):
        at = next((g for g, n in enumerate(cells) if n * counts[c] <= limit), len(groups))
        if at == len(groups):
            groups.append([])
            cells.append(1)
        groups[at].append(c)
        cells[at] *= counts[c]
    return groups


def _joint(x: np.ndarray, features: Sequence[int], counts: Sequence[int]) -> np.ndarray:
    """The joint cell of each row in some features with these numbers of bins."""
    column = x[:, features[0]]
    for f, n in zip(features[1:], counts[1:]):
        column = column.astype(np.uint16, copy=False) * np.uint16(n) + x[:, f]
    return column


def _spread(sums: np.ndarray, groups: list[list[int]], counts: Sequence[int]) -> np.ndarray:
    """Sums by node, column and bin, of those by node and joint cell of each group."""
    ends, end = np.cumsum(counts), 0
    out = np.empty((len(sums), int(ends[-1]), 2))
    for group in groups:
        shape = [counts[c] for c in group]
        part, end = sums[:, end:end + math.prod(shape)].reshape(len(sums), *shape, 2), end + math.prod(shape)
        for i, c in enumerate(group):
            out[:, ends[c] - counts[c]:ends[c]] = part.sum(axis=tuple(1 + k for k in range(len(group)) if k != i))
    return out


@dataclass
class _State:
    """Stored blocks, the margins after `base` trees, and the trees that these do not have yet.

    With a `sample` (bin numbers of some training rows, see `sampled`) features with few bins are counted together, and of
    two siblings only the smaller one is counted.  That adds the same numbers in another order.  A table that fits one
    block goes without: its jobs are short anyway, and its sums stay those of one pass.
    """
    stored: RDD
    blocks: RDD
    width: int
    edges: list[np.ndarray]
    exact: bool
    base: int = 0
    late: list[Tree] = field(default_factory=list)
    run: str = field(default_factory=lambda: uuid.uuid4().hex)
    links: int = 0
    sample: np.ndarray | None = None

    codes: dict[Callable, Broadcast] = field(default_factory=dict)

    def job(self, work: Callable, shapes: Shapes, plan=None) -> list[np.ndarray]:
        """The arrays that `work`, a function of this module, makes of each block and the plan, added up.

        What tasks run is pickled and sent once in a fit, since that takes longer than the sums of many a block; a job
        only sends its plan and the late trees, as plain objects.
        """
        if work not in self.codes:
            self.codes[work] = self.blocks.context.broadcast(cloudpickle.dumps((_of_task, _Block, work)))
        code, width, run, base = self.codes[work], self.width, self.run, self.base
        late = [SimpleNamespace(**vars(t)) for t in self.late]

        def task(number: int, cells: Iterator[bytes]) -> Iterator[tuple[int, list[np.ndarray]]]:
            of_task, block, work = pickle.loads(code.value)
            yield number, of_task((work(block(raw, width, run, base, late), plan) for raw in cells), shapes,
                                  plan if hasattr(plan, "joint") else None)

        return _summed(self.blocks, task, shapes)

    def sampled(self, train: int) -> None:
        """Draw the sample by hash from the training rows; it only directs which rows are read."""
        drawn = self.job(_drawn, [None], SAMPLED_ROWS / train)[0].reshape(-1, self.width)
        self.sample = np.asfortranarray(drawn.astype(np.int64))

    def validation(self) -> np.ndarray:
        return self.job(_judged, [None if self.exact else (2 * BUCKETS,)], self.exact)[0]

    def ended(self) -> None:
        """Let go of what executors keep."""
        self.blocks.unpersist()
        for code in self.codes.values():
            code.destroy()

    def refreshed(self, trees: list[Tree]) -> None:
        """Bring the margins up to date: the kept ones by the trees they lack, after CHAIN times the stored ones by all."""
        onward = self.blocks is not self.stored and self.links < CHAIN and self.base <= len(trees)
        old, (start, new) = self.blocks, (self.blocks, trees[self.base:]) if onward else (self.stored, trees)
        self.blocks = _with_trees(start, self.width, new).persist(StorageLevel.MEMORY_AND_DISK_DESER)  # read by each job
        self.base, self.late, self.links = len(trees), [], self.links + 1 if onward else 0
        self.blocks.count()
        if old is not self.stored:
            old.unpersist()

    def precision(self, asked: dict[int, np.ndarray]) -> dict[int, float | None]:
        """The exact average precision of the validation rows after rounds from `base` on, counted before per bucket and label.

        One job for all rounds: distinct margins with their counts go to tasks by rounds and ranges of buckets; the rows
        above a range are known from the counts, so each task adds up its own shares.
        """
        rows = int(next(iter(asked.values())).sum())
        ranges = rows // RANGE_ROWS + 1
        places, above = {}, {}
        for r, counts in asked.items():
            each = counts.sum(axis=1)
            number = np.minimum((np.cumsum(each) - each) * ranges // max(each.sum(), 1), ranges - 1).astype(np.int32)  # of a bucket's range
            own = np.stack([np.bincount(number, counts[:, k], ranges) for k in range(2)], axis=1)
            places[r], above[r] = number, own.sum(axis=0) - np.cumsum(own, axis=0)
        width, base, late, first = self.width, self.base, list(self.late), min(asked)

        def counted(cells: Iterator[bytes]) -> Iterator[tuple[int, tuple[int, int, list[np.ndarray]]]]:
            for raw in cells:
                block = _Block(raw, width)
                own = ~block.train
                margin, label, x = block.margin[own], block.label[own], block.x.T[:, own].T
                for r in range(base, max(places) + 1):
                    if r > base:
                        margin = margin + tree_values(late[r - base - 1], x, True)
                    if r in places:
                        columns = _distinct(margin, label)
                        place = places[r][_bucket(columns[0])]  # rises with the margin, so a range is a slice
                        ends = np.flatnonzero(np.diff(place, prepend=-1, append=-1))
                        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
                            k = int(place[a])
                            yield (r - first) * ranges + k, (r, k, [c[a:b] for c in columns])

        def shares(found: Iterator[tuple[int, tuple[int, int, list[np.ndarray]]]]) -> Iterator[tuple[int, float]]:
            held: dict[tuple[int, int], list[list[np.ndarray]]] = {}
            for _, (r, k, columns) in found:
                held.setdefault((r, k), []).append(columns)
            for (r, k), own in held.items():
                margin, negative, positive = (np.concatenate(c) for c in zip(*own))
                order = np.argsort(-margin, kind="stable")
                last = np.append(np.diff(margin[order]) != 0, True)
                before = above[r][k]
                tp, fp = before[1] + np.cumsum(positive[order])[last], before[0] + np.cumsum(negative[order])[last]
                yield r, math.fsum(np.diff(tp, prepend=before[1]) * tp / (tp + fp))

        cores, cells = self.blocks.context.defaultParallelism, ranges * len(asked)
        parts = min(cells, max(cores, cells // 8))  # at most 8 ranges of a task, if they are more than the cores
        found = self.blocks.mapPartitions(counted).partitionBy(parts, int).mapPartitions(shares).collect()  # a number per round and range
        totals = {r: counts[:, 1].sum() for r, counts in asked.items()}
        return {r: float(math.fsum(v for q, v in found if q == r) / n) if n else None for r, n in totals.items()}


def _bucket(margin: np.ndarray) -> np.ndarray:
    return ((np.clip(margin / EDGE, -1, 1) + 1) / 2 * (BUCKETS - 1)).astype(np.int64)


def _distinct(margin: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
    """Distinct margins with the numbers of their rows of label 0 and 1."""
    value, place = np.unique(margin, return_inverse=True)
    return [value, *(np.bincount(place, (label > 0.5) == k, len(value)).astype(np.float64) for k in (False, True))]


def _validated(block: _Block, exact: bool) -> np.ndarray:
    """Margins and labels of the validation rows of a block, or their counts per label and bucket."""
    own = ~block.train
    margin, label = block.margin[own], block.label[own]
    if exact:
        return np.stack([margin, label], axis=1).ravel()
    return np.bincount(2 * _bucket(margin) + (label > 0.5), minlength=2 * BUCKETS).astype(float)


def _judged(block: _Block, exact: bool) -> list[np.ndarray]:
    return [_validated(block, exact)]


def _drawn(block: _Block, share: float) -> list[np.ndarray]:
    """Bin numbers of a share of the training rows."""
    return [block.x[block.train & (_unit(block.draw, -1) < share)].astype(np.float64).ravel()]


def _histograms(block: _Block, plan: SimpleNamespace) -> list[np.ndarray]:
    """Sums of gradients and hessians per node, group of columns and joint cell; in a round's first job what the
    validation rows say, too."""
    told = [_validated(block, plan.exact)] if plan.first else []
    if not block.train.any():
        return [np.zeros(plan.shape), *told]
    rows = np.flatnonzero(block.train & (_unit(block.draw, plan.salt) < plan.subsample))
    leaf, place, spare = leaf_of(plan.tree, block.x, True, rows), plan.place, vars(plan.spare)
    if (place < 0).any():  # rows of leaves and of larger siblings go
        inner = place[leaf] >= 0
        rows, leaf = rows[inner], leaf[inner]
    sums, key = block.sums(rows, spare), _spare(spare, "key", len(rows), np.int64)
    starts = {n: np.take(place * n, leaf, out=_spare(spare, f"starts {n}", len(rows), np.int64), mode="clip")
              for n in set(plan.cells)}  # of the bins of each row's node
    out, end = _spare(spare, "out", math.prod(plan.shape)).reshape(plan.shape), 0
    for group, n in zip(plan.groups, plan.cells):
        column = _joint(block.x, [plan.features[c] for c in group], [plan.counts[c] for c in group])
        np.add(starts[n], column.take(rows), out=key)
        for k in range(2):
            out[:, end:end + n, k] = np.bincount(key, sums[k], plan.shape[0] * n).reshape(-1, n)
        end += n
    return [out, *told]


def _grown(state: _State, number: int, s: Settings) -> tuple[Tree, np.ndarray]:
    """The tree of round `number`, and what the validation rows say about the rounds before it."""
    tree, active, told = _Growing(), [0], np.zeros(0)
    columns = _sampled(np.arange(state.width), s.by_tree, [s.seed, number])
    bins = max(len(e) for e in state.edges) + 1
    above: dict[int, np.ndarray] = {}  # left child: the histogram of its parent
    for level in range(max(s.depth, 1)):
        some = _sampled(columns, s.by_level, [s.seed, number, level])
        counts = [len(state.edges[f]) + 1 for f in some]  # bins of each column
        limit = 0 if state.sample is None else min(JOINT_CELLS, JOINT_CELLS * JOINT_NODES // len(active))
        groups = [[c] for c in range(len(some))] if not limit else bundles(counts, limit)
        cells = [math.prod(counts[c] for c in group) for group in groups]
        rest = _differences(state.sample, tree, active, above) if above else {}
        at_once = max(1, HISTOGRAM_CELLS // max(len(some) * bins, sum(cells)))
        at_once += at_once % 2 if rest else 0  # siblings stay together
        # sides without rows have sums of rounding errors only in a difference, and must not pass for heavy enough
        keeps = state.sample is not None and len(active) <= at_once and len(some) == len(columns) and s.least_weight >= 1
        made, above = [], {}
        for start in range(0, len(active), at_once):
            nodes, first = active[start:start + at_once], level == 0 and start == 0
            read = [n for n in nodes if n not in rest]
            place = np.full(len(tree.feature), -1)
            place[read] = np.arange(len(read))
            plan = SimpleNamespace(
                tree=SimpleNamespace(**vars(tree.arrays())), place=place, features=some.tolist(), counts=counts, groups=groups,
                cells=cells, shape=(len(read), sum(cells), 2), joint=limit > 0, first=first, exact=state.exact,
                salt=s.seed * 1_000_003 + number, subsample=s.subsample, spare=SimpleNamespace())  # arrays of a task
            shapes = [(len(read), sum(counts), 2), *([None if state.exact else (2 * BUCKETS,)] if first else [])]
            packed, *told_now = state.job(_histograms, shapes, plan)
            counted = np.zeros((len(read), len(some), bins, 2))
            for c, (n, end) in enumerate(zip(counts, np.cumsum(counts))):
                counted[:, c, :n] = packed[:, end - n:end]
            histogram = counted if not rest else np.stack([
                rest[n][1] - counted[place[rest[n][0]]] if n in rest else counted[place[n]] for n in nodes])
            told = told_now[0] if first else told
            if level == 0:
                tree.gradient[0], tree.hessian[0] = histogram[0, 0].sum(axis=0)
            for node, own, best in zip(nodes, histogram, best_splits(histogram, some, s)):
                if best is not None:
                    made += tree.split(node, *best[:3], list(best[3:]))
                    above |= {tree.left[node]: own} if keeps else {}
        active = made if level + 1 < s.depth else []
        if not active:
            break
    return tree.limited(s).arrays(state.edges, s), told


def _differences(sample: np.ndarray, tree: _Growing, active: list[int], above: dict[int, np.ndarray]) -> dict[int, tuple[int, np.ndarray]]:
    """The larger one of each two siblings with the smaller one and the histogram of both, by their rows in the sample."""
    size = np.bincount(leaf_of(tree.arrays(), sample, True), minlength=len(tree.feature))
    return {(a if size[a] > size[b] else b): (b if size[a] > size[b] else a, above[a]) for a, b in zip(active[::2], active[1::2])}


def _read_ledger(spark: SparkSession, folder: str, features: Sequence[str], edges: list[np.ndarray]) -> list[Tree]:
    try:
        return BoostedModel.of_nodes(features, spark.read.schema(NODES).parquet(f"{folder}/trees"), edges).trees
    except AnalysisException:
        return []  # nothing stored yet


@dataclass(frozen=True)
class Fitted:
    """All fitted rounds, the best one, and the validation average precision after each (None: never needed exactly)."""
    model: BoostedModel
    best: int
    curve: list[float | None]


def boost(rows: DataFrame, features: Sequence[str], rounds: int, settings: Settings, patience: int | None = None,
          ledger: str | None = None) -> Fitted:
    """Fit on `rows` (key, label 0 or 1, weight, train, features), where `train` is false for validation rows.

    Features must not be NULL.  With `patience`, rounds end once the validation average precision has not risen for so
    many; the best round is the one with the highest exact value.  Where validation rows are counted in buckets, a
    round is evaluated exactly only if its upper bound reaches the best value so far.
    """
    spark = rows.sparkSession
    train, total, odd = rows.select(F.count_if("train"), F.count(F.lit(1)), F.count_if(
        F.col("label").isNull() | ~F.col("label").isin(0.0, 1.0))).first()
    if odd or not train:
        raise ValueError(f"{odd} of {total} rows have a label that is not 0 or 1" if odd else "there is no row to fit on")
    if not 1 <= settings.depth <= MOST_DEPTH or settings.bins < 2:
        raise ValueError(f"max_depth must be from 1 to {MOST_DEPTH} and max_bin at least 2")
    parts = max(1, min(-(-total // BLOCK_ROWS), spark.sparkContext.defaultParallelism), -(-total // TASK_ROWS))
    edges = bin_edges(rows.where("train"), features, settings.bins)
    stored = blocks_of(rows, features, edges, parts).rdd.map(lambda r: bytes(r[0]))
    state = _State(stored, stored, len(features), edges, total - train <= EXACT_ROWS)
    trees = _read_ledger(spark, ledger, features, edges)[:rounds] if ledger else []
    known, curve, best, top = len(trees), [], 0, -np.inf
    state.refreshed([])
    if total > BLOCK_ROWS:
        state.sampled(train)

    open_: dict[int, np.ndarray] = {}  # counts of rounds that are not evaluated yet

    def seen(told: np.ndarray) -> None:
        """Take in the validation rows after the latest round."""
        curve.append(None)
        if state.exact:
            pairs = told.reshape(-1, 2)
            taken(len(curve), average_precision(pairs[:, 0], pairs[:, 1]))
            return
        open_[len(curve)] = told.reshape(-1, 2)
        if ended():  # if none of the open rounds is a rise
            evaluate()

    def taken(number: int, value: float | None) -> None:
        nonlocal best, top
        curve[number - 1] = value
        if value is not None and value > top:
            best, top = number, value

    def evaluate() -> None:
        """The exact values of the open rounds whose upper bound reaches the best value before them, by one job."""
        falling = {r: told[::-1].astype(np.int64) for r, told in open_.items()}
        bounds = {r: bounds_of_precision(told[:, 1], told[:, 0]) for r, told in falling.items()}
        asked = {r: open_[r] for r, b in bounds.items() if b is not None and b[1] > top}
        values = state.precision(asked) if asked else {}
        for r in asked:
            if bounds[r][1] > top:
                taken(r, values[r])
        open_.clear()

    def renewed() -> None:
        evaluate()
        state.refreshed(trees[:state.base + len(state.late)])

    def ended() -> bool:
        return patience is not None and len(curve) - max(best, 0) >= patience and len(curve) > 0

    if patience is not None:  # the curve of stored rounds
        for number in range(1, known + 1):
            state.late.append(trees[number - 1])
            seen(state.validation())
            if ended():
                trees = trees[:number]
                break
            if len(state.late) == LATE:
                renewed()
    done = patience is not None and ended()
    if known and not done:
        evaluate()
        state.refreshed(trees)
    while not done and len(trees) < rounds:
        tree, told = _grown(state, len(trees), settings)
        if patience is not None and len(trees) > len(curve):
            seen(told)
            if ended():
                break
        trees.append(tree)
        state.late.append(tree)
        if len(state.late) == LATE:
            renewed()
        if ledger and (len(trees) % REFRESH == 0 or len(trees) == rounds):
            stored_rounds = (len(trees) - 1) // REFRESH * REFRESH
            BoostedModel(list(features), trees).nodes(spark, max(known, stored_rounds)).coalesce(1).write.mode("append").parquet(f"{ledger}/trees")
    if patience is not None and not done and len(curve) < len(trees):
        seen(state.validation())
    evaluate()
    state.ended()
    model = BoostedModel(list(features), trees)
    return Fitted(model, max(best, 1) if patience is not None else model.rounds, curve)


def with_margin(rows: DataFrame, model: BoostedModel) -> DataFrame:
    """`rows` with `margin`, the sum of the model's leaf values for their features."""
    kept = [f for f in rows.schema if f.name != "margin"]
    sent = rows.sparkSession.sparkContext.broadcast((
        [SimpleNamespace(**vars(t)) for t in model.trees],  # plain objects, so that workers need no class of this package
        [[f.name for f in kept].index(n) for n in model.features]))
    layout = rows.select(*[f.name for f in kept]).schema.add("margin", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, places = sent.value
        for batch in batches:
            x = np.stack([np.asarray(batch.column(i), float) for i in places]).T
            margin = np.zeros(batch.num_rows)
            for tree in trees:
                margin += tree_values(tree, x)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(margin)], names=[*batch.schema.names, "margin"])

    return rows.select(*[f.name for f in kept]).mapInArrow(run, layout)
