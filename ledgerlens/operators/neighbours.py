"""Exact k nearest neighbours (Euclidean, ties by lowest id).

Few queries (counted first): the query matrix is sent to every task, each task keeps the k best of its own points
per query, and a per-query top k merges them.

Many queries: points are cut into tiles of similar size along the two widest features.  A query first looks into
its own tile, which bounds how far its k-th neighbour can be, and then only into tiles that reach within that bound.
Where the two widest features do not separate rows (`rings`), the index is over all features: points belong to the nearest
of some pivots and to a ring of distances from it, and each ring knows its least and greatest distance from every pivot.
By the triangle inequality a query at distance d from a pivot is at least lo - d and d - hi away from all points of a ring.

Tiles and queries are split into blocks of bounded size, so a hot tile is many small tasks, and equal vectors are
thinned to the k + 1 lowest ids, which cannot change the answer.  No pair table is ever shuffled: a block emits at
most k rows per query.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql.functions import expr

from ledgerlens import schema
from ledgerlens.session import cut_lineage

# Task functions travel with their code, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BROADCAST_CELLS = 8_000_000   # query cells (rows x features x (k + 1)) sent to every task at most
BROADCAST_PAIRS = 1e10        # comparisons beyond which tiles pay off
VISIT_ROWS = 50_000            # rows of one output batch of tile visits
NO_ID = np.iinfo(np.int64).max


def vectors_of(df: DataFrame, features: Sequence[str], label: str = schema.LABEL) -> DataFrame:
    """(id, y, one DOUBLE per feature); missing values take the fill value."""
    cells = [f"coalesce(nanvl(cast({f} as double), null), {schema.NULL_FILL}D) as {f}" for f in features]
    y = f"cast({label} as int)" if label in df.columns else "0"
    return df.selectExpr(f"{schema.KEY} as id", f"{y} as y", *cells)


def _thin(ids: np.ndarray, points: np.ndarray, k: int) -> np.ndarray:
    """Positions of the rows that can matter: of equal vectors only the k + 1 lowest ids can be among the k nearest."""
    raw = np.ascontiguousarray(points)
    _, group = np.unique(raw.view(np.dtype((np.void, raw.itemsize * raw.shape[1]))).ravel(), return_inverse=True)
    order = np.lexsort((ids, group))
    place = np.arange(len(order)) - np.searchsorted(group[order], group[order], "left")
    return order[place <= k]


class _Best:
    """The k nearest rows seen so far for each of a set of queries, updated block by block."""

    def __init__(self, ids: np.ndarray, cells: np.ndarray, k: int, pivot: int, bound: np.ndarray | None = None):
        order = np.argsort(cells[:, pivot], kind="stable")
        self.ids, self.cells, self.k, self.pivot = ids[order], cells[order], k, pivot
        n = len(ids)
        self.bound = np.full(n, np.inf) if bound is None else bound[order]
        self.d = np.full((n, k), np.inf)
        self.nn = np.full((n, k), NO_ID, dtype=np.int64)
        self.y = np.zeros((n, k), dtype=np.int32)
        self.v = np.zeros((n, k, cells.shape[1]))

    def _distances(self, rows: slice, ids: np.ndarray, points: np.ndarray) -> np.ndarray:
        d = np.zeros((rows.stop - rows.start, len(ids)))
        for j in range(points.shape[1]):
            gap = self.cells[rows, j, None] - points[None, :, j]
            d += gap * gap
        d[self.ids[rows, None] == ids[None, :]] = np.inf
        return d

    def update(self, ids: np.ndarray, y: np.ndarray, points: np.ndarray, chunk: int = 64, width: int = 8192) -> None:
        keep = _thin(ids, points, self.k)
        order = keep[np.argsort(points[keep, self.pivot], kind="stable")]
        ids, y, points = ids[order], y[order], np.asfortranarray(points[order])
        line, k = points[:, self.pivot], self.k
        for start in range(0, len(self.ids), chunk):
            rows = slice(start, min(start + chunk, len(self.ids)))
            at = self.cells[rows, self.pivot]
            bound = np.minimum(self.bound[rows], self.d[rows, k - 1])
            # a short run of points around the queries already limits how far the rest can matter
            near = slice(max(0, np.searchsorted(line, at[0]) - 4 * k - 4),
                         np.searchsorted(line, at[-1], "right") + 4 * k + 4)
            if len(line[near]) <= width:
                d = self._distances(rows, ids[near], points[near])
                if d.shape[1] >= k:
                    bound = np.minimum(bound, np.partition(d, k - 1, axis=1)[:, k - 1])
            reach = np.sqrt(bound) * (1 + 1e-9)
            lo = np.searchsorted(line, np.min(at - reach), "left")
            hi = np.searchsorted(line, np.max(at + reach), "right")
            for a in range(lo, hi, width):
                part = slice(a, min(a + width, hi))
                d = self._distances(rows, ids[part], points[part])
                r, c = np.nonzero(d <= np.minimum(bound, self.d[rows, k - 1])[:, None])
                if len(r):
                    self._merge(start, r, d[r, c], ids[part][c], y[part][c], points[part], c)

    def _merge(self, start: int, r, d, ids, y, points, c) -> None:
        finite = np.isfinite(d)
        r, d, ids, y, c = r[finite], d[finite], ids[finite], y[finite], c[finite]
        order = np.lexsort((ids, d, r))
        r, d, ids, y, c = r[order], d[order], ids[order], y[order], c[order]
        first = np.searchsorted(r, r, "left")
        top = np.arange(len(r)) - first < self.k
        r, d, ids, y, c = r[top], d[top], ids[top], y[top], c[top]
        place = np.arange(len(r)) - np.searchsorted(r, r, "left")
        size = r[-1] + 1 if len(r) else 0
        mine = slice(start, start + size)
        new_d, new_nn = np.full((size, self.k), np.inf), np.full((size, self.k), NO_ID, dtype=np.int64)
        new_y, new_v = np.zeros((size, self.k), dtype=np.int32), np.zeros((size, self.k, points.shape[1]))
        new_d[r, place], new_nn[r, place], new_y[r, place], new_v[r, place] = d, ids, y, points[c]
        all_d, all_nn = np.hstack([self.d[mine], new_d]), np.hstack([self.nn[mine], new_nn])
        best = np.lexsort((all_nn, all_d), axis=-1)[:, :self.k]
        self.d[mine], self.nn[mine] = np.take_along_axis(all_d, best, 1), np.take_along_axis(all_nn, best, 1)
        self.y[mine] = np.take_along_axis(np.hstack([self.y[mine], new_y]), best, 1)
        self.v[mine] = np.take_along_axis(np.hstack([self.v[mine], new_v]), best[:, :, None], 1)

    def result(self) -> pa.RecordBatch:
        found = self.nn != NO_ID
        owner = np.repeat(self.ids, found.sum(axis=1))
        cells = self.v[found]
        offsets = np.arange(0, cells.size + 1, self.cells.shape[1], dtype=np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(owner), pa.array(self.nn[found]), pa.array(self.d[found]), pa.array(self.y[found]),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(cells.ravel()))], names=FOUND)


FOUND = ["q_id", "nn_id", "d2", "nn_label", "nn_v"]
FOUND_TYPES = "q_id long, nn_id long, d2 double, nn_label int, nn_v array<double>"


def _matrix(table, features: Sequence[str]) -> np.ndarray:
    return np.column_stack([table.column(f).to_numpy() for f in features]) if table.num_rows else np.zeros((0, len(features)))


def _ids(table, name: str = "id") -> np.ndarray:
    return table.column(name).to_numpy()


def _broadcast_search(queries: DataFrame, points: DataFrame, k: int, features: list[str]) -> DataFrame:
    table = queries.toArrow()  # size checked by the caller
    cells = _matrix(table, features)
    pivot = int(np.argmax(cells.var(axis=0))) if len(cells) else 0
    sent = queries.sparkSession.sparkContext.broadcast((_ids(table), cells))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(*sent.value, k, pivot)
        for batch in batches:
            if batch.num_rows:
                best.update(_ids(batch), _ids(batch, "y"), _matrix(batch, features))
        yield best.result()

    return points.mapInArrow(search, FOUND_TYPES)


class _Tiles:
    """Tile edges and, once counted, the box of each non-empty tile on the two pivot features."""

    def __init__(self, pivots: list[str], features: list[str], first: np.ndarray, second: list[np.ndarray], slack: float):
        self.pivots, self.first, self.second, self.slack = pivots, first, second, slack
        self.line, self.other = (features.index(p) for p in pivots)
        self.stride = max([len(s) for s in second] + [0]) + 1

    def locate(self, x: np.ndarray) -> np.ndarray:
        a, b = x[:, self.line], x[:, self.other]
        column = np.searchsorted(self.first, a, "right")
        row = np.zeros(len(a), dtype=np.int64)
        for c in np.unique(column):
            mine = column == c
            row[mine] = np.searchsorted(self.second[c], b[mine], "right")
        return column * self.stride + row

    def measure(self, placed: DataFrame) -> None:
        """Take in the number of rows and the box of each tile."""
        a, b = self.pivots
        rows = sorted(placed.groupBy("tile").agg(
            expr("count(*) as n"), expr(f"min({a}) as a0"), expr(f"max({a}) as a1"),
            expr(f"min({b}) as b0"), expr(f"max({b}) as b1")).collect(), key=lambda r: r["tile"])  # at most max_tiles rows
        self.ids = np.array([r["tile"] for r in rows], dtype=np.int64)
        self.n = np.array([r["n"] for r in rows], dtype=np.int64)
        self.box = np.array([[r["a0"], r["a1"], r["b0"], r["b1"]] for r in rows]).reshape(-1, 4)

    def lower(self, q: np.ndarray) -> np.ndarray:
        """Squared distance below which no point of each tile can lie."""
        a, b = q[self.line], q[self.other]
        x = np.maximum(0, np.maximum(self.box[:, 0] - a, a - self.box[:, 1]))
        y = np.maximum(0, np.maximum(self.box[:, 2] - b, b - self.box[:, 3]))
        return x * x + y * y

    def near(self, q: np.ndarray, limit: float) -> np.ndarray:
        """Tiles within a squared distance: only the columns and rows that the reach touches are looked at."""
        if not math.isfinite(limit):
            return self.ids
        a, b = q[self.line], q[self.other]
        reach = math.sqrt(limit) * (1 + 1e-9) + 1e-300
        low, high = np.searchsorted(self.first, a - reach, "left"), np.searchsorted(self.first, a + reach, "right")
        spots = [np.arange(c * self.stride + np.searchsorted(self.second[c], b - reach, "left"),
                           c * self.stride + np.searchsorted(self.second[c], b + reach, "right") + 1)
                 for c in range(low, high + 1)]
        places = np.searchsorted(self.ids, np.concatenate(spots))
        places = places[places < len(self.ids)]
        places = np.unique(places[np.isin(self.ids[places], np.concatenate(spots))])
        box = self.box[places]
        x = np.maximum(0, np.maximum(box[:, 0] - a, a - box[:, 1]))
        y = np.maximum(0, np.maximum(box[:, 2] - b, b - box[:, 3]))
        return self.ids[places[x * x + y * y <= limit]]

    def upper(self, q: np.ndarray, k: int) -> float:
        """A squared distance within which at least k other points lie, from tile boxes alone."""
        a, b = q[self.line], q[self.other]
        x = np.maximum(abs(a - self.box[:, 0]), abs(a - self.box[:, 1]))
        y = np.maximum(abs(b - self.box[:, 2]), abs(b - self.box[:, 3]))
        far = (x * x + y * y) + self.slack
        order = np.argsort(far)
        enough = np.searchsorted(np.cumsum(self.n[order]), k + 1)
        return float(far[order[min(enough, len(order) - 1)]]) * (1 + 1e-9) if enough < len(order) else math.inf


def _build_tiles(queries: DataFrame, points: DataFrame, n: int, features: list[str], tile_rows: int, max_tiles: int) -> _Tiles:
    sides = points.select(*features).unionByName(queries.select(*features))
    shape = sides.selectExpr(*[f"var_pop({f}) as {f}" for f in features],
                             *[f"max({f}) - min({f}) as {f}__range" for f in features]).first()
    a, b = sorted(features, key=lambda f: -(shape[f] or 0.0))[:2] if len(features) > 1 else (features[0], features[0])
    slack = sum((shape[f"{f}__range"] or 0.0) ** 2 for f in features if f not in (a, b))
    side = max(1, math.ceil(math.sqrt(min(max_tiles, n / tile_rows))))
    marks = [i / side for i in range(1, side)]
    first = np.unique(points.approxQuantile(a, marks, 0.25 / side)) if marks else np.array([])
    second = [np.array([]) for _ in range(len(first) + 1)]
    if marks:
        cutter = Bucketizer(splits=[-math.inf, *first.tolist(), math.inf], inputCol=a, outputCol="_c")
        probs = ", ".join(str(m) for m in marks)
        edges = cutter.transform(points.selectExpr(a, f"{b} as b")).groupBy("_c").agg(
            expr(f"percentile_approx(b, array({probs}), {8 * side}) as q"))
        for row in edges.collect():  # at most max_tiles numbers in all
            second[int(row["_c"])] = np.unique(row["q"])
    return _Tiles([a, b], features, first, second, slack)


class _Rings:
    """Pivots in the space of all features, and for each the distances that cut its points into rings."""

    def __init__(self, features: list[str], pivots: np.ndarray, edges: list[np.ndarray], line: int):
        self.features, self.pivots, self.edges, self.line = features, pivots, edges, line
        self.stride = max(len(e) for e in edges) + 1

    def apart(self, x: np.ndarray) -> np.ndarray:
        """Distance of each row from each pivot."""
        out = np.zeros((len(x), len(self.pivots)))
        for j in range(x.shape[1]):
            gap = x[:, j, None] - self.pivots[None, :, j]
            out += gap * gap
        return np.sqrt(out)

    def locate(self, x: np.ndarray) -> np.ndarray:
        apart = self.apart(x)
        owner = apart.argmin(axis=1)
        ring = np.zeros(len(x), np.int64)
        for i in np.unique(owner):
            mine = owner == i
            ring[mine] = np.searchsorted(self.edges[i], apart[mine, i], "right")
        return owner * self.stride + ring

    def measure(self, placed: DataFrame) -> None:
        """Take in the number of rows of each ring and its least and greatest distance from every pivot."""
        features, rings = self.features, self

        def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                apart, tile = rings.apart(_matrix(batch, features)), _ids(batch, "tile")
                order = np.argsort(tile, kind="stable")
                distinct, start, n = np.unique(tile[order], return_index=True, return_counts=True)
                if not len(distinct):
                    continue
                low, high = (f.reduceat(apart[order], start, axis=0) for f in (np.minimum, np.maximum))
                width = apart.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(distinct, width)), pa.array(np.tile(np.arange(width), len(distinct)).astype(np.int32)),
                     pa.array(np.repeat(n, width)), pa.array(low.ravel()), pa.array(high.ravel())], names=["tile", "pivot", "n", "lo", "hi"])

        found = placed.mapInArrow(ends, "tile long, pivot int, n long, lo double, hi double").groupBy("tile", "pivot").agg(
            expr("sum(n) as n"), expr("min(lo) as lo"), expr("max(hi) as hi")).orderBy("tile", "pivot").toPandas()  # rings x pivots
        width = len(self.pivots)
        self.ids, self.n = (found[c].to_numpy()[::width] for c in ("tile", "n"))
        self.low, self.high = (found[c].to_numpy().reshape(-1, width) for c in ("lo", "hi"))

    def lower(self, q: np.ndarray) -> np.ndarray:
        """Squared distance below which no point of each ring can lie, a little less for rounding."""
        apart = self.apart(q[None, :])
        gap = np.maximum(0, np.maximum(self.low - apart, apart - self.high) - 1e-9 * (apart + self.high)).max(axis=1)
        return gap * gap

    def near(self, q: np.ndarray, limit: float) -> np.ndarray:
        return self.ids[self.lower(q) <= limit * (1 + 1e-9)] if math.isfinite(limit) else self.ids

    def upper(self, q: np.ndarray, k: int) -> float:
        """A squared distance within which at least k other points lie."""
        far = (self.apart(q[None, :]) + self.high).min(axis=1)
        order = np.argsort(far)
        enough = np.searchsorted(np.cumsum(self.n[order]), k + 1)
        return float(far[order[min(enough, len(order) - 1)]]) ** 2 * (1 + 1e-9) if enough < len(order) else math.inf


PIVOTS = 64
PIVOT_SAMPLE = 4_096  # points that pivots are chosen from, a bounded sample; every point is indexed
RING_MARKS = 255


def _build_rings(points: DataFrame, n: int, features: list[str], tile_rows: int, max_tiles: int) -> _Rings:
    """Pivots are drawn from a sample, each far from those before it, and moved to the middle of the points around them."""
    share = max(1, n // PIVOT_SAMPLE)
    drawn = points.where(f"pmod(xxhash64(id), {share}) = 0").orderBy("id").limit(2 * PIVOT_SAMPLE).select(*features)
    x = _matrix(drawn.toArrow(), features)  # at most 2 * PIVOT_SAMPLE rows
    if not len(x):
        x = np.zeros((1, len(features)))
    random, chosen = np.random.default_rng(42), [x.mean(axis=0)]
    least = ((x - chosen[0]) ** 2).sum(axis=1)
    while len(chosen) < min(PIVOTS, len(x)) and least.sum() > 0:
        chosen.append(x[random.choice(len(x), p=least / least.sum())])
        least = np.minimum(least, ((x - chosen[-1]) ** 2).sum(axis=1))
    rings = _Rings(features, np.array(chosen), [np.array([])] * len(chosen), int(np.argmax(x.var(axis=0))))
    for _ in range(3):
        owner = rings.apart(x).argmin(axis=1)
        rings.pivots = np.array([x[owner == i].mean(axis=0) if (owner == i).any() else p for i, p in enumerate(rings.pivots)])

    def radius(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = rings.apart(_matrix(batch, features))
            yield pa.RecordBatch.from_arrays([pa.array(apart.argmin(axis=1)), pa.array(apart.min(axis=1))], names=["owner", "r"])

    marks = f"array({', '.join(f'{i / (RING_MARKS + 1)!r}D' for i in range(1, RING_MARKS + 1))})"
    rows = points.select(*features).mapInArrow(radius, "owner long, r double").groupBy("owner").agg(
        expr("count(*) as n"), expr(f"percentile_approx(r, {marks}, {8 * RING_MARKS}) as q")).collect()  # one row per pivot
    edges = [np.array([])] * len(chosen)
    for r in rows:
        wanted = min(RING_MARKS + 1, max_tiles // len(chosen), math.ceil(r["n"] / tile_rows))
        edges[r["owner"]] = np.unique(np.array(r["q"])[[(RING_MARKS + 1) * i // wanted - 1 for i in range(1, wanted)]]) if wanted > 1 else np.array([])
    return _Rings(features, rings.pivots, edges, rings.line)


def _tile_search(queries: DataFrame, points: DataFrame, tiles: _Tiles | _Rings, k: int, features: list[str],
                 block_points: int, block_queries: int, told: dict | None = None) -> DataFrame:
    """`told` gets the number of pairs of a query and a point of a tile that it visits."""
    spark = points.sparkSession
    keys = ", ".join(features)
    told = {} if told is None else told

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spot = tiles.locate(_matrix(batch, features))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spot)], names=[*batch.schema.names, "tile"])

    cells = ", ".join(f"{f} double" for f in features)
    thinned = points.selectExpr("*", f"row_number() over (partition by {keys} order by id) as _r").where(f"_r <= {k + 1}")
    placed = cut_lineage(thinned.drop("_r").mapInArrow(place, f"id long, y int, {cells}, tile long"))
    tiles.measure(placed)
    pivot = tiles.line

    def run(visits: DataFrame) -> DataFrame:
        """visits: (id, bound, features, tile).  Search each visited tile, in blocks of bounded size."""
        asked = {r["tile"]: r["count"] for r in visits.groupBy("tile").count().collect()}
        held = dict(zip(tiles.ids.tolist(), tiles.n.tolist()))
        told["pairs"] = told.get("pairs", 0) + sum(q * held[t] for t, q in asked.items())
        plan = [(t, math.ceil(held[t] / block_points), math.ceil(q / block_queries)) for t, q in asked.items()]
        if not plan:
            return spark.createDataFrame([], FOUND_TYPES)
        blocks = spark.createDataFrame(plan, "tile long, pbs int, qbs int").hint("broadcast")
        left = (visits.join(blocks, "tile").selectExpr("*", f"cast(pmod(xxhash64(id), qbs) as int) as qb")
                .selectExpr("*", "explode(sequence(0, pbs - 1)) as pb").drop("pbs", "qbs"))
        right = (placed.join(blocks, "tile").selectExpr("*", "cast(pmod(xxhash64(id), pbs) as int) as pb")
                 .selectExpr("*", "explode(sequence(0, qbs - 1)) as qb").drop("pbs", "qbs"))

        def meet(q: pa.Table, p: pa.Table) -> pa.Table:
            best = _Best(_ids(q), _matrix(q, features), k, pivot, _ids(q, "bound"))
            if q.num_rows and p.num_rows:
                best.update(_ids(p), _ids(p, "y"), _matrix(p, features))
            return pa.Table.from_batches([best.result()])

        key = ["tile", "pb", "qb"]
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(meet, FOUND_TYPES)

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tiles
        for batch in batches:
            x = _matrix(batch, features)
            spot = t.locate(x)
            for i in np.nonzero(~np.isin(spot, t.ids))[0]:  # an empty tile: the nearest one that is not
                spot[i] = t.ids[np.argmin(t.lower(x[i]))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spot), pa.array(np.full(len(spot), np.inf))],
                                             names=[*batch.schema.names, "tile", "bound"])

    homes = cut_lineage(queries.drop("y").mapInArrow(home, f"id long, {cells}, tile long, bound double"))
    first = cut_lineage(_merge_top(run(homes), k))
    limits = first.groupBy("q_id").agg(expr(f"case when count(*) = {k} then max(d2) end as kth"))
    bounded = (homes.drop("bound").withColumnRenamed("tile", "home")
               .join(limits, homes["id"] == limits["q_id"], "left").drop("q_id"))

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tiles
        for batch in batches:
            x = _matrix(batch, features)
            homes_, kth = _ids(batch, "home"), batch.column("kth").to_numpy(zero_copy_only=False).astype(float)
            rows, spots, bounds, held = [], [], [], 0
            for i in range(batch.num_rows):
                limit = kth[i] if kth[i] == kth[i] else t.upper(x[i], k)
                hit = t.near(x[i], limit)
                hit = hit[hit != homes_[i]]
                for start in range(0, len(hit), VISIT_ROWS):
                    part = hit[start:start + VISIT_ROWS]
                    rows.append(np.full(len(part), i))
                    spots.append(part)
                    bounds.append(np.full(len(part), limit))
                    held += len(part)
                    if held >= VISIT_ROWS:
                        yield visited(batch, rows, spots, bounds)
                        rows, spots, bounds, held = [], [], [], 0
            if held:
                yield visited(batch, rows, spots, bounds)

    def visited(batch: pa.RecordBatch, rows: list, spots: list, bounds: list) -> pa.RecordBatch:
        picked = pa.RecordBatch.from_arrays([batch.column(c) for c in ["id", *features]], names=["id", *features])
        picked = picked.take(pa.array(np.concatenate(rows)))
        return pa.RecordBatch.from_arrays([*picked.columns, pa.array(np.concatenate(spots)), pa.array(np.concatenate(bounds))],
                                          names=["id", *features, "tile", "bound"])

    visits = cut_lineage(bounded.mapInArrow(others, f"id long, {cells}, tile long, bound double"))  # counted, then joined
    return first.select(*FOUND).unionByName(run(visits))


def _merge_top(found: DataFrame, k: int) -> DataFrame:
    return (found.selectExpr("*", "row_number() over (partition by q_id order by d2, nn_id) as rank")
            .where(f"rank <= {k}"))


TWO_WIDEST = 0.9


def _two_are_wide(points: DataFrame, features: list[str]) -> bool:
    spread = sorted((v or 0.0 for v in points.selectExpr(*[f"var_pop({f}) as {f}" for f in features]).first()), reverse=True)
    return sum(spread[:2]) >= TWO_WIDEST * sum(spread)


def knn(queries: DataFrame, points: DataFrame, k: int, features: Sequence[str] = tuple(schema.FEATURES),
        method: str | None = None, tile_rows: int = 50_000, max_tiles: int = 262_144, block_points: int = 100_000,
        block_queries: int = 20_000, told: dict | None = None) -> DataFrame:
    """q_id, rank, nn_id, distance, nn_label, nn_v: the k nearest other rows of each query row.

    Both inputs have a key, features and (optionally) a label; a row is never its own neighbour.
    `method` is broadcast, tiles or rings; by default the counted size decides between broadcast and an index, and the
    spread of the features which one: tiles where the two widest hold at least `TWO_WIDEST` of the variance, rings otherwise.
    """
    features = list(features)
    q, p = vectors_of(queries, features), vectors_of(points, features)
    n_q, n_p = q.count(), p.count()
    small = n_q * len(features) * (k + 1) <= BROADCAST_CELLS and n_q * n_p <= BROADCAST_PAIRS
    if method == "broadcast" or not n_q or not n_p or (method is None and small):
        found = _broadcast_search(q, p, k, features)
    else:
        method = "rings" if method == "rings" or (method is None and not _two_are_wide(p, features)) else "tiles"
        index = (_build_rings(p, n_p, features, tile_rows, max_tiles) if method == "rings"
                 else _build_tiles(q, p, n_p, features, tile_rows, max_tiles))
        found = _tile_search(q, p, index, k, features, block_points, block_queries, told)
    return _merge_top(found, k).selectExpr("q_id", "rank", "nn_id", "sqrt(d2) as distance", "nn_label", "nn_v")
