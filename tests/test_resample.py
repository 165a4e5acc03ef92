"""Neighbours, splits and resampling against brute force and their invariants."""

import numpy as np
import pytest

from ledgerlens import schema
from ledgerlens.operators import neighbours, resample as rs, split as sp
from tests.conftest import feature_rows

F = schema.FEATURES


def _rows(n, seed=0, hot=0.0, minority=0.1):
    """Random feature rows; a share `hot` of them are one and the same vector."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = {"amount": float(np.round(rng.lognormal(6, 2))), "step": float(rng.integers(0, 50)), "hour": float(rng.integers(0, 24))}
        if rng.random() < hot:
            v = {"amount": 1000.0, "step": 7.0, "hour": 7.0}
        rows.append((i, int(rng.random() < minority), v))
    return rows


def _brute(rows, queries, k):
    x = np.array([[v.get(f, 0.0) for f in F] for _, _, v in rows], dtype=np.float32).astype(float)
    ids = np.array([r[0] for r in rows])
    out = {}
    for q in queries:
        d = np.zeros(len(x))
        for j in range(x.shape[1]):
            d += (x[q, j] - x[:, j]) ** 2
        keep = ids != ids[q]
        order = np.lexsort((ids[keep], d[keep]))[:k]
        out[int(ids[q])] = [int(i) for i in ids[keep][order]]
    return out


@pytest.mark.parametrize("hot", [0.0, 0.4])
@pytest.mark.parametrize("options", [dict(method="broadcast"),
                                     dict(method="tiles", tile_rows=40, block_points=15, block_queries=7),
                                     dict(method="tiles", tile_rows=5, block_points=1000, block_queries=1000),
                                     dict(method="tiles")])
def test_neighbours_equal_brute_force(spark, hot, options):
    rows = _rows(400, hot=hot, minority=0.3)
    df = feature_rows(spark, rows).repartition(4)
    got = {}
    for r in neighbours.knn(df.where("isFraud = 1"), df, 4, **options).orderBy("q_id", "rank").collect():
        got.setdefault(r.q_id, []).append(r.nn_id)
        assert r.nn_label == rows[r.nn_id][1]
        assert r.nn_v[F.index("amount")] == np.float32(rows[r.nn_id][2]["amount"])
    assert got == _brute(rows, [i for i, y, _ in rows if y == 1], 4)


@pytest.mark.parametrize("options", [dict(method="broadcast"), dict(method="tiles", tile_rows=2)])
def test_fewer_points_than_neighbours(spark, options):
    df = feature_rows(spark, [(i, 1, {"amount": float(i * i)}) for i in range(4)])
    got = neighbours.knn(df, df, 6, **options).groupBy("q_id").count().collect()
    assert sorted((r.q_id, r["count"]) for r in got) == [(i, 3) for i in range(4)]


def test_missing_features_take_the_fill_value(spark):
    df = feature_rows(spark, [(1, 1, {"amount_category": None}), (2, 1, {"amount_category": 0.0})])
    assert neighbours.knn(df, df, 1).where("q_id = 1").first()["distance"] == 1.0


@pytest.mark.parametrize("nested", [True, False])
@pytest.mark.parametrize("shift", [0, 16])
def test_split_equals_row_numbers(spark, nested, shift):
    # a shift of the key changes every hash; sizes that do not divide evenly test the shares
    df = spark.range(1003).selectExpr(f"id + {shift} as tx_id", "int(id % 17 = 0) as isFraud")
    got = sp.stratified_split(df, nested=nested)
    counts = {(r.split, r.isFraud): r["count"] for r in got.groupBy("split", "isFraud").count().collect()}
    n = {r.isFraud: r["count"] for r in df.groupBy("isFraud").count().collect()}
    assert sum(v for (s, _), v in counts.items() if s == "test") == int(np.ceil(0.2 * 1003))
    for y in (0, 1):
        assert abs(counts["test", y] - 0.2 * n[y]) <= 1
        ends = [counts["test", y], counts["test", y] + counts.get(("val", y), 0)]
        from ledgerlens.functions.scalar import key_hash
        want = df.where(f"isFraud = {y}").selectExpr("tx_id", f"row_number() over (order by {key_hash('tx_id', 42)}, tx_id) as rn")
        both = want.join(got, "tx_id").collect()
        assert all(r.split == ("test" if r.rn <= ends[0] else "val" if r.rn <= ends[1] else "train") for r in both)


def test_split_of_a_tiny_class(spark):
    df = spark.range(21).selectExpr("id as tx_id", "int(id = 3) as isFraud")
    got = {r.split: r["count"] for r in sp.stratified_split(df).groupBy("split").count().collect()}
    assert sum(got.values()) == 21 and got["test"] == 5


@pytest.mark.parametrize("imbalance,method", [(100.0, "smote"), (100.5, "smote_tomek"), (150.0, "smote_tomek"),
                                              (150.5, "adasyn"), (300.0, "adasyn"), (300.5, "borderline_smote")])
def test_strategy_limits(spark, imbalance, method):
    got = sp.choose_strategy(spark.createDataFrame([(imbalance,)], "imbalance double")).first()
    assert got.method == method
    assert (got.target_ratio, got.k, got.m) == {"smote": (0.15, 5, None), "smote_tomek": (0.08, 5, None),
                                                "adasyn": (0.05, 3, None), "borderline_smote": (0.03, 3, 5)}[method]


def test_smote_rows_lie_between_minority_rows(spark):
    rows = _rows(300, seed=5)
    df = feature_rows(spark, rows)
    minority = [r for r in rows if r[1] == 1]
    new = rs.smote(df, 0.5, 3).toPandas()
    assert len(new) == int(0.5 * (len(rows) - len(minority)) - len(minority))
    assert new.tx_id.is_unique and (new.tx_id < 0).all() and (new.isFraud == 1).all()
    x = np.array([[v.get(f, 0.0) for f in F] for _, _, v in minority], dtype=np.float32).astype(float)
    for row in new[F].to_numpy(dtype=float)[:20]:
        on_segment = False
        for i in range(len(x)):
            for j in range(len(x)):
                span, off = x[j] - x[i], row - x[i]
                gap = (span @ off) / (span @ span) if span @ span else 0.0
                on_segment |= -1e-6 <= gap <= 1 + 1e-6 and np.allclose(off, gap * span, rtol=1e-4, atol=1e-3)
        assert on_segment


def test_resampling_is_repeatable(spark):
    df = feature_rows(spark, _rows(200, seed=6))
    a, b = (rs.smote(d, 0.4, 3).orderBy("tx_id").collect() for d in (df, df.repartition(5)))
    assert a == b
    assert a != rs.smote(df, 0.4, 3, seed=7).orderBy("tx_id").collect()


def test_too_few_rows_or_too_low_a_ratio(spark):
    few = feature_rows(spark, _rows(40, minority=0.0)[:38] + [(38, 1, {}), (39, 1, {"amount": 1.0})])
    with pytest.raises(rs.CannotResample):
        rs.smote(few, 0.5, 5)
    with pytest.raises(rs.CannotResample):
        rs.smote(feature_rows(spark, _rows(100, minority=0.5)), 0.1, 5)
    kept = rs.resample(few)
    assert kept.method.startswith("class_weight") and kept.positive_weight == 19.0 and kept.rows.count() == 40
    none = rs.resample(feature_rows(spark, _rows(10, minority=0.0)))
    assert none.positive_weight == 100.0 and none.rows.count() == 10


def test_borderline_uses_only_rows_in_danger(spark):
    # majority rows around 0; minority rows far away are safe, one near 0 is surrounded (noise), two are in danger
    rows = [(i, 0, {"amount": float(i)}) for i in range(40)]
    rows += [(100 + i, 1, {"amount": 5000.0 + i}) for i in range(10)]
    rows += [(200, 1, {"amount": 20.4})]
    rows += [(300, 1, {"amount": 41.0}), (301, 1, {"amount": 41.1})]
    df = feature_rows(spark, rows)
    assert sorted(r.tx_id for r in rs.danger_rows(df, 5).collect()) == [300, 301]
    new = rs.borderline_smote(df, 0.5, 3, 5).collect()
    assert len(new) == int(0.5 * 40 - 13)
    assert sorted(r.tx_id for r in new) == list(range(-len(new), 0))
    assert all(20.4 <= r.amount < 5000.0 for r in new)  # a safe seed would give rows from 5000 on


def test_synthetic_keys_stay_small_for_large_keys(spark):
    rows = [(i << 33, y, v) for i, y, v in _rows(200, seed=8)]
    new = rs.smote(feature_rows(spark, rows), 0.9, 3)
    n = new.count()
    assert sorted(r.tx_id for r in new.select("tx_id").collect()) == list(range(-n, 0))


def test_borderline_without_danger_adds_nothing(spark):
    rows = [(i, 0, {"amount": float(i)}) for i in range(40)] + [(100 + i, 1, {"amount": 5000.0 + i}) for i in range(10)]
    assert rs.borderline_smote(feature_rows(spark, rows), 0.5, 3, 5).count() == 0


def test_adaptive_copies_follow_the_majority_share(spark):
    rows = [(i, 0, {"amount": float(i)}) for i in range(40)]
    rows += [(100 + i, 1, {"amount": 5000.0 + i}) for i in range(5)] + [(200, 1, {"amount": 20.4}), (201, 1, {"amount": 10.4})]
    got = {r.tx_id: r.copies for r in rs.adaptive_copies(feature_rows(spark, rows), 0.5, 3).collect()}
    assert got == {**{100 + i: 0 for i in range(5)}, 200: 6, 201: 6}  # 13 rows shared evenly, halves to even


def test_adaptive_needs_majority_neighbours(spark):
    rows = [(i, 0, {"amount": float(i)}) for i in range(40)] + [(100 + i, 1, {"amount": 5000.0 + i}) for i in range(10)]
    df = feature_rows(spark, rows)
    with pytest.raises(rs.CannotResample):
        rs.adasyn(df, 0.5, 3)


def test_tomek_links_are_mutual_pairs(spark):
    rows = [(1, 1, {"amount": 0.0}), (2, 0, {"amount": 1.0}), (3, 0, {"amount": 10.0}), (4, 1, {"amount": 12.5}),
            (5, 0, {"amount": 14.0}), (6, 0, {"amount": 14.5})]
    got = rs.tomek_links(feature_rows(spark, rows)).collect()
    assert [tuple(r) for r in got] == [(1, 2)]  # 4 hits 5, but 5 is nearer to 6


def test_class_weight_is_capped(spark):
    df = spark.range(1000).selectExpr("id as tx_id", "int(id = 0) as isFraud")
    assert sp.class_weight(df).first()[0] == 100.0
    assert sp.class_weight(df, 50).first()[0] == 50.0
    weights = {r.isFraud: r.weight for r in sp.add_class_weight(df, 5.0).select("isFraud", "weight").distinct().collect()}
    assert weights == {0: 1.0, 1: 5.0}


def _equal_spread(spark, n=3_000, seed=5):
    """Rows around 200 places in the space of ten features of equal spread, many of which meet in any two of them."""
    r = np.random.default_rng(seed)
    names = schema.FEATURES[:10]
    places = r.uniform(-100, 100, size=(200, 10))
    x = places[r.integers(0, 200, n)] + 3 * r.normal(size=(n, 10))
    x[::50] = x[0]  # equal rows
    return feature_rows(spark, [(i, int(i % 9 == 0), dict(zip(names, map(float, row)))) for i, row in enumerate(x)]), names


def test_rings_find_the_neighbours_and_compare_fewer_pairs(spark):
    rows, names = _equal_spread(spark)
    rows = rows.persist()
    told = {m: {} for m in ("tiles", "rings")}
    found = {m: sorted(map(tuple, neighbours.knn(rows, rows, 4, names, method=m, tile_rows=60, block_points=500, block_queries=300,
                                                 told=told.get(m)).select("q_id", "rank", "nn_id", "distance").collect()))
             for m in ("broadcast", "tiles", "rings")}
    assert len(found["broadcast"]) == 12_000
    assert [r[:3] for r in found["rings"]] == [r[:3] for r in found["broadcast"]]
    assert [r[3] for r in found["rings"]] == pytest.approx([r[3] for r in found["broadcast"]])
    assert 2 * told["rings"]["pairs"] <= told["tiles"]["pairs"]
    assert not neighbours._two_are_wide(neighbours.vectors_of(rows, names), names)


def test_rings_of_few_equal_and_no_points(spark):
    few = feature_rows(spark, [(i, 0, {"amount": 5.0}) for i in range(7)])
    got = neighbours.knn(few, few, 3, method="rings", tile_rows=2).orderBy("q_id", "rank").collect()
    assert [r.nn_id for r in got][:6] == [1, 2, 3, 0, 2, 3] and all(r.distance == 0 for r in got)
    assert neighbours.knn(few, few.limit(0), 3, method="rings").count() == 0
    assert neighbours.knn(few.limit(0), few, 3, method="rings").count() == 0
    one = neighbours.knn(few.limit(1), few.limit(1), 3, method="rings")
    assert one.count() == 0


def test_copies_of_one_seed_are_many_tasks(spark, monkeypatch):
    seeds = feature_rows(spark, [(i, 1, {"amount": float(i)}) for i in range(6)])
    near = neighbours.knn(seeds, seeds, 2)
    given = seeds.selectExpr("*", "if(tx_id = 3, 5000L, if(tx_id = 5, 2L, 0L)) as copies")
    whole = rs.interpolate(given, near, 2, 42)
    monkeypatch.setattr(rs, "COPY_BLOCK", 100)
    dealt = rs.interpolate(given, near, 2, 42)
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, whole.collect())) and dealt.count() == 5_002
    blocks = rs._dealt(given.where("copies > 0").selectExpr("tx_id as id", "copies", "0L as before"), 100)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        tasks = blocks.selectExpr("spark_partition_id() as task", "last - first + 1 as n").groupBy("task").sum("n").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["sum(n)"] for r in tasks) == 5_002 and max(r["sum(n)"] for r in tasks) < 2_500
