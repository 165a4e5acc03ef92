"""Boosting against closed forms, a plain grower, and its own ledger."""

import numpy as np
import pytest

from ledgerlens import schema
from ledgerlens.operators import boosting as bo, evaluate, training as tr
from tests.conftest import feature_rows

NAMES = ["a", "b", "c"]


def table(spark, n=600, seed=1, validation=200, positive=0.3):
    r = np.random.default_rng(seed)
    x = np.round(r.normal(size=(n, 3)), 1)
    y = (x[:, 0] + 0.5 * x[:, 1] * (x[:, 2] > 0) + r.normal(scale=0.7, size=n) > np.quantile(x[:, 0], 1 - positive)).astype(float)
    rows = [(i, float(y[i]), 1.0 + i % 3, i >= validation, *map(float, x[i])) for i in range(n)]
    return spark.createDataFrame(rows, "key long, label double, weight double, train boolean, a double, b double, c double")


@pytest.fixture(scope="module")
def rows(spark):
    return table(spark).persist()


def plain_tree(x, g, h, s, depth=0):
    """The greatest gain at each node, tried at every value; pruned from the leaves up."""
    value = lambda g, h: -s.rate * bo.soft(g.sum(), s.alpha) / (h.sum() + s.lam)
    mark = lambda m: bo.soft(g[m].sum(), s.alpha) ** 2 / (h[m].sum() + s.lam)
    best, everything = None, np.ones(len(g), bool)
    if depth < s.depth:
        for f in range(x.shape[1]):
            for t in np.unique(x[:, f])[:-1]:
                left = x[:, f] <= t
                if min(h[left].sum(), h[~left].sum()) < s.least_weight:
                    continue
                gain = (mark(left) + mark(~left) - mark(everything)) / 2
                if gain > 1e-10 and (best is None or gain > best[0] + 1e-12):
                    best = gain, f, t, left
    if best is None:
        return ("leaf", value(g, h))
    gain, f, t, left = best
    sides = [plain_tree(x[m], g[m], h[m], s, depth + 1) for m in (left, ~left)]
    if gain < s.gamma and all(side[0] == "leaf" for side in sides):
        return ("leaf", value(g, h))
    return (f, t, *sides)


def of(tree, node=0):
    if tree.left[node] < 0:
        return ("leaf", tree.value[node])
    return (tree.feature[node], tree.threshold[node], of(tree, tree.left[node]), of(tree, tree.right[node]))


def alike(a, b):
    if a[0] == "leaf" or b[0] == "leaf":
        return a[0] == b[0] and a[1] == pytest.approx(b[1], rel=1e-9)
    return a[0] == b[0] and a[1] == pytest.approx(b[1]) and alike(a[2], b[2]) and alike(a[3], b[3])


@pytest.mark.parametrize("s", [bo.Settings(depth=3, bins=2_000), bo.Settings(depth=4, alpha=2.0, lam=3.0, gamma=1.5, least_weight=5.0, rate=0.1, bins=2_000)])
def test_trees_are_those_of_a_plain_grower(rows, s):
    fitted = bo.boost(rows, NAMES, 3, s)
    data = rows.where("train").toPandas()
    x, y, w = data[NAMES].to_numpy(), data.label.to_numpy(), data.weight.to_numpy()
    margin = np.zeros(len(x))
    for tree in fitted.model.trees:
        p = 1 / (1 + np.exp(-margin))
        assert alike(of(tree), plain_tree(x, w * (p - y), w * p * (1 - p), s))
        margin += bo.tree_values(tree, x)


def test_leaf_values_equal_the_closed_form_in_sql(spark, rows):
    s = bo.Settings(rate=0.2, depth=3, alpha=1.0, lam=2.0, bins=64)
    model = bo.boost(rows, NAMES, 2, s).model
    before = bo.with_margin(rows.where("train"), model.first(1)).toPandas()
    before["leaf"] = bo.leaf_of(model.trees[1], before[NAMES].to_numpy())
    spark.createDataFrame(before).createOrReplaceTempView("leaves")
    found = spark.sql("""with p as (select *, 1 / (1 + exp(-margin)) as p from leaves),
        s as (select leaf, sum(weight * (p - label)) as g, sum(weight * p * (1 - p)) as h from p group by leaf)
        select leaf, -0.2D * sign(g) * greatest(abs(g) - 1, 0) / (h + 2) as value from s""").collect()
    assert {r.leaf: pytest.approx(r.value) for r in found} == {r.leaf: model.trees[1].value[r.leaf] for r in found}


def test_more_regularisation_shrinks_leaves(rows):
    size = lambda **how: max(np.abs(t.value).max() for t in bo.boost(rows, NAMES, 1, bo.Settings(depth=2, **how)).model.trees)
    assert size(lam=0.1) > size(lam=50.0) and size(alpha=0.0) > size(alpha=20.0)
    count = lambda **how: len(bo.boost(rows, NAMES, 1, bo.Settings(depth=4, **how)).model.trees[0].left)
    assert count(gamma=0.0) > count(gamma=5.0) and count(gamma=1e9) == 1


def test_leaf_limit_takes_the_greatest_gains(rows):
    full = bo.boost(rows, NAMES, 1, bo.Settings(depth=4)).model.trees[0]
    for lossguide in (True, False):
        tree = bo.boost(rows, NAMES, 1, bo.Settings(depth=4, leaves=4, lossguide=lossguide)).model.trees[0]
        assert (tree.left < 0).sum() == 4 < (full.left < 0).sum()
        inner = tree.gain[tree.left >= 0]
        assert not lossguide or inner[1:].sum() >= np.sort(full.gain[full.left >= 0])[::-1][1:3].sum() * 0.5
    assert set(bo.boost(rows, NAMES, 1, bo.Settings(depth=3, by_tree=0.3)).model.trees[0].feature) - {-1} <= {0, 1, 2}
    one = bo.boost(rows, NAMES, 6, bo.Settings(depth=3, by_tree=0.3)).model
    assert all(len(set(t.feature) - {-1}) <= 1 for t in one.trees) and len({f for t in one.trees for f in t.feature}) > 2


def test_the_chosen_round_is_that_of_the_exact_curve(spark, monkeypatch):
    for seed in range(4):
        data = table(spark, 400, seed, 150).persist()
        s = bo.Settings(depth=2, rate=0.5, subsample=0.8, seed=seed)
        exact = bo.boost(data, NAMES, 25, s, patience=6)
        assert exact.best == tr.best_round(list(enumerate(exact.curve, 1)), 6)
        with monkeypatch.context() as m:  # validation rows are counted in few, wide buckets
            m.setattr(bo, "EXACT_ROWS", 0)
            m.setattr(bo, "BUCKETS", 64)
            counted = bo.boost(data, NAMES, 25, s, patience=6)
        assert counted.best == exact.best and counted.model.rounds == exact.model.rounds
        assert counted.curve.count(None) > 0 or all(a == pytest.approx(b) for a, b in zip(counted.curve, exact.curve))
        assert all(c is None or c == pytest.approx(e) for c, e in zip(counted.curve, exact.curve))


def test_exact_values_come_from_the_stored_blocks(spark, monkeypatch):
    """Validation rows are not read and scored by all trees again for each round that may be the best."""
    data = table(spark, 400, 5, 150).persist()
    s = bo.Settings(depth=2, rate=0.5, subsample=0.8)
    exact = bo.boost(data, NAMES, 12, s, patience=12)

    def read_again(*_):
        raise AssertionError("the rows are scored again")

    for name, value in {"EXACT_ROWS": 0, "RANGE_ROWS": 20, "BLOCK_ROWS": 50, "LATE": 2, "CHAIN": 2, "with_margin": read_again}.items():
        monkeypatch.setattr(bo, name, value)
    counted = bo.boost(data, NAMES, 12, s, patience=12)
    assert counted.best == exact.best and counted.curve.count(None) < 12
    assert all(c is None or c == pytest.approx(e, rel=1e-12) for c, e in zip(counted.curve, exact.curve))
    assert all(alike(of(a), of(b)) for a, b in zip(counted.model.trees, exact.model.trees))


def test_rows_dealt_out_by_node_are_in_the_leaves_found_row_by_row(rows, monkeypatch):
    tree = bo.boost(rows, NAMES, 1, bo.Settings(depth=4)).model.trees[0]
    x = np.append(rows.select(*NAMES).toPandas().to_numpy(), [[np.nan] * 3], axis=0)
    by_node = bo.leaf_of(tree, np.repeat(x, 3, axis=0))
    monkeypatch.setattr(bo, "FEW_NODES", 1 << 30)
    assert (by_node == bo.leaf_of(tree, np.repeat(x, 3, axis=0))).all() and len(set(by_node)) > 4


def test_leaves_by_columns_by_dealing_and_of_some_rows_agree(rows, monkeypatch):
    tree = bo.boost(rows, NAMES, 1, bo.Settings(depth=5, gamma=0.0)).model.trees[0]
    x = np.asfortranarray(np.repeat(np.random.default_rng(5).normal(size=(2000, 3)), 2, axis=0))
    some = np.flatnonzero(np.arange(len(x)) % 3 == 0)
    by_columns, of_some = bo.leaf_of(tree, x), bo.leaf_of(tree, x, rows=some)
    assert by_columns.dtype == np.uint8 and (of_some == by_columns[some]).all()
    monkeypatch.setattr(bo, "FEW_SPLITS", 0)
    assert (bo.leaf_of(tree, x) == by_columns).all() and (bo.leaf_of(tree, x, rows=some) == of_some).all()


def test_exact_values_of_the_rounds_between_two_updates_come_from_one_job(spark, monkeypatch):
    rows, s = table(spark, 500, 11, 200), bo.Settings(depth=2, rate=0.2, bins=16)
    asked, plain, brute = [], bo._State.precision, bo.boost(rows, NAMES, 11, s, patience=50).curve

    def counted(state, rounds):
        asked.append(list(rounds))
        return plain(state, rounds)

    for name, value in {"EXACT_ROWS": 0, "LATE": 4}.items():
        monkeypatch.setattr(bo, name, value)
    monkeypatch.setattr(bo._State, "precision", counted)
    found = bo.boost(rows, NAMES, 11, s, patience=50)
    assert 1 <= len(asked) <= 3  # before: one for every round that may be a rise
    exact = {n: v for n, v in enumerate(found.curve, 1) if v is not None}
    assert exact == pytest.approx({n: brute[n - 1] for n in exact}) and found.best == int(np.argmax(brute)) + 1


def test_patience_ends_a_fit_at_the_same_round_whether_values_are_found_late(spark, monkeypatch):
    rows, s = table(spark, 400, 12, 150), bo.Settings(depth=3, rate=0.5, bins=16)
    at_once = bo.boost(rows, NAMES, 40, s, patience=3)
    monkeypatch.setattr(bo, "EXACT_ROWS", 0)
    late = bo.boost(rows, NAMES, 40, s, patience=3)
    assert (late.best, late.model.rounds, len(late.curve)) == (at_once.best, at_once.model.rounds, len(at_once.curve)) and late.model.rounds < 40


def test_a_block_gives_back_its_rows(spark):
    rows = spark.range(5_000).selectExpr("id as key", "double(id % 2) as label", "double(id % 3) as weight", "id % 5 > 0 as train",
                                          "double(id % 7) as a")
    edges = [np.arange(6.0)]
    raw = [bytes(r[0]) for r in bo.blocks_of(rows, ["a"], edges, 1).collect()]
    assert len(raw) == 1 and len(raw[0]) < 24 * 5_000  # before: 34 bytes a row
    block = bo._Block(raw[0], 1)
    key = {r[0]: r[1:] for r in rows.selectExpr("xxhash64(key)", "label", "weight", "train", "a").collect()}
    assert [key[d] for d in block.draw.tolist()] == list(zip(block.label, block.weight, block.train, block.x[:, 0]))


def test_average_precision_and_its_bounds(spark):
    r = np.random.default_rng(3)
    margin, label = np.round(r.normal(size=300), 1), (r.random(300) < 0.2).astype(float)
    scored = spark.createDataFrame([(int(y), float(m)) for m, y in zip(margin, label)], "label int, p double")
    value = bo.average_precision(margin, label)
    assert value == pytest.approx(evaluate.average_precision(scored).first()[0])
    bucket = np.floor(margin).astype(int)
    order = sorted(set(bucket), reverse=True)
    counts = [[int(((bucket == b) & (label == k)).sum()) for b in order] for k in (1, 0)]
    low, high = bo.bounds_of_precision(*map(np.array, counts))
    assert low <= value <= high and bo.average_precision(margin, np.zeros(300)) is None


def test_many_blocks_give_the_same_trees(spark, rows, monkeypatch):
    s = bo.Settings(depth=3, subsample=0.7)
    one = bo.boost(rows, NAMES, 4, s, patience=50)
    with monkeypatch.context() as m:
        m.setattr(bo, "BLOCK_ROWS", 40)
        m.setattr(bo, "HISTOGRAM_CELLS", 100)
        m.setattr(bo, "REFRESH", 2)
        many = bo.boost(rows, NAMES, 4, s, patience=50)
    assert all(alike(of(a), of(b)) for a, b in zip(one.model.trees, many.model.trees))
    assert many.curve == pytest.approx(one.curve)


def test_a_killed_fit_goes_on_behind_the_last_stored_round(rows, tmp_path, monkeypatch):
    s, grown = bo.Settings(depth=2, subsample=0.9), []
    whole = bo.boost(rows, NAMES, 9, s, patience=50)
    monkeypatch.setattr(bo, "REFRESH", 3)
    plain = bo._grown

    def dies_in_round_seven(state, number, settings):
        grown.append(number)
        if len(grown) == 8:
            raise RuntimeError("the driver dies")
        return plain(state, number, settings)

    monkeypatch.setattr(bo, "_grown", dies_in_round_seven)
    with pytest.raises(RuntimeError, match="dies"):
        bo.boost(rows, NAMES, 9, s, patience=50, ledger=str(tmp_path))
    again = bo.boost(rows, NAMES, 9, s, patience=50, ledger=str(tmp_path))
    assert grown == [*range(8), 6, 7, 8]
    assert all(alike(of(a), of(b)) for a, b in zip(whole.model.trees, again.model.trees)) and len(again.model.trees) == 9
    assert again.curve == pytest.approx(whole.curve)
    third = bo.boost(rows, NAMES, 9, s, patience=50, ledger=str(tmp_path))
    assert grown == [*range(8), 6, 7, 8] and third.curve == pytest.approx(whole.curve)


def test_odd_inputs(spark, rows):
    with pytest.raises(ValueError, match="not 0 or 1"):
        bo.boost(rows.withColumn("label", rows.label + 1), NAMES, 1, bo.Settings())
    with pytest.raises(ValueError, match="no row to fit on"):
        bo.boost(rows.where("not train"), NAMES, 1, bo.Settings())
    one_kind = bo.boost(rows.where("label = 0"), NAMES, 2, bo.Settings(), patience=5)
    assert one_kind.best == 1 and one_kind.curve == [None, None]
    constant = bo.boost(rows.selectExpr("key", "label", "weight", "train", "0.0D as a", "1.0D as b", "-1.0D as c"), NAMES, 1, bo.Settings())
    assert len(constant.model.trees[0].left) == 1


def test_missing_features_and_importances(spark):
    rows = feature_rows(spark, [(i, int(i % 4 == 0), {"amount": None if i % 4 == 0 else float(i)}) for i in range(400)])
    model = tr.fit(rows, {"min_child_weight": 0.1, "subsample": 1.0, "colsample_bytree": 1.0}, 3)
    shares = model.importances()
    assert shares["amount"] == pytest.approx(1.0) and set(shares) == set(schema.FEATURES)
    scored = tr.score(model, rows).groupBy("label").avg("p").collect()
    by = {r.label: r["avg(p)"] for r in scored}
    assert by[1] > by[0]


def test_a_search_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    rows = feature_rows(spark, [(i, int(i % 5 == 0), {"amount": float(i % 7 + (i % 5 == 0)), "hour": float(i % 24)}) for i in range(300)])
    ran, plain = [], tr.run_trial

    def counted(trial, *rest):
        ran.append(trial)
        return plain(trial, *rest)

    monkeypatch.setattr(tr, "run_trial", counted)
    how = {"max_iter": 2, "parallelism": 1, "ledger": str(tmp_path)}
    first = tr.search(rows, rows, 2, **how).collect()
    again = tr.search(rows, rows, 4, **how).orderBy("trial").collect()
    assert ran == [0, 1, 2, 3] and [r.trial for r in again] == [0, 1, 2, 3]
    assert [(r.trial, r.score, r.seconds) for r in again[:2]] == [(r.trial, r.score, r.seconds) for r in sorted(first)]
    other = tr.search(rows, rows, 2, seed=7, **how)  # other parameters are other trials
    assert ran == [0, 1, 2, 3, 0, 1] and other.count() == 2


def test_a_worker_remembers_the_margins_of_many_small_blocks(spark, monkeypatch):
    """No tree is added to a block's margins twice, as long as all margins of a worker are small together."""
    data = table(spark, 600, 3, 150)
    tree = bo.boost(data, NAMES, 1, bo.Settings(depth=2, rate=0.5)).model.trees[0]
    edges = bo.bin_edges(data.where("train"), NAMES, 256)
    monkeypatch.setattr(bo, "BLOCK_ROWS", 5)
    raws = [bytes(r.data) for r in bo.blocks_of(data, NAMES, edges, 2).collect()]
    asked, leaf_of = [], bo.leaf_of
    monkeypatch.setattr(bo, "leaf_of", lambda *how: asked.append(1) or leaf_of(*how))
    read = lambda trees: [bo._Block(raw, 3, "a run", 0, trees).margin.copy() for raw in raws]
    once, again = read([tree]), read([tree, tree])
    assert len(raws) > 100 and len(asked) == 2 * len(raws)
    assert all((2 * a == b).all() for a, b in zip(once, again)) and any(a.any() for a in once)


def test_kept_blocks_are_held_as_they_are_read(spark):
    stored = spark.sparkContext.parallelize([], 1)
    state = bo._State(stored, stored, 3, [], True)
    state.refreshed([])
    level = state.blocks.getStorageLevel()
    state.blocks.unpersist()
    assert level.deserialized and level.useMemory and level.useDisk


def test_gradient_sums_equal_the_closed_form_whatever_the_spare_arrays_held(spark):
    data = table(spark, 300, 4, 100)
    edges = bo.bin_edges(data.where("train"), NAMES, 256)
    raw, spare = bytes(bo.blocks_of(data, NAMES, edges, 1).first().data), {}
    block = bo._Block(raw, 3)
    block.margin = np.linspace(-3, 3, 300)
    weight = block.weight
    for rows in (np.arange(300), np.arange(0, 300, 7), np.arange(0)):
        p = 1 / (1 + np.exp(-block.margin[rows]))
        g, h = block.sums(rows, spare)
        assert (g == weight[rows] * (p - block.label[rows])).all() and (h == weight[rows] * np.maximum(p * (1 - p), 1e-16)).all()
    assert set(weight) == {1.0, 2.0, 3.0}


def few_bins(spark, n=900, seed=21, validation=300):
    """Rows with three more features of 2, 3 and 5 values that tell nothing."""
    more = [f"double(pmod(xxhash64(key, {k}), {k})) as {name}" for name, k in (("d", 2), ("e", 3), ("f", 5))]
    return table(spark, n, seed, validation).selectExpr("*", *more), [*NAMES, "d", "e", "f"]


@pytest.mark.parametrize("least, read", [(2.0, 4), (0.5, 8)])
def test_of_two_siblings_the_smaller_one_is_read(spark, monkeypatch, least, read):
    data, names = few_bins(spark)
    s = bo.Settings(depth=4, subsample=0.9, bins=32, least_weight=least)
    one = bo.boost(data, names, 3, s, patience=50)
    nodes, plain = [], bo._State.job

    def counted(state, work, shapes, *plan):
        nodes.append(shapes[0][0] if shapes[0] and len(shapes[0]) == 3 else 0)
        return plain(state, work, shapes, *plan)

    monkeypatch.setattr(bo, "BLOCK_ROWS", 50)
    monkeypatch.setattr(bo._State, "job", counted)
    many = bo.boost(data, names, 3, s, patience=50)
    assert all(alike(of(a), of(b)) for a, b in zip(one.model.trees, many.model.trees))
    assert many.curve == pytest.approx(one.curve) and max(nodes) == read


def test_features_with_few_bins_are_counted_together():
    r, counts, n = np.random.default_rng(5), [40, 2, 5, 3, 31, 1], 2_000
    x = np.asfortranarray(np.stack([r.integers(0, c, n) for c in counts], axis=1).astype(np.uint8))
    node, sums = r.integers(0, 3, n), r.integers(-9, 9, (n, 2))
    plain = np.concatenate([np.stack([[np.bincount(x[node == k, f], sums[node == k, i], c) for i in range(2)] for k in range(3)])
                            for f, c in enumerate(counts)], axis=2).transpose(0, 2, 1)
    for limit, size in ((1_024, 2), (30, 3), (0, 6)):
        groups = bo.bundles(counts, limit)
        assert sorted(sum(groups, [])) == list(range(6)) and len(groups) == size
        assert all(len(g) == 1 or np.prod([counts[c] for c in g]) <= limit for g in groups)
        joint = [bo._joint(x, g, [counts[c] for c in g]) for g in groups]
        cells = [int(np.prod([counts[c] for c in g])) for g in groups]
        held = np.concatenate([np.stack([[np.bincount(j[node == k], sums[node == k, i], c) for i in range(2)] for k in range(3)])
                               for j, c in zip(joint, cells)], axis=2).transpose(0, 2, 1)
        assert (bo._spread(held, groups, counts) == plain).all()


def test_a_table_of_several_blocks_has_at_most_a_task_per_core(spark, monkeypatch):
    parts, plain = [], bo.blocks_of
    monkeypatch.setattr(bo, "BLOCK_ROWS", 10)
    monkeypatch.setattr(bo, "blocks_of", lambda *how: parts.append(how[-1]) or plain(*how))
    bo.boost(table(spark, 300, 4, 100), NAMES, 1, bo.Settings(depth=1))
    monkeypatch.setattr(bo, "TASK_ROWS", 20)
    bo.boost(table(spark, 300, 4, 100), NAMES, 1, bo.Settings(depth=1))
    assert parts == [spark.sparkContext.defaultParallelism, 15]
