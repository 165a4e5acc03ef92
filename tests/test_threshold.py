"""Threshold sweeps and evaluation tables against direct computation."""

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator

from ledgerlens.operators import evaluate, report, threshold as th


def _scored(spark, rows):
    return spark.createDataFrame([(i, int(y), None if p is None else float(p)) for i, (y, p) in enumerate(rows)],
                                 "tx_id long, label int, p double")


def _random(n=400, seed=3, digits=None):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.2).astype(int)
    p = np.clip(rng.normal(0.3 + 0.3 * y, 0.2), 0, 1)
    return list(zip(y, np.round(p, digits) if digits else p))


@pytest.mark.parametrize("digits", [None, 2])
@pytest.mark.parametrize("preset", ["device", "host", "search"])
def test_sweep_equals_counting(spark, preset, digits):
    rows = _random(digits=digits) + [(1, 0.0), (0, 1.0), (1, None), (0, float("nan")), (1, 0.05), (0, 0.95)]
    grid = th.PRESETS[preset].grid
    points = np.linspace(grid.low, grid.high, grid.n)
    got = th.threshold_sweep(_scored(spark, rows), grid).orderBy("threshold").collect()
    y = np.array([r[0] for r in rows])
    p = np.array([np.nan if r[1] is None else r[1] for r in rows], dtype=float)
    assert len(got) == grid.n
    for t, r in zip(points, got):
        assert r.threshold == pytest.approx(t, abs=1e-12)
        hit = p >= r.threshold
        assert (r.tp, r.fp) == (int((hit & (y == 1)).sum()), int((hit & (y == 0)).sum()))
        assert (r.fn, r.tn) == (int((~hit & (y == 1)).sum()), int((~hit & (y == 0)).sum()))


def test_grouped_choice_equals_single_choices(spark):
    a, b = _scored(spark, _random(seed=1)), _scored(spark, _random(seed=2))
    both = a.selectExpr("1 as g", "*").unionByName(b.selectExpr("2 as g", "*"))
    got = {r.g: (r.threshold, r.score) for r in th.choose_threshold(both, "host", by=["g"]).collect()}
    for g, one in ((1, a), (2, b)):
        r = th.choose_threshold(one, "host").first()
        assert got[g] == (r.threshold, r.score)


def test_no_valid_threshold_gives_the_default(spark):
    for rows in ([(0, 0.9), (0, 0.8)], [(0, 0.9), (1, 0.01)]):
        r = th.choose_threshold(_scored(spark, rows), "search").first()
        assert (r.threshold, r.score) == (0.5, 0.0)
    g = th.choose_threshold(_scored(spark, [(0, 0.9)]).selectExpr("1 as g", "*"), "search", by=["g"]).first()
    assert (g.threshold, g.score) == (0.5, 0.0)


def test_false_positive_rate_is_one_without_negatives(spark):
    assert {r.fpr for r in th.threshold_sweep(_scored(spark, [(1, 0.4), (1, 0.6)]), th.CURVE_GRID).collect()} == {1.0}


@pytest.mark.parametrize("digits", [None, 1])
def test_auc_equals_the_built_in_evaluator(spark, digits):
    scored = _scored(spark, _random(digits=digits))
    mine = evaluate.ranking_metrics(scored).first()
    other = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="label", numBins=0).evaluate(scored.selectExpr("double(label) as label", "p"))
    assert mine.auc_roc == pytest.approx(other)
    by_hand = sorted(((p, y) for y, p in _random(digits=digits)), reverse=True)
    tp = fp = 0
    ap, last, total = 0.0, 0.0, sum(y for _, y in by_hand)
    for i, (p, y) in enumerate(by_hand):
        tp, fp = tp + y, fp + 1 - y
        if i + 1 == len(by_hand) or by_hand[i + 1][0] != p:
            ap, last = ap + (tp / total - last) * tp / (tp + fp), tp / total
    assert mine.auc_pr == pytest.approx(ap)


def test_all_scores_equal_or_one_class(spark):
    same = _scored(spark, [(1, 0.5), (0, 0.5), (0, 0.5)])
    assert tuple(evaluate.ranking_metrics(same).first()) == pytest.approx((0.5, 1 / 3))
    one = evaluate.ranking_metrics(_scored(spark, [(0, 0.5), (0, 0.7)])).first()
    assert one.auc_roc is None and one.auc_pr is None
    cells = evaluate.confusion_matrix(evaluate.confusion_counts(th.predict_at(_scored(spark, [(0, 0.5)]), 0.6)))
    assert sorted(map(tuple, cells.collect())) == [(0, 0, 1), (0, 1, 0), (1, 0, 0), (1, 1, 0)]


def test_histogram_equals_numpy(spark):
    rows = _random(digits=2) + [(1, 1.0)]
    got = evaluate.score_histogram(_scored(spark, rows)).orderBy("label", "bin").collect()
    for label in (0, 1):
        p = [r[1] for r in rows if r[0] == label]
        n, edges = np.histogram(p, bins=50)
        density, _ = np.histogram(p, bins=50, density=True)
        mine = [r for r in got if r.label == label]
        assert [r.n for r in mine] == n.tolist()
        assert [r.density for r in mine] == pytest.approx(density.tolist())
        assert [r.left for r in mine] == pytest.approx(edges[:-1].tolist())


def test_histogram_of_one_value(spark):
    got = evaluate.score_histogram(_scored(spark, [(0, 0.5), (0, 0.5)])).where("n > 0").collect()
    n, edges = np.histogram([0.5, 0.5], bins=50)
    assert [(r.bin, r.n) for r in got] == [(int(np.argmax(n)), 2)]


def _metrics(spark, **values):
    base = dict(precision=0.4, recall=0.5, f1=0.45, auc_roc=0.8, fpr=0.01, specificity=0.99, investigation_efficiency=0.4)
    base.update(values)
    return spark.createDataFrame([tuple(base.values())], ", ".join(f"{k} double" for k in base))


@pytest.mark.parametrize("values,points,verdict", [
    ({}, 5.0, "OUTSTANDING"), ({"precision": 0.6}, 4.5, "OUTSTANDING"), ({"precision": 0.1, "recall": 0.1}, 3.0, "SOLID"),
    ({"precision": 0.1, "recall": 0.1, "f1": 0.1}, 2.0, "ACCEPTABLE"),
    ({"precision": 0.1, "recall": 0.1, "f1": 0.1, "auc_roc": 0.5}, 1.0, "NEEDS_IMPROVEMENT")])
def test_grades(spark, values, points, verdict):
    r = report.grade_summary(report.grade_targets(_metrics(spark, **values))).first()
    assert (r.points, r.verdict) == (points, verdict)


def test_high_false_positive_rate_is_graded_good_but_outside_its_limit(spark):
    r = report.grade_targets(_metrics(spark, fpr=0.2)).where("metric = 'fpr'").first()
    assert (r.grade, r.within_limit) == ("GOOD", False)


@pytest.mark.parametrize("values,status", [({}, "DEPLOY"), ({"fpr": 0.05, "precision": 0.2}, "REVIEW"), ({"fpr": 0.2, "precision": 0.05}, "IMPROVE")])
def test_readiness(spark, values, status):
    assert report.readiness(_metrics(spark, **values)).first()["status"] == status


def test_prediction_sample_is_the_first_rows_by_key(spark):
    predicted = th.predict_at(_scored(spark, _random()), 0.5)
    assert [r.tx_id for r in evaluate.prediction_sample(predicted, 7).collect()] == list(range(7))
