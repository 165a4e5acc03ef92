"""Fits, search, saved models and whole runs on a small CSV."""

import numpy as np
import pytest
from pyspark.sql.functions import expr

from ledgerlens import schema
from ledgerlens.operators import split as sp, training as tr
from ledgerlens.plans import fixture, runner
from ledgerlens.plans.queries import FIT, _splits
from ledgerlens.session import cut_lineage
from ledgerlens.sources import stages

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def parts(spark):
    rows = cut_lineage(_splits(spark, SF))
    return [rows.where(f"split = '{n}'").drop("split") for n in ("train", "val", "test")]


@pytest.fixture(scope="module")
def model(parts):
    return tr.fit(parts[0], FIT, 8, weight_cap=100.0)


def test_scores_are_probabilities_that_rank_well(parts, model):
    scored = tr.score(model, parts[2])
    low, high, n = scored.selectExpr("min(p)", "max(p)", "count(*)").first()
    assert 0 <= low < high <= 1 and n == parts[2].count()
    from ledgerlens.operators.evaluate import ranking_metrics
    assert ranking_metrics(scored).first().auc_roc > 0.9


def test_saved_model_scores_the_same(spark, parts, model, tmp_path):
    stages.write_model(model, str(tmp_path))
    again = tr.score(stages.read_model(str(tmp_path)), parts[2])
    assert again.exceptAll(tr.score(model, parts[2])).count() == 0


def test_learning_curve_ends_at_the_model(parts, model):
    from ledgerlens.operators.evaluate import ranking_metrics
    curve = tr.learning_curve(model, {"test": parts[2]}).orderBy("round").collect()
    assert [r.round for r in curve] == list(range(1, len(curve) + 1))
    assert curve[-1].auc_pr == pytest.approx(ranking_metrics(tr.score(model, parts[2])).first().auc_pr, abs=0.01)


def test_curve_of_a_small_model_by_exact_ranking(parts):
    """Few leaves give few distinct margins, which all have buckets of their own: the curve is the exact one."""
    small = tr.fit(parts[0], {**FIT, "max_depth": 2.0}, 3, weight_cap=100.0)
    curve = {r.round: r.auc_pr for r in tr.learning_curve(small, {"test": parts[2]}).collect()}
    assert sorted(curve) == [1, 2, 3]
    for rounds, got in curve.items():
        rows = [(r.p, r.label) for r in tr.score(small.first(rounds), parts[2]).collect()]
        total, seen, hits, exact = sum(y for _, y in rows), 0, 0, 0.0
        for p in sorted({p for p, _ in rows}, reverse=True):
            group = [y for q, y in rows if q == p]
            seen, hits = seen + len(group), hits + sum(group)
            exact += sum(group) * hits / seen / total
        assert got == pytest.approx(exact, abs=1e-9)


def test_importances_by_sql_over_the_saved_trees(spark, model, tmp_path):
    import duckdb
    path = stages.write_model(model, str(tmp_path))
    got = dict(duckdb.sql(f"""with gains as (select feature, avg(gain) as mean from '{path}/nodes/*.parquet' where "left" >= 0 group by 1)
                              select cast(feature as int), mean / sum(mean) over () from gains""").fetchall())
    top = {r.feature: r.importance for r in tr.top_features(model, spark, len(schema.FEATURES)).collect()}
    assert {f: pytest.approx(got.get(i, 0.0), abs=1e-12) for i, f in enumerate(model.features)} == top and len(got) > 1


def test_top_features(spark, model):
    rows = tr.top_features(model, spark, 5).collect()
    assert len(rows) == 5 and rows[0].importance >= rows[-1].importance
    assert {r.feature for r in rows} <= set(schema.FEATURES)


@pytest.mark.parametrize("space", ["narrow", "wide"])
def test_draws_stay_in_range_and_repeat(spark, space):
    draws = [dict(r.params) for r in tr.sample_params(spark, 50, 42, space).orderBy("trial").collect()]
    for name, kind, low, high in tr.SEARCH_SPACES[space]:
        values = [d[name] for d in draws]
        assert low <= min(values) and max(values) <= high + 1e-9 and len(set(values)) > 1
        assert kind != "int" or all(v == int(v) for v in values)
    assert draws == [dict(r.params) for r in tr.sample_params(spark, 50, 42, space).orderBy("trial").collect()]
    assert draws != [dict(r.params) for r in tr.sample_params(spark, 50, 1, space).orderBy("trial").collect()]


def test_fallback_parameters():
    assert tr.fallback_params("narrow", 80.0)["scale_pos_weight"] == 50.0
    assert tr.fallback_params("wide")["max_bin"] == 1024.0


def test_best_round_waits_as_long_as_patience():
    assert tr.best_round([(1, 0.2), (2, 0.5), (3, 0.4), (4, 0.4), (5, 0.9)], 2) == 2
    assert tr.best_round([(1, 0.2), (2, 0.5), (3, 0.4), (4, 0.4), (5, 0.9)], 3) == 5
    assert tr.best_round([(1, None), (2, None)], 2) == 1


QUICK = {**FIT, "max_depth": 2.0}


def test_first_rounds_are_a_prefix(parts):
    short, long = tr.fit(parts[0], QUICK, 3), tr.fit(parts[0], QUICK, 6)
    cut = long.first(3)
    assert cut.rounds == 3 and tr.score(cut, parts[2]).exceptAll(tr.score(short, parts[2])).count() == 0
    assert short.first(9) is short


def test_patience_ends_a_fit_or_all_rounds_run(parts):
    from ledgerlens.operators.evaluate import average_precision
    slow = {**QUICK, "learning_rate": 0.01, "n_estimators": 20.0}
    assert tr.fit_patient(parts[0], parts[1], slow, patience=20).model.rounds == 20
    found = tr.fit_patient(parts[0], parts[1], {**QUICK, "n_estimators": 5_000.0}, patience=8)
    assert found.model.rounds < 5_000 and len(found.curve) == found.model.rounds == found.best + 8
    assert found.best == tr.best_round(list(enumerate(found.curve, 1)), 8) == 1 + max(range(len(found.curve)), key=lambda i: found.curve[i])
    for n in (1, found.best):
        assert average_precision(tr.score(found.model.first(n), parts[1])).first()[0] == pytest.approx(found.curve[n - 1])


def test_positive_weight_of_the_parameters_is_the_one_fitted(parts):
    rare = parts[0].where("isFraud = 0 or tx_id % 37 = 0")  # imbalance above the limit of 50
    given = tr.fallback_params("narrow", 400.0)
    assert given["scale_pos_weight"] == 50.0
    as_given = tr.score(tr.fit(rare, {**QUICK, "scale_pos_weight": 50.0}, 2, weight_cap=100.0), parts[2])
    by_hand = tr.score(tr.fit(rare, QUICK, 2, weight_cap=50.0), parts[2])
    measured = tr.score(tr.fit(rare, QUICK, 2, weight_cap=1e9), parts[2])
    assert as_given.exceptAll(by_hand).count() == 0 and as_given.exceptAll(measured).count() > 0


def test_failed_trial_scores_zero_and_keeps_its_error(parts):
    record = tr.run_trial(0, {"max_depth": 99.0}, parts[0], parts[1], max_iter=1)
    assert record["score"] == 0.0 and record["state"].startswith("FAILED") and "max_depth" in record["state"]


def test_search_fails_if_every_trial_does(parts):
    with pytest.raises(RuntimeError, match="every trial failed"):
        tr.search(parts[0].withColumn("isFraud", parts[0].isFraud + 7), parts[1], n_trials=1, max_iter=1)


def test_search_skips_trials_after_the_time_limit(spark, parts):
    trials = tr.search(parts[0], parts[1], n_trials=3, timeout_minutes=1e-9, max_iter=1).collect()
    assert [(t.state, t.score, t.rounds_used) for t in trials] == [("SKIPPED", 0.0, None)] * 3


def _trials(spark, rows):
    return spark.createDataFrame([(i, {}, [], 1, 1, s, t, p, r, f, x, 1.5, st) for i, s, t, p, r, f, x, st in rows], tr.TRIALS_SCHEMA)


def test_best_trial_and_checks(spark):
    trials = _trials(spark, [(0, 0.5, 0.2, 0.3, 0.5, 0.36, 0.04, "COMPLETE"), (1, 0.9, 0.3, 0.5, 0.4, 0.4, 0.06, "COMPLETE"),
                             (2, 0.9, 0.4, 0.6, 0.5, 0.5, 0.01, "COMPLETE"), (3, 0.0, None, None, None, None, None, "FAILED: X")])
    best = tr.search_summary(trials).first()
    assert (best.trial, best.best_threshold, best.n_trials, best.n_completed_trials, best.optimization_seconds) == (1, 0.3, 4, 3, 6.0)
    checks = tr.target_checks(tr.search_summary(trials)).collect()
    assert {r.check: r.passed for r in checks} == {"precision": True, "recall": False, "f1": True, "fpr": False}
    assert {(r.success_percent, r.band) for r in checks} == {(50.0, "GOOD")}
    failed = tr.search_summary(trials.where("trial = 3")).first()
    assert (failed.best_threshold, failed.best_precision, failed.best_fpr) == (0.5, 0.0, 1.0)


def _csv(spark, path, limit=150):
    fixture.transactions(spark, SF, limit).select(*schema.CSV_SCHEMA.names).write.option("header", True).csv(path)


def test_whole_run_and_single_step(spark, tmp_path):
    source, work = str(tmp_path / "csv"), str(tmp_path / "work")
    _csv(spark, source, limit=235)  # imbalance between 100 and 150: rows are both added and removed
    log = runner.run_all(spark, source, work, runner.Settings(n_trials=1, max_iter=3))
    assert [(r.step, r.success, r.error) for r in log.orderBy("step").collect()] == [(i, True, None) for i in range(1, 6)]
    read = {n: stages.read_split(spark, work, n) for n in ("train", "val", "test", "train_balanced")}
    removed = stages.read_table(spark, work, "removed")
    method = stages.read_table(spark, work, "split_metadata").first()["sampling_method"]
    assert method == "smote_tomek (8%)"
    added = read["train_balanced"].where("is_synthetic").count()
    assert added > 0 and removed.count() > 0
    assert read["train_balanced"].count() == read["train"].count() - removed.count() + added
    for a, b in (("train", "test"), ("train", "val"), ("val", "test")):
        assert read[a].join(read[b], "tx_id", "left_semi").count() == 0
    metrics = stages.read_table(spark, work, "metrics").first()
    assert metrics.tp + metrics.fp + metrics.fn + metrics.tn == read["test"].count()
    package = stages.read_table(spark, work, "package").first()
    assert package.feature_names == schema.FEATURES and package.threshold == metrics.threshold
    again = runner.run_step(spark, 3, source, work)
    assert again["success"] and stages.read_split(spark, work, "train_balanced").where("is_synthetic").count() == added


def test_run_stops_at_the_first_failure(spark, tmp_path):
    log = runner.run_all(spark, str(tmp_path / "absent"), str(tmp_path / "work")).collect()
    assert [(r.step, r.success) for r in log] == [(1, False)] and "absent" in log[0].error


def test_rows_without_a_label_fail_the_first_step(spark, tmp_path):
    source = str(tmp_path / "csv")
    rows = fixture.transactions(spark, SF).select(*schema.CSV_SCHEMA.names)
    rows.withColumn("isFraud", expr("if(step = 1, null, isFraud)")).write.option("header", True).csv(source)
    record = runner.run_step(spark, 1, source, str(tmp_path / "work"))
    assert not record["success"] and "have no isFraud" in record["error"]


def test_run_summary_of_no_steps(spark):
    r = runner.run_summary(spark.createDataFrame([], runner.LOG_TYPES)).first()
    assert (r.steps_run, r.total_duration, r.remaining_estimate) == (0, None, None)
