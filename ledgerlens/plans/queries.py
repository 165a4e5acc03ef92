"""Registered queries: every operator over whole tables derived from the given `events`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import expr

from ledgerlens import schema
from ledgerlens.operators import clean, evaluate, features as fe, neighbours, partials, profile, report, resample as rs
from ledgerlens.operators import split as sp, threshold as th, training as tr
from ledgerlens.plans import fixture, runner
from ledgerlens.session import cut_lineage, scratch_path
from ledgerlens.sources import publish, stages
from ledgerlens.sources.transactions import append_chunks, content_keys, read_transactions

Query = Callable[[SparkSession, str], DataFrame]

# Label limits at which each resampling method is the one chosen, and scales of the closed-form trial scores.
LIMITS = {"smote": 150, "smote_tomek": 240, "adasyn": 250, "borderline_smote": 300}
TRIAL_SCALES = [100_000, 200_000, 300_000, 400_000, 500_000, 600_000]
FIT = {"n_estimators": 400.0, "max_depth": 4.0, "learning_rate": 0.15, "subsample": 0.9, "min_child_weight": 2.0}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Fractions as DOUBLE with a fixed number of digits, so that results compare across engines."""
    return df.selectExpr(*[f"round(cast({c} as double), {digits}) as {c}" if t in ("float", "double") else c
                           for c, t in df.dtypes])


_tx = fixture.transactions


def _kept(spark: SparkSession, sf: str) -> DataFrame:
    return clean.filter_types(_tx(spark, sf))


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return fixture.scored(_kept(spark, sf))


def _features(spark: SparkSession, sf: str, limit: int = 150) -> DataFrame:
    return fe.engineer_features(_tx(spark, sf, limit))


def _splits(spark: SparkSession, sf: str, limit: int = 150) -> DataFrame:
    return sp.stratified_split(cut_lineage(_features(spark, sf, limit)))


def _train(spark: SparkSession, sf: str, limit: int = 150) -> DataFrame:
    return cut_lineage(_splits(spark, sf, limit).where("split = 'train'").drop("split"))


def _predicted(spark: SparkSession, sf: str) -> DataFrame:
    scored = _scored(spark, sf)
    return th.predict_at(scored, th.choose_threshold(scored, "device"))


def _metrics(spark: SparkSession, sf: str) -> DataFrame:
    scored = _scored(spark, sf)
    chosen = cut_lineage(th.choose_threshold(scored, "device"))
    return evaluate.test_metrics(th.predict_at(scored, chosen), chosen)


def _trials(spark: SparkSession, sf: str) -> DataFrame:
    """A trial table from real sweeps: each trial scores the same rows with another closed form."""
    scales = ", ".join(f"struct({i} as trial, {s}.0D as scale)" for i, s in enumerate(TRIAL_SCALES))
    rows = _kept(spark, sf).selectExpr("amount", "isFraud as label", f"inline(array({scales}))")
    scored = rows.selectExpr("trial", "label", "round(cast(amount as double) / (amount + scale), 6) as p")
    best = th.choose_threshold(scored, "search", by=["trial"])
    return best.selectExpr("trial", "score", "threshold", "precision", "recall", "f1", "fpr",
                           "10.0D + trial as seconds", "if(trial = 5, 'FAILED', 'COMPLETE') as state")


def _summary(spark: SparkSession, sf: str) -> DataFrame:
    return tr.search_summary(cut_lineage(_trials(spark, sf)))


def _csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark)
    _tx(spark, sf).select(*schema.CSV_SCHEMA.names).write.option("header", True).csv(path)
    rows = cut_lineage(read_transactions(spark, path))
    keys = rows.selectExpr(f"struct(count(distinct {schema.KEY}) as keys, "
                           f"min({schema.KEY}) = 0 and max({schema.KEY}) = count(*) - 1 as dense)")  # the numbers 0 to n - 1
    return rounded(rows.drop(schema.KEY)).withColumn("_k", keys.scalar()).selectExpr("* except (_k)", "_k.*")


def _chunks(spark: SparkSession, sf: str) -> DataFrame:
    tx = _tx(spark, sf)
    return rounded(append_chunks([tx.where(f"step % 3 = {i}") for i in range(3)]))


def _written_splits(spark: SparkSession, sf: str) -> str:
    """The work folder of a split step: three parts, and what turns train into balanced train."""
    work = scratch_path(spark)
    stages.write_splits(_splits(spark, sf), work)
    balanced = rs.resample(stages.read_split(spark, work, "train").drop("split", "is_synthetic"))
    stages.add_balancing(work, balanced.synthetic, balanced.removed, spark)
    return work


def _all_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the three parts and of balanced train, with the part's name as `split`."""
    work = _written_splits(spark, sf)
    return append_chunks([stages.read_split(spark, work, n).drop("split", "is_synthetic").selectExpr("*", f"'{n}' as split")
                          for n in ("train", "val", "test", "train_balanced")])


def _moments(spark: SparkSession, sf: str, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Moments of train and of balanced train."""
    rows = _all_parts(spark, sf)
    return append_chunks([make(profile.feature_moments(rows.where(f"split = '{n}'").drop("split"))).selectExpr(
        f"'{n}' as split", "*") for n in ("train", "train_balanced")])


def _stage_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_all_parts(spark, sf).withColumnRenamed("split", "part"), 3)


def _leftover_strings(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(clean.encode_remaining_strings(_tx(spark, sf).select(schema.KEY, "type", "nameOrig", "nameDest")))


def _float_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(clean.to_float_features(clean.select_xy(clean.drop_leakage(_kept(spark, sf)))))


def _audit(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.split_audit(_all_parts(spark, sf)), 3)


def _knn_minority_all(spark: SparkSession, sf: str, **how) -> DataFrame:
    train = _train(spark, sf)
    return rounded(neighbours.knn(train.where("isFraud = 1"), train, 5, **how).drop("nn_v"), 4)


def _resampled(name: str, make: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: rounded(make(_train(spark, sf, LIMITS[name])), 3)


def _smote_synthetic(train: DataFrame) -> DataFrame:
    return rs.smote(train, 0.15, 5)


def _tomek_rows(train: DataFrame) -> DataFrame:
    return rs.smote_tomek(train, 0.08, 5).rows


def _tomek_links(spark: SparkSession, sf: str) -> DataFrame:
    return rs.tomek_links(_train(spark, sf, LIMITS["smote"]))


def _balanced_summary(spark: SparkSession, sf: str) -> DataFrame:
    train = _train(spark, sf)
    balanced = rs.resample(train)
    return rounded(rs.resample_summary(train, balanced.rows, balanced.method))


def _appended(spark: SparkSession, sf: str) -> DataFrame:
    train = _train(spark, sf)
    return rounded(rs.with_synthetic(train, rs.smote(train)), 3)


def _parts(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    splits = cut_lineage(_splits(spark, sf))
    return {n: splits.where(f"split = '{n}'").drop("split") for n in ("train", "val", "test")}


def _fitted(spark: SparkSession, sf: str):
    parts = _parts(spark, sf)
    return *tr.fit_final(parts["train"], parts["val"], FIT, weight_cap=100.0), parts


def _score_rows(spark: SparkSession, sf: str) -> DataFrame:
    model, _, parts = _fitted(spark, sf)
    return tr.score(model, parts["test"])


def _model_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Per part: rows, distinct keys, scores outside 0 to 1, and rows that the saved and reloaded model scores alike."""
    model, _, parts = _fitted(spark, sf)
    work = scratch_path(spark)
    stages.write_model(model, work)
    again = stages.read_model(work)
    return append_chunks([
        tr.score(model, rows).join(tr.score(again, rows).selectExpr(schema.KEY, "p as p2"), schema.KEY, "left").selectExpr(
            f"'{name}' as part", "count(*) as n", f"count(distinct {schema.KEY}) as keys",
            "count_if(p is null or p < 0 or p > 1) as outside", "count_if(p = p2) as same_after_reload")
        for name, rows in parts.items()])


def _feature_rows(spark: SparkSession, sf: str) -> DataFrame:
    return tr.top_features(_fitted(spark, sf)[0], spark)


def _top_features(spark: SparkSession, sf: str) -> DataFrame:
    """What the list of the most important features must fulfil, its values held against the table of the saved trees."""
    known = ", ".join(f"'{f}'" for f in schema.FEATURES)
    model = _fitted(spark, sf)[0]
    work = scratch_path(spark)
    stages.write_model(model, work)
    saved = spark.read.parquet(f"{stages.locate(spark, work, 'model')}/nodes").where("left >= 0")  # inner nodes
    names = "array(" + ", ".join(f"'{f}'" for f in model.features) + ")"
    gains = saved.groupBy(expr(f"{names}[int(feature)] as feature")).agg(expr("avg(gain) as mean"))
    shares = gains.selectExpr("feature", "mean / sum(mean) over () as share")
    ranked = tr.top_features(model, spark).join(shares, "feature", "left").selectExpr(
        "*", "lag(importance) over (order by importance desc, feature) as before")
    return ranked.selectExpr(
        "count(*) as n", f"count(distinct if(feature in ({known}), feature, null)) as known",
        "min(importance) >= 0 and sum(importance) <= 1.000001D as shares_fit",
        "coalesce(bool_and(before >= importance), true) as in_order",
        "bool_and(abs(importance - coalesce(share, 0)) < 1e-9) as as_the_saved_trees")


def _curve_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _fitted(spark, sf)[1]


def _learning_curve(spark: SparkSession, sf: str) -> DataFrame:
    """Per part: a row for every round, values from 0 to 1, and at the kept round the model's own value (to 0.01)."""
    model, curve, parts = _fitted(spark, sf)
    kept = model.rounds
    own = append_chunks([evaluate.ranking_metrics(tr.score(model, parts[n])).selectExpr(f"'{n}' as part", "auc_pr as own")
                         for n in ("train", "val")])
    return (curve.groupBy("part").agg(expr("count(*) = max(round) and min(round) = 1 and count(distinct round) = count(*) as one_row_per_round"),
                                      expr("min(auc_pr) >= 0 and max(auc_pr) <= 1.000001D as in_range"),
                                      expr(f"max(if(round = {kept}, auc_pr, null)) as at_kept"))
            .join(own, "part").selectExpr("part", "one_row_per_round", "in_range", "abs(at_kept - own) <= 0.01D as ends_at_the_model"))


def _trial_rows(spark: SparkSession, sf: str) -> DataFrame:
    parts = _parts(spark, sf)
    return tr.search(parts["train"], parts["val"], n_trials=2, space="narrow", weight_cap=100.0)


def _search_trials(spark: SparkSession, sf: str) -> DataFrame:
    """Per trial: drawn values, state, and whether rounds and metrics are in range."""
    within = " and ".join(f"coalesce({m} between 0 and 1, true)" for m in ("threshold", "precision", "recall", "f1", "fpr"))
    return rounded(_trial_rows(spark, sf).selectExpr(
        "trial", *[f"params['{n}'] as {n}" for n in ("max_depth", "learning_rate", "n_estimators")], "state",
        "rounds_used between 1 and rounds_fitted and rounds_fitted <= params['n_estimators'] as rounds_in_range",
        f"{within} and seconds > 0 as metrics_in_range"))


def _trial_parameters(spark: SparkSession, sf: str, space: str = "narrow") -> DataFrame:
    """Drawn parameter sets together with the positive weight measured on the data."""
    weight = sp.class_weight(_kept(spark, sf)).scalar()
    draws = tr.sample_params(spark, tr.BUDGETS[space][0], space=space).selectExpr("trial", "explode(params) as (name, value)")
    return rounded(draws.withColumn("positive_weight", weight))


def _fallback_parameters(spark: SparkSession, sf: str) -> DataFrame:
    weight = sp.class_weight(_kept(spark, sf)).first()[0]
    rows = [(n, float(v)) for n, v in tr.fallback_params("narrow", weight).items()]
    return rounded(spark.createDataFrame(rows, "name string, value double"))


def _run_log(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql("""select cast(event_id % 5 + 1 as int) as step, event_type as module,
                               event_type <> 'error' as success, value as duration,
                               if(event_type = 'error', props, null) as error
                        from {events}""", events=spark.read.parquet(f"{sf}/events.parquet"))


def _source(spark: SparkSession, sf: str) -> tuple[str, str]:
    """A CSV source and a work folder."""
    work = scratch_path(spark)
    _tx(spark, sf).select(*schema.CSV_SCHEMA.names).write.option("header", True).csv(f"{work}/raw")
    return f"{work}/raw", work


def _run_rows(spark: SparkSession, sf: str) -> DataFrame:
    source, work = _source(spark, sf)
    return runner.run_all(spark, source, work, runner.Settings(n_trials=2)).select("step", "module", "success", "error")


def _counted(spark: SparkSession, tables: dict[str, DataFrame], name: str) -> DataFrame:
    return append_chunks([t.selectExpr(f"'{n}' as {name}", "count(*) as n") for n, t in tables.items()])


def _full_run(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each stage table after all five steps."""
    source, work = _source(spark, sf)
    log = runner.run_all(spark, source, work, runner.Settings(n_trials=2))
    tables = {n: stages.read_table(spark, work, n) for n in ("loaded", "features", "trials", "best_params", "scored_val",
                                                             "scored_test", "package")}
    tables |= {n: stages.read_split(spark, work, n) for n in ("train", "val", "test", "train_balanced")}
    return _counted(spark, {**tables, "steps": log.where("success")}, "stage")


def _one_step(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the four parts after step 3 has been run again by itself, from the stored tables of steps 1 and 2."""
    source, work = _source(spark, sf)
    for number in (1, 2, 3, 3):
        record = runner.run_step(spark, number, source, work)
        if not record["success"]:
            raise RuntimeError(record["error"])
    return _counted(spark, {n: stages.read_split(spark, work, n) for n in ("train", "val", "test", "train_balanced")}, "part")


def _stage_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """What the manifest tells after the first three steps, the second one run twice."""
    source, work = _source(spark, sf)
    for number in (1, 2, 2, 3):
        record = runner.run_step(spark, number, source, work)
        if not record["success"]:
            raise RuntimeError(record["error"])
    return publish.manifest(spark, work).selectExpr("step", "name", "n_rows", "size(columns) as n_columns", "seq")


def _stored_values(spark: SparkSession, sf: str) -> DataFrame:
    """Contents of the tables that describe a run: profile, statistics, manifest of features, metadata, package."""
    source, work = _source(spark, sf)
    for row in runner.run_all(spark, source, work, runner.Settings(n_trials=2)).collect():
        if not row["success"]:
            raise RuntimeError(row["error"])
    wanted = {
        "loaded_profile": ["total_rows", "fraud_count", "fraud_rate", "amount_stats.median", "data_quality.missing_values"],
        "loaded_balance": ["legit", "fraud_percent"],
        "amount_stats": ["p1", "median", "p99", "mean", "std"],
        "search_metadata": ["feature_count", "train_rows", "train_rate", "validation_rows", "int(is_fallback)",
                            "int(sampling_method like 'smote%')", "int(space = 'narrow')", "targets['fpr'][1]"],
        "package": ["feature_count", "size(feature_names)", "balanced_fraud_rate", "metrics.tp + metrics.fn",
                    "metrics.tp + metrics.fp + metrics.fn + metrics.tn", "int(threshold = metrics.threshold)"],
    }
    parts = [stages.read_table(spark, work, name).selectExpr("inline(array(" + ", ".join(
        f"struct('{name}' as stage, {i} as item, round(cast({e} as double), 4) as value)" for i, e in enumerate(cells)) + "))")
        for name, cells in wanted.items()]
    return append_chunks(parts)


def _content_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Rows by a content key: the rows as they are, and whether keys are unique and none is below zero."""
    rows = cut_lineage(content_keys(_tx(spark, sf).select("type", "isFraud", "step")))
    return rows.groupBy("type", "isFraud", "step").agg(
        expr("count(*) as n"), expr(f"count(distinct {schema.KEY}) as keys"), expr(f"min({schema.KEY}) >= 0 as positive"))


def _merged_profile(spark: SparkSession, sf: str) -> DataFrame:
    """The profile of the whole table from the stored states of five chunks, one of them given twice."""
    tx, work = _tx(spark, sf), scratch_path(spark)
    for i in (0, 1, 2, 3, 4, 2):
        partials.store_chunk(tx.where(f"step % 5 = {i}"), work, f"chunk{i}")
    state = partials.merged(spark, work)
    return rounded(partials.profile_of(state).selectExpr(
        "total_rows", "fraud_count", "fraud_rate", "array_join(transaction_types, ',') as types",
        "amount_stats.min as amount_min", "amount_stats.max as amount_max", "amount_stats.mean as amount_mean",
        "amount_stats.median as amount_median", "data_quality.missing_values", "data_quality.duplicates"))


def _merged_columns(spark: SparkSession, sf: str) -> DataFrame:
    tx, work = _tx(spark, sf), scratch_path(spark)
    for i in range(3):
        partials.store_chunk(tx.where(f"step % 3 = {i}"), work, f"chunk{i}")
    return rounded(partials.numeric_profile_of(partials.merged(spark, work)))


def _strategy_by_limit(spark: SparkSession, sf: str) -> DataFrame:
    """The measured imbalance and the chosen method for each label variant."""
    parts = [sp.choose_strategy(sp.imbalance(clean.filter_types(_tx(spark, sf, limit)))).selectExpr(
        f"{limit} as value_limit", "*") for limit in LIMITS.values()]
    return rounded(append_chunks(parts))


QUERIES: dict[str, Query] = {
    # sources and sinks
    "read_transactions": _csv_round_trip,
    "content_keys": _content_keys,
    "append_chunks": _chunks,
    "narrow_floats": lambda s, d: rounded(clean.narrow_floats(_tx(s, d).selectExpr("tx_id", "cast(amount as double) / 3 as third"))),
    "stage_round_trip": _stage_round_trip,
    "prediction_sample": lambda s, d: rounded(evaluate.prediction_sample(_predicted(s, d))),
    # projections and filters
    "drop_leakage": lambda s, d: rounded(clean.drop_leakage(_tx(s, d))),
    "filter_types": lambda s, d: rounded(_kept(s, d)),
    "select_xy": lambda s, d: rounded(clean.select_xy(_kept(s, d))),
    "to_float_features": _float_features,
    "encode_remaining_strings": _leftover_strings,
    # profile
    "numeric_profile": lambda s, d: rounded(profile.numeric_profile(_tx(s, d))),
    "missing_cells": lambda s, d: profile.missing_cells(_tx(s, d)),
    "label_balance": lambda s, d: rounded(profile.label_balance(_tx(s, d))),
    "rate_band": lambda s, d: rounded(profile.rate_band(profile.label_balance(_tx(s, d)))),
    "type_counts": lambda s, d: profile.type_counts(_tx(s, d)),
    "distinct_types": lambda s, d: profile.distinct_types(_tx(s, d)),
    "amount_summary": lambda s, d: rounded(profile.amount_summary(_tx(s, d))),
    "duplicate_rows": lambda s, d: profile.duplicate_rows(_tx(s, d), ["step", "type", "nameOrig", "isFraud"]),
    "dataset_profile": lambda s, d: rounded(profile.dataset_profile(_tx(s, d)).selectExpr(
        "total_rows", "fraud_count", "fraud_rate", "array_join(transaction_types, ',') as types",
        "amount_stats.min as amount_min", "amount_stats.max as amount_max", "amount_stats.mean as amount_mean",
        "amount_stats.median as amount_median", "data_quality.missing_values", "data_quality.duplicates")),
    "merged_profile": _merged_profile,
    "merged_columns": _merged_columns,
    "split_balance": lambda s, d: rounded(profile.split_balance(_all_parts(s, d))),
    "split_audit": _audit,
    "feature_moments": lambda s, d: rounded(_moments(s, d, lambda m: m), 3),
    "moments_summary": lambda s, d: rounded(_moments(s, d, profile.moments_summary), 2),
    "filter_reduction": lambda s, d: profile.filter_reduction(_tx(s, d)),
    # features
    "amount_stats": lambda s, d: rounded(fe.amount_stats(_kept(s, d))),
    "amount_stats_approx": lambda s, d: rounded(fe.amount_stats(_kept(s, d), "approx")),
    "amount_features": lambda s, d: rounded(fe.add_amount_features(
        _kept(s, d).select("tx_id", "amount"), fe.amount_stats(_kept(s, d)))),
    "time_features": lambda s, d: fe.add_time_features(_kept(s, d).select("tx_id", "step")),
    "type_features": lambda s, d: fe.add_type_features(_kept(s, d).select("tx_id", "type")),
    "interaction_features": lambda s, d: rounded(_features(s, d).select(
        "tx_id", "amount_hour_interaction", "round_amount_night", "extreme_amount_cashout"), 4),
    "risk_flags": lambda s, d: rounded(_features(s, d).select("tx_id", "high_risk_pattern", "suspicious_timing")),
    "engineer_features": lambda s, d: rounded(_features(s, d), 5),
    "feature_manifest": lambda s, d: rounded(fe.feature_manifest(_features(s, d))),
    # split and resampling
    "stratified_split": lambda s, d: sp.stratified_split(_kept(s, d).select("tx_id", "isFraud"), nested=False),
    "nested_split": lambda s, d: sp.stratified_split(_kept(s, d).select("tx_id", "isFraud")),
    "imbalance": lambda s, d: rounded(sp.imbalance(_train(s, d))),
    "choose_strategy": _strategy_by_limit,
    "knn": _knn_minority_all,
    "knn_tiles": lambda s, d: _knn_minority_all(s, d, method="tiles", tile_rows=500),
    "knn_rings": lambda s, d: _knn_minority_all(s, d, method="rings", tile_rows=500),
    "smote": _resampled("smote", _smote_synthetic),
    "borderline_smote": _resampled("borderline_smote", rs.borderline_smote),
    "adasyn": _resampled("adasyn", rs.adasyn),
    "tomek_links": _tomek_links,
    "smote_tomek": _resampled("smote_tomek", _tomek_rows),
    "append_synthetic": _appended,
    "class_weight": lambda s, d: rounded(sp.class_weight(_train(s, d))),
    "resample_summary": _balanced_summary,
    # training and search
    "trial_parameters": _trial_parameters,
    "trial_parameters_wide": lambda s, d: _trial_parameters(s, d, "wide"),
    "fallback_parameters": _fallback_parameters,
    "search_trials": _search_trials,
    "search_rows": _trial_rows,
    "best_trial": lambda s, d: rounded(tr.best_trial(cut_lineage(_trials(s, d)))),
    "search_summary": lambda s, d: rounded(_summary(s, d)),
    "target_checks": lambda s, d: rounded(tr.target_checks(_summary(s, d))),
    "model_scores": _model_scores,
    "score_rows": _score_rows,
    "top_features": _top_features,
    "top_feature_rows": _feature_rows,
    "learning_curve": _learning_curve,
    "learning_curve_rows": _curve_rows,
    "predict_at": lambda s, d: rounded(th.predict_at(_scored(s, d), 0.5)),
    # thresholds and evaluation
    "threshold_sweep": lambda s, d: rounded(th.threshold_sweep(_scored(s, d), th.PRESETS["host"].grid)),
    "valid_thresholds": lambda s, d: rounded(th.valid_thresholds(_scored(s, d), "device")),
    "threshold_device": lambda s, d: rounded(th.choose_threshold(_scored(s, d), "device")),
    "threshold_host": lambda s, d: rounded(th.choose_threshold(_scored(s, d), "host")),
    "threshold_search": lambda s, d: rounded(th.choose_threshold(_scored(s, d), "search")),
    "threshold_curve": lambda s, d: rounded(th.threshold_curve(_scored(s, d))),
    "basic_metrics": lambda s, d: rounded(evaluate.basic_metrics(evaluate.confusion_counts(_predicted(s, d)))),
    "roc_auc": lambda s, d: rounded(evaluate.roc_auc(_scored(s, d))),
    "average_precision": lambda s, d: rounded(evaluate.average_precision(_scored(s, d))),
    "confusion_matrix": lambda s, d: evaluate.confusion_matrix(evaluate.confusion_counts(_predicted(s, d))),
    "business_rates": lambda s, d: rounded(evaluate.business_rates(evaluate.confusion_counts(_predicted(s, d)))),
    "roc_curve": lambda s, d: rounded(evaluate.roc_curve(_scored(s, d))),
    "pr_curve": lambda s, d: rounded(evaluate.pr_curve(_scored(s, d))),
    "base_rate": lambda s, d: rounded(evaluate.base_rate(_scored(s, d))),
    "score_histogram": lambda s, d: rounded(evaluate.score_histogram(_scored(s, d))),
    # grades and report
    "test_metrics": lambda s, d: rounded(_metrics(s, d)),
    "grade_targets": lambda s, d: rounded(report.grade_targets(_metrics(s, d))),
    "grade_summary": lambda s, d: rounded(report.grade_summary(report.grade_targets(_metrics(s, d)))),
    "vs_baseline": lambda s, d: rounded(report.vs_baseline(_metrics(s, d)), 4),
    "radar_values": lambda s, d: rounded(report.radar_values(_metrics(s, d))),
    "readiness": lambda s, d: rounded(report.readiness(_metrics(s, d))),
    "package_flags": lambda s, d: rounded(report.package_flags(_metrics(s, d)), 4),
    "report_table": lambda s, d: rounded(report.report_table(_metrics(s, d)), 4),
    # whole runs
    "run_all_steps": _full_run,
    "run_log_rows": _run_rows,
    "run_one_step": _one_step,
    "stage_manifest": _stage_manifest,
    "stored_values": _stored_values,
    "run_summary": lambda s, d: rounded(runner.run_summary(_run_log(s, d)), 4),
}
