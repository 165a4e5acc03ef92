"""Gradient-boosted trees: parameter draws, trials, search, final fit, scoring and model tables.

Boosting rounds are not cut short: a fit goes on until the exact validation AUC-PR has not risen for `patience` rounds or
the drawn number of rounds is reached, and keeps the best round.  No round is fitted twice (see `boosting`).
"""

from __future__ import annotations

import sys
import time
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.functions import col, expr
from pyspark.storagelevel import StorageLevel

from ledgerlens import schema
from ledgerlens.functions.scalar import key_unit
from ledgerlens.operators import boosting as bo
from ledgerlens.operators.boosting import BoostedModel
from ledgerlens.operators.split import add_class_weight
from ledgerlens.operators.threshold import choose_threshold
from ledgerlens.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need numpy and pyarrow but not this package

# The two search spaces as name, kind, low, high.
SEARCH_SPACES = {
    "wide": [("max_bin", "int", 512, 2048), ("max_depth", "int", 3, 8), ("learning_rate", "log", 0.005, 0.15),
             ("n_estimators", "int", 300, 1500), ("subsample", "uniform", 0.5, 0.95),
             ("colsample_bytree", "uniform", 0.5, 0.95), ("colsample_bylevel", "uniform", 0.5, 1.0),
             ("min_child_weight", "int", 1, 15), ("gamma", "uniform", 0.0, 1.0), ("reg_alpha", "uniform", 0.0, 2.0),
             ("reg_lambda", "uniform", 0.0, 2.0), ("lossguide", "int", 0, 1), ("max_leaves", "int", 0, 1024)],
    "narrow": [("max_depth", "int", 2, 6), ("learning_rate", "log", 0.01, 0.1), ("n_estimators", "int", 200, 800),
               ("subsample", "uniform", 0.6, 0.95), ("colsample_bytree", "uniform", 0.6, 0.95),
               ("min_child_weight", "int", 1, 10), ("gamma", "uniform", 0.0, 0.8), ("reg_alpha", "uniform", 0.0, 1.0),
               ("reg_lambda", "uniform", 0.0, 1.0)],
}
# Parameters used when no search result is available.
FALLBACK = {"max_depth": 5.0, "learning_rate": 0.03, "n_estimators": 800.0, "subsample": 0.8, "colsample_bytree": 0.8,
            "min_child_weight": 3.0, "gamma": 0.1, "reg_alpha": 0.1, "reg_lambda": 0.1}
FALLBACK_WIDE = {"max_bin": 1024.0, "lossguide": 1.0, "max_leaves": 511.0}
FALLBACK_WEIGHT_CAP = 50.0
# (trials, minutes) of the two spaces
BUDGETS = {"wide": (60, 60), "narrow": (30, 30)}

TRIAL_PATIENCE, FINAL_PATIENCE = 30, 50
CURVE_BUCKETS = 4_096  # equal steps between the least and the greatest log odds that the trees of a round can add up to
BINS = 256  # histogram bins where a parameter set names none, as usual for histogram trees
TRIALS_SCHEMA = T.StructType([
    T.StructField("trial", T.IntegerType()), T.StructField("params", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("dropped", T.ArrayType(T.StringType())),
    T.StructField("rounds_used", T.IntegerType()), T.StructField("rounds_fitted", T.IntegerType()),
    *[T.StructField(n, T.DoubleType()) for n in ("score", "threshold", "precision", "recall", "f1", "fpr", "seconds")],
    T.StructField("state", T.StringType())])


def sample_params(spark: SparkSession, n: int, seed: int = 42, space: str = "narrow") -> DataFrame:
    """(trial, params): one seeded draw per trial and parameter, mapped to its range."""
    entries = []
    for name, kind, low, high in SEARCH_SPACES[space]:
        u = key_unit("id", seed, purpose=name)
        value = {"int": f"cast({low} + floor({u} * {high - low + 1}) as double)",
                 "uniform": f"{float(low)!r}D + {u} * {float(high - low)!r}D",
                 "log": f"exp(ln({float(low)!r}D) + {u} * (ln({float(high)!r}D) - ln({float(low)!r}D)))"}[kind]
        entries.append(f"'{name}', {value}")
    return spark.range(n).selectExpr("cast(id as int) as trial", f"map({', '.join(entries)}) as params")


def fallback_params(space: str = "narrow", positive_weight: float | None = None) -> dict[str, float]:
    params = {**FALLBACK, **(FALLBACK_WIDE if space == "wide" else {})}
    if positive_weight is not None:
        params["scale_pos_weight"] = min(positive_weight, FALLBACK_WEIGHT_CAP)
    return params


#: Drawn parameters that a fit does not use; recorded with each trial.
NO_COUNTERPART: tuple[str, ...] = ()


def boost_settings(params: dict[str, float], seed: int = 42) -> bo.Settings:
    """Settings of a parameter set; what it does not name has the fixed value, or no effect."""
    p = {**FALLBACK, **params}
    return bo.Settings(
        rate=float(p["learning_rate"]), depth=int(p["max_depth"]), subsample=float(p["subsample"]),
        by_tree=float(p["colsample_bytree"]), by_level=float(p.get("colsample_bylevel", 1.0)),
        least_weight=float(p["min_child_weight"]), gamma=float(p["gamma"]), alpha=float(p["reg_alpha"]),
        lam=float(p["reg_lambda"]), bins=int(p.get("max_bin", BINS)), lossguide=bool(p.get("lossguide", 0.0)),
        leaves=int(p.get("max_leaves", 0)), seed=seed)


def model_rows(rows: DataFrame, features: Sequence[str] = tuple(schema.FEATURES)) -> DataFrame:
    """(tx_id, label, features, ...): missing features take the fill value, as in the neighbour search."""
    extra = [c for c in ("weight",) if c in rows.columns]
    return rows.selectExpr(schema.KEY, f"cast({schema.LABEL} as double) as label",
                           *[f"coalesce(nanvl(cast({f} as double), null), {schema.NULL_FILL}D) as {f}" for f in features],
                           *extra)


def _weighted(rows: DataFrame, params: dict[str, float], weight_cap: float | None) -> DataFrame:
    """`scale_pos_weight` among the parameters is the weight of a positive row; otherwise `weight_cap` turns on the
    measured class weight, up to the cap."""
    weight = params.get("scale_pos_weight")
    if weight is not None:
        return rows.selectExpr("*", f"if({schema.LABEL} = 1, {float(weight)!r}D, 1.0D) as weight")
    return rows.selectExpr("*", "1.0D as weight") if weight_cap is None else add_class_weight(rows, weight_cap)


def _fitted(train: DataFrame, validation: DataFrame | None, params: dict[str, float], rounds: int, patience: int | None,
            weight_cap: float | None, features: Sequence[str], seed: int, ledger: str | None) -> bo.Fitted:
    names = [schema.KEY, *features, schema.LABEL]

    def side(rows: DataFrame, flag: str) -> DataFrame:
        return model_rows(rows, features).selectExpr(f"{schema.KEY} as key", "label", "weight", f"{flag} as train", *features)

    rows = side(_weighted(train.select(*names), params, weight_cap), "true")
    if validation is not None:
        rows = rows.unionByName(side(validation.select(*names).selectExpr("*", "1.0D as weight"), "false"))
    return bo.boost(rows, list(features), rounds, boost_settings(params, seed), patience, ledger)


def fit(train: DataFrame, params: dict[str, float], rounds: int | None = None, weight_cap: float | None = None,
        features: Sequence[str] = tuple(schema.FEATURES), seed: int = 42) -> BoostedModel:
    """Fit a number of rounds, by default the drawn one."""
    rounds = rounds or int({**FALLBACK, **params}["n_estimators"])
    return _fitted(train, None, params, rounds, None, weight_cap, features, seed, None).model


def best_round(curve: Sequence[tuple[int, float]], patience: int) -> int:
    """Round with the highest score before `patience` rounds pass without a better one."""
    best, top = 0, float("-inf")
    for number, value in sorted(curve):
        if value is not None and value > top:
            best, top = number, value
        elif number - best >= patience:
            break
    return max(best, 1)


def fit_patient(train: DataFrame, validation: DataFrame, params: dict[str, float], patience: int,
                max_iter: int | None = None, weight_cap: float | None = None, seed: int = 42,
                ledger: str | None = None) -> bo.Fitted:
    """All rounds that had to be fitted, the best of them, and the validation AUC-PR after each.

    The best round has the highest validation AUC-PR before `patience` rounds pass without a better one.  `max_iter` is
    a limit that a caller may set below the drawn number of rounds; there is none by default.  Rounds stored under
    `ledger` are taken from there.
    """
    limit = int({**FALLBACK, **params}["n_estimators"])
    limit = min(limit, max_iter) if max_iter else limit
    return _fitted(train, validation, params, limit, patience, weight_cap, schema.FEATURES, seed, ledger)


def fit_final(train: DataFrame, validation: DataFrame, params: dict[str, float], max_iter: int | None = None,
              weight_cap: float | None = None, patience: int = FINAL_PATIENCE, seed: int = 42,
              ledger: str | None = None) -> tuple[BoostedModel, DataFrame]:
    """The model of the best round, and the learning curve of train and validation over all fitted rounds.

    Validation values that the choice of the round needed are exact, the others counted in buckets.
    """
    found = fit_patient(train, validation, params, patience, max_iter, weight_cap, seed, ledger)
    curve = learning_curve(found.model, {"train": train, "val": validation})
    known = train.sparkSession.createDataFrame(
        [("val", n, v) for n, v in enumerate(found.curve, 1) if v is not None], "part string, round int, exact double")
    curve = curve.join(known.hint("broadcast"), ["part", "round"], "left").selectExpr("part", "round", "coalesce(exact, auc_pr) as auc_pr")
    return found.model.first(found.best), cut_lineage(curve)


def score(model: BoostedModel, rows: DataFrame) -> DataFrame:
    """(tx_id, label, p): probability of the positive class."""
    return bo.with_margin(model_rows(rows, model.features), model).selectExpr(
        schema.KEY, "cast(label as int) as label", "1 / (1 + exp(-margin)) as p")


def run_trial(trial: int, params: dict[str, float], train: DataFrame, validation: DataFrame,
              max_iter: int | None = None, weight_cap: float | None = None, seed: int = 42) -> dict:
    """Fit, choose a threshold on validation, and return the trial record; a failed fit scores 0 and keeps its error."""
    started = time.time()
    record = _record(trial, params, "COMPLETE")
    try:
        found = fit_patient(train, validation, params, TRIAL_PATIENCE, max_iter, weight_cap, seed)
        record.update(rounds_used=found.best, rounds_fitted=found.model.rounds)
        chosen = choose_threshold(score(found.model.first(found.best), validation), "search").first()
        if chosen["score"] > 0:
            record.update({k: chosen[k] for k in ("score", "threshold", "precision", "recall", "f1", "fpr")})
    except Exception as error:  # a trial that cannot be fitted must not end the search
        record["state"] = f"FAILED: {type(error).__name__}: {error}"[:2_000]
    record["seconds"] = time.time() - started
    return record


def _record(trial: int, params: dict[str, float], state: str) -> dict:
    return {"trial": trial, "params": params, "dropped": [p for p in NO_COUNTERPART if p in params], "rounds_used": None,
            "rounds_fitted": None, "score": 0.0, "threshold": None, "precision": None, "recall": None, "f1": None,
            "fpr": None, "seconds": 0.0, "state": state}


def search(train: DataFrame, validation: DataFrame, n_trials: int | None = None, timeout_minutes: float | None = None,
           space: str = "narrow", seed: int = 42, parallelism: int = 2, max_iter: int | None = None,
           weight_cap: float | None = None, ledger: str | None = None) -> DataFrame:
    """The trial table.  Trials share one stored input and run a few at a time; a trial that the time limit keeps from
    starting is SKIPPED.  If trials ran and every one failed, the first error is raised: the parameters are not to blame.

    With a `ledger` folder each completed trial is written there as a file of its own, and a trial that it has with the same
    parameters is not run again.  A ledger belongs to one input and one seed.
    """
    spark = train.sparkSession
    trials, minutes = BUDGETS[space]
    trials, minutes = n_trials or trials, timeout_minutes or minutes
    deadline = time.time() + minutes * 60
    draws = [(r["trial"], dict(r["params"])) for r in sample_params(spark, trials, seed, space).collect()]
    train, validation = (d.persist(StorageLevel.MEMORY_AND_DISK) for d in (train, validation))
    finished = stored_trials(spark, ledger) if ledger else {}

    def one(draw):
        trial, params = draw
        if trial in finished and finished[trial]["params"] == params:
            return finished[trial]
        if time.time() >= deadline:
            return _record(*draw, "SKIPPED")
        record = run_trial(*draw, train, validation, max_iter, weight_cap, seed)
        if ledger and record["state"] == "COMPLETE":
            spark.createDataFrame([record], TRIALS_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{ledger}/trial-{trial}")
        return record

    try:
        with ThreadPoolExecutor(parallelism) as pool:
            records = list(pool.map(one, draws))
    finally:
        train.unpersist(), validation.unpersist()
    ran = [r for r in records if r["state"] != "SKIPPED"]
    if ran and all(r["state"].startswith("FAILED") for r in ran):
        raise RuntimeError(f"every trial failed; the first: {ran[0]['state']}")
    return spark.createDataFrame(records, TRIALS_SCHEMA)


def stored_trials(spark: SparkSession, ledger: str) -> dict[int, dict]:
    """Records of the completed trials in a ledger folder, by trial."""
    try:
        rows = spark.read.schema(TRIALS_SCHEMA).parquet(f"{ledger}/trial-*").collect()  # one row per trial
    except AnalysisException:
        return {}  # nothing stored yet
    return {r["trial"]: {**r.asDict(), "params": dict(r["params"])} for r in rows}


def best_trial(trials: DataFrame) -> DataFrame:
    """The trial with the highest score (first one on ties), with the defaults for missing metrics."""
    best = trials.orderBy(col("score").desc(), "trial").limit(1)
    defaults = {"threshold": 0.5, "precision": 0.0, "recall": 0.0, "f1": 0.0, "fpr": 1.0}
    return best.selectExpr("trial", "score as best_score",
                           *[f"coalesce({n}, {d!r}D) as best_{n}" for n, d in defaults.items()])


def search_summary(trials: DataFrame) -> DataFrame:
    """The best trial with the number of trials, of completed ones, and the time spent in all."""
    totals = trials.selectExpr("struct(count(*) as n_trials, count_if(state = 'COMPLETE') as n_completed_trials, "
                               "coalesce(sum(seconds), 0.0D) as optimization_seconds)").scalar()
    return best_trial(trials).withColumn("_t", totals).selectExpr("* except (_t)", "_t.*")


def target_checks(summary: DataFrame) -> DataFrame:
    """check, value, passed for the four search targets, with the share passed and its band on every row."""
    rows = ("inline(array(struct('precision' as check, best_precision as value, best_precision >= 0.30D as passed), "
            "struct('recall' as check, best_recall as value, best_recall >= 0.45D as passed), "
            "struct('f1' as check, best_f1 as value, best_f1 >= 0.35D as passed), "
            "struct('fpr' as check, best_fpr as value, best_fpr <= 0.05D as passed)))")
    rate = ("(int(best_precision >= 0.30D) + int(best_recall >= 0.45D) + int(best_f1 >= 0.35D) + int(best_fpr <= 0.05D))"
            " / 4.0D * 100 as success_percent")
    return (summary.selectExpr(rows, rate)
            .selectExpr("*", "case when success_percent >= 75 then 'EXCELLENT' when success_percent >= 50 then 'GOOD' "
                             "else 'NEEDS_IMPROVEMENT' end as band"))


def top_features(model: BoostedModel, spark: SparkSession, n: int = 15) -> DataFrame:
    """feature, importance: the n most important features, by the mean gain of their splits."""
    table = spark.createDataFrame(list(model.importances().items()), "feature string, importance double")
    return table.orderBy(col("importance").desc(), "feature").limit(n)


def learning_curve(model: BoostedModel, parts: dict[str, DataFrame],
                   features: Sequence[str] = tuple(schema.FEATURES)) -> DataFrame:
    """part, round, auc_pr: average precision of the first 1, 2, ... trees, over CURVE_BUCKETS steps of the score.

    Each task adds one tree after the other to a margin column and counts labels per round and bucket, so the work grows
    with the rounds and only counts are shuffled.  The metric of a finished model is the exact one (`ranking_metrics`).
    """
    trees, rows, values = model.trees, None, bo.tree_values
    low, high = (np.cumsum([pick(t.value[t.left < 0]) for t in trees]) for pick in (np.min, np.max))
    scale = (CURVE_BUCKETS - 1) / np.maximum(high - low, 1e-12)
    for name, part in parts.items():
        side = model_rows(part, features).selectExpr(f"'{name}' as part", "label", *features)
        rows = side if rows is None else rows.unionByName(side)
    out = pa.schema([("part", pa.string()), ("round", pa.int32()), ("bucket", pa.int32()), ("pos", pa.int64()),
                     ("neg", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            x = np.stack([np.asarray(batch.column(f)) for f in features]).T  # by column
            label = (np.asarray(batch.column("label")) > 0.5).astype(np.int64)
            names = np.asarray(batch.column("part").to_pylist())
            for name in sorted(set(names.tolist())):
                own = names == name
                mine, marks = (x, label) if own.all() else (x[own], label[own])
                counts = held.setdefault(name, np.zeros((len(trees), 2 * CURVE_BUCKETS), np.int64))
                margin = np.zeros(len(mine))
                for i, tree in enumerate(trees):
                    margin += values(tree, mine)
                    step = np.clip((margin - low[i]) * scale[i] + 1e-6, 0, CURVE_BUCKETS - 1)
                    counts[i] += np.bincount(2 * step.astype(np.int64) + marks, minlength=2 * CURVE_BUCKETS)
        for name, counts in held.items():
            for i, row in enumerate(counts):
                pairs = row.reshape(-1, 2)
                used = np.flatnonzero(pairs.sum(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(used), pa.string()), pa.array(np.full(len(used), i + 1, np.int32)),
                     pa.array(used.astype(np.int32)), pa.array(pairs[used, 1]), pa.array(pairs[used, 0])], schema=out)

    counted = (rows.mapInArrow(count, "part string, round int, bucket int, pos long, neg long")
               .groupBy("part", "round", "bucket").agg({"pos": "sum", "neg": "sum"})
               .selectExpr("part", "round", "bucket", "`sum(pos)` as pos", "`sum(neg)` as neg"))
    window = "over (partition by part, round order by bucket desc)"
    return (counted.selectExpr("part", "round", "pos", f"sum(pos) {window} as tp", f"sum(neg) {window} as fp")
            .groupBy("part", "round").agg(expr("sum(cast(pos as double) * tp / (tp + fp)) as ap"), expr("sum(pos) as n"))
            .selectExpr("part", "round", "try_divide(ap, n) as auc_pr"))
