"""The five steps, each from the tables of the step before, and the runner that chains them."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgerlens import schema
from ledgerlens.operators import clean, evaluate, features as fe, profile, report, resample as rs, split as sp
from ledgerlens.operators import threshold as th, training as tr
from ledgerlens.sources import publish, stages
from ledgerlens.sources.transactions import read_transactions


@dataclass(frozen=True)
class Settings:
    """What a run may change.  `max_iter` limits the boosting rounds of every fit; there is no limit by default."""
    seed: int = 42
    space: str = "narrow"
    n_trials: int | None = None
    timeout_minutes: float | None = None
    parallelism: int = 2
    max_iter: int | None = None
    weight_cap: float = 100.0
    threshold_preset: str = "device"
    quantiles: str = "exact"


def load_step(spark: SparkSession, source: str, work: str, settings: Settings) -> None:
    raw = stages.write_table(clean.narrow_floats(read_transactions(spark, source, keys="content")), work, "loaded")
    unlabelled = raw.where(f"{schema.LABEL} is null").count()
    if unlabelled:
        raise ValueError(f"{unlabelled} rows have no {schema.LABEL}")
    stages.write_table(profile.dataset_profile(raw), work, "loaded_profile")
    stages.write_table(profile.numeric_profile(raw), work, "loaded_columns")
    stages.write_table(profile.rate_band(profile.label_balance(raw)), work, "loaded_balance")


def feature_step(spark: SparkSession, source: str, work: str, settings: Settings) -> None:
    loaded = stages.read_loaded(spark, work)
    stats = stages.write_table(fe.amount_stats(clean.filter_types(loaded), settings.quantiles), work, "amount_stats")
    table = stages.write_table(fe.engineer_features(loaded, stats=stats), work, "features")
    stages.write_table(fe.feature_manifest(table), work, "feature_manifest")


def split_step(spark: SparkSession, source: str, work: str, settings: Settings) -> None:
    table = stages.read_features(spark, work)
    stages.write_splits(sp.stratified_split(table, seed=settings.seed), work)
    train = stages.read_split(spark, work, "train").drop("split", "is_synthetic")
    balanced = rs.resample(train, settings.seed, settings.weight_cap)
    stages.add_balancing(work, balanced.synthetic, balanced.removed, spark)
    stages.write_table(spark.createDataFrame([(balanced.method, balanced.positive_weight)],
                                             "sampling_method string, positive_weight double"), work, "split_metadata")
    after = stages.read_split(spark, work, "train_balanced")
    everything = stages.read_table(spark, work, "splits", schema.split_table_schema()).where("split <> 'synthetic'").unionByName(
        after.drop("split").selectExpr("*", "'train_balanced' as split"))
    for name in ("train", "train_balanced"):
        moments = profile.feature_moments(everything.where(f"split = '{name}'"))
        moments = stages.write_table(moments, work, f"moments_{name}")
        stages.write_table(profile.moments_summary(moments), work, f"moments_summary_{name}")
    stages.write_table(profile.split_balance(everything), work, "split_balance")
    stages.write_table(profile.split_audit(everything), work, "split_audit")
    stages.write_table(rs.resample_summary(train, after, balanced.method), work, "resample_summary")


def _split_metadata(spark: SparkSession, work: str):
    return stages.read_table(spark, work, "split_metadata").first()


def _digest(train: DataFrame, validation: DataFrame, settings: Settings, *others) -> str:
    """A name for fits on these rows with these settings."""
    names = ", ".join([schema.KEY, *schema.FEATURES, schema.LABEL])
    rows = [tuple(d.selectExpr("count(*)", f"bit_xor(xxhash64({names}))").first()) for d in (train, validation)]
    told = repr((rows, settings.seed, settings.space, settings.max_iter, others))
    return hashlib.sha256(told.encode()).hexdigest()[:24]


def search_step(spark: SparkSession, source: str, work: str, settings: Settings) -> None:
    balanced, validation = (stages.read_split(spark, work, n) for n in ("train_balanced", "val"))
    weight = _split_metadata(spark, work)["positive_weight"]
    cap = settings.weight_cap if weight is not None else None
    ledger = f"{work}/search_ledger/{_digest(balanced, validation, settings, cap)}"  # a run that died goes on there
    trials = tr.search(balanced, validation, settings.n_trials, settings.timeout_minutes, settings.space, settings.seed,
                       settings.parallelism, settings.max_iter, cap, ledger)
    trials = stages.write_table(trials, work, "trials")
    summary = stages.write_table(tr.search_summary(trials), work, "search_summary")
    stages.write_table(tr.target_checks(summary), work, "target_checks")
    best = trials.join(tr.best_trial(trials).where("best_score > 0").select("trial"), "trial", "left_semi").select("params")
    found = best.first()
    params = dict(found["params"]) if found else tr.fallback_params(settings.space, weight)
    stages.write_table(spark.createDataFrame([(params, found is None)], "params map<string,double>, is_fallback boolean"),
                       work, "best_params")
    shapes = {"train_rows": balanced.selectExpr("count(*)").scalar(), "train_rate": balanced.selectExpr(f"avg({schema.LABEL})").scalar(),
              "validation_rows": validation.selectExpr("count(*)").scalar()}
    told = spark.createDataFrame(
        [(found is None, settings.space, _split_metadata(spark, work)["sampling_method"], len(schema.FEATURES),
          {n: list(map(float, r)) for n, r in schema.TARGET_RANGES.items()})],
        "is_fallback boolean, space string, sampling_method string, feature_count int, targets map<string,array<double>>")
    stages.write_table(told.withColumns(shapes), work, "search_metadata")


def train_step(spark: SparkSession, source: str, work: str, settings: Settings) -> None:
    balanced, validation, test = (stages.read_split(spark, work, n) for n in ("train_balanced", "val", "test"))
    split_info = _split_metadata(spark, work)
    params = dict(stages.read_table(spark, work, "best_params").first()["params"])
    cap = settings.weight_cap if split_info["positive_weight"] is not None else None
    ledger = f"{work}/fit_ledger/{_digest(balanced, validation, settings, cap, params)}"
    model, curve = tr.fit_final(balanced, validation, params, settings.max_iter, cap, seed=settings.seed, ledger=ledger)
    stages.write_model(model, work)
    on_validation = stages.write_table(tr.score(model, validation), work, "scored_val")
    chosen = stages.write_table(th.choose_threshold(on_validation, settings.threshold_preset), work, "threshold")
    stages.write_table(th.valid_thresholds(on_validation, settings.threshold_preset), work, "valid_thresholds")
    predicted = stages.write_table(th.predict_at(tr.score(model, test), chosen), work, "scored_test")
    metrics = stages.write_table(evaluate.test_metrics(predicted, chosen), work, "metrics")
    for name, table in {
        "prediction_sample": evaluate.prediction_sample(predicted),
        "confusion_matrix": evaluate.confusion_matrix(metrics),
        "roc_curve": evaluate.roc_curve(predicted), "pr_curve": evaluate.pr_curve(predicted),
        "score_histogram": evaluate.score_histogram(predicted), "threshold_curve": th.threshold_curve(predicted),
        "top_features": tr.top_features(model, spark),
        "learning_curve": curve,
        "grades": report.grade_targets(metrics), "report": report.report_table(metrics),
        "package": package(spark, work, metrics, params, split_info["sampling_method"], balanced),
    }.items():
        stages.write_table(table, work, name)


def package(spark: SparkSession, work: str, metrics: DataFrame, params: dict[str, float], method: str,
            balanced: DataFrame) -> DataFrame:
    """One row: where the model is and everything needed to use and judge it."""
    targets = {n: list(map(float, r)) for n, r in schema.TARGET_RANGES.items()}
    given = spark.createDataFrame([(publish.locate(spark, work, "model"), list(schema.FEATURES), len(schema.FEATURES), params, method, targets)],
                                  "model_path string, feature_names array<string>, feature_count int, "
                                  "parameters map<string,double>, sampling_method string, target_metrics map<string,array<double>>")
    numbers = metrics.selectExpr(f"struct({', '.join(metrics.columns)})").scalar()
    flags = report.package_flags(metrics)
    return given.withColumns({"metrics": numbers, "flags": flags.selectExpr(f"struct({', '.join(flags.columns)})").scalar(),
                              "balanced_fraud_rate": balanced.selectExpr(f"avg({schema.LABEL})").scalar()}
                             ).selectExpr("*", "metrics.threshold as threshold")


STEPS: list[tuple[str, Callable]] = [("load", load_step), ("features", feature_step), ("split", split_step),
                                     ("search", search_step), ("train", train_step)]
READS = {"load": [], "features": ["load"], "split": ["features"], "search": ["split"], "train": ["split", "search"]}
LOG_TYPES = "step int, module string, success boolean, duration double, error string"


def _inputs(spark: SparkSession, source: str, work: str, name: str, settings: Settings) -> str:
    """A digest of what a step reads: the source's files (path, time, length; not their content) or the published
    versions of the steps before, and the settings."""
    if READS[name]:
        done = publish.current(spark, work)
        told = [done.get(step, (None,))[0] for step in READS[name]]
    else:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
        told = list(files.selectExpr("count(*)", "bit_xor(xxhash64(path, modificationTime, length))").first())
    return hashlib.sha256(repr((name, told, settings)).encode()).hexdigest()


def run_step(spark: SparkSession, number: int, source: str, work: str, settings: Settings = Settings(),
             reuse: bool = False) -> dict:
    """Run one step (1-5) from the saved tables; returns its log record.

    Its tables are published together when it is done; a step that fails leaves the ones published before valid.  With
    `reuse` a step is left out whose last publication came from the same inputs.
    """
    name, step = STEPS[number - 1]
    started, error = time.time(), None
    try:
        inputs = _inputs(spark, source, work, name, settings)
        if not (reuse and publish.current(spark, work).get(name, ("", ""))[1] == inputs):
            with publish.publication(spark, work, name, inputs):
                step(spark, source, work, settings)
    except Exception as problem:
        error = f"{type(problem).__name__}: {problem}"
    return {"step": number, "module": name, "success": error is None, "duration": time.time() - started, "error": error}


def run_all(spark: SparkSession, source: str, work: str, settings: Settings = Settings(), first: int = 1,
            reuse: bool = True) -> DataFrame:
    """Run the steps in order, stop at the first failure, and return the written run log.

    Steps that were published from the same inputs are not run again, so a run that died goes on where it was.
    """
    log = []
    for number in range(first, len(STEPS) + 1):
        log.append(run_step(spark, number, source, work, settings, reuse))
        if not log[-1]["success"]:
            break
    return stages.write_table(spark.createDataFrame(log, LOG_TYPES), work, "run_log")


def run_summary(log: DataFrame, total_steps: int = len(STEPS)) -> DataFrame:
    """One row: steps run, successes, failures, total and mean duration, estimated time of the remaining steps."""
    return log.selectExpr("count(*) as steps_run", "count_if(success) as successes", "count_if(not success) as failures",
                          "sum(duration) as total_duration", "avg(duration) as mean_duration",
                          f"avg(duration) * greatest({total_steps} - count(distinct step), 0) as remaining_estimate")
