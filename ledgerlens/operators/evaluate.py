"""Evaluation tables over (tx_id, label, p) and, where a decision is needed, prediction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.functions import broadcast, expr

from ledgerlens.functions.scalar import logit_bucket, ratio
from ledgerlens.operators.running import running_totals
from ledgerlens.operators.threshold import RATES

_COUNTS = ["count_if(label = 1 and prediction = 1) as tp", "count_if(label = 0 and prediction = 1) as fp",
           "count_if(label = 1 and prediction = 0) as fn", "count_if(label = 0 and prediction = 0) as tn"]


def confusion_counts(predicted: DataFrame) -> DataFrame:
    """One row tp, fp, fn, tn; all four are present even if a class is absent."""
    return predicted.selectExpr(*_COUNTS)


def confusion_matrix(counts: DataFrame) -> DataFrame:
    """The four cells as rows actual, predicted, n."""
    return counts.selectExpr("stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) as (actual, predicted, n)")


def basic_metrics(counts: DataFrame) -> DataFrame:
    return counts.selectExpr(*RATES)


def business_rates(counts: DataFrame) -> DataFrame:
    return counts.selectExpr(f"{ratio('tp', 'tp + fp')} as investigation_efficiency",
                             f"{ratio('tp', 'tp + fn')} as fraud_detection_rate",
                             f"{ratio('fp', 'fp + tn')} as false_positive_rate",
                             f"{ratio('tn', 'tn + fp')} as specificity",
                             f"{ratio('tn', 'tn + fn')} as negative_predictive_value")


def by_score(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score, with totals running from the highest score down."""
    rows = (scored.where("p is not null and not isnan(p)").groupBy(*by, "p").agg({"label": "sum", "*": "count"})
            .selectExpr(*by, "p", "`sum(label)` as pos", "`count(1)` - `sum(label)` as neg"))
    return running_totals(rows, "p", ["pos", "neg"], logit_bucket("p"), by=by, descending=True)


def ranking_metrics(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """auc_roc (ties count half) and auc_pr (average precision, a step sum) per group, NULL without both classes.

    Both are sums over distinct scores, so no curve is collected.
    """
    totals = by_score(scored, by).groupBy(*by)
    sums = {"auc": "sum(cast(neg as double) * (c_pos - pos / 2.0D))",
            "ap": "sum(cast(pos as double) * c_pos / (c_pos + c_neg))", "p_all": "sum(pos)", "n_all": "sum(neg)"}
    return totals.agg(*[expr(f"{e} as {n}") for n, e in sums.items()]).selectExpr(
        *by, "try_divide(auc, cast(p_all as double) * n_all) as auc_roc", "try_divide(ap, p_all) as auc_pr")


def roc_auc(scored: DataFrame) -> DataFrame:
    # both metrics are looked at, so that both branches below need the same sums and share one scan and exchange
    return ranking_metrics(scored).selectExpr("if(auc_roc is null and auc_pr is null, null, auc_roc) as auc_roc")


def average_precision(scored: DataFrame) -> DataFrame:
    return ranking_metrics(scored).selectExpr("if(auc_roc is null and auc_pr is null, null, auc_pr) as auc_pr")


def _with_totals(scored: DataFrame) -> DataFrame:
    points = by_score(scored)
    ends = points.selectExpr("struct(sum(pos) as p_all, sum(neg) as n_all)").scalar()
    return points.withColumn("_e", ends).selectExpr("p", "c_pos", "c_neg", "_e.p_all", "_e.n_all")


def roc_curve(scored: DataFrame) -> DataFrame:
    """threshold, fpr, tpr: one point per distinct score, and (0, 0) with an infinite threshold."""
    start = scored.sparkSession.range(1).selectExpr("double('infinity') as threshold", "0.0D as fpr", "0.0D as tpr")
    return _with_totals(scored).selectExpr("p as threshold", f"{ratio('c_neg', 'n_all')} as fpr",
                                           f"{ratio('c_pos', 'p_all')} as tpr").unionByName(start)


def pr_curve(scored: DataFrame) -> DataFrame:
    """threshold, precision, recall: one point per distinct score, and the end point (1, 0)."""
    end = scored.sparkSession.range(1).selectExpr("cast(null as double) as threshold", "1.0D as precision", "0.0D as recall")
    return _with_totals(scored).selectExpr("p as threshold", f"{ratio('c_pos', 'c_pos + c_neg')} as precision",
                                           f"{ratio('c_pos', 'p_all')} as recall").unionByName(end)


def base_rate(scored: DataFrame) -> DataFrame:
    return scored.selectExpr("avg(cast(label as double)) as base_rate")


def score_histogram(scored: DataFrame, bins: int = 50) -> DataFrame:
    """label, bin, left, right, n, density; each class has its own range and its last bin is closed."""
    rows = scored.where("p is not null and not isnan(p)").select("label", "p")
    spans = (rows.groupBy("label").agg(expr("count(*) as total"), expr("min(p) as a"), expr("max(p) as b"))
             .selectExpr("label", "total", "if(a = b, a - 0.5D, a) as lo", "if(a = b, b + 0.5D, b) as hi"))
    edge = "case when {i} = %d then hi else {i} * ((hi - lo) / %d) + lo end" % (bins, bins)
    spans = broadcast(spans)  # one row per class
    placed = (rows.join(spans, "label")
              .selectExpr("label", "p", "lo", "hi", f"least(cast(floor((p - lo) / (hi - lo) * {bins}) as int), {bins - 1}) as _g")
              .selectExpr("label", f"case when p < ({edge.format(i='_g')}) then _g - 1 when _g < {bins - 1} and "
                                   f"p >= ({edge.format(i='(_g + 1)')}) then _g + 1 else _g end as bin")
              .groupBy("label", "bin").count().withColumnRenamed("count", "n"))
    full = spans.selectExpr("*", f"explode(sequence(0, {bins - 1})) as bin")
    return (full.join(placed, ["label", "bin"], "left")
            .selectExpr("label", "bin", f"{edge.format(i='bin')} as left", f"{edge.format(i='(bin + 1)')} as right",
                        "coalesce(n, 0L) as n", f"coalesce(n, 0L) / (total * ((hi - lo) / {bins})) as density"))


def prediction_sample(predicted: DataFrame, n: int = 1000) -> DataFrame:
    """The first `n` scored rows by key: probability, prediction and true label."""
    return predicted.orderBy("tx_id").limit(n).select("tx_id", "p", "prediction", "label")


def test_metrics(predicted: DataFrame, threshold: DataFrame | None = None) -> DataFrame:
    """One row: counts, precision, recall, f1, auc_roc, auc_pr, and the business rates."""
    counts = confusion_counts(predicted)
    ranks = ranking_metrics(predicted).selectExpr("struct(auc_roc, auc_pr)").scalar()
    wide = counts.selectExpr("*", *RATES, f"{ratio('tp', 'tp + fp')} as investigation_efficiency",
                             f"{ratio('tp', 'tp + fn')} as fraud_detection_rate",
                             f"{ratio('fp', 'fp + tn')} as fpr", f"{ratio('tn', 'tn + fp')} as specificity",
                             f"{ratio('tn', 'tn + fn')} as negative_predictive_value").withColumn("_r", ranks)
    wide = wide.selectExpr("* except (_r)", "_r.auc_roc", "_r.auc_pr")
    return wide if threshold is None else wide.withColumn("threshold", threshold.select("threshold").scalar())
