"""Grades, comparison and readiness: arithmetic on the one-row metrics table, reported as rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from ledgerlens import schema
from ledgerlens.session import cut_lineage

# Shares of passed checks that give each verdict.
VERDICTS = [(80, "OUTSTANDING"), (60, "SOLID"), (40, "ACCEPTABLE"), (0, "NEEDS_IMPROVEMENT")]
RADAR_MAX = {"precision": 0.55, "recall": 0.70, "f1": 0.55, "auc_roc": 0.85, "specificity": 1.0}


def _rows(names: dict[str, str], *extra: dict[str, float]) -> str:
    """inline() of one struct (metric, value, ...) per name; `extra` holds further numbers per metric."""
    parts = []
    for metric, column in names.items():
        more = "".join(f", {e[metric]!r}D as x{i}" for i, e in enumerate(extra))
        parts.append(f"struct('{metric}' as metric, cast({column} as double) as value{more})")
    return f"inline(array({', '.join(parts)}))"


def grade_targets(metrics: DataFrame) -> DataFrame:
    """Each metric against its target range: EXCELLENT inside, GOOD above its low end, else NEEDS_WORK.

    A false positive rate above its limit counts as GOOD under this rule; `within_limit` tells it apart.
    """
    low = {m: r[0] for m, r in schema.TARGET_RANGES.items()}
    high = {m: r[1] for m, r in schema.TARGET_RANGES.items()}
    return (metrics.selectExpr(_rows({m: m for m in low}, low, high))
            .selectExpr("metric", "value", "x0 as low", "x1 as high", "value <= x1 as within_limit",
                        "case when value between x0 and x1 then 'EXCELLENT' when value >= x0 then 'GOOD' "
                        "else 'NEEDS_WORK' end as grade")
            .selectExpr("*", "case grade when 'EXCELLENT' then 1.0D when 'GOOD' then 0.5D else 0.0D end as points"))


def grade_summary(grades: DataFrame) -> DataFrame:
    verdict = "case " + " ".join(f"when success_percent >= {v} then '{n}'" for v, n in VERDICTS) + " end"
    return (grades.selectExpr("sum(points) as points", "count(*) as checks")
            .selectExpr("points", "checks", "points / checks * 100 as success_percent")
            .selectExpr("*", f"{verdict} as verdict"))


def baseline_table(spark) -> DataFrame:
    values = ", ".join(f"('{m}', {v!r}D)" for m, v in schema.EARLIER_MODEL.items())
    return spark.sql(f"select * from values {values} as t(metric, baseline)")


def vs_baseline(metrics: DataFrame) -> DataFrame:
    """metric, value, baseline, change in percent against the earlier model."""
    current = metrics.selectExpr(_rows({m: m for m in schema.EARLIER_MODEL}))
    return (current.join(baseline_table(metrics.sparkSession), "metric")
            .selectExpr("metric", "value", "baseline", "(value / baseline - 1) * 100 as change_percent"))


def radar_values(metrics: DataFrame) -> DataFrame:
    """Each metric as a share of its best target, at most 1."""
    return (metrics.selectExpr(_rows({m: m for m in RADAR_MAX}, RADAR_MAX))
            .selectExpr("metric", "least(value / x0, 1.0D) as share"))


def readiness(metrics: DataFrame) -> DataFrame:
    """Mean of three shares against the minimum targets, and what to do."""
    return (metrics.selectExpr("least(precision / 0.30D, 1.0D) as precision_share",
                               "least(recall / 0.45D, 1.0D) as recall_share",
                               "greatest(0.0D, 1 - fpr / 0.05D) as fpr_share", "precision >= 0.30D as precision_ready",
                               "recall >= 0.45D as recall_ready", "fpr <= 0.05D as fpr_ready")
            .selectExpr("*", "(precision_share + recall_share + fpr_share) / 3 as readiness")
            .selectExpr("*", "case when readiness >= 0.7D then 'DEPLOY' when readiness >= 0.5D then 'REVIEW' "
                             "else 'IMPROVE' end as status"))


def package_flags(metrics: DataFrame) -> DataFrame:
    """The two flags stored with a saved model, and the precision change they are shown with."""
    earlier = schema.EARLIER_MODEL["precision"]
    return metrics.selectExpr(
        f"(precision / {earlier!r}D - 1) * 100 as precision_change_percent",
        "precision >= 0.30D and recall >= 0.45D and fpr <= 0.05D as meets_realistic_targets",
        "precision >= 0.30D and investigation_efficiency >= 0.70D as deployment_ready")


def report_table(metrics: DataFrame) -> DataFrame:
    """section, name, value, target, status: every number of the final report as a row."""
    metrics = cut_lineage(metrics)  # one row, read by every section
    blank = "cast(null as string)"
    performance = grade_targets(metrics).selectExpr(
        "'performance' as section", "metric as name", "value",
        "concat(cast(low as string), '-', cast(high as string)) as target", "grade as status")
    extra = metrics.selectExpr(_rows({m: m for m in ("auc_pr", "threshold")}))
    extra = extra.selectExpr("'performance' as section", "metric as name", "value", f"{blank} as target", f"{blank} as status")
    change = vs_baseline(metrics).selectExpr("'improvement' as section", "metric as name", "change_percent as value",
                                             f"{blank} as target", f"{blank} as status")
    business = metrics.selectExpr(_rows({"investigation_efficiency": "investigation_efficiency",
                                         "fraud_detection_rate": "fraud_detection_rate", "false_positive_rate": "fpr",
                                         "specificity": "specificity",
                                         "negative_predictive_value": "negative_predictive_value",
                                         "true_positives": "tp", "false_positives": "fp",
                                         "false_negatives": "fn", "true_negatives": "tn"}))
    business = business.selectExpr("'business' as section", "metric as name", "value",
                                   "if(metric = 'false_positive_rate', '<0.05', null) as target", f"{blank} as status")
    overall = grade_summary(grade_targets(metrics)).selectExpr(
        "'overall' as section", "'success_percent' as name", "success_percent as value", f"{blank} as target",
        "verdict as status")
    ready = readiness(metrics).selectExpr("'overall' as section", "'readiness' as name", "readiness as value",
                                          f"{blank} as target", "status")
    recommended = metrics.selectExpr(
        "'overall' as section", "'recommendation' as name", "cast(null as double) as value", f"{blank} as target",
        "if(precision >= 0.30D and fpr <= 0.05D, 'READY_FOR_PRODUCTION', 'REVIEW_RECOMMENDED') as status")
    shares = radar_values(metrics).selectExpr("'radar' as section", "metric as name", "share as value",
                                              f"{blank} as target", f"{blank} as status")
    flags = package_flags(metrics).selectExpr(
        "inline(array(struct('package' as section, 'meets_realistic_targets' as name, "
        "double(int(meets_realistic_targets)) as value, cast(null as string) as target, "
        "if(meets_realistic_targets, 'YES', 'NO') as status), struct('package' as section, 'deployment_ready' as name, "
        "double(int(deployment_ready)) as value, cast(null as string) as target, if(deployment_ready, 'YES', 'NO') as status)))")
    parts = [performance, extra, change, business, overall, ready, recommended, shares, flags]
    return reduce(lambda a, b: a.unionByName(b), parts)
