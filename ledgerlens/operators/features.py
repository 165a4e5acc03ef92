"""The derived feature columns.

Amount statistics are one aggregate, read back as a scalar subquery, so the feature table itself is a single
narrow projection over the scan: no shuffle of rows, whole-stage code generation throughout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ledgerlens import schema
from ledgerlens.functions.scalar import no_nan
from ledgerlens.operators.clean import drop_leakage, filter_types
from ledgerlens.operators.running import moments_of_counts, quantiles_of_counts, value_counts

_X = "cast(amount as double)"

#: Definition of each derived column.  `_s` holds the fitted amount statistics, `_labels` the sorted types present.
#: Amount categories are closed on the right and open at 0.
AMOUNT_COLUMNS = {
    "amount_log": f"log1p({_X})",
    "amount_zscore": f"try_divide({_X} - _s.mean, _s.std)",
    "is_round_amount": f"int(pmod({_X}, 1000.0D) = 0)",
    "is_extreme_amount": f"int({_X} >= _s.p99 or {_X} <= _s.p1)",
    "amount_category": "case when amount <= 0 then null when amount <= 1000 then 0 when amount <= 10000 then 1 "
                       "when amount <= 100000 then 2 when amount <= 1000000 then 3 when amount is not null then 4 end",
}
TIME_COLUMNS = {
    "hour": "pmod(step, 24)",
    "day": "cast(floor(step / 24.0D) + 1 as int)",
    "is_night": "int(hour >= 22 or hour <= 6)",
    "is_weekend": "int(pmod(day, 7) >= 5)",
    "is_deep_night": "int(hour between 1 and 4)",
}
TYPE_COLUMNS = {
    "type_encoded": "cast(array_position(_labels, type) - 1 as int)",
    "is_cash_out": "int(type = 'CASH_OUT')",
}
INTERACTION_COLUMNS = {
    "amount_hour_interaction": "amount_log * hour",
    "round_amount_night": "is_round_amount * is_night",
    "extreme_amount_cashout": "is_extreme_amount * is_cash_out",
}
RISK_COLUMNS = {
    "high_risk_pattern": "int(is_round_amount = 1 and amount >= 100000 and is_night = 1)",
    "suspicious_timing": "int(is_deep_night = 1 or is_weekend = 1)",
}


def add_columns(df: DataFrame, definitions: dict[str, str]) -> DataFrame:
    """Append columns; a definition may use the ones before it."""
    return df.selectExpr("*", *[f"{e} as {n}" for n, e in definitions.items()])


def amount_stats(df: DataFrame, method: str = "exact", ddof: int = 0, accuracy: int = 100_000) -> DataFrame:
    """One row: p1, p5, p25, median, p75, p95, p99 (linear interpolation), mean, std of the amount.

    `exact` collapses to distinct amounts first and never holds them in one task.  `approx` answers the
    quantiles from mergeable sketches in one pass.
    """
    names = schema.AMOUNT_QUANTILES
    if method == "approx":
        std = "stddev_pop" if ddof == 0 else "stddev_samp"
        points = ", ".join(str(q) for q in names.values())
        return (df.selectExpr(f"{no_nan(_X)} as x")
                .selectExpr(f"percentile_approx(x, array({points}), {accuracy}) as q", "avg(x) as mean",
                            f"{std}(x) as std")
                .selectExpr(*[f"q[{i}] as {n}" for i, n in enumerate(names)], "mean", "std"))
    counts = value_counts(df, "amount")
    moments = moments_of_counts(counts, ddof).selectExpr("struct(mean, std)").scalar()
    return quantiles_of_counts(counts, names).withColumn("_m", moments).selectExpr(*names, "_m.mean", "_m.std")


def add_amount_features(df: DataFrame, stats: DataFrame) -> DataFrame:
    """log, z-score, round, extreme, category; NaN amounts count as missing."""
    rest = [c for c in df.columns if c != "amount"]
    fitted = df.withColumn("_s", stats.selectExpr("struct(p1, p99, mean, std)").scalar())
    return add_columns(fitted.selectExpr(*rest, f"{no_nan('amount')} as amount", "_s"), AMOUNT_COLUMNS).drop("_s")


def add_time_features(df: DataFrame) -> DataFrame:
    return add_columns(df, TIME_COLUMNS)


def add_type_features(df: DataFrame) -> DataFrame:
    """Sorted-label code of the labels present, and the cash-out flag.  The label set is one small array."""
    labels = df.selectExpr("array_sort(collect_set(type))").scalar()
    return add_columns(df.withColumn("_labels", labels), TYPE_COLUMNS).drop("_labels")


def add_interactions(df: DataFrame) -> DataFrame:
    return add_columns(df, INTERACTION_COLUMNS)


def add_risk_flags(df: DataFrame) -> DataFrame:
    return add_columns(df, RISK_COLUMNS)


def engineer_features(transactions: DataFrame, fit_on: DataFrame | None = None, method: str = "exact",
                      ddof: int = 0, stats: DataFrame | None = None) -> DataFrame:
    """key, the features as FLOAT, label.  `fit_on` takes the amount statistics from other rows (e.g. train only);
    `stats` is a stored table of them."""
    kept = filter_types(drop_leakage(transactions))
    if stats is None:
        stats = amount_stats(filter_types(fit_on) if fit_on is not None else kept, method, ddof)
    given = kept.withColumns({"_s": stats.selectExpr("struct(p1, p99, mean, std)").scalar(),
                              "_labels": kept.selectExpr("array_sort(collect_set(type))").scalar()})
    given = given.selectExpr(schema.KEY, "step", "type", f"{no_nan('amount')} as amount", schema.LABEL, "_s", "_labels")
    wide = add_columns(given, {**AMOUNT_COLUMNS, **TIME_COLUMNS, **TYPE_COLUMNS, **INTERACTION_COLUMNS, **RISK_COLUMNS})
    return wide.selectExpr(schema.KEY, *[f"cast({f} as float) as {f}" for f in schema.FEATURES],
                           f"cast({schema.LABEL} as int) as {schema.LABEL}")


def feature_manifest(features: DataFrame, names: Sequence[str] = tuple(schema.FEATURES)) -> DataFrame:
    """position, feature, type of each feature, with the table's shape and label rate on every row."""
    types = dict(features.dtypes)
    rows = ", ".join(f"struct({i} as position, '{n}' as feature, '{types[n]}' as type)" for i, n in enumerate(names))
    shape = features.selectExpr("count(*) as n_rows", f"avg(cast({schema.LABEL} as double)) as label_rate")
    return shape.selectExpr(f"inline(array({rows}))", f"{len(names)} as feature_count", "n_rows", "label_rate")
