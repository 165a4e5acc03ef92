"""Profiling and validation aggregates.  Every result is a small table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from ledgerlens import schema
from ledgerlens.functions.scalar import ratio
from ledgerlens.operators.running import quantiles_of_counts, value_counts
from ledgerlens.session import broadcast_if_small

_FRACTIONAL = (T.FloatType, T.DoubleType)


def _missing(df: DataFrame, name: str) -> str:
    nan = f" or isnan({name})" if isinstance(df.schema[name].dataType, _FRACTIONAL) else ""
    return f"({name} is null{nan})"


def _present(df: DataFrame, name: str) -> str:
    return f"case when not {_missing(df, name)} then cast({name} as double) end"


def _long(df: DataFrame, names: Sequence[str], key: str, stats: dict[str, str]) -> DataFrame:
    """One aggregate over all columns at once, turned into one row per column.

    `stats` gives an expression per statistic, with {present} and {missing} for the column at hand.
    """
    wide = df.selectExpr(*[f"{e.format(present=_present(df, n), missing=_missing(df, n))} as {n}__{s}"
                           for n in names for s, e in stats.items()])
    rows = ", ".join(f"named_struct('{key}', '{n}', " + ", ".join(f"'{s}', {n}__{s}" for s in stats) + ")"
                     for n in names)
    return wide.selectExpr(f"inline(array({rows}))")


def numeric_profile(df: DataFrame, columns: Sequence[str] = tuple(schema.PROFILED)) -> DataFrame:
    """column, missing, mean (without missing values); absent columns are skipped."""
    return _long(df, [c for c in columns if c in df.columns], "column",
                 {"missing": "count_if({missing})", "mean": "avg({present})"})


def _missing_cells(df: DataFrame, names: Sequence[str]) -> str:
    return " + ".join(f"count_if({_missing(df, c)})" for c in names)


def missing_cells(df: DataFrame) -> DataFrame:
    """One row: number of missing cells over all columns."""
    return df.selectExpr(f"{_missing_cells(df, df.columns)} as missing_values")


def label_balance(df: DataFrame, label: str = schema.LABEL) -> DataFrame:
    return (df.selectExpr("count(*) as total_rows", f"coalesce(sum(cast({label} as bigint)), 0L) as fraud")
            .selectExpr("total_rows", "fraud", "total_rows - fraud as legit",
                        f"{ratio('fraud', 'total_rows')} * 100 as fraud_percent"))


def rate_band(balance: DataFrame, low: float = schema.FRAUD_PERCENT_BAND[0],
              high: float = schema.FRAUD_PERCENT_BAND[1]) -> DataFrame:
    """Mark a balance whose percentage lies outside the band; the limits themselves are usual."""
    return balance.selectExpr("*", f"case when fraud_percent < {low}D or fraud_percent > {high}D "
                                   "then 'UNUSUAL' else 'NORMAL' end as band")


def type_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("type").count().withColumnRenamed("count", "n").orderBy(F.desc("n"), "type")


def distinct_types(df: DataFrame) -> DataFrame:
    return df.select("type").distinct().orderBy("type")


def amount_summary(df: DataFrame, column: str = "amount") -> DataFrame:
    """One row: min, max, mean and exact median, without missing values."""
    counts = value_counts(df, column)
    wide = counts.selectExpr("min(value) as min", "max(value) as max",
                             "try_divide(sum(value * n), sum(n)) as mean")
    return wide.withColumn("median", quantiles_of_counts(counts, {"median": 0.5}).scalar())


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None, broadcast_limit: int = 2_000_000) -> DataFrame:
    """One row: number of rows equal to another, earlier one on the given columns (default all but the key).

    Rows are first counted per 64-bit hash, so only hashes cross the network.  Rows whose hash is unique cannot
    be duplicates; the rest are compared on the columns themselves, so a hash collision never counts.
    """
    names = list(columns or [c for c in df.columns if c != schema.KEY])
    rows = df.selectExpr(*names, f"xxhash64({', '.join(names)}) as _h")
    shared = broadcast_if_small(rows.groupBy("_h").count().where("count > 1").select("_h"), broadcast_limit)
    rows = rows.join(shared, "_h", "left_semi")
    return rows.groupBy(*names).count().selectExpr("coalesce(sum(count - 1), 0L) as duplicates")


def dataset_profile(df: DataFrame) -> DataFrame:
    """One record with the whole profile; the fraud rate is a fraction here."""
    cells = [c for c in df.columns if c != schema.KEY]
    base = df.selectExpr("count(*) as total_rows", f"coalesce(sum(cast({schema.LABEL} as bigint)), 0L) as fraud_count",
                         f"avg(cast({schema.LABEL} as double)) as fraud_rate",
                         "array_sort(collect_set(type)) as transaction_types",
                         f"{_missing_cells(df, cells)} as missing_values")
    amount = amount_summary(df).selectExpr("struct(min, max, mean, median)").scalar()
    return (base.withColumns({"amount_stats": amount, "duplicates": duplicate_rows(df).scalar()})
            .selectExpr("total_rows", "fraud_count", "fraud_rate", "transaction_types", "amount_stats",
                        "struct(missing_values, duplicates) as data_quality"))


def split_balance(splits: DataFrame, label: str = schema.LABEL) -> DataFrame:
    return (splits.groupBy("split").agg(F.expr("count(*) as n"), F.expr(f"sum(cast({label} as bigint)) as positives"))
            .selectExpr("split", "n", "positives", f"{ratio('positives', 'n')} as rate"))


def split_audit(splits: DataFrame, features: Sequence[str] = tuple(schema.FEATURES)) -> DataFrame:
    """Per split: any missing cell, any infinite cell, how many cells were missing, mean over all finite cells."""
    infinite = [f"coalesce(abs({f}) = float('infinity'), false)" for f in features]
    missing = [_missing(splits, f) for f in features]
    finite = [f"not ({m}) and not {i}" for m, i in zip(missing, infinite)]
    cells = " + ".join(f"case when {ok} then cast({f} as double) else 0.0D end" for f, ok in zip(features, finite))

    def count(conditions: Sequence[str]) -> str:
        return "cast(" + " + ".join(f"int({c})" for c in conditions) + " as bigint)"

    rows = splits.selectExpr("split", f"{count(missing)} as m", f"{' or '.join(infinite)} as i", f"{cells} as s",
                             f"{count(finite)} as f")
    return (rows.groupBy("split").agg(F.expr("sum(m) as missing_cells"), F.expr("max(i) as has_inf"),
                                      F.expr("try_divide(sum(s), sum(f)) as grand_mean"))
            .selectExpr("split", "missing_cells > 0 as has_nan", "has_inf", "missing_cells", "grand_mean"))


def feature_moments(df: DataFrame, features: Sequence[str] = tuple(schema.FEATURES)) -> DataFrame:
    """feature, mean, std (population), from one aggregate over all features."""
    return _long(df, features, "feature", {"mean": "avg({present})", "std": "stddev_pop({present})"})


def moments_summary(moments: DataFrame) -> DataFrame:
    """The averages of the per-feature means and deviations."""
    return moments.selectExpr("avg(mean) as mean_of_means", "avg(std) as mean_of_stds")


def filter_reduction(df: DataFrame, types: Sequence[str] = tuple(schema.KEPT_TYPES)) -> DataFrame:
    kept = ", ".join(f"'{t}'" for t in types)
    return df.selectExpr("count(*) as rows_before", f"count_if(type in ({kept})) as rows_after")
