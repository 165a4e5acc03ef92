"""Running totals and exact quantiles over very many distinct values without a one-task sort.

A plain window with no partition key moves every row to one task.  Here rows are first collapsed to one per
distinct value (map-side partial aggregation), then summed per coarse, order-preserving bucket.  Only the small
bucket table is scanned in one task; inside a bucket the running sum is an ordinary partitioned window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ledgerlens.functions.scalar import log_bucket


def running_totals(by_value: DataFrame, value: str, sums: Sequence[str], bucket: str,
                   by: Sequence[str] = (), descending: bool = False) -> DataFrame:
    """Add `c_<s>`, the running total of each s in `sums` in order of `value` (one row per `by` + value).

    `bucket` is an expression that never decreases when `value` grows and has a bounded number of results.
    It is made non-NULL so that the join below adds no filter and both branches share one exchange.
    """
    keys = [*by, "_b"]
    way = "desc" if descending else "asc"
    empty = "''" if dict(by_value.dtypes)[value] == "string" else "0L"
    rows = by_value.selectExpr("*", f"coalesce({bucket}, {empty}) as _b")
    outer = f"partition by {', '.join(by)}" if by else ""
    offsets = (rows.groupBy(*keys).agg({s: "sum" for s in sums})
               .selectExpr(*keys, *[f"coalesce(sum(`sum({s})`) over ({outer} order by _b {way} rows between "
                                    f"unbounded preceding and 1 preceding), 0L) as _o_{s}" for s in sums]))
    local = rows.selectExpr("*", *[f"sum({s}) over (partition by {', '.join(keys)} order by {value} {way} "
                                   f"rows between unbounded preceding and current row) as _l_{s}" for s in sums])
    return local.join(offsets, keys).selectExpr(*by_value.columns,
                                                *[f"_l_{s} + _o_{s} as c_{s}" for s in sums])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value double, n): distinct non-missing values of a numeric column."""
    return (df.selectExpr(f"cast({column} as double) as value").where("value is not null and not isnan(value)")
            .groupBy("value").count().withColumnRenamed("count", "n"))


def quantiles_of_counts(counts: DataFrame, points: dict[str, float]) -> DataFrame:
    """One row with the linearly interpolated quantiles of a (value, n) table."""
    ranked = running_totals(counts, "value", ["n"], log_bucket("value"))
    ranked = ranked.withColumn("_t", counts.groupBy().sum("n").scalar())
    aggs = []
    for name, q in points.items():
        position = f"((_t - 1) * {float(q)}D)"
        for end, rank in (("lo", f"floor{position}"), ("hi", f"ceil{position}")):
            aggs.append(f"max(case when c_n > {rank} and c_n - n <= {rank} then value end) as {name}_{end}")
        aggs.append(f"max({position} - floor{position}) as {name}_w")
    return ranked.selectExpr(*aggs).selectExpr(*[f"{n}_lo + ({n}_hi - {n}_lo) * {n}_w as {n}" for n in points])


def moments_of_counts(counts: DataFrame, ddof: int = 0) -> DataFrame:
    """One row (n, mean, std) of a (value, n) table; the second pass runs over distinct values only."""
    mean = counts.selectExpr("try_divide(sum(value * n), sum(n)) as mean").scalar()
    return (counts.withColumn("_m", mean)
            .selectExpr("coalesce(sum(n), 0L) as n", "try_divide(sum(value * n), sum(n)) as mean",
                        f"sqrt(try_divide(sum((value - _m) * (value - _m) * n), sum(n) - {int(ddof)})) as std"))
