"""Profiles by chunk: states that can be merged, stored per chunk, so that an appended file costs one scan of its own.

A state is three tables, all sums over groups: per transaction type the rows, labels, missing cells and sums of each
numeric column (`cells`); distinct amounts with their number (`amounts`); 128-bit row digests with their number (`rows`).
Merging adds the numbers up, so the order of chunks and their sizes do not matter.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlens import schema
from ledgerlens.operators.profile import _missing, _present
from ledgerlens.operators.running import quantiles_of_counts, value_counts

KINDS = {"cells": ["type"], "amounts": ["value"], "rows": ["h1", "h2"]}


@dataclass(frozen=True)
class State:
    cells: DataFrame
    amounts: DataFrame
    rows: DataFrame


def state_of(df: DataFrame, numeric: Sequence[str] = tuple(schema.PROFILED)) -> State:
    """The state of one chunk.  Column `missing` counts the missing cells of all columns but the key."""
    names = [c for c in df.columns if c != schema.KEY]
    sums = ["count(*) as n", f"coalesce(sum(cast({schema.LABEL} as bigint)), 0L) as positives",
            f"count({schema.LABEL}) as labelled", " + ".join(f"count_if({_missing(df, c)})" for c in names) + " as missing"]
    for c in numeric:
        sums += [f"count_if({_missing(df, c)}) as {c}__missing", f"coalesce(sum({_present(df, c)}), 0.0D) as {c}__sum"]
    cells = df.groupBy("type").agg(*[F.expr(e) for e in sums])
    listed = ", ".join(names)
    digests = df.selectExpr(f"xxhash64({listed}) as h1", f"xxhash64('second', {listed}) as h2")
    return State(cells, value_counts(df, "amount"), digests.groupBy("h1", "h2").agg(F.count("*").alias("n")))


def merge(states: Sequence[State]) -> State:
    """The state of all chunks together."""
    out = {}
    for kind, keys in KINDS.items():
        tables = [getattr(s, kind) for s in states]
        rows = tables[0]
        for other in tables[1:]:
            rows = rows.unionByName(other)
        out[kind] = _summed(rows, keys)
    return State(**out)


def _summed(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in rows.columns if c not in keys])


def _valid(spark: SparkSession, work: str) -> DataFrame | None:
    try:
        return spark.read.schema("chunk string, folder string").parquet(f"{work}/chunks")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def store_chunk(df: DataFrame, work: str, chunk: str) -> bool:
    """Store the state of a chunk under its name; a chunk that is there already is not read again (False).

    A chunk counts once its row is in the table `chunks`, which is written last, so that a run that dies leaves none half.
    """
    spark = df.sparkSession
    known = _valid(spark, work)
    if known is not None and known.where(F.col("chunk") == chunk).limit(1).count():
        return False
    state, folder = state_of(df), "c" + uuid.uuid4().hex  # a letter first, so that it is read back as text
    for kind in KINDS:
        getattr(state, kind).write.parquet(f"{work}/{kind}/folder={folder}")
    spark.createDataFrame([(chunk, folder)], "chunk string, folder string").coalesce(1).write.mode("append").parquet(f"{work}/chunks")
    return True


def merged(spark: SparkSession, work: str) -> State:
    """The state of all stored chunks."""
    known = _valid(spark, work)
    if known is None:
        raise ValueError(f"no chunk is stored in {work}")
    folders = F.broadcast(known.groupBy("chunk").agg(F.min("folder").alias("folder")).select("folder"))  # a row per chunk
    return State(**{kind: _summed(spark.read.parquet(f"{work}/{kind}").join(folders, "folder", "left_semi").drop("folder"), keys)
                    for kind, keys in KINDS.items()})


def numeric_profile_of(state: State, columns: Sequence[str] = tuple(schema.PROFILED)) -> DataFrame:
    """column, missing, mean: as `profile.numeric_profile` gives them for the whole table."""
    rows = ", ".join(f"struct('{c}' as column, coalesce(sum({c}__missing), 0L) as missing, "
                     f"try_divide(sum({c}__sum), sum(n) - sum({c}__missing)) as mean)" for c in columns)
    return state.cells.selectExpr(f"array({rows}) as r").selectExpr("inline(r)")


def amount_summary_of(state: State) -> DataFrame:
    """One row: min, max, mean and exact median of the amount."""
    wide = state.amounts.selectExpr("min(value) as min", "max(value) as max", "try_divide(sum(value * n), sum(n)) as mean")
    return wide.withColumn("median", quantiles_of_counts(state.amounts, {"median": 0.5}).scalar())


def type_counts_of(state: State) -> DataFrame:
    return state.cells.select("type", "n").orderBy(F.desc("n"), "type")


def profile_of(state: State) -> DataFrame:
    """The record of `profile.dataset_profile`; rows with equal 128-bit digests count as equal."""
    base = state.cells.selectExpr(
        "coalesce(sum(n), 0L) as total_rows", "coalesce(sum(positives), 0L) as fraud_count",
        "try_divide(cast(sum(positives) as double), sum(labelled)) as fraud_rate",
        "array_sort(collect_set(type)) as transaction_types", "coalesce(sum(missing), 0L) as missing_values")
    amount = amount_summary_of(state).selectExpr("struct(min, max, mean, median)").scalar()
    repeated = state.rows.selectExpr("coalesce(sum(n - 1), 0L)").scalar()
    return (base.withColumns({"amount_stats": amount, "duplicates": repeated})
            .selectExpr("total_rows", "fraud_count", "fraud_rate", "transaction_types", "amount_stats",
                        "struct(missing_values, duplicates) as data_quality"))
