"""Raw transaction input."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerlens import schema
from ledgerlens.session import broadcast_if_small

SHARED = 1 << 62  # keys from here on belong to rows that share their hash with another row


def read_transactions(spark: SparkSession, path: str | Sequence[str], mode: str = "FAILFAST", keys: str = "dense") -> DataFrame:
    """CSV scan with header and fixed types; all rows of all files, never a prefix.

    `mode="PERMISSIVE"` keeps malformed lines in `_corrupt_record` instead of failing.  `tx_id` numbers the rows by
    their content, so it does not depend on files, splits or retries: `keys="dense"` from 0 to n - 1 (`dense_keys`),
    `keys="content"` by the row's hash without moving rows (`content_keys`).
    """
    layout = T.StructType(schema.CSV_SCHEMA.fields)
    if mode == "PERMISSIVE":
        layout = T.StructType(layout.fields + [T.StructField("_corrupt_record", T.StringType())])
    raw = (spark.read.schema(layout).option("header", True).option("mode", mode)
           .option("enforceSchema", False).csv(path if isinstance(path, str) else list(path)))
    return {"dense": dense_keys, "content": content_keys}[keys](raw)


def dense_keys(df: DataFrame, key: str = schema.KEY, block: int = 10_000) -> DataFrame:
    """Add `key`, 0 to n - 1 in the order of a 64-bit hash of the row and then of its columns.

    Equal rows collapse map-side to one row with their number and are interchangeable; they take consecutive keys and
    are spread again in blocks.  Offsets come from the totals of 65536 hash buckets, the order inside a bucket from an
    ordinary partitioned window, so no task sees the whole table.
    """
    names = [f"`{c}`" for c in df.columns]
    rows = (df.groupBy(*names).agg(F.count("*").alias("_n"))
            .withColumn("_h", F.xxhash64(*names)).withColumn("_b", F.shiftright("_h", 48)))
    offsets = (rows.groupBy("_b").agg(F.sum("_n").alias("_s")).selectExpr(
        "_b", "coalesce(sum(_s) over (order by _b rows between unbounded preceding and 1 preceding), 0L) as _o"))
    inside = "sum(_n) over (partition by _b order by _h, " + ", ".join(names) + " rows between unbounded preceding and current row)"
    placed = rows.selectExpr("*", f"{inside} - _n as _w").join(offsets, "_b").selectExpr(*names, "_n", "_w + _o as _k")
    blocks = placed.selectExpr("_k", "_n", f"explode(sequence(0L, (_n - 1) div {block})) as _j", *names)
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.sparkSession.sparkContext.defaultParallelism)
    return (blocks.repartition(parts, "_k", "_j")  # a given number: few distinct rows would be put together again in one task
            .selectExpr(f"explode(sequence(_k + _j * {block}L, _k + least(_n, (_j + 1) * {block}L) - 1)) as `{key}`", *names))


def content_keys(df: DataFrame, key: str = schema.KEY, most: int = 2_000_000) -> DataFrame:
    """Add `key`, unique and >= 0: a 62-bit hash of the row where no other row has it, else a number from SHARED on.

    Only hashes are shuffled, counted map-side first.  Hashes that several rows have (equal rows, or collisions) are
    written; up to `most` of them are sent to every task, so that all other rows get their key where they are read.
    The rows behind them are numbered by `dense_keys`, which collapses equal rows before it moves any.
    """
    names = [f"`{c}`" for c in df.columns]
    rows = df.withColumn("_h", F.expr(f"xxhash64({', '.join(names)}) & {SHARED - 1}L"))
    shared = broadcast_if_small(rows.groupBy("_h").count().where("count > 1").select("_h"), most)
    alone = rows.join(shared, "_h", "left_anti").selectExpr(f"_h as `{key}`", *names)
    numbered = dense_keys(rows.join(shared, "_h", "left_semi").drop("_h"), key)
    return alone.unionByName(numbered.withColumn(key, F.col(key) + F.lit(SHARED)))


def append_chunks(chunks: Sequence[DataFrame]) -> DataFrame:
    """Append many inputs by column name."""
    return reduce(lambda a, b: a.unionByName(b), chunks)
