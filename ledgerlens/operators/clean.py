"""Projections and filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerlens import schema
from ledgerlens.session import cut_lineage


def narrow_floats(df: DataFrame) -> DataFrame:
    """Store every DOUBLE column as FLOAT."""
    return df.select(*[F.col(c).cast("float").alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def drop_leakage(df: DataFrame, columns: Sequence[str] = tuple(schema.LEAKAGE)) -> DataFrame:
    """Drop columns that would give the label away; absent names are ignored."""
    return df.drop(*columns)


def filter_types(df: DataFrame, types: Sequence[str] = tuple(schema.KEPT_TYPES)) -> DataFrame:
    return df.where(F.col("type").isin(*types))


def select_xy(df: DataFrame) -> DataFrame:
    """Key, features and label; the text type column goes."""
    x = [c for c in df.columns if c not in (schema.KEY, schema.LABEL, "type")]
    return df.select(schema.KEY, *x, schema.LABEL)


def to_float_features(df: DataFrame, exclude: Sequence[str] = (schema.KEY, schema.LABEL)) -> DataFrame:
    """Every number except key and label becomes FLOAT."""
    numeric = (T.NumericType, T.BooleanType)
    return df.select(*[F.col(f.name).cast("float").alias(f.name)
                       if isinstance(f.dataType, numeric) and f.name not in exclude else F.col(f.name)
                       for f in df.schema.fields])


#: A label in more than one row of so many is heavy, so there are fewer heavy labels than this.
HEAVY_SHARE = 4096


def label_codes(df: DataFrame, column: str, ranges: int = 256) -> DataFrame:
    """(label, code, n_rows): rank of each distinct label in sorted order, from 0; missing is the text 'nan'.

    The distinct labels are cut into ranges at bounds drawn from a hash sample of them, so labels with a common start
    are spread like any others; a rank is the place inside the range plus the sizes of the ranges before it.
    """
    labels = cut_lineage(df.selectExpr(f"coalesce(cast(`{column}` as string), 'nan') as label")
                         .groupBy("label").agg(F.count("*").alias("n_rows")))
    n = labels.count()
    drawn = labels.where(f"pmod(xxhash64(label), {max(n, 1)}) < {32 * ranges}").select("label").limit(128 * ranges)
    sample = sorted((r["label"] for r in drawn.collect()), key=lambda x: x.encode())  # at most 128 * ranges labels
    bounds = sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)}, key=lambda x: x.encode()) if sample else []
    # the range of a label is the number of bounds that are not above it
    cut = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= F.col("label"))) if bounds else F.lit(0)
    placed = labels.withColumn("_b", cut)
    offsets = placed.groupBy("_b").count().selectExpr(
        "_b", "coalesce(sum(count) over (order by _b rows between unbounded preceding and 1 preceding), 0L) as _o")
    return (placed.selectExpr("label", "n_rows", "_b", "row_number() over (partition by _b order by label) as _r")
            .join(F.broadcast(offsets), "_b").selectExpr("label", "_o + _r - 1 as code", "n_rows"))


def label_key(label: Column) -> Column:
    """A key of at most 64 characters: a shorter label itself, the SHA-256 digits of any other, so keys are bounded."""
    return F.when(F.char_length(label) < 64, label).otherwise(F.sha2(label, 256))


def encode_remaining_strings(df: DataFrame, exclude: Sequence[str] = (schema.KEY, schema.LABEL),
                             broadcast_rows: int = 1_000_000) -> DataFrame:
    """Replace each leftover text column by its sorted-label code.

    The code table is written once, with the rows of each label: up to `broadcast_rows` labels it is sent to every task
    and no row moves.  Beyond that only heavy labels are sent, fewer than `HEAVY_SHARE` by their definition, and rows are
    shuffled once: those of other labels to their code, those of heavy labels, which have it already, by their own hash.
    So neither a label of half the rows nor many labels make one task large, and the code table is stored and moved once.
    """
    given = df
    for name in [f.name for f in df.schema.fields
                 if isinstance(f.dataType, T.StringType) and f.name not in exclude]:
        codes = cut_lineage(label_codes(given, name).select(
            label_key(F.col("label")).alias("_label"), F.col("code").cast("float").alias("_code"), "n_rows"))
        rows = df.withColumn("_label", label_key(F.coalesce(F.col(f"`{name}`"), F.lit("nan"))))
        n_labels, n_rows = codes.agg(F.count("*"), F.coalesce(F.sum("n_rows"), F.lit(0))).first()
        if n_labels <= broadcast_rows:
            joined = rows.join(F.broadcast(codes.drop("n_rows")), "_label", "left")
        else:
            is_heavy = F.col("n_rows") * HEAVY_SHARE > n_rows
            heavy = codes.where(is_heavy).select("_label", F.col("_code").alias("_sent"))
            rare = codes.where(~is_heavy).select("_label", "_code", F.xxhash64("_label").alias("_slot"))
            own = F.xxhash64(*[F.col(f"`{c}`") for c in given.columns])
            told = rows.join(F.broadcast(heavy), "_label", "left").withColumns({
                "_slot": F.when(F.col("_sent").isNull(), F.xxhash64("_label")).otherwise(own),
                "_label": F.when(F.col("_sent").isNull(), F.col("_label"))})
            joined = (told.join(rare, ["_slot", "_label"], "left")
                      .withColumn("_code", F.coalesce("_sent", "_code")).drop("_slot", "_sent"))
        df = joined.drop("_label", name).withColumnRenamed("_code", name)
    return df.select(*[f"`{c}`" for c in given.columns])
