"""Stage outputs: Parquet tables, saved models and one-row metadata tables under one work folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from ledgerlens import schema
from ledgerlens.operators.boosting import BoostedModel
from ledgerlens.sources.publish import locate, target


def write_table(df: DataFrame, work: str, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write one stage table and return the written copy: in a publication a new folder, else its plain one again."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(target(work, name))
    return read_table(df.sparkSession, work, name, df.schema)


def read_table(spark: SparkSession, work: str, name: str, layout: T.StructType | None = None) -> DataFrame:
    """Read a stage table; with a layout, without looking into its files first."""
    reader = spark.read.schema(layout) if layout is not None else spark.read
    return reader.parquet(locate(spark, work, name))


def read_loaded(spark: SparkSession, work: str) -> DataFrame:
    layout = T.StructType([T.StructField(schema.KEY, T.LongType()), *schema.CSV_SCHEMA.fields])
    return read_table(spark, work, "loaded", layout)


def read_features(spark: SparkSession, work: str) -> DataFrame:
    return read_table(spark, work, "features", schema.feature_table_schema())


def write_splits(splits: DataFrame, work: str) -> DataFrame:
    """The original rows, one partition per split; train is stored once and never rewritten."""
    order = [f.name for f in schema.split_table_schema().fields if f.name != "is_synthetic"]
    rows = splits.selectExpr(*order[:-1], "false as is_synthetic", "split")
    return write_table(rows, work, "splits", ["split"])


def add_balancing(work: str, synthetic: DataFrame | None, removed: DataFrame | None, spark: SparkSession) -> None:
    """Append synthetic rows as a partition of their own, and list the original keys left out of balanced train."""
    if synthetic is not None:
        order = [f.name for f in schema.split_table_schema().fields][:-2]
        rows = synthetic.selectExpr(*order, "true as is_synthetic", "'synthetic' as split")
        rows.write.mode("append").partitionBy("split").parquet(locate(spark, work, "splits"))
    none = spark.createDataFrame([], f"{schema.KEY} long")
    write_table(none if removed is None else removed.select(schema.KEY).where(f"{schema.KEY} >= 0"), work, "removed")


def read_split(spark: SparkSession, work: str, name: str) -> DataFrame:
    """train, val, test or train_balanced."""
    rows = read_table(spark, work, "splits", schema.split_table_schema())
    if name != "train_balanced":
        return rows.where(f"split = '{name}'")
    removed = read_table(spark, work, "removed")
    n = removed.count()
    balanced = rows.where("split in ('train', 'synthetic')")
    if n == 0:
        return balanced
    return balanced.join(removed.hint("broadcast") if n <= 2_000_000 else removed, schema.KEY, "left_anti")


def write_model(model: BoostedModel, work: str) -> str:
    """The trees of a model as a table of nodes, and its features."""
    spark, path = SparkSession.active(), target(work, "model", "/nodes")
    model.nodes(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    spark.createDataFrame([(list(model.features),)], "features array<string>").coalesce(1).write.mode("overwrite").parquet(f"{path}/features")
    return path


def read_model(work: str) -> BoostedModel:
    spark = SparkSession.active()
    path = locate(spark, work, "model")
    features = spark.read.parquet(f"{path}/features").first()["features"]
    return BoostedModel.of_nodes(features, spark.read.parquet(f"{path}/nodes"))
