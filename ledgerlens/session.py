"""Session helpers: local test sessions and lineage cuts that survive the loss of an executor."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import broadcast


def local_session(cores: int | str = "*", app: str = "ledgerlens", memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks; on a cluster pass the session it hands out instead."""
    return (SparkSession.builder.master(f"local[{cores}]").appName(app)
            .config("spark.driver.memory", memory)
            .config("spark.sql.shuffle.partitions", "8")
            .config("spark.sql.adaptive.enabled", "true")
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.ui.enabled", "false")
            .getOrCreate())


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the session names; a temporary one only for a local master (tests).

    On a cluster a folder of the driver's machine would be a different folder on every executor, so none is made up.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
        if not named:
            if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="ledgerlens-checkpoint-")
            spark.sparkContext.setCheckpointDir(named)
        return named
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession) -> str:
    """A fresh path in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerlens-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` once as a table in the shared folder and continue from it.

    A lost executor then costs a re-read, not a recomputation, and later steps still read only the columns they use.
    """
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, limit: int = 2_000_000) -> DataFrame:
    """A narrow key table, written once and counted: sent to every task if it is small, shuffled otherwise."""
    stored = cut_lineage(df)
    return broadcast(stored) if stored.count() <= limit else stored
