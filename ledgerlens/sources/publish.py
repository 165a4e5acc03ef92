"""Stages that appear as a whole: tables go to fresh folders, and a manifest says which of them are valid.

The manifest is an append-only table, one row per published table.  Its rows of one stage arrive in one file, so a reader
sees all tables of a stage or none of them.  A stage that dies in the middle leaves folders that no row names.  A work
folder has one writer at a time; folders that no latest row names may be deleted once nobody reads them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

LAYOUT = ("seq long, step string, version string, inputs string, name string, path string, n_rows long, "
          "columns array<string>")


@dataclass
class _Open:
    """A stage that is being written: its folder, and the table to count per name."""
    work: str
    folder: str
    counted: dict[str, str] = field(default_factory=dict)


_open: ContextVar[_Open | None] = ContextVar("open_stage", default=None)


def _join(work: str, *names: str) -> str:
    return "/".join([work.rstrip("/"), *names])


def _read_manifest(spark: SparkSession, work: str) -> DataFrame | None:
    try:
        return spark.read.schema(LAYOUT).parquet(_join(work, "published"))
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def manifest(spark: SparkSession, work: str) -> DataFrame:
    """The latest row of each table: when, by which stage and from what it was published, its rows and columns."""
    rows = _read_manifest(spark, work)
    if rows is None:
        return spark.createDataFrame([], LAYOUT)
    latest = rows.groupBy("name").agg(F.max_by(F.struct(*rows.columns), "seq").alias("r"))
    return latest.select("r.*")


def current(spark: SparkSession, work: str) -> dict[str, tuple[str, str]]:
    """(version, inputs) of the last publication of each stage."""
    rows = _read_manifest(spark, work)
    if rows is None:
        return {}
    return {r["step"]: tuple(r["r"]) for r in rows.groupBy("step").agg(
        F.max_by(F.struct("version", "inputs"), "seq").alias("r")).collect()}  # a row per stage


def locate(spark: SparkSession, work: str, name: str) -> str:
    """Where to read a table: in the open stage, else where it was last published, else the plain folder of its name."""
    stage = _open.get()
    if stage is not None and stage.work == work and name in stage.counted:
        return _join(work, stage.folder, name)
    rows = _read_manifest(spark, work)
    found = rows.where(F.col("name") == name).agg(F.max_by("path", "seq")).first()[0] if rows is not None else None
    return _join(work, found or name)


def target(work: str, name: str, table: str = "") -> str:
    """Where to write a table; `table` is the folder below it whose rows the manifest counts."""
    stage = _open.get()
    if stage is None or stage.work != work:
        return _join(work, name)
    path = _join(work, stage.folder, name)
    stage.counted[name] = path + table
    return path


@contextmanager
def publication(spark: SparkSession, work: str, step: str, inputs: str = "") -> Iterator[None]:
    """What the block writes under `work` is published when it ends; after an error nothing is."""
    version = uuid.uuid4().hex
    stage = _Open(work, f"{step}-{version}")
    token = _open.set(stage)
    try:
        yield
    finally:
        _open.reset(token)
    if not stage.counted:
        return
    told = _read_manifest(spark, work)
    last = told.agg(F.max("seq")).first()[0] if told is not None else None
    rows = []
    for name, path in stage.counted.items():
        df = spark.read.parquet(path)
        rows.append(((last or 0) + 1, step, version, inputs, name, f"{stage.folder}/{name}", df.count(), df.columns))
    spark.createDataFrame(rows, LAYOUT).coalesce(1).write.mode("append").parquet(_join(work, "published"))
