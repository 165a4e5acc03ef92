"""Small helpers that several text operators share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator
from itertools import compress, repeat
from operator import is_
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

BATCH_BYTES = 16 << 20  # an output batch is handed on once it holds this much
BATCH_ROWS = 1_000  # rows that Spark hands to a task function at a time; texts are long, so the usual 10,000 are too many


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def short_batches(spark: SparkSession) -> None:
    """Have the session hand at most BATCH_ROWS rows at a time to task functions; a smaller setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def worker_state(key: str, make: Callable[[], Any]) -> Any:
    """One object per Python worker and key, kept from task to task (parsed vocabularies, bounded caches) until a task of
    `add_columns` runs that does not ask for it."""
    store = _held()
    if key not in store:
        store[key] = [make(), False]
    store[key][1] = True
    return store[key][0]


def _held() -> dict[str, list]:
    """By key: the object, and whether the present task has asked for it."""
    module = sys.modules.setdefault("_text_worker_state", types.ModuleType("_text_worker_state"))
    return vars(module).setdefault("held", {})


def _only_asked_for(make: Callable[[], Any]) -> Any:
    """What `make` gives; what earlier tasks kept and it does not ask for is let go."""
    store = _held()
    for entry in store.values():
        entry[1] = False
    made = make()
    for key in [k for k, (_, asked) in store.items() if not asked]:
        del store[key]
    return made


def batches_of(rows: Iterable[tuple], schema: pa.Schema, size: Callable[[tuple], int], limit: int = BATCH_BYTES,
               most: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Pack rows into record batches that are bounded in bytes and rows, whatever the length of a text."""
    columns: list[list] = [[] for _ in schema]
    held = 0
    for row in rows:
        for column, cell in zip(columns, row):
            column.append(cell)
        held += size(row) + 16
        if held >= limit or len(columns[0]) >= most:
            yield _batch(columns, schema)
            columns, held = [[] for _ in schema], 0
    if columns[0]:
        yield _batch(columns, schema)


def _batch(columns: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def slices(batch: pa.RecordBatch, column: str | int, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of at most `limit` bytes in one column (a single row may be longer)."""
    start, held = 0, 0
    for i, cell in enumerate(batch.column(column)):
        n = cell.as_buffer().size if cell.is_valid else 0
        if held and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def replaced(df: DataFrame, added: str) -> tuple[list[str], StructType]:
    """Columns of `df` that stay, and the schema once the columns named in `added` (a DDL list) follow them.

    An added column takes the place of an input column with the same name, in any case.
    """
    extra = StructType.fromDDL(added)
    taken = {f.name.lower() for f in extra}
    kept = [f for f in df.schema if f.name.lower() not in taken]
    return [f.name for f in kept], StructType([*kept, *extra])


class Known:
    """Results by key.  At most `most` are remembered, the first ones met, since frequent keys come early; they are
    forgotten when they no longer help, that is when over the share `forget` of the keys asked for are not among them.

    `resolve` gives the results of a list of distinct keys; a result is never None.
    """

    def __init__(self, resolve: Callable[[list], Iterable], most: int = 100_000, forget: float = 0.25):
        self.resolve, self.most, self.forget, self.by_key = resolve, most, forget, {}

    def lookup(self, keys: list) -> list:
        """The result of each key."""
        found = list(map(self.by_key.get, keys))
        places = list(compress(range(len(found)), map(is_, found, repeat(None))))
        if places:
            new = list({keys[i] for i in places})
            fresh = dict(zip(new, self.resolve(new)))
            for i in places:
                found[i] = fresh[keys[i]]
            if len(self.by_key) >= self.most and len(places) > self.forget * len(keys):
                self.by_key = {}
            if len(self.by_key) < self.most:
                self.by_key.update(fresh)
        return found


def runs(cells: list, lengths: Iterable[int]) -> Iterator[list]:
    """Consecutive parts of a list."""
    start = 0
    for n in lengths:
        yield cells[start:start + n]
        start += n


def add_columns(df: DataFrame, column: str, added: str, make: Callable[[], Callable[[Any], list]], limit: int = 2 << 20,
                keep: list[str] | None = None, arrow: bool = False) -> DataFrame:
    """Append columns computed from one string or binary column, about `limit` bytes of it at a time.

    `make` is called once per task and returns a function from a list of cells (an Arrow array if `arrow`) to one list
    or array per new column.  `keep` names the columns of `df` that come back, by default all; the others are not sent
    to the task, and the column that is read is sent once.
    """
    short_batches(df.sparkSession)
    if keep is not None:
        kept, schema = replaced(df.select(*map(quoted, keep)), added)
    else:
        kept, schema = replaced(df, added)
    new = pa.schema([f for f in _arrow(schema)][len(kept):])
    place = next((i for i, c in enumerate(kept) if c.lower() == column.lower()), len(kept))
    sent = [F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(kept)]  # by place, so that no two names clash
    if place == len(kept):
        sent.append(F.col(quoted(column)).alias(f"c{place}"))
    width = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = _only_asked_for(make)
        for whole in batches:
            for batch in slices(whole, place, limit):
                cells = batch.column(place)
                out = work(cells if arrow else cells.to_pylist())
                arrays = [batch.column(c) for c in range(width)]
                arrays += [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(out, new)]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)
            pa.default_memory_pool().release_unused()  # what a large batch took is not kept for the next one

    return df.select(*sent).mapInArrow(run, schema)


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)
