"""Helpers of the operators: tables and Arrow mapping; written tables come from the session helpers."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import forget, materialise, ship

__all__ = ["begin", "filter_rows", "forget", "id_text", "keeps", "map_arrow", "materialise", "table"]

#: What operators keep in this worker process from task to task: by operator, how to drop it.
_KEPT: dict[str, Callable[[], None]] = {}


def keeps(owner: str, drop: Callable[[], None]) -> None:
    """Tell that ``owner`` keeps something beyond a task."""
    _KEPT[owner] = drop


def begin(owner: str | None = None) -> None:
    """At the start of a task: drop what operators other than ``owner`` keep, and give the memory back. Spark uses a worker
    again for whatever comes next, which otherwise has the caches of all operators before beside its own."""
    others = [x for x in _KEPT if x != owner]
    for x in others:
        _KEPT.pop(x)()
    if others:
        gc.collect()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc alone has it
            trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just the id (as long) and the text, under fixed names, so that other columns cannot clash."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], dict | Iterable[dict] | None], schema: str, owner: str | None = None) -> DataFrame:
    """Apply ``fn`` to each Arrow batch; it returns columns by name, or several such dicts (lazily, if it is a generator).
    ``owner`` names what ``fn`` keeps from task to task, if it does (``keeps``)."""
    ship(df.sparkSession)
    names = [c.name for c in _struct(schema)]
    target = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(owner)
        for batch in batches:
            if not batch.num_rows:
                continue
            got = fn(batch)
            for part in [got] if got is None or isinstance(got, dict) else got:
                if part is not None:
                    yield pa.RecordBatch.from_arrays([_array(part[n], target.field(n).type) for n in names], schema=target)

    return df.mapInArrow(run, schema)


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def _struct(schema: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema)


def _arrow_schema(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(_struct(schema))


def filter_rows(docs: DataFrame, keep: Callable[[], Callable[[str | None], bool]], text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text passes, with all columns and whatever names they have. ``keep`` makes the test, once a task."""
    ship(docs.sparkSession)
    names = [f"c{k}" for k in range(len(docs.columns))]
    at = docs.columns.index(text_col)
    rows = docs.toDF(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin()
        test = keep()
        for batch in batches:
            yield batch.filter(pa.array([test(t) for t in batch.column(at).to_pylist()], pa.bool_()))

    return rows.mapInArrow(run, rows.schema).toDF(*docs.columns)
