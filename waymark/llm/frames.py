"""Small helpers the operators share: table checks, Arrow batches, worker imports."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from waymark.session import shared_folder
from waymark.sources.sinks import stage

__all__ = ["documents", "hold", "map_batches", "own_names", "pieces", "release", "shared_folder", "stage", "strings", "table", "workers_import"]

#: Bytes of an Arrow batch that an operator works on at a time, about.
PIECE = 8 << 20
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def own_names(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` without its own columns called like the ones an operator is about to add."""
    return df.drop(*[c for c in df.columns if c in set(names)])


def workers_import(df: DataFrame) -> None:
    """Python workers import this package; put the checkout's folder on their path where it is not installed."""
    environment = df.sparkSession.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """``batch`` in parts of about ``PIECE`` bytes, at least a row each, so that what is made of them stays small."""
    if batch.num_rows:
        step = max(1, batch.num_rows * PIECE // max(PIECE, batch.nbytes))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def small_batches(spark: SparkSession) -> None:
    """Spark fills Arrow batches up to ``PIECE`` bytes in this session, unless the session names another bound.

    By default one is 64 MB, which the executor holds twice, written and read, beside the
    worker's copy, and for each of its tasks.
    """
    if BATCH_BYTES not in spark.conf.getAll:
        spark.conf.set(BATCH_BYTES, str(PIECE))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | T.StructType) -> DataFrame:
    """Apply ``fn`` to parts of each Arrow batch; a task holds one batch, of about ``PIECE`` bytes or one row."""
    workers_import(df)
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        release(fn.__module__)
        for batch in batches:
            for piece in pieces(batch):
                yield fn(piece)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


_HELD: list[tuple[str, object, Callable[[], None]]] = []


def release(operator: str) -> None:
    """Drop what another operator's module left in this Python worker.

    Workers are used for one stage after another, and their memories must not add up.
    """
    if _HELD and _HELD[0][0] != operator:
        _HELD.pop()[2]()
        pa.default_memory_pool().release_unused()


def hold(operator: str, owner: object, forget: Callable[[], None]) -> None:
    """One memory at a time in a Python worker: taking it up drops the last one's."""
    if _HELD and _HELD[0][1] != owner:
        _HELD.pop()[2]()
    if not _HELD:
        _HELD.append((operator, owner, forget))


def strings(column: pa.Array) -> list[str]:
    """Texts of an Arrow column; null is the empty text."""
    return [t or "" for t in column.to_pylist()]
