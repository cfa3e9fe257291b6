"""What the corpus operators share: table access, and names of rows."""

from __future__ import annotations

import ctypes
import gc
import string
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectio.sources.shared import dealt, few, forget, release, stored

__all__ = ["few", "forget", "keep_nothing", "kept", "lean", "lowered", "release", "row_name", "small_batches", "stored", "table", "texts"]

T = TypeVar("T")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return dealt(rows) if name == "documents" else rows


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text only; a null text counts as empty. Other columns, whatever their names, are left out."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def row_name() -> Column:
    """The name of a row of texts(): a 64-bit hash of doc_id and text, never null; equal rows have equal names."""
    return F.xxhash64("doc_id", "text")


def lowered(text: Column) -> Column:
    """A-Z lower-cased and nothing else. lower() is much faster than translate(), and the same unless there is a capital beyond A-Z."""
    return F.when(text.rlike(r"[\x{80}-\x{10FFFF}&&[\p{Lu}\p{Lt}\p{Nl}\p{So}]]"), F.translate(text, string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.lower(text))


#: What a Python worker keeps between tasks, by operator: a vocabulary with the pieces that it knows, for one.
_KEPT: dict[str, object] = {}


def kept(name: str, make: Callable[[], T]) -> T:
    """What this worker keeps for an operator, made when it is not there. What it kept for another one goes."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = make()
    return _KEPT[name]


def keep_nothing() -> None:
    """Called by tasks that need memory of their own: workers go from one operator to the next."""
    _KEPT.clear()


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow(); at its end the worker gives the memory that it has freed back to the system. Workers stay, idle
    ones too, and else each would hold the most that it ever had beside its executor's heap."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library of Linux alone has it
        if trim is not None:
            trim(0)

    return whole


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """What is computed inside sends Arrow batches of so many rows at most, which bounds the memory of a worker that holds one."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
