"""Helpers that the operators of this package share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltide.session import ensure_checkpoint_dir


class Stored:
    """Intermediate Parquet tables below the cluster's shared checkpoint folder.

    Written tables cut lineage as a checkpoint does, survive lost executors and keep columns
    compressed.  ``drop`` deletes a table that nothing reads any more (the last iteration's).
    ``files`` bounds the files of a table that would be dealt over many more tasks than its rows
    are worth: each file costs a folder, a rename and, on some file systems, a process.
    """

    def __init__(self, spark: SparkSession, name: str, files: int | None = None):
        self.spark = spark
        self.files = files
        self.base = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{name}"
        (df.coalesce(self.files) if self.files else df).write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def freeing(run: Callable) -> Callable:
    """``run`` for ``mapInArrow``, handing its memory back to the system when a task ends.
    Workers are used again by later tasks and stages, and would keep what each once needed."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library's, where it has one
            if trim:
                trim(0)

    return wrapped


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spans_of(lengths: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose lengths sum to at most ``most`` (or that hold one item)."""
    lo, total = 0, 0
    for i, n in enumerate(lengths):
        if i > lo and total + n > most:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(lengths):
        yield lo, len(lengths)


def text_blocks(batches, at: int, most: int, each: int = 0) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of the batches with the texts of column ``at``, at most ``most`` code points each
    (or one row); a row counts as ``each`` at least.  Only one slice's texts are Python objects
    at a time, however large its batch."""
    for b in batches:
        lengths = pc.fill_null(pc.utf8_length(b.column(at).cast(pa.string())), 0).to_numpy()
        for lo, hi in spans_of(np.maximum(lengths, each).tolist(), most):
            yield b.slice(lo, hi - lo), b.column(at).slice(lo, hi - lo).to_pylist()
        del b  # before the next one is read


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_bucket(c: Column, buckets: int) -> Column:
    """crc32 of the value as text, modulo ``buckets``; null ids count as empty text."""
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % buckets
