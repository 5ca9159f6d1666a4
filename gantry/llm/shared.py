"""Helpers of the training-data operators: reading, cutting lineage, slicing batches, column names."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from gantry.session import scratch

#: Words are maximal runs of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
#: Bytes of text that a Python worker takes from a batch at a time.
PIECE_BYTES = 4 << 20

CLEANUP = "spark.sql.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def new_path(spark: SparkSession, name: str) -> str:
    """A new name in the folder of this application that all executors share; the folder goes when the driver ends."""
    return f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str = "zstd", by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` as a table written to the shared folder and read back, which cuts its lineage: the files outlive any executor.

    Spark removes the shuffle files of the write once it is done. ``by``: columns with a folder for each value.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    schema = df.schema
    before = spark.conf.get(CLEANUP, None)
    try:
        spark.conf.set(CLEANUP, "true")
        df.write.option("compression", compression).partitionBy(*by).parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    table = spark.read.schema(schema).parquet(path)
    table.written_to = path
    return table


def drop_written(*tables: DataFrame, folder: str = "") -> None:
    """Deletes the files (or one folder of them) behind ``written`` tables that no plan reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{df.written_to}/{folder}" if folder else df.written_to)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def sliced(batches: Iterator[pa.RecordBatch], text: int, most: int = PIECE_BYTES, rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """Slices of batches with about ``most`` bytes in column ``text``, or one row, and at most ``rows`` rows."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.cumsum(sizes) // most + np.arange(batch.num_rows) // rows * (1 << 40)
        bounds = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of batches, one at a time: where a row holds a whole block, a batch as Python objects would take its memory once more."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in batch.columns)


def released() -> None:
    """Gives the memory of caches that a task has dropped back to the system: Spark keeps its Python workers for the next operator."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def private(df: DataFrame, *names: str) -> list[str]:
    """Names for columns of an operator's own that no column of ``df`` has (Spark's names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
