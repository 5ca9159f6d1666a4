"""Streams of files: discovery in bounded batches, the latest row of each key, attempts with a freeze, and changes of state.

A stream resumes from its checkpoint: files that have been processed are not read again (2.11).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gantry.sources import versioned as V


def discovered(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 100, fmt: str = "parquet") -> DataFrame:
    """The rows of files as they appear in ``folder``, at most so many files a batch, with the path of each row's file (SRC19)."""
    found = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", True).load(folder)
    return found.withColumn("path", F.col("_metadata.file_path"))


def drained(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Runs a stream over all there is and stops: each batch is appended to ``out``, exactly once."""
    query = stream.writeStream.outputMode(mode).format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def latest_per_key(stream: DataFrame, table: str, checkpoint: str, keys: list[str], at: str) -> None:
    """Keeps the table of the latest row of each key, as a table in versions (``sources.versioned``): a batch writes anew the buckets that its keys fall into, and superseded versions go.

    A batch that is repeated after a failure finds its number in the manifest and is left out.
    """

    def merge(batch: DataFrame, number: int) -> None:
        m = V.manifest(batch.sparkSession, table)
        if m is None or int(m.tag) < number:
            V.upsert(batch, table, keys, at=at, tag=str(number))
            V.drop_versions(batch.sparkSession, table)

    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def attempts(stream: DataFrame, key: str, failed: str, most: int) -> DataFrame:
    """Per key and batch: attempts so far, and closed, retry or frozen (after ``most`` failures); a frozen key stays frozen (stateful)."""

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, frozen = state.get if state.exists else (0, False)
        last = False
        for pdf in batches:
            n += int(pdf["_failed"].sum())
            last = last or bool(pdf["_failed"].any())
        frozen = frozen or n >= most
        state.update((n, frozen))
        yield pd.DataFrame({"key": [str(k[0])], "attempts": [n], "state": ["frozen" if frozen else "retry" if last else "closed"]})

    rows = stream.select(F.col(key).cast("string").alias("_key"), F.col(failed).cast("boolean").alias("_failed"))
    return rows.groupBy("_key").applyInPandasWithState(step, "key string, attempts long, state string", "n long, frozen boolean", "append", GroupStateTimeout.NoTimeout)


def changes(stream: DataFrame, key: str, value: str, at: str) -> DataFrame:
    """A row only where a key's value differs from the one before, in the order of ``at`` within a batch (change-only event log, D93)."""

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before = state.get[0] if state.exists else ()  # differs from any value, null too
        found = sorted(((at_, v) for pdf in batches for at_, v in zip(pdf["_at"].tolist(), pdf["_value"].tolist())), key=lambda r: r[0])  # a few rows a key and batch: lists cost less than frames
        at_new, new = [], []
        for at_, v in found:
            if v != before:
                at_new.append(at_)
                new.append(v)
                before = v
        state.update((before,))
        if new:
            yield pd.DataFrame({"key": str(k[0]), "at": at_new, "value": new})

    rows = stream.select(F.col(key).cast("string").alias("_key"), F.col(value).cast("string").alias("_value"), F.col(at).cast("long").alias("_at"))
    return rows.groupBy("_key").applyInPandasWithState(step, "key string, at long, value string", "value string", "append", GroupStateTimeout.NoTimeout)


def stalled(progress: DataFrame, at: str, now: str, seconds: int) -> DataFrame:
    """``progress`` with whether nothing has come for ``seconds`` (stall alarm)."""
    return progress.withColumn("stalled", F.unix_timestamp(now) - F.unix_timestamp(at) > seconds)
