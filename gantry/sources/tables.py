"""Tables of any format by suffix, tolerant CSV, and text writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from gantry.sources import versioned as V


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV file with a header; rows that don't fit the schema are left out (SRC7)."""
    return spark.read.option("header", True).option("mode", "DROPMALFORMED").schema(schema).csv(path)


def read_any(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Parquet, CSV, JSON lines or text, by the path's suffix (SRC14)."""
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix == "parquet":
        return spark.read.parquet(path)
    if suffix == "csv":
        return read_csv(spark, path, schema) if schema else spark.read.option("header", True).csv(path)
    if suffix in ("json", "jsonl"):
        return spark.read.schema(schema).json(path) if schema else spark.read.json(path)
    if suffix == "txt":
        return spark.read.text(path)
    raise ValueError(f"no reader for {path}")


def read_merged(spark: SparkSession, root: str) -> DataFrame:
    """All Parquet files below ``root``, at any depth, with the union of their columns (SRC3, SRC4)."""
    return spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(root)


def write_text(df: DataFrame, path: str, fmt: str) -> None:
    """CSV with a header, list columns joined by pipes, or JSON lines (SNK6)."""
    if fmt == "csv":
        lists = {f.name: F.array_join(F.col(f.name).cast("array<string>"), "|") for f in df.schema if isinstance(f.dataType, ArrayType)}
        df.withColumns(lists).write.mode("overwrite").option("header", True).csv(path)
    elif fmt in ("json", "jsonl"):
        df.write.mode("overwrite").json(path)
    else:
        raise ValueError(f"no writer for {fmt}")


def append_history(df: DataFrame, history: str, current: str, keys: list[str], at: str, tag: str = "") -> None:
    """Appends ``df`` to a history, and merges it into the table of the latest row of each key (SNK8). Both are tables in versions (``versioned``).

    The history is not read, and of the current table only the buckets of keys in ``df``. With a ``tag``, a table that has it already is left as it is: after a failure between
    the two, the same call again does the second alone.
    """
    spark = df.sparkSession
    done = lambda root: tag and (m := V.manifest(spark, root)) is not None and m.tag == tag
    if not done(history):
        V.append(df, history, keys, tag=tag)
    if not done(current):
        V.upsert(df, current, keys, at=at, tag=tag)
        V.drop_versions(spark, current)


def write_years(df: DataFrame, path: str, ts: str) -> None:
    """A folder for each year of ``ts`` (SNK10)."""
    df.withColumn("year", F.year(ts)).hint("rebalance", F.col("year")).write.mode("overwrite").partitionBy("year").parquet(path)
