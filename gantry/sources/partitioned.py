"""Trees of files by ticker, year and month: reading with pruning, writing, and an inventory of the files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gantry.session import held

LAYOUT = ("ticker", "year", "month")


def _tasks(spark: SparkSession) -> int:
    """Tasks for work that costs by the folder: some for each core."""
    return 4 * spark.sparkContext.defaultParallelism


def listed(spark: SparkSession):
    """Folders of what is read inside are listed by some tasks for each core; Spark's own way is a task a folder, up to 10000."""
    return held(spark, {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(_tasks(spark))})


def read_tree(spark: SparkSession, root: str, schema: StructType | str, layout: tuple[str, ...] = LAYOUT) -> DataFrame:
    """The files under ``root``; filters on the layout's columns prune folders. The schema is given, so no file is opened for it."""
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    for name in layout:
        if name not in fields.names:
            fields = StructType([*fields.fields]).add(name, "string" if name == "ticker" else "integer")
    with listed(spark):
        return spark.read.schema(fields).parquet(root)


def _put(rows: DataFrame, root: str, mode: str, layout: tuple[str, ...] = LAYOUT) -> None:
    """Writes rows into the layout's folders. A folder costs far more than its bytes, so tasks are dealt out by cores and not put together by size; one with very many rows is still split."""
    spark = rows.sparkSession
    dealt = rows.hint("rebalance", max(_tasks(spark), int(spark.conf.get("spark.sql.shuffle.partitions"))), *[F.col(c) for c in layout])
    with held(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        dealt.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*layout).parquet(root)


def _dated(df: DataFrame, ts: str, key: str) -> DataFrame:
    return df.withColumns({"ticker": F.col(key).cast("string"), "year": F.year(ts), "month": F.month(ts)})


def write_tree(df: DataFrame, root: str, ts: str = "ts", key: str = "ticker", layout: tuple[str, ...] = LAYOUT) -> None:
    """Writes ``df`` by ticker, year and month of ``ts``: only the folders it has rows for are replaced (SNK2, SNK3).

    Rebalancing by those columns keeps files few and splits a ticker that holds very many rows. Spark's commit
    protocol makes files visible at the end of the job (SNK4). Where there is no tree yet there is nothing to replace,
    and rows are appended: replacing costs the driver some calls a folder, one after the other.
    """
    _put(_dated(df, ts, key), root, "overwrite" if exists(df.sparkSession, root) else "append", layout)


def upsert_tree(changes: DataFrame, root: str, keys: list[str], schema: StructType | str, ts: str = "ts", key: str = "ticker", prune: bool = False) -> None:
    """Rows of ``changes`` take the place of those of the same keys in the folders they fall into; other rows and folders stay (SNK5).

    Names of the folders that ``changes`` falls into are broadcast; where it is a filter's result, Spark reads these folders alone.
    The new folders are built as a table beside the tree first, as a folder can't be read and replaced in one job. Folders are replaced one after the other at the end: where readers
    must see all or nothing, keep the rows as a table in versions (``versioned``).
    With ``prune``, folders of the tickers in ``changes`` that it has no rows for are removed.
    """
    spark = changes.sparkSession
    dated = _dated(changes, ts, key)
    touched = dated.select(*LAYOUT).distinct()
    old = read_tree(spark, root, schema).withColumn("ticker", F.col("ticker").cast("string"))
    stay = old.join(F.broadcast(touched), list(LAYOUT), "left_semi").join(dated.select(*keys).distinct(), keys, "left_anti")
    gone = []
    if prune:  # names of folders, before they change
        folders = old.select(*LAYOUT).distinct().join(touched.select("ticker").distinct(), "ticker", "left_semi")
        gone = folders.join(touched, list(LAYOUT), "left_anti").collect()
    stage = f"{root.rstrip('/')}_stage_{uuid.uuid4().hex}"
    stay.unionByName(dated.select(*stay.columns)).write.parquet(stage)
    _put(spark.read.parquet(stage), root, "overwrite")
    for r in gone:
        remove(spark, f"{root.rstrip('/')}/ticker={r['ticker']}/year={r['year']}/month={r['month']}")
    remove(spark, stage)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of that name, in any file system that Spark knows."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder of any file system that Spark knows."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """path, size, modified, ticker, year and month of each Parquet file, without reading its content (SRC10, SRC12)."""
    with listed(spark):
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    part = lambda k: F.nullif(F.regexp_extract("path", f"{k}=([^/]+)", 1), F.lit(""))
    return found.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), part("ticker").alias("ticker"), part("year").cast("int").alias("year"), part("month").cast("int").alias("month"))


def signatures(spark: SparkSession, path: str) -> DataFrame:
    """name, size and signature (size and time of the last change) of the files under ``path`` (SC40)."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return f.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), F.concat_ws("_", "length", F.unix_millis("modificationTime")).alias("signature"))


def content_hashes(spark: SparkSession, path: str) -> DataFrame:
    """path and sha256 of the files under ``path`` (SNK11). A file is one binary value: files of 2 GB and more fail."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return f.select("path", F.sha2("content", 256).alias("sha256"))
