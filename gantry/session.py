"""Session helpers shared by queries, tests and the benchmark."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int = 8, shuffle_partitions: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the session the cluster gives."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("gantry")
    settings = SESSION_CONF | {"spark.sql.shuffle.partitions": str(shuffle_partitions), "spark.driver.memory": memory}
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def held(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of the session for what is run or planned inside alone."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


_LOCAL: list[str] = []
_SHARED: set[str] = set()


def _deleted(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of a file system that Spark knows, if the driver's JVM is still there."""
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sparkContext().hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001  the process ends: nothing to be done about a JVM that has gone before
        return


def scratch(spark: SparkSession) -> str:
    """A folder of this application that driver and executors share, deleted when the driver ends: below spark.checkpoint.dir; where it is unset, a temporary one if Spark runs in this process alone."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        folder = f"{where.rstrip('/')}/gantry-{spark.sparkContext.applicationId}"
        if folder not in _SHARED:
            _SHARED.add(folder)
            atexit.register(_deleted, spark, folder)
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="gantry-scratch-"))
        atexit.register(shutil.rmtree, _LOCAL[0], True)
    return f"file://{_LOCAL[0]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table below the scratch folder: for what is read several times and costs more to make than to write."""
    path = f"{scratch(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
