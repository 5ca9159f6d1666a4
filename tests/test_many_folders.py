"""Trees of very many folders: what the driver does once a folder is left out where there is nothing to replace."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameReader, DataFrameWriter

from gantry.sources import incremental as I
from gantry.sources import partitioned as T

SCHEMA = "ts timestamp_ntz, seq long"


@pytest.fixture
def ticks(spark):
    return spark.range(60).select((F.col("id") % 5).alias("ticker"), F.expr("timestamp_ntz'2024-01-20 00:00:00' + make_dt_interval(int(id))").alias("ts"), F.col("id").alias("seq"))


def test_a_new_tree_is_appended(spark, tmp_path, monkeypatch, ticks):
    modes, mode = [], DataFrameWriter.mode
    monkeypatch.setattr(DataFrameWriter, "mode", lambda self, m: (modes.append(m) if m else None, mode(self, m))[1])
    T.write_tree(ticks, f"{tmp_path}/t")
    T.write_tree(ticks.filter("ticker = 1").withColumn("seq", -F.col("seq")), f"{tmp_path}/t")
    assert modes == ["append", "overwrite"]
    got = T.read_tree(spark, f"{tmp_path}/t", SCHEMA).agg(F.count("*"), F.min("seq")).first()
    assert tuple(got) == (60, -56)


def test_a_first_refresh_reads_the_folder(spark, tmp_path, monkeypatch, ticks):
    T.write_tree(ticks, f"{tmp_path}/t")
    reads, parquet = [], DataFrameReader.parquet
    monkeypatch.setattr(DataFrameReader, "parquet", lambda self, *paths, **o: (reads.append(paths), parquet(self, *paths, **o))[1])
    count = lambda f: f.groupBy("path").agg(F.count("*").alias("n"))
    rows, counts = I.refreshed(spark, f"{tmp_path}/t", f"{tmp_path}/c", SCHEMA, count, buckets=2)
    assert rows.agg(F.sum("n")).first()[0] == 60 and counts["new"] > 10
    assert (f"{tmp_path}/t",) in reads and max(map(len, reads)) <= 2
