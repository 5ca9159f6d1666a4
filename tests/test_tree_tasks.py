"""Work that costs by the folder is dealt out by cores: writing, and listing."""

from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameReader

from gantry.session import held
from gantry.sources import incremental as I
from gantry.sources import partitioned as T

SCHEMA = "ts timestamp_ntz, seq long"
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def test_a_small_tree_of_many_folders_is_written_by_many_tasks(spark, tmp_path):
    root = f"{tmp_path}/t"
    df = spark.range(400).select((F.col("id") % 80).alias("ticker"), F.lit("2024-01-20").cast("timestamp_ntz").alias("ts"), F.col("id").alias("seq"))
    T.write_tree(df, root)
    T.upsert_tree(df.filter("ticker % 2 = 0").withColumn("ts", F.expr("ts + interval 1 hour")), root, ["seq"], SCHEMA)
    files = T.inventory(spark, root).select("ticker", F.regexp_extract("path", r"part-(\d+)", 1).alias("task")).collect()
    assert len(files) == 80
    for touched in (0, 1):
        assert len({r["task"] for r in files if int(r["ticker"]) % 2 == touched}) >= 4
    got = T.read_tree(spark, root, SCHEMA).groupBy(F.hour("ts").alias("h")).agg(F.count("*").alias("n"), F.countDistinct("seq").alias("k")).orderBy("h").collect()
    assert [tuple(r) for r in got] == [(0, 200, 200), (1, 200, 200)]


def test_settings_are_those_of_before_again(spark):
    before = spark.conf.get(LISTING)
    with T.listed(spark):
        assert int(spark.conf.get(LISTING)) == 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(LISTING) == before
    try:
        with held(spark, {"spark.gantry.none": "1"}):
            raise ValueError
    except ValueError:
        assert spark.conf.get("spark.gantry.none", None) is None


def test_a_refresh_lists_by_cores(spark, tmp_path, monkeypatch):
    root, seen = f"{tmp_path}/t", []
    T.write_tree(spark.range(40).select((F.col("id") % 8).alias("ticker"), F.lit("2024-01-20").cast("timestamp_ntz").alias("ts"), F.col("id").alias("seq")), root)
    noted = lambda f: lambda self, *paths, **o: (seen.append(spark.conf.get(LISTING)) if any(str(p).startswith((root, f"file:{root}", f"file://{root}")) for p in paths) else None, f(self, *paths, **o))[1]
    monkeypatch.setattr(DataFrameReader, "parquet", noted(DataFrameReader.parquet))
    monkeypatch.setattr(DataFrameReader, "load", noted(DataFrameReader.load))
    count = lambda f: f.groupBy("path").agg(F.count("*").alias("n"))
    I.refreshed(spark, root, f"{tmp_path}/c", SCHEMA, count, buckets=2)
    T.write_tree(spark.range(100, 103).select(F.lit(1).alias("ticker"), F.lit("2024-01-20").cast("timestamp_ntz").alias("ts"), F.col("id").alias("seq")), root)
    rows, counts = I.refreshed(spark, root, f"{tmp_path}/c", SCHEMA, count, buckets=2)
    assert rows.agg(F.sum("n")).first()[0] == 38 and counts["same"] == 7
    assert len(seen) >= 4 and set(seen) == {str(4 * spark.sparkContext.defaultParallelism)}
