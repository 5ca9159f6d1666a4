"""Row numbers are those of the order, whatever the sample that the ranges were cut by."""

from pyspark.sql import functions as F

from gantry.operators import pieces as P


def test_numbers_of_a_table_larger_than_the_sample(spark, tmp_path):
    n = 60_000
    spark.range(n, numPartitions=6).select((F.col("id") * 7919 % n).alias("k"), F.concat(F.lit("name "), "id").alias("name")).write.parquet(f"{tmp_path}/t")
    got = P.numbered(spark.read.parquet(f"{tmp_path}/t"), [F.desc("k")], "row").select("row", "name").collect()
    assert sorted((int(r["name"][5:]) * 7919 % n, r["row"]) for r in got) == [(k, n - 1 - k) for k in range(n)]
