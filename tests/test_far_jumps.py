from pyspark.sql import functions as F

from gantry.functions import exprs as X

FACTORS = [1.0, 1.5, 2.0, 3.0, 11.0]


def test_of_factors_as_near_the_smallest_counts(spark):
    """From 1e17 on, all factors are as far as each other in floating-point numbers; the SQL takes the first."""
    xs = [0.5, 1.25, 1.3, 2.5, 2.6, 7.0, 12.0, 1e17, 1e300, float("inf"), float("-inf")]
    df = spark.createDataFrame([(x,) for x in xs], "x double").withColumn("f", F.array(*map(F.lit, FACTORS)))
    got = {r["x"]: r["near"] for r in df.select("x", X.nearest_of(F.col("f"), F.col("x")).alias("near")).collect()}
    assert got == {x: min(FACTORS, key=lambda f: (abs(x - f), f)) for x in xs}
    odd = spark.sql("SELECT array(1D, 2D) AS f, double('nan') AS x UNION ALL SELECT array(1D, 2D), NULL UNION ALL SELECT CAST(array() AS array<double>), 1D")
    assert [r[0] for r in odd.select(X.nearest_of(F.col("f"), F.col("x"))).collect()] == [1.0, None, None]
