"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gantry.llm.shared import drop_written, written


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
    return moved.select("e.u", "e.v").filter("u <> v").distinct()


def components(links: DataFrame, rounds: int = 40) -> DataFrame:
    """u, v: each linked node u that isn't its component's least node, with that node v.

    ``links`` has columns u and v of one orderable type. Each round halves the depth of the forest at least; every
    round is written to the shared folder, and only counts and sums come to the driver. An empty table gives none.
    """
    edges = written(links.filter("u <> v").select("u", "v").distinct(), "links")
    before = None
    for _ in range(rounds):
        stars = written(_small(_large(edges)), "stars")
        drop_written(edges)
        edges = stars
        state = stars.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            return edges
        before = state
    raise RuntimeError(f"no fixed point in {rounds} rounds")
