"""Centroid clustering with Hamerly's bounds, in exact integers.

Each vector keeps two bounds over the rounds: one above its distance to its own centroid and one below its distance to the nearest other one. When centroids move, the first
grows by the drift of the vector's centroid and the second shrinks by the greatest drift of the others. While the first is less than the second, or than half the way from its
centroid to the next, the vector stays where it is unread; else its own distance is made exact, and if that doesn't settle it, it is measured against all centroids. Bounds
are doubles rounded outwards, distances and centroids are integers, so the result is that of a full search in each round, ties included.

The table of vectors with their bounds is written once a round and takes the place of the one before. Only vectors that change their cluster are summed: they
are added to the one and taken from the other. To the driver go k rows of sums; tasks get the centroids and their drifts, k rows as well, where k is a parameter.

Cases: a vector that is null, of another length than ``dims``, or with a component that is null or not finite is left out; a null id is kept and clustered, but no first centroid; repeated
rows count each, and as first centroids too, in the order of their components; with fewer than k vectors with an id, these are the first centroids, and with none, clusters are null;
ties of distance go to the smaller number; an empty table gives an empty result; other columns pass through, and where they clash with cluster, distance and those that ``summary`` adds,
these take their place. A component beyond +-2**27 after scaling raises an error, as squared distances must fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gantry.llm.shared import drop_written, private, written

MOST = 1 << 27
#: Components up to here have sums of products below 2**53, exact in doubles whatever their order, for up to 128 dimensions.
EXACT = 1 << 22
#: Outward rounding of a bound: far above the error of the few operations that make it.
UP, DOWN = 1 + 1e-12, 1 - 1e-12
ROWS = 8192


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of each row of ``x`` to each of ``c``, exact."""
    if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) <= EXACT and x.shape[1] <= 128:
        inner = (x.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
        return (x * x).sum(1)[:, None] - 2 * inner + (c * c).sum(1)[None, :]
    return np.stack([((x - one) ** 2).sum(1) for one in c], 1)


def own_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((x - c) ** 2).sum(1)


def halves(c: np.ndarray) -> np.ndarray:
    """Half the distance of each centroid to the nearest other one, rounded down."""
    d = distances(c, c).astype(np.float64)
    np.fill_diagonal(d, np.inf)
    return np.sqrt(d.min(1)) * (0.5 * DOWN)


def scan(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid, and the bounds on the distance to it and to the second, from all distances."""
    d = distances(x, c)
    at = d.argmin(1)  # the first of equals
    rows = np.arange(len(x))
    first = d[rows, at].astype(np.float64)
    d[rows, at] = np.iinfo(np.int64).max
    second = d.min(1).astype(np.float64)
    return at, np.sqrt(first) * UP, np.sqrt(second) * DOWN


def step(x: np.ndarray, at: np.ndarray, up: np.ndarray, low: np.ndarray, c: np.ndarray, drift: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Clusters and bounds after the centroids have drifted to ``c``."""
    most = int(drift.argmax())
    others = np.where(at == most, np.delete(drift, most).max(initial=0.0), drift[most])
    up, low = (up + drift[at]) * UP, np.maximum((low - others) * DOWN, 0.0)
    least = np.maximum(low, halves(c)[at])
    open_ = np.flatnonzero(up >= least)
    up[open_] = np.sqrt(own_distances(x[open_], c[at[open_]]).astype(np.float64)) * UP
    open_ = open_[up[open_] >= least[open_]]
    if len(open_):
        at = at.copy()
        at[open_], up[open_], low[open_] = scan(x[open_], c)
    return at, up, low


def passed(centroids: np.ndarray, drift: np.ndarray | None, dims: int, names: dict[str, str], keep: list[str]):
    """The function of a pass over the table: with ``drift`` from the bounds that are there, without it from all distances."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, ROWS):
                batch = whole.slice(a, ROWS)
                column = lambda n: batch.column(names[n])  # noqa: E731, B023
                x = column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dims)
                if len(x) and max(-int(x.min()), int(x.max())) > MOST:
                    raise ValueError(f"a component lies beyond +-{MOST} after scaling: squared distances wouldn't fit a long")
                if drift is None:
                    was = np.full(len(x), -1)
                    at, up, low = scan(x, centroids)
                else:
                    was = column("at").to_numpy().astype(np.int64)
                    at, up, low = step(x, was, column("up").to_numpy().copy(), column("low").to_numpy(), centroids, drift)
                made = {"at": pa.array(at, pa.int32()), "was": pa.array(was, pa.int32()), "up": pa.array(up), "low": pa.array(low), "d": pa.array(own_distances(x, centroids[at]))}
                yield pa.RecordBatch.from_arrays([*map(batch.column, keep), column("x"), *made.values()], names=[*keep, names["x"], *(names[n] for n in made)])

    return run


def integers(vector: str, scale: int) -> Column:
    return F.transform(vector, lambda v: F.floor(F.lit(float(scale)) * v.cast("double")))


def usable(vector: str, dims: int) -> Column:
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    return F.coalesce((F.size(vector) == dims) & ~bad, F.lit(False))


def first_centroids(df: DataFrame, ident: str, x: str, k: int, salt: str) -> np.ndarray:
    """The k vectors whose ids have the least hashes."""
    key = F.sha2(F.concat(F.lit(salt), F.col(ident).cast("string")), 256)
    rows = df.select(key.alias("h"), F.col(x).alias("x")).filter("h IS NOT NULL").orderBy("h", "x").limit(k).collect()
    return np.array([r["x"] for r in rows], np.int64)


def moved_sums(state: DataFrame, names: dict[str, str], k: int, dims: int) -> np.ndarray:
    """For each cluster what has come less what has gone: the sum of each component and, last, the count. A task shuffles k * (dims + 1) numbers at most."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 1), np.int64)
        for batch in batches:
            at, was = (batch.column(i).to_numpy() for i in (0, 1))
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dims)
            x = np.concatenate([x, np.ones((len(x), 1), np.int64)], 1)
            np.add.at(total, at, x)
            old = was >= 0
            np.subtract.at(total, was[old], x[old])
        c, i = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(i, pa.int32()), pa.array(total[c, i])], names=["c", "i", "s"])

    out = np.zeros((k, dims + 1), object)
    moved = state.filter(F.col(names["at"]) != F.col(names["was"])).select(*[names[n] for n in ("at", "was", "x")])
    for r in moved.mapInArrow(summed, "c int, i int, s bigint").groupBy("c", "i").agg(F.sum("s").alias("s")).collect():
        out[r["c"], r["i"]] = r["s"]
    return out


def clustered(df: DataFrame, k: int, rounds: int, dims: int, scale: int = 256, salt: str = "", ident: str = "vec_id", vector: str = "embedding", keep: list[str] | None = None) -> tuple[DataFrame, np.ndarray]:
    """Usable rows of ``df`` (or their columns ``keep``) with ``cluster`` and ``distance`` (squared, of scaled integers) after ``rounds`` rounds and a last assignment; and the centroids.

    A written table is behind the first.
    """
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in ("cluster", "distance")]
    names = dict(zip(("x", "at", "was", "up", "low", "d"), private(df, "_x", "_at", "_was", "_up", "_low", "_d")))
    table = df.filter(usable(vector, dims)).withColumn(names["x"], integers(vector, scale)).select(*keep, names["x"])
    centroids = first_centroids(df.filter(usable(vector, dims)).withColumn(names["x"], integers(vector, scale)), ident, names["x"], k, salt)
    if not len(centroids):
        return table.select(*keep, F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance")), centroids
    kinds = {"x": T.ArrayType(T.LongType()), "at": T.IntegerType(), "was": T.IntegerType(), "up": T.DoubleType(), "low": T.DoubleType(), "d": T.LongType()}
    schema = T.StructType([*[table.schema[c] for c in keep], *[T.StructField(names[n], kind) for n, kind in kinds.items()]])
    sums = np.zeros((len(centroids), dims + 1), object)
    drift, state = None, table
    for i in range(rounds + 1):
        before, state = state, written(state.mapInArrow(passed(centroids, drift, dims, names, keep), schema), "clustered")
        if i:
            drop_written(before)
        if i < rounds:
            sums += moved_sums(state, names, len(centroids), dims)
            new = np.array([[s // row[-1] for s in row[:-1]] if row[-1] else old for row, old in zip(sums.tolist(), centroids.tolist())], np.int64)
            drift = np.sqrt(own_distances(new, centroids).astype(np.float64)) * UP
            centroids = new
    out = state.select(*keep, F.col(names["at"]).alias("cluster"), F.col(names["d"]).alias("distance"))
    return out, centroids


def summary(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with cluster_inertia, inertia and centroid_sha256: one row a cluster is joined to it."""
    spark = assigned.sparkSession
    own = ("cluster_inertia", "inertia", "centroid_sha256")
    sums = {r["cluster"]: int(r["s"]) for r in assigned.filter("cluster IS NOT NULL").groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    total = sum(sums.values())
    digest = lambda c: hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()
    schema = "_c int, cluster_inertia long, inertia long, centroid_sha256 string"
    table = spark.createDataFrame([(c, s, total, digest(c)) for c, s in sums.items()], schema)
    assigned = assigned.drop(*[c for c in assigned.columns if c.lower() in own])
    return assigned.join(F.broadcast(table), assigned["cluster"] == table["_c"], "left").drop("_c")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return summary(*clustered(vectors, k=40, rounds=5, dims=64, scale=256, salt="2:", keep=["vec_id"]))


def _sql(k: int = 40, rounds: int = 5) -> str:
    hashed = "sha256('2:' || vec_id)"
    parts = [
        "kept AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        "e AS MATERIALIZED (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM kept)",
        f"c0 AS MATERIALIZED (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM (SELECT row_number() OVER (ORDER BY {hashed}) - 1 AS c, v FROM kept QUALIFY c < {k}))",
    ]
    for r in range(rounds + 1):
        parts.append(f"a{r} AS MATERIALIZED (SELECT vec_id, min_by(c, (d, c)) AS c, min(d) AS d FROM (SELECT vec_id, c, CAST(sum((e.x - o.x) * (e.x - o.x)) AS BIGINT) AS d FROM e JOIN c{r} o USING (i) GROUP BY 1, 2) GROUP BY 1)")
        if r < rounds:
            parts.append(
                f"s{r} AS MATERIALIZED (SELECT c, i, sum(x) AS s, count(*) AS n FROM e JOIN a{r} USING (vec_id) GROUP BY 1, 2), "
                f"c{r + 1} AS MATERIALIZED (SELECT o.c, o.i, CASE WHEN n > 0 THEN CAST((s - ((s % n) + n) % n) // n AS BIGINT) ELSE o.x END AS x FROM c{r} o LEFT JOIN s{r} USING (c, i))"
            )
    return (
        f"WITH {', '.join(parts)}, g AS (SELECT c, CAST(sum(d) AS BIGINT) AS s FROM a{rounds} GROUP BY 1), h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS sha FROM c{rounds} GROUP BY 1) "
        f"SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, s AS cluster_inertia, (SELECT CAST(sum(d) AS BIGINT) FROM a{rounds}) AS inertia, sha AS centroid_sha256 FROM a{rounds} JOIN g USING (c) JOIN h USING (c)"
    )


OP11_SQL = _sql()
