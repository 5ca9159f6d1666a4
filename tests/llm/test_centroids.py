import hashlib
import math
import random

import numpy as np
import pytest

from gantry.llm import centroids as C

DIMS = 64


def brute(rows, k, rounds):
    """All distances in each round: row number to (cluster, distance), and the centroids."""
    kept = {i: [math.floor(256 * x) for x in v] for i, (_, v) in enumerate(rows) if v is not None and len(v) == DIMS and all(x is not None and math.isfinite(x) for x in v)}
    order = sorted((hashlib.sha256(f"2:{rows[i][0]}".encode()).hexdigest(), v) for i, v in kept.items() if rows[i][0] is not None)
    cs = [v for _, v in order[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cs))
    for _ in range(rounds):
        groups = {}
        for v in kept.values():
            groups.setdefault(nearest(v)[1], []).append(v)
        cs = [[sum(col) // len(groups[j]) for col in zip(*groups[j])] if j in groups else c for j, c in enumerate(cs)]
    return [(rows[i][0], *nearest(v)[::-1]) for i, v in kept.items()], cs


def vectors(n, seed, clusters=5, grid=None):
    r = random.Random(seed)
    middles = [[r.uniform(-3, 3) for _ in range(DIMS)] for _ in range(clusters)]
    out = []
    for i in range(n):
        v = [m + r.gauss(0, 0.7) for m in r.choice(middles)]
        out.append((i, [round(x * grid) / grid for x in v] if grid else v))
    return out


def run(spark, rows, k, rounds):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    out, cs = C.clustered(df, k=k, rounds=rounds, dims=DIMS, salt="2:", keep=["vec_id"])
    return out, cs


@pytest.mark.parametrize("k, rounds, grid", [(7, 6, None), (12, 5, 1), (1, 2, None)])
def test_bounds_give_what_all_distances_give(spark, k, rounds, grid):
    rows = vectors(150, k, grid=grid)
    rows += [(1000 + i, v) for i, (_, v) in enumerate(rows[:20])]  # equal vectors
    out, cs = run(spark, rows, k, rounds)
    want, centers = brute(rows, k, rounds)
    assert sorted(map(tuple, out.collect())) == sorted(want)
    assert cs.tolist() == centers


def test_odd_rows(spark):
    rows = vectors(30, 3)
    odd = [(None, rows[0][1]), (50, None), (51, []), (52, rows[1][1][:63]), (53, [*rows[1][1], 1.0]), (54, [None, *rows[1][1][1:]]), (55, [math.nan, *rows[1][1][1:]]), (56, [math.inf, *rows[1][1][1:]]), rows[2], rows[2], (None, None)]
    out, cs = run(spark, rows + odd, 6, 3)
    want, centers = brute(rows + odd, 6, 3)
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(map(tuple, out.collect()), key=key) == sorted(want, key=key)
    assert cs.tolist() == centers


def test_few_rows_and_none(spark):
    rows = vectors(3, 4)
    out, cs = run(spark, rows, 40, 5)
    assert sorted(map(tuple, out.collect())) == sorted(brute(rows, 40, 5)[0])
    assert len(cs) == 3
    assert C.summary(*run(spark, [], 40, 5)).count() == 0
    only_null = C.summary(*run(spark, [(None, rows[0][1])], 40, 5)).first()
    assert only_null["cluster"] is None and only_null["inertia"] is None


def test_clashing_columns(spark):
    rows = vectors(20, 5)
    df = spark.createDataFrame([(i, v, "a", 1, "b", i % 3) for i, v in rows], "vec_id long, embedding array<double>, cluster string, Distance int, _x string, inertia int")
    out = C.summary(*C.clustered(df, k=4, rounds=3, dims=DIMS, salt="2:"))
    assert sorted(out.columns) == sorted(["vec_id", "embedding", "_x", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])
    want = {i: (c, d) for i, c, d in brute(rows, 4, 3)[0]}
    assert {r["vec_id"]: (r["cluster"], r["distance"]) for r in out.collect()} == want
    assert {r["inertia"] for r in out.collect()} == {sum(d for _, d in want.values())}


def test_large_components(spark):
    big = [[(-1) ** (i + j) * (3.0e5 + i) for j in range(DIMS)] for i in range(6)]
    rows = list(enumerate(big))
    out, _ = run(spark, rows, 3, 3)
    assert sorted(map(tuple, out.collect())) == sorted(brute(rows, 3, 3)[0])
    with pytest.raises(Exception, match="wouldn't fit a long"):
        run(spark, [(0, [1e9] * DIMS)], 1, 1)


def test_most_vectors_are_not_scanned():
    """After small drifts the bounds decide nearly all."""
    r = np.random.default_rng(1)
    c = r.integers(-500, 500, (40, DIMS))
    x = np.concatenate([one + r.integers(-60, 60, (50, DIMS)) for one in c])
    at, up, low = C.scan(x, c)
    moved = c + r.integers(-3, 4, c.shape)
    drift = np.sqrt(((moved - c) ** 2).sum(1)) * C.UP
    read = []
    whole, C.scan = C.scan, lambda a, b: (read.append(len(a)), whole(a, b))[1]
    try:
        got = C.step(x, at, up.copy(), low, moved, drift)[0]
    finally:
        C.scan = whole
    assert got.tolist() == C.distances(x, moved).argmin(1).tolist()
    assert sum(read) < len(x) / 10
