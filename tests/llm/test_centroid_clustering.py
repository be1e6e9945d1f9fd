import hashlib
import random

import pytest
from pyspark.sql import functions as F

from linefold.llm import centroid_clustering as C

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def plain(rows, k, rounds, dims, scale, seed):
    """(id, cluster, distance) per usable row and the centroids, by integers of Python."""
    def ok(v):
        return v is not None and len(v) == dims and all(x is not None and x == x and abs(x) != float("inf") for x in v)

    def whole(x):
        return max(-2 ** 62, min(2 ** 62, int(x * scale // 1)))

    kept = [(i, [whole(x) for x in v]) for i, v in rows if ok(v)]
    first = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in first[:k]]
    if not centroids:
        return [], [], centroids

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        own = [[] for _ in centroids]
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(vs) for x in zip(*vs)] if vs else c for vs, c in zip(own, centroids)]
    return kept, [nearest(v) for _, v in kept], centroids


def check(spark, rows, k=3, rounds=4, dims=4, scale=16, seed=3):
    kept, near, centroids = plain(rows, k, rounds, dims, scale, seed)
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)
    got = C.cluster(df, k, rounds, dims, scale, seed)
    top = 2 ** 63 - 1
    inertia = [min(top, sum(min(d, top) for d, n in near if n == c)) for c in range(len(centroids))]
    want = [(i, n, min(d, top), inertia[n], min(top, sum(min(d, top) for d, _ in near)), centroids[n]) for (i, _), (d, n) in zip(kept, near)]
    found = [(r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], [int(x) for x in r["centroid"]]) for r in got.collect()]
    assert sorted(found, key=str) == sorted(want, key=str)
    return found


def test_equals_brute_force(spark):
    r = random.Random(5)
    rows = [(k, [r.gauss(k % 3, 0.4) for _ in range(4)]) for k in range(300)]
    rows += [(k, rows[7][1]) for k in range(400, 440)] + [(7, rows[7][1])] * 3
    assert len(check(spark, rows)) == 343


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(1, None), (2, []), (3, [1.0, 2.0, 3.0]), (4, [1.0, None, 2.0, 3.0]), (5, [nan, 0.0, 0.0, 0.0]), (6, [0.0, inf, 0.0, 0.0]), (7, [1.0] * 5)]
    assert check(spark, odd) == []
    assert check(spark, []) == []
    assert check(spark, [(None, [1.0] * 4)]) == []
    assert len(check(spark, [*odd, (8, [0.5] * 4), (8, [0.25] * 4), (None, [3.0] * 4)])) == 3  # fewer than k, one id twice
    assert len(check(spark, [(k, [0.0, -0.01, 0.0, 0.0]) for k in range(20)])) == 20  # ties: all in cluster 0, empty centroids stay


@pytest.mark.parametrize("far", [1e6, 1e9, 1e17, 1e300])
def test_far_components_stay_exact(spark, far):
    r = random.Random(6)
    rows = [(k, [r.choice([-far, far, 1.0]) * r.random() for _ in range(4)]) for k in range(40)]
    check(spark, rows)


def test_other_columns_and_types(spark):
    df = spark.createDataFrame([(str(k), [float(k), 0.0], "x") for k in range(9)], "name string, v array<float>, cluster string")
    df = df.withColumns({c: F.lit("y") for c in ("id", "vec", "values", "distance", "h")})
    got = C.cluster(df, k=2, rounds=2, dims=2, scale=1, vec_id="name", vec="v")
    assert got.count() == 9 and got.schema["name"].dataType.simpleString() == "string"


def test_digest(spark):
    row = spark.createDataFrame([([1, -2, 30],)], "c array<bigint>").select(C.centroid_digest(F.col("c")).alias("h")).first()
    assert row["h"] == hashlib.sha256(b"1,-2,30").hexdigest()
