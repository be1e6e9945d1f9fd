import numpy as np
from pyspark.sql import functions as F

from linefold.llm import topk


def brute(vectors, k):
    out = set()
    for i, (q, v) in enumerate(vectors):
        if q is None or q % 3:
            continue
        scores = sorted((-int(np.dot(v, w)), c is None, c or 0) for j, (c, w) in enumerate(vectors) if j != i and len(w) == len(v))[:k]
        out |= {(q, r, None if none else c, -s) for r, (s, none, c) in enumerate(scores, 1)}
    return out


def test_equals_brute_force_with_ties_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(k, rng.normal(size=6).round(1).tolist()) for k in range(60)]
    rows += [(100 + k, [0.5] * 6) for k in range(20)] + [(None, [0.5] * 6), (200, [0.0] * 6), (201, [1.0, 2.0])]
    fine = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows]
    odd = [(300, None), (303, []), (306, [1.0, None] * 3), (309, [float("nan")] * 6), (312, [float("inf")] * 6)]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>").withColumns({c: F.lit(c) for c in ("row", "id", "v", "rank", "score")})
    for shard, block in ((1000, 1000), (16, 5)):
        got = topk.top_k(df, F.col("id") % 3 == 0, k=5, shard=shard, block=block).collect()
        assert {tuple(r) for r in got} == brute(fine, 5) and len(got) == len({(r["query_id"], r["rank"]) for r in got})


def test_few_candidates_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (3, [2.0])], "vec_id bigint, embedding array<float>")
    assert sorted(map(tuple, topk.top_k(df, F.col("id") % 3 == 0).collect())) == [(0, 1, 3, 131072), (3, 1, 0, 131072)]
    assert topk.top_k(df.filter("vec_id < 0"), F.col("id") % 3 == 0).count() == 0


def test_the_bound_stops_early():
    rng = np.random.default_rng(0)
    x = np.zeros((5000, 2))
    x[:, 0] = rng.permutation(5000)
    order, read = np.argsort(x, axis=0, kind="stable"), []

    class Seen(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray):
                read.append(len(key))
            return np.asarray(super().__getitem__(key))

    best = topk.best_of(np.array([2.0, 0.0]), x.view(Seen), order, -1, 5, np.arange(5000))
    assert x[best, 0].tolist() == [4999, 4998, 4997, 4996, 4995] and max(read) <= 16
