"""Exact top-k inner products by Fagin's threshold algorithm.

Vectors become integer vectors, floor(scale * x), so scores are exact. The
candidates are dealt into shards and the queries into blocks, both of bounded
size and by row number, and each (block, shard) cell runs the threshold
algorithm: the shard keeps one sorted list per dimension; for a query, all
lists are read in step from the end that its component's sign favours, rows
met for the first time are scored in full, and reading stops when the bound
(the best score that a row not yet met can have, from the list values at the
current depth) is below the query's kth score. A bound equal to the kth score
does not stop it: an unmet row might tie and have the smaller id. Depths
double, so a query costs few passes. Reading ends early for one more reason
only: no row is unmet. The best k of each cell are merged per query; that is exact, as each
cell's are.

Nulls and edge cases: vectors that are null, empty or hold a null or
non-finite component take no part, as query or candidate; vectors only meet
those of their own dimension; a null id is a candidate, last among ties, and
never a query; repeated rows are rows of their own, and each query row gives
its own result; fewer than k candidates give fewer results. Scores are 64-bit
integers. Only the id and vector columns are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linefold.llm.common import written

SHARD = 16_384
BLOCK = 4_096
FIRST_DEPTH = 8


def whole_vectors(rows: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """(row, id, v array<bigint>, dim) of the vectors that take part."""
    x = F.transform(vector, lambda c: c.cast("double"))
    fine = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (rows.select(F.col(vec_id).alias("id"), x.alias("x")).filter((F.size("x") > 0) & fine)
            .select(F.monotonically_increasing_id().alias("row"), "id",
                    F.transform("x", lambda c: F.floor(F.lit(float(scale)) * c)).alias("v"), F.size("x").alias("dim")))


def best_of(q: np.ndarray, x: np.ndarray, order: np.ndarray, banned: int, k: int, ties: np.ndarray) -> np.ndarray:
    """Rows of ``x`` with the k best scores for ``q``, best first.

    order: per dimension, the rows of ``x`` by rising value. banned: a row
    that is not a candidate, or -1. ties: ranks of the rows' ids.
    """
    n, d = x.shape
    seen = np.zeros(n, bool)
    used = np.flatnonzero(q)
    up = q[used] > 0
    rows, scores = np.zeros(0, np.int64), np.zeros(0, x.dtype)
    depth, at = FIRST_DEPTH, 0
    while True:
        depth = min(depth, n)
        met = np.zeros(n, bool)
        met[order[n - depth:n - at, used[up]]] = True
        met[order[at:depth, used[~up]]] = True
        if not len(used):
            met[:] = True  # a query of zeros: all scores are equal
        new = np.flatnonzero(met & ~seen)
        seen[new] = True
        if banned >= 0:
            new = new[new != banned]
        rows, scores = np.append(rows, new), np.append(scores, x[new] @ q)
        if len(rows) > k:
            # all rows that tie with the kth stay until ids decide
            kth = np.partition(scores, len(scores) - k)[len(scores) - k]
            rows, scores = rows[scores >= kth], scores[scores >= kth]
            best = np.lexsort((ties[rows], -scores))[:k]
            rows, scores = rows[best], scores[best]
        if seen.all():
            return rows[np.lexsort((ties[rows], -scores))]
        if len(rows) == k:
            edge = np.where(up, x[order[n - depth, used], used], x[order[depth - 1, used], used])
            if (q[used] * edge).sum() < scores.min():
                return rows[np.lexsort((ties[rows], -scores))]
        at, depth = depth, 2 * depth


def search_cell(cell: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best candidates of one cell for each of its queries."""
    queries, cands = cell[cell["is_query"]], cell[~cell["is_query"]]
    out: list[tuple] = []
    if len(queries) and len(cands):
        x, qs = np.stack(cands["v"].to_list()), np.stack(queries["v"].to_list())
        if float(np.abs(x).max()) * float(np.abs(qs).max()) * x.shape[1] < 2.0 ** 53:
            x, qs = x.astype(np.float64), qs.astype(np.float64)  # still exact, and faster
        order = np.argsort(x, axis=0, kind="stable")
        row, ids = cands["row"].to_numpy(), cands["id"]
        ties = ids.rank(method="first", na_option="bottom").to_numpy()
        place = {r: i for i, r in enumerate(row)}
        ids = [None if pd.isna(i) else int(i) for i in ids]
        for own, qid, q in zip(queries["row"], queries["id"], qs):
            for r in best_of(q, x, order, place.get(own, -1), k, ties):
                out.append((own, int(qid), ids[r], int(x[r] @ q)))
    return pd.DataFrame({c: pd.array([o[i] for o in out], dtype="Int64") for i, c in enumerate(("own", "query_id", "vec_id", "score"))})


def top_k(rows: DataFrame, is_query: Column, k: int = 5, scale: int = 256, vec_id: str = "vec_id", vector: str = "embedding",
          shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``rows`` where
    ``is_query`` (a condition on the column ``id``), its k best other rows."""
    vectors = written(whole_vectors(rows, vec_id, vector, scale), "vectors")
    queries = vectors.filter(F.col("id").isNotNull() & is_query)
    n, n_queries = vectors.count(), queries.count()
    shards, blocks = -(-n // shard) or 1, -(-n_queries // block) or 1
    numbers = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    deal = lambda m: F.pmod(F.xxhash64("row"), F.lit(m)).cast("int")
    cells = (queries.select("*", F.lit(True).alias("is_query"), deal(blocks).alias("block"), numbers(shards).alias("shard"))
             .unionByName(vectors.select("*", F.lit(False).alias("is_query"), numbers(blocks).alias("block"), deal(shards).alias("shard"))))
    found = cells.groupBy("dim", "block", "shard").applyInPandas(
        lambda cell: search_cell(cell, k), "own bigint, query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("own").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


__all__ = ["whole_vectors", "best_of", "search_cell", "top_k"]
