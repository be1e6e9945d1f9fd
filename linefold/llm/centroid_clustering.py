"""Lloyd's clustering of integer vectors with scalar lookup tables.

A vector's components x become integers floor(scale * x). Vectors are packed
once into blocks of up to ``BLOCK``, written: per dimension the integers that
occur in the block, ascending, and per vector a 16-bit code into them. A round
tabulates, for each dimension, occurring integer and centroid, the squared
difference, and a vector's distance to a centroid is a gather of its codes in
that table and a sum. Each task adds up its vectors per centroid; Spark adds
the tasks' sums (as decimals) and the driver gets ``k`` rows of sums, whatever
the input. All arithmetic is on integers, so neither the number nor the order
of tasks can change a result. A round is one narrow job over the written
blocks plus an aggregate of k x dimensions sums.

Nulls and edge cases: vectors that are null, of another size or that hold a
null or non-finite component are left out. Rows with a null id are clustered
but never chosen as a first centroid. With fewer than ``k`` rows to choose
from there are that many centroids; with none, no rows. Repeated rows each
count; among rows of equal hash the smaller vector is chosen first. Scaled
components beyond +-2**62 count as that; distances and sums of distances
beyond a long are given as the largest long (comparisons are exact even
then). Only the id and vector columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linefold.llm.common import written

BLOCK = 4096          # vectors; codes have 16 bits
LONG = 2 ** 63 - 1
EDGE = 2.0 ** 62
PLAIN = 2 ** 26       # squared differences of such integers add up within a long
SUM = T.DecimalType(38, 0)


def usable(vec: Column, dims: int) -> Column:
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce((F.size(vec) == dims) & ~bad, F.lit(False))


def scaled(x: np.ndarray, scale: int) -> np.ndarray:
    return np.clip(np.floor(scale * x), -EDGE, EDGE).astype(np.int64)


class Block(NamedTuple):
    values: np.ndarray  # the integers of dimension 0, of dimension 1, ...
    sizes: np.ndarray   # how many of each
    codes: np.ndarray   # vectors x dimensions

    @classmethod
    def of(cls, v: np.ndarray) -> Block:
        found = [np.unique(v[:, j], return_inverse=True) for j in range(v.shape[1])]
        return cls(np.concatenate([f[0] for f in found]), np.array([len(f[0]) for f in found]),
                   np.stack([f[1].reshape(-1) for f in found], axis=1).astype(np.uint16))

    def places(self) -> np.ndarray:
        """Where each component stands in ``values``."""
        return self.codes + (np.cumsum(self.sizes) - self.sizes)[None, :]

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(centroid of each vector, its squared distance, the vectors); equal
        distances go to the smaller number. Python integers where a long
        might not hold the sums."""
        dims = len(self.sizes)
        wide = max(np.abs(self.values).max(), max(abs(int(c)) for c in centroids.flat)) > PLAIN or dims > 2 ** 8
        kind = object if wide else np.int64
        values = self.values.astype(kind)
        at = self.places()
        of_dim = np.repeat(np.arange(dims), self.sizes)
        best = cluster = None
        for k, c in enumerate(centroids):
            table = (values - c.astype(kind)[of_dim]) ** 2  # per dimension and occurring integer
            d = table[at].sum(axis=1)
            if best is None:
                best, cluster = d, np.zeros(len(d), np.int64)
            else:
                less = (d < best).astype(bool)
                best = np.where(less, d, best)
                cluster[less] = k
        return cluster, best, values[at]


def pack(vectors: DataFrame, dims: int, scale: int, block: int = BLOCK) -> DataFrame:
    """(ids, values, sizes, codes) per block, of rows (id, vec)."""
    kind = vectors.schema["id"].dataType
    schema = T.StructType([T.StructField("ids", T.ArrayType(kind)), T.StructField("values", T.ArrayType(T.LongType())),
                           T.StructField("sizes", T.ArrayType(T.IntegerType())), T.StructField("codes", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, block):
                part = b.slice(at, block)
                v = scaled(part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, dims), scale)
                made = Block.of(v)
                ids = part.column(0)
                yield pa.RecordBatch.from_arrays([
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([made.values], pa.list_(pa.int64())),
                    pa.array([made.sizes], pa.list_(pa.int32())), pa.array([made.codes.tobytes()], pa.binary())], names=schema.names)

    return vectors.mapInArrow(run, schema)


def blocks_of(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[pa.RecordBatch, int, Block]]:
    for b in batches:
        values, sizes, codes = (b.column(names.index(c)) for c in ("values", "sizes", "codes"))
        for i in range(b.num_rows):
            n = np.array(sizes[i].values)
            yield b, i, Block(np.array(values[i].values), n, np.frombuffer(codes[i].as_py(), np.uint16).reshape(-1, len(n)))


def first_centroids(vectors: DataFrame, k: int, scale: int, seed: int) -> list[list[int]]:
    """The ``k`` rows with the smallest sha256 of ``seed:id``, scaled."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = vectors.filter("id IS NOT NULL").select(h.alias("h"), "vec").orderBy("h", "vec").limit(k).collect()
    return [[int(x) for x in scaled(np.array(r["vec"], np.float64), scale)] for r in rows]


def as_array(centroids: list[list[int]]) -> np.ndarray:
    return np.array(centroids, dtype=object)


def moved(blocks: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round."""
    dims = len(centroids[0])
    array = as_array(centroids)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = [0] * len(array), [[0] * dims for _ in array]
        for _, _, block in blocks_of(batches, ("values", "sizes", "codes")):
            cluster, _, v = block.nearest(array)
            for k in np.unique(cluster):
                own = v[cluster == k]
                n[k] += len(own)
                total[k] = [a + int(x) for a, x in zip(total[k], own.sum(axis=0))]
        hit = [k for k in range(len(array)) if n[k]]
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array([n[k] for k in hit], pa.int64()),
                                          pa.array([[Decimal(x) for x in total[k]] for k in hit], pa.list_(pa.decimal128(38, 0)))], names=["k", "n", "s"])

    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("s", T.ArrayType(SUM))])
    per_task = blocks.select("values", "sizes", "codes").mapInArrow(sums, schema)
    rows = per_task.groupBy("k").agg(F.sum("n").alias("n"), *[F.sum(F.col("s")[j]).alias(f"s{j}") for j in range(dims)]).collect()  # k rows
    out = list(centroids)
    for r in rows:
        out[r["k"]] = [int(r[f"s{j}"]) // r["n"] for j in range(dims)]
    return out


def assigned(blocks: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(id, cluster, distance): the squared distance, or the largest long where
    it is beyond one."""
    array = as_array(centroids)
    kind = blocks.schema["ids"].dataType.elementType
    schema = T.StructType([T.StructField("id", kind), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, i, block in blocks_of(batches, ("ids", "values", "sizes", "codes")):
            cluster, d, _ = block.nearest(array)
            if d.dtype == object:
                d = np.array([min(x, LONG) for x in d], np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0)[i].values, pa.array(cluster, pa.int32()), pa.array(d, pa.int64())], names=["id", "cluster", "distance"])

    return blocks.mapInArrow(run, schema)


def as_long(total: int) -> Column:
    return F.lit(min(total, LONG)).cast("long")


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3,
            vec_id: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """Per usable row: id, cluster, distance (squared), cluster_inertia,
    inertia, centroid (its final integers)."""
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(vec).alias("vec")).filter(usable(F.col("vec"), dims)).withColumn("vec", F.col("vec").cast("array<double>"))
    blocks = written(pack(rows, dims, scale), "vector-blocks")
    centroids = first_centroids(rows, k, scale, seed)
    if not centroids:  # no row with an id: nothing to start from
        return (rows.filter(F.lit(False)).select(F.col("id").alias(vec_id), F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")],
                                                 F.array().cast("array<decimal(38,0)>").alias("centroid")))
    for _ in range(rounds):
        centroids = moved(blocks, centroids)
    found = written(assigned(blocks, centroids), "clusters")
    inertia = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast(SUM)).alias("s")).collect()}  # k rows
    own = F.array(*[as_long(inertia.get(i, 0)) for i in range(len(centroids))])
    final = F.array(*[F.array(*[F.lit(str(x)).cast(SUM) for x in c]) for c in centroids])
    return found.select(F.col("id").alias(vec_id), "cluster", "distance", own[F.col("cluster")].alias("cluster_inertia"),
                        as_long(sum(inertia.values())).alias("inertia"), final[F.col("cluster")].alias("centroid"))


def centroid_digest(centroid: Column) -> Column:
    """sha256 of the components as decimal integers joined by commas."""
    return F.sha2(F.array_join(F.transform(centroid, lambda x: x.cast("string")), ","), 256)


__all__ = ["cluster", "centroid_digest", "Block", "pack", "moved", "assigned", "first_centroids"]
