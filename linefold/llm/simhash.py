"""Near-duplicate groups by SimHash and covering locality-sensitive hashing.

Fingerprint: every shingle of ``shingle`` words (ASCII lower case, repeats
counted) is hashed with XXH64; a bit of the fingerprint is set where more than
half of the hashes have it.

Candidate search: each of the 64 bit positions gets a non-zero vector of
``radius + 1`` bits, and each non-zero vector v of that space gives one table,
whose key keeps the bits whose vector has odd inner product with v. The
vectors of any ``radius`` differing positions span at most ``radius``
dimensions, so some v is orthogonal to all of them and that table's key drops
every differing bit: each pair within the radius collides in some table, with
2 ** (radius + 1) - 1 tables in all.

Everything after the fingerprints works on distinct fingerprints, so copies
cost one aggregate. A bucket of up to ``small`` fingerprints is compared pair
by pair. In a larger one each fingerprint emits itself and its neighbours at
distance radius / 2 within the dropped bits; fingerprints that share such a
middle point are within the radius and get linked to the smallest of them.
Both are exact, and the second is linear in the bucket, so no bucket size is
cut off.

Nulls and edge cases: a null, empty or blank text has fingerprint 0 and links
like any other; fewer words than a shingle are one shingle; rows repeat in the
result as often as in the input; a null id takes no part in the smallest id
(a group of null ids only has a null component). Only the id and text columns
are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linefold.llm.common import under_own_names, written

SEED = 42
BLOCK = 65_536  # hashes whose bits are counted at once


def fingerprint(text: bytes | None, shingle: int) -> int:
    """SimHash of one text, as an unsigned 64-bit number."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(min(shingle, len(words))))))
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(SEED))
    ones, left = np.zeros(64, np.int64), n
    while left:
        h = np.fromiter(hashes, "<u8", min(left, BLOCK))
        left -= len(h)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str, shingle: int, out: str) -> DataFrame:
    """``docs`` with the fingerprint of ``text`` as a bigint column ``out``."""
    fields = docs.schema.fields
    schema = docs.withColumn(out, F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column(b.num_columns - 1).to_pylist()
            fp = pa.array(np.fromiter((fingerprint(t, shingle) for t in raw), np.uint64, len(raw)).view(np.int64))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], fp], names=[*b.schema.names[:-1], out])

    raw = docs.select(*[F.col(f.name) for f in fields], F.col(text).cast("binary").alias("__raw"))
    return raw.mapInArrow(run, schema)


def masks(radius: int) -> list[int]:
    """The kept bits of each table: 2 ** (radius + 1) - 1 masks."""
    vectors = [i % (2 ** (radius + 1) - 1) + 1 for i in range(64)]
    return [sum(1 << i for i, p in enumerate(vectors) if (p & v).bit_count() % 2) for v in range(1, 2 ** (radius + 1))]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(prints: DataFrame, radius: int, small: int = 32) -> DataFrame:
    """Edges (a, b), a < b, whose components are those of all pairs of
    distinct fingerprints (column ``fp``) within ``radius`` bits."""
    if radius % 2:
        raise ValueError("the radius must be even")
    kept = masks(radius)
    keyed = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
        for k, m in enumerate(kept)])).alias("x")).select("fp", "x.t", "x.key")
    full = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = written(keyed.join(full, ["t", "key"]), "simhash-members")
    few = members.filter(F.col("n") <= small).select("t", "key", "fp")
    pairs = (few.select("t", "key", F.col("fp").alias("a")).join(few.select("t", "key", F.col("fp").alias("b")), ["t", "key"])
             .filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)).select("a", "b"))

    def near(m: int) -> Column:
        free = [i for i in range(64) if not m >> i & 1]
        flips = [sum(1 << i for i in c) for k in range(radius // 2 + 1) for c in combinations(free, k)]
        return F.array(*[F.lit(_signed(x)) for x in flips])

    flips = F.element_at(F.array(*[near(m) for m in kept]), F.col("t") + 1)
    middle = (members.filter(F.col("n") > small).select("fp", F.explode(flips).alias("x"))
              .select("fp", F.col("fp").bitwiseXOR(F.col("x")).alias("z")).distinct())
    # at most 1 + 64 ** (radius / 2) fingerprints are that near to one point
    stars = (middle.join(middle.groupBy("z").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "z")
             .filter("a < fp").select("a", F.col("fp").alias("b")))
    return pairs.union(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); root is the same for
    all nodes of a component.

    Each round renames every node to its smallest neighbour (itself included)
    and drops the loops this leaves; fingerprints are as good as random, so a
    round shrinks even a long chain by a constant share. Each round is a
    written table, so that a lost executor costs one round at most.
    """
    edges = written(edges, "edges")
    named = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        low = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                      .select("node", F.least("node", "m").alias("m")), "low")
        if named is None:
            named = low.select("node", F.col("m").alias("root"))
        else:
            named = written(named.join(low.select(F.col("node").alias("root"), "m"), "root", "left")
                            .select("node", F.coalesce("m", "root").alias("root")), "named")
        edges = written(edges.join(low.select(F.col("node").alias("a"), F.col("m").alias("x")), "a")
                        .join(low.select(F.col("node").alias("b"), F.col("m").alias("y")), "b")
                        .filter("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")) if named is None else named


def group_by_fingerprint(prints: DataFrame, least: Column, radius: int) -> DataFrame:
    """(fp, low) for each distinct fingerprint of ``prints``: the smallest
    ``least`` of its component."""
    reps = written(prints.groupBy("fp").agg(F.min(least).alias("low")), "prints")
    rooted = (reps.join(components(links(reps.select("fp"), radius)).withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", "low", F.coalesce("root", "fp").alias("root")))
    return (rooted.join(rooted.groupBy("root").agg(F.min("low").alias("least")), "root")
            .select("fp", F.col("least").alias("low")))


def near_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row per row of ``docs``: the id, ``fingerprint`` (16 hex digits)
    and ``component_id``, the smallest id reachable over links of at most
    ``radius`` differing bits."""
    prints = written(with_fingerprint(docs.select(F.col(doc_id).alias("id"), F.col(text).cast("binary").alias("t")), "t", shingle, "fp")
                     .select("id", "fp"), "fingerprints")
    found = group_by_fingerprint(prints, F.col("id"), radius)
    return prints.join(found, "fp").select(
        F.col("id").alias(doc_id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("low").alias("component_id"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id (null ids
    last; of rows with the same id, any one)."""
    def work(d: DataFrame, doc_id: str, text: str) -> DataFrame:
        rows = written(with_fingerprint(d, text, shingle, "__fp").withColumn("__row", F.monotonically_increasing_id()), "rows")
        # nulls last: min over structs takes a null field first
        order = F.struct(F.col(doc_id).isNull().alias("n"), F.col(doc_id).alias("d"), F.col("__row").alias("row"))
        found = group_by_fingerprint(rows.select(F.col("__fp").alias("fp"), F.col(doc_id), "__row"), order, radius)
        return rows.join(found.select(F.col("low.row").alias("__row")).distinct(), "__row", "left_semi")

    return under_own_names(docs, work, doc_id=doc_id, text=text)


__all__ = ["fingerprint", "masks", "links", "components", "near_dedup", "keep_one"]
