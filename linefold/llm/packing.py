"""Packing documents into training sequences by linear grouping.

Documents become token ids, an end token is added, and those longer than a
sequence are cut into full sequences and a shorter first piece. What is left
to solve is bin packing of piece lengths, and the plan depends on the
histogram of lengths alone, which has at most ``capacity`` entries however
large the corpus is:

1. large lengths, from the longest down, are split into ``groups`` groups of
   equal cardinality, and each is rounded up to its group's longest;
2. configurations of these few sizes are optimised one after the other: the
   longest size left is completed as full as the sizes left allow (bounded
   subset sum, longest sizes preferred), and the configuration is used as
   often as the sizes left allow;
3. the actual lengths take the places of the rounded ones, group by group in
   order, which leaves each sequence at least as much room as planned;
4. the small lengths are put in by best fit, longest first.

Sequences of equal content are handled as one run, so the plan is a bounded
list of runs: the pieces of one length and a range of ranks go to consecutive
sequences. Each piece finds its run by its rank among the pieces of its
length, counted in salted groups, so that a length that a third of all pieces
have is no hot group.

Nulls and edge cases: a null or empty text is one piece holding the end token
alone; repeated rows are packed each; a null id stays null; an empty table
gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linefold.llm.common import written
from linefold.llm.tokens import encoder

GROUPS = 4096
SMALL_SHARE = 1 / 16  # of the capacity: lengths up to it are small
RANKED_TOGETHER = 2_000  # pieces of a length ranked in one group, about


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int = 0, doc_id: str = "doc_id",
           text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's pieces."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("t"))
    schema = rows.select("doc_id", F.lit(0).alias("piece"), *[F.lit(0).cast("long").alias(c) for c in ("start", "length", "ids_crc32")]).schema
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for b in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for k, t in enumerate(b.column(1).to_pylist()):
                ids = encode(t) + end
                n = len(ids) // 4
                cuts = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                for p, (s, e) in enumerate(zip(cuts, cuts[1:])):
                    row.append(k)
                    piece.append(p)
                    start.append(s)
                    length.append(e - s)
                    crc.append(zlib.crc32(ids[4 * s:4 * e]))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                                              *[pa.array(x, pa.int64()) for x in (start, length, crc)]], names=schema.names)

    return rows.mapInArrow(run, schema)


def grouped(lengths: list[tuple[int, int]], groups: int) -> list[list[tuple[int, int]]]:
    """Groups of equal cardinality (but for the last) of (length, count),
    longest first; a length may be shared by two groups."""
    total = sum(n for _, n in lengths)
    size = -(-total // groups) if total else 1
    out: list[list[tuple[int, int]]] = [[]]
    room = size
    for length, n in lengths:
        while n:
            take = min(n, room)
            out[-1].append((length, take))
            n, room = n - take, room - take
            if not room:
                out.append([])
                room = size
    return [g for g in out if g]


def configurations(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """(size numbers, times) that use up ``counts``; sizes fall."""
    left, out = list(counts), []
    for first in range(len(sizes)):
        while left[first]:
            room = capacity - sizes[first]
            left[first] -= 1
            # by[s]: the size that first reached the sum s, from s - sizes[by[s]]
            by = np.full(room + 1, -1, np.int64)
            reached = np.zeros(room + 1, bool)
            reached[0] = True
            for k in range(first, len(sizes)):
                s = sizes[k]
                if not left[k] or s > room:
                    continue
                for _ in range(min(left[k], room // s)):
                    new = np.zeros_like(reached)
                    new[s:] = reached[:-s]
                    new &= ~reached
                    if not new.any():
                        break
                    by[new] = k
                    reached |= new
                if reached[room]:
                    break
            at, used = int(np.flatnonzero(reached)[-1]), [first]
            while at:
                used.append(int(by[at]))
                at -= sizes[by[at]]
            left[first] += 1
            need = defaultdict(int)
            for k in used:
                need[k] += 1
            times = min(left[k] // n for k, n in need.items())
            for k, n in need.items():
                left[k] -= n * times
            out.append((sorted(used), times))
    return out


def plan(histogram: dict[int, int], capacity: int, groups: int = GROUPS, small_share: float = SMALL_SHARE) -> np.ndarray:
    """Runs (length, from rank, pieces per sequence, first sequence, offset),
    sorted: the pieces of a length from that rank up to the next run's."""
    runs: list[tuple[int, int, int, int, int]] = []
    ranked: dict[int, int] = defaultdict(int)  # of each length, the pieces placed
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room left -> (first sequence, sequences)
    sequences = 0
    large = [(x, histogram[x]) for x in sorted(histogram, reverse=True) if x > small_share * capacity]
    members = grouped(large, groups)
    taken = [0] * len(members)  # of each group, the pieces placed
    ends = [np.cumsum([n for _, n in g]) for g in members]
    start_rank: list[list[int]] = []  # of each entry of each group, the rank of its first piece in its length
    for g in members:
        start_rank.append([])
        for length, n in g:
            start_rank[-1].append(ranked[length])
            ranked[length] += n
    for used, times in configurations([g[0][0] for g in members], [sum(n for _, n in g) for g in members], capacity):
        # places of one size take one range of ranks each
        places = []
        for k in used:
            places.append((k, taken[k]))
            taken[k] += times
        done = 0
        while done < times:  # up to where one of the places meets another length
            step, at = times - done, 0
            here = []
            for k, base in places:
                e = int(np.searchsorted(ends[k], base + done, side="right"))
                step = min(step, int(ends[k][e]) - base - done)
                here.append((k, e, base + done - (int(ends[k][e - 1]) if e else 0)))
            for k, e, off in here:
                length = members[k][e][0]
                runs.append((length, start_rank[k][e] + off, 1, sequences + done, at))
                at += length
            room[capacity - at].append((sequences + done, step))
            done += step
        sequences += times
    for length in sorted((x for x in histogram if x <= small_share * capacity), reverse=True):
        n, rank = histogram[length], 0
        while n:
            fits = [r for r in room if r >= length and room[r]]
            best = min(fits) if fits else capacity
            each = best // length
            first, count = room[best].pop() if fits else (sequences, max(1, -(-n // each)))
            if not fits:
                sequences += count
            full = min(count, n // each)
            if full:
                runs.append((length, rank, each, first, capacity - best))
                room[best - each * length].append((first, full))
                n, rank = n - full * each, rank + full * each
            if full < count and n and n < each:
                runs.append((length, rank, n, first + full, capacity - best))
                room[best - n * length].append((first + full, 1))
                rank, n, full = rank + n, 0, full + 1
            if full < count:
                room[best].append((first + full, count - full))
    return np.array(sorted(runs), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, doc_id: str = "doc_id",
         text: str = "text", groups: int = GROUPS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (of the
    little-endian 32-bit ids), sequence_id, offset."""
    cut = written(pieces(docs, path, capacity, end_id, doc_id, text), "pieces")
    counts = cut.groupBy("length").count()  # at most capacity rows
    histogram = {r["length"]: r["count"] for r in counts.collect()}
    runs = plan(histogram, capacity, groups)
    salts = F.broadcast(counts.select("length", F.ceil(F.col("count") / RANKED_TOGETHER).alias("salts")))
    salted = cut.join(salts, "length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("salts")))
    per = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = per.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = (salted.withColumn("own", own).join(before, ["length", "salt"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("own") + F.col("before")).alias("rank")))
    schema = cut.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema
    widest = int(max(histogram.values(), default=0)) + 1
    keys = runs[:, 0] * widest + runs[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (b.column(k).to_numpy(zero_copy_only=False) for k in (3, 5))
            r = runs[np.searchsorted(keys, length * widest + rank, side="right") - 1]
            step = rank - r[:, 1]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(r[:, 3] + step // r[:, 2]),
                                              pa.array(r[:, 4] + step % r[:, 2] * length)], names=schema.names)

    return ranked.mapInArrow(place, schema)


__all__ = ["pieces", "grouped", "configurations", "plan", "pack"]
