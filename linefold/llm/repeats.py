"""Removal of byte strings that earlier documents have, by merged
Burrows-Wheeler transforms.

Every byte covered by a ``length``-byte string that also starts in a document
with a smaller id is removed; strings overlap freely, never cross documents,
and are judged on the input.

1. Texts. Of equal texts the smallest document counts, and the others are
   removed whole (if they are long enough); no more is done for copies.
2. Candidates. Of each string of ``length`` bytes, the ``GRAM``-byte gram with
   the smallest hash (the first of equal ones) is its anchor (winnowing): equal
   strings have equal anchors at equal places, and neighbouring strings mostly
   have the same one. Only anchors that at least two texts share go on, each
   with its context, the bytes of the strings whose anchor it is. Contexts that
   are equal are one, with the smallest document of all of them (a partial
   aggregate, so common passages are cheap).
3. The distinct contexts are dealt into blocks by anchor. In a block, shards of
   contexts get their Burrows-Wheeler transforms, and these are merged by
   interleave refinement to a depth of ``length`` bytes. Where the common
   prefix with the row before is at least ``length``, rows are an interval of
   one repeated string; its smallest document goes to all its places. No
   suffix is sorted again, and a block is bounded: an anchor with more than
   ``MOST_CONTEXTS`` distinct contexts is split into the single strings of its
   contexts, whose smallest documents are a plain aggregate, exact as well.
   Equal strings have one anchor, so an anchor with one context needs no merge,
   nor does a context whose bytes around the gram stand in no other context of
   the anchor, and of the others only the bytes of strings that may be shared
   are merged (``shared_parts``).
4. Places whose string has a smaller document are put together per document,
   and the covered bytes removed.

Nulls and edge cases: null and empty texts have no bytes; null ids come after
all others, and equal ids (null ones too) do not remove from each other, so
repeated rows are treated alike; texts shorter than ``length`` are kept whole.
Texts are told apart by a 64-bit hash. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefold.llm.bwt import merge, transform
from linefold.llm.common import written

GRAM = 20
MOST_CONTEXTS = 4_000
BLOCK_BYTES = 1 << 20
SHARD_CONTEXTS = 600
SOME_PLACES = 20_000  # contexts that a task holds at once
CHUNK = 1 << 15  # bytes hashed at once
PARTS = 6  # ranges of places of the gram within a string
SMALL_TABLE = 50_000  # anchors in a table that may be broadcast
LAST = 2 ** 63 - 1  # the place of null ids
MOST_BITS = 1 << 28  # of the filter of shared anchors, 32 MB
BUCKET_BITS = 1 << 15  # of one row of Spark's bitmaps


def gram_hashes(text: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of the ``GRAM``-byte grams of a text (uint8), of all or of
    those that start ``at``."""
    n = len(text) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    words = np.lib.stride_tricks.as_strided(text[:8].view("<u8"), (n + GRAM - 8,), (1,))
    if at is None:
        words = np.ascontiguousarray(words)

    def word(k: int) -> np.ndarray:
        return words[k:k + n] if at is None else words[at + k]

    h = word(0) * np.uint64(0x9E3779B97F4A7C15)
    for k, factor in zip((*range(8, GRAM - 8, 8), GRAM - 8), (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)):
        h ^= h >> np.uint64(29)
        h += word(k)
        h *= np.uint64(factor)
    h ^= h >> np.uint64(32)
    return h


def sliding(x: np.ndarray, size: int, best: np.ufunc) -> np.ndarray:
    """best (minimum or maximum) of each ``size`` neighbours."""
    have = 1
    while have < size:
        step = min(have, size - have)
        x = best(x[:-step], x[step:])
        have += step
    return x


def anchors(text: np.ndarray, length: int, ends: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(first, last, at, hash) of the anchors of a text of at most a million
    bytes: strings that start at ``first`` to ``last`` have the gram at ``at``
    as theirs. ``ends``: where the texts end, if it is several in a row, of
    ``length`` bytes and more each."""
    if len(text) < length:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    h, place = gram_hashes(text), np.uint64((1 << 20) - 1)
    # the smallest hash (its upper bits), of equal ones the first, in one number
    at = (sliding((h & ~place) | np.arange(len(h), dtype=np.uint64), length - GRAM + 1, np.minimum) & place).astype(np.int64)
    new = np.append(True, at[1:] != at[:-1])
    if ends is not None and len(ends) > 1:
        at[(ends[:-1, None] + np.arange(1 - length, 0)).ravel()] = -1  # strings over the end of a text
        new[ends[:-1]] = new[ends[:-1] + 1 - length] = True
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    some = at[first] >= 0
    first, last = first[some], last[some]
    return first, last, at[first], h[at[first]].view(np.int64)


def anchors_of(texts: pa.Array, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, first, last, at, hash) of the anchors of each text, ``length``
    bytes and more each, some texts or a part of one at a time."""
    texts = texts.cast(pa.large_binary())
    offset = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data, i = np.frombuffer(texts.buffers()[2] or b"", np.uint8), 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offset, offset[i] + CHUNK, "right")) - 1)
        low, high = int(offset[i]), int(offset[j])
        step = CHUNK if j == i + 1 else high - low  # strings of one long text in parts
        for k in range(low, high - length + 1, step):
            first, last, at, found = anchors(data[k:min(k + step + length - 1, high)], length, offset[i + 1:j + 1] - low)
            row = i + np.searchsorted(offset[i + 1:j + 1], first + k, "right")
            back = k - offset[row]
            yield row, first + back, last + back, at + back, found
        i = j


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(d, th, raw): order of the id, hash of the text, its bytes."""
    raw = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("d"), F.xxhash64(raw).alias("th"), raw.alias("raw"))


def anchor_filter(met: DataFrame, most_bits: int = MOST_BITS) -> np.ndarray:
    """Bits (uint8) of which those of the anchors of ``met`` are set, and of
    others a few: what has no bit is not in ``met``. At most ``most_bits``, so
    what reaches the driver is bounded; with more anchors more others pass."""
    n, bits = met.count(), BUCKET_BITS
    while bits < min(16 * n, most_bits):
        bits *= 2
    at = F.pmod("anchor", F.lit(bits)) + 1
    buckets = met.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bitmap"))
    out = np.zeros((bits // BUCKET_BITS, BUCKET_BITS // 8), np.uint8)
    for r in buckets.collect():
        out[r["bucket"] - 1] = np.frombuffer(r["bitmap"], np.uint8)
    return out.ravel()


def may_be_in(found: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether each anchor has its bit set."""
    at = found & np.int64(8 * len(bits) - 1)  # the number of bits is a power of two
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def shared_places(rows: DataFrame, length: int) -> DataFrame:
    """(th, places): per text, the places of anchors that another text has."""
    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, *_, found in anchors_of(b.column(1), length):
                yield pa.RecordBatch.from_arrays([pa.array(found), b.column(0).take(pa.array(row))], names=["anchor", "th"])

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, first, last, at, found in anchors_of(b.column(1), length):
                # most anchors are in one text: few of those go to the join, which decides
                some = may_be_in(found, bits.value)
                row, first, last, at, found = row[some], first[some], last[some], at[some], found[some]
                place = (first << 32) | ((last - first) << 16) | (at - last)
                yield pa.RecordBatch.from_arrays([pa.array(found), b.column(0).take(pa.array(row)), pa.array(place)], names=["anchor", "th", "place"])

    full = rows.filter(F.octet_length("raw") >= length).select("th", "raw")
    met = (full.mapInArrow(values, "anchor bigint, th bigint").groupBy("anchor")
           .agg(F.min("th").alias("low"), F.max("th").alias("high")).filter("low < high").select("anchor"))
    # each anchor once, dealt evenly: a task's share is hashed rather than all places sorted
    met = written(met, "anchors")
    bits = rows.sparkSession.sparkContext.broadcast(anchor_filter(met))
    met = met.hint("shuffle_hash")
    # the places of one text, whose size bounds the set
    return written(full.mapInArrow(places, "anchor bigint, th bigint, place bigint").join(met, "anchor")
                   .groupBy("th").agg(F.collect_set("place").alias("places")), "places")


def contexts(rows: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """(anchor, d, th, start, before, context) of each shared anchor's place,
    ``before`` the bytes before the gram; places: (d, th, places) of the
    documents to look at."""
    def batch(b: pa.RecordBatch, held: list[tuple]) -> pa.RecordBatch:
        row = pa.array(np.repeat([x[0] for x in held], [len(x[1]) for x in held]))
        anchor, start, before = (np.concatenate([x[k] for x in held]) for k in (1, 2, 3))
        return pa.RecordBatch.from_arrays([pa.array(anchor), b.column(0).take(row), b.column(1).take(row), pa.array(start.astype(np.int32)),
                                           pa.array(before.astype(np.int32)), pa.array([c for x in held for c in x[4]], pa.binary())],
                                          names=["anchor", "d", "th", "start", "before", "context"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, n = [], 0
            for i in range(b.num_rows):
                text, places = b.column(2)[i].as_py(), np.sort(b.column(3)[i].values.to_numpy())
                first = places >> 32
                last = first + ((places >> 16) & 0xFFFF)
                at = last + (places & 0xFFFF)
                hashes = gram_hashes(np.frombuffer(text, np.uint8), at).view(np.int64)
                for k in range(0, len(places), SOME_PLACES):  # nearly every byte of a text of equal bytes is an anchor
                    some = slice(k, k + SOME_PLACES)
                    held.append((i, hashes[some], first[some], (at - first)[some],
                                 [text[s:e] for s, e in zip(first[some].tolist(), (last[some] + length).tolist())]))
                    n += len(held[-1][1])
                    if n >= SOME_PLACES:
                        yield batch(b, held)
                        held, n = [], 0
            if held:
                yield batch(b, held)

    return rows.join(places, ["d", "th"]).select("d", "th", "raw", "places").mapInArrow(
        run, "anchor bigint, d bigint, th bigint, start int, before int, context binary")


def shared_parts(texts: np.ndarray, before: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Per context, where strings that another context of its anchor may hold
    start: first and last place, the last below the first if there is none.
    There are false positives, no false negatives. before: bytes before the gram.

    A shared string reaches some o bytes before the gram and the rest of
    ``length`` behind it. The possible o are cut into ``PARTS`` ranges; in a
    range all strings hold the same bytes around the gram, all but a few, so
    only ranges of which this core stands in another context count. Cores are
    told apart by a hash.
    """
    reach = length - GRAM
    size = np.array([len(t) for t in texts])
    cells = np.zeros((len(texts), length + reach), np.uint8)
    column = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(reach - before, size)
    cells[np.repeat(np.arange(len(texts)), size), column] = np.frombuffer(b"".join(texts), np.uint8)
    weight = np.random.default_rng(0).integers(0, 1 << 63, length + reach).astype(np.uint64) | np.uint64(1)
    edges = [reach * k // PARTS for k in range(PARTS + 1)]
    least, most = np.full(len(texts), reach + 1), np.full(len(texts), -1)
    for low, high in zip(edges, edges[1:]):  # from low to high bytes before the gram
        core = slice(reach - low, reach + length - high)
        rows = np.flatnonzero((before >= low) & (size - before >= length - high))  # those that hold the core
        key = (cells[rows, core] * weight[core]).sum(axis=1, dtype=np.uint64)
        _, which, times = np.unique(key, return_inverse=True, return_counts=True)
        shared = rows[times[which] > 1]
        least[shared] = np.minimum(least[shared], low)
        most[shared] = high
    # a place in the context; only those that its bytes reach
    return np.maximum(before - most, 0), np.minimum(before - least, size - length)


def smallest_documents(texts: list[bytes], docs: np.ndarray, length: int) -> list[np.ndarray]:
    """For each text, the smallest document of each of its ``length``-byte
    strings, from the repeated intervals of the merged transform."""
    size = max(SHARD_CONTEXTS, -(-len(texts) // 256))
    shards = [transform(texts[k:k + size]) for k in range(0, len(texts), size)]
    rows, common = merge(shards, length)
    text = np.concatenate([s.text + k * size for k, s in enumerate(shards)])[rows]
    start = np.concatenate([s.start for s in shards])[rows]
    first = np.flatnonzero(common < length)
    low = np.repeat(np.minimum.reduceat(docs[text], first), np.diff(np.append(first, len(rows))))
    full = np.array([len(t) - length + 1 for t in texts])
    whole = start < full[text]  # places with a full string
    base = np.cumsum(full) - full
    out = np.empty(int(full.sum()), np.int64)
    out[base[text[whole]] + start[whole]] = low[whole]
    return np.split(out, np.cumsum(full)[:-1])


def interval_documents(distinct: DataFrame, length: int) -> DataFrame:
    """(anchor, c, low, lows): of each distinct context, the smallest document
    of all its strings (``lows`` null) or of each (``low`` null). distinct:
    (anchor, c, before, context, d), d the context's own, c its hash."""
    counted = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("context") + 1).alias("bytes"))
    counted = written(counted, "anchor-counts")
    crowded = counted.filter(F.col("n") > MOST_CONTEXTS).select("anchor")
    if crowded.count() <= SMALL_TABLE:
        crowded = F.broadcast(crowded)
    total = counted.filter(F.col("n") <= MOST_CONTEXTS).agg(F.sum("bytes")).first()[0] or 0
    blocks = -(-total // BLOCK_BYTES) or 1

    def merged(block: pd.DataFrame) -> pd.DataFrame:
        block["low"] = pd.array(block["d"], dtype="Int64")
        block["lows"] = None
        several = np.flatnonzero(block.duplicated("anchor", keep=False))
        if len(several):
            texts = block["context"].to_numpy()[several]
            first, last = shared_parts(texts, block["before"].to_numpy()[several].astype(np.int64), length)
            some = first <= last  # the others have all their strings to themselves
            several, texts, first, last = several[some], texts[some], first[some], last[some]
        if len(several):
            docs = block["d"].to_numpy()[several]
            parts = [bytes(t[a:b + length]) for t, a, b in zip(texts, first.tolist(), last.tolist())]
            lows = [np.full(len(t) - length + 1, d) for t, d in zip(texts, docs)]
            for x, a, low in zip(lows, first.tolist(), smallest_documents(parts, docs, length)):
                x[a:a + len(low)] = low
            same = [bool((x == x[0]).all()) for x in lows]
            block.loc[block.index[several], "low"] = pd.array([int(x[0]) if s else None for x, s in zip(lows, same)], dtype="Int64")
            column = block["lows"].to_numpy(dtype=object, copy=True)
            for at, x, s in zip(several, lows, same):
                column[at] = None if s else x
            block["lows"] = column
        return block[["anchor", "c", "low", "lows"]]

    usual = distinct.join(crowded, "anchor", "left_anti").withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(blocks)))
    usual = usual.groupBy("block").applyInPandas(merged, "anchor bigint, c bigint, low bigint, lows array<bigint>")

    n_strings = F.octet_length("context") - F.lit(length - 1)
    strings = (distinct.join(crowded, "anchor")
               .select("anchor", "c", "d", "context", F.posexplode(F.sequence(F.lit(1), n_strings)).alias("k", "p"))
               .select("anchor", "c", "d", "k", F.expr(f"substring(context, p, {length})").alias("string")))
    least = strings.groupBy("string").agg(F.min("d").alias("low"))
    many = (strings.join(least, "string").groupBy("anchor", "c").agg(F.sort_array(F.collect_list(F.struct("k", "low"))).alias("x"))
            .select("anchor", "c", F.lit(None).cast("bigint").alias("low"), F.col("x.low").alias("lows")))
    return usual.unionByName(many)


def covered(first: np.ndarray, last: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs (start, end) of bytes covered by strings that start at
    ``first`` to ``last``."""
    if not len(first):
        return []
    order = np.argsort(first, kind="stable")
    start, end = first[order], np.maximum.accumulate(last[order] + length)
    new = np.flatnonzero(start[1:] > end[:-1]) + 1
    return list(zip(start[np.append(0, new)].tolist(), end[np.append(new - 1, len(end) - 1)].tolist()))


def remove_repeats(docs: DataFrame, length: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, ``spans`` (start
    and end of each maximal removed run) and ``kept`` (the other bytes)."""
    if not GRAM < length < 1 << 16:
        raise ValueError(f"strings must be longer than {GRAM} bytes and shorter than {1 << 16}")
    rows = _rows(docs, doc_id, text)
    texts = written(rows.groupBy("th").agg(F.min("d").alias("d")), "texts")
    shared = shared_places(rows, length).join(texts, "th")
    # contexts of one anchor are told apart by a 64-bit hash; the bytes are read once more only
    named = F.xxhash64("context").alias("c")
    more = (F.octet_length("context") - F.lit(length)).alias("more")
    found = written(contexts(rows, shared, length).select("*", named, more), "contexts")
    distinct = written(found.groupBy("anchor", "context").agg(F.min("d").alias("d"), F.min("before").alias("before")), "distinct-contexts").select("*", named)
    lows = written(interval_documents(distinct, length), "intervals")  # each context once, so dealt evenly
    # from where to where strings start that an earlier document has
    some = F.filter(F.transform("lows", lambda low, k: F.when(low < F.col("d"), F.col("start") + k)), lambda x: x.isNotNull())
    all_ = F.when(F.col("low") < F.col("d"), F.array("start"))
    places = found.select("anchor", "c", "d", "th", "start", "more").join(lows.hint("shuffle_hash"), ["anchor", "c"])
    places = places.withColumn("first", F.when(F.col("lows").isNull(), all_).otherwise(some)).filter(F.size("first") > 0).select(
        "d", "th", "first", F.when(F.col("lows").isNull(), F.array(F.col("start") + F.col("more"))).otherwise(F.col("first")).alias("last"))
    # the places of one text, whose size bounds the list
    gone = (places.groupBy("th").agg(F.collect_list(F.struct("first", "last")).alias("x"))
            .select("th", F.flatten("x.first").alias("first"), F.flatten("x.last").alias("last")))
    verdict = written(texts.withColumnRenamed("d", "__d").join(gone, "th", "left"), "verdicts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans, kept, size = [], [], []
            for raw, *places in zip(b.column(1).to_pylist(), b.column(2), b.column(3)):
                first, last = (p.values.to_numpy() if p.is_valid else np.zeros(0, np.int64) for p in places)
                runs = covered(first, last, length)
                size.append(len(raw))
                spans.append([{"start": s, "end": e} for s, e in runs])
                inner = [0, *[x for r in runs for x in r], len(raw)]
                kept.append(b"".join(raw[s:e] for s, e in zip(inner[::2], inner[1::2])))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()),
                                              pa.array([sum(x["end"] - x["start"] for x in s) for s in spans], pa.int64()),
                                              pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                                             names=["id", "n_bytes", "n_removed", "spans", "kept"])

    own = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("d"),
                      F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("raw")).withColumn("th", F.xxhash64("raw"))
    schema = own.select("id", *[F.lit(0).cast("long").alias(c) for c in ("n_bytes", "n_removed")],
                        F.lit(None).cast("array<struct<start:bigint,end:bigint>>").alias("spans"), F.col("raw").alias("kept")).schema
    # a copy of an earlier text is one string that starts at all its places but the last few
    n = F.octet_length("raw")
    copy = (F.col("d") > F.col("__d")) & (n >= length)
    whole = own.join(verdict, "th").select(
        "id", "raw", F.when(copy, F.array(F.lit(0))).otherwise(F.col("first")).alias("first"),
        F.when(copy, F.array(n - F.lit(length))).otherwise(F.col("last")).alias("last"))
    return whole.mapInArrow(cut, schema).withColumnRenamed("id", doc_id)


__all__ = ["GRAM", "gram_hashes", "sliding", "anchors", "anchors_of", "shared_places", "contexts", "smallest_documents", "interval_documents", "covered",
           "remove_repeats"]
