import random

import xxhash
from pyspark.sql import functions as F

from linefold.llm import simhash as S
from llm_data import documents, prose


def brute(pairs):
    """component of each fingerprint by all pairs"""
    fps = sorted({f for _, f in pairs})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    low = {}
    for d, f in pairs:
        if d is not None:
            low[find(f)] = min(d, low.get(find(f), d))
    return {f: low.get(find(f)) for f in fps}


def test_fingerprint():
    text = "Ab cD ef gh"
    h = [xxhash.xxh64_intdigest(s, 42) for s in (b"ab cd ef", b"cd ef gh")]
    assert S.fingerprint(text.encode(), 3) == sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > 2)
    assert S.fingerprint(b"One two", 3) == xxhash.xxh64_intdigest(b"one two", 42)
    assert S.fingerprint(None, 3) == S.fingerprint(b" \n", 3) == 0


def test_every_pair_within_the_radius_meets():
    masks = S.masks(2)
    assert len(masks) == 7
    for i in range(64):
        for j in range(64):
            assert any(not m >> i & 1 and not m >> j & 1 for m in masks)


def test_links_of_random_and_crowded_fingerprints(spark):
    r = random.Random(5)
    fps = {r.getrandbits(64) for _ in range(60)}
    centre = r.getrandbits(64)
    fps |= {centre ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 3))) for _ in range(400)}  # buckets beyond the small limit
    chain = r.getrandbits(64)
    for k in range(0, 60, 2):
        chain ^= 3 << k
        fps.add(chain)
    pairs = [(k, f) for k, f in enumerate(sorted(fps))] + [(None, centre), (-1, 0)]
    rows = spark.createDataFrame([(d, S._signed(f)) for d, f in pairs], "id bigint, fp bigint")
    for small in (32, 2):
        edges = S.links(rows.select("fp").distinct(), 2, small)
        assert edges.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > 2).isEmpty()
    got = {r["fp"] % 2 ** 64: r["low"] for r in S.group_by_fingerprint(rows, F.col("id"), 2).collect()}
    assert got == brute(pairs)


def test_edges(spark, edge_docs, no_docs):
    got = S.near_dedup(edge_docs).collect()
    assert len(got) == edge_docs.count()
    by = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in got}
    zero = "0" * 16
    assert by[3, zero] == by[4, zero] == by[5, zero] == by[None, zero] == 3
    one = {r["doc_id"]: r for r in got}
    assert one[1]["fingerprint"] == one[2]["fingerprint"] and one[1]["component_id"] == one[2]["component_id"] <= 1
    kept = S.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(x for x in ids if x is not None) == sorted({r["component_id"] for r in got if r["component_id"] is not None})
    assert S.near_dedup(no_docs).count() == 0 and S.keep_one(no_docs).count() == 0


def test_only_null_ids(spark):
    got = S.near_dedup(documents(spark, [(None, prose(1, 50)), (None, prose(1, 50))])).collect()
    assert [r["component_id"] for r in got] == [None, None]
