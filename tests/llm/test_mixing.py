import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from linefold.llm import mixing as M
from llm_data import documents, prose


def corpus(spark):
    sizes = {"a": 300, "b": 60, "c": 20, None: 30}
    rows, k = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((k, prose(k, 20 + k % 17), "en", source))
            k += 1
    return documents(spark, rows)


def per_source(mixed):
    total, out = defaultdict(int), defaultdict(int)
    for r in mixed.select("source", "__copies", M.estimated_tokens(F.col("text")).alias("n")).collect():
        total[r["source"]] += r["n"]
        out[r["source"]] += r["n"] * r["__copies"]
    return total, out


def test_repeat_limit(spark):
    mixed = M.mix(corpus(spark), max_repeats=2.5)
    total, out = per_source(mixed)
    low, high = min(total.values()), max(total.values())
    a = 1 - math.log(2.5) / math.log(high / low)
    for s in total:
        want = (high / total[s]) ** (1 - a) * total[s]
        assert want - 60 <= out[s] <= want + 1  # a document short of the budget at most
    assert mixed.filter("__copies < 1").isEmpty()
    copies = Counter((r["source"], r["__copies"]) for r in mixed.collect())
    assert copies["c", 2] and copies["c", 3] and not copies["a", 2]


def test_entropy_target_and_budget(spark):
    docs = corpus(spark)
    target = 1.0
    sources = M.source_totals(docs.select(F.col("source").alias("__source"), M.estimated_tokens(F.col("text")).alias("__tokens")))
    a = M.bisect_exponent(sources, entropy=target)
    p = [r["share"] for r in sources.collect()]
    z = sum(x ** a for x in p)
    assert abs(-sum(x ** a / z * math.log(x ** a / z) for x in p) - target) < 1e-6
    total, out = per_source(M.mix(docs, entropy=target, budget=2000))
    for s, x in total.items():
        want = (x / sum(total.values())) ** a / z * 2000
        assert want - 60 <= out[s] <= want + 1
    assert M.bisect_exponent(sources, entropy=0.0) > 0.999 and M.bisect_exponent(sources, entropy=9.9) < 0.001
    with pytest.raises(ValueError):
        M.bisect_exponent(sources)


def test_readings_are_permutations_of_blocks(spark):
    docs = corpus(spark)
    got = M.readings(docs, max_repeats=2.5).collect()
    copies = {r["doc_id"]: r["__copies"] for r in M.mix(docs, max_repeats=2.5).collect()}
    assert Counter(r["doc_id"] for r in got) == copies
    by = defaultdict(list)
    for r in sorted(got, key=lambda r: (str(r["source"]), r["__epoch"], r["__rank"], r["__place"])):
        by[r["source"], r["__epoch"]].append(r)
    for (source, epoch), rows in by.items():
        every = sorted(r["doc_id"] for r in docs.collect() if r["source"] == source)
        places = [(r["__rank"], r["__place"]) for r in rows]
        assert len(set(places)) == len(places)
        if epoch:  # a whole permutation
            assert sorted(r["doc_id"] for r in rows) == every
            ranks = {p[0] for p in places}
            assert ranks == set(range(1, len(ranks) + 1))
            assert all({p for q, p in places if q == k} == set(range(1, sum(q == k for q, _ in places) + 1)) for k in ranks)
        else:  # whole blocks first, then the beginning of the next one
            assert set(r["doc_id"] for r in rows) < set(every)
    two = [[r["doc_id"] for r in by["c", e]] for e in (1, 2)]
    assert sorted(two[0]) == sorted(two[1]) and two[0] != two[1]  # each epoch has an order of its own


def test_edges(spark, edge_docs, no_docs):
    mixed = M.mixed(edge_docs, max_repeats=1.5)
    assert mixed.columns == edge_docs.columns
    whole, got = (Counter((r["doc_id"], r["text"]) for r in x.collect()) for x in (edge_docs, mixed))
    assert set(got) == set(whole) and all(got[k] >= n for k, n in whole.items())
    assert M.readings(no_docs, max_repeats=1.5).count() == 0 and M.readings(edge_docs, max_repeats=1.5).count() == mixed.count()
    assert M.mixed(no_docs, max_repeats=1.5).count() == 0 and M.mix(no_docs, entropy=1.0).count() == 0
    one = documents(spark, [(1, "x"), (2, None), (2, None)])
    assert sorted(r["__copies"] for r in M.mix(one, max_repeats=3).collect()) == [1, 1, 1]
