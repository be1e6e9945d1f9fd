import numpy as np
from pyspark.sql import functions as F

from llm_data import documents, prose
from linefold.llm import quality_rules as Q


def test_rules_adapt_to_each_source(spark):
    # marks are usual in source "code" and odd in source "prose"
    marked = lambda k: prose(k, 60).replace(" ", " # ")
    rows = [(k, prose(k, 60 + k % 50), "en", "prose") for k in range(150)] + [(200 + k, marked(k), "en", "code") for k in range(150)]
    rows += [(900, marked(999), "en", "prose"), (901, "too short", "en", "prose"), (902, "same words " * 60, "en", "code")]
    got = {r["doc_id"]: r for r in Q.quality_rules(documents(spark, rows)).collect()}
    assert [got[k]["reason"] for k in (900, 901, 902)] == ["word_length", "base", "base"] or got[900]["reason"] == "symbol_share"
    assert not got[900]["kept"] and not got[900]["base_failed"]
    assert all(got[r[0]]["kept"] for r in rows[:300])


def test_sketch_quantiles_are_near_exact_ones(spark):
    rng = np.random.default_rng(0)
    x = rng.lognormal(1, 1, 5000)
    rows = spark.createDataFrame([("en", f"s{k % 3}", int(v * 1e6)) for k, v in enumerate(x)], "lang string, source string, v bigint")
    rows = rows.select("lang", "source", F.col("v").alias("word_chars"), F.lit(1_000_000).alias("n_words"), F.lit(0).alias("n_symbols"),
                       F.lit(0).alias("n_dup_lines"), F.lit(1).alias("n_lines"))
    got = Q.quantiles(Q.sketches(rows), ["lang", "stat"], {"q": 0.9}).filter("stat = 'word_length'").first()
    assert got["rows"] == 5000 and abs(got["q"] / np.quantile(x, 0.9) - 1) < 0.03
    # leaf sketches merge to the sketch of all rows
    parts = [Q.sketches(rows.filter(F.col("source") == f"s{k}")) for k in range(3)]
    merged = parts[0].union(parts[1]).union(parts[2])
    assert Q.quantiles(merged, ["stat"], {"q": 0.5}).collect() == Q.quantiles(Q.sketches(rows), ["stat"], {"q": 0.5}).collect()


def test_edges(spark, edge_docs, no_docs):
    got = Q.quality_rules(edge_docs)
    rows = got.collect()
    assert len(rows) == edge_docs.count()
    assert all(not r["kept"] for r in rows if not (r["text"] or "").strip())
    kept = Q.keep_good(edge_docs)
    assert kept.columns == edge_docs.columns
    assert {r["doc_id"] for r in kept.collect()} >= {1, 2, 7, 9}
    assert kept.filter("doc_id = 2").count() == 2 and kept.first()["n_words"] == "n_words"
    assert Q.quality_rules(no_docs).count() == 0 and Q.keep_good(no_docs).columns == no_docs.columns
