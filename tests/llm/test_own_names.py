"""Stages of the pipeline keep every column of their input and its values,
whatever the columns are called."""

import pytest
from pyspark.sql import functions as F

from linefold.llm import line_dedup, mixing, quality_rules, simhash
from llm_data import CLASHES, documents, prose

NAMES = (*CLASHES, "word_length_low", "symbol_share_high", "base_failed", "n_dup_lines", "stat", "g_rows", "__gone", "__d", "__th", "__kept", "__removed", "__lines",
         "__fp", "__raw", "__row", "__copies", "__copy", "__source", "__of", "__block", "__blocks", "__tokens", "__hash", "__before", "__full", "__s", "__b",
         "part", "whole", "low", "root", "block_id", "__text", "__of_lang", "__lang", "__k0", "__c0", "__c1", "n chars", "a.b")
STAGES = [quality_rules.keep_good, line_dedup.keep_unique_lines, simhash.keep_one,
          lambda d: mixing.mixed(d, max_repeats=1.5)]


@pytest.mark.parametrize("stage", STAGES, ids=["rules", "lines", "simhash", "mixing"])
def test_columns_and_values_stay(spark, stage):
    rows = [(k, prose(k, 60 + k), "en", "a" if k % 2 else "b") for k in range(12)] + [(50, prose(3, 63), "en", "a"), (51, None, None, None)]
    plain = documents(spark, rows)
    wide = plain.select("*", *[F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string")).alias(n) for n in NAMES])
    got = stage(wide)
    assert got.columns == wide.columns
    back = got.collect()
    assert back and all(r[5 + k] == f"{n}:{r[0]}" for r in back for k, n in enumerate(NAMES))
    # and they change nothing else
    assert sorted(str(tuple(r)[:5]) for r in back) == sorted(str(tuple(r)) for r in stage(plain).collect())
