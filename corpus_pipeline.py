"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes what its predecessor kept, written as Parquet and read again,
and works on all of it. All stages but the last return the columns of
``documents``; the last returns one row per packed piece. Null, empty and
repeated rows are handled as each operator's docstring says; an empty table
stays empty. A stage keeps all columns of its input, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from linefold.llm import line_dedup, mixing, packing, quality_rules, simhash
from linefold.llm.common import table, written

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: every source is read at least once, so mixing drops nothing, and at most so often
MAX_REPEATS = 1.5
SEQUENCE = 2048


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that occur earlier, exactly or one edit apart."""
    return line_dedup.keep_unique_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one(docs, shingle=3, radius=2)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as the temperature mix of their sources asks."""
    return mixing.mixed(docs, max_repeats=MAX_REPEATS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in training sequences."""
    return packing.pack(docs, TOKENIZER, capacity=SEQUENCE)


STAGES = [("quality rules", rules), ("line dedup", lines), ("simhash near-dedup", near_duplicates), ("mixing", mix), ("best-fit packing", pack)]

#: The shingle hash and the tokenizer have no SQL form; the pipeline is tested
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage{k}-{name.replace(' ', '-')}")
    return docs
