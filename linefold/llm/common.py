"""Helpers shared by the operators of this package."""

from __future__ import annotations

import gc
import sys
import types
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linefold.session import checkpoint_root


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read back.

    Cuts the lineage at a table that survives lost executors, and fixes what a
    recomputation could change (row ids, order of ties). The files belong to
    the caller's run and stay until its checkpoint folder is cleared.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    # Nothing reads this step's shuffle files again, but Spark keeps them until
    # the driver has collected the plan: first Python lets go of it, then the JVM.
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(col: str, buckets: int) -> Column:
    """crc32 of the id's decimal text, modulo ``buckets`` (null id: null)."""
    return F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(buckets))


def worker_cache(name: str) -> dict:
    """A dict that lives as long as this Python worker, whichever tasks it
    runs (module globals travel with each plan and start anew)."""
    holder = sys.modules.setdefault("linefold_worker_cache", types.ModuleType("linefold_worker_cache"))
    return holder.__dict__.setdefault(name, {})


def under_own_names(docs: DataFrame, work: Callable[..., DataFrame], **columns: str) -> DataFrame:
    """The rows of ``docs`` that ``work`` gives, columns as they came.

    ``work`` gets ``docs`` with neutral column names, so that no column of the
    caller can meet one of its own, and under their keywords the names that
    ``columns`` have there. What it adds is dropped.
    """
    names = [f"__c{k}" for k in range(len(docs.columns))]
    at = dict(zip(docs.columns, names))
    return work(docs.toDF(*names), **{k: at.get(c, c) for k, c in columns.items()}).select(*names).toDF(*docs.columns)


def sum_of(cols: list[Column]) -> Column:
    out = cols[0]
    for c in cols[1:]:
        out = out + c
    return out


__all__ = ["written", "table", "fold", "worker_cache", "under_own_names", "sum_of"]
