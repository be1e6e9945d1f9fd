"""Reading feeds and dimensions, writing the stage, rejects and fact.

* Reads are plain ``spark.read.parquet`` (or ``spark.table``) with a declared
  schema where one is known: Catalyst prunes columns and pushes filters into
  the scan; a window on ``ingest_date`` prunes partitions.
* Writes go to folders under a shared root. Tables that are read and
  rewritten in one pass (the rejects) are versioned: each pass writes a new
  folder, so no job overwrites what it reads, and a re-run after a lost
  executor or a failed pass rewrites its own folder only.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import hashlib
import os
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from linefold.functions.columns import lit_date
from linefold.functions.timewin import day_before
from linefold.session import checkpoint_root


def read_table(spark: SparkSession, name_or_path: str, schema: StructType | str | None = None) -> DataFrame:
    """A catalog table by name, else a Parquet folder or file."""
    if "/" not in name_or_path and spark.catalog.tableExists(name_or_path):
        return spark.table(name_or_path)
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(name_or_path)


def read_window(spark: SparkSession, path: str, since: dt.date | None,
                ingest_date: str = "ingest_date") -> DataFrame:
    """Partition-limited scan, ``ingest_date >= since - 1``."""
    df = read_table(spark, path)
    if since is not None and ingest_date in df.columns:
        df = df.filter(F.col(ingest_date) >= lit_date(day_before(since)))
    return df


def overwrite(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> str:
    """Create or replace the table at ``path``."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the session's checkpoint folder and read back:
    computed once for several readers, lineage cut. The files are read lazily,
    so they stay until ``remove_scratch``."""
    spark = df.sparkSession
    path = os.path.join(scratch(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return read_table(spark, path, df.schema)


def written_bucketed(df: DataFrame, name: str, by: str) -> DataFrame:
    """``written``, in buckets of the column ``by``, one for each partition of a
    shuffle: rows dealt by it are dealt so when they are read again, and joins on
    it shuffle the other side only. The catalog knows the table while it is
    written; nothing stays there."""
    spark = df.sparkSession
    table = f"linefold_{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, by).option("path", os.path.join(scratch(spark), table)).saveAsTable(table, format="parquet")
    try:
        return spark.table(table)
    finally:
        spark.sql(f"DROP TABLE {table}")  # of the catalog: the files are the folder's


def scratch(spark: SparkSession) -> str:
    """The folder of this application's scratch tables."""
    return os.path.join(checkpoint_root(spark), "linefold-work", spark.sparkContext.applicationId)


def remove_scratch(spark: SparkSession) -> None:
    """Delete the tables that ``written`` made in this application; for when
    the results that read them have been used."""
    remove(spark, scratch(spark))


def assert_unique(df: DataFrame, keys: tuple[str, ...], name: str) -> DataFrame:
    """``df``, or an error if a lookup has two rows for a key (a join to it
    would multiply lines)."""
    twice = df.dropna(subset=list(keys)).groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"lookup {name} is not unique on {', '.join(keys)}: {twice[0].asDict()}")
    return df


def replace_partitions(df: DataFrame, path: str, columns: tuple[str, ...], partition_by: tuple[str, ...],
                       cluster_by: tuple[str, ...] = ()) -> str:
    """S9, idempotent: the rows of ``df``, by name, in place of what the
    partitions that they fall in hold.

    Without ``cluster_by`` rows are rebalanced on the partition columns, so
    Spark sizes the files by bytes, whatever a day holds. With it they are dealt
    by range of partition and ``cluster_by`` columns and sorted by them: the
    files of a partition hold disjoint ranges, and so do the row groups of a
    file, so a lookup by the first of them reads few by their statistics. The
    ranges are found by a sample, so ``df`` should be a table, not a long plan.
    """
    out = df.select(*columns)
    if cluster_by:
        order = [F.col(c) for c in (*partition_by, *cluster_by)]
        out = out.repartitionByRange(*order).sortWithinPartitions(*order)
    else:
        out = out.hint("rebalance", *[F.col(c) for c in partition_by])
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    return path


def append_run(df: DataFrame, path: str, columns: tuple[str, ...], run_id: str,
               partition_by: tuple[str, ...] = ("order_date",), run_col: str = "load_run",
               cluster_by: tuple[str, ...] = ()) -> str:
    """S9, idempotent: append the rows of one pass under ``run_col=run_id``,
    clustered as in ``replace_partitions``.

    Re-running a pass after a failure replaces exactly the partitions
    (``partition_by``, ``run_col``) of that pass, so the fact never holds a
    pass twice; other passes' partitions are untouched.
    """
    run = df.select(*columns).withColumn(run_col, F.lit(run_id))
    return replace_partitions(run, path, (*columns, run_col), (*partition_by, run_col), cluster_by)


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str | None) -> Iterator[None]:
    """A session setting for a while; None leaves it as it is."""
    before = spark.conf.get(key, None)
    if value is not None:
        spark.conf.set(key, value)
    try:
        yield
    finally:
        if value is not None and before is None:
            spark.conf.unset(key)
        elif value is not None:
            spark.conf.set(key, before)


def bucketed_table(spark: SparkSession, path: str, schema: str, partition_by: tuple[str, ...], bucket_by: str, buckets: int) -> str:
    """The name of a catalog table over the folder ``path``, its rows dealt
    into ``buckets`` by ``bucket_by`` and sorted by it within a file.

    Joins on ``bucket_by`` read such a table without a shuffle. The folder is
    the table: the catalog entry is made where it is missing (a catalog may
    forget it) and takes up the partitions that are there. Each partition has a
    file per bucket, and one value's rows are one bucket: for a table of
    large partitions and of keys none of which is hot.
    """
    name = f"linefold_{hashlib.sha256(f'{path} {schema} {buckets}'.encode()).hexdigest()[:16]}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet PARTITIONED BY ({', '.join(partition_by)}) "
              f"CLUSTERED BY ({bucket_by}) SORTED BY ({bucket_by}) INTO {buckets} BUCKETS LOCATION '{path}'")
    if exists(spark, path):
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)
    return name


def append_bucketed(df: DataFrame, name: str, run_id: str, run_col: str = "load_run") -> str:
    """``append_run`` for a table of ``bucketed_table``: the rows of one pass in
    place of those that its partitions hold."""
    spark = df.sparkSession
    rows = df.withColumn(run_col, F.lit(run_id)).select(*spark.table(name).columns)
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):  # insertInto has no such option
        rows.write.mode("overwrite").insertInto(name)
    return name


def compact(spark: SparkSession, path: str, schema: StructType | str, columns: tuple[str, ...], before: dt.date,
            date_col: str = "order_date", run_col: str = "load_run", run_id: str = "compacted",
            cluster_by: tuple[str, ...] = ()) -> int:
    """Put the passes of each closed day (before ``before``) into one folder;
    returns the number of folders removed.

    The rows are written to a folder beside the table first and the new
    partitions from there, so a failure at any point loses nothing. Readers
    must wait: between the two steps rows are in the table twice.
    """
    closed = read_table(spark, path, schema).filter(F.col(date_col) < lit_date(before))
    days = closed.groupBy(date_col).agg(F.collect_set(run_col).alias("runs")).filter(F.size("runs") > 1).collect()
    if not days:
        return 0
    beside = path.rstrip("/") + "-compacting"
    rows = closed.filter(F.col(date_col).isin([r[date_col] for r in days]))
    rows.write.mode("overwrite").parquet(beside)
    append_run(read_table(spark, beside, schema), path, columns, run_id, (date_col,), run_col, cluster_by)
    old = [f"{path}/{date_col}={r[date_col]}/{run_col}={x}" for r in days for x in r["runs"] if x != run_id]
    remove(spark, *old, beside)
    return len(old)


def version_path(root: str, name: str, run_id: str) -> str:
    return os.path.join(root, name, f"run={run_id}")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists (Hadoop file system of the session)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, in one step for readers: written beside its place and renamed."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place, beside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    fs = place.getFileSystem(conf)
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.delete(place, False)
    if not fs.rename(beside, place):
        raise OSError(f"cannot rename {beside} to {place}")


def read_text(spark: SparkSession, path: str) -> str:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(conf).open(place)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete folders (Hadoop file system of the session)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        folder = jvm.org.apache.hadoop.fs.Path(p)
        folder.getFileSystem(conf).delete(folder, True)


__all__ = ["read_table", "read_window", "overwrite", "written", "written_bucketed", "assert_unique", "replace_partitions", "append_run", "bucketed_table",
           "append_bucketed", "compact",
           "version_path", "exists", "remove", "remove_scratch", "setting", "read_text", "write_text"]
