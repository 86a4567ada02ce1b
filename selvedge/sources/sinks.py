"""Writers: append, overwrite, one partition, versioned tables and counters, a store, JSON documents in batches."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from selvedge.session import checkpointed


def append(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    w = df.write.mode("append")
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)


def overwrite(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    w = df.write.mode("overwrite")
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: str, condition: Column | None = None) -> None:
    """Overwrites the partitions that occur in df (and fulfil the condition), and no others."""
    rows = df.where(condition) if condition is not None else df
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path)


def insert(df: DataFrame, table: str, columns: list[str], overwrite: bool = False, condition: Column | None = None) -> None:
    rows = df.where(condition) if condition is not None else df
    rows.select(*columns).write.insertInto(table, overwrite=overwrite)


def _folders(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The numbers of the complete folders <prefix>=<number> under path, in order; Spark writes _SUCCESS last."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(conf)
    if not fs.exists(hadoop(path)):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(hadoop(path)) if s.isDirectory()]
    numbers = [int(n.partition("=")[2]) for n in names if n.startswith(f"{prefix}=")]
    return sorted(n for n in numbers if fs.exists(hadoop(f"{path}/{prefix}={n}/_SUCCESS")))


def remove(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


#: The mark of a complete folder is asked for whatever the cluster's defaults are.
MARKED = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "true"}


def swap(df: DataFrame, path: str) -> None:
    """Replaces a versioned table that df may itself read.

    The new version is a folder of its own and counts from the moment Spark has marked it as
    complete; older versions go afterwards, but for the last one, which a running reader may
    still need. Nothing is renamed, so a crash at any point leaves a whole table: the old one
    before the mark, the new one after it.
    """
    spark = df.sparkSession
    done = _folders(spark, path, "version")
    df.write.mode("overwrite").options(**MARKED).parquet(f"{path}/version={done[-1] + 1 if done else 0}")
    for old in done[:-1]:
        remove(spark, f"{path}/version={old}")


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The last complete version of a table that `swap` writes, None if there is none yet."""
    done = _folders(spark, path, "version")
    return spark.read.parquet(f"{path}/version={done[-1]}") if done else None


def add_counts(df: DataFrame, path: str, number: int, keys: list[str], compact_every: int = 20) -> None:
    """Adds the counts of batch `number` to the counters at path, once, whatever was interrupted before.

    A batch is a folder delta=<number> and costs what it holds; after compact_every of them
    their sum with the last base becomes base=<number>. `counts` sums the last complete base
    and the complete deltas after it, so folders left over by a crash change nothing.
    """
    spark = df.sparkSession
    bases, deltas = _folders(spark, path, "base"), _folders(spark, path, "delta")
    last = bases[-1] if bases else -1
    if number <= last or number in deltas:
        return
    df.write.mode("overwrite").options(**MARKED).parquet(f"{path}/delta={number}")
    open_ = [n for n in deltas if n > last] + [number]
    if len(open_) >= compact_every:
        top = max(open_)
        counts(spark, path, keys).write.mode("overwrite").options(**MARKED).parquet(f"{path}/base={top}")
        for n in bases:
            remove(spark, f"{path}/base={n}")
        for n in [*deltas, number]:
            if n <= top:
                remove(spark, f"{path}/delta={n}")


def counts(spark: SparkSession, path: str, keys: list[str]) -> DataFrame | None:
    """The counters that `add_counts` keeps at path, summed per key; None before the first batch."""
    bases, deltas = _folders(spark, path, "base"), _folders(spark, path, "delta")
    last = bases[-1] if bases else -1
    parts = [f"{path}/base={last}"] * bool(bases) + [f"{path}/delta={n}" for n in deltas if n > last]
    if not parts:
        return None
    rows = reduce(DataFrame.unionByName, [spark.read.parquet(p) for p in parts])
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in rows.columns if c not in keys])


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batch: int = 50_000, partitions: int | None = None, **options: str) -> None:
    """Rows into a store, in batches; partitions bounds the connections."""
    w = df.coalesce(partitions) if partitions else df
    w.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table).option("batchsize", batch).options(**options).save()


def documents(df: DataFrame, constants: dict[str, str] | None = None) -> DataFrame:
    """One JSON document per row, dates as YYYY-MM-DD, with constant fields added."""
    rows = df.withColumns({k: F.lit(v) for k, v in (constants or {}).items()}) if constants else df
    return rows.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), {"dateFormat": "yyyy-MM-dd"}).alias("document"))


def upload(df: DataFrame, send: Callable[[list[dict]], None], batch: int = 1000) -> None:
    """Hands documents to `send` in batches, on the executors; a failing batch fails its task, which Spark repeats."""

    def run(rows: Iterator) -> None:
        held: list[dict] = []
        for r in rows:
            held.append(json.loads(r.document))
            if len(held) == batch:
                send(held)
                held = []
        if held:
            send(held)

    documents(df).foreachPartition(run)


def sync_index(new: DataFrame, old_keys: DataFrame, key: str, send: Callable[[list[dict]], None], delete: Callable[[list], None], batch: int = 300, delete_batch: int = 5000) -> None:
    """Brings a search index to the documents of new: keys it no longer has are deleted, in batches, then all documents sent.

    old_keys: the keys in the index now. Both run on the executors, whatever the size of the
    index; sending is by key, so a task that Spark repeats changes nothing.
    """
    stale = old_keys.select(key).distinct().join(new.select(key), key, "left_anti")

    def drop(rows: Iterator) -> None:
        held: list = []
        for r in rows:
            held.append(r[0])
            if len(held) == delete_batch:
                delete(held)
                held = []
        if held:
            delete(held)

    stale.foreachPartition(drop)
    upload(new, send, batch)


def replace_index(df: DataFrame, clear: Callable[[], None], send: Callable[[list[dict]], None], batch: int = 1000) -> None:
    """Empties an index, then sends it all documents of df in batches; df is computed before the index is emptied."""
    kept = checkpointed(df)
    clear()
    upload(kept, send, batch)


def ranked_documents(df: DataFrame, order: list[Column] | None = None, seed: int = 5, name: str = "rank") -> DataFrame:
    """df with a rank: its place in the order given, counted from 0, or without one a random number that depends on the row and the seed only.

    Places are counted by one sort over all rows and one count per partition, so no row has to
    pass through a single task.
    """
    if order is None:
        return df.withColumn(name, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.lit(seed)), F.lit(2**31)) / float(2**31))
    parted = df.orderBy(*order).withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    kept = checkpointed(parted)
    sizes = kept.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return kept.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_at") - F.col("_first")).select(*df.columns, name)


def write_sorted(df: DataFrame, path: str, *order: Column | str) -> None:
    """Rows in one order over all files: each file holds a range, and the files' names are in the order of the ranges."""
    df.orderBy(*order).write.mode("overwrite").parquet(path)


def document_keys(df: DataFrame, columns: list[str], name: str = "document_id") -> DataFrame:
    """df with a key hashed from columns: the same in any process."""
    return df.withColumn(name, F.abs(F.xxhash64(*columns) % F.lit(2**62)))


def write_json(df: DataFrame, path: str) -> None:
    documents(df).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    df.write.mode("overwrite").csv(path, header=True, escape='"', compression=compression, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
