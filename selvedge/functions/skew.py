"""Joins that hold when one key has a large part of all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, keys: list[str], one_in: int = 200) -> list[Row]:
    """The key combinations that hold more than one row in one_in: by counting, fewer than one_in of them.

    The counts are partially aggregated before their shuffle, so a hot key costs one row per
    task. Usually there is none, which the largest count tells in one pass. Tables of fewer
    than 1000 * one_in rows need no spreading and have none.
    """
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    counts = df.where(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    total, most = counts.agg(F.sum("_rows"), F.max("_rows")).first()
    least = max(total or 0, one_in * 1000) / one_in
    return counts.where(F.col("_rows") > least).select(*keys).collect() if most and most > least else []


def broadcast_if_small(df: DataFrame, most: int = 200_000) -> DataFrame:
    """df, marked for broadcast if it has no more than `most` rows; else as it is, to be joined by exchange.

    It is counted up to that bound, so it should be cheap to compute or checkpointed.
    """
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def spread_for_cpu(df: DataFrame) -> DataFrame:
    """df in as many partitions as there are cores, if it has fewer: for steps that cost far more time than bytes.

    Files of a few megabytes are one partition each, however much work their rows make. Tables
    of more partitions than cores, so all large ones, stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def join_unique(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner", one_in: int = 200, salts: int = 64, hot: list[Row] | None = None) -> DataFrame:
    """big joined to small, which has at most one row per key (inner, left, left_semi or left_anti).

    Rows of hot keys are spread over `salts` values of an extra join key, and small's rows of
    those keys (fewer than one_in, by counting) are repeated that often; all other rows keep
    salt 0. The hot keys are the only thing broadcast. big should not hold a large group of
    rows that are equal in every column, because the salt comes from the row's content.
    Null keys match nothing; with a left join they are spread as well. To find the hot keys big
    is computed once more: it should be cheap or kept, or `hot` give the hot keys of the kept
    table it comes from.
    """
    found = hot_keys(big, keys, one_in) if hot is None else hot
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c, t in big.dtypes if not t.startswith(("map", "variant"))]), F.lit(salts)).cast("int")
    if not found:
        left = big.withColumn("_salt", F.when(any_null, spread).otherwise(F.lit(0)))
        return left.join(small.withColumn("_salt", F.lit(0)), [*keys, "_salt"], how).drop("_salt")
    marked = F.broadcast(big.sparkSession.createDataFrame(found, big.select(*keys).schema).withColumn("_hot", F.lit(True)))
    left = big.join(marked, keys, "left").withColumn("_salt", F.when(F.col("_hot") | any_null, spread).otherwise(F.lit(0))).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = small.join(marked, keys, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def join_spread(left: DataFrame, right: DataFrame, keys: list[str], one_in: int = 200, salts: int = 32, tasks: int | None = None) -> DataFrame:
    """Inner join of two tables that may both have many rows of a key.

    Rows of left with a hot key (see hot_keys) are spread over `salts` values by their content,
    and right's rows of those keys are copied to each, so the pairs of a hot key are made by
    that many tasks. Null keys match nothing. The number of tasks follows the bytes that are
    joined, unless `tasks` is given, for results far larger than the tables.
    """
    found = hot_keys(left, keys, one_in)
    parted = lambda df, *more: df.repartition(tasks, *keys, *more) if tasks else df
    if not found:
        return parted(left).join(parted(right), keys)
    marked = F.broadcast(left.sparkSession.createDataFrame(found, left.select(*keys).schema).withColumn("_hot", F.lit(True)))
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c, t in left.dtypes if not t.startswith(("map", "variant"))]), F.lit(salts)).cast("int")
    a = left.join(marked, keys, "left").withColumn("_salt", F.when(F.col("_hot"), spread).otherwise(F.lit(0))).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    b = right.join(marked, keys, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return parted(a, "_salt").join(parted(b, "_salt"), [*keys, "_salt"]).drop("_salt")
