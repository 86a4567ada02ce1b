"""What changed between full snapshots of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_rows(df: DataFrame, keys: list[str], loaded: str, payload: dict[str, Column]) -> DataFrame:
    """One row per keys: the one loaded last, of equally late ones the one with the larger payload.

    A mergeable maximum, taken before the shuffle too, so a hot key leaves one row per task.
    """
    present = df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    last = F.max(F.struct(F.col(loaded).alias("_loaded"), *[c.alias(n) for n, c in payload.items()])).alias("_last")
    return present.groupBy(*keys).agg(last).select(*keys, *[F.col(f"_last.{n}").alias(n) for n in payload])


def diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """keys and change_kind (added, removed, changed) of the rows in which two tables differ.

    Both have the same columns and one row per keys. EXCEPT ALL in either direction removes the
    rows that are identical (null equals null there and differs from any value); only what is
    left is joined, by key. Two empty tables have no difference.
    """
    gone, come = old.select(*new.columns).exceptAll(new), new.exceptAll(old.select(*new.columns))
    a, b = gone.select(*keys, F.lit(True).alias("_old")), come.select(*keys, F.lit(True).alias("_new"))
    kind = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").otherwise("changed")
    return a.join(b, keys, "full").select(*keys, kind.alias("change_kind"))


def consecutive_diff(states: DataFrame, time: str, keys: list[str]) -> DataFrame:
    """diff of each snapshot against the one before, dated by the newer, for all snapshots in one pass.

    The list of snapshot times (one row per delivery, so a few thousand over decades) is the
    only thing ordered in one place and broadcast.
    """
    times = states.select(time).distinct()
    steps = times.select(F.col(time), F.lead(time).over(Window.orderBy(time)).alias("_next"), F.lag(time).over(Window.orderBy(time)).alias("_before"))
    timed = states.join(F.broadcast(steps), time)
    old = timed.where("_next IS NOT NULL").withColumn(time, F.col("_next")).drop("_next", "_before")
    new = timed.where("_before IS NOT NULL").drop("_next", "_before")
    return diff(old, new, [time, *keys])
