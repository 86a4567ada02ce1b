"""MERGE, UPDATE, DELETE and INSERT as functions from tables to the new table.

Keys of a source are expected unique; `last_per_key` makes them so. Null keys match nothing.
Where a target is much larger than its source, the joins below shuffle the target by key once;
a caller that keeps the target bucketed by key saves that.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_per_key(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One whole row per key: the first by order. Deterministic if order is total; with no order, by all columns."""
    by = order or tuple(F.col(f"`{c}`").desc_nulls_last() for c, t in df.dtypes if not t.startswith(("map", "variant")))
    return df.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).where("_place = 1").drop("_place")


def merge_insert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """target and the rows of source whose key it lacks."""
    new = source.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new.select(*source.columns), allowMissingColumns=True).select(*target.columns)


def merge_update(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """target with the columns taken from source where the key is there, nulls included."""
    columns = [c for c in (columns or source.columns) if c not in keys and c in target.columns]
    found = source.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_found"))
    joined = target.join(found, list(keys), "left")
    return joined.select(*[F.when(F.col("_found"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns])


def merge_add(target: DataFrame, source: DataFrame, keys: Sequence[str], counters: Sequence[str], insert: bool = False) -> DataFrame:
    """target with source's counters added where the key is there, and with insert the other rows of source."""
    more = source.select(*keys, *[F.col(c).alias(f"_add_{c}") for c in counters])
    kinds = dict(target.dtypes)
    joined = target.join(more, list(keys), "left")
    added = joined.select(*[(F.coalesce(F.col(c), F.lit(0)) + F.coalesce(F.col(f"_add_{c}"), F.lit(0))).cast(kinds[c]).alias(c) if c in counters else F.col(c) for c in target.columns])
    return merge_insert(added, source, keys) if insert else added


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """source, and the rows of target whose key it lacks: the same applied twice changes nothing."""
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(source, allowMissingColumns=True).select(*target.columns)


def delete_in(target: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return target.join(keys.select(*on), list(on), "left_anti").select(*target.columns)


def keep_in(target: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return target.join(keys.select(*on), list(on), "left_semi").select(*target.columns)


def not_in(target: DataFrame, column: str, values: DataFrame, value: str, guard: bool = True) -> DataFrame:
    """SQL's NOT IN: rows with a null in column go, unless there is no value at all.

    With guard, nulls among the values are ignored; without it, one of them removes every row,
    as SQL has it. Written as an anti join on the non-null values, so it needn't be broadcast.
    """
    kinds = {r[0] for r in values.select(F.col(value).isNull()).distinct().collect()}  # two rows at most
    if not kinds or (guard and False not in kinds):
        return target
    if not guard and True in kinds:
        return target.where(F.lit(False))
    known = values.where(F.col(value).isNotNull()).select(F.col(value).alias(column)).distinct()
    return target.where(F.col(column).isNotNull()).join(known, column, "left_anti").select(*target.columns)


def update_where(target: DataFrame, condition: Column, **values: Column) -> DataFrame:
    return target.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()})


def move_rows(source: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """(moved, kept): the rows that fulfil the condition, and all others, those where it is null included."""
    sure = F.coalesce(condition, F.lit(False))
    return source.where(sure), source.where(~sure)


def truncate_insert(source: DataFrame, columns: Sequence[str], condition: Column | None = None, distinct_on: Sequence[str] | None = None) -> DataFrame:
    rows = source.where(condition) if condition is not None else source
    return (last_per_key(rows, distinct_on) if distinct_on else rows).select(*columns)


def staging_to_live(live: DataFrame, staging: DataFrame, mode: str, keys: Sequence[str] = ()) -> DataFrame:
    """The live table after a staging table was applied: WRITE_TRUNCATE, REPLACE_TABLE or UPSERT."""
    if mode == "UPSERT":
        return upsert(live, staging, keys)
    if mode in ("WRITE_TRUNCATE", "REPLACE_TABLE"):
        return staging.select(*live.columns) if mode == "WRITE_TRUNCATE" else staging
    raise ValueError(f"unknown mode {mode}")


def increments(df: DataFrame, keys: Sequence[str], counters: dict[str, Column]) -> DataFrame:
    """keys and how many rows fulfil each condition, in one aggregation; keys without any go."""
    counted = df.groupBy(*keys).agg(*[F.count_if(c).alias(n) for n, c in counters.items()])
    return counted.where(reduce(lambda a, b: a | b, [F.col(n) > 0 for n in counters]))
