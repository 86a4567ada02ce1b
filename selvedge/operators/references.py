"""References to records that do not exist, from signed counts per key.

Every table contributes change deltas: a reference adds +1 (or -1 when withdrawn) to the
reference count of the key it names, a record adds +1 (or -1 when deleted) to that key's
existence count, and a trace (an old observation of the key) to its trace count. The state
keeps the signed counts of each key; those of records also by the time of the change, so a
deletion takes back exactly what it deletes. States are added up by `merge_states`, so a new
period costs its deltas and no rescan. A key with a positive reference count and an existence
count of zero is an orphan now; one that exists, but only since after a reference was made,
was an orphan at that time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from selvedge.functions.skew import join_unique
from selvedge.session import written

COUNTS = ("n_refs", "n_records", "n_traces")


def _deltas(df: DataFrame, kind: Column, key: Column, what: str, sign: Column | None, at: Column | None = None) -> DataFrame:
    """Counts per key, added up before any shuffle: a hot key leaves one row per task."""
    rows = df.select(kind.alias("kind"), key.cast("long").alias("ref_id"), (F.lit(None) if at is None else at).cast("long").alias("at"), (F.lit(1) if sign is None else sign).cast("long").alias("_n")).where(F.col("ref_id").isNotNull())
    return rows.select("kind", "ref_id", "at", *[(F.col("_n") if c == what else F.lit(0).cast("long")).alias(c) for c in COUNTS])


def reference_deltas(refs: DataFrame, sign: Column | None = None) -> DataFrame:
    """Of references with columns kind and ref_id."""
    return _deltas(refs, F.col("kind"), F.col("ref_id"), "n_refs", sign)


def record_deltas(records: DataFrame, kind: str, key: str, at: Column, sign: Column | None = None) -> DataFrame:
    """Of records that came (or with sign -1 went) at a time in epoch seconds; a null time is before all others."""
    return _deltas(records, F.lit(kind), F.col(key), "n_records", sign, F.coalesce(at.cast("long"), F.lit(-(2**63))))


def trace_deltas(traces: DataFrame, kind: str, key: str) -> DataFrame:
    return _deltas(traces, F.lit(kind), F.col(key), "n_traces", None)


def merge_states(*parts: DataFrame) -> DataFrame:
    """The state from any number of deltas and earlier states: kind, ref_id, at and the counts.

    One row per key, and one per key and time at which its existence changed. Changes that
    cancel out leave nothing, whatever the order of the parts.
    """
    every = reduce(DataFrame.unionByName, parts)
    summed = every.groupBy("kind", "ref_id", "at").agg(*[F.sum(c).alias(c) for c in COUNTS])
    return summed.where(" OR ".join(f"{c} != 0" for c in COUNTS))


def key_states(state: DataFrame) -> DataFrame:
    """kind, ref_id, the counts, exists_from: since when the key has existed without a break, null if it does not.

    Summed over the key's changes in order of time, existence begins anew wherever the sum
    rises from zero or less.
    """
    order = Window.partitionBy("kind", "ref_id").orderBy("at")
    run = F.sum("n_records").over(order.rowsBetween(Window.unboundedPreceding, 0))
    begins = F.when((F.col("_run") > 0) & (F.col("_run") - F.col("n_records") <= 0), F.col("at"))
    summed = state.withColumn("_run", run).groupBy("kind", "ref_id").agg(*[F.sum(c).alias(c) for c in COUNTS], F.max(begins).alias("_from"))
    return summed.withColumn("exists_from", F.when(F.col("n_records") > 0, F.col("_from"))).drop("_from")


def orphan_keys(state: DataFrame) -> DataFrame:
    """key_states of the keys that are referred to without existing: the current orphans."""
    return key_states(state).where("n_refs > 0 AND n_records <= 0")


def orphan_report(refs: DataFrame, state: DataFrame) -> DataFrame:
    """Orphan references: table_name, owner_key, ref_id, period, reason.

    refs: kind, table_name, owner_key, ref_id, at (epoch seconds). reason is `late` if the key
    exists but since after the reference, `deleted` if it does not exist and has traces, else
    `missing`. A null ref_id refers to nothing and is left out; a null at has a null period and
    is never late; a null owner_key is reported as null. Repeated references give one row.
    References are reduced to one row per reported row before the join and written, since hot
    keys are looked for before the join; the join spreads keys that hold more than a
    two-hundredth of them.
    """
    period = F.date_format(F.timestamp_seconds("at"), "yyyy-MM")
    once = refs.where(F.col("ref_id").isNotNull()).groupBy("kind", "table_name", "owner_key", "ref_id", period.alias("period")).agg(F.min("at").alias("at"))
    once = written(once)
    keys = key_states(state).where("n_refs > 0").select("kind", "ref_id", "n_records", "n_traces", "exists_from")
    joined = join_unique(once, keys, ["kind", "ref_id"])
    reason = F.when(F.col("n_records") > 0, F.when(F.col("exists_from") > F.col("at"), "late")).when(F.col("n_traces") > 0, "deleted").otherwise("missing")
    return joined.select("table_name", "owner_key", "ref_id", "period", reason.alias("reason")).where("reason IS NOT NULL")
