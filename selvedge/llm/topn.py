"""Top N items within every group, by a mergeable aggregation with a bounded heap per group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows that a task holds before it cuts its heaps down to N; if that frees less than half, the heaps go out and it starts anew.
BUFFER_ROWS = 400_000


def _cut(t: pa.Table, n: int) -> pa.Table:
    """The n best distinct items of each group: score descending, then item descending."""
    groups, _ = pd.factorize(t["group"].to_numpy(zero_copy_only=False))
    items, scores = t["item"].to_numpy(), t["score"].to_numpy()
    order = np.lexsort((-scores, items, groups))
    g, i = groups[order], items[order]
    first = np.ones(len(g), bool)
    first[1:] = (g[1:] != g[:-1]) | (i[1:] != i[:-1])
    order = order[first]  # each item once, with its highest score
    order = order[np.lexsort((~items[order], -scores[order], groups[order]))]  # ~ turns the order of integers round
    g = groups[order]
    starts = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.array([], int)
    place = np.arange(len(g)) - np.repeat(starts, np.diff(np.r_[starts, len(g)]))
    return t.take(pa.array(order[place < n]))


def _heaps(n: int):
    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for b in batches:
            held.append(b)
            rows += b.num_rows
            if rows >= BUFFER_ROWS:
                best = _cut(pa.Table.from_batches(held).combine_chunks(), n)
                if best.num_rows * 2 > rows:  # many small groups: hand the heaps on, they merge later
                    yield from best.to_batches()
                    held, rows = [], 0
                else:
                    held, rows = best.combine_chunks().to_batches(), best.num_rows
        if held:
            yield from _cut(pa.Table.from_batches(held).combine_chunks(), n).to_batches()

    return combine


def top_items(df: DataFrame, group: str, item: str, score: str, n: int = 10) -> DataFrame:
    """group, place (1 to n), item, score: the n items with the highest score of each group.

    Null and NaN scores, null items and null groups do not take part. An item counts once, with
    its highest score; equal scores are ordered by the larger item first. Each task keeps the n
    best items per group of its rows before the shuffle, so a group of any size arrives as at
    most n rows per task (or per BUFFER_ROWS rows); merging keeps the same rule. Correct because
    an item outside a task's n best has n others before it in the whole group too. One shuffle,
    by group. Items are longs; an empty table gives an empty result.
    """
    rows = df.select(F.col(group).alias("group"), F.col(item).cast("long").alias("item"), F.col(score).cast("double").alias("score"))
    rows = rows.where("group IS NOT NULL AND item IS NOT NULL AND score IS NOT NULL AND NOT isnan(score)")
    # 0.0 and -0.0 are one score
    rows = rows.withColumn("score", F.col("score") + F.lit(0.0))
    local = rows.mapInArrow(_heaps(n), rows.schema)
    met = local.repartition("group").groupBy("group", "item").agg(F.max("score").alias("score"))
    best = Window.partitionBy("group").orderBy(F.desc("score"), F.desc("item"))
    return met.withColumn("place", F.row_number().over(best)).where(F.col("place") <= n).select("group", "place", "item", "score")
