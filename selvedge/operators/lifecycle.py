"""Active and historic products, event counters and tags, as functions from tables to new tables.

The order that keeps them consistent: to_historic, delete_inactive, update_active, append_new.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from selvedge.functions import arrays as A
from selvedge.operators import dml
from selvedge.schemas import COUNTERS


def to_historic(active: DataFrame, historic: DataFrame, today: DataFrame, day: Column) -> DataFrame:
    """historic with the active products that today's feed lacks: counters are added where known, new rows inserted, both dated with day."""
    gone = dml.delete_in(active, today, ["product_id"]).withColumn("execution_date", day)
    known = dml.merge_add(historic, gone, ["product_id"], COUNTERS)
    dated = dml.merge_update(known, gone, ["product_id"], ["execution_date"])
    return dml.merge_insert(dated, gone, ["product_id"])


def delete_inactive(active: DataFrame, today: DataFrame) -> DataFrame:
    return dml.keep_in(active, today.select("product_id").distinct(), ["product_id"])


def update_active(active: DataFrame, today: DataFrame) -> DataFrame:
    """active with today's values in every column that both have."""
    return dml.merge_update(active, dml.last_per_key(today, ["product_id"]), ["product_id"])


def append_new(active: DataFrame, today: DataFrame, embeddings: DataFrame) -> DataFrame:
    """active and today's new products that have an embedding, with counters at zero."""
    new = dml.last_per_key(today, ["product_id"]).join(embeddings, "product_id").withColumns({c: F.lit(0) for c in COUNTERS})
    return dml.merge_insert(active, new, ["product_id"])


EVENT_COUNTERS = {"n_views": ("fave", "trash"), "n_likes": ("fave",), "n_add_to_cart": ("bag",)}


def event_increments(events: DataFrame, excluded_users: Sequence[int] = (), kinds: dict[str, Sequence[str]] = EVENT_COUNTERS) -> DataFrame:
    """product_id and how often each counter's events occurred, without the excluded users."""
    rows = events.where(F.col("product_id").isNotNull())
    if excluded_users:
        rows = rows.where(~F.coalesce(F.col("user_id").isin(*excluded_users), F.lit(False)))
    return dml.increments(rows, ["product_id"], {c: F.col("event").isin(*k) for c, k in kinds.items()})


def add_event_counts(active: DataFrame, increments: DataFrame) -> DataFrame:
    return dml.merge_add(active, increments, ["product_id"], list(EVENT_COUNTERS))


def top_products(active: DataFrame, n: int, min_views: int = 1) -> DataFrame:
    """product_id of the n products with the most likes and cart additions per view; ties by the smaller id."""
    rate = F.try_divide(F.col("n_likes") + F.col("n_add_to_cart"), F.col("n_views"))
    return active.where(F.col("n_views") >= min_views).select("product_id", rate.alias("_rate")).orderBy(F.desc_nulls_last("_rate"), "product_id").limit(n).select("product_id")


def tagged(active: DataFrame, keys: DataFrame, tag: str) -> DataFrame:
    """active with the tag added to product_tags of the products in keys, once."""
    marked = active.join(keys.select("product_id").distinct().withColumn("_hit", F.lit(True)), "product_id", "left")
    tags = F.when(F.col("_hit"), F.array_union("product_tags", A.strings(tag))).otherwise(F.col("product_tags"))
    return marked.withColumn("product_tags", tags).select(*active.columns)


def tag_new(active: DataFrame, day: Column, days: int, tag: str = "new_product") -> DataFrame:
    return dml.update_where(active, F.col("execution_date") > F.date_sub(day, days), product_tags=F.array_union("product_tags", A.strings(tag)))


def deactivated(live: DataFrame, current: DataFrame, flag: str = "is_active") -> DataFrame:
    """live after an upsert of current, with the flag off for every key that current lacks."""
    merged = dml.upsert(live, current.withColumn(flag, F.lit(True)), ["product_id"])
    here = current.select("product_id").distinct().withColumn("_here", F.lit(True))
    return merged.join(here, "product_id", "left").withColumn(flag, F.coalesce("_here", F.lit(False))).select(*live.columns)
