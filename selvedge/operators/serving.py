"""Tables for serving: price history and drops, edges, counts, differences for a search index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from selvedge.operators import dml
from selvedge.operators.history import cents


def price_history(history: DataFrame, products: DataFrame, day: Column) -> DataFrame:
    """history with today's sale price of each product, replacing one of the same day."""
    today = products.where("product_id IS NOT NULL").select("product_id", day.alias("execution_date"), F.col("product_sale_price").cast("double").alias("product_price"))
    return dml.upsert(history.select("product_id", "execution_date", "product_price"), dml.last_per_key(today, ["product_id", "execution_date"]), ["product_id", "execution_date"])


def price_drops(faves: DataFrame, history: DataFrame, products: DataFrame, since: Column, absolute: int, share: float, least: int, lag_days: int = 1) -> DataFrame:
    """user_id, product_id, old_cents, new_cents, since_date: saved products that cost less now than when they were saved.

    Compared is the price `lag_days` before the day of the fave, for faves after `since`, with
    the current sale price, all in whole cents: it fell by `absolute` or by `share`, and by
    `least` anyway. since_date is the first day in the history with the current price. Repeated
    observations of a day count with their highest price, repeated faves once each day.
    """
    obs = history.select("product_id", "execution_date", cents("product_price").alias("c")).where("product_id IS NOT NULL AND execution_date IS NOT NULL AND c IS NOT NULL")
    obs = obs.groupBy("product_id", "execution_date").agg(F.max("c").alias("c"))
    saved = faves.where("product_id IS NOT NULL AND user_id IS NOT NULL").select("user_id", "product_id", F.date_sub(F.to_date(F.timestamp_seconds("event_timestamp")), lag_days).alias("execution_date")).where(F.col("execution_date") > since).distinct()
    now = products.select("product_id", cents("product_sale_price").alias("new_cents")).where("new_cents IS NOT NULL")
    old = saved.join(obs, ["product_id", "execution_date"]).join(now, "product_id").withColumnRenamed("c", "old_cents")
    fell = ((F.col("old_cents") >= F.col("new_cents") + absolute) | (F.col("old_cents") * (1 - share) >= F.col("new_cents"))) & (F.col("old_cents") >= F.col("new_cents") + least)
    first = obs.join(now, "product_id").where("c = new_cents").groupBy("product_id").agg(F.min("execution_date").alias("since_date"))
    hit = old.where(fell).groupBy("user_id", "product_id", "new_cents").agg(F.max("old_cents").alias("old_cents"))
    return hit.join(first, "product_id").select("user_id", "product_id", "old_cents", "new_cents", "since_date")


def board_entries(drops: DataFrame, boards: DataFrame) -> DataFrame:
    """board_id, product_id, last_modified_timestamp: the drops on every board of their user, dated by the day of the price."""
    return drops.join(boards, "user_id").select("board_id", "product_id", (F.unix_date("since_date").cast("long") * 86400).alias("last_modified_timestamp"))


def refreshed_boards(boards: DataFrame, entries: DataFrame) -> DataFrame:
    """boards with last_modified_timestamp raised to that of their latest entry."""
    last = entries.groupBy("board_id").agg(F.max("last_modified_timestamp").alias("_last"))
    return boards.join(last, "board_id", "left").withColumn("last_modified_timestamp", F.coalesce("_last", "last_modified_timestamp")).select(*boards.columns)


def label_edges(edges: DataFrame, products: DataFrame, column: str, name: str) -> DataFrame:
    """edges (product_id, name) with those of the given products replaced by their current labels."""
    new = products.select("product_id", F.explode(column).alias(name)).distinct()
    return dml.delete_in(edges, products.select("product_id").distinct(), ["product_id"]).unionByName(new)


def tag_edges(live: DataFrame, edges: DataFrame, tags: DataFrame, active: DataFrame) -> DataFrame:
    """live product-tag edges after an export: those of active products are replaced by their edges to existing tags."""
    valid = dml.keep_in(edges.where("product_id IS NOT NULL"), tags, ["smart_tag_id"]).select("product_id", "smart_tag_id").distinct()
    return dml.upsert(dml.delete_in(live.select("product_id", "smart_tag_id"), active, ["product_id"]), valid, ["product_id", "smart_tag_id"])


def counts(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name))


def tagged_with(df: DataFrame, tag: str) -> DataFrame:
    return df.where(F.array_contains("product_tags", tag)).select("product_id").distinct()


def index_changes(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """key, action (upsert or delete): what brings a search index from old to new documents."""
    gone = old.select(key).distinct().join(new.select(key), key, "left_anti").withColumn("action", F.lit("delete"))
    same = new.select(*old.columns).intersect(old) if set(old.columns) <= set(new.columns) else old.limit(0)
    return new.select(key).distinct().join(same.select(key), key, "left_anti").withColumn("action", F.lit("upsert")).unionByName(gone)


def joined_names(df: DataFrame, key: str, column: str, separator: str = ",_,") -> DataFrame:
    """key and the distinct, sorted values of a column as one text."""
    return df.groupBy(key).agg(F.concat_ws(separator, F.array_sort(F.collect_set(column))).alias(column))
