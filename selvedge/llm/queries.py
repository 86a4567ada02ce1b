"""Queries of the training-data problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from selvedge.llm import canonical, encoding, listings, mixing, privacy, topn
from selvedge.sources.tables import table


def _colors(spark: SparkSession, d: str) -> list[tuple[int, list[str]]]:
    return canonical.reference_names(table(spark, d, "ref_color"), "color_id", "color_name", "aliases")


def _brands(spark: SparkSession, d: str) -> list[tuple[int, list[str]]]:
    return canonical.reference_names(table(spark, d, "ref_brand"), "brand_id", "brand_name")


def _mapped_products(spark: SparkSession, d: str) -> DataFrame:
    colors, brands = _colors(spark, d), _brands(spark, d)
    lists = {"color": colors, "internal_color": colors, "product_brand": brands}
    return canonical.canonicalized(table(spark, d, "active_products"), ["product_id"], lists).where("NOT is_literal")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _mapped_products(spark, d).select("product_id", "field_name", "ref_id")


def p3_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Values that mean no entry, and how often they occur."""
    return canonical.unmatched(_mapped_products(spark, d))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    parts = []
    for kind, name, group, item in (("user", "product_recs", "user_id", "product_id"), ("advertiser", "advertiser_top_smart_tag", "advertiser_name", "smart_tag_id")):
        best = topn.top_items(table(spark, d, name), group, item, "score", 10)
        parts.append(best.select(F.lit(kind).alias("group_kind"), F.col("group").cast("string").alias("group_key"), "place", F.col("item").alias("item_id")))
    return parts[0].unionByName(parts[1])


P4_SQL = """
WITH rows AS (
  SELECT 'user' AS group_kind, CAST(user_id AS VARCHAR) AS group_key, product_id AS item_id, max(score) AS score FROM product_recs WHERE score IS NOT NULL AND NOT isnan(score) AND user_id IS NOT NULL AND product_id IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT 'advertiser', advertiser_name, smart_tag_id, max(score) FROM advertiser_top_smart_tag WHERE score IS NOT NULL AND NOT isnan(score) AND advertiser_name IS NOT NULL AND smart_tag_id IS NOT NULL GROUP BY ALL
)
SELECT group_kind, group_key, CAST(place AS INTEGER) AS place, item_id
FROM (SELECT *, row_number() OVER (PARTITION BY group_kind, group_key ORDER BY score DESC, item_id DESC) AS place FROM rows) WHERE place <= 10
"""


def _article_groups(spark: SparkSession, d: str) -> DataFrame:
    return listings.groups(table(spark, d, "product_info"), "product_id", _brands(spark, d), _colors(spark, d), ["advertiser_name"])


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return listings.pairs_between(_article_groups(spark, d), "product_id", "advertiser_name")


def p6_groups(spark: SparkSession, d: str) -> DataFrame:
    """The group of each listing, named by one number."""
    return _article_groups(spark, d).select("product_id", "component")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encoding.encode(table(spark, d, "documents"), "text", ["doc_id"])


def p8_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose decoded ids are, and are not, their text."""
    docs = table(spark, d, "documents").withColumn("whole", F.coalesce("text", F.lit("")))
    same = encoding.encode(docs, "text", ["doc_id", "whole"]).select((encoding.decoded(F.col("ids")) == F.col("whole")).alias("same"))
    return same.groupBy("same").agg(F.count(F.lit(1)).alias("n_documents"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """The documents of the largest mix that meets every share, and how often each is used; text of many characters a token is likelier."""
    return mixing.copies(mixing.sized_documents(table(spark, d, "documents")), table(spark, d, "mix_target"), "doc_id", "source", "n_tokens", weight=F.col("weight"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares(p9_mix(spark, d), table(spark, d, "mix_target"), "n_tokens")


def p9_reached(spark: SparkSession, d: str) -> DataFrame:
    """Whether each source has its target share, to a hundredth, and no document more than its repeats."""
    target = table(spark, d, "mix_target")
    got = p9_shares(spark, d).join(target.select("source", "max_repeats"), "source")
    return got.select("source", F.round("target_share", 6).alias("target_share"), (F.abs(F.col("actual_share") - F.col("target_share")) < 0.01).alias("reached"), (F.col("most_repeats") <= F.col("max_repeats")).alias("within"))


P9_REACHED_SQL = "SELECT source, round(target_share, 6) AS target_share, true AS reached, true AS within FROM mix_target"


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return privacy.extract(table(spark, d, "documents"), "text", ["doc_id"]).select("doc_id", "pii_kind", "pii_text").distinct()


def p10_redacted(spark: SparkSession, d: str) -> DataFrame:
    """The texts with placeholders that name the kind of what stood there."""
    return privacy.redact(table(spark, d, "documents"), "text", ["doc_id"])


def p10_lengths(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose redacted text is as long as the text without its pieces and with their placeholders, so that nothing else was touched."""
    docs = table(spark, d, "documents").where("text IS NOT NULL")
    cut = privacy.extract(docs, "text", ["doc_id"]).groupBy("doc_id").agg(F.sum(F.length("pii_kind") + 2 - F.length("pii_text")).alias("_more"))
    clean = privacy.redact(docs, "text", ["doc_id"]).select("doc_id", F.length("text").alias("_after"))
    both = docs.select("doc_id", F.length("text").alias("_before")).join(clean, "doc_id").join(cut, "doc_id", "left")
    return both.groupBy((F.col("_after") == F.col("_before") + F.coalesce("_more", F.lit(0))).alias("same")).agg(F.count(F.lit(1)).alias("n_documents"))


P10_LENGTHS_SQL = "SELECT true AS same, count(*) AS n_documents FROM documents WHERE text IS NOT NULL"
P8_ROUND_TRIP_SQL = "SELECT true AS same, count(*) AS n_documents FROM documents"

QUERIES = {f.__name__: f for f in (p3_found, p3_unmatched, p4_found, p6_found, p6_groups, p8_ids, p8_round_trip, p9_mix, p9_shares, p9_reached, p10_found, p10_redacted, p10_lengths)}
SQL = {"p4_found": P4_SQL, "p8_round_trip": P8_ROUND_TRIP_SQL, "p9_reached": P9_REACHED_SQL, "p10_lengths": P10_LENGTHS_SQL}
