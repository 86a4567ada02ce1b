"""Tags mined from attributes: combinations per product, supported tags, search suggestions, tags that mark an advertiser."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from selvedge.functions import arrays as A
from selvedge.functions.skew import spread_for_cpu
from selvedge.session import written

EMPTY = ("",)


def product_tags(products: DataFrame, synonyms: dict[str, list[str]], forbidden: str = "-colored") -> DataFrame:
    """product_id, product_label, suggestion, tag_words, suggestion_hash, secondary_subset, internal_color.

    Every label (or none) of a product with up to three of its attributes (secondary labels,
    colour, none), of which no later one is a synonym of an earlier one; a root is its own
    synonym. If the subset has a synonym of a root among the product's labels, that word goes
    last instead of the label; with several such roots there is a row for each. Combinations
    are made inside each row, so no self-join is needed. synonyms is held by every task. A
    suggestion with the forbidden pattern is left out.
    """
    table = {r: sorted({r, *s}) for r, s in synonyms.items()}

    def of(x: Column) -> Column:
        out = A.strings()
        for root, words in table.items():
            out = F.when(x == root, A.strings(*words)).otherwise(out)
        return out

    attributes = F.array_distinct(F.array_union(F.coalesce("product_secondary_labels", A.strings()), F.array(F.lit(""), F.coalesce("internal_color", F.lit("")))))
    keep = lambda a, b: ~F.coalesce(F.array_contains(of(a), b), F.lit(False))
    none = F.array().cast("array<array<string>>")
    triples = F.flatten(
        F.transform(
            "_at",
            lambda a: F.flatten(
                F.transform("_at", lambda b: F.when(keep(a, b), F.transform(F.filter("_at", lambda c: keep(a, c) & keep(b, c)), lambda c: F.array_distinct(F.array(a, b, c)))).otherwise(none))
            ),
        )
    )
    labels = F.array_distinct(F.array_union(F.coalesce("product_labels", A.strings()), A.strings("")))
    roots = F.filter(A.strings(*table), lambda r: F.coalesce(F.array_contains("product_labels", r), F.lit(False)))
    roots = F.when(F.size(roots) > 0, roots).otherwise(F.array(F.lit(None).cast("string")))
    base = spread_for_cpu(products.select("product_id", "internal_color", "product_labels", "product_secondary_labels")).withColumn("_at", attributes)
    subsets = base.select("product_id", "internal_color", "product_labels", F.explode(F.array_distinct(triples)).alias("secondary_subset"))
    wide = subsets.withColumn("product_label", F.explode(labels)).withColumn("_root", F.explode(roots))
    found = F.get(F.filter("secondary_subset", lambda x: F.coalesce(F.array_contains(of(F.col("_root")), x), F.lit(False))), F.lit(0))
    wide = wide.withColumn("_syn", F.when(F.col("_root").isNotNull(), found))
    rest = F.when(F.col("_syn").isNotNull(), F.array_remove("secondary_subset", F.coalesce("_syn", F.lit("")))).otherwise(F.col("secondary_subset"))
    chosen = F.array_union(rest, F.array(F.coalesce("_syn", "product_label")))
    out = wide.withColumn("_chosen", chosen)
    suggestion = F.array_join(F.array_remove("_chosen", ""), " ")
    key = A.sorted_words(F.col("_chosen"))
    out = out.select("product_id", "product_label", suggestion.alias("suggestion"), key.alias("tag_words"), A.surrogate_key(key).alias("suggestion_hash"), "secondary_subset", "internal_color")
    return out.where(~F.col("suggestion").contains(forbidden)).distinct()


def supported(tags: DataFrame) -> DataFrame:
    """suggestion, product_label, n_hits: distinct products per suggestion and label, and per suggestion the rows with the running maximum.

    In the order labelled first, then by count: a row stays if no earlier one has more. So an
    unlabelled row with a higher count than the labelled ones stays besides them. Of labels
    with equal counts the greatest by alphabet counts.
    """
    counts = tags.select("product_id", "suggestion", "product_label").distinct().groupBy("suggestion", "product_label").agg(F.count(F.lit(1)).alias("n_hits"))
    order = Window.partitionBy("suggestion").orderBy(F.desc(F.length("product_label") > 0), F.desc("n_hits"))
    top = counts.withColumn("_max", F.max("n_hits").over(order)).where("n_hits = _max")
    return top.groupBy("suggestion", "n_hits").agg(F.max("product_label").alias("product_label"))


def search_suggestions(tags: DataFrame, include: int, strong: int) -> DataFrame:
    """suggestion, product_label, n_hits, is_base_label, is_strong: suggestions with more than `include` products."""
    top = supported(tags).where((F.col("n_hits") > include) & (F.length("suggestion") > 0))
    return top.select("suggestion", "product_label", "n_hits", (F.col("suggestion") == F.col("product_label")).alias("is_base_label"), (F.col("n_hits") > strong).alias("is_strong"))


def smart_tags(tags: DataFrame, include: int, redundancy: float = 0.65) -> DataFrame:
    """tag_words, suggestion, product_label, product_secondary_labels, n_hits: tags worth a page of their own.

    Tags with more than `include` products, one or two attributes and no colour in the text,
    without those that another tag continues by one word with more than `redundancy` of their
    products; one row per set of words, the smallest by alphabet. tags are written once, since
    two aggregations read them and making them multiplies the products.
    """
    tags = written(tags.select("product_id", "suggestion", "product_label", "tag_words", "secondary_subset", "internal_color"))
    top = supported(tags).where((F.col("n_hits") > include) & (F.length("suggestion") > 0))
    forms = tags.groupBy("suggestion", "product_label", "tag_words").agg(F.min(F.struct(F.array_sort(F.array_remove("secondary_subset", "")).alias("labels"), F.coalesce("internal_color", F.lit("")).alias("color"))).alias("_f"))
    t = top.join(forms, ["suggestion", "product_label"]).where((F.col("_f.color") == "") | ~F.contains("suggestion", F.col("_f.color")))
    t = t.select("tag_words", "suggestion", "product_label", F.col("_f.labels").alias("product_secondary_labels"), "n_hits").where(F.size("product_secondary_labels").isin(1, 2))
    longer = t.select(A.without_last_word(F.col("suggestion")).alias("suggestion"), F.col("n_hits").alias("_longer"))
    redundant = t.join(longer, "suggestion").where(F.col("_longer") / F.col("n_hits") > redundancy).select("tag_words").distinct()
    kept = t.join(redundant, "tag_words", "left_anti")
    return kept.groupBy("tag_words").agg(F.min(F.struct("suggestion", "product_label", "product_secondary_labels", "n_hits")).alias("_t")).select("tag_words", "_t.*")


def advertiser_tags(product_tag: DataFrame, products: DataFrame, dimension: DataFrame, min_count: int, min_share: float, ranks: int = 1000, label_ranks: int = 200) -> DataFrame:
    """advertiser_name, smart_tag_id, product_label, score, rank, plrank: tags by how much they mark an advertiser.

    score = ln(count) * share among the advertiser's products / mean share over advertisers that
    have the tag; the mean is taken before the thresholds, the ranks after the join with the
    dimension. Ties by the smaller id. Kept are rank < ranks and plrank * rank < label_ranks.
    """
    edges = product_tag.select("product_id", "smart_tag_id").where("smart_tag_id IS NOT NULL").distinct().join(products.select("product_id", "advertiser_name"), "product_id")
    counts = edges.groupBy("advertiser_name", "smart_tag_id").agg(F.count(F.lit(1)).alias("c"))
    totals = edges.select("product_id", "advertiser_name").distinct().groupBy("advertiser_name").agg(F.count(F.lit(1)).alias("total"))
    share = counts.join(totals, "advertiser_name").withColumn("p", F.col("c") / F.col("total")).withColumn("g", F.avg("p").over(Window.partitionBy("smart_tag_id")))
    scored = share.where((F.col("p") > min_share) & (F.col("c") > min_count)).withColumn("score", F.log("c") * F.col("p") / F.col("g"))
    named = scored.join(dimension.select("smart_tag_id", "product_label"), "smart_tag_id").where(F.length("product_label") > 1)
    score = F.desc(F.round("score", 9))
    ranked = named.withColumn("rank", F.row_number().over(Window.partitionBy("advertiser_name").orderBy(score, "smart_tag_id")))
    ranked = ranked.withColumn("plrank", F.row_number().over(Window.partitionBy("advertiser_name", "product_label").orderBy(score, "smart_tag_id")))
    return ranked.where((F.col("rank") < ranks) & (F.col("plrank") * F.col("rank") < label_ranks)).select("advertiser_name", "smart_tag_id", "product_label", "score", "rank", "plrank")


def search_documents(products: DataFrame, options: DataFrame, seed: int = 11) -> DataFrame:
    """products with sizes, product_color_options, swipe_rate and default_search_order for the search index.

    options: product_id, other_id, color. Large advertisers sink: the order is a random number
    times their size to the power 11/12, drawn from the product's id and the seed, so a
    repeated run gives the same.
    """
    sizes = products.groupBy("advertiser_name").agg(F.count(F.lit(1)).alias("_n"))
    images = products.select(F.col("product_id").alias("other_id"), "product_image_url")
    sets = options.join(images, "other_id").groupBy("product_id").agg(F.array_sort(F.collect_set(F.struct("color", F.col("other_id").alias("product_id"), "product_image_url"))).alias("product_color_options"))
    random = F.pmod(F.xxhash64("product_id", F.lit(seed)), F.lit(2**31)) / float(2**31)
    size = lambda x: F.struct(x["size"].alias("size"), x["product_purchase_url"].alias("product_purchase_url"), F.lit(True).alias("in_stock"))
    out = products.join(sizes, "advertiser_name").join(sets, "product_id", "left")
    return out.withColumns(
        {"default_search_order": random * F.pow(F.col("_n"), F.lit(11 / 12)), "sizes": F.transform("product_details", size), "swipe_rate": F.try_divide(F.col("n_likes") + F.col("n_add_to_cart") + 1, F.col("n_views"))}
    ).drop("_n")


def trending(tags: DataFrame, products: DataFrame) -> DataFrame:
    """suggestion_text, product_label, product_id, product_image_url: each tag with the image of its label's smallest product id."""
    firsts = products.select(F.explode("product_labels").alias("product_label"), "product_id", "product_image_url").groupBy("product_label").agg(F.min(F.struct("product_id", "product_image_url")).alias("_p")).select("product_label", "_p.*")
    return tags.select(A.display_text(F.col("suggestion")).alias("suggestion_text"), "product_label").distinct().join(firsts, "product_label")
