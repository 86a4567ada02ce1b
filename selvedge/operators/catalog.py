"""Catalogue normalisation: ids, defaults, required fields, names, image addresses, grouping."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from selvedge.functions import arrays as A
from selvedge.operators.dml import last_per_key, not_in


def basic_info(df: DataFrame, day: Column, required: Sequence[str], identity: Sequence[str], array_defaults: Sequence[str] = ()) -> DataFrame:
    """Distinct rows with an id hashed from identity, the day, [] for null arrays, the price for a null sale price, and no null in required."""
    filled = df.distinct().withColumns(
        {
            "product_id": A.surrogate_key(*[F.col(c) for c in identity]),
            "execution_date": day,
            **{c: F.coalesce(F.col(c), A.strings()) for c in array_defaults},
            "product_sale_price": F.coalesce("product_sale_price", "product_price"),
        }
    )
    return filled.dropna(subset=list(required))


def clean_name(name: Column, color: Column, size: Column, prefix: str = "", strip_null_color: bool = False) -> Column:
    """A product name without sizes, colours and what follows them.

    Deleted in turn, case aside, trimming after each: the prefix; ' - ' and the rest; the first
    full stop and the rest; the words extra, x, small, medium and large; the row's own size as
    a word; a final 'size'; 'in <colour>' and the rest; a hyphen, any character, the colour and
    the rest. Sizes and colours are taken literally. A null colour deletes nothing, or with
    strip_null_color whatever follows 'in'.
    """
    plain = F.regexp_replace(color, r"[^0-9a-zA-Z:, ]", "")
    shade = F.coalesce(plain, F.lit("")) if strip_null_color else plain
    own = F.when(F.length(F.trim(size)) > 0, F.concat(F.lit(r"(?i)(^|\s)"), A.quoted(F.trim(size)), F.lit(r"(\s|$)")))
    in_color = F.when(F.lit(True) if strip_null_color else F.length(shade) > 0, F.concat(F.lit(r"(?i)\bin "), A.quoted(shade), F.lit(".*")))
    dashed = F.when(F.length(shade) > 0, F.concat(F.lit(r"(?i)-."), A.quoted(shade), F.lit(".*")))
    start = [f"^{A.escaped(prefix)}"] if prefix else []
    return A.stripped(name, [*start, r" - .*", r"\..*", *[rf"(?i)\b{w}\b" for w in ("extra", "x", "small", "medium", "large")], (own, " "), r"(?i)\bsize$", in_color, dashed])


Rewrite = tuple[str, str]


def rewritten_url(url: Column, advertiser: Column, rules: dict[str, Sequence[Rewrite]]) -> Column:
    """url after the advertiser's rewrites (pattern, replacement), each in turn; null for advertisers without rule.

    One expression over one scan, whatever the number of advertisers.
    """
    out = None
    for name, steps in rules.items():
        new = reduce(lambda u, s: F.regexp_replace(u, s[0], s[1]), steps, url)
        out = F.when(advertiser == name, new) if out is None else out.when(advertiser == name, new)
    return out if out is not None else F.lit(None).cast("string")


def additional_images(main: Column, given: Column, variants: Column) -> Column:
    """Given and derived image addresses without repeats, empty ones and the main image."""
    both = F.array_union(F.coalesce(given, A.strings()), F.coalesce(variants, A.strings()))
    return F.array_distinct(F.filter(both, lambda u: u.isNotNull() & (F.length(u) > 0) & (main.isNull() | (u != main))))


def numbered_variants(url: Column, pattern: str, template: str, first: int, last: int) -> Column:
    """url with the pattern replaced by the template for each number; [] where the pattern isn't found."""
    return F.when(url.rlike(pattern), F.transform(F.sequence(F.lit(first), F.lit(last)), lambda i: F.regexp_replace(url, F.lit(pattern), F.format_string(template, i)))).otherwise(A.strings())


def named_variants(url: Column, pattern: str, names: Column | Sequence[str]) -> Column:
    """url with what the pattern finds replaced by each name in turn (in the names, $1 is the first group); [] where it isn't found."""
    each = A.strings(*names) if not isinstance(names, Column) else names
    return F.when(url.rlike(pattern), F.transform(each, lambda x: F.regexp_replace(url, F.lit(pattern), x))).otherwise(A.strings())


def chosen_variants(url: Column, pattern: str, condition: Column, names: Sequence[str], otherwise: Sequence[str]) -> Column:
    """named_variants by one list of names where the condition holds, by another elsewhere."""
    return named_variants(url, pattern, F.when(F.coalesce(condition, F.lit(False)), A.strings(*names)).otherwise(A.strings(*otherwise)))


def rewritten_list(urls: Column, pattern: str, replacement: str) -> Column:
    """Given image addresses, each rewritten."""
    return F.transform(urls, lambda u: F.regexp_replace(u, pattern, replacement))


def variants_by_advertiser(advertiser: Column, variants: dict[str, Column]) -> Column:
    """The variants of each advertiser's rule, [] for advertisers without one: one expression over one scan."""
    out = None
    for name, found in variants.items():
        out = F.when(advertiser == name, found) if out is None else out.when(advertiser == name, found)
    return (out.otherwise(A.strings())) if out is not None else A.strings()


def combined(basic: DataFrame, labels: DataFrame, overrides: dict[str, DataFrame], secondary: DataFrame, drop: Column | None = None) -> DataFrame:
    """basic with its labels, and each column of overrides taken from there if it has a value for the id.

    labels: product_id, product_label; products without label go. secondary: product_id,
    product_secondary_label. overrides: column -> (product_id, column), at most one row per id
    (the smallest value counts). All joins are on product_id, so one exchange of basic serves.
    """
    tags = labels.groupBy("product_id").agg(F.array_sort(F.collect_set("product_label")).alias("product_labels"))
    more = secondary.groupBy("product_id").agg(F.array_sort(F.collect_set("product_secondary_label")).alias("_secondary"))
    out = basic.drop("product_labels").join(tags, "product_id").join(more, "product_id", "left")
    out = out.withColumn("product_secondary_labels", F.coalesce("_secondary", A.strings())).drop("_secondary")
    for column, table in overrides.items():
        best = table.groupBy("product_id").agg(F.min(column).alias(f"_{column}"))
        out = out.join(best, "product_id", "left")
        out = out.withColumn(column, F.coalesce(f"_{column}", column) if column in basic.columns else F.col(f"_{column}")).drop(f"_{column}")
    return out.where(~F.coalesce(drop, F.lit(False))) if drop is not None else out


def grouped(df: DataFrame, key: str = "product_id") -> DataFrame:
    """One row per product: product_details is the set of its sizes, sorted; other columns come from its smallest row."""
    detail = F.struct(F.lower("color").alias("color"), "size", "product_price", "product_sale_price", "product_purchase_url")
    rest = [c for c in df.columns if c not in (key, "product_details")]
    whole = F.min(F.struct(*[F.col(c) for c in rest])).alias("_row")
    return df.groupBy(key).agg(F.array_sort(F.collect_set(detail)).alias("product_details"), whole).select(key, "_row.*", "product_details")


def size_info(df: DataFrame) -> DataFrame:
    """product_id, size, product_purchase_url: the first address of each size by alphabet; null sizes go."""
    exploded = df.select("product_id", F.explode("product_details").alias("d")).where("d.size IS NOT NULL")
    return exploded.groupBy("product_id", F.col("d.size").alias("size")).agg(F.min("d.product_purchase_url").alias("product_purchase_url"))


def valid_images(images: DataFrame, invalid: DataFrame, column: str = "image_hash") -> DataFrame:
    """Images whose hash is not among the invalid ones; images without hash go."""
    return not_in(images.where(F.col(column).isNotNull()), column, invalid, column)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return last_per_key(df, keys, *order)
