"""Table schemas with their constraints, and bringing a table to a schema."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRINGS = T.ArrayType(T.StringType(), False)
DETAILS = T.ArrayType(
    T.StructType(
        [
            T.StructField("color", T.StringType()),
            T.StructField("size", T.StringType(), False),
            T.StructField("product_price", T.FloatType(), False),
            T.StructField("product_sale_price", T.FloatType(), False),
            T.StructField("product_purchase_url", T.StringType(), False),
        ]
    ),
    False,
)


def _f(name: str, kind: T.DataType, nullable: bool = False, **metadata: Any) -> T.StructField:
    return T.StructField(name, kind, nullable, metadata or None)


PRODUCT_INFO = T.StructType(
    [
        _f("product_id", T.LongType()),
        *[_f(n, T.StringType()) for n in ("advertiser_name", "product_brand", "product_name")],
        *[_f(n, STRINGS, default=[]) for n in ("product_labels", "product_secondary_labels", "product_external_labels", "product_tags")],
        *[_f(n, T.StringType()) for n in ("product_description", "product_purchase_url")],
        *[_f(n, T.FloatType()) for n in ("product_price", "product_sale_price")],
        _f("product_image_url", T.StringType()),
        _f("product_currency", T.StringType(), True),
        _f("product_additional_image_urls", STRINGS, True),
        *[_f(n, T.StringType(), True) for n in ("advertiser_country", "external_id")],
        _f("execution_date", T.DateType()),
        _f("execution_timestamp", T.LongType()),
        *[_f(n, T.StringType(), True) for n in ("color", "size")],
        _f("product_details", DETAILS),
        _f("internal_color", T.StringType(), True),
    ]
)
COUNTERS = ("n_views", "n_likes", "n_add_to_cart", "n_conversions")
ACTIVE_PRODUCTS = T.StructType([*PRODUCT_INFO.fields, _f("product_image_embedding", T.ArrayType(T.FloatType(), False)), *[_f(n, T.IntegerType(), default=0) for n in COUNTERS]])
USER_EVENTS = T.StructType(
    [
        _f("user_id", T.LongType()), _f("event", T.StringType()), _f("method", T.StringType(), True), _f("event_timestamp", T.LongType()), _f("product_id", T.LongType(), True),
        _f("tags", STRINGS, True), _f("execution_date", T.DateType()), _f("batch_timestamp", T.LongType()), _f("advertiser_names", STRINGS, True), _f("product_labels", STRINGS, True),
        _f("search_string", T.StringType(), True), _f("json_data", T.StringType(), True),
    ]
)


def relaxed(schema: T.StructType) -> T.StructType:
    """The schema with every column nullable, as a dump has it."""
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])


DAILY_PRODUCT_DUMP = relaxed(PRODUCT_INFO)
EMBEDDINGS = T.StructType([_f("product_id", T.LongType()), _f("product_image_embedding", T.ArrayType(T.FloatType(), False))])


def _loose(kind: T.DataType) -> T.DataType:
    """The type with nulls allowed inside, which any value can be cast to."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_loose(kind.elementType), True)
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _loose(f.dataType), True) for f in kind.fields])
    return kind


def align(df: DataFrame, schema: T.StructType, keep_extra: bool = False) -> DataFrame:
    """df with the columns of schema in its order and types, missing ones as their default or null.

    Values that don't fit a type become null (try_cast). Columns that the schema doesn't have
    follow as strings with keep_extra, else they go. Where a field's metadata has a default, it
    also fills nulls.
    """
    have = {c.lower(): c for c in df.columns}
    out = []
    for f in schema.fields:
        kind = _loose(f.dataType)
        col = F.col(f"`{have[f.name.lower()]}`").try_cast(kind) if f.name.lower() in have else F.lit(None).cast(kind)
        if "default" in (f.metadata or {}):
            value = f.metadata["default"]
            col = F.coalesce(col, F.array().cast(kind) if value == [] else F.lit(value).cast(kind))
        out.append(col.alias(f.name))
    names = {f.name.lower() for f in schema.fields}
    if keep_extra:
        out += [F.col(f"`{c}`").cast("string").alias(c) for c in df.columns if c.lower() not in names]
    return df.select(*out)


def stacked(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of several tables by column name; a missing column is null."""
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p, allowMissingColumns=True)
    return whole


def schema_differences(have: T.StructType, want: T.StructType) -> list[tuple[str, str]]:
    """(column, what to do): add, drop, retype, relax or tighten, and move, to come from one schema to the other."""
    a, b = {f.name: f for f in have.fields}, {f.name: f for f in want.fields}
    out = [(n, "add") for n in b if n not in a] + [(n, "drop") for n in a if n not in b]
    for n in b:
        if n in a:
            if a[n].dataType.simpleString() != b[n].dataType.simpleString():
                out.append((n, "retype"))
            if a[n].nullable != b[n].nullable:
                out.append((n, "relax" if b[n].nullable else "tighten"))
    if [n for n in a if n in b] != [n for n in b if n in a]:
        out += [(n, "move") for n, m in zip([x for x in b if x in a], [x for x in a if x in b]) if n != m]
    return out


@dataclass(frozen=True)
class Constraints:
    """What a store would enforce and Spark does not."""

    primary_key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    foreign_keys: tuple[tuple[str, str, str], ...] = ()  # column, table, column there
    indexes: tuple[tuple[str, ...], ...] = field(default=())


def violations(df: DataFrame, rules: Constraints, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """rule, n_rows: rows with nulls, surplus rows of a key, and rows whose reference is missing, per broken rule."""
    spark = df.sparkSession
    out = spark.createDataFrame([], "rule string, n_rows bigint")
    columns = dict.fromkeys((*rules.not_null, *rules.primary_key))
    if columns:
        counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        out = out.unionByName(counted.select(F.explode(F.array(*[F.struct(F.lit(f"not null {c}").alias("rule"), F.col(c).alias("n_rows")) for c in columns])).alias("x")).select("x.*"))
    for key in (*((rules.primary_key,) if rules.primary_key else ()), *rules.unique):
        name = f"unique {', '.join(key)}"
        out = out.unionByName(df.dropna(subset=list(key)).groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.lit(name).alias("rule"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_rows")))
    for column, other, there in rules.foreign_keys:
        name = f"{column} in {other}.{there}"
        keys = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias(there)).agg(F.count(F.lit(1)).alias("n"))
        out = out.unionByName(keys.join((tables or {})[other].select(there).distinct(), there, "left_anti").agg(F.lit(name).alias("rule"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows")))
    return out.where("n_rows > 0")


def enforced(df: DataFrame, rules: Constraints, tables: dict[str, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows that a store with these constraints would hold, rows it would refuse, with the first rule each breaks).

    Of rows with one primary or unique key the first by all columns stays; rows with a null in a
    unique key are never repeats. A null reference is no violation. Every rule is one join or
    one window on its key.
    """
    order = [F.col(f"`{c}`").desc_nulls_last() for c, t in df.dtypes if not t.startswith(("map", "variant"))]
    broken = F.lit(None).cast("string")
    for c in dict.fromkeys((*rules.not_null, *rules.primary_key)):
        broken = F.coalesce(broken, F.when(F.col(c).isNull(), F.lit(f"not null {c}")))
    rows = df.withColumn("_broken", broken)
    for i, (column, other, there) in enumerate(rules.foreign_keys):
        known = (tables or {})[other].select(F.col(there).alias(column)).where(F.col(column).isNotNull()).distinct().withColumn(f"_known{i}", F.lit(True))
        rows = rows.join(known, column, "left")
        rows = rows.withColumn("_broken", F.coalesce("_broken", F.when(F.col(column).isNotNull() & F.col(f"_known{i}").isNull(), F.lit(f"{column} in {other}.{there}")))).drop(f"_known{i}")
    for key in (*((rules.primary_key,) if rules.primary_key else ()), *rules.unique):
        whole = F.lit(True)
        for k in key:
            whole = whole & F.col(k).isNotNull()
        place = F.row_number().over(Window.partitionBy(*key, F.col("_broken").isNull() & whole).orderBy(*order))
        rows = rows.withColumn("_broken", F.coalesce("_broken", F.when(whole & (place > 1), F.lit(f"unique {', '.join(key)}"))))
    good = rows.where("_broken IS NULL").select(*df.columns)
    return good, rows.where("_broken IS NOT NULL").select(*df.columns, F.col("_broken").alias("rule"))
