"""Vendor feeds as Spark readers, and their mapping to the common product schema.

Credentials are options of the caller or of the environment, never part of the code.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from selvedge.functions import arrays as A
from selvedge.schemas import align

NULL_WORDS = ["nan", "NaN", "None", "null"]


def read_csv(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """All columns as strings, nulls as ''; compressed files are read as they are."""
    return spark.read.csv(path, header=True, sep=separator, inferSchema=False, multiLine=True, escape='"').na.fill("")


def read_xml(spark: SparkSession, path: str, row: str = "product", schema: T.StructType | None = None) -> DataFrame:
    """One row per element of that name. With a schema the files are read once; else they are also scanned for it."""
    reader = spark.read.format("xml").option("rowTag", row).option("mode", "PERMISSIVE").option("ignoreSurroundingSpaces", False)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.option("mode", "PERMISSIVE")
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_jdbc(spark: SparkSession, url: str, table: str, column: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 16, **options: str) -> DataFrame:
    """A table of a store, read in parallel where a numeric column and its bounds are given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if column and bounds:
        reader = reader.option("partitionColumn", column).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", partitions)
    return reader.load()


def flattened(df: DataFrame, separator: str = "_") -> DataFrame:
    """Struct columns replaced by their fields, at any depth; arrays stay."""
    while any(isinstance(f.dataType, T.StructType) for f in df.schema.fields):
        out = []
        for f in df.schema.fields:
            if isinstance(f.dataType, T.StructType):
                out += [F.col(f"`{f.name}`.`{x.name}`").alias(f"{f.name}{separator}{x.name}") for x in f.dataType.fields]
            else:
                out.append(F.col(f"`{f.name}`"))
        df = df.select(*out)
    return df


def nulls_normalized(df: DataFrame, words: list[str] = NULL_WORDS) -> DataFrame:
    """NaN and the words for it become null."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("float", "double"):
            c = F.when(~F.isnan(c), c)
        elif kind == "string":
            c = F.when(~c.isin(*words), c)
        out.append(c.alias(name))
    return df.select(*out)


def rows(spark: SparkSession, records: list[dict[str, Any]], schema: str | T.StructType | None = None) -> DataFrame:
    """A small table from dictionaries, by default with the columns in order of name."""
    if schema is not None:
        return spark.createDataFrame(records, schema)
    return spark.createDataFrame(pd.DataFrame(records)[sorted({k for r in records for k in r})])


def lookup_mapped(df: DataFrame, mapping: DataFrame, on: str) -> DataFrame:
    """Rows whose name the mapping knows, with its columns."""
    return df.join(mapping, on)


def array_of(*columns: Column) -> Column:
    """The non-empty ones among several columns, as an array."""
    return F.filter(F.array(*columns), lambda x: x.isNotNull() & (F.length(x) > 0))


def first_number(*columns: Column) -> Column:
    """The first of the columns that is a number, as a float; text such as '12.50 EUR' counts by its number."""
    return F.coalesce(*[F.regexp_replace(F.regexp_extract(c.cast("string"), r"(\d+(?:[.,]\d+)?)", 1), ",", ".").try_cast("float") for c in columns])


def mapped(df: DataFrame, spec: dict[str, Column], schema: T.StructType, constants: dict[str, Any] | None = None, keep_extra: bool = False) -> DataFrame:
    """A vendor's rows in the common schema: spec gives its columns, constants the ones that are the same for all rows."""
    out = df.select(*[c.alias(n) for n, c in spec.items()], *[F.lit(v).alias(n) for n, v in (constants or {}).items()])
    return align(out, schema, keep_extra)


Fields = dict[str, "Fields | None"]


def graphql_query(root: str, arguments: dict[str, Any], fields: Fields, operation: str = "") -> str:
    """A GraphQL document: one call with its arguments and the fields wanted, nested by dictionaries.

    Strings and lists are written as JSON. A field may carry arguments of its own, as in
    `linkCode(pid: "7")`. operation is `query` or `subscription`; without it the short form.
    """

    def chosen(x: Fields, depth: int) -> str:
        pad = "  " * depth
        return "{\n" + "".join(f"{pad}  {name}{' ' + chosen(inner, depth + 1) if inner else ''}\n" for name, inner in x.items()) + pad + "}"

    given = ", ".join(f"{k}: {json.dumps(v)}" for k, v in arguments.items() if v is not None)
    call = {f"{root}({given})" if given else root: fields}
    return f"{operation} {chosen(call, 0)}".strip()


def records_at(response: dict | str, *path: str) -> list[dict]:
    """The list of records inside a response; a missing or null step is an empty list, an error of the service is raised."""
    found: Any = json.loads(response) if isinstance(response, str) else response
    if isinstance(found, dict) and found.get("errors"):
        raise OSError(f"the service answered {json.dumps(found['errors'])}")
    for step in path:
        found = found.get(step) if isinstance(found, dict) else None
    return found or []


def flat_record(record: dict, separator: str = ".") -> dict[str, Any]:
    """A record with nested dictionaries flattened to dotted names; lists stay."""
    out: dict[str, Any] = {}
    for k, v in record.items():
        if isinstance(v, dict):
            out |= {f"{k}{separator}{x}": y for x, y in flat_record(v, separator).items()}
        else:
            out[k] = v
    return out


def recorded_page(page: int, options: dict[str, str]) -> list[dict]:
    """A fetcher for PagedFeed that replays recorded responses: option `recorded` is a table with a folder page=<n> each and a column body."""
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    fs, root = pafs.FileSystem.from_uri(options["recorded"] if ":" in options["recorded"] else f"file://{options['recorded']}")
    out: list[dict] = []
    for f in sorted(i.path for i in fs.get_file_info(pafs.FileSelector(f"{root}/page={page}")) if i.path.endswith(".parquet")):
        with fs.open_input_file(f) as handle:
            for body in pq.ParquetFile(handle).read(columns=["body"])["body"].to_pylist():
                out += [flat_record(r) for r in records_at(body, *options["path"].split("/"))]
    return out


def _chooser(df: DataFrame) -> Callable[..., Column]:
    have = set(df.columns)

    def col(*names: str) -> Column:
        """The first of several columns that has a text; null if the feed has none of them."""
        found = [F.when(F.length(F.col(f"`{n}`").cast("string")) > 0, F.col(f"`{n}`").cast("string")) for n in names if n in have]
        return F.coalesce(*found) if found else F.lit(None).cast("string")

    return col


def graph_spec(df: DataFrame) -> dict[str, Column]:
    """The common columns from a GraphQL feed with flattened names: links through the tracking code first, labels from categories and custom labels."""
    col = _chooser(df)
    price, sale = first_number(col("price.amount")), first_number(col("salePrice.amount"))
    labels = [col(c) for c in ("googleProductCategory.name", "gender", "availability", "customLabel0", "customLabel1", "customLabel2", "customLabel3")]
    more = F.from_json(col("additionalImageLink"), "array<string>")
    return {
        "advertiser_name": col("advertiserName"), "advertiser_country": col("advertiserCountry"), "product_brand": col("brand"), "product_name": col("title"), "product_description": col("description"),
        "product_purchase_url": col("linkCode.clickUrl", "link"), "product_image_url": col("imageLink", "linkCode.imageUrl"), "product_additional_image_urls": F.coalesce(more, A.strings()),
        "product_price": F.coalesce(price, sale), "product_sale_price": F.coalesce(sale, price), "product_currency": col("price.currency", "salePrice.currency"),
        "product_external_labels": array_of(*labels), "external_id": col("id"), "color": col("color"), "size": col("size"),
    }


def merchandiser_spec(df: DataFrame, advertiser: str) -> dict[str, Column]:
    """The common columns from an XML feed, flattened with `_`: attributes have a leading underscore, one price stands for both."""
    col = _chooser(df)
    retail, sale = first_number(col("price_retail")), first_number(col("price_sale"))
    return {
        "advertiser_name": F.lit(advertiser), "product_brand": col("brand"), "product_name": col("_name"), "product_description": col("description_long", "description_short"),
        "product_purchase_url": col("URL_product"), "product_image_url": col("URL_productImage"), "product_additional_image_urls": array_of(col("m1")),
        "product_price": F.coalesce(retail, sale), "product_sale_price": F.coalesce(sale, retail), "product_currency": col("price__currency"),
        "product_external_labels": array_of(col("category_primary"), col("category_secondary"), col("attributeClass_Gender"), col("shipping_availability")),
        "external_id": col("_product_id"), "color": col("attributeClass_Color"), "size": col("attributeClass_Size"),
    }


def feed_spec(df: DataFrame) -> dict[str, Column]:
    """The columns of the common schema from a feed with vendor names; what a feed lacks is null."""
    have, col = set(df.columns), _chooser(df)
    extra = [F.col(f"`{n}`") for n in ("alternate_image", "alternate_image_two", "alternate_image_three", "alternate_image_four") if n in have]
    category = [F.col(f"`{n}`") for n in ("category_name", "merchant_category", "custom_1") if n in have]
    price = first_number(col("rrp_price", "product_price_old"), col("search_price"))
    return {
        "advertiser_name": col("merchant_name", "advertiser_name"), "product_brand": col("brand_name", "merchant_name"), "product_name": col("product_name", "title"),
        "product_description": col("description", "product_description"), "product_purchase_url": col("deep_link", "link"), "product_price": F.coalesce(price, first_number(col("search_price"))),
        "product_sale_price": F.coalesce(first_number(col("search_price")), price), "product_image_url": col("merchant_image_url", "image_link"), "product_currency": col("currency"),
        "product_additional_image_urls": array_of(*extra) if extra else A.strings(), "product_external_labels": array_of(*category) if category else A.strings(),
        "external_id": col("merchant_product_id", "id"), "color": col("colour", "color"), "size": col("Fashion:size", "size"),
    }


class PagedFeed(DataSource):
    """A feed that is fetched page by page, one task per page.

    Register with spark.dataSource.register(PagedFeed) and load with the options `pages`, `schema`
    and `fetcher`, the latter as "module:function"; it gets (page, options) and returns a list
    of records as dictionaries. Failing pages are tried `retries` times again.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_feed"

    def schema(self) -> str:
        return self.options["schema"]

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return PagedReader(dict(self.options), schema)


class PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType):
        self.options, self.fields = options, schema.fieldNames()

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(i) for i in range(int(self.options.get("pages", 1)))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        import importlib

        module, _, function = self.options["fetcher"].partition(":")
        fetch = getattr(importlib.import_module(module), function)
        for left in range(int(self.options.get("retries", 2)), -1, -1):
            try:
                found = fetch(partition.value, self.options)
                break
            except OSError:
                if not left:
                    raise
        for record in found:
            yield tuple(x if x is None or isinstance(x, (int, float, str, bool)) else json.dumps(x) for x in (record.get(f) for f in self.fields))


def fetched(df: DataFrame, url: str, fetch: Callable[[str], bytes | None], name: str = "content", timeout: float = 5.0, threads: int = 16) -> DataFrame:
    """df with the bytes behind each URL, null where fetching fails or takes longer than `timeout` seconds.

    The fetcher is given, so nothing here opens a connection. A task waits for `threads`
    addresses at a time; one that hangs costs its own thread until the task ends, no more.
    """
    kinds = T.StructType([*df.schema.fields, T.StructField(name, T.BinaryType())])

    def one(u: str | None) -> bytes | None:
        try:
            return fetch(u) if u else None
        except Exception:  # noqa: BLE001 - one bad address must not end the job
            return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from concurrent.futures import ThreadPoolExecutor, TimeoutError

        for b in batches:
            out: list[bytes | None] = []
            for at in range(0, len(b), threads):
                pool = ThreadPoolExecutor(threads)
                waiting = [pool.submit(one, u) for u in b[url].iloc[at : at + threads]]
                until = time.monotonic() + timeout
                for w in waiting:
                    try:
                        out.append(w.result(max(0.0, until - time.monotonic())))
                    except TimeoutError:
                        out.append(None)
                pool.shutdown(wait=False, cancel_futures=True)
            yield b.assign(**{name: out})

    return df.mapInPandas(run, kinds)


def read_rules(spark: SparkSession, path: str) -> dict | list:
    """A rule set or another small JSON document, from any file system that Spark reads."""
    return json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()))


def search_settings(base: dict, synonyms: DataFrame, root: str = "root", word: str = "synonym", most: int = 100_000) -> dict:
    """Settings of a search index with the synonyms of each root added; more than `most` rows are refused."""
    found = synonyms.where(F.col(root).isNotNull() & F.col(word).isNotNull()).select(root, word).distinct().orderBy(root, word).limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} synonyms")
    table: dict[str, list[str]] = {}
    for r, w in found:
        table.setdefault(r, []).append(w)
    return base | {"synonyms": base.get("synonyms", {}) | table}
