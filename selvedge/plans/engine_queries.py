"""Queries of sources, sinks, tables, streams and images, each through files or tables in the shared folder and back, with their SQL."""

from __future__ import annotations

import datetime
import json
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from selvedge import schemas
from selvedge.functions import arrays as A
from selvedge.operators import catalog, dml, images, rules, tags
from selvedge.plans import catalog_queries, sqlrun
from selvedge.session import checkpoint_folder
from selvedge.sources import feeds, sinks
from selvedge.sources.tables import table
from selvedge.streaming import events as stream

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _folder(spark: SparkSession) -> str:
    return f"{checkpoint_folder(spark)}/query-{uuid.uuid4().hex}"


def _database(spark: SparkSession) -> str:
    """A database of its own whose tables lie in the shared folder."""
    name = f"made_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{_folder(spark)}'")
    return name


def _euros(c: str) -> Column:
    return F.round(F.col(c).cast("double"), 2).alias(c)


# feeds

#: Records of one recorded response.
PAGE = 500
_MAPPED = ["external_id", "advertiser_name", "product_brand", "product_name"]
_PRICES_SQL = "round(CAST(coalesce(product_price, product_sale_price) AS DOUBLE), 2) AS product_price, round(CAST(coalesce(product_sale_price, product_price) AS DOUBLE), 2) AS product_sale_price"
_TEXT = "CASE WHEN length({0}) > 0 THEN {0} END AS {0}"


@query(f"""
SELECT CAST(product_id AS VARCHAR) AS external_id, advertiser_name, product_brand, product_name, {_PRICES_SQL}, {_TEXT.format("color")}, {_TEXT.format("product_purchase_url")},
  1 + CASE WHEN length(product_currency) > 0 THEN 1 ELSE 0 END AS n_labels, coalesce(len(product_additional_image_urls), 0) AS n_images FROM product_info
""")
def graph_feed(spark: SparkSession, d: str) -> DataFrame:
    """Products recorded as pages of GraphQL responses, fetched page by page, flattened and mapped."""
    p, recorded = table(spark, d, "product_info"), _folder(spark)
    pages = max(1, p.count() // PAGE)
    money = lambda c: F.struct(F.col(c).alias("amount"), F.col("product_currency").alias("currency"))
    record = F.struct(
        F.col("product_id").cast("string").alias("id"), F.col("advertiser_name").alias("advertiserName"), F.col("product_brand").alias("brand"), F.col("product_name").alias("title"), F.col("color"),
        F.struct(F.col("product_purchase_url").alias("clickUrl")).alias("linkCode"), money("product_price").alias("price"), money("product_sale_price").alias("salePrice"), F.lit("in stock").alias("availability"),
        F.col("product_currency").alias("customLabel0"), F.col("product_additional_image_urls").alias("additionalImageLink"),
    )
    body = F.to_json(F.struct(F.struct(F.struct(F.collect_list(record).alias("resultList")).alias("shoppingProducts")).alias("data")))
    p.groupBy(F.pmod(F.xxhash64("product_id"), F.lit(pages)).cast("int").alias("page")).agg(body.alias("body")).repartition("page").write.partitionBy("page").parquet(recorded)
    spark.dataSource.register(feeds.PagedFeed)
    columns = "id string, `advertiserName` string, brand string, title string, color string, `linkCode.clickUrl` string, `price.amount` double, `price.currency` string, `salePrice.amount` double, availability string, `customLabel0` string, `additionalImageLink` string"
    feed = spark.read.format("paged_feed").options(pages=str(pages), schema=columns, fetcher="selvedge.sources.feeds:recorded_page", recorded=recorded, path="data/shoppingProducts/resultList").load()
    out = feeds.mapped(feed, feeds.graph_spec(feed), schemas.DAILY_PRODUCT_DUMP)
    return out.select(*_MAPPED, _euros("product_price"), _euros("product_sale_price"), "color", "product_purchase_url", F.size("product_external_labels").alias("n_labels"), F.size("product_additional_image_urls").alias("n_images"))


@query(f"""
SELECT CAST(product_id AS VARCHAR) AS external_id, 'Example Shop' AS advertiser_name, product_brand, product_name, {_PRICES_SQL}, {_TEXT.format("color")},
  CASE WHEN len(product_labels) > 0 THEN 1 ELSE 0 END AS n_labels, CASE WHEN length(product_image_url) > 0 THEN 1 ELSE 0 END AS n_images FROM product_info
""")
def xml_feed(spark: SparkSession, d: str) -> DataFrame:
    """Products written as gzipped XML files, read by their folder, flattened and mapped; attributes, nested prices and categories."""
    p, folder = table(spark, d, "product_info"), _folder(spark)
    shaped = p.select(
        F.col("product_id").alias("_product_id"), F.col("product_name").alias("_name"), F.col("product_brand").alias("brand"), F.struct(F.get("product_labels", F.lit(0)).alias("primary")).alias("category"),
        F.struct(F.col("product_currency").alias("_currency"), F.col("product_price").alias("retail"), F.col("product_sale_price").alias("sale")).alias("price"), F.struct(F.col("color").alias("Color"), F.col("size").alias("Size")).alias("attributeClass"), F.col("product_image_url").alias("m1"),
    )
    shaped.write.format("xml").option("rowTag", "product").option("rootTag", "merchandiser").option("compression", "gzip").save(folder)
    feed = feeds.flattened(feeds.read_xml(spark, folder, "product", shaped.schema))
    out = feeds.mapped(feed, feeds.merchandiser_spec(feed, "Example Shop"), schemas.DAILY_PRODUCT_DUMP)
    return out.select("external_id", "advertiser_name", "product_brand", "product_name", _euros("product_price"), _euros("product_sale_price"), "color", F.size("product_external_labels").alias("n_labels"), F.size("product_additional_image_urls").alias("n_images"))


@query(f"""
SELECT CAST(product_id AS VARCHAR) AS external_id, advertiser_name, coalesce({_TEXT.format("product_brand").split(" AS ")[0]}, advertiser_name) AS product_brand, product_name, round(CAST(coalesce(product_price, product_sale_price) AS DOUBLE), 2) AS product_price, {_TEXT.format("color")}, {_TEXT.format("size")} FROM product_info
""")
def csv_feed(spark: SparkSession, d: str) -> DataFrame:
    """Products written as gzipped CSV with vendor names, one of them with a colon, read as strings and mapped."""
    p, folder = table(spark, d, "product_info"), _folder(spark)
    vendor = p.select(F.col("product_id").alias("merchant_product_id"), F.col("advertiser_name").alias("merchant_name"), F.col("product_brand").alias("brand_name"), "product_name", F.col("product_price").alias("rrp_price"), F.col("product_sale_price").alias("search_price"), F.col("size").alias("Fashion:size"), F.col("color").alias("colour"))
    sinks.write_csv(vendor, folder, compression="gzip")
    feed = feeds.read_csv(spark, folder)
    out = feeds.mapped(feed, feeds.feed_spec(feed), schemas.DAILY_PRODUCT_DUMP)
    return out.select(*_MAPPED, _euros("product_price"), "color", "size")


@query("SELECT product_id, 'shop ' || lower(advertiser_name) AS merchant FROM product_info WHERE advertiser_name IN (SELECT advertiser_name FROM active_products WHERE advertiser_name IS NOT NULL)")
def merchant_map(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "active_products").where("advertiser_name IS NOT NULL").select("advertiser_name", F.concat(F.lit("shop "), F.lower("advertiser_name")).alias("merchant")).distinct()
    return feeds.lookup_mapped(table(spark, d, "product_info"), known, "advertiser_name").select("product_id", "merchant")


@query("SELECT user_id, product_id, CASE WHEN NOT isnan(score) THEN score END AS score FROM product_recs")
def normalized_nulls(spark: SparkSession, d: str) -> DataFrame:
    return feeds.nulls_normalized(table(spark, d, "product_recs"))


@query("SELECT * FROM (VALUES ('a', 1, NULL), ('b', 2, 0.5)) v(code, n, share)")
def record_frame(spark: SparkSession, d: str) -> DataFrame:
    return feeds.rows(spark, [{"n": 1, "code": "a", "share": None}, {"share": 0.5, "code": "b", "n": 2}])


@query("SELECT product_id, CASE WHEN contains(product_image_url, 'https') THEN length(product_image_url) END AS n_bytes FROM product_info")
def image_fetch(spark: SparkSession, d: str) -> DataFrame:
    """Contents behind addresses, by a fetcher that hands back the address itself and fails for those without https."""

    def fetch(url: str) -> bytes:
        if "https" not in url:
            raise OSError("refused")
        return url.encode()

    return feeds.fetched(table(spark, d, "product_info").select("product_id", "product_image_url"), "product_image_url", fetch).select("product_id", F.octet_length("content").alias("n_bytes"))


@query(catalog_queries.SQL["label_rules"])
def rule_file(spark: SparkSession, d: str) -> DataFrame:
    """Labels by a rule set that was written as a JSON file and read back."""
    path = _folder(spark)
    spark.createDataFrame([(json.dumps(catalog_queries.LABELS),)], "value string").coalesce(1).write.text(path)
    return rules.labelled(table(spark, d, "product_info"), feeds.read_rules(spark, path), "product_id", "product_label")


@query("SELECT product_label AS root, string_agg(DISTINCT suggestion, '|' ORDER BY suggestion) AS words FROM smart_tag WHERE product_label IS NOT NULL AND suggestion IS NOT NULL GROUP BY 1 UNION ALL SELECT 'kept', 'as it was'")
def index_settings(spark: SparkSession, d: str) -> DataFrame:
    found = feeds.search_settings({"synonyms": {"kept": ["as it was"]}}, table(spark, d, "smart_tag"), "product_label", "suggestion")
    return spark.createDataFrame([(root, "|".join(sorted(words))) for root, words in found["synonyms"].items()], "root string, words string")


# sinks and tables


def _boards(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "board_product").withColumn("month", F.date_format(F.timestamp_seconds("last_modified_timestamp"), "yyyy-MM"))


_BOARDS_SQL = "b AS (SELECT *, strftime(to_timestamp(last_modified_timestamp) AT TIME ZONE 'UTC', '%Y-%m') AS month FROM board_product)"


@query(f"""
WITH {_BOARDS_SQL}, t AS (
  SELECT month, product_id, last_modified_timestamp AS ts FROM b WHERE month != '2025-04' UNION ALL SELECT month, product_id, last_modified_timestamp FROM b WHERE month = '2025-03'
  UNION ALL SELECT month, product_id, last_modified_timestamp + 1 FROM b WHERE month = '2025-04' AND product_id IS NOT NULL
) SELECT month, count(*) AS n, count(product_id) AS n_products, CAST(sum(ts) AS BIGINT) AS total FROM t GROUP BY month
""")
def sink_modes(spark: SparkSession, d: str) -> DataFrame:
    """A partitioned table overwritten, appended to, and with one partition replaced."""
    b, path = _boards(spark, d), _folder(spark)
    sinks.overwrite(b, path, "month")
    sinks.append(b.where("month = '2025-03'"), path, "month")
    later = b.where("product_id IS NOT NULL").withColumn("last_modified_timestamp", F.col("last_modified_timestamp") + 1)
    sinks.replace_partitions(later, path, "month", F.col("month") == "2025-04")
    return spark.read.parquet(path).groupBy(F.date_format(F.to_date("month"), "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.count("product_id").alias("n_products"), F.sum("last_modified_timestamp").alias("total"))


@query("""
WITH f AS (SELECT * FROM user_product_faves WHERE product_id IS NOT NULL), n AS (SELECT user_id, product_id FROM f WHERE event_timestamp >= 1746057600 UNION ALL SELECT user_id, product_id FROM f)
SELECT 'inserted' AS step, count(*) AS n FROM n UNION ALL SELECT 'overwritten', count(*) FROM f WHERE event_timestamp >= 1746057600 UNION ALL SELECT 'emptied', 0 UNION ALL SELECT 'replaced', (SELECT count(*) FROM f)
""")
def table_inserts(spark: SparkSession, d: str) -> DataFrame:
    """Row counts of one table after inserts with a condition, an overwriting insert, after all rows went, and after it was replaced."""
    f, name, steps = table(spark, d, "user_product_faves").where("product_id IS NOT NULL"), f"{_database(spark)}.faves", []
    recent = F.col("event_timestamp") >= 1746057600
    sqlrun.ensure_table(spark, name, T.StructType([T.StructField("user_id", T.LongType()), T.StructField("product_id", T.LongType())]))
    columns = ["user_id", "product_id"]
    sinks.insert(f, name, columns, condition=recent)
    sinks.insert(f, name, columns)
    steps.append(("inserted", spark.table(name).count()))
    sinks.insert(f, name, columns, overwrite=True, condition=recent)
    steps.append(("overwritten", spark.table(name).count()))
    sinks.insert(f.where("false"), name, columns, overwrite=True)
    steps.append(("emptied", spark.table(name).count()))
    sinks.insert(dml.staging_to_live(spark.table(name), f.select(*columns), "REPLACE_TABLE"), name, columns, overwrite=True)
    steps.append(("replaced", spark.table(name).count()))
    return spark.createDataFrame(steps, "step string, n long")


@query("""
WITH live AS (SELECT user_id, product_id, event_timestamp FROM user_product_faves), staged AS (SELECT user_id, product_id, max(last_modified_timestamp) AS event_timestamp FROM user_product_faves JOIN board_product USING (product_id) WHERE user_id IS NOT NULL GROUP BY ALL)
SELECT 'WRITE_TRUNCATE' AS mode, count(*) AS n, CAST(sum(event_timestamp) AS BIGINT) AS total FROM staged
UNION ALL SELECT 'REPLACE_TABLE', count(*), CAST(sum(event_timestamp) AS BIGINT) FROM staged
UNION ALL SELECT 'UPSERT', count(*), CAST(sum(event_timestamp) AS BIGINT) FROM (SELECT * FROM staged UNION ALL SELECT * FROM live l WHERE NOT EXISTS (SELECT 1 FROM staged s WHERE s.user_id = l.user_id AND s.product_id = l.product_id))
""")
def staging_modes(spark: SparkSession, d: str) -> DataFrame:
    live = table(spark, d, "user_product_faves").select("user_id", "product_id", "event_timestamp")
    boards = table(spark, d, "board_product").groupBy("product_id").agg(F.max("last_modified_timestamp").alias("_last"))
    staged = live.where("user_id IS NOT NULL").join(boards, "product_id").groupBy("user_id", "product_id").agg(F.max("_last").alias("event_timestamp"))
    out = None
    for mode in ("WRITE_TRUNCATE", "REPLACE_TABLE", "UPSERT"):
        done = dml.staging_to_live(live, staged, mode, ["user_id", "product_id"]).agg(F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("n"), F.sum("event_timestamp").alias("total"))
        out = done if out is None else out.unionByName(done)
    return out


@query("""
SELECT product_id, user_id, event_timestamp FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY user_id DESC NULLS LAST, event_timestamp DESC NULLS LAST) AS rn FROM user_product_faves WHERE event_timestamp > 1744000000 AND product_id IS NOT NULL) WHERE rn = 1
""")
def truncate_insert(spark: SparkSession, d: str) -> DataFrame:
    """A table filled anew with one row per product of the rows that fulfil a condition."""
    f = table(spark, d, "user_product_faves").select("user_id", "product_id", "event_timestamp")
    return dml.truncate_insert(f, ["product_id", "user_id", "event_timestamp"], (F.col("event_timestamp") > 1744000000) & F.col("product_id").isNotNull(), ["product_id"])


@query("SELECT coalesce(CAST(product_id AS VARCHAR), '') AS product_id, coalesce(board_id, '') AS board_id, coalesce(CAST(user_id AS VARCHAR), '') AS user_id FROM (SELECT board_id, product_id, NULL AS user_id FROM board_product UNION ALL SELECT NULL, product_id, user_id FROM user_product_faves)")
def stacked_batches(spark: SparkSession, d: str) -> DataFrame:
    out = schemas.stacked([table(spark, d, "board_product").select("board_id", "product_id"), table(spark, d, "user_product_faves").select("product_id", "user_id")])
    return out.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("product_id", "board_id", "user_id")])


@query(f"WITH {_BOARDS_SQL}, k AS (SELECT board_id, product_id, last_modified_timestamp AS ts FROM b) SELECT 'moved' AS part, count(*) AS n, CAST(sum(ts) AS BIGINT) AS total FROM k WHERE product_id > 1000 UNION ALL SELECT 'kept', count(*), CAST(sum(ts) AS BIGINT) FROM k WHERE product_id <= 1000 OR product_id IS NULL")
def moved_and_kept(spark: SparkSession, d: str) -> DataFrame:
    moved, kept = dml.move_rows(table(spark, d, "board_product"), F.col("product_id") > 1000)
    of = lambda df, part: df.agg(F.lit(part).alias("part"), F.count(F.lit(1)).alias("n"), F.sum("last_modified_timestamp").alias("total"))
    return of(moved, "moved").unionByName(of(kept, "kept"))


@query("SELECT 'none' AS origin, product_id, board_id, CAST(0 AS BIGINT) AS n_saved FROM board_product WHERE product_id IS NOT NULL UNION ALL SELECT 'fave', product_id, '', event_timestamp FROM user_product_faves WHERE product_id IS NOT NULL")
def table_alteration(spark: SparkSession, d: str) -> DataFrame:
    """A table brought to a schema with another order, new columns with defaults, and no nulls; then rows of the new kind are added."""
    name = f"{_database(spark)}.saved"
    sqlrun.ensure_table(spark, name, T.StructType([T.StructField("board_id", T.StringType()), T.StructField("product_id", T.LongType())]))
    sinks.insert(table(spark, d, "board_product").where("product_id IS NOT NULL"), name, ["board_id", "product_id"])
    wanted = T.StructType(
        [
            T.StructField("origin", T.StringType(), False, {"default": "none", "comment": "where it's from"}), T.StructField("product_id", T.LongType(), False),
            T.StructField("board_id", T.StringType(), False, {"default": ""}), T.StructField("n_saved", T.LongType(), False, {"default": 0}),
        ]
    )
    sqlrun.ensure_table(spark, name, wanted)
    f = table(spark, d, "user_product_faves").where("product_id IS NOT NULL")
    sinks.insert(f.select(F.lit("fave").alias("origin"), "product_id", F.lit("").alias("board_id"), F.col("event_timestamp").alias("n_saved")), name, spark.table(name).columns)
    return spark.table(name)


@query("""
WITH known AS (SELECT * FROM (SELECT board_id, product_id, last_modified_timestamp, row_number() OVER (PARTITION BY board_id, product_id ORDER BY last_modified_timestamp DESC NULLS LAST) AS rn FROM board_product WHERE board_id IS NOT NULL AND product_id IN (SELECT product_id FROM product_info)))
SELECT * FROM (SELECT 'held' AS rule, count(*) AS n FROM known WHERE rn = 1 UNION ALL SELECT 'unique board_id, product_id', count(*) FROM known WHERE rn > 1
UNION ALL SELECT 'not null product_id', count(*) FROM board_product WHERE product_id IS NULL
UNION ALL SELECT 'product_id in product_info.product_id', count(*) FROM board_product WHERE product_id IS NOT NULL AND product_id NOT IN (SELECT product_id FROM product_info)) WHERE n > 0
""")
def enforced_rows(spark: SparkSession, d: str) -> DataFrame:
    """How many rows a store with these constraints would hold, and how many each rule refuses."""
    key = schemas.Constraints(("board_id", "product_id"), foreign_keys=(("product_id", "product_info", "product_id"),))
    good, bad = schemas.enforced(table(spark, d, "board_product"), key, {"product_info": table(spark, d, "product_info")})
    return good.agg(F.lit("held").alias("rule"), F.count(F.lit(1)).alias("n")).unionByName(bad.groupBy("rule").agg(F.count(F.lit(1)).alias("n")))


@query("SELECT product_id, n_views + 2 AS n_views FROM active_products")
def versioned_table(spark: SparkSession, d: str) -> DataFrame:
    """A table that replaces itself twice."""
    path = _folder(spark)
    sinks.swap(table(spark, d, "active_products").select("product_id", "n_views"), path)
    for _ in range(2):
        sinks.swap(sinks.current(spark, path).withColumn("n_views", F.col("n_views") + 1), path)
    return sinks.current(spark, path)


@query("SELECT advertiser_name, count(*) AS n FROM active_products WHERE n_views >= 5 GROUP BY 1")
def sql_output(spark: SparkSession, d: str) -> DataFrame:
    """A script with a bound table name whose result, without repeats, is saved as a table and appended to the same way."""
    name = f"{_database(spark)}.counts"
    views = {"seen_input": table(spark, d, "active_products")}
    script = "SELECT advertiser_name FROM IDENTIFIER(:source) WHERE n_views >= :least;"
    sqlrun.run(spark, script, {"source": "seen_input", "least": 5}, views, output=name, mode="overwrite")
    return sqlrun.run(spark, "SELECT advertiser_name, count(*) AS n FROM IDENTIFIER(:source) GROUP BY advertiser_name; ", {"source": name}, drop_duplicates=True, output=f"{name}_again")


@query("SELECT true AS in_order, count(*) AS n, min(product_id) AS least FROM active_products")
def sorted_output(spark: SparkSession, d: str) -> DataFrame:
    """Whether the files of a sorted table, by name, hold ranges one after the other, each in order."""
    path = _folder(spark)
    sinks.write_sorted(table(spark, d, "active_products").select("product_id", "product_name"), path, "product_id")
    rows = spark.read.parquet(path).withColumns({"_file": F.input_file_name(), "_at": F.monotonically_increasing_id()})
    from pyspark.sql import Window

    inside = rows.withColumn("_before", F.lag("product_id").over(Window.partitionBy("_file").orderBy("_at")))
    parts = inside.groupBy("_file").agg(F.min("product_id").alias("low"), F.max("product_id").alias("high"), F.bool_and(F.coalesce(F.col("_before") <= F.col("product_id"), F.lit(True))).alias("ok"), F.count(F.lit(1)).alias("n"))
    chained = parts.withColumn("_last", F.lag("high").over(Window.orderBy("_file")))
    return chained.agg(F.bool_and(F.col("ok") & F.coalesce(F.col("_last") <= F.col("low"), F.lit(True))).alias("in_order"), F.sum("n").alias("n"), F.min("low").alias("least"))


def _writer(path: str):
    """A function for executors that keeps what it is given as a file of JSON lines under path."""

    def keep(rows: list) -> None:
        import pyarrow.fs as pafs

        fs, root = pafs.FileSystem.from_uri(path if ":" in path else f"file://{path}")
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/{uuid.uuid4().hex}.json") as out:
            out.write("".join(json.dumps(r if isinstance(r, dict) else {"product_id": r}) + "\n" for r in rows).encode())

    return keep


@query("""
SELECT 'delete' AS action, product_id, NULL AS product_name, NULL AS execution_date FROM product_info WHERE product_id NOT IN (SELECT product_id FROM active_products)
UNION ALL SELECT 'send', product_id, product_name, CAST(execution_date AS VARCHAR) FROM active_products
""")
def index_sync(spark: SparkSession, d: str) -> DataFrame:
    """What a search index that holds all products is told, to hold the active ones: deletions in batches, then documents."""
    sent, gone = _folder(spark), _folder(spark)
    sinks.sync_index(table(spark, d, "active_products").select("product_id", "product_name", "execution_date"), table(spark, d, "product_info"), "product_id", _writer(sent), _writer(gone))
    schema = "product_id long, product_name string, execution_date string"
    return feeds.read_json(spark, gone, schema).withColumn("action", F.lit("delete")).unionByName(feeds.read_json(spark, sent, schema).withColumn("action", F.lit("send")))


@query(f"""
WITH t AS ({catalog_queries.SQL["trending_documents"]})
SELECT suggestion_text, product_label, row_number() OVER (ORDER BY suggestion_text, product_label, product_id) - 1 AS rank, true AS drawn FROM t
""")
def trending_ranks(spark: SparkSession, d: str) -> DataFrame:
    """Trending documents by rank; the random rank, too, is a number from 0 to 1 that a repeat gives again."""
    docs = catalog_queries.trending_documents(spark, d)
    ranked = sinks.ranked_documents(docs, [F.col("suggestion_text"), F.col("product_label"), F.col("product_id")])
    random = sinks.ranked_documents(docs, name="random").withColumnRenamed("random", "_a").join(sinks.ranked_documents(docs, name="random").withColumnRenamed("random", "_b"), docs.columns)
    both = ranked.join(random, docs.columns)
    return both.select("suggestion_text", "product_label", "rank", ((F.col("_a") == F.col("_b")) & F.col("_a").between(0, 1)).alias("drawn"))


@query("SELECT advertiser_name, string_agg(DISTINCT product_brand, ',_,' ORDER BY product_brand) AS product_brand, 'brand' AS kind, true AS keyed FROM product_info GROUP BY 1")
def autocomplete_upload(spark: SparkSession, d: str) -> DataFrame:
    """Names for completion with a constant field and a key, sent to an index that was emptied before."""
    from selvedge.operators import serving

    names = serving.joined_names(table(spark, d, "product_info"), "advertiser_name", "product_brand").withColumn("kind", F.lit("brand"))
    keyed, path = sinks.document_keys(names, ["advertiser_name", "product_brand"]), _folder(spark)
    stale = keyed.withColumn("kind", F.lit("stale"))
    sinks.upload(stale, _writer(path))
    sinks.replace_index(keyed, lambda: sinks.remove(spark, path), _writer(path), 1000)
    back = feeds.read_json(spark, path, keyed.schema).withColumnRenamed("document_id", "_was")
    return sinks.document_keys(back, ["advertiser_name", "product_brand"]).select("advertiser_name", "product_brand", "kind", (F.col("_was") == F.col("document_id")).alias("keyed"))


# catalogue columns


@query("""
WITH p AS (SELECT product_id, advertiser_name AS a, product_image_url AS u, product_additional_image_urls AS g FROM product_info),
v AS (SELECT product_id, u, CASE
  WHEN a = 'Brindlecote' AND regexp_matches(u, '\\.jpg') THEN [regexp_replace(u, '\\.jpg', '_side.jpg', 'g'), regexp_replace(u, '\\.jpg', '_back.jpg', 'g')]
  WHEN a = 'Quillon Row' AND regexp_matches(u, '/p/') THEN CASE WHEN regexp_matches(u, '[02468]\\.jpg') THEN [regexp_replace(u, '/p/', '/even/', 'g')] ELSE [regexp_replace(u, '/p/', '/odd/', 'g'), regexp_replace(u, '/p/', '/more/', 'g')] END
  WHEN a = 'Umbrell' THEN list_transform(g, lambda x: regexp_replace(x, '^https', 'http', 'g'))
  WHEN a IN ('Brindlecote', 'Quillon Row') OR a NOT IN ('Tarnwick', 'Umbrell') OR a IS NULL OR NOT regexp_matches(u, '\\.jpg') OR u IS NULL THEN []
  ELSE [regexp_replace(u, '\\.jpg', '_1.jpg', 'g'), regexp_replace(u, '\\.jpg', '_2.jpg', 'g'), regexp_replace(u, '\\.jpg', '_3.jpg', 'g')] END AS found FROM p)
SELECT product_id, array_to_string(list_sort(list_distinct(list_filter(found, lambda x: x IS NOT NULL AND length(x) > 0 AND (u IS NULL OR x != u)))), ' ') AS urls FROM v WHERE found IS NOT NULL
""")
def image_variants(spark: SparkSession, d: str) -> DataFrame:
    """Image addresses by each advertiser's own rule: named views, views by a condition, given ones rewritten, numbered ones; advertisers without rule have none."""
    p = table(spark, d, "product_info").withColumnsRenamed({"product_image_url": "u", "product_additional_image_urls": "g"})
    u = F.col("u")
    found = catalog.variants_by_advertiser(
        F.col("advertiser_name"),
        {
            "Brindlecote": catalog.named_variants(u, r"\.jpg", ["_side.jpg", "_back.jpg"]), "Quillon Row": catalog.chosen_variants(u, "/p/", u.rlike(r"[02468]\.jpg"), ["/even/"], ["/odd/", "/more/"]),
            "Umbrell": catalog.rewritten_list(F.col("g"), "^https", "http"), "Tarnwick": catalog.numbered_variants(u, r"\.jpg", "_%d.jpg", 1, 3),
        },
    )
    return p.withColumn("_v", found).where("_v IS NOT NULL").select("product_id", F.concat_ws(" ", F.array_sort(catalog.additional_images(u, A.strings(), F.col("_v")))).alias("urls"))


@query("SELECT count(*) AS n_rows, count(DISTINCT (advertiser_name, product_image_url)) AS n_identities, count(DISTINCT (advertiser_name, product_image_url)) AS n_keys, true AS none_negative FROM product_info WHERE advertiser_name IS NOT NULL AND product_image_url IS NOT NULL")
def surrogate_keys(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "product_info").where("advertiser_name IS NOT NULL AND product_image_url IS NOT NULL").withColumn("k", A.surrogate_key(F.col("advertiser_name"), F.col("product_image_url")))
    return p.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("advertiser_name", "product_image_url").alias("n_identities"), F.countDistinct("k").alias("n_keys"), F.bool_and(F.col("k") >= 0).alias("none_negative"))


@query("SELECT product_id, array_to_string(list_transform(list_slice(list_reverse_sort(list_filter(product_image_embedding, lambda x: x IS NOT NULL)), 1, 3), lambda x: printf('%.4f', CAST(x AS DOUBLE))), ' ') AS top FROM active_products WHERE product_image_embedding IS NOT NULL")
def largest_numbers(spark: SparkSession, d: str) -> DataFrame:
    top = A.largest(F.col("product_image_embedding"), 3)
    return table(spark, d, "active_products").where("product_image_embedding IS NOT NULL").select("product_id", F.concat_ws(" ", F.transform(top, lambda x: F.format_string("%.4f", x.cast("double")))).alias("top"))


@query("""
WITH n AS (SELECT advertiser_name, count(*) AS n FROM active_products GROUP BY 1)
SELECT product_id, true AS in_range, true AS repeated, coalesce(array_to_string(list_transform(product_details, lambda x: coalesce(x.size, '?') || '=' || coalesce(x.product_purchase_url, '?')), '|'), '') AS sizes
FROM active_products JOIN n USING (advertiser_name)
""")
def search_order(spark: SparkSession, d: str) -> DataFrame:
    """The order weight of search documents lies below the advertiser's size to the power 11/12 and is the same when drawn again; sizes as given."""
    p = table(spark, d, "active_products")
    none = spark.createDataFrame([], "product_id long, other_id long, color string")
    docs, again = tags.search_documents(p, none), tags.search_documents(p, none).select("product_id", F.col("default_search_order").alias("_again"))
    sizes = p.groupBy("advertiser_name").agg(F.count(F.lit(1)).alias("_n"))
    text = F.array_join(F.transform("sizes", lambda x: F.concat(F.coalesce(x["size"], F.lit("?")), F.lit("="), F.coalesce(x["product_purchase_url"], F.lit("?")))), "|")
    order = F.col("default_search_order")
    return docs.join(again, "product_id").join(sizes, "advertiser_name").select("product_id", ((order >= 0) & (order < F.pow("_n", F.lit(11 / 12)))).alias("in_range"), (order == F.col("_again")).alias("repeated"), F.coalesce(text, F.lit("")).alias("sizes"))


# images

_BYTE_SQL = "greatest(0, least(255, CAST(round(CAST(x AS DOUBLE) * 255 + 128) AS INTEGER)))"


def _grey(spark: SparkSession, d: str, width: int, height: int) -> DataFrame:
    """A grey image of each vector: its first numbers as bytes."""
    byte = lambda x: F.greatest(F.lit(0), F.least(F.lit(255), F.round(x.cast("double") * 255 + 128).cast("int")))
    hexed = F.transform(F.slice("embedding", 1, width * height), lambda x: F.lpad(F.hex(byte(x).cast("long")), 2, "0"))
    head = F.encode(F.lit(f"P5\n{width} {height}\n255\n"), "utf-8")
    return table(spark, d, "embeddings").select("vec_id", F.concat(head, F.unhex(F.array_join(hexed, ""))).alias("image"))


@query(f"""
WITH b AS (SELECT vec_id, list_transform(list_slice(embedding, 1, 30), lambda x: {_BYTE_SQL}) AS p FROM embeddings),
bits AS (SELECT vec_id, list_transform(range(0, 32), lambda i: CASE WHEN i < 25 AND p[(i // 5) * 6 + i % 5 + 2] > p[(i // 5) * 6 + i % 5 + 1] THEN 1 ELSE 0 END) AS x FROM b)
SELECT vec_id, array_to_string(list_transform(range(0, 4), lambda k: printf('%02X', CAST(list_sum(list_transform(range(0, 8), lambda j: x[k * 8 + j + 1] * CAST(pow(2, 7 - j) AS INTEGER))) AS INTEGER))), '') AS image_hash FROM bits
""")
def image_hash(spark: SparkSession, d: str) -> DataFrame:
    """Difference hashes of images of 6 x 5 pixels, the size at which they are compared."""
    return images.with_hash(_grey(spark, d, 6, 5), "image").select("vec_id", F.hex("image_hash").alias("image_hash"))


#: A model of two features for the query below: what the upper and the lower half of an 8 x 8 image add up to.
HALVES = np.vstack([np.r_[np.ones(32), np.zeros(32)], np.r_[np.zeros(32), np.ones(32)]])


@query(f"""
WITH b AS (SELECT vec_id, list_transform(embedding, lambda x: {_BYTE_SQL} / 127.5 - 1) AS p FROM embeddings),
f AS (SELECT vec_id, list_sum(list_slice(p, 1, 32)) AS x, list_sum(list_slice(p, 33, 64)) AS y FROM b)
SELECT vec_id, round(x / (sqrt(x * x + y * y) + 1e-5), 3) + 0.0 AS upper, round(y / (sqrt(x * x + y * y) + 1e-5), 3) + 0.0 AS lower FROM f
""")
def image_embedding(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of images by a model whose weights are broadcast."""
    out = images.embedded(_grey(spark, d, 8, 8), "image", images.linear_model(spark, HALVES), side=8)
    x = F.col("product_image_embedding")
    return out.select("vec_id", (F.round(x[0].cast("double"), 3) + F.lit(0.0)).alias("upper"), (F.round(x[1].cast("double"), 3) + F.lit(0.0)).alias("lower"))


# streams

_KINDS = {"n_clicks": "click", "n_purchases": "purchase"}


def _event_files(spark: SparkSession, d: str) -> tuple[str, str]:
    path = _folder(spark)
    ev = table(spark, d, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    ev.repartition(4, "event_id").write.parquet(path)
    return path, "event_id long, user_id long, event_type string, ts timestamp"


@query("SELECT user_id, count(*) FILTER (event_type = 'click') AS n_clicks, count(*) FILTER (event_type = 'purchase') AS n_purchases FROM events GROUP BY 1 HAVING n_clicks > 0 OR n_purchases > 0")
def stream_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counters kept by a stream of several batches, of which each is delivered twice."""
    source, schema = _event_files(spark, d)
    path, marks = _folder(spark), _folder(spark)
    count = stream.counting(path, ["user_id"], {n: F.col("event_type") == k for n, k in _KINDS.items()}, compact_every=2)

    def twice(batch: DataFrame, number: int) -> None:
        count(batch, number)
        count(batch, number)

    stream.run_batches(stream.read_events(spark, source, schema, 1), twice, marks).awaitTermination()
    return sinks.counts(spark, path, ["user_id"])


@query("SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events")
def stream_log(spark: SparkSession, d: str) -> DataFrame:
    """A log that a stream appends to, partitioned by the day of the event, started twice."""
    source, schema = _event_files(spark, d)
    path, marks = _folder(spark), _folder(spark)
    for _ in range(2):
        stream.run_batches(stream.read_events(spark, source, schema, 1), stream.append_batches(path, "ts"), marks).awaitTermination()
    return spark.read.parquet(path).select("event_id", F.col("execution_date").cast("string").alias("day"))


@query("""
SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(CASE WHEN ts < TIMESTAMP '2024-01-10' THEN 1 ELSE 2 END AS BIGINT) AS batch FROM events WHERE ts < TIMESTAMP '2024-01-25'
""")
def late_events(spark: SparkSession, d: str) -> DataFrame:
    """Two ingestions: what comes after the first cutoff goes with the second batch, under its own day."""
    ev = table(spark, d, "events").withColumn("event_timestamp", F.unix_timestamp(F.col("ts").cast("timestamp")))
    at = lambda day: F.lit(int(datetime.datetime(2024, 1, day, tzinfo=datetime.timezone.utc).timestamp()))
    first, rest = stream.ingested(ev, at(10), F.lit(1))
    second, _ = stream.ingested(rest, at(25), F.lit(2))
    return first.unionByName(second).select("event_id", F.col("execution_date").cast("string").alias("day"), F.col("batch_timestamp").alias("batch"))
