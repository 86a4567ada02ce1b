"""Queries of the catalogue operators over the named tables, with their SQL."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from selvedge import schemas
from selvedge.functions import arrays as A
from selvedge.operators import catalog, dml, lifecycle, rules, serving, similarity, tags
from selvedge.plans import sqlrun
from selvedge.session import checkpointed
from selvedge.sources import feeds
from selvedge.sources.tables import table
from selvedge.streaming import events as stream

QUERIES, SQL = {}, {}

LABELS = {
    "knitwear": [{"product_name": ["sweater", "jumper"]}],
    "footwear": [{"product_name": ["boots", "sandals", "sneakers", "trainers"]}, {"product_labels": "shoes"}],
    "plant_fibre": [{"product_description": ["linen", "cotton"], "EXCLUDE": {"product_description": "polyester"}}],
    "outlet": [{"product_external_labels": "outlet"}],
}
SECONDARY = {"waterproof": [{"product_description": "wipe clean"}], "small_batch": [{"product_description": "small batches"}]}
COLORS = {"red": "red|crimson", "green": "green|sage|olive", "blue": "navy|indigo|cobalt", "white": "white|ivory|ecru"}
DROP = [{"product_name": "limited edition"}, {"product_description": "imported", "product_brand": "studio"}]
URLS = {
    "Brindlecote": [("/p/", "/large/")],
    "Quillon Row": [(r"\.jpg$", ".webp")],
    "Umbrell": [(r"^https://[^/]*", "https://cdn.umbrell.example"), (r"\?.*$", "")],
    "Corrin Vale": [(r"^.*/([^/]*)$", "https://cdn.corrinvale.example/$1")],
}
SYNONYMS = {"bag": ["oversized"], "slim": ["cropped", "wrap"], "shoes": ["lined"], "midi": ["maxi"]}
PRIORITY = ["quilted", "ribbed", "lined"]
PART_COLORS = ["red", "blue", "green", "small", "large", "hot", "cold"]
CUTOFF = "2024-01-20"
TASTE = {"click": 1.0, "purchase": 3.0, "view": -1.0}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def euros(c: str):
    return F.round(F.col(c).cast("double"), 2).alias(c)


# sources and normalisation


@query("""
SELECT advertiser_name, product_image_url, product_name, CAST(execution_date AS VARCHAR) AS day, round(CAST(coalesce(product_sale_price, product_price) AS DOUBLE), 2) AS product_sale_price, coalesce(len(product_tags), 0) AS n_tags
FROM (SELECT DISTINCT * REPLACE (DATE '2025-06-11' AS execution_date) FROM daily_product_dump) WHERE advertiser_name IS NOT NULL AND product_image_url IS NOT NULL AND product_name IS NOT NULL AND product_price IS NOT NULL
""")
def basic_info(spark: SparkSession, d: str) -> DataFrame:
    dump = table(spark, d, "daily_product_dump").withColumn("execution_date", F.lit(datetime.date(2025, 6, 11)))
    out = catalog.basic_info(dump, F.lit(datetime.date(2025, 6, 11)), ["advertiser_name", "product_image_url", "product_name", "product_price"], ["advertiser_name", "product_image_url"], ["product_tags"])
    return out.select("advertiser_name", "product_image_url", "product_name", F.col("execution_date").cast("string").alias("day"), euros("product_sale_price"), F.size("product_tags").alias("n_tags"))


@query("""
SELECT json_extract_string(payload, '$.id') AS external_id, advertiser_name, json_extract_string(payload, '$.title') AS product_name, TRY_CAST(replace(regexp_extract(json_extract_string(payload, '$.product_price'), '([0-9]+(?:[.,][0-9]+)?)', 1), ',', '.') AS FLOAT) AS product_price, coalesce(json_extract_string(payload, '$.color'), '') AS color
FROM daily_product_dump_raw WHERE json_valid(payload)
""")
def feed_map(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "daily_product_dump_raw").where(F.try_parse_json("payload").isNotNull())
    feed = raw.select(F.get_json_object("payload", "$.id").alias("id"), F.col("advertiser_name").alias("merchant_name"), F.get_json_object("payload", "$.title").alias("title"), F.get_json_object("payload", "$.product_price").alias("search_price"), F.get_json_object("payload", "$.color").alias("colour"))
    out = feeds.mapped(feed, feeds.feed_spec(feed), schemas.DAILY_PRODUCT_DUMP)
    return out.select("external_id", "advertiser_name", "product_name", "product_price", F.coalesce("color", F.lit("")).alias("color"))


@query("""
SELECT product_id, external_id, len(product_tags) AS n_tags, product_details IS NULL AS no_details FROM
(SELECT product_id, CAST(external_id AS VARCHAR) AS external_id, coalesce(product_tags, []) AS product_tags, product_details FROM active_products)
""")
def aligned_products(spark: SparkSession, d: str) -> DataFrame:
    """Active products in the schema of product information: other order, other type of external_id, columns less."""
    out = schemas.align(table(spark, d, "active_products"), schemas.PRODUCT_INFO)
    return out.select("product_id", "external_id", F.size("product_tags").alias("n_tags"), F.col("product_details").isNull().alias("no_details"))


@query("""
SELECT * FROM (
  SELECT 'not null product_id' AS rule, count(*) FILTER (product_id IS NULL) AS n_rows FROM board_product
  UNION ALL SELECT 'unique board_id, product_id', sum(n - 1) FROM (SELECT count(*) AS n FROM board_product WHERE board_id IS NOT NULL AND product_id IS NOT NULL GROUP BY board_id, product_id HAVING count(*) > 1)
  UNION ALL SELECT 'product_id in product_info.product_id', count(*) FROM board_product WHERE product_id IS NOT NULL AND product_id NOT IN (SELECT product_id FROM product_info)
) WHERE n_rows > 0
""")
def constraint_violations(spark: SparkSession, d: str) -> DataFrame:
    boards = table(spark, d, "board_product")
    return schemas.violations(boards, schemas.Constraints(("board_id", "product_id"), foreign_keys=(("product_id", "product_info", "product_id"),)), {"product_info": table(spark, d, "product_info")})


@query("""
SELECT product_id, 'knitwear' AS product_label FROM product_info WHERE regexp_matches(product_name, '(?i)sweater') OR regexp_matches(product_name, '(?i)jumper')
UNION ALL SELECT product_id, 'footwear' FROM product_info WHERE regexp_matches(product_name, '(?i)boots|sandals|sneakers|trainers') OR regexp_matches(array_to_string(list_sort(product_labels), ' && '), '(?i)shoes')
UNION ALL SELECT product_id, 'plant_fibre' FROM product_info WHERE regexp_matches(product_description, '(?i)linen|cotton') AND NOT regexp_matches(product_description, '(?i)polyester')
UNION ALL SELECT product_id, 'outlet' FROM product_info WHERE regexp_matches(array_to_string(list_sort(product_external_labels), ' && '), '(?i)outlet')
""")
def label_rules(spark: SparkSession, d: str) -> DataFrame:
    return rules.labelled(table(spark, d, "product_info"), LABELS, "product_id", "product_label")


@query(" UNION ALL ".join(f"SELECT product_id, '{k}' AS internal_color FROM product_info WHERE coalesce(regexp_matches(color, '(?i){p}'), false) OR coalesce(regexp_matches(product_name, '(?i)\\b{p}\\b'), false)" for k, p in COLORS.items()))
def internal_colors(spark: SparkSession, d: str) -> DataFrame:
    return rules.labelled(table(spark, d, "product_info"), rules.color_rules(COLORS), "product_id", "internal_color")


@query("""
SELECT product_id FROM product_info WHERE NOT (coalesce(regexp_matches(product_name, '(?i)limited edition'), false) OR (coalesce(regexp_matches(product_description, '(?i)imported'), false) AND coalesce(regexp_matches(product_brand, '(?i)studio'), false)))
""")
def drop_rules(spark: SparkSession, d: str) -> DataFrame:
    return rules.dropped(table(spark, d, "product_info"), DROP).select("product_id")


def _names(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "product_info").where("advertiser_name != 'Tarnwick'")
    return p.select("product_id", catalog.clean_name(F.col("product_name"), F.col("color"), F.col("size"), "Gift idea ").alias("product_name"))


_STEP = "trim(regexp_replace({0}, '{1}', '', 'g'))"
_NAMES = "product_name"
for _p in ("^Gift idea ", " - .*", r"\..*", *[rf"(?i)\b{w}\b" for w in ("extra", "x", "small", "medium", "large")]):
    _NAMES = _STEP.format(_NAMES, _p)
NAMES_SQL = f"""
WITH a AS (SELECT product_id, {_NAMES} AS n, trim(size) AS s, regexp_replace(color, '[^0-9a-zA-Z:, ]', '', 'g') AS c FROM product_info WHERE advertiser_name != 'Tarnwick'),
b AS (SELECT product_id, c, trim(regexp_replace(CASE WHEN length(s) > 0 THEN trim(regexp_replace(n, '(?i)(^|\\s)' || regexp_escape(s) || '(\\s|$)', ' ', 'g')) ELSE n END, '(?i)\\bsize$', '', 'g')) AS n FROM a),
e AS (SELECT product_id, c, CASE WHEN length(c) > 0 THEN trim(regexp_replace(n, '(?i)\\bin ' || regexp_escape(c) || '.*', '', 'g')) ELSE n END AS n FROM b)
SELECT product_id, CASE WHEN length(c) > 0 THEN trim(regexp_replace(n, '(?i)-.' || regexp_escape(c) || '.*', '', 'g')) ELSE n END AS product_name FROM e
"""


@query(NAMES_SQL)
def clean_names(spark: SparkSession, d: str) -> DataFrame:
    return _names(spark, d)


def _urls(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "product_info")
    return p.select("product_id", catalog.rewritten_url(F.col("product_image_url"), F.col("advertiser_name"), URLS).alias("product_image_url")).where("product_image_url IS NOT NULL")


URL_SQL = r"""
SELECT product_id, CASE advertiser_name WHEN 'Brindlecote' THEN replace(product_image_url, '/p/', '/large/') WHEN 'Quillon Row' THEN regexp_replace(product_image_url, '\.jpg$', '.webp')
  WHEN 'Umbrell' THEN regexp_replace(regexp_replace(product_image_url, '^https://[^/]*', 'https://cdn.umbrell.example'), '\?.*$', '')
  ELSE 'https://cdn.corrinvale.example/' || split_part(product_image_url, '/', -1) END AS product_image_url
FROM product_info WHERE advertiser_name IN ('Brindlecote', 'Quillon Row', 'Umbrell', 'Corrin Vale') AND product_image_url IS NOT NULL
"""


@query(URL_SQL)
def url_rewrite(spark: SparkSession, d: str) -> DataFrame:
    return _urls(spark, d)


@query(r"""
SELECT product_id, array_to_string(list_sort(list_distinct(list_filter(list_concat(coalesce(product_additional_image_urls, []), CASE WHEN regexp_matches(product_image_url, '\.jpg$') THEN [regexp_replace(product_image_url, '\.jpg$', '_1.jpg'), regexp_replace(product_image_url, '\.jpg$', '_2.jpg')] ELSE [] END), lambda u: u IS NOT NULL AND length(u) > 0 AND (product_image_url IS NULL OR u != product_image_url)))), ' ') AS urls
FROM product_info
""")
def extra_urls(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "product_info")
    main = F.col("product_image_url")
    all_urls = catalog.additional_images(main, F.col("product_additional_image_urls"), catalog.numbered_variants(main, r"\.jpg$", "_%d.jpg", 1, 2))
    return p.select("product_id", F.concat_ws(" ", F.array_sort(all_urls)).alias("urls"))


@query(f"""
WITH labels AS ({SQL['label_rules']}), colors AS ({SQL['internal_colors']}), names AS ({NAMES_SQL}), urls AS ({URL_SQL}),
second AS (SELECT product_id, 'waterproof' AS s FROM product_info WHERE regexp_matches(product_description, '(?i)wipe clean') UNION ALL SELECT product_id, 'small_batch' FROM product_info WHERE regexp_matches(product_description, '(?i)small batches')),
joined AS (
  SELECT p.product_id, string_agg(DISTINCT l.product_label, ',' ORDER BY l.product_label) AS labels, coalesce(any_value(s.secondary), '') AS secondary, coalesce(any_value(n.product_name), any_value(p.product_name)) AS product_name, coalesce(any_value(u.product_image_url), any_value(p.product_image_url)) AS product_image_url, coalesce(any_value(c.internal_color), any_value(p.internal_color)) AS internal_color, any_value(p.product_description) AS descr, any_value(p.product_brand) AS brand
  FROM product_info p JOIN labels l USING (product_id) LEFT JOIN names n USING (product_id) LEFT JOIN urls u USING (product_id)
  LEFT JOIN (SELECT product_id, min(internal_color) AS internal_color FROM colors GROUP BY 1) c USING (product_id)
  LEFT JOIN (SELECT product_id, string_agg(DISTINCT s, ',' ORDER BY s) AS secondary FROM second GROUP BY 1) s USING (product_id) GROUP BY p.product_id
)
SELECT product_id, labels, secondary, product_name, product_image_url, internal_color FROM joined
WHERE NOT (coalesce(regexp_matches(product_name, '(?i)limited edition'), false) OR (coalesce(regexp_matches(descr, '(?i)imported'), false) AND coalesce(regexp_matches(brand, '(?i)studio'), false)))
""")
def combine_info(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "product_info")
    overrides = {"product_name": _names(spark, d), "product_image_url": _urls(spark, d), "internal_color": internal_colors(spark, d)}
    out = catalog.combined(p, label_rules(spark, d), overrides, rules.labelled(p, SECONDARY, "product_id", "product_secondary_label"), rules.condition(DROP))
    return out.select("product_id", F.concat_ws(",", "product_labels").alias("labels"), F.concat_ws(",", "product_secondary_labels").alias("secondary"), "product_name", "product_image_url", "internal_color")


@query("""
WITH g AS (SELECT DISTINCT product_id, coalesce(lower(color), '?') || '/' || coalesce(size, '?') || '/' || coalesce(printf('%.2f', CAST(product_price AS DOUBLE)), '?') || '/' || coalesce(printf('%.2f', CAST(product_sale_price AS DOUBLE)), '?') AS x, lower(color) AS c, size, product_price AS a, product_sale_price AS b, product_purchase_url AS u FROM daily_product_dump WHERE product_id IS NOT NULL AND execution_date IS NOT NULL)
SELECT product_id, count(*) AS n_details, string_agg(x, '|' ORDER BY x) AS details, (SELECT CAST(min(execution_date) AS VARCHAR) FROM daily_product_dump d WHERE d.product_id = g.product_id) IS NOT NULL AS dated FROM g GROUP BY product_id
""")
def group_details(spark: SparkSession, d: str) -> DataFrame:
    out = catalog.grouped(table(spark, d, "daily_product_dump").where("product_id IS NOT NULL AND execution_date IS NOT NULL"))
    price = lambda x: F.when(x.isNotNull(), F.format_string("%.2f", x.cast("double")))
    text = lambda x: F.array_join(F.array(x["color"], x["size"], price(x["product_price"]), price(x["product_sale_price"])), "/", "?")
    return out.select("product_id", F.size("product_details").cast("long").alias("n_details"), F.array_join(F.array_sort(F.transform("product_details", text)), "|").alias("details"), F.col("execution_date").isNotNull().alias("dated"))


@query("SELECT product_id, x.size AS size, min(x.product_purchase_url) AS product_purchase_url FROM (SELECT product_id, unnest(product_details) AS x FROM active_products) WHERE x.size IS NOT NULL GROUP BY ALL")
def size_info(spark: SparkSession, d: str) -> DataFrame:
    return catalog.size_info(table(spark, d, "active_products"))


@query("SELECT board_id, product_id FROM board_product WHERE product_id IS NOT NULL AND product_id NOT IN (SELECT product_id FROM user_product_faves WHERE product_id IS NOT NULL)")
def filter_invalid(spark: SparkSession, d: str) -> DataFrame:
    return catalog.valid_images(table(spark, d, "board_product"), table(spark, d, "user_product_faves"), "product_id").select("board_id", "product_id")


@query("SELECT user_id, product_id, max(event_timestamp) AS event_timestamp FROM user_product_faves GROUP BY user_id, product_id")
def dedup_first(spark: SparkSession, d: str) -> DataFrame:
    return catalog.first_per_key(table(spark, d, "user_product_faves"), ["user_id", "product_id"], [F.desc_nulls_last("event_timestamp")]).select("user_id", "product_id", "event_timestamp")


# lifecycle

_DAY = datetime.date(2025, 6, 12)
TODAY_SQL = "today AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY execution_timestamp DESC, product_name DESC) AS rn FROM daily_product_dump WHERE product_id IS NOT NULL AND execution_date = (SELECT max(execution_date) FROM daily_product_dump)) WHERE rn = 1)"
HISTORIC_SQL = "historic AS (SELECT product_id, execution_date, 1 AS n_views, 0 AS n_likes FROM product_info WHERE execution_date < DATE '2025-05-01')"


def _today(spark: SparkSession, d: str) -> DataFrame:
    dump = table(spark, d, "daily_product_dump").where("product_id IS NOT NULL")
    last = dump.agg(F.max("execution_date")).first()[0]
    return dml.last_per_key(dump.where(F.col("execution_date") == F.lit(last)), ["product_id"], F.desc("execution_timestamp"), F.desc("product_name"))


def _historic(spark: SparkSession, d: str) -> DataFrame:
    """A historic table to merge into: the products loaded before May, each seen once."""
    p = table(spark, d, "product_info").where("execution_date < DATE '2025-05-01'")
    return p.select("product_id", "execution_date", F.lit(1).alias("n_views"), *[F.lit(0).alias(c) for c in schemas.COUNTERS[1:]])


@query(f"""
WITH {TODAY_SQL}, {HISTORIC_SQL}, gone AS (SELECT product_id, n_views, n_likes FROM active_products WHERE product_id NOT IN (SELECT product_id FROM today))
SELECT coalesce(h.product_id, g.product_id) AS product_id, coalesce(h.n_views, 0) + coalesce(g.n_views, 0) AS n_views, coalesce(h.n_likes, 0) + coalesce(g.n_likes, 0) AS n_likes, CAST(CASE WHEN g.product_id IS NOT NULL THEN DATE '2025-06-12' ELSE h.execution_date END AS VARCHAR) AS day
FROM historic h FULL JOIN gone g ON h.product_id = g.product_id
""")
def active_to_historic(spark: SparkSession, d: str) -> DataFrame:
    active = table(spark, d, "active_products").select("product_id", "execution_date", *schemas.COUNTERS)
    out = lifecycle.to_historic(active, _historic(spark, d), _today(spark, d), F.lit(_DAY))
    return out.select("product_id", "n_views", "n_likes", F.col("execution_date").cast("string").alias("day"))


@query(f"WITH {TODAY_SQL} SELECT product_id, product_name FROM active_products WHERE product_id IN (SELECT product_id FROM today)")
def delete_inactive(spark: SparkSession, d: str) -> DataFrame:
    return lifecycle.delete_inactive(table(spark, d, "active_products"), _today(spark, d)).select("product_id", "product_name")


@query(f"""
WITH {TODAY_SQL} SELECT a.product_id, CASE WHEN t.product_id IS NOT NULL THEN t.product_name ELSE a.product_name END AS product_name, round(CAST(CASE WHEN t.product_id IS NOT NULL THEN t.product_sale_price ELSE a.product_sale_price END AS DOUBLE), 2) AS product_sale_price, a.n_views
FROM active_products a LEFT JOIN today t ON a.product_id = t.product_id
""")
def update_active(spark: SparkSession, d: str) -> DataFrame:
    new = _today(spark, d).select("product_id", "product_name", "product_sale_price")
    return lifecycle.update_active(table(spark, d, "active_products"), new).select("product_id", "product_name", euros("product_sale_price"), "n_views")


@query(f"""
WITH {TODAY_SQL} SELECT product_id, product_name, n_views FROM active_products
UNION ALL SELECT t.product_id, t.product_name, 0 FROM today t WHERE t.product_id IN (SELECT product_id FROM user_product_faves) AND t.product_id NOT IN (SELECT product_id FROM active_products)
""")
def append_new(spark: SparkSession, d: str) -> DataFrame:
    active = table(spark, d, "active_products").select("product_id", "product_name", "product_image_embedding", *schemas.COUNTERS)
    today = _today(spark, d).select("product_id", "product_name")
    saved = table(spark, d, "user_product_faves").where("product_id IS NOT NULL").select("product_id").distinct()
    vectors = saved.select("product_id", F.array(F.lit(1.0)).cast("array<float>").alias("product_image_embedding"))
    return lifecycle.append_new(active, today, vectors).select("product_id", "product_name", "n_views")


EVENTS_SQL = "ev AS (SELECT user_id, CASE event_type WHEN 'click' THEN 'fave' WHEN 'view' THEN 'trash' WHEN 'purchase' THEN 'bag' END AS event, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id, ts FROM events)"


def _events(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "click", "fave").when(F.col("event_type") == "view", "trash").when(F.col("event_type") == "purchase", "bag")
    return table(spark, d, "events").select("user_id", kind.alias("event"), "event_type", F.get_json_object("props", "$.k").cast("long").alias("product_id"), "ts")


@query(f"WITH {EVENTS_SQL} SELECT product_id, count(*) FILTER (event IN ('fave', 'trash')) AS n_views, count(*) FILTER (event = 'fave') AS n_likes, count(*) FILTER (event = 'bag') AS n_add_to_cart FROM ev WHERE product_id IS NOT NULL AND coalesce(user_id NOT IN (1, 2, 3), true) GROUP BY product_id HAVING n_views > 0 OR n_likes > 0 OR n_add_to_cart > 0")
def event_stats(spark: SparkSession, d: str) -> DataFrame:
    return lifecycle.event_increments(_events(spark, d), (1, 2, 3))


@query(f"SELECT event_id, user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(7 AS BIGINT) AS batch_timestamp FROM events WHERE ts < TIMESTAMP '{CUTOFF}'")
def event_ingest(spark: SparkSession, d: str) -> DataFrame:
    ev = table(spark, d, "events").withColumn("event_timestamp", F.unix_timestamp(F.col("ts").cast("timestamp")))
    cut = int(datetime.datetime.fromisoformat(f"{CUTOFF}T00:00:00+00:00").timestamp())
    moved, _ = stream.ingested(ev, F.lit(cut), F.lit(7))
    return moved.select("event_id", "user_id", F.col("execution_date").cast("string").alias("day"), "batch_timestamp")


@query("SELECT product_id FROM active_products WHERE n_views >= 2 ORDER BY (n_likes + n_add_to_cart) / n_views DESC, product_id LIMIT 100")
def top_tag(spark: SparkSession, d: str) -> DataFrame:
    return lifecycle.top_products(table(spark, d, "active_products"), 100, 2)


@query("SELECT product_id, array_to_string(CASE WHEN execution_date > DATE '2025-06-12' - 3 AND NOT list_contains(product_tags, 'new_product') THEN list_append(product_tags, 'new_product') ELSE product_tags END, ',') AS tags FROM (SELECT product_id, product_tags, execution_date FROM active_products)")
def new_tag(spark: SparkSession, d: str) -> DataFrame:
    return lifecycle.tag_new(table(spark, d, "active_products"), F.lit(_DAY), 3).select("product_id", F.concat_ws(",", "product_tags").alias("tags"))


@query(f"""
WITH best AS ({SQL['top_tag']}) SELECT a.product_id, list_contains(a.product_tags, 'top_product') OR b.product_id IS NOT NULL AS is_top FROM active_products a LEFT JOIN best b ON a.product_id = b.product_id
""")
def top_tagged(spark: SparkSession, d: str) -> DataFrame:
    active = table(spark, d, "active_products")
    return lifecycle.tagged(active, lifecycle.top_products(active, 100, 2), "top_product").select("product_id", F.array_contains("product_tags", "top_product").alias("is_top"))


@query(f"WITH {TODAY_SQL} SELECT coalesce(a.product_id, t.product_id) AS product_id, t.product_id IS NOT NULL AS is_active FROM active_products a FULL JOIN today t ON a.product_id = t.product_id")
def deactivate(spark: SparkSession, d: str) -> DataFrame:
    live = table(spark, d, "active_products").select("product_id", F.lit(True).alias("is_active"))
    return lifecycle.deactivated(live, _today(spark, d).select("product_id"))


@query(f"WITH {TODAY_SQL} SELECT product_id, product_name FROM today UNION ALL SELECT product_id, product_name FROM active_products WHERE product_id NOT IN (SELECT product_id FROM today)")
def upsert_products(spark: SparkSession, d: str) -> DataFrame:
    live = table(spark, d, "active_products").select("product_id", "product_name")
    return dml.staging_to_live(live, _today(spark, d).select("product_id", "product_name"), "UPSERT", ["product_id"])


# similarity


_DOT = "list_dot_product(CAST({0} AS DOUBLE[]), CAST({1} AS DOUBLE[]))"


@query(f"""
WITH act AS (SELECT * FROM embeddings WHERE embedding[1] <= 0.05),
his AS (SELECT * FROM embeddings WHERE embedding[1] > 0.05 AND DATE '2025-06-12' - CAST(round(abs(embedding[2]) * 1000) AS INTEGER) > DATE '2025-06-12' - 45),
known AS (SELECT * FROM act WHERE embedding[1] < -0.05), new AS (SELECT * FROM act WHERE embedding[1] >= -0.05),
stored AS (SELECT a.vec_id AS product_id, b.vec_id AS similar_product_id, 0.5 AS s FROM known a JOIN known b ON a.label = b.label AND a.vec_id != b.vec_id),
old AS (SELECT * FROM known k WHERE EXISTS (SELECT 1 FROM stored WHERE product_id = k.vec_id) UNION ALL SELECT * FROM his),
pairs AS (
  SELECT a.vec_id AS product_id, b.vec_id AS similar_product_id, {_DOT.format("a.embedding", "b.embedding")} AS s FROM old a JOIN new b ON a.label = b.label AND a.vec_id != b.vec_id
  UNION ALL SELECT a.vec_id, b.vec_id, {_DOT.format("a.embedding", "b.embedding")} FROM new a JOIN act b ON a.label = b.label AND a.vec_id != b.vec_id
)
SELECT product_id, similar_product_id, round(s, 4) AS similarity_score FROM pairs WHERE s > 0.2 UNION ALL SELECT product_id, similar_product_id, s FROM stored
""")
def similarity_scores(spark: SparkSession, d: str) -> DataFrame:
    """An incremental run: by its first number a vector is a historic product (its age by the second), an active one with stored scores, or a new one."""
    aged = F.date_sub(F.lit(_DAY), F.round(F.abs(F.get("embedding", F.lit(1))) * 1000).cast("int"))
    vec = table(spark, d, "embeddings").select(F.col("vec_id").alias("product_id"), F.array(F.col("label").cast("string")).alias("labels"), F.col("embedding").alias("vector"), aged.alias("execution_date"))
    active, historic = vec.where("vector[0] <= 0.05"), vec.where("vector[0] > 0.05")
    known = active.where("vector[0] < -0.05").select("product_id", F.explode("labels").alias("label"))
    other = known.withColumnRenamed("product_id", "similar_product_id")
    stored = known.join(other, "label").where("product_id != similar_product_id").select("product_id", "similar_product_id", F.lit(0.5).alias("similarity_score"))
    out = similarity.incremental_scores(active, historic, stored, F.lit(_DAY), 45, 0.2)
    return out.select("product_id", "similar_product_id", F.round("similarity_score", 4).alias("similarity_score"))


@query(f"""
WITH act AS (SELECT product_id, product_labels, CAST(product_image_embedding AS DOUBLE[]) AS v, product_secondary_labels AS s FROM active_products),
his AS (SELECT product_id, product_labels, [0.5, 0.5, 0.5, 0.5, 0.0, 0.0, 0.0, 0.0] AS v, product_secondary_labels AS s FROM product_info WHERE execution_date > DATE '2025-05-01' AND product_id NOT IN (SELECT product_id FROM act)),
roots AS (SELECT product_id, unnest(product_labels) AS label, v, s FROM (SELECT * FROM act UNION ALL SELECT * FROM his)), p AS (SELECT product_id, unnest(product_labels) AS label, v, s FROM act),
pairs AS (SELECT DISTINCT a.product_id, b.product_id AS other, list_dot_product(a.v, b.v) AS score, list_intersect(a.s, b.s) AS common FROM roots a JOIN p b ON a.label = b.label AND a.product_id != b.product_id AND list_dot_product(a.v, b.v) > 0.6),
boosted AS (SELECT product_id, other, round(score * (1 + 0.8 * len(list_distinct(common)) + 0.24 * len(list_intersect(list_distinct(common), ['quilted', 'ribbed', 'lined']))), 6) AS score FROM pairs),
best AS (SELECT product_id, CAST(place - 1 AS INTEGER) AS index, other AS similar_product_id FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY score DESC, other DESC) AS place FROM boosted) WHERE place <= 10)
SELECT * FROM best UNION ALL SELECT DISTINCT product_id, 0, product_id FROM product_info WHERE product_id NOT IN (SELECT product_id FROM best)
""")
def similar_topn(spark: SparkSession, d: str) -> DataFrame:
    """Roots are active and historic products (those with one vector for all, loaded in May or later); every product has an earlier result, itself."""
    cols = ["product_id", "product_labels", "product_secondary_labels"]
    active, info = table(spark, d, "active_products").select(*cols, F.col("product_image_embedding").alias("vector")), table(spark, d, "product_info")
    flat = F.array(*[F.lit(x) for x in (0.5, 0.5, 0.5, 0.5, 0.0, 0.0, 0.0, 0.0)]).cast("array<float>").alias("vector")
    historic = dml.delete_in(info.where("execution_date > DATE '2025-05-01'").select(*cols, flat), active, ["product_id"])
    of = lambda x: x.select(F.col("product_id").alias("id"), F.explode("product_labels").alias("label"), "vector")
    pairs = similarity.block_pairs(of(active.unionByName(historic)), of(active), 0.6).withColumnsRenamed({"id": "product_id", "other": "similar_product_id", "score": "similarity_score"})
    stored = info.select("product_id", F.lit(0).alias("index"), F.col("product_id").alias("similar_product_id"))
    return similarity.refreshed_neighbours(pairs, active, historic, stored, PRIORITY, 10)


@query(f"""
WITH p AS (SELECT p_partkey AS id, p_brand, p_type, p_name, split_part(p_name, ' ', 1) AS color, array_to_string(list_filter(string_split(lower(p_name), ' '), lambda w: NOT list_contains({PART_COLORS!r}, w) AND w != ''), ' ') AS core FROM part),
near AS (SELECT a.id, a.color, b.id AS other_id, b.color AS other_color FROM p a JOIN p b ON a.p_brand = b.p_brand AND a.p_type = b.p_type AND a.core = b.core AND a.id != b.id AND a.color != b.color),
far AS (SELECT a.id, a.color, b.other_id, b.other_color FROM near a JOIN near b ON a.other_id = b.id WHERE a.id != b.other_id AND a.color != b.other_color)
SELECT DISTINCT id AS product_id, other_id, other_color AS color FROM (SELECT * FROM near UNION ALL SELECT * FROM far)
""")
def color_options(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select(F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("advertiser_name"), F.col("p_type").alias("product_brand"), F.col("p_name").alias("product_name"), F.get(F.split("p_name", " "), F.lit(0)).alias("color"))
    return similarity.color_variants(p, PART_COLORS)


@query("SELECT user_id, 0 AS index, (SELECT min(product_id) FROM active_products) AS product_id FROM events WHERE user_id IS NOT NULL GROUP BY user_id HAVING count(*) > 40")
def recs_simple(spark: SparkSession, d: str) -> DataFrame:
    return similarity.simple_recommendations(table(spark, d, "events"), table(spark, d, "active_products"), 40)


@query(f"""
WITH {EVENTS_SQL}, w AS (SELECT user_id, product_id, CASE event WHEN 'fave' THEN 1.0 WHEN 'bag' THEN 3.0 WHEN 'trash' THEN -1.0 END / date_diff('day', CAST(ts AS DATE), DATE '2024-02-01') AS w FROM ev WHERE event IS NOT NULL AND product_id IS NOT NULL AND user_id IS NOT NULL),
t AS (SELECT user_id, sum(w) FILTER (w > 0) AS p, sum(w) FILTER (w < 0) AS n FROM w GROUP BY user_id HAVING abs(n) > 0.05 AND p > 0.1),
s AS (SELECT w.user_id, v.pos, avg(CASE WHEN w < 0 THEN w * 0.8 * abs(p / n) ELSE w END * v.x) AS x FROM w JOIN t USING (user_id) JOIN (SELECT vec_id, unnest(range(1, 65)) AS pos, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings) v ON v.vec_id = w.product_id GROUP BY ALL),
u AS (SELECT user_id, list(x ORDER BY pos) AS v FROM s GROUP BY user_id),
n AS (SELECT user_id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v FROM u WHERE list_dot_product(v, v) > 0),
r AS (SELECT n.user_id, e.vec_id AS product_id, row_number() OVER (PARTITION BY n.user_id ORDER BY round(list_dot_product(n.v, CAST(e.embedding AS DOUBLE[])), 9) DESC, e.vec_id DESC) AS place FROM n, embeddings e WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.user_id = n.user_id AND w.product_id = e.vec_id))
SELECT user_id, CAST(place - 1 AS INTEGER) AS index, product_id FROM r WHERE place <= 5
""")
def recs_vector(spark: SparkSession, d: str) -> DataFrame:
    ev = _events(spark, d).select("user_id", F.col("event_type").alias("event"), "product_id", F.to_date("ts").alias("event_date"))
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").alias("product_id"), F.col("embedding").alias("vector"))
    day = F.lit(datetime.date(2024, 2, 1))
    users = checkpointed(similarity.user_vectors(ev, vectors, day, TASTE, 0.1, 0.05, 64))  # one row per user, used three times
    return similarity.vector_recommendations(users, vectors, 5, similarity.weighed_events(ev, day, TASTE))


# tags

_SYN = "(VALUES " + ", ".join(f"('{r}', '{w}')" for r, ws in SYNONYMS.items() for w in sorted({r, *ws})) + ") s(root, word)"
TAGS_SQL = f"""
syn AS (SELECT * FROM {_SYN}),
att AS (SELECT DISTINCT product_id, internal_color, unnest(list_concat(product_secondary_labels, ['', coalesce(internal_color, '')])) AS a FROM active_products),
sub AS (
  SELECT DISTINCT x.product_id, x.internal_color, list_distinct_ordered.l AS subset FROM att x JOIN att y ON x.product_id = y.product_id JOIN att z ON x.product_id = z.product_id,
  LATERAL (SELECT CASE WHEN x.a = y.a AND y.a = z.a THEN [x.a] WHEN x.a = y.a THEN [x.a, z.a] WHEN x.a = z.a OR y.a = z.a THEN [x.a, y.a] ELSE [x.a, y.a, z.a] END AS l) list_distinct_ordered
  WHERE (x.a, y.a) NOT IN (SELECT root, word FROM syn) AND (x.a, z.a) NOT IN (SELECT root, word FROM syn) AND (y.a, z.a) NOT IN (SELECT root, word FROM syn)
),
lab AS (SELECT DISTINCT product_id, product_labels, unnest(list_concat(product_labels, [''])) AS pl FROM active_products),
lr AS (SELECT lab.product_id, pl, r.words FROM lab LEFT JOIN (SELECT root, list(word) AS words FROM syn GROUP BY root) r ON list_contains(product_labels, r.root)),
f AS (SELECT lr.product_id, pl, subset, internal_color, list_filter(subset, lambda x: list_contains(words, x))[1] AS w FROM lr JOIN sub ON lr.product_id = sub.product_id),
c AS (SELECT product_id, pl, subset, internal_color, CASE WHEN list_contains(r, coalesce(w, pl)) THEN r ELSE list_append(r, coalesce(w, pl)) END AS chosen FROM (SELECT *, CASE WHEN w IS NULL THEN subset ELSE list_filter(subset, lambda x: x != w) END AS r FROM f)),
tags AS (SELECT DISTINCT product_id, pl AS product_label, array_to_string(list_filter(chosen, lambda x: x != ''), ' ') AS suggestion, trim(array_to_string(list_sort(chosen), ' '), ' ') AS tag_words, subset AS secondary_subset, internal_color FROM c WHERE NOT contains(array_to_string(list_filter(chosen, lambda x: x != ''), ' '), '-colored'))
"""
SUPPORT_SQL = """
cnt AS (SELECT suggestion, product_label, count(DISTINCT product_id) AS n_hits FROM tags GROUP BY ALL),
top AS (SELECT suggestion, n_hits, max(product_label) AS product_label FROM (SELECT *, max(n_hits) OVER (PARTITION BY suggestion ORDER BY length(product_label) > 0 DESC, n_hits DESC) AS m FROM cnt) WHERE n_hits = m GROUP BY suggestion, n_hits)
"""


def _tags(spark: SparkSession, d: str) -> DataFrame:
    return tags.product_tags(table(spark, d, "active_products"), SYNONYMS)


@query(f"WITH {TAGS_SQL} SELECT product_id, product_label, suggestion, tag_words, array_to_string(secondary_subset, '|') AS subset FROM tags")
def product_tags(spark: SparkSession, d: str) -> DataFrame:
    return _tags(spark, d).select("product_id", "product_label", "suggestion", "tag_words", F.concat_ws("|", "secondary_subset").alias("subset"))


@query(f"WITH {TAGS_SQL}, {SUPPORT_SQL} SELECT suggestion, product_label, n_hits, suggestion = product_label AS is_base_label, n_hits > 20 AS is_strong FROM top WHERE n_hits > 5 AND length(suggestion) > 0")
def suggestions(spark: SparkSession, d: str) -> DataFrame:
    return tags.search_suggestions(_tags(spark, d), 5, 20)


SMART_SQL = f"""
WITH {TAGS_SQL}, {SUPPORT_SQL},
form AS (SELECT suggestion, product_label, tag_words, min(row(list_sort(list_filter(secondary_subset, lambda x: x != '')), coalesce(internal_color, ''))) AS f FROM tags GROUP BY ALL),
t AS (SELECT tag_words, top.suggestion, top.product_label, f[1] AS labels, n_hits FROM top JOIN form ON top.suggestion = form.suggestion AND top.product_label = form.product_label WHERE n_hits > 8 AND length(top.suggestion) > 0 AND (f[2] = '' OR NOT contains(top.suggestion, f[2])) AND len(f[1]) IN (1, 2)),
red AS (SELECT DISTINCT t.tag_words FROM t JOIN t l ON t.suggestion = CASE WHEN contains(l.suggestion, ' ') THEN regexp_replace(l.suggestion, ' [^ ]*$', '') ELSE '' END WHERE l.n_hits / t.n_hits > 0.65)
SELECT tag_words, r[1] AS suggestion, r[2] AS product_label, array_to_string(r[3], ',') AS labels, r[4] AS n_hits FROM (SELECT tag_words, min(row(suggestion, product_label, labels, n_hits)) AS r FROM t WHERE tag_words NOT IN (SELECT tag_words FROM red) GROUP BY tag_words)
"""


@query(SMART_SQL)
def smart_tags(spark: SparkSession, d: str) -> DataFrame:
    return tags.smart_tags(_tags(spark, d), 8).select("tag_words", "suggestion", "product_label", F.concat_ws(",", "product_secondary_labels").alias("labels"), "n_hits")


@query("""
WITH e AS (SELECT DISTINCT s.product_id, s.smart_tag_id, p.advertiser_name FROM product_smart_tag s JOIN product_info p ON s.product_id = p.product_id WHERE s.smart_tag_id IS NOT NULL),
c AS (SELECT advertiser_name, smart_tag_id, count(*) AS c FROM e GROUP BY ALL), t AS (SELECT advertiser_name, count(DISTINCT product_id) AS total FROM e GROUP BY 1),
p AS (SELECT c.*, c / total AS p, avg(c / total) OVER (PARTITION BY smart_tag_id) AS g FROM c JOIN t USING (advertiser_name)),
s AS (SELECT p.advertiser_name, p.smart_tag_id, d.product_label, ln(c) * p / g AS score FROM p JOIN smart_tag d ON d.smart_tag_id = p.smart_tag_id WHERE p > 0.001 AND c > 1 AND length(product_label) > 1),
r AS (SELECT *, row_number() OVER (PARTITION BY advertiser_name ORDER BY round(score, 9) DESC, smart_tag_id) AS rank, row_number() OVER (PARTITION BY advertiser_name, product_label ORDER BY round(score, 9) DESC, smart_tag_id) AS plrank FROM s)
SELECT advertiser_name, smart_tag_id, product_label, round(score, 4) AS score, CAST(rank AS INTEGER) AS rank, CAST(plrank AS INTEGER) AS plrank FROM r WHERE rank < 1000 AND plrank * rank < 200
""")
def advertiser_top_tags(spark: SparkSession, d: str) -> DataFrame:
    return tags.advertiser_tags(table(spark, d, "product_smart_tag"), table(spark, d, "product_info"), table(spark, d, "smart_tag"), 1, 0.001).withColumn("score", F.round("score", 4))


_SHADES = ["black", "white", "navy", "red", "green", "blue", "grey", "beige", "pink", "ivory", "olive", "sage"]


@query(f"""
WITH p AS (SELECT *, array_to_string(list_filter(string_split(regexp_replace(lower(product_name), '[^\\w\\s]|\\s', ' ', 'g'), ' '), lambda w: w != '' AND NOT list_contains({_SHADES!r}, w)), ' ') AS core FROM active_products),
o AS (SELECT DISTINCT a.product_id, b.product_id AS other_id, b.color, b.product_image_url AS url FROM p a JOIN p b ON a.advertiser_name = b.advertiser_name AND a.product_brand = b.product_brand AND a.core = b.core AND a.product_id != b.product_id AND a.color != b.color),
s AS (SELECT product_id, string_agg(color || ':' || other_id || ':' || coalesce(url, '?'), '|' ORDER BY color, other_id) AS options FROM o GROUP BY 1)
SELECT a.product_id, coalesce(len(product_details), 0) AS n_sizes, coalesce(s.options, '') AS options, round((n_likes + n_add_to_cart + 1) / CASE WHEN n_views = 0 THEN NULL ELSE n_views END, 6) AS swipe_rate FROM active_products a LEFT JOIN s ON a.product_id = s.product_id
""")
def search_docs(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "active_products")
    docs = tags.search_documents(p, similarity.color_variants(p, _SHADES))
    options = F.array_join(F.transform("product_color_options", lambda x: F.concat_ws(":", x["color"], x["product_id"].cast("string"), F.coalesce(x["product_image_url"], F.lit("?")))), "|")
    return docs.select("product_id", F.coalesce(F.size("sizes"), F.lit(0)).alias("n_sizes"), F.coalesce(options, F.lit("")).alias("options"), F.round("swipe_rate", 6).alias("swipe_rate"))


@query("""
WITH f AS (SELECT label AS product_label, min_by(product_id, product_id) AS product_id, min_by(product_image_url, product_id) AS product_image_url FROM (SELECT unnest(product_labels) AS label, product_id, product_image_url FROM active_products) GROUP BY 1)
SELECT DISTINCT trim(regexp_replace(suggestion, ' +', ' ', 'g')) AS suggestion_text, product_label, product_id, product_image_url FROM smart_tag JOIN f USING (product_label) WHERE suggestion IS NOT NULL
""")
def trending_documents(spark: SparkSession, d: str) -> DataFrame:
    return tags.trending(table(spark, d, "smart_tag").where("suggestion IS NOT NULL"), table(spark, d, "active_products"))


# serving

PRICE_DROP_SQL = """
WITH obs AS (SELECT product_id, execution_date, max(CAST(round(product_price * 100) AS BIGINT)) AS c FROM product_price_history WHERE product_id IS NOT NULL AND execution_date IS NOT NULL AND product_price IS NOT NULL GROUP BY ALL),
sv AS (SELECT DISTINCT user_id, product_id, CAST(to_timestamp(event_timestamp) AT TIME ZONE 'UTC' AS DATE) - 1 AS execution_date FROM user_product_faves WHERE product_id IS NOT NULL AND user_id IS NOT NULL),
cur AS (SELECT product_id, CAST(round(CAST(product_sale_price AS DOUBLE) * 100) AS BIGINT) AS n FROM active_products WHERE product_sale_price IS NOT NULL),
first AS (SELECT product_id, min(execution_date) AS d FROM obs JOIN cur USING (product_id) WHERE c = n GROUP BY 1),
hit AS (SELECT user_id, product_id, n, max(c) AS c FROM sv JOIN obs USING (product_id, execution_date) JOIN cur USING (product_id) WHERE execution_date > DATE '2025-03-01' AND (c >= n + 1000 OR c * (1 - 0.1) >= n) AND c >= n + 200 GROUP BY ALL)
SELECT user_id, product_id, c AS old_cents, n AS new_cents, CAST(d AS VARCHAR) AS since_date FROM hit JOIN first USING (product_id)
"""


def _drops(spark: SparkSession, d: str) -> DataFrame:
    return serving.price_drops(table(spark, d, "user_product_faves"), table(spark, d, "product_price_history"), table(spark, d, "active_products"), F.lit(datetime.date(2025, 3, 1)), 1000, 0.1, 200)


@query(PRICE_DROP_SQL)
def price_drop(spark: SparkSession, d: str) -> DataFrame:
    return _drops(spark, d).withColumn("since_date", F.col("since_date").cast("string"))


@query(f"WITH x AS ({PRICE_DROP_SQL}) SELECT 'board-' || user_id AS board_id, max(date_diff('day', DATE '1970-01-01', CAST(since_date AS DATE)) * 86400) AS last_modified_timestamp FROM x GROUP BY user_id")
def price_drop_boards(spark: SparkSession, d: str) -> DataFrame:
    drops = _drops(spark, d)
    boards = drops.select("user_id").distinct().withColumn("board_id", F.concat(F.lit("board-"), F.col("user_id").cast("string")))
    entries = serving.board_entries(drops, boards)
    return serving.refreshed_boards(boards.select("board_id", F.lit(0).cast("long").alias("last_modified_timestamp")), entries)


@query("""
SELECT product_id, CAST(execution_date AS VARCHAR) AS day, round(product_price, 2) AS price FROM product_price_history h WHERE NOT EXISTS (SELECT 1 FROM active_products a WHERE a.product_id = h.product_id AND h.execution_date = DATE '2025-06-12')
UNION ALL SELECT product_id, '2025-06-12', round(CAST(product_sale_price AS DOUBLE), 2) FROM active_products
""")
def price_history(spark: SparkSession, d: str) -> DataFrame:
    out = serving.price_history(table(spark, d, "product_price_history"), table(spark, d, "active_products"), F.lit(_DAY))
    return out.select("product_id", F.col("execution_date").cast("string").alias("day"), F.round("product_price", 2).alias("price"))


@query("""
SELECT DISTINCT product_id, product_label FROM (SELECT product_id, unnest(product_labels) AS product_label FROM active_products)
UNION ALL SELECT product_id, l FROM (SELECT product_id, unnest(product_labels) AS l FROM product_info) WHERE product_id NOT IN (SELECT product_id FROM active_products)
""")
def label_edges(spark: SparkSession, d: str) -> DataFrame:
    old = table(spark, d, "product_info").select("product_id", F.explode("product_labels").alias("product_label"))
    return serving.label_edges(old, table(spark, d, "active_products"), "product_labels", "product_label")


@query("""
WITH v AS (SELECT DISTINCT product_id, smart_tag_id FROM product_smart_tag WHERE product_id IS NOT NULL AND smart_tag_id IN (SELECT smart_tag_id FROM smart_tag)),
live AS (SELECT DISTINCT product_id, smart_tag_id FROM product_smart_tag WHERE useless AND product_id IS NOT NULL AND smart_tag_id IS NOT NULL)
SELECT * FROM v UNION ALL SELECT * FROM live WHERE product_id NOT IN (SELECT product_id FROM active_products) AND (product_id, smart_tag_id) NOT IN (SELECT product_id, smart_tag_id FROM v)
""")
def tag_edges(spark: SparkSession, d: str) -> DataFrame:
    edges = table(spark, d, "product_smart_tag")
    live = edges.where("useless AND product_id IS NOT NULL AND smart_tag_id IS NOT NULL").select("product_id", "smart_tag_id").distinct()
    return serving.tag_edges(live, edges, table(spark, d, "smart_tag"), table(spark, d, "active_products"))


@query("SELECT advertiser_name, count(*) AS n_products FROM active_products GROUP BY 1")
def advertiser_counts(spark: SparkSession, d: str) -> DataFrame:
    return serving.counts(table(spark, d, "active_products"), "advertiser_name", "n_products")


@query("SELECT DISTINCT product_id FROM active_products WHERE list_contains(product_tags, 'top_product')")
def top_products(spark: SparkSession, d: str) -> DataFrame:
    return serving.tagged_with(table(spark, d, "active_products"), "top_product")


@query("""
WITH o AS (SELECT product_id, product_name, color FROM product_info), n AS (SELECT product_id, product_name, color FROM active_products)
SELECT product_id, 'delete' AS action FROM o WHERE product_id NOT IN (SELECT product_id FROM n)
UNION ALL SELECT n.product_id, 'upsert' FROM n LEFT JOIN o ON n.product_id = o.product_id WHERE o.product_id IS NULL OR n.product_name IS DISTINCT FROM o.product_name OR n.color IS DISTINCT FROM o.color
""")
def search_diff(spark: SparkSession, d: str) -> DataFrame:
    cols = ["product_id", "product_name", "color"]
    return serving.index_changes(table(spark, d, "active_products").select(*cols), table(spark, d, "product_info").select(*cols), "product_id")


@query("SELECT advertiser_name, string_agg(DISTINCT product_brand, ',_,' ORDER BY product_brand) AS product_brand FROM product_info GROUP BY 1")
def autocomplete_names(spark: SparkSession, d: str) -> DataFrame:
    return serving.joined_names(table(spark, d, "product_info"), "advertiser_name", "product_brand")


@query("SELECT p.advertiser_name, count(*) AS n, round(avg(CAST(p.product_price AS DOUBLE)), 4) AS mean_price FROM active_products p WHERE p.n_views >= 5 GROUP BY 1")
def sql_script(spark: SparkSession, d: str) -> DataFrame:
    """Several statements with a bound value; the last one is the result."""
    script = """
    -- products; that were looked at
    CREATE OR REPLACE TEMP VIEW seen_products AS SELECT *, ';' AS mark FROM all_products;
    SELECT advertiser_name, count(*) AS n, round(avg(CAST(product_price AS DOUBLE)), 4) AS mean_price FROM seen_products WHERE n_views >= :least GROUP BY advertiser_name;
    """
    return sqlrun.run(spark, script, {"least": 5}, {"all_products": table(spark, d, "active_products")})


# windows over events


@query("SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def daily_event_counts(spark: SparkSession, d: str) -> DataFrame:
    out = stream.tumbling_counts(table(spark, d, "events"), "ts", "1 day", "1 hour", "event_type")
    return out.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "n")


@query("SELECT strftime(s, '%Y-%m-%d %H') AS start, count(*) AS n FROM (SELECT unnest([time_bucket(INTERVAL 12 HOUR, ts, TIMESTAMP '2024-01-01'), time_bucket(INTERVAL 12 HOUR, ts, TIMESTAMP '2024-01-01') - INTERVAL 12 HOUR]) AS s FROM events) GROUP BY 1")
def sliding_event_counts(spark: SparkSession, d: str) -> DataFrame:
    out = stream.sliding_counts(table(spark, d, "events"), "ts", "24 hours", "12 hours", "1 hour")
    return out.select(F.date_format("window_start", "yyyy-MM-dd HH").alias("start"), "n")


@query("""
WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh FROM events WHERE user_id IS NOT NULL),
s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, fresh DESC ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM s GROUP BY user_id, k
""")
def event_sessions(spark: SparkSession, d: str) -> DataFrame:
    out = stream.sessions(table(spark, d, "events").where("user_id IS NOT NULL"), "ts", "2 hours", "1 hour", "user_id")
    return out.select("user_id", F.date_format("session_start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")
