"""Queries of the general problems: orphan references, history, schema drift, snapshot differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from selvedge.operators import drift, history, references, snapshots
from selvedge.session import checkpointed
from selvedge.sources.tables import table


def _references(spark: SparkSession, d: str) -> DataFrame:
    day = F.unix_date("execution_date").cast("long") * 86400
    specs = (
        ("board_product", "product", "board_id", "product_id", F.col("last_modified_timestamp")),
        ("user_product_faves", "product", "user_id", "product_id", F.col("event_timestamp")),
        ("product_smart_tag", "tag", "product_id", "smart_tag_id", day),
    )
    parts = [table(spark, d, name).select(F.lit(kind).alias("kind"), F.lit(name).alias("table_name"), F.col(owner).cast("string").alias("owner_key"), F.col(ref).alias("ref_id"), at.alias("at")) for name, kind, owner, ref, at in specs]
    return reduce(DataFrame.unionByName, parts)


def _reference_state(spark: SparkSession, d: str) -> DataFrame:
    day = F.unix_date("execution_date").cast("long") * 86400
    return references.merge_states(
        references.reference_deltas(_references(spark, d)),
        references.record_deltas(table(spark, d, "product_info"), "product", "product_id", F.col("execution_timestamp")),
        references.record_deltas(table(spark, d, "smart_tag"), "tag", "smart_tag_id", day),
        references.trace_deltas(table(spark, d, "product_price_history"), "product", "product_id"),
        references.trace_deltas(table(spark, d, "advertiser_top_smart_tag"), "tag", "smart_tag_id"),
    )


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return references.orphan_report(_references(spark, d), _reference_state(spark, d))


def p1_counts(spark: SparkSession, d: str) -> DataFrame:
    """Orphan references per table and period."""
    return p1_found(spark, d).groupBy("table_name", "period", "reason").agg(F.count(F.lit(1)).alias("n_orphans"), F.countDistinct("ref_id").alias("n_keys"))


#: The end of the first period that p1_incremental merges.
PERIOD_END = 1746057600  # 2025-05-01


def p1_incremental(spark: SparkSession, d: str) -> DataFrame:
    """Orphan keys from the state of one period and the deltas of the next, with withdrawals.

    The first period has the references and records up to PERIOD_END. The second adds all later
    ones, withdraws the faves of products that are on no board, and deletes the records of the
    products that are active no more.
    """
    faves = table(spark, d, "user_product_faves").select(F.lit("product").alias("kind"), F.col("product_id").alias("ref_id"), F.col("event_timestamp").alias("at"))
    boards = table(spark, d, "board_product").select(F.lit("product").alias("kind"), F.col("product_id").alias("ref_id"), F.col("last_modified_timestamp").alias("at"))
    refs = faves.unionByName(boards)
    records, active = table(spark, d, "product_info"), table(spark, d, "active_products").select("product_id").distinct()
    loaded = F.col("execution_timestamp")
    first = references.merge_states(references.reference_deltas(refs.where(F.col("at") < PERIOD_END)), references.record_deltas(records.where(loaded < PERIOD_END), "product", "product_id", loaded))
    dropped = faves.join(boards.where("ref_id IS NOT NULL").select("ref_id").distinct(), "ref_id", "left_anti")
    gone = records.join(active, "product_id", "left_anti")
    second = references.merge_states(
        first,
        references.reference_deltas(refs.where(F.col("at") >= PERIOD_END)),
        references.reference_deltas(dropped, F.lit(-1)),
        references.record_deltas(records.where(loaded >= PERIOD_END), "product", "product_id", loaded),
        references.record_deltas(gone, "product", "product_id", loaded, F.lit(-1)),
    )
    return references.orphan_keys(second).select("ref_id", "n_refs", "n_records")


P1_INCREMENTAL_SQL = """
WITH refs AS (SELECT product_id FROM board_product UNION ALL SELECT product_id FROM user_product_faves WHERE product_id IN (SELECT product_id FROM board_product WHERE product_id IS NOT NULL))
SELECT product_id AS ref_id, count(*) AS n_refs, CAST(0 AS BIGINT) AS n_records FROM refs
WHERE product_id IS NOT NULL AND product_id NOT IN (SELECT p.product_id FROM product_info p JOIN active_products a ON p.product_id = a.product_id) GROUP BY product_id
"""

P1_SQL = """
WITH refs AS (
  SELECT 'board_product' AS table_name, CAST(board_id AS VARCHAR) AS owner_key, product_id AS ref_id, strftime(to_timestamp(last_modified_timestamp) AT TIME ZONE 'UTC', '%Y-%m') AS period, last_modified_timestamp AS ts FROM board_product
  UNION ALL
  SELECT 'user_product_faves', CAST(user_id AS VARCHAR), product_id, strftime(to_timestamp(event_timestamp) AT TIME ZONE 'UTC', '%Y-%m'), event_timestamp FROM user_product_faves
), found AS (
  SELECT table_name, owner_key, ref_id, period,
    CASE WHEN p.product_id IS NOT NULL THEN CASE WHEN p.execution_timestamp > ts THEN 'late' END
         WHEN ref_id IN (SELECT product_id FROM product_price_history WHERE product_id IS NOT NULL) THEN 'deleted' ELSE 'missing' END AS reason
  FROM refs LEFT JOIN product_info p ON p.product_id = ref_id WHERE ref_id IS NOT NULL
  UNION ALL
  SELECT 'product_smart_tag', CAST(s.product_id AS VARCHAR), s.smart_tag_id, strftime(s.execution_date, '%Y-%m'),
    CASE WHEN t.smart_tag_id IS NOT NULL THEN CASE WHEN t.execution_date > s.execution_date THEN 'late' END
         WHEN s.smart_tag_id IN (SELECT smart_tag_id FROM advertiser_top_smart_tag WHERE smart_tag_id IS NOT NULL) THEN 'deleted' ELSE 'missing' END
  FROM product_smart_tag s LEFT JOIN smart_tag t ON t.smart_tag_id = s.smart_tag_id WHERE s.smart_tag_id IS NOT NULL
)
SELECT DISTINCT table_name, owner_key, ref_id, period, reason FROM found WHERE reason IS NOT NULL
"""
P1_COUNTS_SQL = f"SELECT table_name, period, reason, count(*) AS n_orphans, count(DISTINCT ref_id) AS n_keys FROM ({P1_SQL}) GROUP BY ALL"


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """The rows that arrived in one month are one run."""
    month = F.coalesce(F.year("loaded_at") * 12 + F.month("loaded_at"), F.lit(0))
    versions = history.entity_versions(table(spark, d, "product_price_history"), "product_id", "execution_date", history.cents("product_price"), "loaded_at", month)
    return versions.select("product_id", F.col("valid_from").cast("string").alias("valid_from"), F.coalesce(F.col("valid_to").cast("string"), F.lit("")).alias("valid_to"))


P2_SQL = """
WITH last AS (
  SELECT product_id, execution_date, CAST(round(product_price * 100) AS BIGINT) AS c,
    row_number() OVER (PARTITION BY product_id, execution_date ORDER BY loaded_at DESC NULLS LAST, CAST(round(product_price * 100) AS BIGINT) DESC) AS rn
  FROM product_price_history WHERE product_price IS NOT NULL AND NOT isnan(product_price) AND product_id IS NOT NULL AND execution_date IS NOT NULL
), starts AS (
  SELECT product_id, execution_date FROM (SELECT *, lag(c) OVER (PARTITION BY product_id ORDER BY execution_date) AS before FROM last WHERE rn = 1) WHERE c IS DISTINCT FROM before
)
SELECT product_id, CAST(execution_date AS VARCHAR) AS valid_from, coalesce(CAST(lead(execution_date) OVER (PARTITION BY product_id ORDER BY execution_date) AS VARCHAR), '') AS valid_to FROM starts
"""


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return drift.schema_changes(table(spark, d, "daily_product_dump_raw"), "feed_id", "file_id", "execution_date", "payload")


P5_SQL = """
WITH ok AS (SELECT feed_id, file_id, json(payload) AS j FROM daily_product_dump_raw WHERE json_valid(payload) AND json_type(CASE WHEN json_valid(payload) THEN payload ELSE 'null' END) = 'OBJECT'),
ord AS (SELECT feed_id, file_id, row_number() OVER (PARTITION BY feed_id ORDER BY min(execution_date), file_id) AS seq FROM daily_product_dump_raw GROUP BY feed_id, file_id),
raw AS (SELECT feed_id, file_id, CAST(j->'$.id' AS VARCHAR) AS id, k AS field, json_extract(j, '$."' || k || '"') AS v FROM (SELECT *, unnest(json_keys(j)) AS k FROM ok)),
val AS (
  SELECT DISTINCT r.feed_id, o.seq, id, field, CASE json_type(v) WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' ELSE 'number' END AS kind,
    CASE WHEN json_type(v) IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'HUGEINT') THEN CAST(CAST(v AS DOUBLE) AS VARCHAR) ELSE CAST(v AS VARCHAR) END AS t
  FROM raw r JOIN ord o ON r.feed_id = o.feed_id AND r.file_id = o.file_id WHERE json_type(v) != 'NULL'
), head AS (SELECT feed_id, seq, field, list_sort(list(DISTINCT kind)) AS kinds FROM val GROUP BY ALL),
step AS (
  SELECT coalesce(a.feed_id, b.feed_id) AS feed_id, coalesce(a.seq + 1, b.seq) AS seq, coalesce(a.field, b.field) AS field, a.kinds AS was, b.kinds AS now
  FROM head a FULL JOIN head b ON a.feed_id = b.feed_id AND a.seq + 1 = b.seq AND a.field = b.field
), change AS (SELECT s.* FROM step s JOIN ord o ON s.feed_id = o.feed_id AND s.seq = o.seq WHERE s.seq > 1 AND was IS DISTINCT FROM now),
pair AS (
  SELECT x.feed_id, x.seq, x.field AS old, y.field AS fresh
  FROM change x JOIN change y ON x.feed_id = y.feed_id AND x.seq = y.seq AND x.now IS NULL AND y.was IS NULL
  JOIN val p ON p.feed_id = x.feed_id AND p.seq = x.seq - 1 AND p.field = x.field AND p.id IS NOT NULL JOIN val q ON q.feed_id = x.feed_id AND q.seq = x.seq AND q.field = y.field AND q.id = p.id
  GROUP BY ALL HAVING bool_and(p.t = q.t)
)
SELECT r.feed_id, o.file_id, r.field_name, r.change_kind, r.new_name FROM (
  SELECT feed_id, seq, old AS field_name, 'renamed' AS change_kind, fresh AS new_name FROM pair
  UNION ALL SELECT feed_id, seq, field, CASE WHEN was IS NULL THEN 'added' WHEN now IS NULL THEN 'removed' ELSE 'retyped' END, '' FROM change c
  WHERE NOT EXISTS (SELECT 1 FROM pair p WHERE p.feed_id = c.feed_id AND p.seq = c.seq AND ((c.now IS NULL AND p.old = c.field) OR (c.was IS NULL AND p.fresh = c.field)))
) r JOIN ord o ON r.feed_id = o.feed_id AND r.seq = o.seq
"""


def p5_unified(spark: SparkSession, d: str) -> DataFrame:
    """All readable records in the one schema that holds them all."""
    return drift.unified(table(spark, d, "daily_product_dump_raw"), ["feed_id", "file_id", "execution_date", "line_no"], "payload")


def p5_schema(spark: SparkSession, d: str) -> DataFrame:
    """The union schema, with the number of files that have each field."""
    raw = table(spark, d, "daily_product_dump_raw")
    files = drift.headers(raw, ["feed_id", "file_id"], "payload").groupBy("field_name").agg(F.count(F.lit(1)).alias("n_files"))
    return drift.union_schema(raw, "payload").join(files, "field_name")


_KIND_SQL = "CASE json_type(v) WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' ELSE 'number' END"
_FIELDS_SQL = """
ok AS (SELECT feed_id, file_id, line_no, json(payload) AS j FROM daily_product_dump_raw WHERE json_valid(payload) AND json_type(CASE WHEN json_valid(payload) THEN payload ELSE 'null' END) = 'OBJECT'),
cell AS (SELECT * FROM (SELECT feed_id, file_id, line_no, k, json_extract(j, '$."' || k || '"') AS v FROM (SELECT *, unnest(json_keys(j)) AS k FROM ok)) WHERE json_type(v) != 'NULL')
"""
P5_SCHEMA_SQL = f"WITH {_FIELDS_SQL} SELECT k AS field_name, CASE WHEN count(DISTINCT {_KIND_SQL}) = 1 THEN any_value({_KIND_SQL}) ELSE 'string' END AS kind, count(DISTINCT (feed_id, file_id)) AS n_files FROM cell GROUP BY k"


def p5_cells(spark: SparkSession, d: str) -> DataFrame:
    """How many records have a value in each column of the unified table, how many different ones, and the least and greatest of those without an object."""
    keep = ["feed_id", "file_id", "execution_date", "line_no"]
    whole = drift.unified(table(spark, d, "daily_product_dump_raw"), keep, "payload")
    names = [c for c in whole.columns if c not in keep]
    kinds = dict(whole.dtypes)
    text = lambda c: F.when(F.col(f"`{c}`").isNotNull(), F.format_string("%.4f", f"`{c}`") if kinds[c] == "double" else F.col(f"`{c}`").cast("string"))
    cells = whole.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), text(c).alias("value")) for c in names])).alias("x")).select("x.*").where("value IS NOT NULL")
    plain = F.when(~F.col("value").contains("{"), F.col("value"))
    return cells.groupBy("column_name").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("value").alias("n_values"), F.min(plain).alias("least"), F.max(plain).alias("greatest"))


# field names that differ only in case get a suffix, in order of the names
P5_CELLS_SQL = f"""
WITH {_FIELDS_SQL},
kinds AS (SELECT k, CASE WHEN count(DISTINCT {_KIND_SQL}) = 1 THEN any_value({_KIND_SQL}) ELSE 'string' END AS kind, row_number() OVER (PARTITION BY lower(k) ORDER BY k) - 1 AS nth FROM cell GROUP BY k),
t AS (SELECT k || CASE WHEN nth > 0 THEN '_field' || nth ELSE '' END AS column_name, CASE WHEN kind = 'number' THEN printf('%.4f', CAST(v AS DOUBLE)) WHEN json_type(v) = 'VARCHAR' THEN v->>'$' ELSE CAST(v AS VARCHAR) END AS value FROM cell JOIN kinds USING (k))
SELECT column_name, count(*) AS n, count(DISTINCT value) AS n_values, min(value) FILTER (NOT contains(value, '{{')) AS least, max(value) FILTER (NOT contains(value, '{{')) AS greatest FROM t GROUP BY 1
"""


def _dump_states(spark: SparkSession, d: str) -> DataFrame:
    payload = {
        "product_name": F.col("product_name"), "product_price": history.cents("product_price"), "product_sale_price": history.cents("product_sale_price"),
        "color": F.col("color"), "size": F.col("size"), "labels": F.array_sort(F.array_distinct("product_external_labels")),
    }
    return snapshots.latest_rows(table(spark, d, "daily_product_dump"), ["execution_date", "product_id"], "execution_timestamp", payload)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Without any active product, or any snapshot, the last step is left out."""
    dump, keys = checkpointed(_dump_states(spark, d)), ["execution_date", "product_id"]  # read six times below
    steps = snapshots.consecutive_diff(dump, "execution_date", ["product_id"])
    active = snapshots.latest_rows(table(spark, d, "active_products"), keys, "execution_timestamp", {"product_sale_price": history.cents("product_sale_price")})
    day = active.agg(F.max("execution_date")).first()[0]
    last = dump.agg(F.max("execution_date")).first()[0]
    if day is not None and last is not None:
        final = dump.where(F.col("execution_date") == F.lit(last)).select(F.lit(day).alias("execution_date"), "product_id", "product_sale_price")
        latest = active.where(F.col("execution_date") == F.lit(day)).select(*final.columns)
        steps = steps.unionByName(snapshots.diff(final, latest, keys))
    return steps.select(F.col("execution_date").cast("string").alias("snapshot_date"), "product_id", "change_kind")


P7_SQL = """
WITH dump AS (
  SELECT execution_date AS day, product_id, product_name, CAST(round(CAST(product_price AS DOUBLE) * 100) AS BIGINT) AS price, CAST(round(CAST(product_sale_price AS DOUBLE) * 100) AS BIGINT) AS sale,
    color, size, list_sort(list_distinct(product_external_labels)) AS labels
  FROM (SELECT *, row_number() OVER (PARTITION BY execution_date, product_id ORDER BY execution_timestamp DESC) AS rn FROM daily_product_dump WHERE product_id IS NOT NULL AND execution_date IS NOT NULL) WHERE rn = 1
), days AS (SELECT day, lead(day) OVER (ORDER BY day) AS next_day, lag(day) OVER (ORDER BY day) AS last_day FROM (SELECT DISTINCT day FROM dump)),
old AS (SELECT days.next_day AS step, dump.* FROM dump JOIN days USING (day) WHERE next_day IS NOT NULL),
cur AS (SELECT day AS step, dump.* FROM dump JOIN days USING (day) WHERE last_day IS NOT NULL),
final AS (SELECT product_id, sale FROM dump WHERE day = (SELECT max(day) FROM dump)),
active AS (SELECT execution_date AS step, product_id, CAST(round(CAST(product_sale_price AS DOUBLE) * 100) AS BIGINT) AS sale FROM active_products)
SELECT CAST(step AS VARCHAR) AS snapshot_date, product_id,
  CASE WHEN was IS NULL THEN 'added' WHEN now IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
FROM (
  SELECT coalesce(o.step, c.step) AS step, coalesce(o.product_id, c.product_id) AS product_id, o.product_id AS was, c.product_id AS now,
    o.product_name IS DISTINCT FROM c.product_name OR o.price IS DISTINCT FROM c.price OR o.sale IS DISTINCT FROM c.sale OR o.color IS DISTINCT FROM c.color OR o.size IS DISTINCT FROM c.size OR o.labels IS DISTINCT FROM c.labels AS other
  FROM old o FULL JOIN cur c ON o.step = c.step AND o.product_id = c.product_id
  UNION ALL
  SELECT (SELECT max(step) FROM active), coalesce(f.product_id, a.product_id), f.product_id, a.product_id, f.sale IS DISTINCT FROM a.sale
  FROM final f FULL JOIN active a ON f.product_id = a.product_id
) WHERE was IS NULL OR now IS NULL OR other
"""

QUERIES = {f.__name__: f for f in (p1_found, p1_counts, p1_incremental, p2_found, p5_found, p5_schema, p5_unified, p5_cells, p7_found)}
SQL = {"p1_found": P1_SQL, "p1_counts": P1_COUNTS_SQL, "p1_incremental": P1_INCREMENTAL_SQL, "p2_found": P2_SQL, "p5_found": P5_SQL, "p5_schema": P5_SCHEMA_SQL, "p5_cells": P5_CELLS_SQL, "p7_found": P7_SQL}
