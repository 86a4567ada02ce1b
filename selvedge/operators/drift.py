"""Schemas that drift between files: one union schema, and every change with the file that brought it.

Records are JSON objects. A file's header schema is the set of its top-level fields with the
type each has, read in parallel from the records (a mergeable aggregate per file and field, so
a file with a third of all rows is one row per task). Headers are folded through the lattice

    null < boolean < string,  null < number < string,  null < array < string,  null < object < string

to the union schema, to which every record is cast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from selvedge.functions.skew import broadcast_if_small
from selvedge.session import checkpointed

#: Above this many fields a union schema as columns is refused; `records` and `headers` stay usable.
MAX_COLUMNS = 2000


def kind_of(value: Column) -> Column:
    """string, number, boolean, array or object; null for a JSON null."""
    t = F.schema_of_variant(value)
    return (
        F.when(t == "VOID", None)
        .when(t.startswith("OBJECT"), "object")
        .when(t.startswith("ARRAY"), "array")
        .when(t == "BOOLEAN", "boolean")
        .when(t == "STRING", "string")
        .otherwise("number")
    )


def records(raw: DataFrame, payload: str) -> DataFrame:
    """raw with `record`, the parsed object; lines that are no readable JSON object are left out.

    A line that repeats a field name is unreadable, as is one over Spark's variant limit.
    """
    parsed = raw.withColumn("record", F.try_parse_json(payload))
    return parsed.where(F.col("record").isNotNull()).where(F.schema_of_variant("record").startswith("OBJECT"))


def field_values(raw: DataFrame, payload: str, file: list[str], wanted: DataFrame, record_id: str = "id") -> DataFrame:
    """The columns of wanted, record_key and value: one row per record and wanted field that is not null.

    wanted has the columns of file and field_name, compared exactly, case included. value is the
    canonical JSON text (object fields in order of name, numbers as doubles), made for wanted
    fields only; record_key is that of the field record_id, null where it has none.
    """
    read = records(raw, payload).select(*file, "record", F.to_json(F.try_variant_get("record", f"$.{record_id}", "variant")).alias("record_key"))
    fields = read.lateralJoin(read.sparkSession.tvf.variant_explode(F.col("record").outer())).select(*file, "record_key", F.col("key").alias("field_name"), F.col("value").alias("_v"))
    kind = kind_of(F.col("_v"))
    text = F.when(kind == "number", F.try_variant_get("_v", "$", "double").cast("string")).when(kind.isNotNull(), F.to_json("_v"))
    return fields.join(wanted, [*file, "field_name"]).select(*wanted.columns, "record_key", text.alias("value")).where("value IS NOT NULL")


def promote(kinds: Column) -> Column:
    """The least upper bound in the lattice of an array of distinct kinds."""
    return F.when(F.size(kinds) == 0, "null").when(F.size(kinds) == 1, F.get(kinds, 0)).otherwise("string")


def headers(raw: DataFrame, file: list[str], payload: str) -> DataFrame:
    """The schema of each file: file, field_name, kind; the kinds a field has in its records are folded through the lattice.

    Files are read in parallel, the sets of kinds (five at most) are merged per task and then
    per file. Fields without any value other than null are none of the file's.
    """
    read = records(raw, payload).select(*file, "record")
    fields = read.lateralJoin(read.sparkSession.tvf.variant_explode(F.col("record").outer())).select(*file, F.col("key").alias("field_name"), kind_of(F.col("value")).alias("kind"))
    return fields.where("kind IS NOT NULL").groupBy(*file, "field_name").agg(promote(F.collect_set("kind")).alias("kind"))


def file_order(raw: DataFrame, source: str, file: str, time: str) -> DataFrame:
    """source, file, seq: the files of each source, counted by time (ties by file)."""
    files = raw.groupBy(source, file).agg(F.min(time).alias("_time"))
    return files.select(source, file, F.row_number().over(Window.partitionBy(source).orderBy("_time", file)).alias("seq"))


def schema_changes(raw: DataFrame, source: str, file: str, time: str, payload: str, record_id: str = "id") -> DataFrame:
    """source, file, field_name, change_kind, new_name: each file against the one before of its source.

    Header schemas are folded through the lattice and compared in the order of the files: a
    field is added, removed, or retyped if its kind differs. A field that ends and one that
    begins in the same file are one renamed field if the records with a value in both files, at
    least one, all have the same value there; every such pair is reported, instead of as added
    and removed. A file without readable record has no field. new_name is '' unless renamed.
    Rows without source or file are left out.

    Records are parsed once for the headers, and once more only those of the files where one
    field ends and another begins. Old and new values meet by record and value, so only fields
    that are equal somewhere are compared at all, and large files spread over their records.
    """
    raw = raw.where(F.col(source).isNotNull() & F.col(file).isNotNull())
    order = file_order(raw, source, file, time)
    # a row per file and field: without the cut each of its uses would parse the records again
    header = checkpointed(headers(raw, [source, file], payload).join(order, [source, file]).select(source, "seq", "field_name", "kind"))
    here = header.where("seq > 1").withColumnRenamed("kind", "_now")
    last = order.groupBy(source).agg(F.max("seq").alias("_last"))
    before = header.join(last, source).where(F.col("seq") < F.col("_last")).select(source, (F.col("seq") + 1).alias("seq"), "field_name", F.col("kind").alias("_then"))
    both = before.join(here, [source, "seq", "field_name"], "full")
    state = F.when(F.col("_then").isNull(), "added").when(F.col("_now").isNull(), "removed").when(F.col("_then") != F.col("_now"), "retyped")
    changes = checkpointed(both.select(source, "seq", "field_name", state.alias("change_kind")).where("change_kind IS NOT NULL"))

    # only where a field ends and another begins can there be a renaming: wanted are its fields, in the file before and in the file
    sides = F.collect_set(F.when(F.col("change_kind") != "retyped", F.col("change_kind")))
    busy = changes.groupBy(source, F.col("seq").alias("_step")).agg(F.size(sides).alias("_n")).where("_n = 2").drop("_n")
    moving = changes.where("change_kind != 'retyped'").withColumnRenamed("seq", "_step").join(busy, [source, "_step"])
    old_side = F.col("change_kind") == "removed"
    wanted = moving.select(source, (F.col("_step") - F.when(old_side, 1).otherwise(0)).alias("seq"), "field_name", "_step", old_side.alias("_old"))
    wanted = checkpointed(wanted.join(order, [source, "seq"]).drop("seq"))
    files = broadcast_if_small(wanted.select(source, file).distinct())
    values = field_values(raw.join(files, [source, file], "left_semi"), payload, [source, file], broadcast_if_small(wanted), record_id)
    step = [source, "_step", "record_key"]
    held = checkpointed(values.where("record_key IS NOT NULL").select(*step, "_old", "field_name", "value").distinct())
    old, new = held.where("_old").select(*step, F.col("field_name").alias("_from"), "value"), held.where("NOT _old").select(*step, F.col("field_name").alias("_to"), "value")
    equal = old.join(new, [*step, "value"]).groupBy(source, "_step", "_from", "_to").agg(F.count(F.lit(1)).alias("_equal"))
    met = old.drop("value").join(equal, [source, "_step", "_from"]).join(new.drop("value"), [*step, "_to"])
    renamed = met.groupBy(source, F.col("_step").alias("seq"), "_from", "_to").agg(F.count(F.lit(1)).alias("_met"), F.first("_equal").alias("_equal")).where("_met = _equal").drop("_met", "_equal")

    moved = renamed.select(source, "seq", F.col("_from").alias("field_name"), F.lit("removed").alias("change_kind")).unionByName(renamed.select(source, "seq", F.col("_to").alias("field_name"), F.lit("added").alias("change_kind"))).distinct()
    rest = changes.join(moved, [source, "seq", "field_name", "change_kind"], "left_anti").withColumn("new_name", F.lit(""))
    named = renamed.select(source, "seq", F.col("_from").alias("field_name"), F.lit("renamed").alias("change_kind"), F.col("_to").alias("new_name"))
    return rest.unionByName(named).join(order, [source, "seq"]).select(source, file, "field_name", "change_kind", "new_name")


def union_schema(raw: DataFrame, payload: str) -> DataFrame:
    """field_name and kind of the one table that holds all files: all headers folded through the lattice."""
    return headers(raw, [], payload)


CASTS = {"boolean": "boolean", "number": "double", "string": "string"}


def unified(raw: DataFrame, keep: list[str], payload: str, schema: DataFrame | None = None) -> DataFrame:
    """keep and one column per field of the union schema, in order of name, every record cast to it.

    Arrays and objects stay JSON text; a value of a field that also has other kinds becomes its
    text. The schema, one row per field, is brought to the driver; more than MAX_COLUMNS fields
    are refused. A field named like a column of keep, or like another field but for case, gets
    the suffix _field and a number.
    """
    found = (schema if schema is not None else union_schema(raw, payload)).orderBy("field_name").limit(MAX_COLUMNS + 1).collect()
    if len(found) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} fields")
    used, columns = {k.lower() for k in keep}, []
    for name, kind in found:
        alias, n = name, 1
        while alias.lower() in used:
            alias, n = f"{name}_field{n}", n + 1
        used.add(alias.lower())
        path = "$['" + name.replace("'", "\\'") + "']"
        whole = F.try_variant_get("record", path, "variant")
        text = F.coalesce(F.try_variant_get("record", path, "string"), F.to_json(whole))
        value = F.try_variant_get("record", path, CASTS[kind]) if kind in ("boolean", "number") else F.when(F.schema_of_variant(whole) != "VOID", text)
        columns.append(value.alias(alias))
    return records(raw, payload).select(*keep, *columns)
