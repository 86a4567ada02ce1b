"""Scripts of several SQL statements, with values as parameters and one result."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from selvedge.operators.dml import last_per_key
from selvedge.schemas import align
from selvedge.session import checkpointed


def statements(script: str) -> list[str]:
    """The statements of a script: parted at semicolons outside of quotes and comments."""
    out, now, i, n = [], [], 0, len(script)
    while i < n:
        c, two = script[i], script[i : i + 2]
        if two == "--":
            j = script.find("\n", i)
            i = n if j < 0 else j
        elif two == "/*" and script[i : i + 3] != "/*+":
            j = script.find("*/", i + 2)
            i = n if j < 0 else j + 2
        elif c in "'\"`":
            j = i + 1
            while j < n and script[j] != c:
                j += 2 if script[j] == "\\" and c != "`" else 1
            now.append(script[i : j + 1])
            i = j + 1
        elif c == ";":
            out.append("".join(now).strip())
            now = []
            i += 1
        else:
            now.append(c)
            i += 1
    out.append("".join(now).strip())
    return [s for s in out if s]


def run(
    spark: SparkSession,
    script: str,
    values: dict[str, Any] | None = None,
    views: dict[str, DataFrame] | None = None,
    unique_on: Sequence[str] | None = None,
    output: str | None = None,
    mode: str = "errorifexists",
    format: str = "parquet",
    drop_duplicates: bool = False,
    **options: str,
) -> DataFrame | None:
    """The result of the last statement; those before run in order.

    Values are bound (:name), never pasted in; names of tables and columns are bound by
    IDENTIFIER(:name). views are registered under their names first. With drop_duplicates equal
    rows stay once, with unique_on one row per key. With output the result is saved as that
    table, by mode (append, overwrite, ignore or errorifexists), and the table is returned.
    """
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    result = None
    for s in statements(script):
        result = spark.sql(s, args={k: v for k, v in (values or {}).items() if f":{k}" in s})
    if result is None:
        return None
    result = last_per_key(result, unique_on) if unique_on else result.distinct() if drop_duplicates else result
    if output is None:
        return result
    result.write.format(format).mode(mode).options(**options).saveAsTable(output)
    return spark.table(output)


def ensure_table(spark: SparkSession, name: str, schema, partition_by: Sequence[str] = ()) -> None:
    """Creates a Parquet table if it is missing; else brings it to the schema.

    Missing columns are added, with their default (in the field's metadata) in the rows that are
    there; the order of columns, their comments and whether they may be null follow the schema.
    A field that may no longer be null must have a default for the rows that are null, else the
    call is refused and the table stays. Columns that the schema doesn't have stay, at the end.
    A Parquet table can only be altered so by writing it anew: that is done beside it, and only
    if anything but comments or new columns at the end differs.
    """
    if not spark.catalog.tableExists(name):
        _created(spark, name, schema, partition_by)
        return
    old = spark.table(name)
    have = {f.name: f for f in old.schema.fields}
    wanted = {f.name for f in schema.fields}
    rest = [f for f in old.schema.fields if f.name not in wanted]
    new = [f for f in schema.fields if f.name not in have]
    whole = T.StructType([*schema.fields, *rest])
    filled = [f for f in new if "default" in (f.metadata or {})]
    tightened = [f for f in schema.fields if not f.nullable and (f.name not in have or old.where(F.col(f"`{f.name}`").isNull()).limit(1).count())]
    if lacking := [f.name for f in tightened if "default" not in (f.metadata or {}) and (f.name in have or old.limit(1).count())]:
        raise ValueError(f"no default for null values in {', '.join(lacking)}")
    parts = list(partition_by) or [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    expected = [f.name for f in [*schema.fields, *rest] if f.name not in parts]
    moved = [c for c in old.columns if c not in parts and c in wanted] != [c for c in expected if c in have and c in wanted]
    if filled or tightened or moved or (new and rest):
        rows = checkpointed(align(old, whole))
        spark.sql(f"DROP TABLE {name}")
        _created(spark, name, whole, parts)
        rows.select(*spark.table(name).columns).write.insertInto(name)
    elif new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(_column(f) for f in new)})")
    said = {c.name: c.description or "" for c in spark.catalog.listColumns(name)}
    for f in schema.fields:
        comment = (f.metadata or {}).get("comment", "")
        if comment != said.get(f.name, ""):
            spark.sql(f"ALTER TABLE {name} ALTER COLUMN `{f.name}` COMMENT {_quoted(comment)}")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _column(f: T.StructField) -> str:
    comment = (f.metadata or {}).get("comment")
    return f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT {_quoted(comment)}" if comment else "")


def _created(spark: SparkSession, name: str, schema: T.StructType, partition_by: Sequence[str]) -> None:
    parts = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {name} ({', '.join(_column(f) for f in schema.fields)}) USING parquet{parts}")
