import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from selvedge import schemas
from selvedge.operators import catalog, dml, lifecycle, rules


def t(spark, rows):
    return spark.createDataFrame(rows, "id long, v int")


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_merges(spark):
    a, b = t(spark, [(1, 2), (3, None)]), t(spark, [(1, 3), (4, 5)])
    assert rows(dml.merge_add(a, b, ["id"], ["v"], insert=True)) == [(1, 5), (3, 0), (4, 5)]
    assert rows(dml.merge_insert(a, b, ["id"])) == [(1, 2), (3, None), (4, 5)]
    assert dml.merge_update(a, b, ["id"]).orderBy("id").collect()[0].v == 3
    assert rows(dml.upsert(a, b, ["id"])) == [(1, 3), (3, None), (4, 5)]
    assert rows(dml.staging_to_live(a, b, "WRITE_TRUNCATE")) == [(1, 3), (4, 5)]
    with pytest.raises(ValueError):
        dml.staging_to_live(a, b, "OTHER")


keyed = st.lists(st.tuples(st.integers(0, 5), st.integers(0, 9)), max_size=6, unique_by=lambda x: x[0])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keyed, keyed)
def test_upsert_twice_is_once_and_keys_stay_unique(spark, x, y):
    a, b = t(spark, x), t(spark, y)
    once = dml.upsert(a, b, ["id"])
    assert rows(once) == rows(dml.upsert(once, b, ["id"])) == sorted({**dict(x), **dict(y)}.items())
    moved, kept = dml.move_rows(a, F.col("v") > 4)
    assert moved.count() + kept.count() == len(x)


def test_not_in(spark):
    left = t(spark, [(1, 0), (None, 0), (5, 0)])
    assert rows(dml.not_in(left, "id", t(spark, [(5, 0)]), "id")) == [(1, 0)]
    assert rows(dml.not_in(left, "id", t(spark, [(5, 0), (None, 0)]), "id", guard=False)) == []
    assert rows(dml.not_in(left, "id", t(spark, [(5, 0), (None, 0)]), "id")) == [(1, 0)]
    assert dml.not_in(left, "id", t(spark, []), "id").count() == 3
    assert dml.not_in(left, "id", t(spark, [(None, 0)]), "id").count() == 3


def test_rules(spark):
    df = spark.createDataFrame([(1, "Dress", "y", "red", ["b", "a"]), (2, "dress", "x", "red", None), (3, "dress", "x", "blue", []), (4, None, "y", None, None)], "id long, name string, brand string, color string, product_tags array<string>")
    found = rules.labelled(df, {"d": [{"name": "DRESS", "EXCLUDE": {"brand": "x", "color": "red"}}], "t": [{"product_tags": "a && b"}], "none": [{"name": ""}], "not_y": [{"EXCLUDE": {"brand": "y"}}]}, "id", "label")
    assert rows(found) == [(1, "d"), (1, "t"), (2, "not_y"), (3, "d"), (3, "not_y")]
    assert rows(rules.dropped(df, [{"color": "red"}]).select("id", "brand")) == [(3, "x"), (4, "y")]
    assert rules.labelled(df, {}, "id", "label").collect() == []
    assert "Scan" in df._jdf.queryExecution().executedPlan().toString()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1  # one pass, whatever the number of rules


def test_names(spark):
    df = spark.createDataFrame([("ACME - Dress in Blue", None, None), ("Robe (M extra small", "red", "(M"), ("Tee x Medium size", None, "XL"), ("Skirt in Red wool", "red", None), ("Bag - big. More", None, None), (None, "a", "b")], "n string, c string, s string")
    clean = lambda **k: [r[0] for r in df.select(catalog.clean_name(F.col("n"), F.col("c"), F.col("s"), "ACME - ", **k)).collect()]
    assert clean() == ["Dress in Blue", "Robe", "Tee", "Skirt", "Bag", None]
    assert clean(strip_null_color=True)[0] == "Dress"


def test_counters_and_tags(spark):
    events = spark.createDataFrame([(1, "fave", 7), (1, "trash", 7), (2, "bag", 7), (9, "fave", 7), (None, "fave", 8), (1, "other", 8), (1, "fave", None)], "user_id long, event string, product_id long")
    assert rows(lifecycle.event_increments(events, (9,))) == [(7, 2, 1, 1), (8, 1, 1, 0)]
    active = spark.createDataFrame([(7, ["a"], 1, 1, 1)], "product_id long, product_tags array<string>, n_views int, n_likes int, n_add_to_cart int")
    assert rows(lifecycle.add_event_counts(active, lifecycle.event_increments(events, (9,)))) == [(7, ["a"], 3, 2, 2)]
    twice = lifecycle.tagged(lifecycle.tagged(active, active, "top"), active, "top")
    assert twice.first().product_tags == ["a", "top"]


def test_align_and_violations(spark):
    df = spark.createDataFrame([("x", "5", 1.5)], "extra string, product_id string, product_price double")
    out = schemas.align(df, schemas.PRODUCT_INFO, keep_extra=True)
    r = out.first()
    assert out.columns == [*schemas.PRODUCT_INFO.fieldNames(), "extra"] and (r.product_id, r.product_labels, r.product_price, r.extra) == (5, [], 1.5, "x")
    assert schemas.schema_differences(schemas.PRODUCT_INFO, schemas.DAILY_PRODUCT_DUMP)[0] == ("product_id", "relax")
    keys = t(spark, [(1, 1), (1, 2), (None, 3)])
    broken = schemas.violations(keys, schemas.Constraints(("id",), foreign_keys=(("id", "other", "k"),)), {"other": spark.createDataFrame([(2,)], "k long")})
    assert rows(broken) == [("id in other.k", 2), ("not null id", 1), ("unique id", 1)]
