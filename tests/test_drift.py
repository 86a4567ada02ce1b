import json

from selvedge.operators import drift

SCHEMA = "feed long, file long, day string, payload string, key string, value int, record string"


def frame(spark, files):
    rows = [(f, n, f"2025-01-{n:02d}", p if isinstance(p, str) or p is None else json.dumps(p), "k", 1, "r") for f, n, lines in files for p in lines]
    return spark.createDataFrame(rows, SCHEMA)


def changes(spark, files):
    return sorted(tuple(r) for r in drift.schema_changes(frame(spark, files), "feed", "file", "day", "payload").collect())


def test_added_removed_renamed_retyped(spark):
    files = [
        (1, 1, [{"id": "a", "x": 1, "size": "S", "gone": True, "t": "5"}, {"id": "b", "x": 2, "size": "M", "t": "6"}, "{broken", '{"id": "a", "x"', "", None, "[1]", "7"]),
        (1, 2, [{"id": "a", "x": 1.0, "sizes": "S", "new": None, "t": 5}, {"id": "c", "sizes": "L", "t": 6}]),
        (1, 3, [{"id": "a", "X": 1, "sizes": ["S"], "t": 5, "new": {"b": 1}}]),
        (2, 3, [{"id": "a", "q": 1}]),
    ]
    assert changes(spark, files) == [
        (1, 2, "gone", "removed", ""), (1, 2, "size", "renamed", "sizes"), (1, 2, "t", "retyped", ""),
        (1, 3, "new", "added", ""), (1, 3, "sizes", "retyped", ""), (1, 3, "x", "renamed", "X"),
    ]


def test_no_common_record_is_no_renaming(spark):
    files = [(1, 1, [{"id": 1, "a": "x"}]), (1, 2, [{"id": 2, "b": "x"}]), (1, 3, [{"id": 2, "c": "y"}]), (1, 4, ["unreadable"])]
    assert changes(spark, files) == [(1, 2, "a", "removed", ""), (1, 2, "b", "added", ""), (1, 3, "b", "removed", ""), (1, 3, "c", "added", ""), (1, 4, "c", "removed", ""), (1, 4, "id", "removed", "")]


def test_repeated_lines_and_one_large_file(spark):
    many = [{"id": i % 500, "old": f"v{i % 500}"} for i in range(1500)]
    renamed = [{"id": i % 500, "fresh": f"v{i % 500}"} for i in range(1500)]
    assert changes(spark, [(1, 1, many), (1, 2, renamed)]) == [(1, 2, "old", "renamed", "fresh")]
    renamed[7]["fresh"] = "other"
    assert changes(spark, [(1, 1, many), (1, 2, renamed)]) == [(1, 2, "fresh", "added", ""), (1, 2, "old", "removed", "")]


def test_two_fields_with_equal_values_and_one_that_differs_once(spark):
    old = [{"id": i, "a": i % 2, "b": True, "c": i} for i in range(6)]
    new = [{"id": i, "x": i % 2, "y": i % 2, "z": i != 3, "w": True} for i in range(6)]
    assert changes(spark, [(1, 1, old), (1, 2, new)]) == [(1, 2, "a", "renamed", "x"), (1, 2, "a", "renamed", "y"), (1, 2, "b", "renamed", "w"), (1, 2, "c", "removed", ""), (1, 2, "z", "added", "")]


def test_kinds_fold_through_the_lattice(spark):
    df = frame(spark, [(1, 1, [{"a": 1, "b": None, "c": [1]}, {"a": "x", "b": True}]), (1, 2, [{"a": 2, "c": {"k": 1}}])])
    assert sorted(tuple(r) for r in drift.headers(df, ["file"], "payload").collect()) == [(1, "a", "string"), (1, "b", "boolean"), (1, "c", "array"), (2, "a", "number"), (2, "c", "object")]
    assert sorted(tuple(r) for r in drift.union_schema(df, "payload").collect()) == [("a", "string"), ("b", "boolean"), ("c", "string")]


def test_empty(spark):
    assert changes(spark, []) == []
    assert drift.unified(frame(spark, []), ["file"], "payload").collect() == []


def test_unified_table(spark):
    df = frame(spark, [(1, 1, [{"id": "a", "n": 1, "b": True, "l": [1, 2], "File": "x"}]), (1, 2, [{"id": 3, "n": "two", "o": {"k": None}, "f": None, "b": None}])])
    out = drift.unified(df, ["file"], "payload")
    assert out.dtypes == [("file", "bigint"), ("File_field1", "string"), ("b", "boolean"), ("id", "string"), ("l", "string"), ("n", "string"), ("o", "string")]
    assert sorted(map(tuple, out.collect())) == [(1, "x", True, "a", "[1,2]", "1", None), (2, None, None, "3", None, "two", '{"k":null}')]
