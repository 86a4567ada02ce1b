import random

from pyspark.sql import functions as F

from selvedge.operators import snapshots


def test_consecutive_snapshots_against_brute_force(spark):
    rng = random.Random(4)
    states = {d: {k: (rng.choice([None, 1, 2]), rng.choice([None, ["a"], ["a", "b"], []])) for k in rng.sample(range(60), 40)} for d in ("d1", "d2", "d3", "d4")}
    rows = [(d, k, *v) for d, s in states.items() for k, v in s.items()]
    df = spark.createDataFrame(rows, "day string, id long, price int, labels array<string>")
    got = sorted(tuple(r) for r in snapshots.consecutive_diff(df, "day", ["id"]).collect())
    expected = []
    for a, b in (("d1", "d2"), ("d2", "d3"), ("d3", "d4")):
        for k in states[a].keys() | states[b].keys():
            if k not in states[a]:
                expected.append((b, k, "added"))
            elif k not in states[b]:
                expected.append((b, k, "removed"))
            elif states[a][k] != states[b][k]:
                expected.append((b, k, "changed"))
    assert got == sorted(expected)


def test_latest_rows(spark):
    rows = [("d", 1, 5, "old"), ("d", 1, 9, "new"), ("d", 1, 9, "mew"), ("d", 1, None, "z"), (None, 1, 1, "a"), ("d", None, 1, "a"), ("d", 2, None, None)] + [("d", 3, 1, "hot")] * 2000
    df = spark.createDataFrame(rows, "day string, id long, loaded long, name string")
    got = snapshots.latest_rows(df, ["day", "id"], "loaded", {"name": F.col("name")})
    assert sorted(tuple(r) for r in got.collect()) == [("d", 1, "new"), ("d", 2, None), ("d", 3, "hot")]


def test_empty_and_single(spark):
    df = spark.createDataFrame([("d", 1)], "day string, id long")
    assert snapshots.consecutive_diff(df, "day", ["id"]).collect() == []
    assert snapshots.consecutive_diff(df.where("false"), "day", ["id"]).collect() == []
    assert [tuple(r) for r in snapshots.diff(df.where("false"), df, ["day", "id"]).collect()] == [("d", 1, "added")]
