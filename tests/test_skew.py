import random

from selvedge.functions import skew
from selvedge.functions.components import connected_components


def test_join_with_hot_and_null_keys(spark):
    rng = random.Random(1)
    big = [(i, rng.choice([7] * 9 + [None, *range(50)])) for i in range(20_000)]
    df = spark.createDataFrame(big, "id long, k long").repartition(3)
    small = spark.createDataFrame([(k, k * 2) for k in range(0, 60, 2)] + [(7, 14)], "k long, v long")
    monkey = {k: v for k, v in [(k, k * 2) for k in range(0, 60, 2)] + [(7, 14)]}
    assert [r[0] for r in skew.hot_keys(df, ["k"], 10)] == [7]
    for how in ("inner", "left"):
        got = sorted(((r.id, r.k, r.v) for r in skew.join_unique(df, small, ["k"], how, one_in=10, salts=4).collect()), key=lambda x: x[0])
        assert got == [(i, k, monkey.get(k)) for i, k in big if how == "left" or k in monkey]
    assert skew.join_unique(df, small, ["k"], "left_anti", one_in=10).count() == sum(k not in monkey for _, k in big)


def test_spread_join_in_given_tasks(spark):
    left = [(i, 7 if i < 2000 else i % 90 or None) for i in range(4000)]
    df = spark.createDataFrame(left, "id long, k long")
    right = spark.createDataFrame([(7, 1), (7, 2), (8, 3), (None, 4)], "k long, v long")
    for one_in, hot in ((3, [7]), (1, [])):
        assert [r[0] for r in skew.hot_keys(df, ["k"], one_in)] == hot
        out = skew.join_spread(df, right, ["k"], one_in=one_in, salts=4, tasks=9)
        assert out.rdd.getNumPartitions() == 9
        assert sorted((r.id, r.k, r.v) for r in out.collect()) == [(i, k, v) for i, k in left for v in {7: (1, 2), 8: (3,)}.get(k, ())]


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 102), (102, 101), (7, 7), (None, 3), (200, 200)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 102: 100, 200: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []
