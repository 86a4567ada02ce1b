import random

from selvedge.llm import mixing


def mix(spark, docs, target, **kw):
    d = spark.createDataFrame(docs, "doc_id long, source string, n long")
    t = spark.createDataFrame(target, "source string, target_share double, max_repeats int")
    used = mixing.copies(d, t, "doc_id", "source", "n", **kw)
    return used, t


def test_shares_and_repeats(spark):
    rng = random.Random(1)
    docs = [(i, rng.choice(["a"] * 80 + ["b"] * 15 + ["c"] * 5 + [None, "other"]), rng.choice([0, 5, 50, rng.randrange(1, 300)])) for i in range(4000)]
    target = [("a", 0.5, 1), ("b", 0.3, 4), ("c", 0.2, 8)]
    used, t = mix(spark, docs, target)
    rows = used.collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    limit = {s: m for s, _, m in target}
    assert all(1 <= r.copies <= limit[r.source] for r in rows) and all(r.n > 0 for r in rows)
    for r in mixing.shares(used, t, "n").collect():
        assert abs(r.actual_share - r.target_share) < 0.002
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mix(spark, docs, target)[0].collect()))  # repeatable


def test_pareto_sampling_keeps_inclusion_odds(spark):
    docs = [(i, "a", 10) for i in range(2000)]
    from pyspark.sql import functions as F

    weight = F.when(F.col("doc_id") % 2 == 0, 1.0).otherwise(0.5)
    used, _ = mix(spark, docs, [("a", 1.0, 1)], total=6000.0, weight=weight)
    rows = used.collect()
    even = sum(r.doc_id % 2 == 0 for r in rows)
    assert abs(len(rows) - 600) <= 1 and abs(even - 400) < 40


def test_what_is_over_max_repeats_goes_to_other_documents(spark):
    from pyspark.sql import functions as F

    docs = [(i, "a", 10) for i in range(3000)]
    weight = F.when(F.col("doc_id") < 100, 1000.0).when(F.col("doc_id") < 1000, 4.0).otherwise(1.0)
    used, _ = mix(spark, docs, [("a", 1.0, 2)], total=20_000.0, weight=weight)
    rows = {r.doc_id: r.copies for r in used.collect()}
    assert abs(sum(rows.values()) - 2000) <= 1  # nothing of the part is lost
    assert all(rows[i] == 2 for i in range(100))  # at most twice, and the other 1800 by weight 4 : 1
    heavy = sum(n for i, n in rows.items() if 100 <= i < 1000)
    scale = 1800 / (900 * 4 + 2000)
    expected = 900 * 4 * scale
    assert abs(heavy - expected) < 4 * (900 * 0.25) ** 0.5 and max(rows.values()) == 2


def test_scales_against_brute_force(spark):
    rng = random.Random(3)
    sized = [("s", float(rng.randrange(1, 50)), 2.0 ** rng.randrange(-3, 6)) for _ in range(300)]
    total = sum(x for _, x, _ in sized)
    for share in (0.01, 0.3, 0.9, 1.7, 2.5, 3.0):
        plan = spark.createDataFrame([("s", 3.0, share * total)], "source string, max_repeats double, _part double")
        found = mixing.expectation_scales(spark.createDataFrame(sized, "source string, _size double, _w double").groupBy("source", "_w").agg({"_size": "sum"}).toDF("source", "_w", "_mass"), plan).collect()
        scale = found[0][1] if found else float("inf")
        assert abs(sum(x * min(3.0, scale * w) for _, x, w in sized) - share * total) < 1e-6 * total


def test_one_bin_of_equal_ranks_is_cut_exactly(spark):
    used, _ = mix(spark, [(i, "a", 1) for i in range(500)], [("a", 1.0, 1)], total=123.0)
    assert used.count() == 123


def test_null_and_broken_weights_are_never_used(spark):
    from pyspark.sql import functions as F

    weight = F.when(F.col("doc_id") == 1, float("nan")).when(F.col("doc_id") == 2, -1.0).when(F.col("doc_id") == 3, 1.0)
    used, _ = mix(spark, [(i, "a", 5) for i in range(1, 5)], [("a", 1.0, 2)], weight=weight)
    assert [tuple(r) for r in used.collect()] == [(3, "a", 5, 2)]


def test_edges(spark):
    used, t = mix(spark, [(1, "a", 0), (2, None, 5)], [("a", 0.5, 2), ("b", 0.5, 2)])
    assert used.collect() == []
    assert {(r.source, r.actual_share, r.n_copies) for r in mixing.shares(used, t, "n").collect()} == {("a", 0.0, 0), ("b", 0.0, 0)}
    used, _ = mix(spark, [(1, "a", 7)], [("a", 1.0, 3)])
    assert [tuple(r) for r in used.collect()] == [(1, "a", 7, 3)]
    empty, _ = mix(spark, [(1, "a", 7)], [("a", 1.0, 3)], total=0.0)
    assert empty.collect() == []
