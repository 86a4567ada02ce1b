import random
from collections import defaultdict

import pytest

from selvedge.llm import topn


def brute(rows, n):
    best = defaultdict(dict)
    for g, i, s in rows:
        if g is not None and i is not None and s is not None and s == s:
            best[g][i] = max(best[g].get(i, s), s)
    return {(g, p + 1, i) for g, items in best.items() for p, (i, s) in enumerate(sorted(items.items(), key=lambda x: (-x[1], -x[0]))[:n])}


@pytest.mark.parametrize("buffer", [50, 100_000])
def test_against_brute_force(spark, monkeypatch, buffer):
    monkeypatch.setattr(topn, "BUFFER_ROWS", buffer)
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2, 3, 4, None]), rng.choice([None, 2**60 + rng.randrange(40), rng.randrange(40)]), rng.choice([None, float("nan"), -1.0, 0.0, -0.0, 0.5, rng.random()])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g long, i long, s double").repartition(3)
    got = [(r.group, r.place, r.item) for r in topn.top_items(df, "g", "i", "s", 5).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, 5)


def test_empty_and_clashing_names(spark):
    df = spark.createDataFrame([("a", 1, 1.0, "x", 9)], "name string, item long, score double, `group` string, place int")
    assert [tuple(r) for r in topn.top_items(df, "name", "item", "score").collect()] == [("a", 1, 1, 1.0)]
    assert topn.top_items(df.where("false"), "name", "item", "score").collect() == []
