import datetime
import random

from pyspark.sql import functions as F

from selvedge.operators import history

DAY = datetime.date(2025, 1, 1)
SCHEMA = "id long, day date, price double, loaded timestamp, payload string, _last int"


def versions(df):
    return sorted((r.id, r.valid_from, r.valid_to, r.payload) for r in history.entity_versions(df, "id", "day", history.cents("price"), "loaded").collect())


def brute(rows):
    last = {}
    for i, d, p, t, *_ in rows:
        if i is None or d is None or p is None or p != p:
            continue
        key = (t is not None, t, round(p * 100))
        if (i, d) not in last or (key[0], key[1] or datetime.datetime.min, key[2]) > last[i, d]:
            last[i, d] = (key[0], key[1] or datetime.datetime.min, key[2])
    out = []
    for i in {k for k, _ in last}:
        now = None
        for d in sorted(d for k, d in last if k == i):
            c = last[i, d][2]
            if c != now:
                out.append([i, d, None, c])
                if now is not None:
                    out[-2][2] = d
                now = c
    return sorted(map(tuple, out))


def rows(rng, n):
    t = datetime.datetime(2025, 1, 1)
    return [(rng.choice([None, 1, 1, 1, 2, 3]), rng.choice([None, *(DAY + datetime.timedelta(k) for k in range(25))]), rng.choice([None, float("nan"), 1.0, 1.0, 2.0, 2.5]), rng.choice([None, *(t + datetime.timedelta(hours=h) for h in range(4))]), "x", 1) for _ in range(n)]


def test_against_brute_force(spark):
    data = rows(random.Random(2), 800)
    assert versions(spark.createDataFrame(data, SCHEMA)) == brute(data)


def test_several_snapshots_are_one(spark):
    data = rows(random.Random(3), 300)
    parts = [spark.createDataFrame(data[:100], SCHEMA), spark.createDataFrame(data[100:], SCHEMA)]
    assert versions(parts) == brute(data)


def test_small_batches_many_runs_and_long_histories(spark, monkeypatch):
    monkeypatch.setattr(history, "AHEAD", 0)  # batches of 256 rows
    rng = random.Random(6)
    data = [(rng.choice([1, 1, 1, 2, 3]), DAY + datetime.timedelta(rng.randrange(3000)), float(rng.randrange(2)), datetime.datetime(2025, 1, 1) + datetime.timedelta(hours=rng.randrange(40)), "x", 1) for _ in range(9000)]
    df = spark.createDataFrame(data, SCHEMA)
    got = history.entity_versions(df, "id", "day", history.cents("price"), "loaded", F.hour("loaded"), 2)
    assert sorted((r.id, r.valid_from, r.valid_to, r.payload) for r in got.collect()) == brute(data)


def test_a_new_snapshot_is_one_more_run_and_a_lost_writer_leaves_none(spark, tmp_path):
    store = history.RunStore(spark, str(tmp_path / "runs"), 2)
    frame = lambda data: spark.createDataFrame(data, "entity string, time timestamp, loaded int, payload string")
    t = [datetime.datetime(2025, 1, d) for d in range(1, 6)]
    store.add(frame([("a", t[0], 1, "x"), ("b", t[0], 1, "p"), ("a", t[2], 1, "y")]))
    store.add(frame([("a", t[1], None, "x"), ("b", t[0], 2, "q"), ("a", t[2], 0, "z"), ("a", t[4], 1, "y")]))
    (tmp_path / "runs" / "lost").mkdir()
    assert sorted(map(tuple, store.versions().collect()), key=str) == [("a", t[0], t[2], "x"), ("a", t[2], None, "y"), ("b", t[0], None, "q")]
    store.add(frame([("a", t[3], 1, "w")]))
    assert sorted(map(tuple, store.versions().where("entity = 'a'").collect()), key=str) == [("a", t[0], t[2], "x"), ("a", t[2], t[3], "y"), ("a", t[3], t[4], "w"), ("a", t[4], None, "y")]


def test_returning_price_and_empty(spark):
    data = [(1, DAY + datetime.timedelta(k), p, None, "", 0) for k, p in enumerate([1.0, 1.004, 2.0, 1.0])]
    assert [v[3] for v in sorted(versions(spark.createDataFrame(data, SCHEMA)), key=lambda v: v[1])] == [100, 200, 100]
    assert versions(spark.createDataFrame([], SCHEMA)) == []


def test_cents(spark):
    df = spark.createDataFrame([(121.4999999997,), (0.29,), (None,), (float("nan"),), (float("inf"),), (-1.5,)], "price double")
    assert [r[0] for r in df.select(history.cents("price")).collect()] == [12150, 29, None, None, None, -150]
