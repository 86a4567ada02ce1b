import datetime
import random

from pyspark.sql import functions as F

from selvedge.operators import references as R

REFS = "kind string, table_name string, owner_key string, ref_id long, at long, period int, reason string"


def report(spark, refs, records, traces):
    r = spark.createDataFrame([(*x, 0, "x") for x in refs], REFS)
    e = spark.createDataFrame(records, "id long, at long, ref_id long")
    t = spark.createDataFrame([(x,) for x in traces], "id long")
    state = R.merge_states(R.reference_deltas(r), R.record_deltas(e, "p", "id", F.col("at")), R.trace_deltas(t, "p", "id"))
    return R.orphan_report(r, state), r, e, t


def brute(refs, records, traces):
    first = {}
    for k, at, _ in records:
        if k is not None:
            first[k] = min(first.get(k, at), at)
    out = set()
    for _, t, o, k, at in refs:
        if k is None:
            continue
        period = None if at is None else datetime.datetime.fromtimestamp(at, datetime.timezone.utc).strftime("%Y-%m")
        if k in first:
            if at is not None and first[k] > at:
                out.add((t, o, k, period, "late"))
        else:
            out.add((t, o, k, period, "deleted" if k in traces else "missing"))
    return out


def test_against_brute_force_with_a_hot_key(spark):
    rng = random.Random(5)
    at = lambda: rng.choice([None, 0, 1_700_000_000, 1_700_000_000 + rng.randrange(9_000_000)])
    refs = [("p", rng.choice(["a", "b"]), rng.choice([None, *map(str, range(600))]), rng.choice([7, 7, 7, None, -1, 0, *range(300)]), at()) for _ in range(3000)]
    records = [(k, 1_700_000_000 + rng.randrange(9_000_000), None) for k in range(8, 150) for _ in range(rng.choice([1, 1, 2]))] + [(None, 5, None)]
    traces = [rng.randrange(100, 300) for _ in range(80)]
    got = [tuple(r) for r in report(spark, refs, records, traces)[0].collect()]
    assert len(got) == len(set(got)) and set(got) == brute(refs, records, set(traces))


def test_states_add_up(spark):
    refs = [("p", "a", "o", 1, 100), ("p", "a", "o", 2, 100), ("p", "a", "o", 3, 100)]
    _, r, e, t = report(spark, refs, [(1, 50, None)], [])
    first = R.merge_states(R.reference_deltas(r), R.record_deltas(e, "p", "id", F.col("at")))
    assert sorted(x.ref_id for x in R.orphan_keys(first).collect()) == [2, 3]
    born = spark.createDataFrame([(2, 60)], "id long, at long")
    gone = spark.createDataFrame([(1, 60)], "id long, at long")
    later = R.merge_states(first, R.record_deltas(born, "p", "id", F.col("at")), R.record_deltas(gone, "p", "id", F.col("at"), F.lit(-1)), R.reference_deltas(r.where("ref_id = 3"), F.lit(-1)))
    assert [x.ref_id for x in R.orphan_keys(later).collect()] == [1]


def reasons(spark, refs, *deltas):
    r = spark.createDataFrame([("p", "t", str(i), k, at, 0, "x") for i, (k, at) in enumerate(refs)], REFS)
    parts = [R.record_deltas(spark.createDataFrame([(k, at)], "id long, at long"), "p", "id", F.col("at"), F.lit(n)) for k, at, n in deltas]
    state = R.reference_deltas(r)
    for p in parts:  # one period after the other
        state = R.merge_states(state, p)
    return {(int(x.owner_key), x.reason) for x in R.orphan_report(r, state).collect()}


def test_a_key_that_was_deleted_and_came_back_is_late_for_references_between(spark):
    assert reasons(spark, [(1, 50), (1, 150)], (1, 10, 1), (1, 20, -1), (1, 100, 1)) == {(0, "late")}
    assert reasons(spark, [(1, 50)], (1, 100, 1), (1, 20, -1), (1, 10, 1)) == {(0, "late")}
    assert reasons(spark, [(1, 50)], (1, 10, 1), (1, 100, 1), (1, 20, -1), (1, 10, -1), (1, 20, 1)) == {(0, "late")}
    assert reasons(spark, [(1, 50)], (1, 10, 1), (1, 20, 1), (1, 30, -1)) == set()
    assert reasons(spark, [(1, 50)], (1, 10, 1), (1, 60, -1)) == {(0, "missing")}


def test_withdrawn_references_and_cancelled_records_leave_no_state(spark):
    r = spark.createDataFrame([("p", "t", "o", 1, 5, 0, "x")] * 3, REFS)
    e = spark.createDataFrame([(1, None), (2, 7)], "id long, at long")
    plus, minus = R.record_deltas(e, "p", "id", F.col("at")), R.record_deltas(e, "p", "id", F.col("at"), F.lit(-1))
    assert R.merge_states(R.reference_deltas(r), plus, R.reference_deltas(r, F.lit(-1)), minus).collect() == []


def test_empty(spark):
    assert report(spark, [], [], [])[0].collect() == []
