import datetime
import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from selvedge.functions import arrays as A
from selvedge.operators import images, similarity, tags

DAY = datetime.date(2025, 1, 10)


def products(spark, rows):
    return spark.createDataFrame([(*r, DAY) for r in rows], "product_id long, labels array<string>, vector array<float>, execution_date date")


def unit(rng, n=4):
    v = np.array([rng.gauss(0, 1) for _ in range(n)])
    return [float(x) for x in v / np.linalg.norm(v)]


def scores(df):
    return {(r.product_id, r.similar_product_id): round(r.similarity_score, 4) for r in df.collect()}


def test_incremental_scores_equal_full_ones(spark):
    rng = random.Random(1)
    rows = [(i, rng.sample(["a", "b", "c"], rng.choice([1, 2])), unit(rng)) for i in range(60)] + [(99, ["a"], [1.0, 0.0])]
    none = spark.createDataFrame([], "product_id long, similar_product_id long, similarity_score double")
    whole = products(spark, rows)
    full = similarity.incremental_scores(whole, whole.limit(0), none, F.lit(DAY), 45, 0.3)
    expected = {}
    for (i, la, va), (j, lb, vb) in itertools.permutations(rows, 2):
        if set(la) & set(lb) and len(va) == len(vb) and (s := float(np.dot(np.float32(va).astype(float), np.float32(vb).astype(float)))) > 0.3:
            expected[i, j] = round(s, 4)
    assert scores(full) == expected
    first = similarity.incremental_scores(products(spark, rows[:40]), whole.limit(0), none, F.lit(DAY), 45, 0.3)
    stepped = similarity.incremental_scores(whole, whole.limit(0), spark.createDataFrame(first.collect(), first.schema), F.lit(DAY), 45, 0.3)
    assert scores(stepped) == expected


def test_chunks_make_no_difference(spark):
    rng = random.Random(2)
    v = spark.createDataFrame([(i, "x", unit(rng)) for i in range(80)], "id long, label string, vector array<float>")
    pairs = lambda n: {(r.id, r.other) for r in similarity.block_pairs(v, v, 0.2, n).collect()}
    assert pairs(7) == pairs(1000) != set()
    assert similarity.block_pairs(v.where("false"), v, 0.2).collect() == []


def test_null_and_broken_vectors_have_no_product(spark):
    v = spark.createDataFrame([(1, "x", [1.0, 0.0]), (2, "x", None), (3, "x", [1.0, None]), (4, "x", [1.0, float("nan")]), (5, "x", [0.9, 0.1]), (6, "x", [1.0])], "id long, label string, vector array<float>")
    assert {(r.id, r.other) for r in similarity.block_pairs(v, v, 0.1).collect()} == {(1, 5), (5, 1)}


def test_recommendations_against_brute_force(spark):
    rng = random.Random(4)
    users = [(u, unit(rng) if u != 3 else None) for u in range(12)]
    items = [(i, unit(rng) if i % 9 else None) for i in range(60)]
    items += [(100 + i, items[1][1]) for i in range(4)]  # ties
    seen = [(u, rng.choice(items)[0]) for u in range(12) for _ in range(u * 6)] + [(None, 1), (1, None)]
    got: dict = {}
    out = similarity.vector_recommendations(spark.createDataFrame(users, "user_id long, vector array<float>"), spark.createDataFrame(items, "product_id long, vector array<float>"), 4, spark.createDataFrame(seen, "user_id long, product_id long"))
    for r in sorted(out.collect()):
        got.setdefault(r.user_id, []).append(r.product_id)
    for u, v in users:
        if v is not None:
            score = lambda w: round(float(np.dot(np.float32(v).astype(float), np.float32(w).astype(float))), 9)  # noqa: B023, E731
            best = sorted(((-score(w), -i) for i, w in items if w is not None and (u, i) not in seen))[:4]
            assert got[u] == [-i for _, i in best]
    assert 3 not in got


def test_new_scores_replace_stored_ones(spark):
    act = products(spark, [(1, ["a"], [1.0, 0.0]), (2, ["a"], [0.8, 0.6])])
    stored = spark.createDataFrame([(1, 2, 0.3), (1, 9, 0.9)], "product_id long, similar_product_id long, similarity_score double")
    out = similarity.incremental_scores(act, act.limit(0), stored, F.lit(DAY), 45, 0.1)
    assert scores(out) == {(1, 2): 0.8, (2, 1): 0.8}


def test_color_variants_with_a_hot_name(spark):
    rows = [(i, "a", "b", f"{c} dress", c) for i, c in enumerate(["red", "blue", "green", None] * 6)] + [(90, "a", "b", "red coat", "red"), (91, "a", None, "red dress", "blue")]
    p = spark.createDataFrame(rows, "product_id long, advertiser_name string, product_brand string, product_name string, color string")
    got = {tuple(r) for r in similarity.color_variants(p, ["red", "blue", "green"]).collect()}
    assert got == {(i, j, d) for i, _, _, _, c in rows[:24] for j, _, _, _, d in rows[:24] if c and d and c != d}


def variants(rows):
    core = lambda name: tuple(w for w in name.split() if w not in ("red", "blue", "green"))
    return sorted({(i, j, d) for i, a, b, n, c in rows for j, e, f, m, d in rows if i != j and None not in (i, j, a, b, n, c, d, m) and (a, b, core(n)) == (e, f, core(m)) and c != d})


def test_color_variants_make_products_distinct_not_pairs(spark, monkeypatch):
    schema = "product_id long, advertiser_name string, product_brand string, product_name string, color string"
    rows = [(i, "a", "b", f"{c} {n}", c) for i, (c, n) in enumerate(itertools.product(["red", "blue", "green"] * 7, ["dress", "coat"]))]
    for pairs in (similarity.PAIRS, 100):
        monkeypatch.setattr(similarity, "PAIRS", pairs)
        out = similarity.color_variants(spark.createDataFrame(rows + rows[:9], schema), ["red", "blue", "green"])
        assert sorted(map(tuple, out.collect())) == variants(rows)
        assert "Aggregate" not in out._jdf.queryExecution().executedPlan().toString()  # no pair is exchanged
        assert pairs > 100 or out.rdd.getNumPartitions() == 882 // 100
        several = [*rows, (0, "a", "b", "blue dress", "blue"), (0, "a", "b", "red coat", "red"), (3, "a", "b", "green dress", "red"), (3, "a", "b", None, "red"), (None, "a", "b", "red dress", "red"), (5, "a", None, "red coat", "red")]
        assert sorted(map(tuple, similarity.color_variants(spark.createDataFrame(several, schema), ["red", "blue", "green"]).collect())) == variants(several)


def test_top_neighbours_ties(spark):
    s = spark.createDataFrame([(1, 7, 0.1), (1, 3, 0.9), (1, 8, 0.9)], "product_id long, similar_product_id long, similarity_score double")
    assert [(r["index"], r.similar_product_id) for r in similarity.top_neighbours(s, 3).orderBy("index").collect()] == [(0, 8), (1, 3), (2, 7)]


def test_arrays(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0, 4.0], [3.0], ["red", "dress", "red"])], "a array<double>, b array<double>, c array<double>, w array<string>")
    r = df.select(
        A.dot(F.col("a"), F.col("b")), A.dot(F.col("a"), F.col("c")), A.without(F.col("w"), A.strings("red")), A.sorted_words(A.strings("b", "", "a")), A.without_last_word(F.lit("blue denim jean")), A.without_last_word(F.lit("jean")),
        A.largest(F.col("b"), 1), A.positional_matches(F.col("a"), F.col("a")), F.round(A.norm(A.l2_normalized(F.col("b"))), 9), A.l2_normalized(F.array(F.lit(0.0))), A.display_text(F.lit("a  b"), F.lit(None).cast("string"), F.lit(" c")),
    ).first()
    assert tuple(r) == (11.0, None, ["dress"], "a b", "blue denim", "", [4.0], 2, 1.0, None, "a b c")
    assert A.mean_vectors(df, [], "a", 2).first()[0] == [1.0, 2.0]


def test_product_tags_and_running_maximum(spark):
    p = spark.createDataFrame([(1, "red", ["dress"], ["slim", "cropped"]), (2, None, None, None)], "product_id long, internal_color string, product_labels array<string>, product_secondary_labels array<string>")
    found = {(r.product_id, r.product_label, r.suggestion) for r in tags.product_tags(p, {"slim": ["cropped"], "dress": ["red"]}).collect()}
    assert (1, "dress", "slim dress") in found and (1, "dress", "slim red") in found and (2, "", "") in found
    assert not any("slim" in s and "cropped" in s and s.index("slim") < s.index("cropped") for _, _, s in found)
    rows = [(i, "s", label) for label, n in (("x", 3), ("y", 2), ("", 9)) for i in range(n)]
    t = spark.createDataFrame(rows, "product_id long, suggestion string, product_label string")
    assert sorted((r.product_label, r.n_hits) for r in tags.supported(t).collect()) == [("", 9), ("x", 3)]


def test_images(spark):
    pixels = bytes(range(0, 240, 10))
    good = b"P5\n# made here\n6 4\n255\n" + pixels
    df = spark.createDataFrame([(1, bytearray(good)), (2, bytearray(b"broken")), (3, None)], "id long, image binary")
    hashes = {r.id: r.image_hash for r in images.with_hash(df, "image").collect()}
    assert hashes[1] == images.difference_hash(good) and len(hashes[1]) == 4 and hashes[2] is None and hashes[3] is None
    vectors = {r.id: r.product_image_embedding for r in images.embedded(df, "image", side=8).collect()}
    assert all(abs(np.linalg.norm(v) - 1) < 1e-3 and len(v) == 64 for v in vectors.values()) and vectors[2] == vectors[3]
