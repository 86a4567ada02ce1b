"""Similarity within label blocks, re-ranking, top neighbours, colour variants and recommendations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from selvedge.functions import arrays as A
from selvedge.functions.skew import hot_keys, join_spread, join_unique
from selvedge.operators import dml
from selvedge.session import checkpointed, written

#: Vectors of a label that are multiplied at a time.
CHUNK = 1024
#: Pairs of colour variants that a task makes.
PAIRS = 8_000_000


def _packed(vectors: DataFrame, chunk: int, side: str, *more: str) -> DataFrame:
    """Vectors of a label in chunks of about `chunk`, by a hash of the id, so a hot label is many rows.

    One list of (id, vector, more), so that nulls can't put the lists of a chunk out of step.
    """
    per = vectors.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("_chunks"))
    placed = vectors.join(per, "label").withColumn("_chunk", F.pmod(F.xxhash64("id"), F.col("_chunks")).cast("int"))
    return placed.groupBy("label", "_chunks", "_chunk").agg(F.collect_list(F.struct("id", "vector", *more)).alias(side))


def _meetings(a: DataFrame, b: DataFrame) -> DataFrame:
    """a, b: every chunk of a with every chunk of b of its label.

    a's chunks are spread over several tasks a label, to which b's are copied: as many as the
    label has chunks in a, but no more than keep the whole cluster busy (four tasks a core), so
    that copies don't grow with the data.
    """
    most = 4 * a.sparkSession.sparkContext.defaultParallelism
    left = a.withColumn("_salt", F.pmod("_chunk", F.lit(most))).drop("_chunks", "_chunk")
    spread = a.select("label", F.least("_chunks", F.lit(most)).alias("_spread")).distinct()
    right = b.drop("_chunks", "_chunk").join(spread, "label").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_spread") - 1))).drop("_spread")
    return left.join(right, ["label", "_salt"]).drop("label", "_salt")


Chunk = tuple[np.ndarray, np.ndarray]


def _by_length(rows: list) -> dict[int, Chunk]:
    """ids and vectors of a chunk, by the vectors' length; a vector with a null element has no product."""
    held: dict[int, tuple[list, list]] = {}
    for r in rows:
        ids, vectors = held.setdefault(len(r["vector"]), ([], []))
        ids.append(r["id"])
        vectors.append(r["vector"])
    out = {}
    for n, (ids, vectors) in held.items():
        v = np.array(vectors, np.float64).reshape(len(ids), n)
        whole = ~np.isnan(v).any(1)
        out[n] = (np.array(ids, np.int64)[whole], v[whole])
    return out


def block_pairs(left: DataFrame, right: DataFrame, least: float, chunk: int = CHUNK) -> DataFrame:
    """id, other, score: pairs within a label whose dot product exceeds `least`, once per pair and direction given.

    left, right: id, label, vector. Chunks of both sides meet by label and are multiplied as
    matrices; only pairs over the threshold leave a task, so no row per pair is made or
    shuffled before it is known to count. Null vectors, vectors with a null or NaN and vectors
    of unequal length have no product. A pair with several labels in common counts once.
    """
    usable = "id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL"
    met = _meetings(_packed(left.where(usable), chunk, "a"), _packed(right.where(usable), chunk, "b"))

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for a, b in zip(rows["a"], rows["b"]):
                xs, ys = _by_length(a), _by_length(b)
                for n in xs.keys() & ys.keys():
                    (ai, x), (bi, y) = xs[n], ys[n]
                    scores = x @ y.T
                    i, j = np.nonzero(scores > least)
                    keep = ai[i] != bi[j]
                    yield pd.DataFrame({"id": ai[i][keep], "other": bi[j][keep], "score": scores[i, j][keep]})

    return met.mapInPandas(multiply, "id long, other long, score double").dropDuplicates(["id", "other"])


def incremental_scores(active: DataFrame, historic: DataFrame, stored: DataFrame, day: Column, days: int, least: float) -> DataFrame:
    """product_id, similar_product_id, similarity_score: stored scores kept up with only the pairs that touch a new product.

    active, historic: product_id, labels (array), vector, execution_date; stored: the scores so
    far. New is an active product without stored score. Scored are old against new products and
    new against all active ones of a label, the similar side being active; historic products
    older than `days` take no part. Stored scores stay while their similar side is active; where
    a pair has a new score as well, that counts.
    """
    act = active.select(F.col("product_id").alias("id"), F.explode("labels").alias("label"), "vector")
    recent = dml.delete_in(historic.where(F.col("execution_date") > F.date_sub(day, days)), active, ["product_id"])
    his = recent.select(F.col("product_id").alias("id"), F.explode("labels").alias("label"), "vector")
    roots = stored.select(F.col("product_id").alias("id")).distinct()
    new, old = act.join(roots, "id", "left_anti"), act.join(roots, "id", "left_semi").unionByName(his)
    pairs = block_pairs(old, new, least).unionByName(block_pairs(new, act, least))
    fresh = pairs.select(F.col("id").alias("product_id"), F.col("other").alias("similar_product_id"), F.col("score").alias("similarity_score"))
    kept = stored.join(active.select(F.col("product_id").alias("similar_product_id")), "similar_product_id", "left_semi").where(F.col("similarity_score") > least)
    both = fresh.withColumn("_new", F.lit(True)).unionByName(kept.select(*fresh.columns).withColumn("_new", F.lit(False)))
    best = both.groupBy("product_id", "similar_product_id").agg(F.max(F.struct("_new", "similarity_score")).alias("_s"))
    return best.select("product_id", "similar_product_id", F.col("_s.similarity_score").alias("similarity_score"))


def boosted(scores: DataFrame, roots: DataFrame, others: DataFrame, priority: list[str], shared: float = 0.8, first: float = 0.24) -> DataFrame:
    """Scores times 1 + shared * |S| + first * |S and priority|, S being the secondary labels both have.

    roots, others: product_id, product_secondary_labels.
    """
    s = scores.join(roots.select("product_id", F.col("product_secondary_labels").alias("_a")), "product_id")
    s = s.join(others.select(F.col("product_id").alias("similar_product_id"), F.col("product_secondary_labels").alias("_b")), "similar_product_id")
    both = F.array_intersect("_a", "_b")
    factor = 1 + shared * F.coalesce(F.size(both), F.lit(0)) + first * F.coalesce(F.size(F.array_intersect(both, A.strings(*priority))), F.lit(0))
    return s.select("product_id", "similar_product_id", (F.col("similarity_score") * factor).alias("similarity_score"))


def top_neighbours(scores: DataFrame, n: int) -> DataFrame:
    """product_id, index (from 0), similar_product_id: the n best per product, ties by the larger neighbour first."""
    best = Window.partitionBy("product_id").orderBy(F.desc("similarity_score"), F.desc("similar_product_id"))
    return scores.withColumn("_place", F.row_number().over(best)).where(F.col("_place") <= n).select("product_id", (F.col("_place") - 1).alias("index"), "similar_product_id")


def refreshed_neighbours(scores: DataFrame, active: DataFrame, historic: DataFrame, stored: DataFrame, priority: list[str], n: int) -> DataFrame:
    """product_id, index, similar_product_id: the n best for every root, active or historic, that has scores, and what is stored for the others.

    active, historic: product_id, product_secondary_labels; a product in both counts as active.
    stored: the earlier result. Its rows of roots with new scores go; the rest stays.
    """
    old = dml.delete_in(historic.select("product_id", "product_secondary_labels"), active, ["product_id"])
    roots = active.select("product_id", "product_secondary_labels").unionByName(old)
    score = F.round("similarity_score", 6).alias("similarity_score")  # equal to the last digit however the sums were made
    new = top_neighbours(boosted(scores, roots, active, priority).select("product_id", "similar_product_id", score), n)
    return dml.delete_in(stored.select(*new.columns), new.select("product_id").distinct(), ["product_id"]).unionByName(new)


def color_variants(products: DataFrame, colors: list[str]) -> DataFrame:
    """product_id, other_id, color: products of one advertiser and brand with equal names but for colour words.

    products: product_id, advertiser_name, product_brand, product_name, color. The words left
    of the name are part of the join key. To have one advertiser, brand and rest of the name is
    transitive, so variants of variants are found in the same step. Products without colour,
    brand or advertiser have none. Every pair is asked for; the rows of a name that holds more
    than a two-hundredth of all products are spread, those of the other side copied. Pairs are
    quadratic in a name's products, so it is products that are made distinct, not pairs: only
    a product that still has several rows, of other colours or names, can give a pair twice.
    Tasks are as many as the pairs ask for, since the table's bytes say nothing about them.
    """
    keys = ["advertiser_name", "product_brand", "core"]
    core = A.without(A.word_list(F.col("product_name")), A.strings(*colors))
    rows = products.where("product_id IS NOT NULL AND color IS NOT NULL").select("product_id", "advertiser_name", "product_brand", "product_name", "color").repartition("product_id")
    named = rows.select("product_id", "advertiser_name", "product_brand", "color", F.array_join(core, " ").alias("core")).distinct()
    p = written(named.withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy("product_id"))))
    b = p.select(*keys, F.col("product_id").alias("other_id"), F.col("color").alias("other_color"))
    met = p.where("advertiser_name IS NOT NULL AND product_brand IS NOT NULL AND core IS NOT NULL").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.sum(F.col("_n") * F.col("_n"))).first()[0] or 0
    tasks = max(met // PAIRS, p.sparkSession.sparkContext.defaultParallelism) if met > PAIRS else None

    def pairs(a: DataFrame) -> DataFrame:
        return join_spread(a.drop("_rows"), b, keys, tasks=tasks).where("product_id != other_id AND color != other_color").select("product_id", "other_id", F.col("other_color").alias("color"))

    several = p.where("_rows > 1")
    once = pairs(p.where("_rows = 1"))
    return once if several.isEmpty() else once.unionByName(pairs(several).distinct())


def simple_recommendations(events: DataFrame, products: DataFrame, more_than: int) -> DataFrame:
    """user_id, index, product_id: users with more than so many events, each with the same product, the smallest id."""
    users = events.where("user_id IS NOT NULL").groupBy("user_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > more_than)
    first = products.agg(F.min("product_id")).first()[0]
    return users.select("user_id", F.lit(0).alias("index"), F.lit(first).cast("long").alias("product_id")).where("product_id IS NOT NULL")


def user_vectors(events: DataFrame, vectors: DataFrame, day: Column, weights: dict[str, float], least_positive: float, least_negative: float, dimensions: int) -> DataFrame:
    """user_id, vector: each user's taste as the mean of weighted product vectors, of length 1.

    An event weighs its kind's weight over the days since (events of the day itself nothing).
    Users count if their positive weights exceed least_positive and the negative ones
    least_negative in size; negative weights are scaled by 0.8 * |positive / negative|.
    vectors: product_id (unique), vector; null vectors take no part. Users and products with a
    large part of all events are spread in the joins; a mean is partial sums per task.
    """
    weighed = checkpointed(weighed_events(events, day, weights).select("user_id", "product_id", "_w"))  # used for the totals, the hot keys and the joins
    totals = weighed.groupBy("user_id").agg(F.sum(F.when(F.col("_w") > 0, F.col("_w"))).alias("_p"), F.sum(F.when(F.col("_w") < 0, F.col("_w"))).alias("_n"))
    totals = totals.where((F.abs("_n") > least_negative) & (F.col("_p") > least_positive))
    scaled = join_unique(weighed, totals, ["user_id"]).withColumn("_w", F.when(F.col("_w") < 0, F.col("_w") * 0.8 * F.abs(F.col("_p") / F.col("_n"))).otherwise(F.col("_w")))
    parts = join_unique(scaled, vectors.where("vector IS NOT NULL"), ["product_id"], hot=hot_keys(weighed, ["product_id"])).select("user_id", A.scaled(F.col("vector"), F.col("_w")).alias("_v"))
    return A.mean_vectors(parts, ["user_id"], "_v", dimensions).select("user_id", A.l2_normalized(F.col("vector")).alias("vector")).where("vector IS NOT NULL")


def weighed_events(events: DataFrame, day: Column, weights: dict[str, float]) -> DataFrame:
    """events that say something about a user's taste, with their weight _w."""
    kind = F.lit(None).cast("double")
    for name, w in weights.items():
        kind = F.when(F.col("event") == name, F.lit(float(w))).otherwise(kind)
    return events.withColumn("_w", F.try_divide(kind, F.datediff(day, F.col("event_date")))).where("_w IS NOT NULL AND user_id IS NOT NULL AND product_id IS NOT NULL")


def vector_recommendations(users: DataFrame, vectors: DataFrame, n: int, seen: DataFrame | None = None) -> DataFrame:
    """user_id, index (from 0), product_id: the n products nearest to each user's vector that they haven't seen.

    users: user_id, vector; seen: user_id, product_id. Every user is compared with every
    product, in blocks: chunks of users meet chunks of products, and of each meeting a user
    keeps n products more than they have seen at all, so that n unseen ones are among them. What
    was seen is taken out by a join on user and product, and the best of all meetings are
    kept; no user-product matrix is shuffled and no user's history is one row. Ties by the
    larger product first. Null vectors, and those with a null or NaN, take no part.
    """
    known = (seen if seen is not None else users.select("user_id", F.lit(None).cast("long").alias("product_id"))).where("user_id IS NOT NULL AND product_id IS NOT NULL").select("user_id", "product_id").distinct()
    spare = users.where("user_id IS NOT NULL AND vector IS NOT NULL").join(known.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_seen")), "user_id", "left")
    a = _packed(spare.select(F.col("user_id").alias("id"), F.lit(0).alias("label"), "vector", F.coalesce("n_seen", F.lit(0)).alias("n_seen")), CHUNK, "a", "n_seen")
    b = _packed(vectors.where("product_id IS NOT NULL AND vector IS NOT NULL").select(F.col("product_id").alias("id"), F.lit(0).alias("label"), "vector"), 4 * CHUNK, "b")
    met = _meetings(a, b)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for a, b in zip(rows["a"], rows["b"]):
                more = {r["id"]: n + r["n_seen"] for r in a}
                xs, ys = _by_length(a), _by_length(b)
                for size in xs.keys() & ys.keys():
                    (ai, x), (bi, y) = xs[size], ys[size]
                    order = np.argsort(-bi)
                    bi, y = bi[order], y[order]
                    scores = np.round(x @ y.T, 9)
                    for user, row in zip(ai, scores):
                        k = min(more[user], len(bi))
                        if k < len(bi):  # the k best, and all that tie with the last of them
                            at = np.flatnonzero(row >= np.partition(row, len(bi) - k)[len(bi) - k])
                        else:
                            at = np.arange(len(bi))
                        at = at[np.argsort(-row[at], kind="stable")[:k]]
                        yield pd.DataFrame({"user_id": np.full(len(at), user), "product_id": bi[at], "score": row[at]})

    def together(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        rows = 0
        for part in nearest(batches):
            held.append(part)
            rows += len(part)
            if rows >= 50_000:
                yield pd.concat(held, ignore_index=True)
                held, rows = [], 0
        if held:
            yield pd.concat(held, ignore_index=True)

    scored = met.mapInPandas(together, "user_id long, product_id long, score double")
    fresh = scored.join(known, ["user_id", "product_id"], "left_anti")
    best = Window.partitionBy("user_id").orderBy(F.desc("score"), F.desc("product_id"))
    return fresh.withColumn("_place", F.row_number().over(best)).where(F.col("_place") <= n).select("user_id", (F.col("_place") - 1).alias("index"), "product_id")
