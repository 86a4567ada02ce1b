"""Mixing sources to target weights, by Pareto order sampling on sizes in tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from selvedge.session import checkpointed

#: Most sources that a target may name.
MAX_SOURCES = 10_000
#: Bins of the sampling rank per source, and finer bins within the one that the cut falls into; within those the cut is exact.
RANK_BINS = 4096
#: Different weights per doubling: weights are told apart to about one part in a hundred.
STEPS = 64


def _uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the key and the seed only, so a repeated task draws the same."""
    return (F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(2**52)).cast("double") + 0.5) / float(2**52)


def _rounded(weight: Column) -> Column:
    """The nearest of STEPS weights per doubling, so that a source has few different ones however many documents."""
    return F.pow(F.lit(2.0), F.round(F.log2(weight) * STEPS) / STEPS)


def expectation_scales(masses: DataFrame, plan: DataFrame) -> DataFrame:
    """source, _scale: the factor by which a source's weights become expected copies that fill its part.

    masses: source, _w, _mass (the size of all documents of that weight); plan: source, max_repeats, _part. An expectation is min(max_repeats,
    scale * weight); what documents at max_repeats cannot take goes to the others. Weights are
    clipped from the greatest down until the next one needs no clipping, which a window over
    the different weights of a source finds. The scale is null where even all documents at
    max_repeats don't fill more than the part.
    """
    masses = masses.join(F.broadcast(plan.select("source", "max_repeats", "_part")), "source")
    down = Window.partitionBy("source").orderBy(F.desc("_w"))
    clipped = F.coalesce(F.sum("_mass").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weighted = F.sum(F.col("_mass") * F.col("_w")).over(down.rowsBetween(0, Window.unboundedFollowing))
    tried = masses.withColumn("_scale", F.try_divide(F.col("_part") - F.col("max_repeats") * clipped, weighted))
    fits = tried.where(F.col("_scale") * F.col("_w") <= F.col("max_repeats") * (1 + 1e-12))
    return fits.groupBy("source").agg(F.max_by("_scale", "_w").alias("_scale"))


def _first_over(bins: DataFrame, rest: DataFrame, cut: str, left: str) -> DataFrame:
    """Per source the first bin through which the sizes exceed the rest, and what of the rest is left before it."""
    through = F.sum("_in_bin").over(Window.partitionBy("source").orderBy("_bin"))
    over = bins.withColumn("_through", through).join(rest, "source").where("_through > _rest")
    return over.groupBy("source").agg(F.min("_bin").alias(cut), F.min_by(F.col("_rest") - (F.col("_through") - F.col("_in_bin")), "_bin").alias(left))


def copies(docs: DataFrame, target: DataFrame, key: str, source: str, size: str, total: float | None = None, seed: int = 7, weight: Column | None = None) -> DataFrame:
    """key, source, size, copies: how often each document is used (rows with no copy are left out).

    docs: one row per document with its size; target: source, target_share, max_repeats. total
    is the size of the whole mix; without it, the largest that every source can fill within its
    max_repeats. A source that cannot fill its part within max_repeats gives all it has.

    A document's expected copies are in proportion to its weight (1 by default; rounded to
    STEPS per doubling), at most max_repeats, and such that they fill the source's part (see
    expectation_scales). Its whole part are certain copies. The fraction p is drawn by Pareto
    order sampling: documents are ranked by (u / (1 - u)) / (p / (1 - p)) with a random u, and
    the first are taken, as many as fill the rest of the part: the last one is taken if that
    brings the sum nearer. So a source misses its part by at most half a document.

    Ranks are summed per source and bin of rank before a cut is looked for, then within the bin
    of the cut by finer bins, and only documents of the one finer bin are ordered: about one in
    RANK_BINS squared. Documents of size 0 (null and empty texts) or without positive weight,
    without source or of a source that target doesn't name are never used. Expects unique keys.
    """
    if target.limit(MAX_SOURCES + 1).count() > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    goal = target.where(F.col("source").isNotNull() & (F.col("target_share") > 0)).groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").cast("double").alias("max_repeats"))
    w = (weight if weight is not None else F.lit(1.0)).cast("double")
    sized = docs.select(F.col(key).alias("_key"), F.col(source).alias("source"), F.col(size).cast("double").alias("_size"), w.alias("_w")).where("source IS NOT NULL AND _size > 0 AND _w > 0 AND NOT isnan(_w)").withColumn("_w", _rounded(F.col("_w")))
    masses = checkpointed(sized.groupBy("source", "_w").agg(F.sum("_size").alias("_mass")))  # a few hundred rows a source
    have = masses.groupBy("source").agg(F.sum("_mass").alias("_have"))
    plan = goal.join(have, "source", "left").withColumn("_cap", F.coalesce(F.col("_have"), F.lit(0.0)) * F.col("max_repeats"))
    whole = F.lit(float(total)) if total is not None else F.min(F.when(F.col("_cap") > 0, F.col("_cap") / F.col("target_share"))).over(Window.partitionBy())
    plan = plan.withColumn("_part", F.least("_cap", F.col("target_share") * whole)).select("source", "max_repeats", "_part")
    plan = checkpointed(plan.join(expectation_scales(masses, plan), "source", "left"))  # a row per source, used four times

    expect = F.coalesce(F.least(F.col("max_repeats"), F.col("_scale") * F.col("_w")), F.col("max_repeats"))
    drawn = sized.join(F.broadcast(plan), "source").withColumn("_expect", expect).withColumn("_sure", F.floor(F.col("_expect") + 1e-9)).withColumn("_p", F.greatest(F.lit(0.0), F.col("_expect") - F.col("_sure")))
    u = _uniform(F.col("_key"), seed)
    odds = (u / (1 - u)) / (F.col("_p") / (1 - F.col("_p")))
    # odds lie in (0, inf); odds / (1 + odds) orders them alike within (0, 1)
    drawn = drawn.withColumn("_rank", F.when(F.col("_p") > 1e-9, odds / (1 + odds))).withColumn("_bin", F.floor(F.col("_rank") * RANK_BINS))

    binned = drawn.groupBy("source", "_bin").agg(F.sum(F.col("_sure") * F.col("_size")).alias("_certain"), F.sum("_size").alias("_in_bin"))
    sure = binned.groupBy("source").agg(F.sum("_certain").alias("_certain"))
    rest = plan.join(sure, "source").withColumn("_rest", F.col("_part") - F.col("_certain")).select("source", "_rest")
    cut = checkpointed(_first_over(binned.where("_bin IS NOT NULL").drop("_certain"), rest, "_cut", "_rest_of_bin"))
    marked = drawn.join(F.broadcast(cut), "source", "left")
    finer = F.floor((F.col("_rank") * RANK_BINS - F.col("_bin")) * RANK_BINS)
    inside = marked.where("_bin = _cut").withColumn("_fine", finer)
    fine = inside.groupBy("source", F.col("_fine").alias("_bin")).agg(F.sum("_size").alias("_in_bin"))
    fine_cut = _first_over(fine, cut.select("source", F.col("_rest_of_bin").alias("_rest")), "_fine_cut", "_left")
    placed = marked.withColumn("_fine", F.when(F.col("_bin") == F.col("_cut"), finer)).join(F.broadcast(fine_cut), "source", "left")

    no, yes = F.lit(0), F.lit(1)
    here = F.coalesce(F.col("_fine") == F.col("_fine_cut"), F.lit(False))
    sides = F.when(F.col("_bin").isNull(), no).when(F.col("_cut").isNull() | (F.col("_bin") < F.col("_cut")), yes).when(F.col("_bin") > F.col("_cut"), no)
    sides = sides.when(F.col("_fine_cut").isNull() | (F.col("_fine") < F.col("_fine_cut")), yes).otherwise(no)
    order = Window.partitionBy("source").orderBy("_rank", "_key")
    at = placed.where(here).withColumn("_sum", F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    at = at.withColumn("_taken", F.when(F.col("_sum") - F.col("_size") / 2 <= F.col("_left"), yes).otherwise(no))
    kept = ["_key", "source", "_size", "_sure", "_taken"]
    used = placed.where(~here).withColumn("_taken", sides).select(*kept).unionByName(at.select(*kept)).withColumn("copies", (F.col("_sure") + F.col("_taken")).cast("int")).where("copies > 0")
    return used.select(F.col("_key").alias(key), "source", F.col("_size").cast("long").alias(size), "copies")


def shares(used: DataFrame, target: DataFrame, size: str) -> DataFrame:
    """source, target_share, actual_share, n_documents, n_copies, size, most_repeats: what a mix came to.

    A source of the target that has no document has share 0; the shares of an empty mix are 0.
    """
    got = used.groupBy("source").agg(F.count(F.lit(1)).alias("n_documents"), F.sum("copies").alias("n_copies"), F.sum(F.col(size) * F.col("copies")).alias("_size"), F.max("copies").alias("most_repeats"))
    joined = target.select("source", "target_share").join(got, "source", "left").na.fill(0, ["n_documents", "n_copies", "_size", "most_repeats"])
    whole = F.sum("_size").over(Window.partitionBy())
    share = F.when(whole > 0, F.col("_size") / whole).otherwise(F.lit(0.0))
    return joined.select("source", "target_share", share.alias("actual_share"), "n_documents", "n_copies", F.col("_size").alias(size), "most_repeats")


def sized_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, source, n_tokens and weight, counted once and kept: the plan above reads them often.

    The weight is the number of code points per token: text that the tokenizer knows well takes
    few tokens, broken encodings and markup take many.
    """
    from selvedge.llm.encoding import count_tokens

    counted = count_tokens(docs.select("doc_id", "source", "text", F.length("text").alias("_length")), "text", ["doc_id", "source", "_length"], path)
    return checkpointed(counted.select("doc_id", "source", "n_tokens", F.try_divide("_length", "n_tokens").alias("weight")))
