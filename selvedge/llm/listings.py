"""Listings of the same article by different sellers, grouped.

1. Facts. Each listing's brand, colour and measure are read from its columns and text, in one
   spelling and unit. Words that name kinds of articles and materials are learnt from the
   corpus (see `learnt_traits`) and read as facts as well.
2. Rare text. What is left of the words after the facts and the words that many brands share
   (marketing, care, layout) names the model.
3. Blocks. Listings that agree in facts and rare text are one representative. Representatives
   meet in blocks on pieces of their rare tokens (see `pieces`), so that a misspelt letter
   anywhere keeps one block, and other models with like syllables are met as well.
4. Cosine. A pair is confirmed by the cosine of the character trigrams of its rare texts,
   weighted by inverse frequency over all representatives.
5. Veto. Numbers or variants that conflict part a pair; what one side doesn't say conflicts with
   nothing, if just one group fits.
6. Clusters. Confirmed pairs are joined to connected components, members follow their
   representative.
"""

from __future__ import annotations

import html
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from selvedge.functions.components import connected_components
from selvedge.functions.skew import broadcast_if_small, hot_keys, join_spread, spread_for_cpu
from selvedge.llm.canonical import Names, built, folded
from selvedge.session import checkpointed, written

# Units by what they measure, in centimetres, litres and grams a square metre.
UNITS = {
    "length": {"mm": 0.1, "cm": 1.0, "m": 100.0, "in": 2.54, "inch": 2.54, "inches": 2.54, '"': 2.54, "″": 2.54, "ft": 30.48},
    "volume": {"ml": 0.001, "cl": 0.01, "l": 1.0, "ltr": 1.0, "litre": 1.0, "litres": 1.0, "liter": 1.0, "liters": 1.0},
    "weight": {"gsm": 1.0, "g/m²": 1.0, "g/m2": 1.0, "oz/yd²": 33.906, "oz/yd2": 33.906},
}
#: Steps to which measures are rounded, so that a size is the same in any unit.
STEPS = {"length": 0.5, "volume": 0.5, "weight": 5.0}

_UNIT = {u: (what, f) for what, us in UNITS.items() for u, f in us.items()}
_MEASURE = regex.compile(rf"(?<![\w.,])(\d+(?:[.,]\d+)?)\s*({'|'.join(sorted(map(regex.escape, _UNIT), key=len, reverse=True))})(?!\w)", regex.I)
_PIECES = regex.compile(r"\b(?:pack|set) of (\d+)\b|(?<![\w.,])(\d+)\s?(?:-|er)?[ -]?(?:pack|pcs|pieces|pairs)\b|\bx\s?(\d+)\b|(?<![\w.,])(\d+)\s?x\b", regex.I)
_MARKUP = regex.compile(r"<[/!?\p{L}][^<>]*>")
_INSIDE = regex.compile(r"(\p{L}+)([·•\-‐‑­​⁠])(?=\p{L})")
_WORD = regex.compile(r"\p{L}+|\d+")

#: A word that occurs with this many brands, and with this share of all brands, names no model.
MANY_BRANDS, COMMON_SHARE = 3, 0.05
#: Trigrams of Latin letters have a number each; those of other letters share this many more.
LETTERS = "^$abcdefghijklmnopqrstuvwxyz"
GRAM_BUCKETS = len(LETTERS) ** 3 + (1 << 18)
#: Set by a sweep (see README): one swap of letters costs three of some nine trigrams a side.
LEAST_COSINE = 0.25


def measure(text: str) -> str | None:
    """The first size, volume, weight or number of pieces in a text, in one unit; null if there is none."""
    if m := _MEASURE.search(text):
        what, factor = _UNIT[m[2].lower()]
        return f"{what} {round(float(m[1].replace(',', '.')) * factor / STEPS[what]) * STEPS[what]:g}"
    if m := _PIECES.search(text):
        return f"pieces {int(next(g for g in m.groups() if g))}"
    return None


def _joined(m: regex.Match) -> str:
    """A word with the sign inside it replaced: by nothing, but by a blank for a hyphen after a short part, as in T-shirt."""
    return f"{m[1]} " if m[2] in "-‐‑" and len(m[1]) <= 3 else m[1]


FACTS = "brand long, color long, measure string, words array<struct<at: int, word: string>>"
FIELDS = ["brand", "color", "measure"]


class Reader:
    """Facts and candidate words of listings."""

    def __init__(self, brands, colors):
        self.brands, self.colors = (x if isinstance(x, Names) else Names(x) for x in (brands, colors))
        # a single word hints at a brand if the brand's name begins with it: others, such as Leather in a firm's name, may say what the article is
        self.heads = {core[0] for _, core in self.brands.names}

    def read(self, name: str | None, description: str | None, brand: str | None, colors: list[str | None]):
        texts = [_MARKUP.sub(" ", html.unescape(x or "")) for x in (name, description)]
        size = measure(" ¦ ".join(texts))
        words, gaps = [], []
        for t in texts:
            t = _INSIDE.sub(_joined, _MEASURE.sub(" | ", t))
            t = folded(t)
            last = 0
            for m in _WORD.finditer(t):
                gaps.append(not words or bool(t[last : m.start()].strip()) or (last == 0))
                words.append(m[0])
                last = m.end()
        used = [False] * len(words)
        whole = " ".join(words)
        spots = self.brands.mentions(words)
        spots = sorted({*spots, *(h for h in self.brands.hints(words) if whole[h[0] : h[0] + h[1]] in self.heads)})
        starts, at = {}, 0
        for i, w in enumerate(words):
            starts[at] = i
            at += len(w) + 1
        for start, length, _ in spots:
            if (i := starts.get(start)) is not None:
                covered = 0
                while covered < length and i < len(words):
                    used[i] = True
                    covered += len(words[i]) + 1
                    i += 1
        entry = self.brands.entry(brand) or (spots[0][2] if spots and len({e for *_, e in spots}) == 1 else 0)
        free = [w if not u else "" for w, u in zip(words, used)]
        shown = self.colors.mentions(free)
        color = next((e for c in colors if (e := self.colors.entry(c))), 0) or (shown[0][2] if len({e for *_, e in shown}) == 1 else 0)
        out, at = [], 0
        for i, w in enumerate(words):
            at += 1 + gaps[i]  # neighbours within one phrase follow each other without a gap
            if not used[i] and w.isalpha() and not (len(w) > 1 and w in self.colors.exact):
                out.append({"at": at, "word": w})
            elif used[i] or not w.isalpha():
                at += 1
        return entry or None, color or None, size, out


def facts(listings: DataFrame, keep: list[str], brands, colors) -> DataFrame:
    """keep and FACTS of listings (product_name, product_description, product_brand, color, internal_color).

    brands, colors: reference names (see canonical.reference_names). A fact that no column or
    text gives is null; null and empty texts give no word.
    """
    fields = ["product_name", "product_description", "product_brand", "color", "internal_color"]
    rows = spread_for_cpu(listings.select(*keep, *[F.col(f).alias(f"_{f}") for f in fields]))
    kept = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(built(brands), built(colors))
        types = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("at", pa.int32()), ("word", pa.string())]))]
        for b in batches:
            got = [reader.read(n, d, br, [c, i]) for n, d, br, c, i in zip(*[b[kept + i].to_pylist() for i in range(5)])]
            columns = [pa.array([g[i] for g in got], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*b.columns[:kept], *columns], names=[*keep, "brand", "color", "measure", "words"])

    return rows.mapInArrow(run, f"{rows.select(*keep).schema.simpleString()[7:-1]}, {FACTS.replace(' array', ' array').replace('long', 'bigint')}")


def common_words(read: DataFrame) -> DataFrame:
    """word: the words that many brands share.

    A word is common if it occurs with MANY_BRANDS brands or more and with COMMON_SHARE of all
    brands or more: copies of one listing, however many, make no word common, nor does the size
    of the table.
    """
    brands = read.agg(F.countDistinct("brand")).first()[0] or 0
    words = read.where("brand IS NOT NULL").select("brand", F.explode("words.word").alias("word")).distinct()
    return checkpointed(words.groupBy("word").agg(F.count(F.lit(1)).alias("brands")).where(F.col("brands") >= max(MANY_BRANDS, COMMON_SHARE * brands)).select("word"))


#: A trait word is this many times likelier in a listing if another listing of the article has it; two words of one trait likewise.
TRAIT_LIFT = 3.0
#: Two words exclude each other if they occur together in articles in less than this share of the cases that chance gives, and hardly ever in one listing.
OPPOSED, BESIDE = 0.5, 0.1
#: Cases that chance must give at least before their number tells anything.
LEAST_EXPECTED = 8
#: Most trait words: they come to the driver. More are refused.
MAX_TRAITS = 5_000


def _parts(nodes: list[str], links: set[tuple[str, str]]) -> dict[str, str]:
    """The connected part of each of a few words, named by its first word."""
    root = {n: n for n in nodes}

    def find(x: str) -> str:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def learnt_traits(read: DataFrame, models: DataFrame, common: DataFrame) -> list[tuple[str, int, str]]:
    """(word, slot, value) of the words that name what an article is or is made of.

    Listings that share brand, colour, measure and a rare word are, but for such words, of one
    article. In such contexts a trait word comes again and again, while marketing comes by
    chance: its lift tells. Two trait words that follow each other from listing to listing
    name one value (viscose, rayon); two that exclude each other, both between the listings of
    an article and within a listing (cotton, linen), are values of one slot. Whatever excludes each other, directly or through others, is one slot.

    read: _row, FIELDS, words; models: _row, models; common: word. Counts are sums over all
    contexts, so they take one row per context and word; only trait words, of which there are
    few in any language, are paired. Tables in which chance would give fewer than
    LEAST_EXPECTED meetings of two words tell nothing about them.
    """
    full = " AND ".join(f"{f} IS NOT NULL" for f in FIELDS)
    placed = read.where(full).join(models, "_row").select("_row", *FIELDS, F.array_distinct("words.word").alias("_words"), F.explode("models").alias("_m")).select("_row", F.xxhash64(*FIELDS, "_m").alias("context"), "_words")
    sizes = placed.groupBy("context").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    placed = written(placed.join(sizes, "context").select("context", "n", "_words"))  # read for all words, then for trait words
    words = placed.select("context", "n", F.explode("_words").alias("word")).join(broadcast_if_small(common), "word", "left_semi")
    counts = checkpointed(words.groupBy("context", "n", "word").agg(F.count(F.lit(1)).alias("k")))
    whole = placed.count()
    each = counts.groupBy("word").agg(F.sum("k").alias("k"), F.sum(F.col("k") * (F.col("k") - 1)).alias("same"), F.sum(F.col("k") * (F.col("n") - 1)).alias("chances"))
    lift = (F.col("same") / F.col("chances")) / (F.col("k") / F.lit(float(whole or 1)))
    found = each.where((F.col("k") >= LEAST_EXPECTED) & (F.col("chances") > 0)).where(lift >= TRAIT_LIFT).limit(MAX_TRAITS + 1).collect()
    if len(found) > MAX_TRAITS:
        raise ValueError(f"more than {MAX_TRAITS} trait words")
    if not found:
        return []
    traits = counts.sparkSession.createDataFrame([(r.word,) for r in found], "word string")
    mine = counts.join(F.broadcast(traits), "word")
    met = mine.select("context", F.col("word").alias("u"), F.col("k").alias("ku")).join(mine.select("context", F.col("word").alias("v"), F.col("k").alias("kv")), "context").where("u < v")
    apart = met.groupBy("u", "v").agg(F.sum(F.col("ku") * F.col("kv")).alias("met"))
    only = F.lit([r.word for r in found])
    listed = read.select(F.array_sort(F.array_intersect("words.word", only)).alias("w"))
    beside = listed.select(F.explode("w").alias("u"), "w").select("u", F.explode("w").alias("v")).where("u <= v").groupBy("u", "v").agg(F.count(F.lit(1)).alias("beside"))
    together = {(r.u, r.v): r.beside for r in beside.collect()}  # MAX_TRAITS squared at most, as below
    inside = placed.select(F.array_sort(F.array_intersect("_words", only)).alias("w"))
    inside = inside.select(F.explode("w").alias("u"), "w").select("u", F.explode("w").alias("v")).where("u < v").groupBy("u", "v").agg(F.count(F.lit(1)).alias("inside"))
    pairs = {(r.u, r.v): r.met - (r.inside or 0) for r in apart.join(inside, ["u", "v"], "left").collect()}
    rows = read.count() or 1
    chances, share = {r.word: r.chances for r in found}, {r.word: r.k / whole for r in found}
    names, alike, opposed = sorted(chances), set(), set()
    for i, u in enumerate(names):
        for v in names[i + 1 :]:
            expected = (chances[u] * share[v], chances[v] * share[u])
            if min(expected) < LEAST_EXPECTED:
                continue
            lifts = [pairs.get((u, v), 0) / e for e in expected]
            by_chance = together[u, u] * together[v, v] / rows
            if min(lifts) >= TRAIT_LIFT:
                alike.add((u, v))
            elif max(lifts) <= OPPOSED and by_chance >= LEAST_EXPECTED and together.get((u, v), 0) <= BESIDE * by_chance:
                opposed.add((u, v))
    value = _parts(names, alike)
    between = {tuple(sorted((value[u], value[v]))) for u, v in opposed if value[u] != value[v]}
    slot = _parts(sorted({x for pair in between for x in pair}), between)
    order = {s: i for i, s in enumerate(sorted(set(slot.values())))}
    return [(w, order[slot[value[w]]], value[w]) for w in names if value[w] in slot]


def with_traits(read: DataFrame, traits: list[tuple[str, int, str]]) -> tuple[DataFrame, list[str]]:
    """read with a column per slot (its value that stands first in the listing, null if none), and the names of those columns."""
    slots = sorted({s for _, s, _ in traits})
    if not slots:
        return read, []
    known = read.sparkSession.createDataFrame(traits, "word string, slot int, value string")
    words = read.select("_row", F.explode("words").alias("_w")).select("_row", "_w.at", "_w.word").join(F.broadcast(known), "word")
    names = [f"trait{s}" for s in slots]
    values = words.groupBy("_row").agg(*[F.min_by("value", F.when(F.col("slot") == s, F.col("at"))).alias(n) for s, n in zip(slots, names)])
    return read.join(values, "_row", "left"), names


def rare_texts(read: DataFrame, common: DataFrame) -> DataFrame:
    """_row and models: the rare words of each listing, neighbours written together, distinct and sorted; rows without any are left out."""
    words = read.select("_row", F.explode("words").alias("_w")).select("_row", F.col("_w.at").alias("at"), F.col("_w.word").alias("word"))
    rare = words.join(broadcast_if_small(common), "word", "left_anti").groupBy("_row").agg(F.array_sort(F.collect_set(F.struct("at", "word"))).alias("_rare"))
    start = F.struct(F.lit(-9).alias("at"), F.array().cast("array<string>").alias("runs"))

    def step(acc: Column, x: Column) -> Column:
        glued = F.concat(F.slice(acc["runs"], F.lit(1), F.size(acc["runs"]) - 1), F.array(F.concat(F.element_at(acc["runs"], -1), x["word"])))
        return F.struct(x["at"].alias("at"), F.when((x["at"] == acc["at"] + 1) & (F.size(acc["runs"]) > 0), glued).otherwise(F.concat(acc["runs"], F.array(x["word"]))).alias("runs"))

    runs = F.aggregate("_rare", start, step, lambda acc: acc["runs"])
    return rare.select("_row", F.array_sort(F.array_distinct(runs)).alias("models")).where(F.size("models") > 0)


def pieces(token: Column) -> Column:
    """What a rare token is met by: its first three letters, its last three, and its first two with its last two.

    One misspelt, missing, added or swapped letter leaves at least one of them as it is, in
    tokens of six letters or more; shorter ones are met with each letter left out once as well.
    """
    n = F.length(token)
    ends = F.array(F.concat(F.lit("<"), F.substring(token, 1, 3)), F.concat(F.lit(">"), F.substring(token, n - 2, F.lit(3))), F.concat(F.lit("="), F.substring(token, 1, 2), F.substring(token, n - 1, F.lit(2))))
    less = F.array_union(F.array(token), F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.substring(token, F.lit(1), i - 1), F.substring(token, i + 1, n))))
    return F.array_distinct(F.when(n >= 6, ends).when(n <= 2, F.array(token)).otherwise(F.array_union(ends, less)))


_NUMBER = {c: i for i, c in enumerate(LETTERS)}


def _grams(text: str) -> list[int]:
    """Numbers of the trigrams of a text: one each for Latin letters, a hash for others."""
    t, n = f"^{text}$", len(LETTERS)
    try:
        x = [_NUMBER[c] for c in t]
        return [(x[i] * n + x[i + 1]) * n + x[i + 2] for i in range(len(x) - 2)]
    except KeyError:
        return [n**3 + zlib.crc32(t[i : i + 3].encode()) % (GRAM_BUCKETS - n**3) for i in range(len(t) - 2)]


def _cosine(idf: np.ndarray):
    def vector(text: str) -> dict[int, float]:
        v: dict[int, float] = {}
        for g in _grams(text):
            v[g] = v.get(g, 0.0) + float(idf[g])
        n = sum(x * x for x in v.values()) ** 0.5 or 1.0
        return {g: x / n for g, x in v.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            memo: dict[str, dict[int, float]] = {}
            out = []
            for xs, ys in zip(b["models_a"].to_pylist(), b["models_b"].to_pylist()):
                best = 0.0
                for x in xs:
                    u = memo.get(x) or memo.setdefault(x, vector(x))
                    for y in ys:
                        if x == y:
                            best = 1.0
                            break
                        w = memo.get(y) or memo.setdefault(y, vector(y))
                        best = max(best, sum(p * w[g] for g, p in u.items() if g in w))
                out.append(best)
            yield pa.RecordBatch.from_arrays([b["a"], b["b"], pa.array(out, pa.float64())], names=["a", "b", "cosine"])

    return run


def gram_weights(models: DataFrame) -> np.ndarray:
    """Inverse frequency of trigrams over all representatives: GRAM_BUCKETS numbers, whatever the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(GRAM_BUCKETS, np.int64)
        for b in batches:
            for models in b["models"].to_pylist():
                sums[list({g for m in models for g in _grams(m)})] += 1
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(sums[at], pa.int64())], names=["bucket", "n"])

    rows = models.select("models").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    n = models.count()
    idf = np.full(GRAM_BUCKETS, np.log1p(n))
    for bucket, k in rows:
        idf[bucket] = np.log1p(n / k)
    return idf


def _representatives(member: DataFrame, text: Column, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """(member with rep, one row per rep): listings with the same text share a number.

    A second hash tells texts apart that share the first by chance; then others are tried.
    """
    for seed in range(16):
        marked = checkpointed(member.withColumn("rep", F.xxhash64(F.lit(seed), text)).withColumn("_other", F.hash(text)))
        reps = checkpointed(marked.groupBy("rep").agg(*[F.first(c).alias(c) for c in (*fields, "models")], F.min("_other").alias("_least"), F.max("_other").alias("_most")))
        if not reps.where("_least != _most").limit(1).count():
            return marked.drop("_other"), reps.drop("_least", "_most")
    raise RuntimeError("no hash tells the representatives apart")


def groups(listings: DataFrame, key: str, brands, colors, keep: list[str] | None = None, least: float = LEAST_COSINE) -> DataFrame:
    """key, keep and component: the group of each listing; listings of one article share it.

    A fact that one listing lacks conflicts with nothing only if just one group fits: such a
    listing joins the single group of its model whose known facts it doesn't contradict, else
    it stays with those that know as little. A listing without any rare word names no model and
    is a group of its own; listings of a null key are one group. Repeated rows share their group. Blocks that
    hold more than a two-hundredth of all tokens are spread.
    """
    keep = keep or []
    read = checkpointed(facts(listings, [key, *keep], brands, colors).withColumn("_row", F.monotonically_increasing_id()))
    common = common_words(read)
    models = checkpointed(rare_texts(read, common))
    read, traits = with_traits(read, learnt_traits(read, models, common))
    fields = [*FIELDS, *traits]
    known = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    whole = F.concat_ws("\u0001", *known, F.concat_ws("\u0002", "models"))
    text = F.when(F.size("models") > 0, whole).otherwise(F.concat(F.lit("\u0003"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    member, reps = _representatives(read.select("_row", key, *keep, *fields).join(models, "_row", "left").drop("_row"), text, fields)
    unknown = [F.when(F.col(f).isNull(), F.lit(1 << i)).otherwise(0) for i, f in enumerate(fields)]
    named = reps.where(F.size("models") > 0).withColumn("mask", reduce(lambda x, y: x + y, unknown))
    tokens = checkpointed(named.select("rep", "mask", *fields, F.explode("models").alias("_m")).select("rep", "mask", *fields, F.explode(pieces(F.col("_m"))).alias("piece")).distinct())

    def block(mask: Column) -> Column:
        """A piece with those facts that are no part of the mask, as one number; what collides is told apart by the veto."""
        return F.xxhash64("piece", mask, *[F.when(mask.bitwiseAND(1 << i) == 0, F.coalesce(F.col(f).cast("string"), F.lit(""))).otherwise("") for i, f in enumerate(fields)])

    side = lambda x: named.select(F.col("rep").alias(x), F.col("models").alias(f"models_{x}"), F.struct(*fields).alias(f"facts_{x}"))
    weights = gram_weights(named)

    def confirmed(pairs: DataFrame, veto: Column) -> DataFrame:
        met = pairs.join(side("a"), "a").join(side("b"), "b").where(~veto)
        return met.select("a", "b", "models_a", "models_b").mapInArrow(_cosine(weights), "a long, b long, cosine double").where(F.col("cosine") >= least).select("a", "b")

    blocked = tokens.select(block(F.lit(0)).alias("block"), "rep")
    pairs = join_spread(blocked.withColumnRenamed("rep", "a"), blocked.withColumnRenamed("rep", "b"), ["block"]).where("a < b").select("a", "b").distinct()
    edges = checkpointed(confirmed(pairs, ~F.col("facts_a").eqNullSafe(F.col("facts_b"))))
    found = connected_components(edges, "a", "b")
    component = reps.select(F.col("rep").alias("node")).join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))

    # a listing that lacks facts meets those that have all of them in blocks of the facts it has
    masks = [r[0] for r in tokens.where("mask != 0").select("mask").distinct().collect()]  # fewer than 2 ** len(fields)
    parts = tokens.where("mask != 0").select(block(F.col("mask")).alias("block"), F.col("rep").alias("a"))
    wholes = tokens.where("mask = 0").drop("mask").withColumn("mask", F.explode(F.array(*[F.lit(m) for m in masks]).cast("array<int>"))).select(block(F.col("mask")).alias("block"), F.col("rep").alias("b"))
    loose = join_spread(parts, wholes, ["block"]).select("a", "b").distinct()
    conflict = reduce(lambda x, y: x | y, [F.coalesce(F.col(f"facts_a.{f}") != F.col(f"facts_b.{f}"), F.lit(False)) for f in fields])
    fits = confirmed(loose, conflict).join(component.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("_to"), F.max("component").alias("_other")).where("_to = _other").select("node", "_to")
    final = component.join(fits, "node", "left").select(F.col("node").alias("rep"), F.coalesce("_to", "component").alias("component"))
    return member.select(key, *keep, "rep").join(final, "rep").select(key, *keep, "component")


def pairs_between(grouped: DataFrame, key: str, seller: str, salts: int = 32) -> DataFrame:
    """{key}_a, {key}_b: pairs of one group and different sellers, the smaller key first.

    Every pair is asked for, so a group of n listings gives up to n² / 2 rows; groups that hold
    more than a two-hundredth of all listings are spread over `salts` tasks.
    """
    rows = grouped.where(F.col(seller).isNotNull()).select("component", F.col(key).alias("_key"), F.col(seller).alias("_seller")).distinct()
    hot = [r[0] for r in hot_keys(rows, ["component"])]  # fewer than 200
    is_hot = F.col("component").isin(hot) if hot else F.lit(False)
    left = rows.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64("_key"), F.lit(salts))).otherwise(0).cast("int"))
    right = rows.withColumn("_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    met = left.select("component", "_salt", F.col("_key").alias(f"{key}_a"), F.col("_seller").alias("_sa")).join(right.select("component", "_salt", F.col("_key").alias(f"{key}_b"), F.col("_seller").alias("_sb")), ["component", "_salt"])
    return met.where((F.col(f"{key}_a") < F.col(f"{key}_b")) & (F.col("_sa") != F.col("_sb"))).select(f"{key}_a", f"{key}_b").distinct()
