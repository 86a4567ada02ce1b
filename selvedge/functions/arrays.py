"""Array, vector and string columns made of built-in functions, so they stay in generated code."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def strings(*values: str) -> Column:
    """An array of string literals; typed when empty."""
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def dot(a: Column, b: Column) -> Column:
    """The dot product in doubles; null for null vectors, null elements or unequal lengths."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def scaled(a: Column, factor: Column) -> Column:
    return F.transform(a, lambda x: x.cast("double") * factor)


def norm(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"), lambda acc: F.sqrt(acc))


def l2_normalized(a: Column, floor: float = 0.0) -> Column:
    """a divided by its length plus floor; null for a zero vector without floor."""
    n = norm(a) + F.lit(floor)
    return F.when(n > 0, F.transform(a, lambda x: x.cast("double") / n))


def mean_vectors(df: DataFrame, keys: Sequence[str], vector: str, dimensions: int, name: str = "vector") -> DataFrame:
    """keys and the mean of each element over the group, for vectors of a known length.

    One aggregation with an average per element: partial sums go through the shuffle, not the
    vectors. Shorter vectors count with nulls, which an average leaves out.
    """
    means = [F.avg(F.get(vector, i).cast("double")).alias(f"_{i}") for i in range(dimensions)]
    return df.groupBy(*keys).agg(*means).select(*keys, F.array(*[F.col(f"_{i}") for i in range(dimensions)]).alias(name))


def positional_matches(a: Column, b: Column) -> Column:
    """At how many positions two arrays have the same non-null value."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)).cast("int")), F.lit(0), lambda acc, x: acc + x)


def largest(a: Column, n: int) -> Column:
    """The n largest elements, largest first. Nulls come last."""
    return F.slice(F.reverse(F.array_sort(F.filter(a, lambda x: x.isNotNull()))), 1, n)


def without(a: Column, words: Column) -> Column:
    """a without any element of the array words; all of a for null words."""
    return F.filter(a, lambda x: ~F.coalesce(F.array_contains(words, x), F.lit(False)))


def word_list(text: Column) -> Column:
    """Lower-case words; everything that is neither letter, digit, underscore nor blank parts words."""
    return F.array_remove(F.split(F.regexp_replace(F.lower(text), r"[^\w\s]|\s", " "), " "), "")


def sorted_words(words: Column) -> Column:
    """The words in order as one text: equal for permutations."""
    return F.trim(F.array_join(F.array_sort(words), " "))


def without_last_word(text: Column) -> Column:
    return F.when(F.instr(text, " ") > 0, F.regexp_replace(text, " [^ ]*$", "")).otherwise(F.lit(""))


def quoted(text: Column) -> Column:
    """text as a literal part of a pattern."""
    return F.regexp_replace(text, r"([\\\[\]{}()*+?.^$|\-])", r"\\$1")


#: A pattern that is found nowhere.
NEVER = r"[^\s\S]"


def stripped(text: Column, steps: Sequence[Column | str | tuple[Column, str]]) -> Column:
    """text after each pattern was deleted (or replaced, for pairs) in turn, trimmed every time; a null pattern changes nothing.

    Each step names its input once, so the expression grows with the number of steps only.
    """
    for step in steps:
        pattern, by = step if isinstance(step, tuple) else (step, "")
        pattern = F.lit(pattern) if isinstance(pattern, str) else F.coalesce(pattern, F.lit(NEVER))
        text = F.trim(F.regexp_replace(text, pattern, F.lit(by)))
    return text


def surrogate_key(*columns: Column) -> Column:
    """abs(xxhash64(...)): nulls are skipped by the hash; the one value without absolute is 0."""
    h = F.xxhash64(*columns)
    return F.when(h == F.lit(-(2**63)), F.lit(0)).otherwise(F.abs(h))


def display_text(*parts: Column) -> Column:
    """Parts joined by one blank, without empty ones."""
    return F.trim(F.regexp_replace(F.concat_ws(" ", *parts), " +", " "))


def escaped(text: str) -> str:
    return re.escape(text)
