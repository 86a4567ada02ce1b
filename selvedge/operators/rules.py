"""Declarative rules, compiled to conditions, and labelling with all of them in one pass.

A rule set is {label: [alternative, ...]}; an alternative is {field: pattern or [patterns]},
with an optional EXCLUDE of the same form. A field holds if any of its patterns is found in it,
whatever the case; an alternative holds if all its fields hold and EXCLUDE, if it says
anything, does not; a label holds if any alternative does. Empty patterns are left out. Array
fields are searched as their sorted elements joined by ' && '. A null field does not hold.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Alternative = dict
ARRAYS = frozenset(["product_labels", "product_secondary_labels", "product_external_labels", "product_tags"])


def _patterns(value: str | list[str] | None) -> list[str]:
    return [p for p in ([value] if isinstance(value, str) else value or []) if p]


def _fields(alternative: Alternative, arrays: frozenset[str]) -> Column | None:
    parts = []
    for name, value in alternative.items():
        if name == "EXCLUDE" or not (patterns := _patterns(value)):
            continue
        text = F.concat_ws(" && ", F.array_sort(F.col(name))) if name in arrays else F.col(name)
        parts.append(F.coalesce(reduce(lambda a, b: a | b, [text.rlike(f"(?i){p}") for p in patterns]), F.lit(False)))
    return reduce(lambda a, b: a & b, parts) if parts else None


def condition(alternatives: list[Alternative], arrays: frozenset[str] = ARRAYS) -> Column:
    """Whether any alternative holds: never null."""
    out = []
    for a in alternatives:
        holds, excluded = _fields(a, arrays), _fields(a.get("EXCLUDE") or {}, arrays)
        if holds is None and excluded is None:
            continue
        out.append((holds if holds is not None else F.lit(True)) & (~excluded if excluded is not None else F.lit(True)))
    return reduce(lambda a, b: a | b, out) if out else F.lit(False)


def color_rules(colors: dict[str, str]) -> dict[str, list[Alternative]]:
    """A rule per colour: its pattern in color, or as whole words in product_name."""
    return {label: [{"color": p}, {"product_name": rf"\b{p}\b"}] for label, p in colors.items()}


def labelled(df: DataFrame, rules: dict[str, list[Alternative]], key: str, name: str, arrays: frozenset[str] = ARRAYS) -> DataFrame:
    """key, name: one row per row and label that holds. The table is read once, whatever the number of rules."""
    found = F.array_compact(F.array(*[F.when(condition(alternatives, arrays), F.lit(label)) for label, alternatives in rules.items()])) if rules else F.array().cast("array<string>")
    return df.select(key, F.explode(found).alias(name))


def dropped(df: DataFrame, alternatives: list[Alternative], arrays: frozenset[str] = ARRAYS) -> DataFrame:
    """The rows for which no alternative holds."""
    return df.where(~condition(alternatives, arrays))
