"""Free-entered values mapped to the entries of a reference list.

Values and names are brought to one spelling first: HTML entities, text that was decoded twice,
full-width and look-alike letters, invisible characters, case, accents and punctuation. An
automaton over all canonical names and aliases then finds the names a value mentions, as whole
words; of overlapping mentions the longest wins. Values without mention go to token-set
similarity, where tokens may be misspelt, the tokens that few entries have weigh most, and the
best entry must be clearly better than the next. What is left means no entry.
"""

from __future__ import annotations

import hashlib
import html
import math
import unicodedata
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from selvedge.functions.skew import spread_for_cpu

#: Most names and aliases a reference list may have: every Python worker holds one copy, measured at 0.65 GB for this many names of two words.
MAX_NAMES = 200_000
#: Letters of a word that its deletions are made of; what follows them is compared in full.
PREFIX = 7
#: Distinct values a task remembers.
CACHE = 200_000

# Letters of other scripts that look like a Latin letter.
LOOKALIKES = str.maketrans("АВЕКМНОРСТХІЈЅаеорсухіјѕԁһΑΒΕΖΗΙΚΜΝΟΡΤΥΧοα", "ABEKMHOPCTXIJSaeopcyxijsdhABEZHIKMNOPTYXoa")
# Words that join or name a company and tell brands apart no better than punctuation.
FILLERS = frozenset("and the by of und y et inc ltd llc gmbh sl sa ag official store shop brand col color colour internal www http https com example".split())

WORDS = regex.compile(r"[^\W\d_]+|\d+")
CAMEL = regex.compile(r"(?<=\p{Ll})(?=\p{Lu}\p{Ll})")


_TWICE = regex.compile(r"[ÂÃâ][\u0080-¿€‚ƒ„…†‡ˆ‰Š‹Œ‘’“”•–—˜™š›œžŸ]")
_LATIN = regex.compile(r"\p{Latin}")


def repaired(s: str) -> str:
    """Undoes one decoding of UTF-8 as Latin-1 or Windows-1252, where that is what happened."""
    if not s.isascii() and _TWICE.search(s):
        for codec in ("cp1252", "latin-1"):
            try:
                return s.encode(codec).decode("utf-8")
            except UnicodeError:
                pass
    return s


def folded(s: str) -> str:
    """One spelling of letters: no entities, invisible characters, accents, case or look-alikes."""
    s = html.unescape(s)
    if s.isascii():  # nothing of what follows changes it but case, and the Latin letters' look-alikes are none
        return s.casefold()
    s = unicodedata.normalize("NFKC", repaired(s))
    s = "".join(c for c in s if unicodedata.category(c) != "Cf")
    if _LATIN.search(s):
        s = s.translate(LOOKALIKES)
    s = unicodedata.normalize("NFD", s.casefold())
    return unicodedata.normalize("NFC", "".join(c for c in s if unicodedata.category(c) != "Mn"))


def words(s: str) -> list[str]:
    return WORDS.findall(folded(s))


def distance(a: str, b: str, most: int) -> int:
    """Edits, among them swaps of neighbours (also of letters that become so), that turn a into b; most + 1 if there are more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    if a == b:
        return 0
    far, seen = len(a) + len(b), {}
    d = [[far] * (len(b) + 2) for _ in range(len(a) + 2)]
    d[1] = [far, *range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        d[i + 1][1], at = i, 0
        for j, y in enumerate(b, 1):
            swap = d[seen.get(y, 0)][at] + (i - seen.get(y, 0) - 1) + 1 + (j - at - 1)
            d[i + 1][j + 1] = min(d[i][j] + (x != y), d[i + 1][j] + 1, d[i][j + 1] + 1, swap)
            if x == y:
                at = j
        seen[x] = i
    return min(d[-1][-1], most + 1)


def allowed(n: int) -> int:
    """Edits that a word of n letters may have and still be itself."""
    return 0 if n < 4 else 1 if n < 7 else 2


def deletions(s: str, most: int) -> set[str]:
    """s with up to `most` letters left out. Words within that many edits share one of these."""
    found = new = {s}
    for _ in range(most):
        new = {x[:i] + x[i + 1 :] for x in new for i in range(len(x))}
        found = found | new
    return found


class Near:
    """The words of a list that lie within `allowed` edits of a given one.

    Two words within d edits have a common subsequence that both become by leaving out at most
    d letters; the beginnings of the two words then share a string of that kind as well, so it
    is enough to look up the deletions of the first PREFIX letters. They are held as two sorted
    arrays (hash of the string, number of the word), 12 bytes a string. Every word found is
    compared in full.
    """

    def __init__(self, found: Iterable[str]):
        self.words = list(found)
        self.longest = max(map(len, self.words), default=0) + 2
        keys, ids = array("q"), array("i")
        for i, w in enumerate(self.words):
            for x in deletions(w[:PREFIX], allowed(len(w))):
                keys.append(hash(x))
                ids.append(i)
        k = np.frombuffer(keys, np.int64) if keys else np.zeros(0, np.int64)
        order = np.argsort(k, kind="stable")
        self.keys, self.ids = k[order], (np.frombuffer(ids, np.int32) if ids else np.zeros(0, np.int32))[order]

    def __call__(self, word: str) -> Iterator[tuple[str, float]]:
        """(word of the list, similarity)."""
        if not self.words or len(word) > self.longest:
            return
        wanted = np.array([hash(x) for x in deletions(word[:PREFIX], min(2, allowed(len(word) + 1)))], np.int64)
        low, high = np.searchsorted(self.keys, wanted, "left"), np.searchsorted(self.keys, wanted, "right")
        seen = {int(i) for a, b in zip(low, high) if b > a for i in self.ids[a:b]}
        for i in seen:
            t = self.words[i]
            most = min(allowed(len(t)), allowed(len(word) + 1))
            d = distance(word, t, most)
            if d <= most:
                yield t, 1 - d / max(len(t), len(word))


class Names:
    """A reference list: entries with their names and aliases."""

    def __init__(self, entries: Iterable[tuple[int, Iterable[str]]], least: float = 0.55, margin: float = 0.1):
        import ahocorasick

        self.least, self.margin = least, margin
        self.exact: dict[str, int] = {}
        self.compact: dict[str, int] = {}
        self.names: list[tuple[int, tuple[str, ...]]] = []
        holders: dict[str, list[int]] = defaultdict(list)
        for entry, names in sorted(entries, key=lambda x: x[0]):
            for name in names:
                tokens = words(name or "")
                if tokens and " ".join(tokens) not in self.exact:
                    self.exact[" ".join(tokens)] = entry
                    core = tuple(t for t in tokens if t not in FILLERS) or tuple(tokens)
                    self.compact.setdefault("".join(core), entry)
                    self.names.append((entry, core))
                    for t in core:
                        if entry not in holders[t][-1:]:  # entries come in order, so a repeat is the last one
                            holders[t].append(entry)
        self.holders = dict(holders)
        n = len({e for e, _ in self.names}) or 1
        self.weight = {t: math.log(1 + n / len(h)) ** 2 for t, h in holders.items()}
        self.unknown = math.log(1 + n) ** 2
        self.automaton = ahocorasick.Automaton()
        for name, entry in self.exact.items():
            self.automaton.add_word(f" {name} ", (len(name), entry))
        for name, entry in self.exact.items():  # the plural of a single word mentions it as well
            if " " not in name and f"{name}s" not in self.exact:
                self.automaton.add_word(f" {name}s ", (len(name), entry))
        if self.names:
            self.automaton.make_automaton()
        self.near_token, self.near_compact = Near(holders), Near(self.compact)
        self.having: dict[str, list[int]] = defaultdict(list)
        for i, (_, core) in enumerate(self.names):
            for t in core:
                self.having[t].append(i)

    def mentions(self, tokens: list[str]) -> list[tuple[int, int, int]]:
        """(start, length, entry) of the longest names that don't overlap, in the tokens joined by blanks."""
        if not self.names:
            return []
        text = f" {' '.join(tokens)} "
        found = sorted(((end - size - 1, size, entry) for end, (size, entry) in self.automaton.iter(text)), key=lambda x: (-x[1], x[0]))
        taken, covered = [], bytearray(len(text) + 2)
        for start, size, entry in found:
            if not any(covered[start : start + size]):
                covered[start : start + size] = b"\1" * size
                taken.append((start, size, entry))
        return sorted(taken)

    def hints(self, tokens: list[str]) -> list[tuple[int, int, int]]:
        """mentions, and outside them the single words that only one entry's names have."""
        out, at = self.mentions(tokens), 0
        taken = {x for a, n, _ in out for x in range(a, a + n)}
        for t in tokens:
            if len(t) > 3 and len(self.holders.get(t, ())) == 1 and at not in taken:
                out.append((at, len(t), next(iter(self.holders[t]))))
            at += len(t) + 1
        return sorted(out)

    def entry(self, value: str | None) -> int:
        """The entry that the value means, 0 for none. Null and blank values mean none."""
        if not value or not (raw := folded(value)).strip():
            return 0
        tokens = WORDS.findall(raw)
        if (whole := " ".join(tokens)) in self.exact:
            return self.exact[whole]
        if found := {e for _, _, e in self.mentions(tokens)}:
            return found.pop() if len(found) == 1 else 0
        if CAMEL.search(value) and (found := {e for _, _, e in self.mentions(words(CAMEL.sub(" ", value)))}):
            if len(found) == 1:
                return found.pop()
        core = [t for t in dict.fromkeys(tokens) if t not in FILLERS and not t.isdigit()]
        return self._similar(core)

    def _similar(self, core: list[str]) -> int:
        joined = "".join(core)
        if not joined:
            return 0
        if joined in self.compact:
            return self.compact[joined]
        scores: dict[int, float] = defaultdict(float)
        for name, sim in self.near_compact(joined):
            scores[self.compact[name]] = max(scores[self.compact[name]], sim)
        near = {t: ({t: 1.0} if t in self.weight else dict(self.near_token(t))) for t in core}
        touched = {i for t in core for hit in near[t] for i in self.having[hit]}
        for i in touched:
            entry, name = self.names[i]
            matched = whole = 0.0
            worst, own = 1.0, False
            left = set(core)
            for t in name:
                sim, best = max(((near[v].get(t, 0.0), v) for v in left), default=(0.0, ""))
                if sim:
                    left.discard(best)
                    worst, own = min(worst, sim), own or len(self.holders[t]) == 1
                matched += self.weight[t] * sim
                whole += self.weight[t]
            whole += sum(self.weight.get(v, self.unknown if len(v) > 3 else 0.3) for v in left)
            if own and not left:  # a part of the name, nothing else, and no other entry has it
                scores[entry] = max(scores[entry], 0.9 * worst)
            scores[entry] = max(scores[entry], matched / whole)
        ranked = sorted(((s, -e) for e, s in scores.items()), reverse=True)
        if not ranked or ranked[0][0] < self.least or (len(ranked) > 1 and ranked[0][0] - ranked[1][0] < self.margin):
            return 0
        return -ranked[0][1]


def reference_names(reference: DataFrame, key: str, name: str, aliases: str | None = None) -> list[tuple[int, list[str]]]:
    """The list as rows on the driver; refused beyond MAX_NAMES rows or names."""
    rows = reference.select(key, name, F.col(aliases) if aliases else F.array().cast("array<string>").alias("aliases")).limit(MAX_NAMES + 1).collect()
    if len(rows) + sum(len(r[2] or []) for r in rows) > MAX_NAMES:
        raise ValueError(f"more than {MAX_NAMES} names")
    return [(int(r[0]), [x for x in [r[1], *(r[2] or [])] if x]) for r in rows if r[0] is not None]


#: The lists a Python worker has built, by what they were built from: tasks of one worker share them.
_BUILT: dict[str, Names] = {}


def built(entries: list[tuple[int, list[str]]]) -> Names:
    """The list, built once per worker process; an older one goes when it is no longer the same."""
    key = hashlib.sha256(repr(entries).encode()).hexdigest()
    if key not in _BUILT:
        if len(_BUILT) >= 4:
            _BUILT.clear()
        _BUILT[key] = Names(entries)
    return _BUILT[key]


def _mapper(lists: dict[str, list[tuple[int, list[str]]]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = {f: built(entries) for f, entries in lists.items()}
        literal = {f: {n[0] for _, n in entries if n} for f, entries in lists.items()}
        known: dict[tuple[str, str], int] = {}
        for b in batches:
            kept_names = b.schema.names[: len(b.schema.names) - len(lists)]
            for f in lists:
                column = b[f].dictionary_encode()  # each distinct value of a batch is mapped once
                values = column.dictionary.to_pylist()
                for v in values:
                    if (f, v) not in known:
                        if len(known) >= CACHE:
                            known.clear()
                        known[f, v] = names[f].entry(v)
                ids = pa.array([known.get((f, v)) if (f, v) in known else names[f].entry(v) for v in values], pa.int64())
                said = pa.array([v in literal[f] for v in values], pa.bool_())
                there = pa.array([bool(v.strip()) for v in values], pa.bool_())
                codes = column.indices
                rows = pc.indices_nonzero(pc.fill_null(there.take(codes), False))
                at = codes.take(rows)
                columns = [b[n].take(rows) for n in kept_names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([f] * len(rows), pa.string()), column.dictionary.take(at), ids.take(at), said.take(at)], names=[*kept_names, "field_name", "value", "ref_id", "is_literal"])

    return run


def canonicalized(df: DataFrame, keep: list[str], lists: dict[str, list[tuple[int, list[str]]]]) -> DataFrame:
    """keep, field_name, value, ref_id, is_literal: one row per row and field of lists whose value is not null or blank.

    ref_id is the entry meant, 0 if none is; is_literal tells whether the value is letter for
    letter the first name of an entry. A narrow pass without shuffle, so it makes no difference
    how often a value occurs; a value that mentions two different entries means none. Names of
    an empty list match nothing.
    """
    rows = spread_for_cpu(df.select(*keep, *lists))
    return rows.mapInArrow(_mapper(lists), f"{rows.select(*keep).schema.simpleString()[7:-1]}, field_name: string, value: string, ref_id: bigint, is_literal: boolean")


def unmatched(mapped: DataFrame) -> DataFrame:
    """field_name, value, n: the values that mean no entry and how often they occur."""
    return mapped.where("ref_id = 0").groupBy("field_name", "value").agg(F.count(F.lit(1)).alias("n"))
