"""Personal information in free text, found by bootstrapped contextual extraction.

1. Candidates. Loose grammars propose spans of each kind, once, in one pass over the texts. A
   candidate has features (the words of a name, the digit mask of a number, the top-level
   domain of an address, ...) and stands in contexts: patterns of the tokens before and after it.
2. Graph. Some features are seeds: words of the email addresses in the corpus for names, formats
   of public standards and labels for numbers, a postcode or label for addresses. Features and
   patterns form a graph over all documents, and scores pass from seeds to patterns, from
   patterns to other features, and on, for a few rounds:

    score(pattern) = sum(n * score(feature)) / (sum(n) + SMOOTHING)
    score(feature) = the same over its patterns of one side, for the side that tells most; 1 for seeds

3. Extraction. Candidates are joined with the patterns they stand in. A seed needs one pattern that
   is not against it (SEED_THRESHOLD, or unknown), any other candidate one that is for it (THRESHOLD), so
   identifiers are found that no seed resembles. Names in small letters beside a sure context,
   and the ends of addresses that run into the next sentence, are looked for in a second, gated
   pass, which knows fixed-size filters of the learnt words and contexts; what it proposes is
   joined with the patterns like all else.

Patterns, features and candidates stay in tables and meet by joins, so their number is not
bounded. Only names of towns and streets and of persons in ideographs are held by tasks.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from selvedge.functions.skew import broadcast_if_small, spread_for_cpu
from selvedge.llm.canonical import folded
from selvedge.session import checkpointed, written

KINDS = ("person", "email", "phone", "id_number", "address")
ROUNDS = 4
SMOOTHING = 2.0
THRESHOLD = 0.55
#: In words without capitals, and on one token alone, a context must be surer.
THRESHOLD_LOWER = 0.7
#: A seed counts unless all its known contexts score less: a context seen once, with a seed, scores 1 / (1 + SMOOTHING).
SEED_THRESHOLD = 0.3
#: From this score on a feature lends its score to patterns.
PROMOTED = 0.7
PROMOTED_FORM = 0.55
#: Bits of a filter of learnt words or contexts: a fixed size, whatever the corpus.
WORD_BITS = 1 << 22
#: Most names of towns, streets and persons in ideographs that a task holds. Beyond that the run is refused, not cut.
MAX_LEARNT = 500_000
#: Least occurrences of a pattern that finds what is no seed.
LEAST = 3
#: Longer tokens and masks stand in patterns as a digest, which tells them apart as well.
LONG = 48

# Titles, which are no part of a name.
TITLES = frozenset("mr mrs ms miss mx dr prof sir herr frau hr fr sr sra srta señor señora don doña mme mlle monsieur madame mademoiselle".split())
# Top-level domains that seed email addresses.
DOMAINS = frozenset("com org net edu gov info biz io co eu de at ch es mx ar fr be it nl pt uk us ca au jp example test invalid".split())
# Masks (9 a digit, A a letter) of documents whose format is public: US social security number, UK national insurance number, French NIR, German tax number, Spanish DNI.
ID_SEEDS = frozenset(["999-99-9999", "AA 99 99 99 A", "9 99 99 99 999 999 99", "99 999 999 999", "99.999.999-A"])

# Words that announce a number of a person; numbers after them are seeds.
LABELS = {
    "phone": "tel|tél|telefon|telephone|phone|mobile|mobil|cell|fax|call me|ring|handy|rückruf|anruf|appelez|portable|llamar|llámame|teléfono|móvil|電話番号|電話|携帯",
    "id_number": "passport|passeport|pasaporte|reisepass|ssn|social security|national insurance|ni number|nino|tax id|taxpayer|tin|steuer-id|steuer-identifikationsnummer|steuernummer|ausweis|ausweisnummer|personalausweis|führerschein|sozialversicherungsnummer|driver(?:'s)? licen[cs]e|driving licen[cs]e|licen[cs]e|permis|sécurité sociale|carte d'identité|dni|d\\.n\\.i\\.|nif|n\\.i\\.f\\.|nie|seguridad social|identity card|id card|マイナンバー|個人番号|パスポート|旅券番号|免許証",
    "address": "address|adresse|anschrift|dirección|住所|ship(?: it)? to|deliver to|lieferung an|livrer (?:au|à)|enviar a",
}
_HAN_LABELS = [w for v in LABELS.values() for w in v.split("|") if regex.fullmatch(r"\p{Han}+", w)]
#: Characters between a label and its number, and those back to which a label can begin: the longest, what follows it, and one before.
AFTER_LABEL = 14
_BACK = {k: max(map(len, v.split("|"))) + AFTER_LABEL + 1 for k, v in LABELS.items()}
_LABELLED = {k: regex.compile(rf"(?<![\p{{Latin}}])(?:{v})(?![\p{{Latin}}])[^\d\n]{{0,{AFTER_LABEL}}}$", regex.I) for k, v in LABELS.items()}

TOKEN = regex.compile(r"[\p{Latin}\p{M}][\p{Latin}\p{M}’']*|[\p{Han}々]+|\p{Hiragana}+|[\p{Katakana}ー]+|\p{L}+|\d+|[\n\r]+|[^\s\w]|_")
_UP = r"\p{Lu}[\p{Latin}\p{M}'’]+"
_LOW = r"[\p{Latin}][\p{Latin}\p{M}'’]+"
_GAP = r"[  　]"


def _name(word: str) -> regex.Pattern:
    full = rf"{word}(?:[-‐‑]{word})*"
    return regex.compile(rf"(?:{full}{_GAP}(?:\p{{L}}\.{_GAP}?)?{full}|\p{{L}}\.{_GAP}?{full}|{full},{_GAP}{full}(?:{_GAP}\p{{L}}\.)?)(?![\p{{Latin}}\p{{M}}])")


NAME, NAME_LOWER = _name(_UP), _name(_LOW)
EMAIL = regex.compile(r"(?<![\p{Latin}\d._+@＠-])[\p{Latin}\d][\p{Latin}\d._+'-]*(?:\s?[@＠]\s?|\s?[(\[{]\s?at\s?[)\]}]\s?)[\p{Latin}\d-]+(?:(?:\.|\s?[(\[{]\s?dot\s?[)\]}]\s?|\sdot\s)[\p{Latin}\d-]+)+", regex.I)
_DIG = r"[\d０-９]"
_JOIN = r"(?:[ \u00a0.\-‐‑–－/]|[)）][ \u00a0.-]?|[ \u00a0]?[(（]|)"
NUMBER = regex.compile(rf"(?<![\p{{Latin}}\d０-９#@.,-]|\d/|\d ?[x×] ?)[+＋(（]{{0,2}}{_DIG}(?:{_JOIN}{_DIG})+(?:,?\s?(?:ext\.?|extension|x|durchwahl|dw\.?|poste|int\.?|内線)\s?{_DIG}{{1,6}})?(?![\p{{Latin}}\d０-９@])", regex.I)
PERSONAL_NUMBER = regex.compile(r"(?<![\p{Latin}\d#@/_.,-])(?:(?:[A-Z]{1,2}[ -]?)?\d+(?:[ .\-]\d+)*(?:[ .-]?[A-Z])?|(?=[A-Z\d]{7,15}(?![A-Z\d]))(?:[A-Z]{0,2}\d+){2,}[A-Z]?)(?![\p{Latin}\d@_])(?!/\d)(?![.-]\d)", regex.I)

# Words for streets and parts of buildings.
_EN_TYPE = r"(?:Ave\.?|(?:Street|St|Road|Rd|Lane|Ln|Avenue|Boulevard|Blvd|Court|Ct|Drive|Dr|Place|Pl|Square|Sq|Way|Close|Terrace|Crescent|Row|Walk|Parkway|Pkwy)(?:\.(?=[.,]|\s?#|\s\p{Ll}))?)(?![\p{Latin}])"
_UNIT = r"(?:,?\s(?:Apt|Apartment|Flat|Unit|Suite|Ste)\.?\s?\w{1,5}|,?\s?#\s?\w{1,5})"
_SEP = r"(?:,\s|\s[–—-]\s|\s?[\n\r]+\s?)"
_TOWN = r"[\p{Latin}\p{M}'’.]+(?:-[\p{Latin}\p{M}'’]+)*"
EN = regex.compile(rf"(?<![\p{{Latin}}\d])(?:(?:Flat|Apt|Apartment|Unit|Suite)\.?\s\w{{1,5}},\s)?\d{{1,5}}\s?[A-Z]?\s(?:[\p{{Latin}}\p{{M}}'’.-]+ ){{1,3}}?{_EN_TYPE}{_UNIT}?", regex.I)
EN_TAIL = regex.compile(rf"{_SEP}({_TOWN}(?:\s{_TOWN}){{0,2}}),?\s\d{{5}}(?:-\d{{4}})?(?!\d(?!\d?[./]\d))", regex.I)
DE = regex.compile(rf"(?<![\p{{Latin}}\d])(?:(?:Am|Im|An der|An den|Auf dem|Auf der|In der|Zum|Zur|Unter den) )?(?:[\p{{Latin}}\p{{M}}-]+(?:straße|strasse|str\.|weg|allee|platz|gasse|ring|damm|ufer)|[\p{{Latin}}\p{{M}}-]+ (?:Straße|Strasse|Str\.|Weg|Allee|Platz|Gasse|Ring|Damm|Ufer))\s\d{{1,4}}(?:\s?[a-z](?![\p{{Latin}}]))?(?![\p{{Latin}}\d%])", regex.I)
FR = regex.compile(rf"(?<![\p{{Latin}}\d])\d{{1,4}}(?:\s(?:bis|ter|quater))?,?\s(?:rue|avenue|av\.|bd|bld|boulevard|impasse|place|allée|chemin|quai|cours|route|square)\s((?:de la |de l[’']|du |des |de |d[’'])?[\p{{Latin}}\p{{M}}'’-]+(?: [\p{{Latin}}\p{{M}}'’-]+){{0,3}})", regex.I)
ES = regex.compile(rf"(?<![\p{{Latin}}\d])(?:Calle|C/|Avda\.?|Avenida|Av\.|Plaza|Pza\.?|Paseo|Pº|Camino|Ronda|Travesía)\s(?:[\p{{Latin}}\p{{M}}'’-]+\s){{1,4}}?(?<=\s)(?:(?:nº|n°|núm\.?|no\.?)\s?)?\d{{1,4}}(?![\d%])(?:,\s\d{{1,2}}\s?[ºª°](?:\s[A-Z](?![\p{{Latin}}]))?)?|(?<![\p{{Latin}}\d])(?:Calle|C/|Avda\.?|Avenida|Av\.|Plaza|Pza\.?|Paseo|Pº|Camino|Ronda|Travesía)\s(?:[\p{{Latin}}\p{{M}}'’-]+\s?){{1,4}}?,\s?\d{{1,4}}(?![\d%])(?:,\s\d{{1,2}}\s?[ºª°](?:\s[A-Z](?![\p{{Latin}}]))?)?", regex.I)
ZIP_TAIL = regex.compile(rf"{_SEP}(?:[A-Z]{{1,2}}-)?\d{{5}}\s({_TOWN}(?:\s{_TOWN}){{0,2}})", regex.I)
SEP, TOWNS = regex.compile(_SEP), regex.compile(rf"{_TOWN}(?:\s{_TOWN}){{0,2}}")
_END = regex.compile(r"\s*(?:$|[.!?:;,)<\n\r&]|\s\s)")


def short(token: str) -> str:
    return token if len(token) <= LONG else "#" + hashlib.blake2b(token.encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()


class Text:
    """A text with its tokens, for contexts."""

    def __init__(self, text: str):
        spans = [m.span() for m in TOKEN.finditer(text)]
        self.text, self.starts, self.ends = text, [a for a, _ in spans], [b for _, b in spans]
        whole = [text[a:b] for a, b in spans]
        self.tokens = [("0" if t[0].isdigit() else "¶" if t[0] in "\n\r" else t.casefold()) if len(t) <= LONG else "0" if t[0].isdigit() else short(t.casefold()) for t in whole]
        #: Digits in the text, to know which grammars can find anything.
        self.digits = sum(b - a for a, b, t in zip(self.starts, self.ends, self.tokens) if t == "0") if "0" in self.tokens else 0

    def sides(self, start: int, end: int) -> tuple[list[str], list[str]]:
        """The three tokens before text[start:end] and the three after it; a token that the span parts counts with its rest."""
        i, j = bisect_left(self.ends, start + 1), bisect_left(self.starts, end)
        if i < len(self.starts) and self.starts[i] < start:
            left = [*self.tokens[max(0, i - 2) : i], short(self.text[self.starts[i] : start].casefold())]
        else:
            left = self.tokens[max(0, i - 3) : i]
        if j and self.ends[j - 1] > end:
            right = [short(self.text[end : self.ends[j - 1]].casefold()), *self.tokens[j : j + 2]]
        else:
            right = self.tokens[j : j + 3]
        return ["^"] * (3 - len(left)) + left, right + ["$"] * (3 - len(right))

    def patterns(self, start: int, end: int) -> list[str]:
        """Contexts of text[start:end], from the nearest token outwards on either side and across."""
        left, right = self.sides(start, end)
        out = [f"L2 {left[1]} {left[2]}", f"L3 {left[0]} {left[1]} {left[2]}", f"R2 {right[0]} {right[1]}", f"R3 {right[0]} {right[1]} {right[2]}", f"X {left[2]} _ {right[0]}"]
        if left[2][:1].isalpha():
            out.append(f"L1 {left[2]}")
        return out


# Fixed value: the forms of a date.
DATE = regex.compile(r"\d{4}[-./]\d{1,2}[-./]\d[\d.]*|\d{1,2}[-./]\d{1,2}[-./]\d[\d.]{1,4}")


def mask(number: str) -> str:
    out = []
    for c in number:
        out.append("9" if c.isdigit() else "A" if c.isalpha() else "-" if c in "‐‑–－" else " " if c.isspace() else c)
    return short("".join(out))


def labelled(kind: str, text: str, at: int) -> bool:
    return bool(_LABELLED[kind].search(text[max(0, at - _BACK[kind]) : at]))


def _digits(s: str) -> int:
    return sum(c.isdigit() for c in s)


def names(t: Text, pattern: regex.Pattern) -> Iterator[tuple[int, int]]:
    """Spans of the form of a name at every capital; a title in front is no part of it."""
    text = t.text
    for s, token in zip(t.starts, t.tokens):
        if text[s].isupper() and token not in TITLES and (m := pattern.match(text, s)):
            yield m.span()


_NAME_WORD = regex.compile(r"[\p{Latin}\p{M}]{2,}")


@lru_cache(1 << 16)
def name_words(span: str) -> list[str]:
    return _NAME_WORD.findall(folded(span))


_HAN_RUN = regex.compile(r"[\p{Han}々]+(?:[  　][\p{Han}々]+)?")
_HAN_START = regex.compile(r"(?:^|[。．！？\n])\s*([\p{Han}]{2,4})(?=[\p{Hiragana}])")
# Forms of address after a name, and what stands before one.
HONORIFICS = ("様", "殿")
_BEFORE_NAME = frozenset("はがの、。：:")


def han_runs(t: Text) -> Iterator[tuple[int, int, str]]:
    """(start, end, run): runs of ideographs, over one blank, up to a form of address."""
    for m in _HAN_RUN.finditer(t.text):
        run = m[0]
        if run.endswith(HONORIFICS):
            run = run[:-1]
        if len(run) >= 2:
            yield m.start(), m.start() + len(run), run


_AT = regex.compile(r"[@＠]|[(\[{]\s?at\s?[)\]}]", regex.I)
_DE_GATE = regex.compile(r"(?:straße|strasse|str\.|weg|allee|platz|gasse|ring|damm|ufer)\s\d", regex.I)


_NO_WORD, _NO_LETTER, _MAIL_PART = regex.compile(r"[^\p{L}\d]+"), regex.compile(r"[^\p{L}]+"), regex.compile(r"[@＠(\[{+]")


def emails(t: Text) -> Iterator[tuple[int, int, str]]:
    if not _AT.search(t.text):
        return
    for m in EMAIL.finditer(t.text):
        yield m.start(), m.end(), _NO_WORD.split(m[0].casefold())[-1]


_EXTENSION = regex.compile(r"(?i),?\s?(?:ext\.?|extension|x|durchwahl|dw\.?|poste|int\.?|内線)\s?\d+$")
_SMALL_WORD = regex.compile(r"(?i)(?:id|no|nr|is|es|le|at|on|of|to|in|al|am|by|it|or)[ -]")


def phones(t: Text) -> Iterator[tuple[int, int, str]]:
    if t.digits < 7:
        return
    for m in NUMBER.finditer(t.text):
        s, e = m.span()
        if e - s < 7:
            continue
        span = m[0]
        if span[0] in "(（" and ")" not in span and "）" not in span:
            s += 1
        while span.rstrip()[-1:] in ")）" and t.text[s:e].count("(") + t.text[s:e].count("（") < t.text[s:e].count(")") + t.text[s:e].count("）"):
            e -= 1
            span = t.text[s:e]
        if _digits(t.text[s:e]) >= 7:
            yield s, e, mask(_EXTENSION.sub("", t.text[s:e])) + " label" * labelled("phone", t.text, s)


def personal_numbers(t: Text) -> Iterator[tuple[int, int, str]]:
    if t.digits < 6:
        return
    for m in PERSONAL_NUMBER.finditer(t.text):
        s, e = m.span()
        if e - s < 6:
            continue
        if m := _SMALL_WORD.match(t.text[s:e]):
            s = m.end() + s
        if _digits(t.text[s:e]) >= 6:
            yield s, e, mask(t.text[s:e]) + " label" * labelled("id_number", t.text, s)


# The tokens of which a text has one at least if the grammar of that language finds anything.
_EN_CUES = frozenset("ave street st road rd lane ln avenue boulevard blvd court ct drive dr place pl square sq way close terrace crescent row walk parkway pkwy".split())
_CUES = {"fr": frozenset("rue avenue av bd bld boulevard impasse place allée chemin quai cours route square".split()), "es": frozenset("calle c avda avenida av plaza pza paseo pº p camino ronda travesía".split())}


def _prefix(words: str, known: set[str]) -> str | None:
    """The longest beginning of words that is known and not followed by a small letter."""
    best = None
    for n in {len(k) for k in known}:
        if n <= len(words) and folded(words[:n]) in known and not words[n : n + 1].islower() and (best is None or n > len(best)):
            best = words[:n]
    return best


def addresses(t: Text, towns: set[str], streets: set[str]) -> Iterator[tuple[int, int, str, list[tuple[str, str]]]]:
    """(start, end, feature, learnt): spans, their form, and (kind, name) of what stands before a clear end."""
    text, seen = t.text, set(t.tokens)
    if not t.digits:
        return
    for m in EN.finditer(text) if seen & _EN_CUES else ():
        if tail := EN_TAIL.match(text, m.end()):
            yield m.start(), tail.end(), "en zip", [("town", folded(tail[1]))]
            continue
        end = m.end()
        if sep := SEP.match(text, end):
            rest = TOWNS.match(text, sep.end())
            if rest and (town := _prefix(rest[0], towns)):
                end = sep.end() + len(town)
        yield m.start(), end, "en" + " label" * labelled("address", text, m.start()), []
    for lang, grammar in (("de", DE), ("es", ES), ("fr", FR)):
        if not (_DE_GATE.search(text) if lang == "de" else seen & _CUES[lang]):
            continue
        for m in grammar.finditer(text):
            start, end, learnt = m.start(), m.end(), []
            if lang == "fr":
                name, at = m[1], m.start(1)
                tail = ZIP_TAIL.match(text, end)
                if tail or _END.match(text, end):
                    learnt.append(("street", folded(name)))
                else:
                    for n in range(len(name), 0, -1):  # the tail may follow an earlier word
                        if n == len(name) or name[n] in " ":
                            if ZIP_TAIL.match(text, at + n):
                                break
                    else:
                        n = 0
                    if n:
                        end = at + n
                    else:
                        own = _prefix(name, streets)
                        if own is None:
                            small = regex.match(r"(?i)(?:de la |de l[’']|du |des |de |d[’'])?[\p{L}\p{M}'’-]+", name)
                            own = small[0]
                        end = at + len(own)
            feature = lang
            if tail := ZIP_TAIL.match(text, end):
                feature = f"{lang} zip"
                town = tail[1]
                if _END.match(text, tail.end(1)) and " " not in town:
                    learnt.append(("town", folded(town.rstrip("."))))
                own = _prefix(town, towns) or town.split()[0].rstrip(".")
                end = tail.start(1) + len(own)
            yield start, end, feature + " label" * (feature == lang and labelled("address", text, start)), learnt


@dataclass
class Found:
    """A candidate. mode: `sure` for a seed, `learn` if it only teaches, else how it is judged (see _judged)."""

    start: int
    end: int
    kind: str
    mode: str
    features: list[str]
    patterns: list[str]


def candidates_of(text: str) -> tuple[list[Found], list[tuple[str, str]]]:
    """All candidates of a text, and the (kind, name)s that are learnt from it without a pattern."""
    t = Text(text)
    out: list[Found] = []
    learnt: list[tuple[str, str]] = []
    for s, e, domain in emails(t):
        out.append(Found(s, e, "email", "sure" if domain in DOMAINS else "", [domain], t.patterns(s, e)))
        if domain in DOMAINS:
            learnt += [("mailword", w) for w in _NO_LETTER.split(folded(_MAIL_PART.split(text[s:e])[0])) if len(w) >= 3]
    for s, e in names(t, NAME):
        out.append(Found(s, e, "person", "learn" if _capitals(t, s, e) else "", name_words(text[s:e]), t.patterns(s, e)))
    for s, e, run in han_runs(t):
        if text[e : e + 1] in HONORIFICS:
            parts = regex.split(r"[  　]", run)
            learnt += [("han", w) for w in parts] if len(parts) > 1 else [("hanfull", run)]
            out.append(Found(s, e, "person", "honoured sure" if text[max(0, s - 1) : s] in _BEFORE_NAME else "honoured", [run], [f"R1 {text[e]}", *(p for p in t.patterns(s, e) if p[0] != "L")]))
        elif text[max(0, s - 2) : s].strip()[-1:] in (":", "："):
            out.append(Found(s, e, "person", "after colon", [], [p for p in t.patterns(s, e) if p[0] == "L"]))
    learnt += [("hanstart", m[1]) for m in _HAN_START.finditer(text)]
    for kind, spans in (("phone", phones(t)), ("id_number", personal_numbers(t))):
        for s, e, f in spans:
            form = f.removesuffix(" label")
            known = form[:1] in "+＋" or form[:2] == "(+" if kind == "phone" else form in ID_SEEDS
            # a labelled number's form as such (its shadow) has met the label's contexts as well
            mode = "learn" if form == f and DATE.fullmatch(text[s:e]) else "sure" if form != f or known else ""
            out.append(Found(s, e, kind, mode, [f, f"{form} shadow"] if form != f else [f], t.patterns(s, e)))
    for s, e, f, names_ in addresses(t, set(), set()):
        out.append(Found(s, e, "address", "learn", [f], t.patterns(s, e)))
        learnt += names_
    return out, learnt


SPANS = "array<struct<start: int, end: int, kind: string, mode: string, piece: string, features: array<string>, patterns: array<string>>>"
_SPAN = [("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("mode", pa.string()), ("piece", pa.string()), ("features", pa.list_(pa.string())), ("patterns", pa.list_(pa.string()))]


def _lists(rows: list[list], kinds: list[tuple[str, pa.DataType]]) -> pa.Array:
    """Lists of structs from lists of tuples."""
    offsets, flat = [0], []
    for r in rows:
        flat += r
        offsets.append(len(flat))
    columns = [pa.array([x[i] for x in flat], kind) for i, (_, kind) in enumerate(kinds)]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(columns, names=[n for n, _ in kinds]))


def _with(df: DataFrame, columns: list[str], more: str = "") -> StructType:
    """The schema of some columns of df, whatever their names, and of more ones."""
    return StructType([df.schema[c] for c in columns] + (list(_parse_datatype_string(more).fields) if more else []))


def _tuple(f: Found, text: str) -> tuple:
    return f.start, f.end, f.kind, f.mode, text[f.start : f.end], f.features, f.patterns


def candidates(documents: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """_row, _keep (a struct), _text, spans and learnt of every document, written once: all later steps read it."""
    rows = documents.select(F.struct(*[F.col(f"`{k}`") for k in keep], F.lit(None).cast("string").alias("_none")).alias("_keep"), F.col(text).alias("_text"))
    rows = spread_for_cpu(rows).withColumn("_row", F.monotonically_increasing_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans, learnt = [], []
            for x in b["_text"].to_pylist():
                found, names_ = candidates_of(x) if x else ([], [])
                spans.append([_tuple(f, x) for f in found])
                learnt.append(names_)
            yield pa.RecordBatch.from_arrays([*b.columns, _lists(spans, _SPAN), _lists(learnt, [("kind", pa.string()), ("name", pa.string())])], names=["_keep", "_text", "_row", "spans", "learnt"])

    return written(rows.mapInArrow(run, _with(rows, ["_keep", "_text", "_row"], f"spans {SPANS}, learnt array<struct<kind: string, name: string>>")))


def scored_graph(edges: DataFrame, mailwords: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(kind, pattern, score, n) and (kind, feature, score): the graph, scored for some rounds.

    edges: kind, feature, pattern, n, already summed, so a frequent pattern is as many rows as
    it has features. mailwords: feature. A round touches only edges of features that are known
    and of patterns that have any score: those are joined by broadcast where they are few, else
    by exchange. Patterns without score are left out; features have one, 0 if need be.
    """
    mail = mailwords.distinct().select(F.lit("person").alias("kind"), "feature", F.lit(True).alias("_mail"))
    seed = (
        F.when(F.col("kind") == "person", F.coalesce("_mail", F.lit(False)) | F.col("feature").endswith(" honoured sure"))
        .when(F.col("kind") == "email", F.col("feature").isin(*DOMAINS))
        .when(F.col("kind") == "phone", F.col("feature").rlike(r"^\(?[+＋]") | F.col("feature").endswith(" label"))
        .when(F.col("kind") == "id_number", F.col("feature").isin(*ID_SEEDS) | F.col("feature").endswith(" label"))
        .otherwise(F.col("feature").rlike(" (zip|label)$"))
    )
    form = F.regexp_replace("feature", " shadow$", "").alias("feature")
    graph = edges.join(broadcast_if_small(mail), ["kind", "feature"], "left").select("kind", form, "pattern", "n", seed.alias("seed"), F.col("feature").endswith(" shadow").alias("shadow"))
    graph = graph.withColumn("side", F.substring("pattern", 1, 2))
    # totals stand on every edge, so a round needs no join to find them: of a pattern (a labelled
    # number counts once), and of the side of a feature that has most
    of_pattern = graph.where("NOT shadow").groupBy("kind", "pattern").agg(F.sum("n").alias("of_pattern"))
    met = graph.groupBy("kind", "feature", "side").agg(F.sum("n").alias("n")).groupBy("kind", "feature").agg(F.max("n").alias("of_feature"))
    graph = checkpointed(graph.join(of_pattern, ["kind", "pattern"], "left").join(met, ["kind", "feature"]))
    counted = graph.where("NOT shadow")
    seeds = checkpointed(counted.where("seed").select("kind", "feature").distinct().withColumn("score", F.lit(1.0)))
    own = broadcast_if_small(seeds.select("kind", "feature"))
    known, patterns, scores = seeds, None, None
    for _ in range(rounds):
        mass = counted.join(broadcast_if_small(known), ["kind", "feature"]).groupBy("kind", "pattern").agg(F.sum(F.col("n") * F.col("score")).alias("mass"), F.first("of_pattern").alias("n"))
        patterns = checkpointed(mass.select("kind", "pattern", (F.col("mass") / (F.col("n") + SMOOTHING)).alias("score"), "n"))
        sides = graph.join(broadcast_if_small(patterns.select("kind", "pattern", "score")), ["kind", "pattern"]).groupBy("kind", "feature", "side").agg(F.sum(F.col("n") * F.col("score")).alias("mass"), F.first("of_feature").alias("n"))
        # of the sides of a context that one counts which tells most; every occurrence has one pattern of each
        best = sides.groupBy("kind", "feature").agg((F.max("mass") / (F.first("n") + SMOOTHING)).alias("score"))
        scores = checkpointed(best)
        # a half-known feature lends nothing, so errors don't creep
        sure = scores.where(F.col("score") >= F.when(F.col("kind") == "person", PROMOTED).otherwise(PROMOTED_FORM))
        known = seeds.unionByName(sure.join(own, ["kind", "feature"], "left_anti"))
    whole = graph.select("kind", "feature").distinct().join(broadcast_if_small(scores), ["kind", "feature"], "left")
    whole = whole.join(broadcast_if_small(seeds.select("kind", "feature", F.lit(1.0).alias("_seed"))), ["kind", "feature"], "left")
    return patterns, whole.select("kind", "feature", F.coalesce("_seed", "score", F.lit(0.0)).alias("score"))


def _bits(word: str) -> tuple[int, int]:
    return zlib.crc32(word.encode()) % WORD_BITS, zlib.crc32(word.encode(), 77) % WORD_BITS


def _filters(words: DataFrame) -> dict[str, bytes]:
    """A filter, as compressed bits, of the words of each name; words: name (a handful of different ones), word.

    Each task makes filters of fixed size, eight tasks unite them, so few come to the driver.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, bytearray] = {}
        for b in batches:
            for name, word in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                bits = held.setdefault(name, bytearray(WORD_BITS // 8))
                for x in _bits(word):
                    bits[x >> 3] |= 1 << (x & 7)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([zlib.compress(bytes(x)) for x in held.values()], pa.binary())], names=["name", "bits"])

    def united(rows: Iterator[tuple[str, bytes]]) -> dict[str, int]:
        whole: dict[str, int] = {}
        for name, x in rows:
            whole[name] = whole.get(name, 0) | int.from_bytes(zlib.decompress(x), "little")
        return whole

    def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = united((n, x) for b in batches for n, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        if whole:
            yield pa.RecordBatch.from_arrays([pa.array(list(whole), pa.string()), pa.array([zlib.compress(x.to_bytes(WORD_BITS // 8, "little")) for x in whole.values()], pa.binary())], names=["name", "bits"])

    parts = words.mapInArrow(made, "name string, bits binary").repartition(8).mapInArrow(few, "name string, bits binary").collect()
    return {name: zlib.compress(x.to_bytes(WORD_BITS // 8, "little")) for name, x in united(map(tuple, parts)).items()}


EMPTY = zlib.compress(bytes(WORD_BITS // 8))


class Filter:
    """Whether a word may be among those a filter was made of; remembers what it was asked."""

    def __init__(self, packed: bytes):
        self.bits, self.known, self.sides = zlib.decompress(packed), {}, {}

    def near(self, token: str) -> int:
        """1 if the token may stand right before a name in a sure context, 2 if right after, 3 for both."""
        hit = self.sides.get(token)
        if hit is None:
            if len(self.sides) > 200_000:
                self.sides.clear()
            hit = self.sides[token] = (f"before {token}" in self) + 2 * (f"after {token}" in self)
        return hit

    def __contains__(self, word: str) -> bool:
        hit = self.known.get(word)
        if hit is None:
            if len(self.known) > 200_000:
                self.known.clear()
            hit = self.known[word] = all(self.bits[x >> 3] >> (x & 7) & 1 for x in _bits(word))
        return hit


@dataclass
class Model:
    """What was learnt: two tables of any size, and what tasks hold, of bounded size."""

    patterns: DataFrame  # kind, pattern, score, n
    features: DataFrame  # kind, feature, score
    words: bytes  # filter of the words of names
    contexts: bytes  # filter of sure contexts of names, and of their nearest tokens
    held: dict[str, set[str]]  # town, street, han, hanfull, hanstart

    def tasks(self) -> dict:
        return {"words": self.words, "contexts": self.contexts, "held": self.held}


def learn(found: DataFrame) -> Model:
    """A model from all documents' candidates."""
    spans = found.select(F.explode("spans").alias("s"))
    # a name after a form of address teaches by itself; one in small letters, or one after a colon, teaches nothing
    features = F.when(F.col("s.mode").startswith("honoured"), F.transform("s.features", lambda x: F.concat(x, F.lit(" "), F.col("s.mode")))).otherwise(F.col("s.features"))
    edges = spans.select("s.kind", F.explode(features).alias("feature"), "s.patterns").select("kind", "feature", F.explode("patterns").alias("pattern"))
    edges = checkpointed(edges.groupBy("kind", "feature", "pattern").agg(F.count(F.lit(1)).alias("n")))
    names_ = checkpointed(found.select(F.explode("learnt").alias("x")).groupBy("x.kind", "x.name").agg(F.count(F.lit(1)).alias("n")))
    patterns, features = scored_graph(edges, names_.where("kind = 'mailword'").select(F.col("name").alias("feature")))
    named = names_.where(F.col("kind").startswith("han") | (F.col("kind").isin("town", "street") & (F.col("n") >= 2))).select("kind", "name").limit(MAX_LEARNT + 1).collect()
    if len(named) > MAX_LEARNT:
        raise ValueError(f"more than {MAX_LEARNT} names of places or persons learnt")
    sure = patterns.where((F.col("kind") == "person") & (F.col("score") >= THRESHOLD_LOWER) & (F.col("n") >= LEAST)).select("pattern")
    parts = F.split("pattern", " ")
    # the token next to the name, before it or after it, tells cheaply where a context may be
    near = F.when(F.col("pattern").startswith("R2"), F.concat(F.lit("after "), F.get(parts, F.lit(1)))).when(F.col("pattern").startswith("X"), F.concat(F.lit("before "), F.get(parts, F.lit(1)))).when(F.col("pattern").startswith("L"), F.concat(F.lit("before "), F.element_at(parts, -1)))
    words = features.where("kind = 'person'").where(F.col("score") >= PROMOTED).where(~F.col("feature").contains(" honoured")).select(F.lit("words").alias("name"), F.col("feature").alias("word"))
    contexts = sure.select(F.lit("contexts").alias("name"), F.explode(F.filter(F.array("pattern", near), lambda x: x.isNotNull())).alias("word"))
    made = _filters(words.unionByName(contexts))
    return Model(patterns, features, made.get("words", EMPTY), made.get("contexts", EMPTY), {k: {r.name for r in named if r.kind == k} for k in ("town", "street", "han", "hanfull", "hanstart")})


def _han_end(run: str, held: dict[str, set[str]]) -> int:
    """Characters of a run of ideographs that are a name: the longest known one, else up to a known start of a sentence or a label, else all."""
    flat = regex.sub(r"[  　]", "", run)
    longest = max(max(map(len, held["hanfull"]), default=0), 2 * max(map(len, held["han"]), default=0))
    best = 0
    for n in range(2, min(len(flat), longest) + 1):
        head = flat[:n]
        if head in held["hanfull"] or any(head[:k] in held["han"] and head[k:] in held["han"] for k in range(1, n)):
            best = n
    if not best:
        cuts = [flat.find(w) for w in (*held["hanstart"], *_HAN_LABELS) if flat.find(w) >= 2]
        best = min(cuts, default=len(flat))
    kept = out = 0
    for c in run:
        if kept == best:
            break
        out += 1
        kept += c not in "  　"
    return out


_CAPITALS = regex.compile(r"[\p{Latin}]{2,}")


def _capitals(t: Text, start: int, end: int) -> bool:
    """Whether text[start:end] is in capitals like the words around it, so that they tell nothing."""
    if t.text[start:end].upper() != t.text[start:end]:
        return False
    i, j = bisect_left(t.ends, start + 1) - 1, bisect_left(t.starts, end)
    while i >= 0 and not _CAPITALS.search(t.text, t.starts[i], t.ends[i]):
        i -= 1
    while j < len(t.starts) and not _CAPITALS.search(t.text, t.starts[j], t.ends[j]):
        j += 1
    return (i >= 0 and t.text[t.starts[i] : t.ends[i]].isupper()) or (j < len(t.starts) and t.text[t.starts[j] : t.ends[j]].isupper())


#: Tokens of the longest name in small letters: two double names, each of parts with hyphens between.
NAME_TOKENS = 8


def _beside_context(t: Text, contexts: Filter) -> Iterator[tuple[int, int]]:
    """Spans of the form of a name, whatever their case, beside a context that may be sure."""
    tokens = t.tokens
    sides = list(map(contexts.near, tokens))
    before = contexts.near("^")
    for i, (s, token, side) in enumerate(zip(t.starts, tokens, sides)):
        if before & 1 and token[0].isalpha() and token not in TITLES and (m := NAME_LOWER.match(t.text, s)):
            yield m.span()
        if side & 2 and i >= 2 and i + 1 < len(tokens) and f"R2 {token} {tokens[i + 1]}" in contexts:
            for j in range(max(0, i - NAME_TOKENS), i - 1):
                m = NAME_LOWER.match(t.text, t.starts[j]) if tokens[j] not in TITLES else None
                if m and m.end() == t.ends[i - 1]:
                    yield m.span()
                    break
        before = side


_JUDGED_LOWER = ("L1 ", "L2 ", "L3 ", "X ", "R2 ")


def second_look(text: str, cased: set[int], has_address: bool, words: Filter, contexts: Filter, held: dict[str, set[str]]) -> list[Found]:
    """Candidates that need what was learnt: addresses up to known towns and streets, and names in small letters."""
    out, t = [], Text(text)
    if has_address:
        for s, e, f, _ in addresses(t, held["town"], held["street"]):
            out.append(Found(s, e, "address", "sure" if f.endswith((" zip", " label")) else "", [f], t.patterns(s, e)))
    seen = set()
    for s, e in _beside_context(t, contexts):
        if (s, e) not in seen and s not in cased and (text[s].islower() or _capitals(t, s, e)) and any(w in words for w in name_words(text[s:e]) if len(w) > 2):
            seen.add((s, e))
            if kept := [p for p in t.patterns(s, e) if p.startswith(_JUDGED_LOWER) and p in contexts]:
                out.append(Found(s, e, "person", "lower", [], kept))
    return out


def second_looks(found: DataFrame, model: Model) -> DataFrame:
    """_row, _keep and s, one candidate a row."""
    known = model.tasks()
    rows = found.where(F.length("_text") > 0).select("_row", "_keep", "_text", F.transform(F.filter("spans", lambda s: (s["kind"] == "person") & (s["mode"] == "")), lambda s: s["start"]).alias("cased"), F.exists("spans", lambda s: s["kind"] == "address").alias("address"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, contexts = Filter(known["words"]), Filter(known["contexts"])
        for b in batches:
            index, spans = [], []
            for i, (x, cased, address) in enumerate(zip(b["_text"].to_pylist(), b["cased"].to_pylist(), b["address"].to_pylist())):
                more = second_look(x, set(cased), address, words, contexts, known["held"])
                index += [i] * len(more)
                spans += [_tuple(f, x) for f in more]
            at = pa.array(index, pa.int64())
            s = pa.StructArray.from_arrays([pa.array([x[i] for x in spans], kind) for i, (_, kind) in enumerate(_SPAN)], names=[n for n, _ in _SPAN])
            yield pa.RecordBatch.from_arrays([b["_row"].take(at), b["_keep"].take(at), s], names=["_row", "_keep", "s"])

    return rows.mapInArrow(run, _with(rows, ["_row", "_keep"], f"s {SPANS[6:-1]}"))


def _judged(model: Model, spans: DataFrame) -> DataFrame:
    """spans (_row, _keep, s) that count, with their priority: joined with the patterns they stand in, and with the score of their form."""
    # one token alone, or one on either side, must be surer
    strict = F.when(F.substring("pattern", 1, 2).isin("L1", "X "), THRESHOLD_LOWER).otherwise(THRESHOLD)
    good = (F.col("n") >= LEAST) & (F.col("score") >= strict)
    every = model.patterns.select("kind", "pattern", F.col("score").alias("any_score"), F.when(good, F.col("score")).alias("good_score"))
    used = spans.where("s.mode != 'learn'").select("_row", "_keep", "s.*").withColumn("form", F.regexp_replace(F.coalesce(F.get("features", F.lit(0)), F.lit("")), " label$", "")).drop("features")
    met = used.withColumn("pattern", F.explode("patterns")).drop("patterns")
    sure = F.col("mode").endswith("sure")
    # what is no seed needs only the good patterns, which are few; a seed is held against all that have a score
    parts = met.where(~sure).join(broadcast_if_small(checkpointed(every.where("good_score IS NOT NULL"))), ["kind", "pattern"])
    parts = parts.unionByName(met.where(sure).join(broadcast_if_small(every), ["kind", "pattern"], "left"))
    best = parts.groupBy("_row", "start", "end", "kind", "mode", "form").agg(F.max("good_score").alias("best"), F.max("any_score").alias("any"), F.first("piece").alias("piece"), F.first("_keep").alias("_keep"))
    best = best.where(~sure | F.coalesce(F.col("any") >= SEED_THRESHOLD, F.lit(True)))
    forms = checkpointed(model.features.where(F.col("kind").isin("phone", "id_number") & ~F.col("feature").endswith(" label")).select("kind", F.col("feature").alias("form"), F.col("score").alias("form_score")))
    known = best.join(broadcast_if_small(forms), ["kind", "form"], "left")
    x = F.greatest(F.coalesce("best", F.lit(0.0)), F.when(sure, 0.95).otherwise(0.0))
    # of two kinds for one number, that counts whose form it has
    number = 2.0 + x * F.when(sure, 1.0).otherwise(0.5 + 0.5 * F.coalesce("form_score", F.lit(0.5)))
    least = F.when(F.col("mode") == "lower", THRESHOLD_LOWER).otherwise(THRESHOLD)
    priority = F.when(F.col("kind") == "email", 5.0).when(F.col("kind") == "address", 4.0).when(F.col("kind").isin("phone", "id_number"), number).when(F.col("mode") == "lower", 1.0).when(F.col("mode") != "", 1.9).otherwise(1.0 + x)
    return known.where(x >= least).select("_row", "_keep", "start", "end", "kind", "mode", "piece", priority.alias("priority"))


def _without_overlaps(hits: list[dict], held: dict[str, set[str]]) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, piece) in order: of overlapping hits the one that ranks first stays."""
    kept: list[tuple[int, int, str, str]] = []
    for h in sorted(hits, key=lambda h: (-h["priority"], h["start"], h["start"] - h["end"])):
        s, piece = h["start"], h["piece"]
        if h["mode"] == "after colon":
            piece = piece[: _han_end(piece, held)]
        e = s + len(piece)
        i = bisect_left(kept, (s, e, h["kind"], piece))
        if (not i or kept[i - 1][1] <= s) and (i == len(kept) or kept[i][0] >= e):
            kept.insert(i, (s, e, h["kind"], piece))
    return kept


def _found(found: DataFrame, model: Model) -> DataFrame:
    """_row, _keep and the final spans, one document a row; documents without any are left out."""
    # written, because what is judged below is read once as seeds and once as the rest
    spans = found.select("_row", "_keep", F.explode("spans").alias("s")).unionByName(written(second_looks(found, model)))
    hits = _judged(model, spans).groupBy("_row").agg(F.first("_keep").alias("_keep"), F.collect_list(F.struct("priority", "start", "end", "kind", "mode", "piece")).alias("hits"))
    held = model.held
    final = [("start", pa.int32()), ("end", pa.int32()), ("pii_kind", pa.string()), ("pii_text", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["_row"], b["_keep"], _lists([_without_overlaps(h, held) for h in b["hits"].to_pylist()], final)], names=["_row", "_keep", "final"])

    return hits.mapInArrow(run, _with(hits, ["_row", "_keep"], "final array<struct<start: int, end: int, pii_kind: string, pii_text: string>>"))


def extract(documents: DataFrame, text: str, keep: list[str], model: Model | None = None) -> DataFrame:
    """keep, start, end, pii_kind, pii_text: one row per piece, exactly as it stands in the text.

    model: from `learn`, by default learnt from these documents. Null and empty texts have no
    piece. Offsets count code points.
    """
    found = candidates(documents, text, keep)
    final = _found(found, model if model is not None else learn(found))
    return final.select(*[F.col(f"_keep.`{k}`").alias(k) for k in keep], F.explode("final").alias("_f")).select(*[F.col(f"`{k}`") for k in keep], "_f.*")


def redact(documents: DataFrame, text: str, keep: list[str], model: Model | None = None) -> DataFrame:
    """keep and the text with each piece replaced by its kind, such as [PHONE]; all else stays as it is.

    Null stays null.
    """
    found = candidates(documents, text, keep)
    final = _found(found, model if model is not None else learn(found)).select("_row", "final")
    rows = found.select("_row", "_keep", "_text").join(final, "_row", "left").drop("_row")

    def replaced(x: str | None, spans: list[dict] | None) -> str | None:
        if not x or not spans:
            return x
        out, at = [], 0
        for h in spans:
            out += [x[at : h["start"]], f"[{h['pii_kind'].upper()}]"]
            at = h["end"]
        return "".join([*out, x[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["_keep"], pa.array([replaced(x, s) for x, s in zip(b["_text"].to_pylist(), b["final"].to_pylist())], pa.string())], names=["_keep", "_text"])

    done = rows.mapInArrow(run, _with(rows, ["_keep", "_text"]))
    return done.select(*[F.col(f"_keep.`{k}`").alias(k) for k in keep], F.col("_text").alias(text))
