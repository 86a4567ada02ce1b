import pytest

from selvedge.llm import canonical

COLORS = [(1, ["Black", "schwarz", "blk"]), (2, ["Teal", "verde azulado"]), (3, ["Green", "verde"]), (4, ["Crimson"]), (5, ["Red", "rojo"]), (6, ["Olive", "olivgrün"])]
BRANDS = [(10, ["Fenloka Mills"]), (11, ["Luwenja & Daughters"]), (12, ["Tertakel"]), (13, ["Yafen Paris Nine"]), (14, ["Brilin Paris Nine"]), (15, ["Wagawen Mills"])]


@pytest.mark.parametrize(
    ("value", "entry"),
    [
        ("BLACK ", 1), ("Bl​ack", 1), ("Ｂｌａｃｋ", 1), ("Blасk", 1), ("[Black]", 1), ("col_black", 1), ("black_3", 1), ("blacks", 1), ("Black&nbsp;", 1), ("black, black", 1),
        ("Verde azulado", 2), ("verde", 3), ("olivgrÃ¼n", 6), ("OLIVGRUN", 6), ("Crmison", 4), ("crimsoon", 4), ("shade red 42", 5), ("Réd", 5),
        ("black/red", 0), ("size 477", 0), ("ver foto", 0), ("as shown", 0), ("redwood", 0), ("??", 0), ("", 0), (None, 0), ("  ", 0), ("0371", 0),
    ],
)
def test_colors(value, entry):
    assert canonical.Names(COLORS).entry(value) == entry


@pytest.mark.parametrize(
    ("value", "entry"),
    [
        ("Mills Fenloka", 10), ("fenloka", 10), ("Fenloka Mils", 10), ("FenlokaMills", 10), ("www.fenloka.example", 10), ("Fenloka Mills Official", 10), ("luwenja and daughters", 11),
        ("Tertakel®", 12), ("tretakel", 12), ("Brilin", 14), ("Paris Nine Yafen", 13), ("Paris Nine", 0), ("Docaselflo Mills", 0), ("Mills", 0), ("house line", 0),
    ],
)
def test_brands(value, entry):
    assert canonical.Names(BRANDS).entry(value) == entry


def test_longest_mention_wins():
    names = canonical.Names(COLORS)
    assert [e for *_, e in names.mentions("verde azulado black".split())] == [2, 1]
    assert canonical.Names([]).entry("black") == 0


def test_table(spark):
    rows = [(1, "BLACK", None), (2, " ", "tertakel"), (3, None, "n/a"), (4, "x" * 50_000, "Tertakel"), (1, "BLACK", None)]
    df = spark.createDataFrame(rows, "product_id long, color string, product_brand string")
    got = canonical.canonicalized(df, ["product_id"], {"color": COLORS, "product_brand": BRANDS})
    assert sorted((r.product_id, r.field_name, r.ref_id) for r in got.collect()) == [(1, "color", 1), (1, "color", 1), (2, "product_brand", 12), (3, "product_brand", 0), (4, "color", 0), (4, "product_brand", 12)]
    assert {tuple(r) for r in canonical.unmatched(got).collect()} == {("product_brand", "n/a", 1), ("color", "x" * 50_000, 1)}
    assert canonical.canonicalized(df.where("false"), ["product_id"], {"color": COLORS}).collect() == []


def test_reference_list_is_bounded(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id long, name string")
    assert canonical.reference_names(df, "id", "name") == [(1, ["a"]), (2, ["b"])]
    monkeypatch.setattr(canonical, "MAX_NAMES", 2)
    with pytest.raises(ValueError):
        canonical.reference_names(df, "id", "name")


def test_very_long_values():
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = canonical.Names(COLORS)
    assert names.entry("".join(letters[(i * i) % 26] for i in range(60_000))) == 0
    assert names.entry(" ".join(letters[i % 26] * 5 + letters[i // 26 % 26] for i in range(20_000))) == 0
    assert names.entry("black " * 50_000) == 1


SIZE = """
import random, resource
from selvedge.llm import canonical
rng = random.Random(1)
word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(5, 11)))
entries = [(i + 1, [f"{word()} {word()}".title()]) for i in range(canonical.MAX_NAMES)]
names = canonical.Names(entries)
found = [names.entry(n[:3] + n[4] + n[3] + n[5:]) == e for e, [n] in entries[::2000]]
print(sum(found), len(found), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""


def test_the_largest_list_fits_a_worker():
    import os
    import subprocess
    import sys

    out = subprocess.run([sys.executable, "-c", SIZE], capture_output=True, text=True, timeout=300, cwd=os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), check=True).stdout.split()
    assert out[0] == out[1] and int(out[2]) < 1500


def test_near_words_against_brute_force():
    import random

    rng = random.Random(8)
    words = sorted({"".join(rng.choice("abcd") for _ in range(rng.randrange(1, 12))) for _ in range(300)})
    near = canonical.Near(words)
    for _ in range(300):
        w = "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 12)))
        expected = {t for t in words if (most := min(canonical.allowed(len(t)), canonical.allowed(len(w) + 1))) >= canonical.distance(w, t, most)}
        assert {t for t, _ in near(w)} == expected
