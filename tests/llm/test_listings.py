import pytest

from selvedge.llm import listings

COLORS = [(1, ["Black"]), (2, ["Navy"]), (3, ["Grey", "gray"])]
BRANDS = [(10, ["Fenloka Mills"]), (11, ["Tertakel"]), (12, ["Britosel Leather Co"])]
SCHEMA = "product_id long, advertiser_name string, product_brand string, product_name string, product_description string, color string, internal_color string"


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("width 4.5 cm", "length 4.5"), ('1.8" wide', "length 4.5"), ("1.8 inch", "length 4.5"), ("0.88 m inseam", "length 88"), ("880 mm", "length 88"), ("34.6 in", "length 88"),
        ("24 ltr", "volume 24"), ("24000 ml", "volume 24"), ("140gsm", "weight 140"), ("4.1 oz/yd²", "weight 140"), ("pack of 5", "pieces 5"), ("5er pack", "pieces 5"), ("x5", "pieces 5"), ("5 pcs", "pieces 5"), ("5-pack", "pieces 5"), ("size 40", None), ("", None),
    ],
)
def test_measures(text, value):
    assert listings.measure(text) == value


def rows():
    return [
        (1, "A", "Fenloka Mills", "'Zodriwaso' belt navy 4.5 cm wide", "Composition leather. Dry clean only.", "Navy", "navy"),
        (2, "B", "B", "Fenloka ZODRI-WASO leather belt", "Approx. 1.8 in wide. Shown in navy.", None, None),
        (3, "C", "Fenloka Mills®", "belt, SALE, Zodriwsao, genuine leather, 45 mm width", "<p>Soft to the touch.</p>", "NAVY", None),
        (4, "C", "FENLOKA MILLS", "Zodriwaso belt black leather 4.5 cm wide", "", "Black", None),
        (5, "D", "Fenloka Mills", "Zodriwaso belt navy leather 3 cm wide", None, "navy", None),
        (6, "E", "Tertakel", "Zodriwaso belt navy leather 4.5 cm wide", None, "navy", None),
        (7, "E", "Fenloka Mills", "Zodri waso belt navy leather 4.5 cm wide", None, "navy", None),
        (8, "A", "Fenloka Mills", "Zodriwaso belt navy leather 4.5 cm wide", None, "navy", None),
        (9, None, None, None, None, None, None),
        (10, "F", "Fenloka Mills", "Zodriwaso belt leather 4.5 cm wide", "", None, None),
        (11, "F", "Fenloka Mills", "Kelmulinda belt navy leather 4.5 cm wide", "", "navy", None),
        (12, "G", "Britosel Leather Co", "Fatowin belt silk 4.5 cm wide", "", "gray", None),
        (13, "H", "H", "Fatowin belt silk 45 mm wide Britosel", "", "Grey", None),
    ]


#: Listings of three brands that make the words of the fixtures common.
FILLER = [
    (900 + i, "Z", b, f"{m} belt sandals silk leather 3 cm wide", "Composition genuine. Dry clean only. SALE width. Soft to the touch. Approx. Shown in wide.", "black", None)
    for i, (b, m) in enumerate([("Tertakel", "Ullorema"), ("Fenloka Mills", "Ghistopar"), ("Britosel Leather Co", "Vuntewil")])
]


def test_groups_and_pairs(spark):
    df = spark.createDataFrame(rows() + FILLER, SCHEMA)
    grouped = listings.groups(df, "product_id", BRANDS, COLORS, ["advertiser_name"])
    pairs = {tuple(r) for r in listings.pairs_between(grouped, "product_id", "advertiser_name").collect()}
    same = [1, 2, 3, 7, 8]
    seller = {r[0]: r[1] for r in rows()}
    assert pairs == {(a, b) for a in same for b in same if a < b and seller[a] != seller[b]} | {(12, 13)}  # 10 fits black as well as navy


def test_repeated_rows_ties_and_empty(spark):
    df = spark.createDataFrame([*rows()[:2], *rows()[:2], *FILLER], SCHEMA).selectExpr("*", "1 AS component", "2 AS trait0", "3 AS rep", "4 AS _row2")
    grouped = listings.groups(df, "product_id", BRANDS, COLORS, ["advertiser_name"])
    assert [tuple(r) for r in listings.pairs_between(grouped, "product_id", "advertiser_name").collect()] == [(1, 2)]
    assert listings.groups(df.where("false"), "product_id", BRANDS, COLORS).collect() == []


def grouped(spark, rows, **kw):
    rows = rows + FILLER
    out = listings.groups(spark.createDataFrame(rows, SCHEMA), "product_id", BRANDS, COLORS, **kw).collect()
    same: dict = {}
    for r in (r for r in out if r.product_id < 900):
        same.setdefault(r.component, set()).add(r.product_id)
    return sorted(map(sorted, same.values()))


def test_every_listing_has_a_group_and_short_models_count(spark):
    name = lambda m: f"{m} belt leather 4.5 cm wide"
    made = lambda i, m: (i, f"S{i}", "Tertakel", name(m), None, "navy", None)
    rows = [made(1, "Zx"), made(2, "ZX"), made(3, "Qy"), (4, "S4", None, "", None, None, None), (5, "S5", None, None, None, None, None), made(6, "x" * 300), made(7, "x" * 300)]
    assert grouped(spark, rows) == [[1, 2], [3], [4], [5], [6, 7]]


def test_markup_of_any_length_is_no_text(spark):
    long = '<p data-x="' + "zorbelino " * 40 + '">'
    rows = [(i, f"S{i}", "Tertakel", "Hatomiru belt leather 4.5 cm wide", x, "navy", None) for i, x in enumerate([long, "", f"5 < 6 {long}"])]
    reader = listings.Reader(BRANDS, COLORS)
    assert all(w["word"] != "zorbelino" for r in rows for w in reader.read(r[3], r[4], r[2], [r[5]])[3])
    assert grouped(spark, rows)[0][:2] == [0, 1]


def catalogue():
    """(listings, true article of each): models of two kinds in some materials, worded in two ways, with marketing by chance."""
    import random

    rng = random.Random(12)
    kinds = [("jeans", "denims"), ("scarf", "stole"), ("coat", "overcoat"), ("boots", "boots"), ("belt", "belt"), ("skirt", "skirt")]
    materials = [("viscose", "rayon"), ("cotton", "cotton"), ("linen", "linen"), ("silk", "silk"), ("cashmere", "cashmere"), ("suede", "suede")]
    out, article = [], {}
    for m in range(300):
        model = "".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(5))
        kind = rng.choice(kinds)
        for material in rng.sample(materials, 1 + (rng.random() < 0.3)):
            for _ in range(5):
                extra = " ".join(rng.sample(["timeless", "iconic", "season", "favourite", "new", "handmade", "studio", "classic"], 2))
                fabric = f"Made from {rng.choice(material)}." if rng.random() < 0.9 else ""
                i = len(out)
                out.append((i, f"S{i % 9}", BRANDS[m % 3][1][0], f"{model} {rng.choice(kind)} 4 cm {extra}", fabric, "navy", None))
                article[i] = (m, material[0], bool(fabric))
    return out, article


def test_traits_are_learnt_from_the_corpus(spark):
    from pyspark.sql import functions as F

    rows, article = catalogue()
    read = listings.facts(spark.createDataFrame(rows, SCHEMA), ["product_id"], BRANDS, COLORS).withColumn("_row", F.col("product_id")).cache()
    common = listings.common_words(read)
    traits = listings.learnt_traits(read, listings.rare_texts(read, common), common)
    value = {w: (s, v) for w, s, v in traits}
    assert value["viscose"] == value["rayon"] and value["scarf"] == value["stole"] and value["jeans"] == value["denims"]
    assert len({value[w] for w in ("viscose", "cotton", "linen", "silk", "cashmere", "suede")}) == 6 and len({value[w][0] for w in ("viscose", "cotton", "linen", "silk")}) == 1
    assert value["scarf"][0] == value["coat"][0] != value["silk"][0] and "timeless" not in value
    read.unpersist()


def test_listings_of_other_materials_are_other_articles(spark):
    rows, article = catalogue()
    out = listings.groups(spark.createDataFrame(rows, SCHEMA), "product_id", BRANDS, COLORS).collect()
    held: dict = {}
    for r in out:
        held.setdefault(r.component, set()).add(article[r.product_id])
    stated = [{(m, f) for m, f, said in members if said} for members in held.values()]
    assert not [x for x in stated if len(x) > 1]  # no group mixes models or materials
    assert sum(map(len, stated)) == len({(m, f) for m, f, said in article.values() if said})  # and no article is parted


def test_the_cosine_decides(spark):
    models = ["Delzomahel", "Delzoprifa", "Delzomahle", "Delzokunto"]
    rows = [(i, f"S{i}", "Tertakel", f"{m} belt leather 4.5 cm wide", None, "navy", None) for i, m in enumerate(models)]
    rows += [(100 + i, "T", "Fenloka Mills", f"{a}{b} belt silk 2 cm wide", None, "black", None) for i, (a, b) in enumerate((a, b) for a in ("Mar", "Sol", "Tun", "Vex") for b in ("ibondo", "akirel", "upasti", "owinga"))]
    assert [0, 2] in grouped(spark, rows)
    assert [0, 1, 2, 3] in grouped(spark, rows, least=-1.0)


def test_pieces_survive_one_error(spark):
    from pyspark.sql import functions as F

    wrong = lambda w: {w[:i] + w[i + 1 :] for i in range(len(w))} | {w[:i] + w[i + 1] + w[i] + w[i + 2 :] for i in range(len(w) - 1)} | {w[:i] + "q" + w[i:] for i in range(len(w) + 1)} | {w[:i] + "q" + w[i + 1 :] for i in range(len(w))}
    pairs = [(w, x) for w in ("abc", "abcd", "abcde", "abcdef", "abcdefg", "abcdefghijk") for x in wrong(w)]
    df = spark.createDataFrame(pairs, "w string, x string")
    lost = df.where(~F.arrays_overlap(listings.pieces(F.col("w")), listings.pieces(F.col("x")))).collect()
    assert all(len(r.w) <= 5 for r in lost) and not [r for r in lost if len(r.w) > 3], lost


def test_hot_group(spark):
    one = rows()[7]
    df = spark.createDataFrame([(i, f"S{i % 40}", *one[2:]) for i in range(1200)] + [(5000 + r[0], *r[1:]) for r in FILLER], SCHEMA)
    grouped = listings.groups(df, "product_id", BRANDS, COLORS, ["advertiser_name"]).where("product_id < 5000")
    assert grouped.select("component").distinct().count() == 1
    assert listings.pairs_between(grouped, "product_id", "advertiser_name").count() == 1200 * 1199 // 2 - 40 * (30 * 29 // 2)


def test_very_long_texts():
    reader = listings.Reader(BRANDS, COLORS)
    long = "well-made and-so-on black " * 40_000
    got = reader.read("Zodriwaso belt leather 4.5 cm wide Fenloka", long, None, [None])
    assert got[:3] == (10, 1, "length 4.5") and got[3][0]["word"] == "zodriwaso"
