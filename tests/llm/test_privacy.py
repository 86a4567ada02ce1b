import pytest

from selvedge.llm import privacy

NAMES = ["Anna Korvelund", "Bruno Tessmark", "Clara Vintholm", "Dario Pelligard", "Elin Morvssen", "Fabio Krantz", "Greta Ollevang", "Hugo Sandmere"]


def corpus():
    texts = []
    for i, n in enumerate(NAMES * 3):
        first, last = n.split()
        texts += [
            f"The parcel was signed for by {n}. Refund approved.",
            f"My name is {n} and I need help. e-mail={first.lower()}.{last.lower()}@post.example;",
            f"Hi, {n} here again. Call me on +1 303 555 01{i:02d} after six.",
            f"Order A-33{i:04d} was late. Parcel TRK 4443 8946 9{i:03d} shows no scan. Ref. 555-3989-{i:02d}.",
            f"Our {first} tote sold out again. The {first} dress is back. 10 Street Style looks to try.",
            f"For customs my SSN is 927-75-30{i:02d}. number on file: 303-555-01{i:02d}",
            f"Tel 303-555-02{i:02d}. tax id 9157469{i:02d} was given by mistake. SSN 927-75-31{i:02d} was given by mistake.",
            f"Mobile 303-555-03{i:02d}, no texts please. Ring 303-555-04{i:02d} if lost.",
            f"Ship it to {i + 2} Mossbridge Lane, Apt 3, Port Alder, 643{i:02d}. Item VZ-1184-581 was exchanged.",
            "Price @ 87.90 each. Sprite file icon@2x.png missing. Tag us @someone now.",
        ]
    return texts


@pytest.fixture(scope="module")
def model(spark):
    return privacy.learn(privacy.candidates(spark.createDataFrame([(i, t) for i, t in enumerate(corpus())], "doc_id long, text string"), "text", []))


def found(spark, model, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = [[] for _ in texts]
    for r in privacy.extract(df, "text", ["doc_id"], model).orderBy("doc_id", "start").collect():
        assert r.pii_text == texts[r.doc_id][r.start : r.end]
        out[r.doc_id].append((r.pii_kind, r.pii_text))
    return out


CASES = [
    ("The parcel was signed for by Zelda Unseenova. Ok.", [("person", "Zelda Unseenova")]),
    ("My name is Unseen, Zelda and I need help.", [("person", "Unseen, Zelda")]),
    ("Hi, Z. Unseen here again.", [("person", "Z. Unseen")]),
    ("the parcel was signed for by anna tessmark. ok", [("person", "anna tessmark")]),
    ("Our Anna tote sold out again.", []),
    ("mail quentin [at] some dot example, now", [("email", "quentin [at] some dot example")]),
    ("e-mail=x.y+z@mail.test;", [("email", "x.y+z@mail.test")]),
    ("icon@2x.png and size@S and @handle", []),
    ("Call me on +44 (0)20 7946 0385 after six.", [("phone", "+44 (0)20 7946 0385")]),
    ("number on file: 415-555-0100", [("phone", "415-555-0100")]),
    ("Tel 212 555 0152 ext. 674.", [("phone", "212 555 0152 ext. 674")]),
    ("tax id 912734887 was given by mistake.", [("id_number", "912734887")]),
    ("DNI nº: 49300160 M. Ok", [("id_number", "49300160 M")]),
    ("Parcel TRK 4443 8946 9231 shows no scan. Order A-331234.", []),
    ("Ship it to Flat 4, 127 Larkspin Ave., Port Alder. Please", [("address", "Flat 4, 127 Larkspin Ave., Port Alder")]),
    ("Neue Anschrift: Kesselbach Weg 41 – 97300 Brennau. Gut", [("address", "Kesselbach Weg 41 – 97300 Brennau")]),
    ("Livrer au 58 bis, avenue du Vieux Lavoir – 85051 Saint-Orme. Oui", [("address", "58 bis, avenue du Vieux Lavoir – 85051 Saint-Orme")]),
    ("Mi dirección: Avda. del Brezal, 26, 2º B, 95194 Torrelusa", [("address", "Avda. del Brezal, 26, 2º B, 95194 Torrelusa")]),
    ("Court Shoes, Avenue Boots and Plaza Bags at 41% off.", []),
    ("", []),
    ("Call me on " + "7" * 41 + " after six.", [("phone", "7" * 41)]),
    ("Tel 303-555-0211. " + "x" * 100 + " Tel 303-555-0212.", [("phone", "303-555-0211"), ("phone", "303-555-0212")]),
]


def test_kinds(spark, model):
    for (text, expected), got in zip(CASES, found(spark, model, [t for t, _ in CASES])):
        assert got == expected, text


def test_tokens_of_a_hundred_letters_are_told_apart(spark):
    a, b = "z" * 100 + "a", "z" * 100 + "b"
    docs = [(i, f"{a} {n} here. {n.split()[0].lower()}.{n.split()[1].lower()}@post.example; {b} {w} there.") for i, (n, w) in enumerate(zip(NAMES * 3, ["Blue Dress", "Summer Sale", "Silk Scarf"] * 8))]
    got = privacy.extract(spark.createDataFrame(docs, "doc_id long, text string"), "text", ["doc_id"]).where("pii_kind = 'person'").collect()
    assert sorted(r.pii_text for r in got) == sorted(NAMES * 3)


def test_a_label_needs_a_context_that_is_not_against_it(spark):
    texts = [f"Ring 303-555-04{i:02d} now. Cell 40 71 {i:02d} 15 fits. " for i in range(20)] + ["mobile 303-555-0399 x"]
    assert found(spark, privacy.learn(privacy.candidates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "text", [])), texts)[-1] == [("phone", "303-555-0399")]


def test_long_runs_of_ideographs():
    held = {"han": {"水城", "谷"}, "hanfull": {"田中"}, "hanstart": {"電話"}}
    assert privacy._han_end("田中電話番号", held) == 2 and privacy._han_end("水城谷電話", held) == 3
    assert privacy._han_end("山本電話番号", held) == 2 and privacy._han_end("山" * 9, held) == 9
    assert [r for *_, r in privacy.han_runs(privacy.Text("山" * 30 + "様"))] == ["山" * 30]


def test_extra_and_clashing_columns(spark, model):
    df = spark.createDataFrame([(1, "Hi, Anna Korvelund here again.", "k", 2)], "`doc id` long, text string, kind string, start int")
    got = privacy.extract(df, "text", ["doc id", "kind"], model).drop("start", "end").collect()
    assert [tuple(r) for r in got] == [(1, "k", "person", "Anna Korvelund")]


def test_tables(spark, model):
    long = "Nothing here. " * 20_000 + "Hi, Anna Korvelund here again."
    rows = [(1, None), (2, ""), (3, "Hi, Anna Korvelund here again.\n"), (4, long), (3, "Hi, Anna Korvelund here again.\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in privacy.extract(df, "text", ["doc_id"], model).select("doc_id", "pii_kind", "pii_text").collect())
    assert got == [(3, "person", "Anna Korvelund")] * 2 + [(4, "person", "Anna Korvelund")]
    clean = {r.doc_id: r.text for r in privacy.redact(df, "text", ["doc_id"], model).collect()}
    assert clean == {1: None, 2: "", 3: "Hi, [PERSON] here again.\n", 4: long.replace("Anna Korvelund", "[PERSON]")}
    assert privacy.extract(df.where("false"), "text", ["doc_id"]).collect() == []


def test_very_long_texts_of_every_kind(spark, model):
    unit = "Hi, Anna Korvelund here again. Tel 303-555-0211. SSN 927-75-3011. 担当は水城谷様です。 New address: 5 Mossbridge Lane, Port Alder, 64311. "
    once, many = found(spark, model, [unit, unit * 2000])
    assert len(many) == 2000 * len(once) and {k for k, _ in once} == {"person", "phone", "id_number", "address"}
    known = model.tasks()
    for odd in ("1" * 100_000, "a" * 100_000, "A-" * 50_000, "@" * 50_000, "1 " * 50_000, "水" * 100_000, "Aa " * 50_000):
        privacy.candidates_of(odd)
        privacy.second_look(odd, set(), True, privacy.Filter(known["words"]), privacy.Filter(known["contexts"]), known["held"])
