import os
import random

import pytest

from selvedge.llm import encoding

PATH = encoding.tokenizer_path()
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary file")

TEXTS = [
    "", " ", "a", "don't we'll they're I've x's 'still 's's", "word " * 50, "x" * 300, "日本語のテキスト" * 40, "1234567890" * 30, "a1b2c3!!??  \n\n\t end ",
    "   leading and trailing   ", "emoji 👍🏽❤️‍🔥 and <|endoftext|> inside", "tabs\t\t\tand\r\n\r\nlines   .", "é" * 100 + "!" * 100 + " " * 200 + "x", "。、" * 80, "…'ll" * 60,
]


@pytest.mark.parametrize("leaf", [1, 2, 7, 50])
@pytest.mark.parametrize("window", [1, 5])
def test_tree_gives_the_ids_of_the_whole_text(leaf, window):
    enc = encoding.Encoder(PATH, leaf=leaf, window=window)
    rng = random.Random(leaf)
    alphabet = "ab Z'ſ9١!.,\n\t 　 é日👍’sdtrevmll"
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(200))) for _ in range(150)]
    for text, ids in zip(texts, enc.encode_all(texts)):
        assert ids.tolist() == enc.pieces([text])[0], repr(text)
        assert enc.decode(ids.tolist()) == text


def test_table_with_empty_null_and_long_texts(spark):
    long = "The hem, 42 cm. " * 40_000
    rows = [(1, None), (2, ""), (3, "soft wool"), (4, long), (5, "soft wool")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.ids for r in encoding.encode(df, "text", ["doc_id"]).collect()}
    enc = encoding.encoder(PATH)
    assert got == {i: (enc.pieces([t])[0] if t else []) for i, t in rows}
    counts = {r.doc_id: r.n_tokens for r in encoding.count_tokens(df, "text", ["doc_id"]).collect()}
    assert counts == {i: len(x) for i, x in got.items()}
    assert encoding.encode(df.where("false"), "text", ["doc_id"]).collect() == []
    back = encoding.encode(df, "text", ["doc_id"]).select("doc_id", encoding.decoded("ids").alias("text"))
    assert {r.doc_id: r.text for r in back.collect()} == {i: t or "" for i, t in rows}
