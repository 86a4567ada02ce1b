import os
import struct
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from selvedge import schemas
from selvedge.operators import catalog, images
from selvedge.plans import catalog_queries, engine_queries, general_problems, sqlrun
from selvedge.session import ship
from selvedge.sources import feeds, sinks

DATA = "/root/testdata/sf0.001"
CHECKED = {**engine_queries.SQL, **general_problems.SQL, **{n: catalog_queries.SQL[n] for n in ("similarity_scores", "similar_topn", "recs_vector", "color_options", "smart_tags")}}


def plain(x):
    if x is None or (isinstance(x, float) and x != x):
        return ""
    return f"{x:.6g}" if isinstance(x, float) else str(x)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_queries_equal_their_sql(spark):
    import duckdb

    ship(spark)
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    queries = {**catalog_queries.QUERIES, **engine_queries.QUERIES, **general_problems.QUERIES}
    for name, sql in CHECKED.items():
        found = queries[name](spark, DATA)
        columns = sorted(found.columns)
        got = sorted(tuple(map(plain, r)) for r in found.select(*columns).collect())
        expected = con.sql(sql)
        assert sorted(expected.columns) == columns, name
        assert got == sorted(tuple(map(plain, r)) for r in expected.select(*[f'"{c}"' for c in columns]).fetchall()), name


def test_graphql_documents_and_responses():
    text = feeds.graphql_query("products", {"companyId": "1", "none": None, "keywords": ['a"b'], "limit": 5}, {"id": None, "price": {"amount": None}}, "subscription")
    assert text.split() == 'subscription { products(companyId: "1", keywords: ["a\\"b"], limit: 5) { id price { amount } } }'.split()
    assert feeds.records_at('{"data": {"x": {"list": [{"a": {"b": 1}}]}}}', "data", "x", "list") == [{"a": {"b": 1}}]
    assert feeds.records_at({"data": None}, "data", "x") == [] and feeds.flat_record({"a": {"b": {"c": 1}}, "d": [2]}) == {"a.b.c": 1, "d": [2]}
    with pytest.raises(OSError):
        feeds.records_at({"errors": ["refused"]}, "data")


def test_prices_of_feeds(spark):
    df = spark.createDataFrame([("1", None, "2 EUR"), ("2", "3,50", None), ("3", None, None)], "_product_id string, price_retail string, price_sale string")
    got = feeds.mapped(df, feeds.merchandiser_spec(df, "Shop"), schemas.DAILY_PRODUCT_DUMP).orderBy("external_id").collect()
    assert [(r.product_price, r.product_sale_price, r.advertiser_name, r.product_external_labels) for r in got] == [(2.0, 2.0, "Shop", []), (3.5, 3.5, "Shop", []), (None, None, "Shop", [])]


def test_fetching_gives_up_after_the_timeout(spark):
    def fetch(u):
        if u == "slow":
            time.sleep(3)
        return u.encode()

    began = time.time()
    got = feeds.fetched(spark.createDataFrame([("slow",), ("a",), (None,)], "u string").coalesce(1), "u", fetch, timeout=0.5).collect()
    assert [r.content for r in got] == [None, bytearray(b"a"), None] and time.time() - began < 10


def png(pixels: np.ndarray, rule: int, palette: bytes = b"") -> bytes:
    height, width, planes = pixels.shape
    lines, above = [], np.zeros((width, planes), int)
    for y in range(height):
        row, out = pixels[y].astype(int), np.zeros((width, planes), int)
        for x in range(width):
            left, corner = (row[x - 1], above[x - 1]) if x else (np.zeros(planes, int),) * 2
            p = left + above[x] - corner
            paeth = np.where((abs(p - left) <= abs(p - above[x])) & (abs(p - left) <= abs(p - corner)), left, np.where(abs(p - above[x]) <= abs(p - corner), above[x], corner))
            out[x] = (row[x] - [0 * left, left, above[x], (left + above[x]) // 2, paeth][rule]) % 256
        lines.append(bytes([rule]) + out.astype(np.uint8).tobytes())
        above = row
    color = 3 if palette else {1: 0, 2: 4, 3: 2, 4: 6}[planes]
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, color, 0, 0, 0)) + (chunk(b"PLTE", palette) if palette else b"") + chunk(b"IDAT", zlib.compress(b"".join(lines))) + chunk(b"IEND", b"")


@pytest.mark.parametrize("rule", range(5))
@pytest.mark.parametrize("planes", [1, 2, 3, 4])
def test_png_round_trip(rule, planes):
    pixels = np.random.default_rng(rule * 9 + planes).integers(0, 256, (5, 7, planes))
    assert (images.decode(png(pixels, rule)) == (np.repeat(pixels[..., :1], 3, 2) if planes < 3 else pixels[..., :3])).all()


def test_png_palette_and_broken():
    assert images.decode(png(np.array([[[1], [0]]]), 0, bytes([1, 2, 3, 7, 8, 9]))).tolist() == [[[7, 8, 9], [1, 2, 3]]]
    assert images.difference_hash(b"\x89PNG broken") is None


def test_table_is_brought_to_a_schema(spark, tmp_path):
    spark.sql(f"CREATE DATABASE altered LOCATION '{tmp_path}/db'")
    try:
        a, b, c = T.StructField("a", T.LongType(), True, {"comment": "it's a"}), T.StructField("b", T.StringType()), T.StructField("c", T.LongType(), False, {"default": 7})
        sqlrun.ensure_table(spark, "altered.t", T.StructType([b, a]))
        sinks.insert(spark.createDataFrame([("x", 1), (None, 2)], "b string, a long"), "altered.t", ["b", "a"])
        sqlrun.ensure_table(spark, "altered.t", T.StructType([a, T.StructField("d", T.StringType()), c]))
        assert spark.table("altered.t").columns == ["a", "d", "c", "b"] and {x.name: x.description for x in spark.catalog.listColumns("altered.t")}["a"] == "it's a"
        assert sorted(map(tuple, spark.table("altered.t").collect())) == [(1, None, 7, "x"), (2, None, 7, None)]
        with pytest.raises(ValueError):
            sqlrun.ensure_table(spark, "altered.t", T.StructType([a, T.StructField("b", T.StringType(), False)]))
        sqlrun.ensure_table(spark, "altered.t", T.StructType([a, T.StructField("b", T.StringType(), False, {"default": "none"})]))
        assert sorted(r.b for r in spark.table("altered.t").collect()) == ["none", "x"] and spark.table("altered.t").columns == ["a", "b", "d", "c"]
    finally:
        spark.sql("DROP DATABASE altered CASCADE")


def test_enforced_parts_every_row(spark):
    rows = [(1, "a"), (1, "b"), (None, "c"), (2, None), (3, "z")]
    good, bad = schemas.enforced(spark.createDataFrame(rows, "id long, ref string"), schemas.Constraints(("id",), foreign_keys=(("ref", "t", "k"),)), {"t": spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")})
    assert sorted(map(tuple, good.collect()), key=str) == [(1, "b"), (2, None)]
    assert sorted((r.ref, r.rule) for r in bad.collect()) == [("a", "unique id"), ("c", "not null id"), ("z", "ref in t.k")]


def test_ranks_over_several_partitions(spark):
    df = spark.range(500).select(F.hex(F.xxhash64("id")).alias("x"))
    got = [r.x for r in sinks.ranked_documents(df, [F.col("x")]).orderBy("rank").collect()]
    assert got == sorted(got) and sinks.ranked_documents(df.where("false"), [F.col("x")]).collect() == []


def test_variants_without_rule_or_image(spark):
    df = spark.createDataFrame([("a", "p.jpg"), ("a", None), ("b", "p.jpg"), (None, "p.jpg")], "who string, u string")
    found = catalog.variants_by_advertiser(F.col("who"), {"a": catalog.named_variants(F.col("u"), r"\.jpg", ["_x.jpg"])})
    assert [r[0] for r in df.select(found).collect()] == [["p_x.jpg"], [], [], []]
