import gzip
import json

import pytest
from pyspark.sql import functions as F

from selvedge import schemas
from selvedge.plans import sqlrun
from selvedge.session import ship
from selvedge.sources import feeds, sinks
from selvedge.streaming import events


def test_feeds(spark, tmp_path):
    with gzip.open(tmp_path / "feed.csv.gz", "wt") as f:
        f.write('merchant_name,brand_name,product_name,rrp_price,search_price,"Fashion:size",colour,merchant_image_url,alternate_image,category_name,merchant_product_id\nShop,Brand,Tee,,12.50,M,red,u1,u2,Tops,A-1\nShop,,Hat,20,x,,,u3,,,A-2\n')
    feed = feeds.read_csv(spark, str(tmp_path / "feed.csv.gz"))
    out = feeds.mapped(feed, feeds.feed_spec(feed), schemas.PRODUCT_INFO).orderBy("external_id").collect()
    assert [(r.product_brand, r.product_price, r.product_sale_price, r.size, r.product_additional_image_urls, r.product_external_labels) for r in out] == [("Brand", 12.5, 12.5, "M", ["u2"], ["Tops"]), ("Shop", 20.0, 20.0, None, [], [])]
    (tmp_path / "feed.xml").write_text("<all><product><name>Tee</name><price><retail>5</retail></price></product><product><name>Hat</name></product></all>")
    xml = feeds.flattened(feeds.read_xml(spark, str(tmp_path / "feed.xml")))
    assert sorted(xml.columns) == ["name", "price_retail"] and xml.count() == 2
    frame = spark.createDataFrame([("nan", float("nan")), ("a", 1.0)], "s string, x double")
    assert [tuple(r) for r in feeds.nulls_normalized(frame).collect()] == [(None, None), ("a", 1.0)]
    assert feeds.rows(spark, [{"b": 1, "a": "x"}]).columns == ["a", "b"]
    got = feeds.fetched(spark.createDataFrame([("ok",), ("bad",), (None,)], "u string"), "u", lambda u: b"x" if u == "ok" else 1 / 0)
    assert [r.content for r in got.collect()] == [bytearray(b"x"), None, None]


def test_rules_settings_and_tables(spark, tmp_path):
    (tmp_path / "rules.json").write_text('{"dress": [{"name": "dress"}]}')
    assert feeds.read_rules(spark, str(tmp_path / "rules.json")) == {"dress": [{"name": "dress"}]}
    words = spark.createDataFrame([("a", "b"), ("a", "c"), ("a", "b"), (None, "x")], "root string, synonym string")
    assert feeds.search_settings({"ranking": 1, "synonyms": {"z": ["y"]}}, words) == {"ranking": 1, "synonyms": {"z": ["y"], "a": ["b", "c"]}}
    spark.sql("DROP TABLE IF EXISTS made_by_test")
    try:
        sqlrun.ensure_table(spark, "made_by_test", spark.createDataFrame([], "id long").schema)
        sqlrun.ensure_table(spark, "made_by_test", spark.createDataFrame([], "id long, name string").schema)
        sinks.insert(spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string"), "made_by_test", ["id", "name"], condition=F.col("id") > 1)
        assert [tuple(r) for r in spark.table("made_by_test").collect()] == [(2, "b")]
    finally:
        spark.sql("DROP TABLE IF EXISTS made_by_test")


def test_paged_feed(spark, tmp_path):
    (tmp_path / "pages_of_test.py").write_text("def page(number, options):\n    return [{'id': number, 'tags': ['a']}]\n")
    spark.sparkContext.addPyFile(str(tmp_path / "pages_of_test.py"))
    ship(spark)
    spark.dataSource.register(feeds.PagedFeed)
    df = spark.read.format("paged_feed").options(pages="3", schema="id long, tags string", fetcher="pages_of_test:page").load()
    assert sorted(tuple(r) for r in df.collect()) == [(0, '["a"]'), (1, '["a"]'), (2, '["a"]')]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, day string")
    path = str(tmp_path / "t")
    sinks.overwrite(df, path, "day")
    sinks.replace_partitions(spark.createDataFrame([(9, "b")], "id long, day string"), path, "day")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 9]
    sinks.append(df, path, "day")
    assert spark.read.parquet(path).count() == 4
    other = str(tmp_path / "s")
    assert sinks.current(spark, other) is None
    sinks.swap(df, other)
    for _ in range(3):
        sinks.swap(sinks.current(spark, other).withColumn("id", F.col("id") + 1), other)  # reads what it replaces
    assert sorted(r.id for r in sinks.current(spark, other).collect()) == [4, 5]
    (tmp_path / "s" / "version=9").mkdir()  # a version whose writer was lost
    assert sorted(r.id for r in sinks.current(spark, other).collect()) == [4, 5] and len(list((tmp_path / "s").iterdir())) == 3
    assert sorted(json.loads(r.document)["id"] for r in sinks.documents(df, {"x": "y"}).collect()) == [1, 2]
    box = tmp_path / "sent"
    box.mkdir()

    def send(rows, box=str(box)):
        import pathlib
        import uuid

        pathlib.Path(box, uuid.uuid4().hex).write_text(str(len(rows)))

    sinks.upload(spark.range(25).coalesce(1), send, 10)
    assert sorted(int(p.read_text()) for p in box.iterdir()) == [5, 10, 10]


def test_statements():
    assert sqlrun.statements("SELECT ';' AS a; -- x; y\n/* ; */ SELECT `b;` ; ;") == ["SELECT ';' AS a", "SELECT `b;`"]


def test_stream_equals_batch_and_repeats_nothing(spark, tmp_path):
    src, log, counts = (str(tmp_path / n) for n in ("src", "log", "counts"))
    schema = "user_id long, event string, product_id long, ts timestamp"
    data = spark.createDataFrame([(i % 5, ["fave", "bag", "x"][i % 3], i % 4) for i in range(60)], "user_id long, event string, product_id long").withColumn("ts", F.timestamp_seconds(F.col("user_id") * 90000))
    data.repartition(3).write.parquet(src)
    kinds = {"n_likes": F.col("event") == "fave", "n_bags": F.col("event") == "bag"}
    count, append = events.counting(counts, ["product_id"], kinds, 2), events.append_batches(log, "ts")

    def both(batch, number):
        count(batch, number)
        count(batch, number)  # a repeated batch
        append(batch, number)

    for _ in range(2):
        events.run_batches(events.read_events(spark, src, schema, 1), both, str(tmp_path / "check")).awaitTermination()
    got = sorted((r.product_id, r.n_likes, r.n_bags) for r in sinks.counts(spark, counts, ["product_id"]).collect())
    expected = data.groupBy("product_id").agg(F.count_if(kinds["n_likes"]).alias("a"), F.count_if(kinds["n_bags"]).alias("b")).collect()
    assert got == sorted(map(tuple, expected)) and spark.read.parquet(log).count() == 60


def test_counters_survive_a_crash_between_any_two_steps(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "c")
    batch = lambda n: spark.createDataFrame([(1, n)], "id long, n long")
    total = lambda: [r.n for r in sinks.counts(spark, path, ["id"]).collect()]
    sinks.add_counts(batch(5), path, 0, ["id"], 2)
    (tmp_path / "c" / "delta=1").mkdir()  # the writer of batch 1 was lost before it was done
    assert total() == [5]

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:  # and again after the sum was written, before the batches went
        m.setattr(sinks, "remove", lost)
        with pytest.raises(RuntimeError):
            sinks.add_counts(batch(2), path, 1, ["id"], 2)
    assert total() == [7]
    sinks.add_counts(batch(2), path, 1, ["id"], 2)  # Spark repeats the batch
    assert total() == [7]
    sinks.add_counts(batch(3), path, 2, ["id"], 2)
    assert total() == [10]


def test_jdbc_round_trip(spark):
    url, driver = "jdbc:derby:memory:selvedge;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    df = spark.createDataFrame([(i, f"n{i}") for i in range(20)], "id long, name string")
    sinks.write_jdbc(df, url, "products", "overwrite", partitions=2, driver=driver)
    sinks.write_jdbc(spark.createDataFrame([(99, None)], df.schema), url, "products", driver=driver)
    back = feeds.read_jdbc(spark, url, "products", "id", (0, 20), 4, driver=driver)
    assert back.rdd.getNumPartitions() == 4
    assert sorted((r[0], r[1] or "") for r in back.collect()) == sorted([*[(i, f"n{i}") for i in range(20)], (99, "")])


def test_entry_points(spark):
    import __spark_entry__ as e

    queries, sql = e.queries(), e.oracle_sql()
    assert set(sql) <= set(queries) and {"p1_found", "p2_found", "p5_found", "p7_found"} <= set(queries)


def test_llm_package_is_not_needed_elsewhere():
    import pathlib
    import re

    root = pathlib.Path(__file__).resolve().parent.parent / "selvedge"
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert not re.search(r"^\s*(from|import)\s+selvedge\.llm", p.read_text(), re.M), p
