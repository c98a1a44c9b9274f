import math

import pytest
from pyspark.sql import functions as F

from shelfrank.operators import catalog
from shelfrank.schemas import CATALOG_DOCUMENT, StrictSchemaError, require_schema
from shelfrank.sources import readers, writers

HITS = (
    "session_id bigint, channel string, sku string, category string, name string,"
    " is_impression boolean, is_click boolean, price_micros bigint"
)


def rows_for(spark, rows):
    return catalog.product_channel(spark.createDataFrame(rows, HITS))


def test_rates_and_distinct_rows(spark):
    view = ("Direct", "a", "x/y", "pen", True, None, 2_000_000)
    click = ("Direct", "a", "x/y", "pen", None, True, 2_000_000)
    # sessions 1 and 2 are equal: their rows count once per channel, twice in all
    products = rows_for(
        spark,
        [(1, *view), (1, *view), (1, *click), (2, *view), (2, *view), (2, *click)]
        + [(3, "Social", "a", "x/y", "pen", None, True, 5_000_000)]
        + [(4, "Direct", "b", "x", "ink", None, True, 1_000_000)],
    )
    found = {(r["sku"], r["channel"]): r for r in catalog.catalog_rows(products).collect()}
    assert set(found) == {("a", "Direct"), ("a", "Social")}  # b was never shown
    direct, social = found["a", "Direct"], found["a", "Social"]
    assert direct["category"] == "x y"
    assert (direct["impressions"], direct["clicks"]) == (4, 3)
    assert direct["ctr"] == 0.75
    assert direct["price"] == pytest.approx(3.0)
    assert (direct["ctr_direct"], direct["ctr_social"]) == (0.5, 0.0)
    assert (social["ctr_direct"], social["ctr_social"]) == (0.0, 1.0)
    every = catalog.catalog_rows(products, distinct_rows=False).filter("channel = 'Direct'")
    assert every.first()["ctr_direct"] == 0.5


def test_last_and_merge(spark):
    products = rows_for(
        spark,
        [
            (1, "Direct", "a", "x", "pen", True, True, 1_000_000),
            (2, "Social", "a", "y", "pen two", True, None, 1_000_000),
            (3, None, "a", "z", "old pen", True, None, 1_000_000),
        ],
    )
    rows = catalog.catalog_rows(products)
    last = catalog.catalog_docs(rows, mode="last").first()
    merged = catalog.catalog_docs(rows).first()
    assert last["name"] == merged["name"] == "pen two"
    assert (last["ctr_direct"], merged["ctr_direct"]) == (0.0, 1.0)


def test_upsert_last_write_wins(spark):
    old = spark.createDataFrame([("a", "old", 9), ("b", "keep", 9)], "sku string, name string, at int")
    new = spark.createDataFrame([("a", "mid", 1), ("a", "new", 2)], "sku string, name string, at int")
    found = {r["sku"]: r["name"] for r in catalog.upsert_catalog(old, new, "at").collect()}
    assert found == {"a": "new", "b": "keep"}
    assert catalog.upsert_catalog(None, new, "at").first()["name"] == "new"


def test_strict_schema(spark):
    products = rows_for(spark, [(1, "Direct", "a", "x", "pen", True, True, 1_500_000)])
    documents = catalog.to_documents(catalog.catalog_docs(catalog.catalog_rows(products)))
    assert documents.schema.simpleString() == CATALOG_DOCUMENT.simpleString()
    assert documents.first()["performances"]["channel"]["direct"]["CTR"] == 1.0
    back = catalog.from_documents(documents).first()
    assert (back["price"], back["ctr_direct"]) == (1.5, 1.0)
    with pytest.raises(StrictSchemaError, match="colour"):
        require_schema(documents.withColumn("colour", F.lit("red")), CATALOG_DOCUMENT)
    nested = documents.withColumn(
        "performances", F.col("performances").withField("global.extra", F.lit(1))
    )
    with pytest.raises(StrictSchemaError, match="performances.global.extra"):
        require_schema(nested, CATALOG_DOCUMENT)


def test_catalog_is_rebuilt_only_on_request(spark, tmp_path):
    path = str(tmp_path / "catalog")
    calls = []

    def build(price):
        def inner():
            calls.append(price)
            hits = [(1, "Direct", "a", "x", "pen", True, True, price * 1_000_000)]
            return catalog.catalog_docs(catalog.catalog_rows(rows_for(spark, hits)))

        return inner

    assert writers.write_catalog(spark, path, build(1)).first()["price"] == 1.0
    assert writers.write_catalog(spark, path, build(2)).first()["price"] == 1.0
    assert writers.write_catalog(spark, path, build(3), force_restart=True).first()["price"] == 3.0
    assert calls == [1, 3]


def test_single_file_export(spark, tmp_path):
    path = tmp_path / "docs"
    frame = spark.createDataFrame([("a", 1), ("b", 2)], "sku string, n int").repartition(4)
    writers.write_ndjson_gz(frame, str(path), single_file=True)
    assert len(list(path.glob("*.json.gz"))) == 1
    back = readers.read_ndjson_gz(spark, str(path), frame.schema)
    assert sorted(back.collect()) == [("a", 1), ("b", 2)]
    assert not math.isnan(back.count())
