"""Loads into a bucketed table: what they rewrite, and what readers see."""

import pathlib

import pytest
from pyspark.sql import functions as F

from shelfrank.operators import catalog
from shelfrank.sources import buckets


def rows_of(df):
    return sorted(map(tuple, df.select("sku", "name", "price").collect()))


def products(spark, first, last, price):
    return spark.range(first, last).select(
        F.col("id").cast("string").alias("sku"), F.concat(F.lit("n"), "id").alias("name"), F.lit(price).alias("price")
    )


def files(path):
    return {f: f.stat().st_size for f in pathlib.Path(path).rglob("*.parquet")}


def test_upserts_rewrite_their_buckets_only(spark, tmp_path):
    path = f"{tmp_path}/catalog"
    old, new = products(spark, 0, 2000, 1.0), products(spark, 1990, 2010, 2.0)
    assert buckets.read_buckets(spark, path) is None
    assert len(buckets.upsert(old, path)) == buckets.BUCKETS
    before = files(path)
    touched = buckets.upsert(new, path)
    expected = {r[0] for r in new.select(buckets.bucket_of("sku", buckets.BUCKETS)).distinct().collect()}
    assert set(touched) == expected and len(touched) <= 20
    added = {f: n for f, n in files(path).items() if f not in before}
    assert len(added) == len(touched) and sum(added.values()) < 0.5 * sum(before.values())
    whole = buckets.read_buckets(spark, path)
    assert rows_of(whole) == rows_of(catalog.upsert_catalog(old, new, order="name"))


def test_readers_never_see_half_a_load(spark, tmp_path):
    path = f"{tmp_path}/catalog"
    buckets.upsert(products(spark, 0, 500, 1.0), path)
    before = rows_of(buckets.read_buckets(spark, path))
    during = buckets.read_buckets(spark, path)
    broken = products(spark, 0, 500, 2.0).withColumn(
        "price", F.when(F.col("sku") == "250", F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("price"))
    )
    with pytest.raises(Exception, match="lost"):
        buckets.upsert(broken, path)
    assert rows_of(buckets.read_buckets(spark, path)) == before
    buckets.upsert(products(spark, 0, 500, 3.0), path)
    # a reader that began before the load still has its folders
    assert rows_of(during) == before
    assert buckets.vacuum(spark, path) >= 1
    assert {r[2] for r in rows_of(buckets.read_buckets(spark, path))} == {3.0}


def test_small_and_odd_loads(spark, tmp_path):
    path = f"{tmp_path}/catalog"
    assert buckets.upsert(products(spark, 0, 0, 1.0), path, buckets=4) == []
    assert buckets.read_buckets(spark, path).count() == 0
    odd = products(spark, 0, 3, 1.0).unionByName(products(spark, 0, 1, 2.0).withColumn("name", F.lit("z")))
    odd = odd.withColumn("sku", F.when(F.col("sku") != "2", F.col("sku")))
    buckets.upsert(odd, path)
    assert sorted(rows_of(buckets.read_buckets(spark, path).fillna("-", "sku"))) == [
        ("-", "n2", 1.0), ("0", "z", 2.0), ("1", "n1", 1.0),
    ]
    assert buckets.upsert(products(spark, 0, 0, 1.0), path) == []
    more = products(spark, 5, 6, 1.0).withColumn("extra", F.lit(1))
    buckets.upsert(more, path)
    assert {r.extra for r in buckets.read_buckets(spark, path).collect()} == {1, None}
