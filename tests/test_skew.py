"""Hot keys without help from session settings."""

import pytest
from pyspark.sql import functions as F

from shelfrank.operators import clicks, features, skew, training

PLAIN = {
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def plain(spark):
    """No adaptive plans and no broadcasts by size: only what an operator does itself."""
    before = {key: spark.conf.get(key) for key in PLAIN}
    for key, value in PLAIN.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


def hot_rows(spark, many=12_000):
    """A third of all rows under one key."""
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 500)
    return spark.range(many).select(key.alias("k"), F.col("id").alias("doc"))


def largest(df):
    # all columns are asked for, or a join might be left out
    sizes = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.max(F.xxhash64(*df.columns)))
    return sizes.agg(F.max("n")).first()[0]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_hot_key_is_spread(plain, how):
    rows = hot_rows(plain)
    side = rows.groupBy("k").agg(F.sum("doc").alias("s")).where("k <> 7")
    sizes = rows.groupBy("k").count()
    whole = rows.join(side, ["k"], how)
    spread = skew.spread_join(rows, side, ["k"], sizes, ["doc"], how, rows_per_part=250)
    assert sorted(spread.columns) == sorted(whole.columns)
    names = whole.columns
    assert sorted(map(tuple, spread.select(*names).collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    assert largest(spread) < 2000
    if how == "inner":
        assert largest(whole) > 4000


def test_few_keys_are_broadcast(plain, monkeypatch):
    rows = hot_rows(plain)
    sizes = rows.groupBy("k").agg(F.count("*").alias("n"))
    side = rows.groupBy("k").agg(F.max("doc").alias("m"))
    monkeypatch.setattr(skew, "MOST_HEAVY", 3)
    # keys are split from a third of all rows on
    found = skew.spread_join(rows, side, ["k"], sizes, ["doc"], rows_per_part=1)
    assert found.count() == rows.count() and largest(found) >= 4000


@pytest.mark.parametrize("name", ["grade", "normalise", "gradients"])
def test_operators_spread_hot_lists(plain, monkeypatch, name):
    rows = hot_rows(plain, 6000)
    monkeypatch.setattr(skew.spread_join, "__defaults__", ("inner", 250))
    if name == "grade":
        judged = rows.select(F.col("k").alias("query"), "doc", ((F.col("doc") * 37 % 101) / 100).alias("judgment"))
        found = clicks.grade(judged, ["query"])
    elif name == "normalise":
        found = features.normalise(
            rows.select(F.col("k").alias("qid"), "doc", F.array(F.col("doc").cast("double")).alias("features")), 1
        )
    else:
        scored = rows.select(
            F.col("k").alias("qid"), F.col("doc").cast("string").alias("doc"),
            (F.col("doc") % 5).cast("double").alias("grade"), F.lit(0.0).alias("F"),
        )
        found = training.lambda_gradients(scored)
    assert found.count() == 6000 and largest(found) < 1200
