import pytest
from pyspark.sql import functions as F

from shelfrank.functions import arrays, numbers, text
from shelfrank.functions.sql import register_sql_functions


def one(spark, column, **values):
    frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return frame.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "path, term",
    [
        ("/google+redesign/shop/men++s+t+shirt.axd", "men tshirt"),
        ("/google+redesign/shop/blue+shirt", "blue hirt"),
        ("/google+redesign/shop/men's+short+sleeve", "men's hortsleeve"),
        ("/google+redesign/shop/", ""),
    ],
)
def test_normalize_query(spark, path, term):
    assert one(spark, text.normalize_query(F.lit(path))) == term


@pytest.mark.parametrize(
    "path, found",
    [
        ("/google+redesign/shop/pen", True),
        ("/google+redesign/home", False),
        ("/google+redesign/a.html", False),
        ("/store/pen", False),
    ],
)
def test_search_page(spark, path, found):
    assert one(spark, text.is_search_page(F.lit(path))) is found


@pytest.mark.parametrize("value, rounded", [(2.5, 3), (-2.5, -3), (2.4, 2), (2.4999999999, 3)])
def test_round_to_int(spark, value, rounded):
    assert one(spark, numbers.round_to_int(F.lit(value))) == rounded


def test_clipped_ratio(spark):
    assert one(spark, numbers.clipped_ratio(F.lit(3), F.lit(2))) == 1.0
    assert one(spark, numbers.clipped_ratio(F.lit(1), F.lit(2))) == 0.5
    assert one(spark, numbers.clipped_ratio(F.lit(1), F.lit(0))) == 0.0
    nothing = F.lit(None).cast("bigint")
    assert one(spark, numbers.clipped_ratio(nothing, F.lit(2))) == 0.0
    assert one(spark, numbers.channel_ratio(F.lit(1), nothing)) == 1.0


def test_flags_differ_on_null(spark):
    unknown = F.lit(None).cast("boolean")
    assert one(spark, numbers.flag(unknown)) == 0
    assert one(spark, numbers.nullable_flag(unknown)) is None


def test_context_key_round_trip(spark):
    frame = spark.createDataFrame([("blue pen", "direct", 12)], "a string, b string, c bigint")
    key = frame.select(text.format_context_key(["a", "b", "c"]).alias("key"))
    assert key.first()["key"] == "a:blue pen|b:direct|c:12"
    parsed = key.select(text.parse_context_key(F.col("key")).alias("map")).first()["map"]
    assert parsed == {"a": "blue pen", "b": "direct", "c": "12"}


def test_tokenize(spark):
    words = one(spark, text.tokenize(F.lit("Men's Élan T-Shirt, 2.5 cm!")))
    assert words == ["men's", "élan", "t", "shirt", "2.5", "cm"]
    assert one(spark, text.tokenize(F.lit(None).cast("string"))) == []


def test_mark_purchased(spark):
    searched = F.array(F.lit("a"), F.lit("b"), F.lit("c"))
    marked = arrays.mark_purchased(searched, F.array(F.lit("c"), F.lit("x")))
    assert one(spark, arrays.only_purchased(marked)) == ["c"]


def test_sample_keeps_clicks_and_a_share(spark):
    rows = spark.range(20000).select("id", (F.col("id") % 10 == 0).cast("int").alias("click"))
    kept = rows.filter(numbers.keep_sampled(F.col("click"), 0.05, F.col("id")))
    clicked = kept.filter("click = 1").count()
    assert clicked == 2000
    assert 0.04 < kept.filter("click = 0").count() / 18000 < 0.06
    assert rows.filter(numbers.keep_sampled(F.col("click"), 1.0, F.col("id"))).count() == 20000


def test_sql_functions(spark):
    register_sql_functions(spark)
    row = spark.sql(
        "SELECT process_channel_group('Paid Search') AS c,"
        " filter(process_skus_purchased_from_search(array('a', 'b'), array('b')),"
        "        p -> p.purchase_flag).sku AS s"
    ).first()
    assert (row["c"], row["s"]) == ("paid_search", ["b"])
