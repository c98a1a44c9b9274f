"""Maps the test tables to the session-log schema.

``event_hits``     events + part, one product per hit; many small sessions
``order_hits``     orders + lineitem, five search terms; very hot search terms
``event_sessions`` events as nested visits, one row per visit, built in the row
``nested_event_hits`` the sessions of ``event_hits`` as nested rows, as a log stores them
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.operators.skew import tasks_for
from shelfrank.schemas import CHANNELS

_SHOP = "/google+redesign/shop/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _channel(number: Column) -> Column:
    """Eight numbers, seven channels: the last one has no channel."""
    value = F.lit(None).cast("string")
    for position, label in enumerate(CHANNELS):
        value = F.when(number == position, F.lit(label)).otherwise(value)
    return value


def _event_key() -> Column:
    return F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")


def event_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "ts", _event_key().alias("p_partkey")
    )
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_type", "p_brand", "p_retailprice"
    )
    window = F.floor((F.dayofmonth("ts") - 1) / 10).cast("bigint")
    page = (
        F.when(F.col("event_type") == "signup", F.lit("/google+redesign/home"))
        .when(F.col("event_type") == "error", F.lit("/google+redesign/err.html"))
        .otherwise(
            F.concat(
                F.lit(_SHOP),
                F.split_part(F.col("p_name"), F.lit(" "), F.lit(2)),
                F.when(F.col("event_id") % 2 == 0, F.lit(".axd")).otherwise(F.lit("")),
            )
        )
    )
    return events.join(part, "p_partkey").select(
        F.col("user_id").alias("fv"),
        (F.col("user_id") * 10 + window).alias("session_id"),
        F.to_date("ts").alias("session_date"),
        _channel((F.col("user_id") + window) % 8).alias("channel"),
        F.col("event_id").alias("hit_pos"),
        F.lit(0).cast("bigint").alias("product_pos"),
        F.col("event_id").alias("place"),
        page.alias("pagepath"),
        F.when(F.col("event_type") == "purchase", F.lit("6"))
        .otherwise(F.lit("0"))
        .alias("action_type"),
        F.when(F.col("event_id") % 97 == 0, F.lit("(not set)"))
        .otherwise(F.col("p_partkey").cast("string"))
        .alias("sku"),
        F.col("p_name").alias("name"),
        F.concat("p_type", F.lit("/"), "p_brand").alias("category"),
        F.round((F.col("p_retailprice") - 900) * 10 * 1000000).cast("bigint").alias("price_micros"),
        F.when(F.col("event_type") == "click", F.lit(True)).alias("is_click"),
        F.when(F.col("event_type") == "view", F.lit(True)).alias("is_impression"),
    )


def nested_event_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per session; each hit is a page with one product."""
    product = F.struct("sku", "name", "category", "price_micros", "is_click", "is_impression")
    page = F.struct("hit_pos", "pagepath", "action_type", F.array(product).alias("product"))
    pages = F.array_sort(F.collect_list(page))
    return (
        event_hits(spark, sf_dir)
        .groupBy("fv", "session_id", "channel")
        .agg(F.min("session_date").alias("session_date"), pages.alias("hits"))
        .withColumn("hits", F.transform("hits", lambda x: x.dropFields("hit_pos")))
    )


def order_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"
    )
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_returnflag"
    )
    term = F.replace(
        F.lower(F.substring("o_orderpriority", 3, 40)), F.lit(" "), F.lit("+")
    )
    # what follows per session stays in the tasks of this join, so their number goes by the rows;
    # with a share for each core or less, the planner chooses
    if (tasks := tasks_for(items)) > spark.sparkContext.defaultParallelism:
        items = items.repartition(tasks, "l_orderkey")
        orders = orders.repartition(tasks, "o_orderkey")
    return items.join(orders, items.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("fv"),
        F.col("o_orderkey").alias("session_id"),
        F.to_date("o_orderdate").alias("session_date"),
        _channel(F.col("o_custkey") % 8).alias("channel"),
        F.col("l_linenumber").cast("bigint").alias("hit_pos"),
        F.col("l_partkey").alias("product_pos"),
        # keys stay below 2^48 and line numbers below 2^15
        (F.shiftleft(F.col("l_linenumber").cast("bigint"), 48) + F.col("l_partkey")).alias(
            "place"
        ),
        F.concat(F.lit(_SHOP), term).alias("pagepath"),
        F.when(F.col("l_returnflag") == "R", F.lit("6")).otherwise(F.lit("0")).alias("action_type"),
        F.col("l_partkey").cast("string").alias("sku"),
        F.round(F.col("l_extendedprice") / F.col("l_quantity") * 1000000)
        .cast("bigint")
        .alias("price_micros"),
        F.when(F.col("l_returnflag") != "N", F.lit(True)).alias("is_click"),
        F.lit(True).alias("is_impression"),
    )


def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One visit per event: a result page of 0 to 3 products, then an action page."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "ts", _event_key().alias("k")
    )
    window = F.floor((F.dayofmonth("ts") - 1) / 10).cast("bigint")
    clicked = F.col("event_type") == "click"

    def product(offset: Column) -> Column:
        key = F.col("k") + offset
        return F.struct(
            F.when(key % 10 == 9, F.lit("(not set)")).otherwise(key.cast("string")).alias("sku"),
            F.concat(F.lit("item "), key.cast("string")).alias("name"),
            F.lit("all/items").alias("category"),
            (key * 1000000).alias("price_micros"),
            F.when(clicked & (offset == 0), F.lit(True)).alias("is_click"),
            F.when(F.col("event_type") == "view", F.lit(True)).alias("is_impression"),
        )

    listed = F.transform(
        F.slice(F.sequence(F.lit(0), F.lit(2)), F.lit(1), (F.col("event_id") % 4).cast("int")),
        product,
    )
    page = (
        F.when(F.col("event_type") == "signup", F.lit("/google+redesign/home"))
        .when(F.col("event_type") == "error", F.lit("/google+redesign/err.html"))
        .otherwise(
            F.concat(
                F.lit(_SHOP), F.col("event_type"), F.lit("+"), (F.col("k") % 10).cast("string")
            )
        )
    )
    hits = F.array(
        F.struct(
            page.alias("pagepath"), F.lit("0").alias("action_type"), listed.alias("product")
        ),
        F.struct(
            F.lit("/google+redesign/basket.html").alias("pagepath"),
            F.when(F.col("event_type") == "purchase", F.lit("6"))
            .otherwise(F.lit("0"))
            .alias("action_type"),
            F.array(product(F.lit(0))).alias("product"),
        ),
    )
    return events.select(
        F.col("user_id").alias("fv"),
        F.col("event_id").alias("session_id"),
        F.to_date("ts").alias("session_date"),
        _channel((F.col("user_id") + window) % 8).alias("channel"),
        hits.alias("hits"),
    )
