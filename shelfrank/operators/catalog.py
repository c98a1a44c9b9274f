"""Product catalog with click-through rates, keyed by sku."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.functions import numbers, text
from shelfrank.schemas import CATALOG_DOCUMENT, CHANNELS, require_schema

CTR_COLUMNS = [f"ctr_{field}" for field in CHANNELS.values()]

DOCUMENT_COLUMNS = [
    "sku",
    "name",
    "category",
    "price",
    "impressions",
    "clicks",
    "ctr",
    *CTR_COLUMNS,
]


def product_channel(hits: DataFrame) -> DataFrame:
    """Impressions, clicks and price per session, channel and product variant."""
    return hits.groupBy("session_id", "channel", "sku", "category", "name").agg(
        F.sum(numbers.nullable_flag(F.col("is_impression"))).alias("impressions"),
        F.sum(numbers.nullable_flag(F.col("is_click"))).alias("clicks"),
        F.avg(numbers.micros_to_units(F.col("price_micros"))).alias("price"),
    )


def catalog_rows(products: DataFrame, distinct_rows: bool = True) -> DataFrame:
    """One row per sku, channel, name and category.

    Totals of a sku are taken over all session rows. Channel clicks and
    impressions are summed over *distinct* rows, so equal rows of two sessions
    count once (``distinct_rows=False`` counts each). Session rows are first
    combined into distinct ones with their number, which serves both sums in one
    pass and leaves only a sku's variants for the window over it.
    """
    variant = ["sku", "channel", "name", "category"]
    combined = (
        products.withColumn("category", text.clean_category(F.col("category")))
        .groupBy(*variant, "impressions", "clicks")
        .agg(
            F.count("*").alias("n"),
            F.sum("price").alias("price_sum"),
            F.count("price").alias("price_n"),
        )
    )
    times = F.lit(1) if distinct_rows else F.col("n")
    per_variant = combined.groupBy(*variant).agg(
        F.sum(F.col("impressions") * times).alias("channel_impressions"),
        F.sum(F.col("clicks") * times).alias("channel_clicks"),
        F.sum(F.col("impressions") * F.col("n")).alias("all_impressions"),
        F.sum(F.col("clicks") * F.col("n")).alias("all_clicks"),
        F.sum("price_sum").alias("price_sum"),
        F.sum("price_n").alias("price_n"),
    )
    whole = Window.partitionBy("sku")
    totals = (
        per_variant.withColumn("impressions", F.sum("all_impressions").over(whole))
        .withColumn("clicks", F.sum("all_clicks").over(whole))
        .withColumn(
            "price",
            F.try_divide(F.sum("price_sum").over(whole), F.sum("price_n").over(whole)),
        )
        .filter(F.col("impressions") > 0)
    )
    own = numbers.channel_ratio(F.col("channel_clicks"), F.col("channel_impressions"))
    return totals.select(
        *variant,
        F.coalesce("price", F.lit(0.0)).alias("price"),
        F.coalesce("impressions", F.lit(0)).alias("impressions"),
        F.coalesce("clicks", F.lit(0)).alias("clicks"),
        numbers.clipped_ratio(F.col("clicks"), F.col("impressions")).alias("ctr"),
        *numbers.channel_columns(F.col("channel"), own),
    )


def last_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last row per key in ``order``; combined on the map side.

    NULL sorts first in ``order``.
    """
    # max_by skips NULL orderings but not NULL parts of a struct
    place = F.struct(*[F.col(name) for name in order])
    rest = [name for name in df.columns if name != key]
    return (
        df.groupBy(key)
        .agg(F.max_by(F.struct(*rest), place).alias("_last"))
        .select(key, "_last.*")
    )


def catalog_docs(rows: DataFrame, mode: str = "merge") -> DataFrame:
    """One document per sku.

    ``last`` keeps the last row by channel, name and category, so at most one
    channel rate is above zero. ``merge`` takes the highest rate per channel and
    everything else from that last row.
    """
    order = ["channel", "name", "category"]
    if mode == "last":
        return last_per_key(rows, "sku", order).select(*DOCUMENT_COLUMNS)
    if mode != "merge":
        raise ValueError(f"unknown mode: {mode}")
    place = F.struct(*[F.col(name) for name in order])
    last = F.struct("name", "category", "price", "impressions", "clicks", "ctr")
    return (
        rows.groupBy("sku")
        .agg(
            F.max_by(last, place).alias("_last"),
            *[F.max(name).alias(name) for name in CTR_COLUMNS],
        )
        .select("sku", "_last.*", *CTR_COLUMNS)
        .select(*DOCUMENT_COLUMNS)
    )


def upsert_catalog(current: DataFrame | None, incoming: DataFrame, order: str) -> DataFrame:
    """Documents after a load: the last write per sku wins, old rows come first."""
    fresh = incoming.withColumn("_load", F.lit(1))
    rows = fresh
    if current is not None:
        rows = current.withColumn("_load", F.lit(0)).unionByName(
            fresh, allowMissingColumns=True
        )
    return last_per_key(rows, "sku", ["_load", order]).drop("_load")


def to_documents(docs: DataFrame) -> DataFrame:
    """Flat catalog -> nested documents of the strict schema."""
    rates = F.struct(
        *[
            F.struct(F.col(f"ctr_{field}").cast("float").alias("CTR")).alias(field)
            for field in CHANNELS.values()
        ]
    )
    whole = F.struct(
        F.col("impressions").cast("int").alias("impressions"),
        F.col("clicks").cast("int").alias("clicks"),
        F.col("ctr").cast("float").alias("CTR"),
    )
    nested = docs.select(
        "sku",
        "name",
        "category",
        F.col("price").cast("float").alias("price"),
        F.struct(whole.alias("global"), rates.alias("channel")).alias("performances"),
    )
    return require_schema(nested, CATALOG_DOCUMENT)


def from_documents(documents: DataFrame) -> DataFrame:
    """Nested documents -> flat catalog."""
    checked = require_schema(documents, CATALOG_DOCUMENT)
    return checked.select(
        "sku",
        "name",
        "category",
        F.col("price").cast("double").alias("price"),
        F.col("performances.global.impressions").cast("bigint").alias("impressions"),
        F.col("performances.global.clicks").cast("bigint").alias("clicks"),
        F.col("performances.global.CTR").cast("double").alias("ctr"),
        *[
            F.col(f"performances.channel.{field}.CTR").cast("double").alias(f"ctr_{field}")
            for field in CHANNELS.values()
        ],
    )
