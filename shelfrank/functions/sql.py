"""The scalar functions under a name, for users who write SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DEFINITIONS = (
    """
    CREATE OR REPLACE TEMPORARY FUNCTION process_channel_group(channel STRING)
    RETURNS STRING
    RETURN regexp_replace(lower(channel), ' ', '_')
    """,
    """
    CREATE OR REPLACE TEMPORARY FUNCTION process_skus_purchased_from_search(
        searched ARRAY<STRING>, purchased ARRAY<STRING>)
    RETURNS ARRAY<STRUCT<sku: STRING, purchase_flag: BOOLEAN>>
    RETURN transform(searched, s -> named_struct(
        'sku', s, 'purchase_flag', coalesce(array_contains(purchased, s), false)))
    """,
    """
    CREATE OR REPLACE TEMPORARY FUNCTION log_price_distance(price DOUBLE, ticket DOUBLE)
    RETURNS DOUBLE
    RETURN log1p(abs(price - ticket))
    """,
)


def register_sql_functions(spark: SparkSession) -> None:
    for definition in DEFINITIONS:
        spark.sql(definition)


def run_sql(spark: SparkSession, text: str, **parameters: object) -> DataFrame:
    """Run SQL text with named parameter markers (``:name``), never formatted in."""
    return spark.sql(text, args=parameters)
