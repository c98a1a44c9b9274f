"""Array functions for nested rows. Arrays here are bounded by one input row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mark_purchased(searched: Column, purchased: Column) -> Column:
    """``[sku]`` -> ``[{sku, purchase_flag}]``."""
    return F.transform(
        searched,
        lambda sku: F.struct(
            sku.alias("sku"),
            F.coalesce(F.array_contains(purchased, sku), F.lit(False)).alias("purchase_flag"),
        ),
    )


def only_purchased(marked: Column) -> Column:
    """``[{sku, purchase_flag}]`` -> purchased skus."""
    kept = F.filter(marked, lambda entry: entry["purchase_flag"])
    return F.transform(kept, lambda entry: entry["sku"])


def size_between(array: Column, low: int, high: int) -> Column:
    return F.size(array).between(low, high)


def element_or_null(array: Column, index: int) -> Column:
    return F.get(array, F.lit(index))


def any_click(docs: Column) -> Column:
    return F.exists(docs, lambda entry: entry["click"] == 1)


def purchase_count(docs: Column) -> Column:
    return F.aggregate(
        docs, F.lit(0).cast("bigint"), lambda total, entry: total + entry["purchase"]
    )


def with_runs(df: DataFrame, items: str, same: Callable[[Column, Column], Column], name: str) -> DataFrame:
    """Add the runs of neighbours in the array ``items`` that are the ``same``, as arrays.

    The starts are a column of their own: an expression used twice is computed once. Unnest what
    is made of runs by ``explode_outer``: for ``explode`` the planner infers a filter on the
    array's size, and pushes it below these columns, which puts the starts into every element.
    """
    starts = F.filter(
        F.transform(items, lambda _, i: i),
        lambda i: (i == 0) | ~same(F.get(items, i - 1), F.get(items, i)),
    )
    runs = F.transform(
        "_starts",
        lambda start, k: F.slice(
            items, start + 1, F.coalesce(F.get("_starts", k + 1), F.size(items)) - start
        ),
    )
    return df.withColumn("_starts", starts).withColumn(name, runs).drop("_starts")
