"""Ranking metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values: the highest grade, and the depth of the training metric
MAX_GRADE = 4
DEPTH = 10


def gain(grade: Column, highest: int = MAX_GRADE) -> Column:
    """Chance that a document of this grade satisfies; a grade above ``highest`` is an error."""
    valid = F.when(grade > highest, F.raise_error(F.lit(f"a grade is above {highest}"))).otherwise(
        grade
    )
    return (F.pow(F.lit(2.0), valid) - 1) / F.lit(float(2**highest))


def err_at_k(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], grade: str = "grade", k: int = DEPTH, highest: int = MAX_GRADE
) -> DataFrame:
    """Expected reciprocal rank per list.

    Only the first ``k`` rows of a list count, and ``row_number() <= k`` is
    applied before the exchange as well as after it, so long lists stay apart.
    """
    in_list = Window.partitionBy(*keys)
    top = df.withColumn("_rank", F.row_number().over(in_list.orderBy(*order))).filter(
        F.col("_rank") <= k
    )
    above = in_list.orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    passed = F.exp(F.coalesce(F.sum(F.log1p(-gain(F.col(grade), highest))).over(above), F.lit(0.0)))
    return (
        top.withColumn("_passed", passed)
        .groupBy(*keys)
        .agg(F.sum(gain(F.col(grade), highest) * F.col("_passed") / F.col("_rank")).alias("err"))
    )


def mean_percentile_rank(
    retrieved: DataFrame,
    purchases: DataFrame,
    keys: Sequence[str],
    key: str = "sku",
    by: Sequence[str] = (),
    each: Sequence[str] = (),
) -> DataFrame:
    """Mean place of purchased documents, 0 at the top to 1 at the end; lower is better.

    ``retrieved`` has 0-based ``pos`` per search; searches with one result are
    left out; 0.5 where no purchase was retrieved. One row, or one per ``by``.
    Equal purchases of a search count once, unless ``each`` tells them apart.
    """
    lengths = retrieved.groupBy(*keys).agg((F.max("pos") + 1).alias("n"))
    bought = purchases.select(*keys, *each, key).distinct()
    places = (
        retrieved.join(bought, [*keys, key])
        .join(lengths.filter(F.col("n") >= 2), list(keys))
        .select(*by, (F.col("pos") / (F.col("n") - 1)).alias("place"))
    )
    found = places.groupBy(*by).agg(
        F.sum("place").alias("_num"), F.count("*").alias("_den")
    )
    value = F.coalesce(F.try_divide("_num", "_den"), F.lit(0.5)).alias("rank")
    if not by:
        return found.select(value)
    sets = purchases.select(*by).distinct()
    return sets.join(found, list(by), "left").select(*by, value)
