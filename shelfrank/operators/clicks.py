"""Judgments from closed-form click counts, and their grading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.operators.skew import spread_join
from shelfrank.operators.numbering import percentiles_of, placed_in_groups

# fixed values: grades are the fifths of a search's judgments
GRADE_POINTS = (0.2, 0.4, 0.6, 0.8, 1.0)

# percentile edges carry rounding noise of the interpolation
EDGE = 1e-12


def sdbn(lists: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Simplified dynamic Bayesian network, counted in one aggregate.

    A document is examined down to the last click of its list. Attraction is
    clicks over examinations, satisfaction is last clicks over clicks.
    """
    examined = F.col("list_pos") <= F.col("last_click")
    is_last = F.col("list_pos") == F.col("last_click")
    counts = lists.groupBy(*keys, "doc").agg(
        F.sum(F.when(examined, 1).otherwise(0)).alias("shows"),
        F.sum("click").alias("clicks"),
        F.sum(F.when(is_last, 1).otherwise(0)).alias("last_clicks"),
    )
    alpha = F.when(F.col("shows") > 0, F.col("clicks") / F.col("shows")).otherwise(F.lit(0.0))
    sigma = F.when(F.col("clicks") > 0, F.col("last_clicks") / F.col("clicks")).otherwise(
        F.lit(0.0)
    )
    return counts.select(
        *keys,
        "doc",
        alpha.alias("alpha"),
        sigma.alias("sigma"),
        (alpha * sigma).alias("judgment"),
    )


def grade(judgments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Grade 0 to 4: the first fifth of its search that a judgment fits in.

    Searches whose judgments are all equal are dropped.
    """
    placed, spans = placed_in_groups(judgments, keys, "judgment", "doc")
    informative = spans.filter(F.col("_high") > F.col("_low"))
    edges = percentiles_of(placed, informative, keys, "judgment", GRADE_POINTS, "_edges")
    value = F.lit(len(GRADE_POINTS) - 1)
    for number in reversed(range(len(GRADE_POINTS) - 1)):
        fits = F.col("judgment") <= F.get("_edges", F.lit(number)) + F.lit(EDGE)
        value = F.when(fits, F.lit(number)).otherwise(value)
    return (
        spread_join(placed, edges, keys, spans.select(*keys, "_n"), ["doc"])
        .withColumn("grade", value.cast("int"))
        .select(*judgments.columns, "grade")
    )
