"""Joins that spread hot keys, whatever the session's settings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_PART = 250_000  # rows of one key that go to one task
ROWS_PER_TASK = 250_000  # rows that one task joins and sorts
MOST_HEAVY = 100_000  # keys that are broadcast at most


def spread_join(
    rows: DataFrame,
    side: DataFrame,
    keys: Sequence[str],
    sizes: DataFrame,
    by: Sequence[str],
    how: str = "inner",
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """``rows`` joined with ``side``, which has one row per key.

    ``sizes`` has the keys and, as its last column, their numbers of rows; it is read twice.
    Only keys of more than ``rows_per_part`` rows are split: their rows go to several tasks by
    a hash of the columns ``by``, and their row of ``side`` goes to each of these. The list of
    these keys is broadcast; there are at most ``MOST_HEAVY``, since keys of less than that
    share of all rows are not split.
    """
    size = sizes.columns[-1]
    total = sizes.agg(F.sum(size).alias("n")).scalar()
    most = F.greatest(F.lit(rows_per_part), F.ceil(total / MOST_HEAVY))
    parts = F.ceil(F.col(size) / most).cast("int").alias("_parts")
    heavy = F.broadcast(sizes.select(*keys, parts).filter(F.col("_parts") > 1))
    own = F.coalesce("_parts", F.lit(1))
    salt = F.pmod(F.xxhash64(*by), own).cast("int")
    salted = rows.join(heavy, list(keys), "left").withColumn("_salt", salt).drop("_parts")
    each = F.explode(F.sequence(F.lit(0), own - 1))
    copies = side.join(heavy, list(keys), "left").withColumn("_salt", each).drop("_parts")
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")


def tasks_for(table: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Tasks among which the rows of a stored table are dealt, so that a task's share stays the same.

    Merged by bytes, as the planner does it, a task gets as many rows as compress well. Counting
    a table of files reads their footers only.
    """
    return -(-table.count() // rows_per_task)
