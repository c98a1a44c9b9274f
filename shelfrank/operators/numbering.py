"""Row numbers that do not put a whole group, or the whole table, into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.session import cut_lineage

# monotonically_increasing_id keeps the row's place in its partition in the low bits
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def numbered_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, name: str
) -> DataFrame:
    """1-based row number per ``keys`` in ``order``.

    ``chunk`` must not fall as ``order`` rises. Rows are numbered inside
    (keys, chunk) and shifted by the size of the chunks before, so a hot key is
    spread over its chunks; only chunk sizes meet in one place.
    """
    by_chunk = [*keys, "_chunk"]
    rows = df.withColumn("_chunk", chunk)
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        rows.groupBy(*by_chunk)
        .agg(F.count("*").alias("_rows"))
        .select(*by_chunk, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    inside = F.row_number().over(Window.partitionBy(*by_chunk).orderBy(*order))
    return (
        rows.withColumn("_inside", inside)
        .join(starts, by_chunk)
        .withColumn(name, F.col("_start") + F.col("_inside"))
        .drop("_chunk", "_start", "_inside")
    )


def sorted_index(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """0-based place of each row in the global order, computed in parallel.

    ``order`` should end in a unique column so that equal values can be split
    over partitions. The sorted rows are written to the checkpoint folder first:
    the place depends on the partition bounds, which must not be drawn twice.
    """
    placed = cut_lineage(
        df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_slot", _ROW_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition of the sort, so the unpartitioned window stays small
    starts = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_slot").bitwiseAND(F.lit(_ROW_MASK)))
        .drop("_part", "_slot", "_start")
    )


def dense_ids(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """One 0-based id per distinct key, in key order, without gaps."""
    return sorted_index(df.select(*keys).distinct(), keys, name)


def placed_in_groups(
    df: DataFrame, keys: Sequence[str], value: str, unique: str
) -> tuple[DataFrame, DataFrame]:
    """All rows with their place in the order of (keys, value, unique), and per
    group its first place, size, lowest and highest value.
    """
    placed = sorted_index(df, [*keys, value, unique], "_at")
    spans = placed.groupBy(*keys).agg(
        F.min("_at").alias("_first"),
        F.count("*").alias("_n"),
        F.min(value).alias("_low"),
        F.max(value).alias("_high"),
    )
    return placed, spans


def percentiles_of(
    placed: DataFrame,
    spans: DataFrame,
    keys: Sequence[str],
    value: str,
    points: Sequence[float],
    name: str = "percentiles",
) -> DataFrame:
    """Exact percentiles per group of ``spans``, linearly interpolated.

    A percentile is the value at one or two known places. Places are unique in the whole
    table, so they are looked up by an ordinary join that no hot group can skew.
    """
    wanted, picks, results = [], [], []
    for number, point in enumerate(points):
        place = F.lit(float(point)) * (F.col("_n") - 1)
        low, high = F.floor(place), F.ceil(place)
        for slot, at in enumerate((low, high), 2 * number):
            wanted.append(
                F.struct(F.lit(slot).alias("_slot"), (F.col("_first") + at).alias("_at"))
            )
            picks.append(F.max(F.when(F.col("_slot") == slot, F.col(value))).alias(f"_v{slot}"))
        low_value, high_value = F.col(f"_v{2 * number}"), F.col(f"_v{2 * number + 1}")
        results.append(low_value + (high_value - low_value) * (place - low))
    places = spans.select(*keys, "_n", F.explode(F.array(*wanted)).alias("_place")).select(
        *keys, "_n", "_place.*"
    )
    return (
        places.join(placed.select("_at", value), "_at")
        .groupBy(*keys)
        .agg(F.max("_n").alias("_n"), *picks)
        .select(*keys, F.array(*results).alias(name))
    )


def group_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    unique: str,
    points: Sequence[float],
    name: str = "percentiles",
) -> DataFrame:
    """Exact percentiles per group, for groups of any size."""
    placed, spans = placed_in_groups(df.select(*keys, value, unique), keys, value, unique)
    return percentiles_of(placed, spans, keys, value, points, name)
