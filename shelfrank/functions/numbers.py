"""Numeric functions: money, flags, ratios, feature values, hashing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfrank.schemas import CHANNELS

# fixed values: CTR is scaled by ten as a feature and as a boost
CTR_FACTOR = 10.0

# Sums of doubles depend on the order in which partitions arrive. Averages that
# become keys are cut to nine decimals first, so that this cannot move a value
# over a rounding edge or split a group.
KEY_DECIMALS = 9


def micros_to_units(micros: Column) -> Column:
    return micros / F.lit(1e6)


def flag(condition: Column) -> Column:
    """1 when true, else 0 (NULL counts as 0)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def nullable_flag(condition: Column) -> Column:
    """1 / 0, NULL stays NULL."""
    return condition.cast("int")


def round_to_int(value: Column) -> Column:
    """Integer cast that rounds half away from zero."""
    return F.round(F.round(value, KEY_DECIMALS)).cast("bigint")


def stable(value: Column) -> Column:
    return F.round(value, KEY_DECIMALS)


def clipped_ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` held to at most 1; 0 where it is undefined."""
    ratio = F.try_divide(part.cast("double"), whole.cast("double"))
    return F.coalesce(F.when(ratio > 1, F.lit(1.0)).otherwise(ratio), F.lit(0.0))


def channel_ratio(clicks: Column, impressions: Column) -> Column:
    """Clipped CTR of one channel; missing or zero impressions count as one."""
    shown = F.coalesce(F.nullif(impressions, F.lit(0)), F.lit(1))
    return clipped_ratio(clicks, shown)


def channel_columns(channel: Column, ctr: Column) -> list[Column]:
    """One CTR column per known channel, 0 for all but the row's own channel."""
    return [
        F.when(channel == label, ctr).otherwise(F.lit(0.0)).alias(f"ctr_{field}")
        for label, field in CHANNELS.items()
    ]


def log_price_distance(price: Column, ticket: Column) -> Column:
    return F.log1p(F.abs(price - ticket))


def channel_ctr_feature(channel_group: Column) -> Column:
    """CTR of the context's channel times ten; 0 for an unknown channel."""
    value = F.lit(0.0)
    for field in CHANNELS.values():
        value = F.when(channel_group == field, F.col(f"ctr_{field}")).otherwise(value)
    return F.coalesce(value, F.lit(0.0)) * CTR_FACTOR


def ctr_boost(ctr: Column) -> Column:
    return F.coalesce(ctr, F.lit(0.0)) * CTR_FACTOR


def hash_fraction(*parts: Column) -> Column:
    """A repeatable number in [0, 1) per key, from the first 32 bits of its MD5."""
    digest = F.md5(F.concat_ws("|", *[part.cast("string") for part in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def keep_sampled(click: Column, rate: float, *key: Column) -> Column:
    """Every clicked row, and a share ``rate`` of the others."""
    if rate >= 1.0:
        return F.lit(True)
    return (click == 1) | (hash_fraction(*key) < F.lit(float(rate)))
