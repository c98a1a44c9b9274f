"""Near duplicates: banded MinHash candidates, sequential Bayesian verification, exact check.

1. Each text becomes its set of word shingles. Texts with equal sets are one class, named by
   its smallest id; only classes go on, so copies cost nothing more.
2. ``BANDS`` bands of ``ROWS`` MinHash values make buckets. At a similarity of 0.8 a pair
   shares no bucket with probability (1 - 0.8 ** 5) ** 32 = 3e-6.
3. Buckets are not expanded into pairs. First each bucket's smallest id is compared with the
   other members, which joins most of them into components. Where a bucket still has several
   components, its members are dealt into blocks; a task compares two blocks, only pairs of
   different components, each pair in the first band it shares, and gives out only links. So
   every pair of a bucket that is not connected otherwise is compared, and none is expanded.
4. Pairs are compared ``BATCH`` signature values at a time. With m of n values equal and a
   uniform prior, P(similarity >= threshold | m, n) = P(Bin(n + 1, threshold) <= m); a pair
   is dropped as soon as this falls under ``MISS``.
5. Survivors are checked on their full sets (64-bit shingle hashes).

Nulls: a null or empty text has no shingles and is linked with nothing; it is its own
component. A row with a null id is linked with nothing and has a null component. Rows of one
id are one document: they have the same component, and a link of one links all. Repeated
rows stay rows.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.llm import shingles
from shelfrank.llm.components import components
from shelfrank.llm.shared import comparable, written

BANDS = 32
ROWS = 5
BATCH = 32
MISS = 1e-6
PERCENT = 80
BLOCK_BYTES = 8 << 20  # sets of a block; a task holds two blocks


@functools.cache
def least_matches(count: int, batch: int, threshold: float, miss: float) -> tuple[int, ...]:
    """For n = batch, 2 batch, …: the fewest equal values with posterior >= ``miss``."""

    def posterior(m: int, n: int) -> float:
        terms = (
            math.comb(n + 1, i) * threshold**i * (1 - threshold) ** (n + 1 - i)
            for i in range(m + 1)
        )
        return sum(terms)

    return tuple(
        next(m for m in range(n + 1) if posterior(m, n) >= miss)
        for n in range(batch, count + 1, batch)
    )


def survives(left: np.ndarray, right: np.ndarray, percent: int, batch: int, miss: float) -> np.ndarray:
    """Which rows of two signature matrices pass every batch's bound."""
    alive = np.arange(len(left))
    equal = np.zeros(len(left), int)
    for i, least in enumerate(least_matches(left.shape[1], batch, percent / 100, miss)):
        part = slice(i * batch, (i + 1) * batch)
        equal[alive] += (left[alive, part] == right[alive, part]).sum(1)
        alive = alive[equal[alive] >= least]
    passed = np.zeros(len(left), bool)
    passed[alive] = True
    return passed


def similar(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    """Whether intersection / union of two sorted sets is at least ``percent`` / 100."""
    common = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * common >= percent * (len(left) + len(right) - common)


def described(df: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """``id, n, set_key, bands`` of each row; rows without shingles have no bands."""

    def describe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashing = shingles.MinHash(BANDS * ROWS)
        for frame in frames:
            found = []
            for x in frame["text"]:
                values = shingles.shingle_set(x, size)
                bands = shingles.band_keys(hashing.signature(values), BANDS) if len(values) else []
                found.append((len(values), shingles.set_key(values), bands))
            columns = list(zip(*found, strict=True)) or [(), (), ()]
            yield pd.DataFrame(
                {"id": frame["id"], "n": columns[0], "set_key": columns[1], "bands": columns[2]}
            )

    rows = df.select(
        F.col(key).cast("string").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    out = rows.mapInPandas(describe, "id string, n long, set_key binary, bands array<long>")
    return out.withColumn("id", F.col("id").cast("long"))


def active_sets(df: DataFrame, key: str, text: str, ids: DataFrame, size: int) -> DataFrame:
    """``id, signature, shingles`` (binary) for the documents in ``ids``."""

    def describe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashing = shingles.MinHash(BANDS * ROWS)
        for frame in frames:
            for start in range(0, len(frame), 500):
                some = frame.iloc[start : start + 500]
                sets = [shingles.shingle_set(x, size) for x in some["text"]]
                yield pd.DataFrame(
                    {
                        "id": some["id"],
                        "signature": [hashing.signature(s).tobytes() for s in sets],
                        "shingles": [s.tobytes() for s in sets],
                    }
                )

    rows = df.select(
        F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    return rows.join(ids, "id", "left_semi").mapInPandas(
        describe, "id long, signature binary, shingles binary"
    )


def both_sides(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    """``pairs`` with ``left`` and ``right``: the column of ``sets`` for either id."""
    side = sets.select("id", column)
    return pairs.join(
        side.select(F.col("id").alias("a"), F.col(column).alias("left")), "a"
    ).join(side.select(F.col("id").alias("b"), F.col(column).alias("right")), "b")


def links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` that survive the bounds and are similar on their full sets."""

    @F.pandas_udf("boolean")
    def plausible(left: pd.Series, right: pd.Series) -> pd.Series:
        matrices = [np.frombuffer(b"".join(x), np.uint32).reshape(len(x), -1) for x in (left, right)]
        return pd.Series(survives(*matrices, percent, BATCH, MISS))

    @F.pandas_udf("boolean")
    def confirmed(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series(
            [
                similar(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), percent)
                for a, b in zip(left, right, strict=True)
            ]
        )

    likely = written(
        both_sides(pairs, sets, "signature").where(plausible("left", "right")).select("a", "b")
    )
    return both_sides(likely, sets, "shingles").where(confirmed("left", "right")).select("a", "b")


def star_pairs(members: DataFrame) -> DataFrame:
    """``a, b``: the smallest id of every bucket with each of its other members."""
    first = members.groupBy("bucket").agg(F.min("id").alias("a"))
    pairs = members.select("bucket", F.col("id").alias("b")).join(first, "bucket")
    return pairs.where("a < b").select("a", "b").distinct()


def dealt_blocks(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``members`` dealt into pairs of blocks, with their signatures and sets.

    A bucket's members, by id, fill blocks of ``BLOCK_BYTES``. Every pair of blocks of a bucket
    (``low``, ``high``) is a group of rows, so a group is bounded however large its bucket.
    """
    sizes = sets.groupBy("id").agg(F.sum(F.octet_length("shingles") + 1024).alias("bytes"))
    so_far = Window.partitionBy("bucket").orderBy("id")
    blocked = members.join(sizes, "id").withColumn(
        "block", F.floor((F.sum("bytes").over(so_far) - F.col("bytes")) / BLOCK_BYTES).cast("int")
    )
    last = blocked.groupBy("bucket").agg(F.max("block").alias("last"))
    other = F.explode(F.sequence(F.lit(0), F.col("last")))
    return (
        blocked.join(last, "bucket")
        .select("bucket", "band", "id", "component", "block", other.alias("other"))
        .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
        .join(sets, "id")
        .repartition("bucket", "low", "high")
        .sortWithinPartitions("bucket", "low", "high", "block", "id")
        .select(
            "bucket", "low", "high", "block", "band", "id", "component", "signature", "shingles"
        )
    )


def groups(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Runs of rows with equal keys, also across batches."""
    rest: pd.DataFrame | None = None
    for frame in frames:
        if rest is not None:
            frame = pd.concat([rest, frame], ignore_index=True)
        values = frame[keys].to_numpy()
        edges = np.flatnonzero((values[1:] != values[:-1]).any(1)) + 1
        for start, stop in zip([0, *edges], edges, strict=False):
            yield frame.iloc[start:stop]
        rest = frame.iloc[edges[-1] if len(edges) else 0 :]
    if rest is not None and len(rest):
        yield rest


def linked_in_group(group: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """Links between members of different components in one group of blocks.

    A pair that shares an earlier band is left to that band's bucket. Links that join what
    others of the group have joined already are left out.
    """
    ids = group["id"].to_numpy()
    label = group["component"].to_numpy().copy()
    if (label == label[0]).all():
        return []
    block, band = group["block"].to_numpy(), int(group["band"].iloc[0])
    signature = np.frombuffer(b"".join(group["signature"]), np.uint32).reshape(len(ids), -1)
    keys = np.stack([shingles.band_keys(row, BANDS)[:band] for row in signature])
    sets = [np.frombuffer(x, np.uint64) for x in group["shingles"]]
    one_block = (group["low"] == group["high"]).iloc[0]
    found = []
    for i in range(len(ids) - 1):
        later = np.arange(i + 1, len(ids))
        if not one_block:
            later = later[block[later] != block[i]]
        later = later[label[later] != label[i]]
        later = later[~(keys[later] == keys[i]).any(1)]
        if not len(later):
            continue
        own = np.broadcast_to(signature[i], (len(later), signature.shape[1]))
        for j in later[survives(own, signature[later], percent, BATCH, MISS)]:
            if label[j] != label[i] and similar(sets[i], sets[j], percent):
                found.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
                label[label == label[j]] = label[i]
    return found


def block_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between members of a bucket that are in different components."""

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in groups(frames, ["bucket", "low", "high"]):
            found = linked_in_group(group, percent)
            if found:
                yield pd.DataFrame(found, columns=["a", "b"])

    return dealt_blocks(members, sets).mapInPandas(compare, "a long, b long").distinct()


def merge(known: DataFrame, found: DataFrame) -> DataFrame:
    """``known (id, component)`` after joining the components of every link ``a, b``."""
    of = known.select(F.col("id").alias("a"), F.col("component").alias("left"))
    to = known.select(F.col("id").alias("b"), F.col("component").alias("right"))
    between = written(
        found.join(of, "a")
        .join(to, "b")
        .select(F.col("left").alias("a"), F.col("right").alias("b"))
        .where("a <> b")
        .distinct()
    )
    if between.isEmpty():
        return known
    merged = components(between).withColumnRenamed("node", "component")
    return written(
        known.join(merged, "component", "left").select(
            "id", F.coalesce("label", "component").alias("component")
        )
    )


def linked_components(
    sets: DataFrame, members: DataFrame, bridges: DataFrame, percent: int
) -> DataFrame:
    """``id, component`` of all ids that share a bucket or a bridge with another."""
    ids = members.select("id").union(bridges.select("a")).union(bridges.select("b")).distinct()
    known = merge(written(ids.select("id", F.col("id").alias("component"))), bridges)
    known = merge(known, links(written(star_pairs(members)), sets, percent))
    now = members.join(known, "id").select("bucket", "band", "id", "component")
    several = (
        now.groupBy("bucket")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high")
        .select("bucket")
    )
    several = written(now.join(several, "bucket", "left_semi"))
    return merge(known, written(block_links(several, sets, percent)))


def find_near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 2, percent: int = PERCENT
) -> DataFrame:
    """``key, n_shingles, component_id, kept`` for every row of ``df``."""
    rows = written(described(df, key, text, size))
    named = rows.where("id IS NOT NULL AND n > 0")
    classes = written(
        named.groupBy("set_key").agg(
            F.min("id").alias("first"),
            F.count("*").alias("copies"),
            F.first("bands").alias("bands"),  # equal in a class
        )
    )
    repeated = classes.where("copies > 1").select("set_key", "first")
    copies = written(
        named.select("set_key", "id").join(repeated, "set_key").where("id <> first").select("id", "first").distinct()
    )
    # a document of several rows with different sets links their classes
    several = (
        named.groupBy("id")
        .agg(F.min("set_key").alias("low"), F.max("set_key").alias("high"))
        .where("low < high")
    )
    bridges = copies.join(several, "id", "left_semi").select(F.col("id").alias("a"), F.col("first").alias("b"))
    single = classes.select(
        F.col("first").alias("id"), F.posexplode("bands").alias("band", "bucket")
    )
    shared = single.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    members = written(
        single.join(shared.where("low < high").select("bucket"), "bucket", "left_semi").distinct()
    )
    ids = written(members.select("id").distinct())
    sets = written(active_sets(df, key, text, ids, size))
    known = linked_components(sets, members, written(bridges), percent)
    first = copies.groupBy("id").agg(F.min("first").alias("first"))
    placed = (
        rows.select("id", "n")
        .join(first, "id", "left")
        .withColumn("of", F.when(F.col("n") > 0, F.coalesce("first", "id")).otherwise(F.col("id")))
        .join(known.select(F.col("id").alias("of"), "component"), "of", "left")
        .withColumn("component_id", F.coalesce("component", "of"))
    )
    return placed.select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        "component_id",
        (F.col("id").isNull() | (F.col("id") == F.col("component_id"))).alias("kept"),
    )


def keep_first(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 2, percent: int = PERCENT) -> DataFrame:
    """The rows of ``df`` whose document is the first of its group; one row per document.

    Rows with a null id stay. Of several rows with a kept id, the least row stays.
    """
    found = find_near_duplicates(df, key, text, size, percent)
    gone = written(found.where("NOT kept").select(F.col(key).alias("_gone")).distinct())
    rows = df.select(F.struct("*").alias("row"), F.col(key).alias("_id"))
    left = rows.join(gone, F.col("_id") == F.col("_gone"), "left_anti")
    counts = df.where(F.col(key).isNotNull()).groupBy(key).count()
    if not counts.where("count > 1").isEmpty():
        place = F.struct(*(F.col("row").getField(name.strip("`")) for name in comparable(df)))
        one = left.where("_id IS NOT NULL").groupBy("_id").agg(F.min_by("row", place).alias("row"))
        left = left.where("_id IS NULL").select("_id", "row").unionByName(one)
    return left.select("row.*")
