"""Trie of conversation prefixes in minimal-perfect-hash node tables.

1. Turns are placed by one sorted, parallel numbering; ``rebuilt`` then gives every conversation
   the first turns of another one.
2. Each turn hashes to ``LANES`` numbers together with its depth; their running sums along a
   conversation are the digests of its prefixes. Sums run in blocks of ``BLOCK`` turns, so a
   conversation of any length is spread over tasks.
3. Distinct digests are the nodes. An aggregate counts their members and verifies them: all rows
   of a digest must have one depth, one parent digest and one last turn, else the job fails.
4. Nodes are dealt to shards by the topmost node above them that has few enough rows below it
   (a light subtree). A shard puts its digests into a minimal perfect hash (cascaded bit arrays),
   whose slots keep the digest they belong to, so that foreign digests are found out. Counts are
   scattered into flat arrays by slot and added up through the parents' slots, deepest first.
5. Nodes above the light subtrees form one more such table, which takes the subtrees' sums. Of
   these a node whose members all are the same conversation is left out: what is below it is one
   chain, whose sums are known from the rows. So one endless conversation, or any number of
   copies of it, never meets in one task.
6. The ids of conversations that end at a node are joined in chunks of ``ID_CHUNK`` values, which
   stream through the hash in order.

The table above the light subtrees has at most ``HEAVY_SHARE`` nodes for each partition and depth.

Nulls: rows without ``conv_id`` belong to no conversation and are ignored; a null turn comes
first; null role or text is empty. Rows of one turn are ordered by the SHA-256 of role and text;
repeated rows are turns like others. An empty table has no node, not even a root. Very long
texts only travel as their digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.llm.shared import written
from shelfrank.operators.numbering import sorted_index

BORROWED = 9  # a conversation takes fewer turns than this from the first of its group
GROUP = 5
LANES = 4
BLOCK = 1024
ID_CHUNK = 256
# subtrees of fewer rows are never split; larger tables have about so many shares a partition
MIN_LIGHT = 500
HEAVY_SHARE = 8
SHARD_NODES = 200_000
SLOTS_PER_KEY = 1.5
EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """``conv, at, turn_digest, bytes``; ``at`` rises by one from turn to turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        F.unhex(F.sha2(whole, 256)).alias("turn_digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    return sorted_index(rows, ["conv", "turn", "turn_digest"], "at").drop("turn")


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns ``conv, depth, turn_digest, bytes, length`` of the rebuilt conversations, and all
    conversations ``conv, length``, turnless ones too.

    ``rows`` are those of ``turns``. A conversation starts with the first turns of the first
    conversation of its group, as many as its own id's checksum says; its own follow.
    """
    sizes = written(
        rows.groupBy("conv").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    )
    base = F.col("conv") - F.pmod(F.col("conv"), F.lit(GROUP))
    taken = F.crc32(F.col("conv").cast("string").cast("binary")) % BORROWED
    bases = sizes.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    convs = written(
        sizes.select("conv", "first", "n", base.alias("base"), taken.alias("taken"))
        .join(bases, "base", "left")
        .withColumn("borrowed", F.least("taken", F.coalesce("n_base", F.lit(0))))
        .withColumn("length", F.col("borrowed") + F.greatest(F.col("n") - F.col("taken"), F.lit(0)))
    )
    placed = rows.join(convs, "conv").withColumn("place", F.col("at") - F.col("first"))
    own = placed.where("place >= taken").select(
        "conv",
        (F.col("place") - F.col("taken") + F.col("borrowed") + 1).alias("depth"),
        "turn_digest",
        "bytes",
        "length",
    )
    heads = placed.where((F.col("place") < BORROWED) & (F.col("conv") == F.col("base"))).select(
        "base", "place", "turn_digest", "bytes"
    )
    borrowers = convs.where("borrowed > 0").select("conv", "base", "borrowed", "length")
    front = heads.join(borrowers, "base").where("place < borrowed").select(
        "conv", (F.col("place") + 1).alias("depth"), "turn_digest", "bytes", "length"
    )
    return own.unionByName(front), convs.select("conv", "length")


def node_id(depth: Column, sums: list[Column]) -> Column:
    """128 bits that stand for a prefix."""
    whole = F.concat_ws(",", *(x.cast("string") for x in (depth, *sums)))
    return F.unhex(F.substring(F.sha2(whole, 256), 1, 32))


def root_id() -> Column:
    return node_id(F.lit(0), [F.lit(0)] * LANES)


def paths(rows: DataFrame) -> DataFrame:
    """Every prefix of every conversation: ``conv, depth, node, parent, last`` (the node it ends
    at), the turn's digest and bytes, the ``rows`` and ``bytes_below`` from here to its end.
    """
    lanes, sums = [f"lane{i}" for i in range(LANES)], [f"sum{i}" for i in range(LANES)]
    digest = F.sha2(F.concat(F.hex("turn_digest"), F.col("depth").cast("string")), 256)
    hashed = rows.withColumn("digest", digest).select(
        "*",
        F.floor((F.col("depth") - 1) / BLOCK).alias("block"),
        *(
            F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("long").alias(lane)
            for i, lane in enumerate(lanes)
        ),
    )
    added = [*lanes, "bytes"]
    blocks = hashed.groupBy("conv", "block").agg(*(F.sum(x).alias(x) for x in added))
    whole = Window.partitionBy("conv")
    before = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        "conv",
        "block",
        *(F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"{x}_before") for x in added),
        *(F.sum(x).over(whole).alias(f"{x}_all") for x in added),
    )
    inside = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(
        Window.unboundedPreceding, 0
    )
    run = hashed.join(starts, ["conv", "block"]).select(
        "*",
        *(
            (F.col(f"{x}_before") + F.sum(x).over(inside)).alias(total)
            for x, total in zip(added, [*sums, "bytes_so_far"], strict=True)
        ),
    )
    return run.select(
        "conv",
        "depth",
        node_id(F.col("depth"), [F.col(x) for x in sums]).alias("node"),
        node_id(
            F.col("depth") - 1, [F.col(x) - F.col(y) for x, y in zip(sums, lanes, strict=True)]
        ).alias("parent"),
        node_id(F.col("length"), [F.col(f"{x}_all") for x in lanes]).alias("last"),
        "turn_digest",
        "bytes",
        (F.col("length") - F.col("depth") + 1).alias("rows"),
        (F.col("bytes_all") - F.col("bytes_so_far") + F.col("bytes")).alias("bytes_below"),
    )


def nodes_of(steps: DataFrame, convs: DataFrame) -> DataFrame:
    """One verified row per node: members, least member, and what is known of its subtree."""
    one = ["depth", "parent", "turn_digest"]
    differ = F.lit(False)
    for x in one:
        differ = differ | (F.min(x) != F.max(x))
    found = steps.groupBy("node").agg(
        F.when(differ, F.raise_error(F.lit("two prefixes share a digest")).cast("long"))
        .otherwise(F.min("depth"))
        .alias("depth"),
        F.min("parent").alias("parent"),
        F.min("conv").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.max("bytes").alias("bytes"),
        F.sum("rows").alias("rows"),
        (F.min("last") == F.max("last")).alias("alike"),
        F.max("bytes_below").alias("bytes_below"),
    )
    root = convs.agg(
        F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.sum("length").alias("rows")
    ).where("n_convs > 0")
    top = root.select(
        root_id().alias("node"),
        F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("binary").alias("parent"),
        "conv_id",
        "n_convs",
        F.lit(0).cast("long").alias("bytes"),
        (F.col("rows") + 1).alias("rows"),
        F.lit(False).alias("alike"),
        F.lit(0).cast("long").alias("bytes_below"),
    )
    return found.unionByName(top)


class NodeSlots:
    """Minimal perfect hash of distinct 128-bit digests: each one's slot in ``range(n)``.

    A level gives a place to every digest that is alone there and passes the others on; a slot
    is the number of places taken before. Slots keep their digest, so others are found out.
    """

    def __init__(self, keys: np.ndarray) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        rest, taken = np.arange(len(keys)), 0
        slots = np.empty(len(keys), np.int64)
        while len(rest):
            size = max(8, int(SLOTS_PER_KEY * len(rest)))
            at = self.places(keys[rest], len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            rank = taken + np.cumsum(alone) - 1
            self.levels.append((alone, rank))
            placed = alone[at]
            slots[rest[placed]] = rank[at[placed]]
            taken += int(placed.sum())
            rest = rest[~placed]
        self.keys = np.empty_like(keys)
        self.keys[slots] = keys
        self.slots = slots

    @staticmethod
    def places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        mixed = keys[:, 0] ^ (keys[:, 1] * np.uint64(0x9E3779B97F4A7C15 + 2 * level & 0xFFFFFFFFFFFFFFFF))
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((mixed ^ (mixed >> np.uint64(29))) % np.uint64(size)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slots of ``keys``, -1 for those that are not in the table."""
        out, rest = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (alone, rank) in enumerate(self.levels):
            at = self.places(keys[rest], level, len(alone))
            here = alone[at]
            out[rest[here]] = rank[at[here]]
            rest = rest[~here]
        known = out >= 0
        known[known] = (self.keys[out[known]] == keys[known]).all(axis=1)
        return np.where(known, out, -1)


def as_keys(column: pd.Series) -> np.ndarray:
    """128-bit digests as pairs of numbers; a null (the root's parent) is nobody's digest."""
    joined = b"".join(x if x is not None else b"\0" * 16 for x in column)
    return np.frombuffer(joined, "<u8").reshape(-1, 2).astype(np.uint64)


def accumulate(frame: pd.DataFrame) -> pd.DataFrame:
    """Children, leaves and saved tokens of each node of a shard, and its parent's least member.

    ``n_children``, ``n_leaves`` and ``saved`` come in with what is known from other shards.
    """
    table = NodeSlots(as_keys(frame["node"]))
    slot, size = table.slots, len(frame)

    def scattered(values: np.ndarray) -> np.ndarray:
        out = np.empty(size, np.int64)
        out[slot] = values
        return out

    parent = scattered(table.find(as_keys(frame["parent"])))
    depth = scattered(frame["depth"].to_numpy())
    conv = scattered(frame["conv_id"].to_numpy())
    children = scattered(frame["n_children"].to_numpy())
    inner = np.flatnonzero(parent >= 0)
    np.add.at(children, parent[inner], 1)
    leaves = scattered(frame["n_leaves"].to_numpy())
    leaves[children == 0] = 1
    members, weight = scattered(frame["n_convs"].to_numpy()), scattered(frame["bytes"].to_numpy())
    saved = scattered(frame["saved_tokens"].to_numpy()) + (members - 1) * weight
    order = inner[np.argsort(-depth[inner], kind="stable")]
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    out = frame[["node", "parent", "depth", "conv_id", "n_convs"]].copy()
    out["parent_conv_id"] = pd.array(np.where(parent >= 0, conv[parent], 0)[slot], "Int64")
    out.loc[parent[slot] < 0, "parent_conv_id"] = pd.NA
    out["n_children"], out["n_leaves"], out["saved_tokens"] = children[slot], leaves[slot], saved[slot]
    return out


SUMMED = (
    "node binary, parent binary, depth long, conv_id long, n_convs long, parent_conv_id long, "
    "n_children long, n_leaves long, saved_tokens long"
)
SUMS = ["n_children", "n_leaves", "saved_tokens"]


def ends_digests(steps: DataFrame, convs: DataFrame) -> DataFrame:
    """``node, ends_sha256`` of the nodes at which conversations end."""
    ends = steps.where("node = last").select("node", "conv").unionByName(
        convs.where("length = 0").select(root_id().alias("node"), "conv")
    )
    chunks = ends.groupBy("node", F.floor(F.col("conv") / ID_CHUNK).alias("chunk")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda x: x.cast("string")), ",")
        .alias("ids")
    )

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, state = None, hashlib.sha256()
        for frame in frames:
            done = []
            for key, ids in zip(frame["node"], frame["ids"], strict=True):
                if key == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((node, state.hexdigest()))
                node, state = key, hashlib.sha256(ids.encode())
            yield pd.DataFrame(done, columns=["node", "ends_sha256"])
        if node is not None:
            yield pd.DataFrame([(node, state.hexdigest())], columns=["node", "ends_sha256"])

    return (
        chunks.repartition("node")
        .sortWithinPartitions("node", "chunk")
        .select("node", "ids")
        .mapInPandas(hashed, "node binary, ends_sha256 string")
    )


def prefix_trie(conversations: DataFrame, light: int | None = None) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations (``conv_id, turn, role, text``).

    ``conv_id`` (least member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` and ``ends_sha256``. ``light`` is the number of rows up to
    which a subtree stays in one shard.
    """
    spark = conversations.sparkSession
    rows, convs = rebuilt(turns(conversations))
    steps = written(paths(rows))
    nodes = written(nodes_of(steps, convs))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = convs.agg(F.sum("length").alias("rows")).first()
    light = light or max(MIN_LIGHT, int(sizes["rows"] or 0) // (HEAVY_SHARE * partitions))
    shards = max(partitions, nodes.count() // SHARD_NODES)

    # the root always is: conversations without turns have no row below it
    above_light = (F.col("rows") > light) | (F.col("depth") == 0)
    heavy = written(nodes.where(above_light))
    tops = (
        steps.join(heavy.select("node"), "node", "left_anti")
        .groupBy("conv")
        .agg(F.min_by("node", "depth").alias("top"))
    )
    zero = [F.lit(0).cast("long").alias(x) for x in SUMS]
    fields = ["node", "parent", "depth", "conv_id", "n_convs", "bytes"]
    below = (
        nodes.where(~above_light)
        .join(tops, F.col("conv_id") == F.col("conv"))
        .select(*fields, *zero, F.pmod(F.xxhash64("top"), F.lit(shards)).alias("shard"))
    )
    summed = written(below.groupBy("shard").applyInPandas(accumulate, SUMMED))

    # chains of one conversation: known without the tree
    chain = heavy.where("alike").select(
        *fields[:5],
        F.lit(None).cast("long").alias("parent_conv_id"),
        (F.col("rows") > F.col("n_convs")).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes_below")).alias("saved_tokens"),
    )
    upper = heavy.where("NOT alike")
    from_below = (
        summed.where("parent_conv_id IS NULL")
        .unionByName(chain)
        .groupBy("parent")
        .agg(
            F.count("*").alias("n_children"),
            F.sum("n_leaves").alias("n_leaves"),
            F.sum("saved_tokens").alias("saved_tokens"),
        )
        .withColumnRenamed("parent", "node")
    )
    taken = upper.join(from_below, "node", "left").select(
        *fields, *(F.coalesce(x, F.lit(0)).alias(x) for x in SUMS), F.lit(0).alias("shard")
    )
    above = written(taken.groupBy("shard").applyInPandas(accumulate, SUMMED))
    parents = heavy.select(F.col("node").alias("parent"), F.col("conv_id").alias("above_conv_id"))
    whole = summed.unionByName(chain).unionByName(above).join(parents, "parent", "left")
    return whole.join(ends_digests(steps, convs), "node", "left").select(
        "conv_id",
        "depth",
        F.coalesce("parent_conv_id", "above_conv_id").alias("parent_conv_id"),
        "n_convs",
        *SUMS,
        F.coalesce("ends_sha256", F.lit(EMPTY_DIGEST)).alias("ends_sha256"),
    )
