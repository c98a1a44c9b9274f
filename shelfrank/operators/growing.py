"""Regression trees grown best first, to an exact number of leaves.

Rows have targets ``lam``, weights ``w`` and ``bins``: per feature the number of candidate
thresholds below the value. A split is found from sums per (leaf, feature, bin). Only the rows
of the smaller child of a split are summed; its sibling's sums are its parent's minus those.
Sums are whole numbers of a fixed step, so they are exact: neither subtraction nor the order of
adding changes a tree. Several trees, each with its own times per row, grow in the same jobs.

With a bounded number of candidates the sums, at most one number per (leaf, feature,
candidate), come to the driver, one job per level. With all values as candidates they stay a
table, and running sums go by ranges of bins, so that no feature's values meet in one task.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from shelfrank.operators.ensemble import Node, value_at
from shelfrank.operators.numbering import sorted_index
from shelfrank.session import cut_lineage

MEASURES = ("lam", "squares", "w", "rows")
RANGE = 1024  # bins whose running sums are made together
LEAF_BITS = 20  # a leaf's number within its tree, in the key of sums of several trees
TREES_AT_ONCE = 20
MOST_TIMES = 16  # of one row in one tree
GAIN_DECIMALS = 9  # splits whose gains agree so far are equal: the first feature and bin wins


# -- candidate thresholds ----------------------------------------------------


@dataclass
class Thresholds:
    """Candidates by feature: sorted arrays, or a table ``feature, bin, threshold``."""

    size: int
    values: list[np.ndarray] | None = None
    table: DataFrame | None = None


def whole_values(size: int) -> Column:
    """The features by the rule of scoring: what is missing counts as 0."""
    own = F.col("features")
    return F.array(*[value_at(own, i).cast("double") for i in range(size)]).cast("array<double>")


def with_bins(rows: DataFrame, size: int, count: int) -> tuple[DataFrame, Thresholds]:
    """``rows`` with ``bins``, written down, and the thresholds they stand for.

    ``count`` < 0: all different values are thresholds. Else those of a feature with at most
    ``count`` of them, and ``count`` equal steps from the lowest value of any other. NaN is no
    threshold and above all of them. Rows need no key; equal rows count each.
    """
    filled = rows.withColumn("_values", whole_values(size))
    spread = filled.select(F.posexplode("_values").alias("feature", "x"))
    values = spread.where(~F.isnan("x")).distinct()
    if count < 0:
        return _all_values(filled, values, size)
    spans = values.groupBy("feature").agg(
        F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")
    ).collect()  # one row per feature
    few = [row["feature"] for row in spans if row["n"] <= count]
    edges = [np.empty(0) for _ in range(size)]
    for row in spans:
        steps = max(count, 1)
        width = (row["high"] - row["low"]) / steps
        edges[row["feature"]] = np.array([row["low"] + i * width for i in range(steps)])
    own: dict[int, list[float]] = {feature: [] for feature in few}
    for row in values.where(F.col("feature").isin(few)).collect() if few else []:
        own[row["feature"]].append(row["x"])  # at most ``count`` per feature
    for feature, found in own.items():
        edges[feature] = np.array(sorted(found))

    @pandas_udf("array<int>")
    def binned(batch: pd.Series) -> pd.Series:
        x = np.array(batch.tolist(), float).reshape(len(batch), size)
        columns = [np.searchsorted(edges[i], x[:, i]) for i in range(size)]
        return pd.Series(list(np.array(columns, np.int32).reshape(size, len(x)).T))

    return cut_lineage(filled.withColumn("bins", binned("_values")).drop("_values")), Thresholds(size, edges)


def _all_values(filled: DataFrame, values: DataFrame, size: int) -> tuple[DataFrame, Thresholds]:
    placed = sorted_index(values, ["feature", "x"], "at")
    first = placed.groupBy("feature").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    table = cut_lineage(
        placed.join(first, "feature").select(
            "feature", (F.col("at") - F.col("first")).cast("int").alias("bin"), F.col("x").alias("threshold")
        )
    )
    keyed = cut_lineage(filled.withColumn("_row", F.monotonically_increasing_id()))
    long = keyed.select("_row", F.posexplode("_values").alias("feature", "threshold"))
    found = (
        long.join(table, ["feature", "threshold"], "left")
        .join(first.select("feature", "n"), "feature", "left")
        .select("_row", "feature", F.coalesce("bin", "n", F.lit(0)).cast("int").alias("bin"))
        .groupBy("_row")
        .agg(F.array_sort(F.collect_list(F.struct("feature", "bin"))).alias("pairs"))
        .select("_row", F.transform("pairs", lambda p: p["bin"]).alias("bins"))
    )
    rows = keyed.join(found, "_row", "left").drop("_row", "_values")
    empty = F.array().cast("array<int>")
    return cut_lineage(rows.withColumn("bins", F.coalesce("bins", empty))), Thresholds(size, table=table)


# -- trees -------------------------------------------------------------------


@dataclass
class Leaf:
    """What is known of a node: its sums, and its best split once that was looked for."""

    sums: tuple[int, int, int, int]
    parent: int = -1
    looked: bool = False
    feature: int = 0
    bin: int = 0
    threshold: float = 0.0
    left: int = 0
    right: int = 0


@dataclass
class Tree:
    """A tree that grows: ``times`` is how often it has a row, ``features`` those it may use."""

    number: int
    weight: float
    times: Column | None = None
    features: Sequence[int] | None = None
    known: dict[int, Leaf] = field(default_factory=dict)
    inner: set[int] = field(default_factory=set)
    finished: bool = False


@dataclass
class Scale:
    """Steps of the whole numbers that stand for ``lam``, its square and ``w``."""

    steps: tuple[float, float, float]

    @classmethod
    def of(cls, rows: DataFrame) -> Scale:
        most = rows.agg(
            F.max(F.abs("lam")).alias("lam"), F.max(F.abs("w")).alias("w"), F.count("*").alias("n")
        ).first()
        lam, w, n = most["lam"] or 0.0, most["w"] or 0.0, most["n"] * MOST_TIMES

        def step(highest: float) -> float:
            # a sum of all rows stays below 2 ** 62
            return 2.0 ** min(50, 61 - math.ceil(math.log2(max(highest * n, 1e-9))))

        return cls((step(lam), step(lam * lam), step(w)))

    def measures(self) -> list[Column]:
        values = F.col("lam"), F.col("lam") * F.col("lam"), F.col("w")
        return [F.rint(x * F.lit(step)).cast("long") for x, step in zip(values, self.steps, strict=True)]

    def deviance(self, leaf: Leaf) -> float:
        lam, squares, _, rows = leaf.sums
        total = lam / self.steps[0]
        return squares / self.steps[1] - total * total / rows if rows else 0.0

    def output(self, leaf: Leaf) -> float:
        """A Newton step: the mean target where all weights are 1."""
        lam, _, w, _ = leaf.sums
        return (lam / self.steps[0]) / (w / self.steps[2]) if w > 0 else 0.0


def place_of(tree: Tree, outputs: dict[int, float] | None = None, inner: set[int] | None = None) -> Column:
    """The leaf a row is in, by its bins, or what that leaf stands for."""

    def walk(number: int) -> Column:
        leaf = tree.known[number]
        if not leaf.left or (inner is not None and number not in inner):
            return F.lit(number) if outputs is None else F.lit(outputs[number])
        low = F.get("bins", F.lit(leaf.feature)) <= F.lit(leaf.bin)
        return F.when(low, walk(leaf.left)).otherwise(walk(leaf.right))

    return walk(0)


def sums_of(rows: DataFrame, trees: Sequence[Tree], wanted: dict[int, list[int]], scale: Scale) -> DataFrame:
    """``leaf, feature, bin`` and the measures' sums over the rows of the wanted leaves.

    ``leaf`` is the leaf's number after the tree's place in ``trees``.
    """
    lam, squares, w = scale.measures()
    keys = []
    for place, leaves in wanted.items():
        here, times = place_of(trees[place]), trees[place].times
        times = F.lit(1) if times is None else times
        key = F.when(here.isin(leaves) & (times > 0), here + F.lit(place << LEAF_BITS))
        keys.append(F.struct(key.alias("leaf"), times.cast("long").alias("times")))
    measured = rows.select(
        "bins",
        lam.alias("lam"),
        squares.alias("squares"),
        w.alias("w"),
        F.explode(F.filter(F.array(*keys), lambda x: x["leaf"].isNotNull())).alias("in"),
    )
    return (
        measured.select(
            "in.leaf",
            *[(F.col(x) * F.col("in.times")).alias(x) for x in MEASURES[:3]],
            F.col("in.times").alias("rows"),
            F.posexplode("bins").alias("feature", "bin"),
        )
        .groupBy("leaf", "feature", "bin")
        .agg(*(F.sum(x).alias(x) for x in MEASURES))
    )


class ArraySums:
    """Sums of bounded size, as arrays on the driver."""

    def __init__(self, thresholds: Thresholds, scale: Scale, least: int) -> None:
        self.edges, self.size, self.scale, self.least = thresholds.values, thresholds.size, scale, least
        self.width = max((len(x) for x in self.edges), default=0) + 1
        self.valid = np.array([np.arange(self.width) < len(x) for x in self.edges])
        self.sums: dict[int, np.ndarray] = {}

    def look(self, rows, trees, wanted, pairs) -> dict[int, tuple]:
        found = sums_of(rows, trees, wanted, self.scale).toPandas()
        for key in [(p << LEAF_BITS) + leaf for p, leaves in wanted.items() for leaf in leaves]:
            self.sums[key] = np.zeros((len(MEASURES), self.size, self.width), np.int64)
        place = found["leaf"].to_numpy()
        for key in np.unique(place):
            some = found[place == key]
            at = some["feature"].to_numpy(), some["bin"].to_numpy()
            for i, name in enumerate(MEASURES):
                self.sums[key][i][at] = some[name].to_numpy()
        for small, big, parent in pairs:
            self.sums[big] = self.sums.pop(parent) - self.sums[small]
        looked = [x for pair in pairs for x in pair[:2]] or [k << LEAF_BITS for k in wanted]
        return {key: self.best(key, trees[key >> LEAF_BITS]) for key in looked}

    def roots(self, rows, trees, places) -> dict[int, tuple]:
        """The best splits of whole trees, whose sums are known."""
        keys = [p << LEAF_BITS for p in places]
        return {k: self.best(k, trees[k >> LEAF_BITS]) if k in self.sums else None for k in keys}

    def best(self, key: int, tree: Tree) -> tuple | None:
        left = self.sums[key].cumsum(axis=2)
        whole = left[:, :, -1:]
        low, high = left[3], whole[3] - left[3]
        allowed = self.valid & (low >= self.least) & (high >= self.least) & (low > 0) & (high > 0)
        if tree.features is not None:
            allowed[[f for f in range(self.size) if f not in tree.features]] = False
        if not allowed.any():
            return None
        step = self.scale.steps[0]
        total = left[0] / step
        rest = (whole[0] - left[0]) / step
        gain = np.full(allowed.shape, -np.inf)
        found = total[allowed] ** 2 / low[allowed] + rest[allowed] ** 2 / high[allowed]
        gain[allowed] = np.round(found, GAIN_DECIMALS)
        feature, place = np.unravel_index(gain.argmax(), gain.shape)
        sums = tuple(int(x) for x in left[:, feature, place])
        return int(feature), int(place), float(self.edges[feature][place]), sums


class TableSums:
    """Sums of any size, as a table; one row per looked leaf comes to the driver."""

    def __init__(self, thresholds: Thresholds, scale: Scale, least: int) -> None:
        self.thresholds, self.scale, self.least = thresholds.table, scale, least
        self.table: DataFrame | None = None

    def look(self, rows, trees, wanted, pairs) -> dict[int, tuple]:
        table = sums_of(rows, trees, wanted, self.scale)
        if pairs:
            # the larger child: its parent's sums, and the smaller one's taken away
            after = {parent: big for _, big, parent in pairs}
            beside = {small: big for small, big, _ in pairs}
            renamed = lambda df, names: df.where(F.col("leaf").isin(list(names))).withColumn(
                "leaf", F.element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), F.col("leaf"))
            )
            gone = renamed(table, beside).select("leaf", "feature", "bin", *((-F.col(x)).alias(x) for x in MEASURES))
            table = (
                table.unionByName(renamed(self.table, after))
                .unionByName(gone)
                .groupBy("leaf", "feature", "bin")
                .agg(*(F.sum(x).alias(x) for x in MEASURES))
                .where("rows > 0")
            )
        new = cut_lineage(table)
        keep = [] if self.table is None else [p for p in self.kept if p not in {x[2] for x in pairs}]
        looked = [x for pair in pairs for x in pair[:2]] or [k << LEAF_BITS for k in wanted]
        best = self.best(new, trees)
        if keep:
            new = new.unionByName(self.table.where(F.col("leaf").isin(keep)))
        self.table, self.kept = new, [*keep, *looked]
        found = {
            row["leaf"]: (row["feature"], row["bin"], row["threshold"], tuple(row[f"left_{x}"] for x in MEASURES))
            for row in best.collect()
        }
        return {key: found.get(key) for key in looked}

    def roots(self, rows, trees, places) -> dict[int, tuple]:
        return self.look(rows, trees, {p: [0] for p in places}, [])

    def best(self, table: DataFrame, trees: Sequence[Tree]) -> DataFrame:
        ranged = table.withColumn("range", F.floor(F.col("bin") / RANGE))
        inside = Window.partitionBy("leaf", "feature", "range").orderBy("bin").rowsBetween(
            Window.unboundedPreceding, 0
        )
        feature = Window.partitionBy("leaf", "feature")
        before = feature.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
        ranges = ranged.groupBy("leaf", "feature", "range").agg(*(F.sum(x).alias(x) for x in MEASURES))
        starts = ranges.select(
            "leaf",
            "feature",
            "range",
            *(F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"{x}_before") for x in MEASURES),
            *(F.sum(x).over(feature).alias(f"{x}_all") for x in MEASURES),
        )
        run = ranged.join(starts, ["leaf", "feature", "range"]).select(
            "leaf",
            "feature",
            "bin",
            *((F.col(f"{x}_before") + F.sum(x).over(inside)).alias(f"left_{x}") for x in MEASURES),
            *(F.col(f"{x}_all") for x in MEASURES),
        )
        rest = F.col("rows_all") - F.col("left_rows")
        step = F.lit(self.scale.steps[0])
        left, right = F.col("left_lam") / step, (F.col("lam_all") - F.col("left_lam")) / step
        allowed = run.where((F.col("left_rows") >= self.least) & (rest >= self.least) & (rest > 0))
        for place, tree in enumerate(trees):
            if tree.features is not None:
                own = F.shiftright("leaf", LEAF_BITS) == place
                allowed = allowed.where(~own | F.col("feature").isin(list(tree.features)))
        gain = F.round(left * left / F.col("left_rows") + right * right / rest, GAIN_DECIMALS)
        order = F.struct(gain.alias("gain"), -F.col("feature"), -F.col("bin"))
        names = ["feature", "bin", *(f"left_{x}" for x in MEASURES)]
        best = allowed.groupBy("leaf").agg(F.max_by(F.struct(*names), order).alias("b")).select("leaf", "b.*")
        # one row per looked leaf
        return self.thresholds.join(F.broadcast(best), ["feature", "bin"])


def next_leaves(tree: Tree, leaves: int, least: int, scale: Scale) -> list[int]:
    """Leaves whose best split must be known to go on; none once the tree is finished.

    The leaf of the highest deviance is split first. Where its split is not known yet, all
    others that may still be split are asked for with it.
    """
    tree.inner = set()
    queue, done = [(-scale.deviance(tree.known[0]), 0)], 0
    while queue and done + len(queue) < leaves:
        _, number = heapq.heappop(queue)
        leaf = tree.known[number]
        if leaf.sums[3] < 2 * least:
            done += 1
        elif not leaf.looked:
            splits = leaves - done - len(queue) - 1
            others = [
                (-scale.deviance(x), n)
                for n, x in tree.known.items()
                if not x.looked and n != number and x.sums[3] >= 2 * least
            ]
            return [number, *(n for _, n in heapq.nsmallest(splits - 1, others))]
        elif not leaf.left:
            done += 1
        else:
            tree.inner.add(number)
            for child in (leaf.left, leaf.right):
                heapq.heappush(queue, (-scale.deviance(tree.known[child]), child))
    tree.finished = True
    return []


def grow_all(
    rows: DataFrame, thresholds: Thresholds, leaves: int, least: int, trees: Sequence[Tree]
) -> tuple[list[Node], Scale]:
    """Trees of ``leaves`` leaves, or fewer where rows do not allow more splits.

    A leaf of fewer than 2 ``least`` rows, or without a threshold that leaves ``least`` rows on
    both sides, stays. Rows are ``lam, w, bins``.
    """
    scale = Scale.of(rows)
    least = max(least, 1)
    nodes: list[Node] = []
    for start in range(0, len(trees), TREES_AT_ONCE):
        some = trees[start : start + TREES_AT_ONCE]
        _grow(rows, thresholds, leaves, least, some, scale)
        nodes += [node for tree in some for node in nodes_of(tree, scale)]
    return nodes, scale


def _grow(rows, thresholds: Thresholds, leaves: int, least: int, trees: Sequence[Tree], scale: Scale) -> None:
    kind = TableSums if thresholds.values is None else ArraySums
    store = kind(thresholds, scale, least)
    roots = {place: [0] for place in range(len(trees))}
    if kind is ArraySums and thresholds.size:
        for tree in trees:
            tree.known[0] = Leaf((0, 0, 0, 0))
        # a feature's sums add up to those of the tree
        store.look(rows, trees, roots, [])
        for place, tree in enumerate(trees):
            whole = store.sums[place << LEAF_BITS][:, 0].sum(axis=1)
            tree.known[0] = Leaf(tuple(int(x) for x in whole))
    else:
        _count_roots(rows, trees, scale)
    while True:
        wanted: dict[int, list[int]] = {}
        pairs: list[tuple[int, int, int]] = []
        roots_asked: list[int] = []
        for place, tree in enumerate(trees):
            asked = [] if tree.finished else next_leaves(tree, leaves, least, scale)
            base = place << LEAF_BITS
            if asked == [0]:
                roots_asked.append(place)
            for parent in sorted({tree.known[n].parent for n in asked} - {-1}):
                children = tree.known[parent].left, tree.known[parent].right
                small, big = sorted(children, key=lambda n: (tree.known[n].sums[3], n))
                wanted.setdefault(place, []).append(small)
                pairs.append((base + small, base + big, base + parent))
        if not wanted and not roots_asked:
            return
        found = store.roots(rows, trees, roots_asked) if roots_asked else {}
        if wanted:
            found |= store.look(rows, trees, wanted, pairs)
        for key, split in found.items():
            tree, number = trees[key >> LEAF_BITS], key & ((1 << LEAF_BITS) - 1)
            leaf = tree.known[number]
            leaf.looked = True
            if split is None or leaf.sums[3] < 2 * least:
                continue
            leaf.feature, leaf.bin, leaf.threshold, low = split
            leaf.left, leaf.right = len(tree.known), len(tree.known) + 1
            tree.known[leaf.left] = Leaf(low, number)
            tree.known[leaf.right] = Leaf(tuple(a - b for a, b in zip(leaf.sums, low, strict=True)), number)


def _count_roots(rows: DataFrame, trees: Sequence[Tree], scale: Scale) -> None:
    lam, squares, w = scale.measures()
    measured = []
    for place, tree in enumerate(trees):
        times = F.lit(1).cast("long") if tree.times is None else tree.times.cast("long")
        for name, value in zip(MEASURES, (lam, squares, w, F.lit(1)), strict=True):
            measured.append(F.sum(value * times).alias(f"{name}{place}"))
    whole = rows.agg(*measured).first()
    for place, tree in enumerate(trees):
        tree.known[0] = Leaf(tuple(int(whole[f"{x}{place}"] or 0) for x in MEASURES))


def nodes_of(tree: Tree, scale: Scale) -> list[Node]:
    found, todo = [], [0]
    while todo:
        number = todo.pop()
        leaf = tree.known[number]
        if number in tree.inner:
            found.append(
                Node(tree.number, number, tree.weight, leaf.feature + 1, leaf.threshold, leaf.left, leaf.right)
            )
            todo += [leaf.left, leaf.right]
        else:
            found.append(Node(tree.number, number, tree.weight, output=scale.output(leaf)))
    return found


def grow(rows: DataFrame, thresholds: Thresholds, leaves: int, least: int, tree: int, weight: float) -> list[Node]:
    """One tree on rows of ``lam, bins`` and perhaps ``w``."""
    if "w" not in rows.columns:
        rows = rows.withColumn("w", F.lit(1.0))
    return grow_all(rows, thresholds, leaves, least, [Tree(tree, weight)])[0]
