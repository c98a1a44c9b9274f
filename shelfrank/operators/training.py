"""Rankers: LambdaMART, MART, random forest and coordinate ascent.

Rows are ``qid, doc, grade, features``. All trees are grown best first to an exact number of
leaves (``growing``). A feature that is missing counts as 0, as in scoring; repeated rows count
each.
"""

from __future__ import annotations

import inspect
import math
import random
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from shelfrank.operators.ensemble import LinearModel, Model, Node
from shelfrank.operators.growing import MOST_TIMES, Tree, grow_all, place_of, with_bins
from shelfrank.operators.linesearch import REACH, best_on_coordinate
from shelfrank.operators.metrics import DEPTH, err_at_k, gain
from shelfrank.operators.numbering import sorted_index
from shelfrank.operators.skew import ROWS_PER_PART, spread_join
from shelfrank.session import cut_lineage, release

# trees after which the tables of earlier ones are let go
RELEASE_EVERY = 10

# fixed values: ranges that trials draw from, (type, lowest, highest)
_TREES = {
    "trees": ("int", 1, 500),
    "leaf": ("int", 2, 40),
    "tc": ("int", -1, 300),
    "mls": ("int", 1, 10),
}
_BOOSTED = {**_TREES, "shrinkage": ("double", 0.01, 0.2)}
SEARCH_SPACE = {
    "lambdamart": _BOOSTED,
    "mart": _BOOSTED,
    "random forest": _TREES,
    "coordinate ascent": {"rounds": ("int", 1, 5), "seed": ("int", 1, 1000)},
}

def with_document_ids(rows: DataFrame) -> DataFrame:
    """Rows of a training text file have no documents: number them to break ties.

    The numbers are written down, so every stage sees the same ones.
    """
    return cut_lineage(rows.withColumn("doc", F.monotonically_increasing_id().cast("string")))


# -- LambdaMART --------------------------------------------------------------


def _swap_factors(gains: Column) -> Column:
    """What a swap in a list's head does to ERR, per unit of gain difference.

    Input: gains of the first k documents. Output: a (k, k+1) table as one array;
    entry (a, b) is for the swap of places a < b, column k for any place beyond.
    Swapping a and b changes ERR by S_a (R_b - R_a)(1/a - M_ab - Q_ab / b): S is
    the chance to get to a, M the value between the places, Q the chance to pass
    between them; beyond k only S_a (R_b - R_a)(1/a - M) is left.
    """
    depth = DEPTH

    @pandas_udf(T.ArrayType(T.DoubleType()))
    def factors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            # missing places have gain 0, which changes nothing above them
            rows = np.zeros((len(batch), depth))
            for i, row in enumerate(batch):
                rows[i, : len(row)] = row
            ones = np.ones((len(rows), 1))
            reach = np.hstack((ones, np.cumprod(1 - rows, axis=1)))
            table = np.zeros((len(rows), depth, depth + 1))
            for a in range(depth):
                below, ranks = rows[:, a + 1 :], np.arange(a + 2, depth + 1)
                passed = np.hstack((ones, np.cumprod(1 - below, axis=1)))[:, :-1]
                between = np.hstack((0 * ones, np.cumsum(below * passed / ranks, axis=1)))
                own = 1.0 / (a + 1)
                inside = own - between[:, :-1] - passed / ranks
                table[:, a, a + 1 : depth] = reach[:, a, None] * np.abs(inside)
                table[:, a, depth] = reach[:, a] * np.abs(own - between[:, -1])
            yield pd.Series(list(table.reshape(len(rows), -1)))

    return factors(gains)


def lambda_gradients(
    scored: DataFrame, sizes: DataFrame | None = None, spread: bool = True
) -> DataFrame:
    """Add gradient ``lam`` and curvature ``w`` of ERR to rows of ``qid, doc, grade, F``.

    ERR only sees the first k places, so a swap matters only when one of the two
    documents is among them: every row is compared with its list's k first
    documents and with no other. What a row beyond them adds to the first ones
    comes back as k sums per list. No list is ever gathered. ``sizes`` (``qid, n``) are the
    lists' numbers of rows, by which long lists are spread over tasks; they are counted if
    not given. Without ``spread`` no list is longer than what goes to one task.
    """
    if spread and sizes is None:
        sizes = cut_lineage(scored.groupBy("qid").agg(F.count("*").alias("n")))
    order = Window.partitionBy("qid").orderBy(F.desc("F"), F.asc("doc"))
    head = (
        scored.select("qid", "doc", "grade", "F")
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= DEPTH)
        .withColumn("place", F.col("place") - 1)
    )
    heads = (
        head.groupBy("qid")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("place", gain(F.col("grade")).alias("gain"), "F", "doc"))
            ).alias("head")
        )
        .withColumn("factors", _swap_factors(F.transform("head", lambda d: d["gain"])))
    )
    place = F.coalesce(
        F.array_position(F.transform("head", lambda d: d["doc"]), F.col("doc")) - 1, F.lit(-1)
    ).cast("int")

    def with_list(rows: DataFrame, side: DataFrame, how: str) -> DataFrame:
        return spread_join(rows, side, ["qid"], sizes, ["doc"], how) if spread else rows.join(side, "qid", how)

    rows = with_list(scored, heads, "inner").withColumn("place", place)

    own_gain = gain(F.col("grade"))

    def against(other: Column) -> Column:
        """(gradient, curvature) of the row against one document of the head."""
        low = F.when(F.col("place") < 0, other["place"]).otherwise(
            F.least(F.col("place"), other["place"])
        )
        high = F.when(F.col("place") < 0, F.lit(DEPTH)).otherwise(
            F.greatest(F.col("place"), other["place"])
        )
        factor = F.get("factors", (low * (DEPTH + 1) + high).cast("int"))
        change = factor * F.abs(own_gain - other["gain"])
        better = own_gain > other["gain"]
        margin = F.when(better, F.col("F") - other["F"]).otherwise(other["F"] - F.col("F"))
        rho = 1 / (1 + F.exp(margin))
        same = (own_gain == other["gain"]) | (F.col("place") == other["place"])
        return F.struct(
            F.when(same, F.lit(0.0))
            .when(better, change * rho)
            .otherwise(-change * rho)
            .alias("lam"),
            F.when(same, F.lit(0.0)).otherwise(change * rho * (1 - rho)).alias("w"),
        )

    parts = rows.withColumn("parts", F.transform("head", against)).withColumns(
        {
            "lam": F.aggregate("parts", F.lit(0.0), lambda acc, p: acc + p["lam"]),
            "w": F.aggregate("parts", F.lit(0.0), lambda acc, p: acc + p["w"]),
        }
    )
    beyond = parts.filter(F.col("place") < 0)
    back = beyond.groupBy("qid").agg(
        F.array(
            *[
                F.coalesce(F.sum(F.get("parts", F.lit(a))["lam"]), F.lit(0.0))
                for a in range(DEPTH)
            ]
        ).alias("back_lam"),
        F.array(
            *[F.coalesce(F.sum(F.get("parts", F.lit(a))["w"]), F.lit(0.0)) for a in range(DEPTH)]
        ).alias("back_w"),
    )
    in_head = F.col("place") >= 0
    returned = F.when(in_head, F.get("back_lam", F.col("place")))
    curved = F.when(in_head, F.get("back_w", F.col("place")))
    return with_list(parts, back, "left").select(
        *scored.columns,
        (F.col("lam") - F.coalesce(returned, F.lit(0.0))).alias("lam"),
        (F.col("w") + F.coalesce(curved, F.lit(0.0))).alias("w"),
    )


def train_lambdamart(
    rows: DataFrame,
    trees: int = 10,
    leaf: int = 10,
    shrinkage: float = 0.1,
    tc: int = 256,
    mls: int = 1,
) -> list[Node]:
    """Boosted trees on the gradients of ERR@10 (Burges, 2010)."""
    return _boost(rows, lambda_gradients, trees, leaf, shrinkage, tc, mls)


def residuals(scored: DataFrame, sizes: DataFrame | None = None, spread: bool = True) -> DataFrame:
    """Gradients of the squared error: the grade is to be met."""
    return scored.withColumns({"lam": F.col("grade") - F.col("F"), "w": F.lit(1.0)})


def _boost(
    rows: DataFrame,
    gradients: Callable[[DataFrame, DataFrame, bool], DataFrame],
    trees: int,
    leaf: int,
    shrinkage: float,
    tc: int,
    mls: int,
) -> list[Node]:
    """Trees of exactly ``leaf`` leaves on the gradients; a leaf's output is a Newton step.

    Bins are made once, and stand for the features from then on. A round writes its rows once.
    Rows of one document are told apart by their place in a common order.
    """
    plain = rows.select("qid", "doc", F.col("grade").cast("double").alias("grade"), "features")
    size = plain.select(F.max(F.size("features"))).first()[0] or 0
    ordered = sorted_index(plain, ["qid", "doc", "grade", "features"], "row")
    fixed, thresholds = with_bins(ordered, max(size, 0), tc)
    state = fixed.select(
        "qid", F.struct("doc", "row").alias("doc"), "grade", "bins", F.lit(0.0).alias("F")
    )
    sizes = cut_lineage(fixed.groupBy("qid").agg(F.count("*").alias("n")))
    spread = (sizes.agg(F.max("n")).first()[0] or 0) > ROWS_PER_PART
    model: list[Node] = []
    for number in range(1, trees + 1):
        step = cut_lineage(gradients(state, sizes, spread))
        tree = Tree(number, shrinkage)
        nodes, _ = grow_all(step, thresholds, leaf, mls, [tree])
        model += nodes
        outputs = {node.node: node.output for node in nodes if node.is_leaf}
        value = F.lit(shrinkage) * place_of(tree, outputs, tree.inner)
        state = step.select("qid", "doc", "grade", "bins", (F.col("F") + value).alias("F"))
        if number % RELEASE_EVERY == 0:
            release(rows.sparkSession)
    return model


def train_mart(
    rows: DataFrame,
    trees: int = 10,
    leaf: int = 10,
    shrinkage: float = 0.1,
    tc: int = 256,
    mls: int = 1,
) -> list[Node]:
    """Boosted regression trees on the grade."""
    return _boost(rows, residuals, trees, leaf, shrinkage, tc, mls)


# -- random forest -----------------------------------------------------------


def poisson_times(tree: int, seed: int) -> Column:
    """How often a tree has a row: a Poisson draw of mean 1 from a hash of tree and row."""
    unit = F.pmod(F.xxhash64(F.lit(seed), F.lit(tree), "qid", "doc", "row"), F.lit(1 << 53)) / F.lit(
        float(1 << 53)
    )
    times, chance, below = F.lit(0), math.exp(-1), 0.0
    for k in range(MOST_TIMES):
        below += chance
        times = times + (unit >= F.lit(below)).cast("int")
        chance /= k + 1
    return times


def forest_features(tree: int, seed: int, size: int, rate: float) -> list[int]:
    """The share of the features that a tree may use, drawn by its number."""
    draw = random.Random(f"{seed} {tree}")
    return sorted(draw.sample(range(size), max(1, math.ceil(rate * size)))) if size else []


def train_random_forest(
    rows: DataFrame,
    trees: int = 10,
    leaf: int = 32,
    tc: int = 256,
    mls: int = 1,
    seed: int = 42,
    bagging: bool = True,
    feature_rate: float = 1 / 3,
) -> list[Node]:
    """Regression trees on the grade, each on a bootstrap of all rows and some features.

    All trees grow in the same jobs. Without ``bagging`` every tree has every row once.
    """
    plain = rows.select("qid", "doc", F.col("grade").cast("double").alias("grade"), "features")
    size = max(plain.select(F.max(F.size("features"))).first()[0] or 0, 0)
    ordered = sorted_index(plain, ["qid", "doc", "grade", "features"], "row")
    fixed, thresholds = with_bins(ordered, size, tc)
    points = fixed.select("qid", "doc", "row", "bins", F.col("grade").alias("lam"), F.lit(1.0).alias("w"))
    forest = [
        Tree(
            number,
            1.0 / trees,
            poisson_times(number, seed) if bagging else None,
            forest_features(number, seed, size, feature_rate),
        )
        for number in range(1, trees + 1)
    ]
    return grow_all(points, thresholds, leaf, mls, forest)[0]


# -- coordinate ascent -------------------------------------------------------


def mean_err(rows: DataFrame, score: Column, k: int = DEPTH) -> float:
    scored = rows.withColumn("_score", score)
    lists = err_at_k(scored, ["qid"], [F.desc("_score"), F.asc("doc")], k=k)
    return lists.agg(F.avg("err")).first()[0] or 0.0


def train_coordinate_ascent(
    rows: DataFrame,
    size: int,
    rounds: int = 2,
    seed: int = 42,
    order: Sequence[int] | None = None,
    reach: float = REACH,
) -> LinearModel:
    """Linear weights, one coordinate at a time, for the highest mean ERR@10.

    Each step moves a weight to its exact optimum within ``reach`` (see ``linesearch``).
    ``order`` lists the coordinates of a round; by default it is drawn anew for each.
    """
    weights = [1.0 / size] * size
    draw = random.Random(seed)
    kept = cut_lineage(
        rows.select("qid", "doc", F.col("grade").cast("double").alias("grade"), "features")
    )
    lists = kept.select("qid").distinct().count()
    best = mean_err(kept, LinearModel(tuple(weights)).column(F.col("features"))) * lists
    for _ in range(rounds):
        improved = False
        coordinates = list(range(size)) if order is None else list(order)
        if order is None:
            draw.shuffle(coordinates)
        for coordinate in coordinates:
            found = best_on_coordinate(kept, weights, coordinate, reach)
            if found is None or found[1] <= best + 1e-9:
                continue
            changed = list(weights)
            changed[coordinate] += found[0]
            scale = sum(abs(weight) for weight in changed)
            if scale > 0:
                weights, best, improved = [weight / scale for weight in changed], found[1], True
        if not improved:
            break
    return LinearModel(tuple(weights))


TRAINERS = {
    "lambdamart": train_lambdamart,
    "mart": train_mart,
    "random forest": train_random_forest,
    "coordinate ascent": train_coordinate_ascent,
}


def check_space(name: str, space: Mapping[str, tuple]) -> None:
    """An error for an unknown ranker, or a parameter that it does not take."""
    if name not in TRAINERS:
        raise ValueError(f"no ranker {name!r}; there are {sorted(TRAINERS)}")
    taken = set(inspect.signature(TRAINERS[name]).parameters) - {"rows", "size"}
    unknown = sorted(set(space) - taken)
    if unknown:
        raise ValueError(f"ranker {name!r} does not take {unknown}")


def train(name: str, rows: DataFrame, size: int, **parameters) -> Model | LinearModel:
    """Train the named ranker on rows of ``size`` features."""
    check_space(name, parameters)
    if name == "coordinate ascent":
        parameters["size"] = size
    return TRAINERS[name](rows, **parameters)
