"""Best-first trees against a direct construction."""

import heapq
import random

import pytest
from pyspark.sql import functions as F

from shelfrank.operators import growing, training
from shelfrank.operators.ensemble import tree_column


def expected_leaves(points, leaves, least, cuts):
    def deviance(p):
        total = sum(v for _, v in p)
        return sum(v * v for _, v in p) - total * total / len(p)

    queue, done, number = [(-deviance(points), 0, points)], [], 0
    while queue and len(done) + len(queue) < leaves:
        _, _, p = heapq.heappop(queue)
        best = None
        for f, cut in [(f, t) for f in range(3) for t in cuts[f]] if len(p) >= 2 * least else []:
            low = [v for x, v in p if x[f] <= cut]
            high = [v for x, v in p if x[f] > cut]
            if len(low) >= least and len(high) >= least:
                gain = sum(low) ** 2 / len(low) + sum(high) ** 2 / len(high)
                if best is None or gain > best[0] + 1e-9:
                    best = (gain, f, cut)
        if best is None:
            done.append(p)
            continue
        _, f, cut = best
        for side in ([z for z in p if z[0][f] <= cut], [z for z in p if z[0][f] > cut]):
            number += 1
            heapq.heappush(queue, (-deviance(side), number, side))
    return sorted(sorted(v for _, v in p) for p in done + [p for _, _, p in queue])


@pytest.mark.parametrize("count", [-1, 5])
def test_trees(spark, count):
    draw = random.Random(3)
    data = []
    for q in range(20):
        for i in range(10):
            x = [draw.randrange(6) / 2, draw.random(), float(draw.randrange(2))]
            value = 2 * x[0] + (x[1] > 0.4) * 3 - x[2] * x[0] + draw.random() * 0.1
            data.append((q, f"d{i}", x, value))
    rows = spark.createDataFrame(data, "qid long, doc string, features array<double>, lam double")
    binned, thresholds = growing.with_bins(rows, 3, count)
    cuts = []
    for f in range(3):
        values = sorted({x[f] for _, _, x, _ in data})
        step = (values[-1] - values[0]) / count
        every = count < 0 or len(values) <= count
        cuts.append(values if every else [values[0] + j * step for j in range(count)])
    for row in binned.collect():
        assert list(row.bins) == [sum(t < x for t in cuts[f]) for f, x in enumerate(row.features)]
    points = [(x, v) for _, _, x, v in data]
    for leaves, least in ((2, 1), (9, 1), (10, 15), (400, 60)):
        tree = growing.grow(binned, thresholds, leaves, least, 1, 1.0)
        place = tree_column({n.node: n for n in tree}, F.col("features"), leaf_id=True)
        found = {}
        for row in binned.select("lam", place.alias("leaf")).collect():
            found.setdefault(row.leaf, []).append(row.lam)
        assert sorted(map(sorted, found.values())) == expected_leaves(points, leaves, least, cuts)


def test_one_row_is_one_leaf(spark):
    rows = spark.createDataFrame([(0, "a", [1.0], 2.0)], "qid long, doc string, features array<double>, lam double")
    binned, thresholds = growing.with_bins(rows, 1, 256)
    assert [n.is_leaf for n in growing.grow(binned, thresholds, 10, 1, 1, 1.0)] == [True]


def labelled(spark, seed=5, lists=30, docs=12):
    draw = random.Random(seed)
    data = []
    for q in range(lists):
        for i in range(docs):
            x = [draw.randrange(8) / 2, draw.random(), float(draw.randrange(2))]
            data.append((q, f"d{i:02}", draw.randrange(5), x))
    return data, spark.createDataFrame(data, "qid long, doc string, grade int, features array<double>")


def test_sums_of_any_size_grow_the_same_trees(spark):
    """Bounded sums on the driver, and sums that stay a table, with several ranges of bins."""
    _, rows = labelled(spark)
    points = rows.withColumns({"lam": F.col("grade").cast("double"), "w": F.lit(1.0)})
    trees = []
    for count in (100_000, -1):
        binned, thresholds = growing.with_bins(points, 3, count)
        assert (thresholds.values is None) == (count < 0)
        trees.append(growing.grow(binned, thresholds, 12, 3, 1, 1.0))
    assert trees[0] == trees[1] and len(trees[0]) == 23


def test_ranges_of_bins(spark, monkeypatch):
    _, rows = labelled(spark)
    points = rows.withColumns({"lam": F.col("grade").cast("double"), "w": F.lit(1.0)})
    binned, thresholds = growing.with_bins(points, 3, -1)
    whole = growing.grow(binned, thresholds, 6, 3, 1, 1.0)
    monkeypatch.setattr(growing, "RANGE", 7)
    assert growing.grow(binned, thresholds, 6, 3, 1, 1.0) == whole


@pytest.mark.parametrize("tc", [-1, 4])
def test_missing_values_count_as_zero(spark, tc):
    """NULL arrays, short arrays, NULL elements and repeated rows, against the filled table."""
    data, _ = labelled(spark, seed=6)
    odd, filled = [], []
    for n, (qid, doc, grade, x) in enumerate(data):
        given = [None, x[:1], [None, *x[1:]], [], x, x][n % 6]
        whole = [0.0 if v is None else v for v in [*(given or []), 0.0, 0.0, 0.0][:3]]
        for _ in range(2 if n % 6 == 5 else 1):
            odd.append((qid, doc, grade, given))
            filled.append((qid, doc, grade, whole))
    schema = "qid long, doc string, grade int, features array<double>"
    models = []
    for rows in (odd, filled):
        table = spark.createDataFrame(rows, schema)
        models.append(
            [
                training.train_lambdamart(table, trees=1, leaf=4, tc=tc),
                training.train_random_forest(table, trees=2, leaf=4, tc=tc, bagging=False),
            ]
        )
    assert models[0] == models[1]
    assert all(node.threshold is not None for model in models[0] for node in model if not node.is_leaf)


def test_nan_is_above_all_thresholds(spark):
    rows = spark.createDataFrame(
        [(0, "a", [float("nan")], 4.0), (0, "b", [1.0], 0.0), (0, "c", [2.0], 0.0)],
        "qid long, doc string, features array<double>, lam double",
    )
    for count in (-1, 5):
        binned, thresholds = growing.with_bins(rows, 1, count)
        root = growing.grow(binned, thresholds, 2, 1, 1, 1.0)[0]
        assert (root.feature, root.threshold) == (1, 2.0)


def test_forest_without_bagging(spark):
    """Every tree is the tree of all rows over its own features."""
    data, rows = labelled(spark)
    model = training.train_random_forest(rows, trees=3, leaf=5, tc=-1, bagging=False, feature_rate=0.5)
    for number in (1, 2, 3):
        own = training.forest_features(number, 42, 3, 0.5)
        tree = {n.node: n for n in model if n.tree == number}
        assert {n.feature - 1 for n in tree.values() if not n.is_leaf} <= set(own)
        points = [([x[f] if f in own else 0.0 for f in range(3)], float(g)) for _, _, g, x in data]
        cuts = [sorted({p[0][f] for p in points}) for f in range(3)]
        place = tree_column(tree, F.col("features"), leaf_id=True)
        found = {}
        for row in rows.select("grade", place.alias("leaf")).collect():
            found.setdefault(row.leaf, []).append(float(row.grade))
        assert sorted(map(sorted, found.values())) == expected_leaves(points, 5, 1, cuts)
        for leaf, grades in found.items():
            assert tree[leaf].output == pytest.approx(sum(grades) / len(grades))


def test_bootstrap_has_all_rows(spark):
    """Times per row follow Poisson(1), are the same in every run, and differ between trees."""
    rows = spark.range(20_000).select(
        F.col("id").alias("qid"), F.lit("d").alias("doc"), F.col("id").alias("row")
    )
    drawn = rows.select(*(training.poisson_times(t, 7).alias(f"t{t}") for t in (1, 2)))
    counts = {r["t1"]: r["count"] / 20_000 for r in drawn.groupBy("t1").count().collect()}
    assert counts[0] == pytest.approx(0.368, abs=0.02) and counts[1] == pytest.approx(0.368, abs=0.02)
    assert counts[2] == pytest.approx(0.184, abs=0.02) and max(counts) < growing.MOST_TIMES
    assert drawn.corr("t1", "t2") == pytest.approx(0.0, abs=0.03)


def test_a_level_is_one_job(spark):
    """Jobs of one more tree do not grow with its leaves, but with its levels."""
    _, rows = labelled(spark, lists=60)
    points = rows.withColumns({"lam": F.col("grade").cast("double"), "w": F.lit(1.0)})
    binned, thresholds = growing.with_bins(points, 3, 64)
    asked = []
    look = growing.ArraySums.look

    def counted(self, rows, trees, wanted, pairs):
        asked.append(sum(map(len, wanted.values())))
        return look(self, rows, trees, wanted, pairs)

    growing.ArraySums.look, before = counted, look
    try:
        model = growing.grow(binned, thresholds, 32, 1, 1, 1.0)
    finally:
        growing.ArraySums.look = before
    depth = {0: 0}
    nodes = {n.node: n for n in model}
    for number in sorted(nodes):
        if not nodes[number].is_leaf:
            depth[nodes[number].left] = depth[nodes[number].right] = depth[number] + 1
    # one look a level; of two children only the smaller is summed
    assert len(asked) <= max(depth.values()) + 2 and sum(asked) <= 1.2 * len(model)
