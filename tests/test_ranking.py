import math
import random

import pytest
from pyspark.sql import functions as F

from shelfrank.operators import ensemble, features, metrics, ranking, textmatch, training
from shelfrank.sources import readers

RATES = [f"ctr_{c}" for c in (
    "organic_search", "direct", "referral", "paid_search", "display", "affiliates", "social"
)]


def make_catalog(spark, rows):
    """rows: sku, name, category, price, ctr."""
    frame = spark.createDataFrame(
        rows, "sku string, name string, category string, price double, ctr double"
    )
    return frame.select("*", *[(F.col("ctr") / (i + 1)).alias(c) for i, c in enumerate(RATES)])


@pytest.fixture(scope="module")
def small(spark):
    return make_catalog(
        spark,
        [
            ("s1", "red pen", "office pens", 2.0, 0.1),
            ("s2", "blue pen", "office", 3.0, 0.5),
            ("s3", "red ink red", "refill", 4.0, 0.0),
            ("s4", "paper", "office red", 5.0, 0.2),
            ("pen", "ballpoint", "office", 6.0, 0.9),
        ],
    )


def brute_bm25(docs, tokens, query):
    lengths = [len(t) for t in tokens if t]
    average = sum(lengths) / len(lengths)
    scores = []
    for words in tokens:
        score = 0.0
        for term in query:
            df = sum(term in t for t in tokens)
            tf = words.count(term)
            idf = math.log(1 + (len(lengths) - df + 0.5) / (df + 0.5))
            score += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / average))
        scores.append(score)
    return dict(zip(docs, scores))


def test_bm25_against_brute_force(spark, small):
    docs = textmatch.with_tokens(small, ["name", "category"])
    rows = small.collect()
    queries = ["red pen", "red red office", "unknown", "pen ink paper"]
    pairs = spark.createDataFrame(
        [(q, r["sku"]) for q in queries for r in rows], "search_term string, sku string"
    )
    found = {
        (r["search_term"], r["sku"]): r
        for r in textmatch.bm25(pairs, docs, ["name", "category"]).collect()
    }
    assert len(found) == len(queries) * len(rows)
    for field in ("name", "category"):
        tokens = [r[field].split() for r in rows]
        for query in queries:
            expected = brute_bm25([r["sku"] for r in rows], tokens, query.split())
            for sku, score in expected.items():
                assert found[query, sku][f"bm25_{field}"] == pytest.approx(score, abs=1e-9)


def test_cross_field_match(spark, small):
    docs = textmatch.with_tokens(small, ["name", "category"])
    queries = spark.createDataFrame(
        [("red office",), ("pen",), ("red missing",), ("RED  pen",), ("!",)], "search_term string"
    )
    found = sorted(
        (r["search_term"], r["sku"], r["exact"])
        for r in textmatch.match_cross_fields(queries, docs, ["name", "category"]).collect()
    )
    assert found == [
        ("RED  pen", "s1", False),
        ("pen", "pen", True),
        ("pen", "s1", False),
        ("pen", "s2", False),
        ("red office", "s1", False),
        ("red office", "s4", False),
    ]


def test_match_of_a_hot_term(spark):
    """A third of the catalog shares one term; every match is found."""
    rows = [(f"k{i}", "common word" if i % 3 == 0 else f"rare{i}", "c", 1.0, 0.0) for i in range(900)]
    docs = textmatch.with_tokens(make_catalog(spark, rows), ["name", "category"])
    queries = spark.createDataFrame([("common",), ("word common",)], "search_term string")
    found = textmatch.match_cross_fields(queries, docs, ["name", "category"])
    assert {r["search_term"]: r["count"] for r in found.groupBy("search_term").count().collect()} == {
        "common": 300,
        "word common": 300,
    }


MODEL = [
    ensemble.Node(1, 0, 1.0, feature=1, threshold=1.0, left=1, right=2),
    ensemble.Node(1, 1, 1.0, output=2.0),
    ensemble.Node(1, 2, 1.0, output=-2.0),
]


def test_search_and_rescore(spark, small):
    contexts = spark.createDataFrame(
        [("office", "direct", 2), ("office", "social", 6)],
        "search_term string, channel_group string, customer_avg_ticket bigint",
    )
    plain = ranking.search(contexts, small, use_ltr=False)
    order = [
        r["sku"] for r in plain.filter("channel_group = 'direct'").orderBy("pos").collect()
    ]
    assert order == ["pen", "s2", "s4", "s1"]
    scores = {r["sku"]: r["score"] for r in plain.collect()}
    found = ranking.search(contexts, small, MODEL, window=3)
    direct = found.filter("channel_group = 'direct'").orderBy("pos").collect()
    # distances to 2: pen ln 5, s2 ln 2 (<= 1: +2), s4 ln 4; s1 is outside the window
    assert [r["sku"] for r in direct] == ["s2", "pen", "s4", "s1"]
    assert direct[0]["score"] == pytest.approx(0.1 * scores["s2"] + 40, abs=1e-6)
    assert direct[3]["score"] == pytest.approx(scores["s1"], abs=1e-6)
    top = ranking.search(contexts, small, MODEL, size=2, window=3)
    assert top.count() == 4
    assert [r["pos"] for r in found.filter("channel_group = 'social'").orderBy("pos").collect()] == [
        0, 1, 2, 3,
    ]


def test_features(spark, small):
    rows = spark.createDataFrame(
        [("red pen", "direct", 4, "s1", 3), ("red pen", "", 4, "s3", 1), ("red", "social", 2, "zz", 0)],
        "search_term string, channel_group string, customer_avg_ticket bigint, doc string, grade int",
    )
    found = {r["doc"]: r["features"] for r in features.log_features(rows, small).collect()}
    assert set(found) == {"s1", "s3"}  # not in the catalog: no features
    assert found["s1"][0] == pytest.approx(math.log(3))
    assert found["s1"][2] == pytest.approx(0.05 * 10)
    assert found["s3"][2] == 0.0  # unknown channel
    assert found["s3"][1] == 0.0 and found["s3"][3] > 0


def test_normalise(spark):
    rows = spark.createDataFrame(
        [(0, [1.0, 0.0]), (0, [-3.0, 0.0]), (1, [5.0, 2.0])], "qid bigint, features array<double>"
    )
    found = sorted((r["qid"], list(r["features"])) for r in features.normalise(rows, size=2).collect())
    assert found == [(0, [-0.75, 0.0]), (0, [0.25, 0.0]), (1, [1.0, 1.0])]


# -- metrics ------------------------------------------------------------------


def test_err(spark):
    rows = spark.createDataFrame(
        [("q", 3, 4), ("q", 2, 0), ("q", 1, 2)], "query string, score int, grade int"
    )
    found = metrics.err_at_k(rows, ["query"], [F.desc("score")]).first()["err"]
    assert found == pytest.approx(0.94140625)


def test_mean_percentile_rank(spark):
    retrieved = spark.createDataFrame(
        [(q, pos, f"doc{3 - pos}") for q in range(3) for pos in range(4)] + [(9, 0, "doc0")],
        "query_id int, pos bigint, sku string",
    )
    bought = spark.createDataFrame(
        [(0, "doc0"), (0, "doc1"), (0, "doc1"), (1, "doc0"), (2, "doc2"), (2, "doc3"), (9, "doc0")],
        "query_id int, sku string",
    )
    rank = metrics.mean_percentile_rank(retrieved, bought, ["query_id"]).first()["rank"]
    assert rank == pytest.approx(0.6)
    nothing = bought.filter("query_id = 9")
    assert metrics.mean_percentile_rank(retrieved, nothing, ["query_id"]).first()["rank"] == 0.5


# -- models -------------------------------------------------------------------

TEXT = """## LambdaMART
## No. of trees = 1
## Learning rate = 0.1

<ensemble>
	<tree id="1" weight="0.1">
		<split>
			<feature> 4 </feature>
			<threshold> 0.25 </threshold>
			<split pos="left">
				<feature> 1 </feature>
				<threshold> 0.5 </threshold>
				<split pos="left">
					<output> -1.75 </output>
				</split>
				<split pos="right">
					<output> 0.5 </output>
				</split>
			</split>
			<split pos="right">
				<output> 2.0 </output>
			</split>
		</split>
	</tree>
</ensemble>
"""


def test_model_file(spark, tmp_path):
    file = tmp_path / "model.txt"
    file.write_text(TEXT)
    model, settings = readers.read_ensemble(spark, str(file))
    assert settings["Learning rate"] == "0.1"
    rows = spark.createDataFrame(
        [([0.5, 0.0, 0.0, 0.25],), ([0.6, 0.0, 0.0, 0.2],), ([0.0, 0.0, 0.0, 0.3],)],
        "features array<double>",
    )
    scored = ensemble.score_ensemble(rows, model).collect()
    assert [r["model_score"] for r in scored] == pytest.approx([-0.175, 0.05, 0.2])


def test_expression_and_batch_scoring_agree(spark):
    draw = random.Random(7)
    model = []
    for tree in range(1, 61):
        model += [
            ensemble.Node(tree, 0, 0.1, feature=draw.randint(1, 4), threshold=draw.random(), left=1, right=2),
            ensemble.Node(tree, 1, 0.1, output=draw.gauss(0, 1)),
            ensemble.Node(tree, 2, 0.1, feature=draw.randint(1, 4), threshold=draw.random(), left=3, right=4),
            ensemble.Node(tree, 3, 0.1, output=draw.gauss(0, 1)),
            ensemble.Node(tree, 4, 0.1, output=draw.gauss(0, 1)),
        ]
    rows = spark.createDataFrame(
        [([draw.random() for _ in range(4)],) for _ in range(50)], "features array<double>"
    )
    halves = [
        ensemble.ensemble_column([n for n in model if (n.tree <= 30) == first], F.col("features"))
        for first in (True, False)
    ]
    both = rows.select(
        (halves[0] + halves[1]).alias("a"),
        ensemble.ensemble_column(model, F.col("features")).alias("b"),
    )
    for row in both.collect():
        assert row["a"] == pytest.approx(row["b"], abs=1e-9)


def brute_lambdas(rows, k=10):
    """All pairs of one list, ERR@k before and after each swap."""
    order = sorted(rows, key=lambda r: (-r[2], r[0]))
    gains = [(2 ** r[1] - 1) / 16 for r in order]

    def err(values):
        total, passed = 0.0, 1.0
        for place, gain in enumerate(values[:k], 1):
            total += passed * gain / place
            passed *= 1 - gain
        return total

    base = err(gains)
    lam = dict.fromkeys([r[0] for r in order], 0.0)
    w = dict(lam)
    for i in range(len(order)):
        for j in range(i + 1, len(order)):
            if order[i][1] == order[j][1]:
                continue
            swapped = list(gains)
            swapped[i], swapped[j] = swapped[j], swapped[i]
            change = abs(err(swapped) - base)
            high, low = (i, j) if order[i][1] > order[j][1] else (j, i)
            rho = 1 / (1 + math.exp(order[high][2] - order[low][2]))
            lam[order[high][0]] += change * rho
            lam[order[low][0]] -= change * rho
            for place in (i, j):
                w[order[place][0]] += change * rho * (1 - rho)
    return lam, w


@pytest.mark.parametrize("size", [2, 7, 10, 11, 40])
def test_lambdas_against_all_pairs(spark, size):
    draw = random.Random(size)
    rows = [(f"d{i:02d}", float(draw.randint(0, 4)), draw.choice([0.0, draw.random()])) for i in range(size)]
    frame = spark.createDataFrame(
        [(0, d, g, s) for d, g, s in rows], "qid bigint, doc string, grade double, F double"
    )
    lam, w = brute_lambdas(rows)
    found = {r["doc"]: r for r in training.lambda_gradients(frame).collect()}
    assert set(found) == set(lam)
    for doc in lam:
        assert found[doc]["lam"] == pytest.approx(lam[doc], abs=1e-9)
        assert found[doc]["w"] == pytest.approx(w[doc], abs=1e-9)


@pytest.fixture(scope="module")
def learnable(spark):
    draw = random.Random(1)
    rows = []
    for qid in range(30):
        for i in range(12):
            x = [draw.random() for _ in range(4)]
            grade = min(4, int(5 * (0.8 * x[2] + 0.2 * draw.random())))
            rows.append((qid, f"d{i:02d}", grade, x))
    return spark.createDataFrame(
        rows, "qid bigint, doc string, grade int, features array<double>"
    ).cache()


@pytest.mark.parametrize(
    "name, parameters",
    [
        ("lambdamart", {"trees": 4, "leaf": 4}),
        ("mart", {"trees": 4, "leaf": 4}),
        ("random forest", {"trees": 4, "leaf": 8}),
        ("coordinate ascent", {"rounds": 1}),
    ],
)
def test_rankers_learn(learnable, name, parameters):
    model = training.train(name, learnable, 4, **parameters)
    before = training.mean_err(learnable, F.lit(0.0))
    after = training.mean_err(learnable, ensemble.score_column(model, F.col("features")))
    assert after > before + 0.05


def test_names(learnable):
    with pytest.raises(ValueError, match="no ranker 'other'"):
        training.train("other", learnable, 4)
    with pytest.raises(ValueError, match="does not take"):
        training.check_space("random forest", training.SEARCH_SPACE["lambdamart"])
    for name, space in training.SEARCH_SPACE.items():
        training.check_space(name, space)
