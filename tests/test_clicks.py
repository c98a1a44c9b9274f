import itertools
import random

import pytest
from pyspark.sql import functions as F

from shelfrank.operators import clicks, dbn
from shelfrank.sources import readers, writers

LISTS = (
    "session_id bigint, query string, doc string, click int, purchase int, "
    "list_pos bigint, last_click bigint"
)


def frame(spark, lists, query="q"):
    rows = []
    for number, (docs, clicked, bought) in enumerate(lists):
        last = max([i + 1 for i, c in enumerate(clicked) if c], default=0)
        for place, doc in enumerate(docs):
            rows.append(
                (number, query, doc, clicked[place], int(bought and place + 1 == last),
                 place + 1, last)
            )
    return spark.createDataFrame(rows, LISTS)


def test_sdbn(spark):
    lists = frame(
        spark,
        [(["d1", "d2", "d3"], [0, 1, 0], False), (["d2", "d1"], [1, 1], True)],
    )
    found = {row["doc"]: row for row in clicks.sdbn(lists, ["query"]).collect()}
    assert (found["d1"]["alpha"], found["d1"]["sigma"], found["d1"]["judgment"]) == (0.5, 1, 0.5)
    assert (found["d2"]["alpha"], found["d2"]["sigma"], found["d2"]["judgment"]) == (1, 0.5, 0.5)
    assert found["d3"]["judgment"] == 0


def test_golden_grades(spark, tmp_path):
    lines = [
        '{"search_term:keyword0|var1:val1": {"doc0": 0.1, "doc1": 0.9, "doc2": 0.5}}',
        '{"search_term:keyword1|var1:val1": {"doc1": 0.1, "doc2": 0.9}}',
        '{"search_term:keyword2|var1:val1": {"doc3": 0.1, "doc4": 0.9}}',
        '{"search_term:keyword3|var1:val1": {"doc5": 0.5, "doc6": 0.5}}',
    ]
    path = str(tmp_path / "model")
    spark.createDataFrame([(line,) for line in lines], "value string").write.option(
        "compression", "gzip"
    ).text(path)
    raw = readers.read_raw_judgments(spark, path).select(
        F.col("search_keys")["search_term"].alias("search_term"),
        F.col("search_keys")["var1"].alias("var1"),
        "doc",
        "judgment",
    )
    graded = clicks.grade(raw, ["search_term", "var1"])
    out = str(tmp_path / "judgments")
    writers.write_judgments(graded, ["search_term", "var1"], out)
    found = {}
    for row in readers.read_graded_judgments(spark, out).collect():
        assert row["search_keys"]["var1"] == "val1"
        found[row["search_keys"]["search_term"]] = dict(zip(row["docs"], row["grades"]))
    assert found == {
        "keyword0": {"doc0": 0, "doc1": 4, "doc2": 2},
        "keyword1": {"doc1": 0, "doc2": 4},
        "keyword2": {"doc3": 0, "doc4": 4},
    }


def test_grade_ties_and_order(spark):
    rows = [("q", "a", 0.0), ("q", "b", 0.5), ("q", "c", 0.5)]
    graded = clicks.grade(
        spark.createDataFrame(rows, "query string, doc string, judgment double"), ["query"]
    )
    assert {row["doc"]: row["grade"] for row in graded.collect()} == {"a": 0, "b": 2, "c": 2}


def test_grades_rise_with_judgments(spark):
    draw = random.Random(3)
    rows = [("q", f"d{i}", round(draw.random(), 3)) for i in range(60)]
    graded = clicks.grade(
        spark.createDataFrame(rows, "query string, doc string, judgment double"), ["query"]
    ).orderBy("judgment").collect()
    grades = [row["grade"] for row in graded]
    assert grades == sorted(grades) and set(grades) == {0, 1, 2, 3, 4}


# -- EM against enumeration of all hidden states ------------------------------


def brute_step(lists, alpha, sigma, gamma):
    """One EM step by summing over every hidden state of every list."""
    top = {("a", d): 0.0 for d in alpha} | {("s", d): 0.0 for d in alpha}
    bottom = dict.fromkeys(top, 0.0)
    gamma_top = gamma_bottom = 0.0
    likelihood = 1.0
    for docs, clicked, bought in lists:
        size = len(docs)
        last = max([i for i, c in enumerate(clicked) if c], default=-1)
        total = 0.0
        sums = []
        # a state: attracted and satisfied and went-on flags per place
        for attracted in itertools.product([0, 1], repeat=size):
            for leave in itertools.product([0, 1, 2], repeat=size):
                # leave: 0 goes on, 1 stops after the place unsatisfied, 2 is satisfied
                weight, examined, seen = 1.0, True, []
                for place, doc in enumerate(docs):
                    weight *= alpha[doc] if attracted[place] else 1 - alpha[doc]
                    seen.append(examined)
                    click = examined and attracted[place]
                    if click != bool(clicked[place]):
                        weight = 0.0
                        break
                    kind = leave[place]
                    if not examined:
                        # hidden choices below the stop are summed out once
                        weight *= 1.0 if kind == 0 else 0.0
                        continue
                    if bought and place == last and kind != 2:
                        weight = 0.0
                        break
                    if kind == 2:
                        weight *= sigma[doc] if click else 0.0
                        if bought and place == last:
                            weight /= sigma[doc]
                        examined = False
                        continue
                    if click:
                        weight *= 1 - sigma[doc]
                    if place + 1 == size:
                        weight *= 1.0 if kind == 0 else 0.0
                        continue
                    weight *= gamma if kind == 0 else 1 - gamma
                    examined = kind == 0
                if weight:
                    total += weight
                    sums.append((weight, attracted, leave, seen))
        likelihood *= total
        for weight, attracted, leave, seen in sums:
            share = weight / total
            for place, doc in enumerate(docs):
                top["a", doc] += share * attracted[place]
                bottom["a", doc] += share
                if clicked[place]:
                    top["s", doc] += share * (leave[place] == 2)
                    bottom["s", doc] += share
                if seen[place] and leave[place] != 2 and place + 1 < size:
                    gamma_top += share * (leave[place] == 0)
                    gamma_bottom += share
    new_alpha = {d: top["a", d] / bottom["a", d] for d in alpha}
    new_sigma = {
        d: top["s", d] / bottom["s", d] if bottom["s", d] else 0.0 for d in alpha
    }
    return new_alpha, new_sigma, gamma_top / gamma_bottom, likelihood


def random_lists(seed, count=6):
    draw = random.Random(seed)
    lists = []
    for _ in range(count):
        docs = draw.sample("abcde", draw.randint(2, 4))
        clicked = [int(draw.random() < 0.4) for _ in docs]
        bought = False
        if any(clicked) and draw.random() < 0.3:
            last = max(i for i, c in enumerate(clicked) if c)
            docs, clicked, bought = docs[: last + 1], clicked[: last + 1], True
        lists.append((docs, clicked, bought))
    lists.append((["a", "b", "c", "d", "e"][:4], [1, 0, 0, 0], False))
    lists.append((["a", "b", "c", "d", "e"][:4], [1, 0, 0, 0], False))
    lists.append((["e", "a"], [0, 0], False))
    return lists


@pytest.mark.parametrize("seed, rows_per_salt", [(1, 250_000), (2, 1)])
def test_em_matches_enumeration(spark, seed, rows_per_salt):
    lists = random_lists(seed)
    docs = {doc for row in lists for doc in row[0]}
    alpha, sigma, gamma = dict.fromkeys(docs, 0.5), dict.fromkeys(docs, 0.5), 0.9
    for _ in range(3):
        alpha, sigma, gamma, _ = brute_step(lists, alpha, sigma, gamma)
    fitted = dbn.dbn_em(
        frame(spark, lists), ["query"], iterations=3, rows_per_salt=rows_per_salt
    ).collect()
    assert {row["doc"] for row in fitted} == docs
    for row in fitted:
        assert row["alpha"] == pytest.approx(alpha[row["doc"]], abs=1e-9)
        assert row["sigma"] == pytest.approx(sigma[row["doc"]], abs=1e-9)
        assert row["gamma"] == pytest.approx(gamma, abs=1e-9)
        assert row["judgment"] == pytest.approx(row["alpha"] * row["sigma"], abs=1e-12)


def test_likelihood_never_falls():
    lists = random_lists(5)
    docs = {doc for row in lists for doc in row[0]}
    alpha, sigma, gamma = dict.fromkeys(docs, 0.5), dict.fromkeys(docs, 0.5), 0.9
    seen = []
    for _ in range(8):
        alpha, sigma, gamma, likelihood = brute_step(lists, alpha, sigma, gamma)
        seen.append(likelihood)
    assert all(b >= a - 1e-12 for a, b in zip(seen, seen[1:]))


def test_em_of_finished_lists_is_sdbn(spark):
    lists = [
        (["a", "b", "c"], [1, 0, 1], True),
        (["b", "a"], [0, 1], True),
        (["c", "b"], [1, 1], True),
    ]
    data = frame(spark, lists)
    closed = {row["doc"]: row for row in clicks.sdbn(data, ["query"]).collect()}
    for row in dbn.dbn_em(data, ["query"], iterations=1).collect():
        assert row["alpha"] == pytest.approx(closed[row["doc"]]["alpha"])
        assert row["sigma"] == pytest.approx(closed[row["doc"]]["sigma"])


def test_em_recovers_known_parameters(spark):
    draw = random.Random(11)
    alpha = {"a": 0.8, "b": 0.3, "c": 0.6, "d": 0.45}
    sigma = {"a": 0.7, "b": 0.5, "c": 0.2, "d": 0.6}
    gamma = 0.85
    lists = []
    for _ in range(6000):
        docs = draw.sample("abcd", 4)
        clicked, examined = [0] * 4, True
        for place, doc in enumerate(docs):
            if not examined:
                break
            if draw.random() < alpha[doc]:
                clicked[place] = 1
                if draw.random() < sigma[doc]:
                    break
            examined = draw.random() < gamma
        lists.append((docs, clicked, False))
    fitted = dbn.dbn_em(frame(spark, lists), ["query"], iterations=25).collect()
    for row in fitted:
        assert row["alpha"] == pytest.approx(alpha[row["doc"]], abs=0.06)
        assert row["judgment"] == pytest.approx(
            alpha[row["doc"]] * sigma[row["doc"]], abs=0.08
        )


def test_export(spark):
    rows = spark.createDataFrame(
        [("pen", "direct", "a", 0.5)], "search_term string, c string, doc string, judgment double"
    )
    row = dbn.export_judgments(rows, ["search_term", "c"]).first()
    assert (row["key"], row["doc"], row["judgment"]) == ("search_term:pen|c:direct", "a", 0.5)
