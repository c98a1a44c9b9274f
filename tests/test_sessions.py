import datetime

import pytest
from pyspark.sql import functions as F

from shelfrank.operators import numbering, sessions
from shelfrank.schemas import SESSIONS
from shelfrank.sources import adapter

DAY = datetime.date(2024, 1, 1)
SEARCH = "/google+redesign/shop/"


def product(sku, click=None, price=10):
    return (sku, f"name {sku}", "a/b", price * 1_000_000, click, None)


@pytest.fixture(scope="module")
def nested(spark):
    rows = [
        (
            "v1",
            1,
            DAY,
            "Direct",
            [
                (SEARCH + "pen", "0", [product("a"), product("b", True), product("(not set)")]),
                (SEARCH + "home", "0", [product("z", True)]),
                (SEARCH + "pen", "0", [product("b"), product("c"), product("d")]),
                ("/basket", "6", [product("c")]),
                (SEARCH + "ink", "0", []),
            ],
        ),
        (
            "v1",
            2,
            DAY,
            None,
            [(SEARCH + "pen", "0", [product("a", True), product("b"), product("e")])],
        ),
        # two purchased documents in one list
        (
            "v2",
            3,
            DAY,
            "Paid Search",
            [
                (SEARCH + "pen", "0", [product("a"), product("b"), product("c")]),
                ("/basket", "6", [product("a"), product("b")]),
            ],
        ),
        # no click at all
        ("v3", 4, DAY, None, [(SEARCH + "pen", "0", [product("a"), product("b"), product("c")])]),
    ]
    return spark.createDataFrame(rows, SESSIONS)


def test_nested_and_flat_positions_agree(nested):
    flat = sessions.search_hits(sessions.explode_sessions(nested))
    columns = ["session_id", "fv", "query", "doc", "click", "position"]
    inside = sessions.nested_search_hits(nested)
    assert sorted(flat.select(columns).collect()) == sorted(inside.select(columns).collect())


def test_outer_unnest_keeps_empty_pages(nested):
    rows = sessions.explode_sessions(nested).filter("session_id = 1")
    assert rows.count() == 9
    assert rows.filter("sku IS NULL").count() == 1
    inner = sessions.explode_sessions(nested, outer=False).filter("session_id = 1")
    assert inner.count() == 8


def test_lists(nested):
    lists = sessions.session_lists(sessions.explode_sessions(nested), rate=1.0)
    found = {
        (r["session_id"], r["doc"]): (r["click"], r["purchase"], r["list_pos"], r["last_click"])
        for r in lists.collect()
    }
    # session 1 ends at its purchase: d is cut; sessions 3 and 4 are not usable
    assert found == {
        (1, "a"): (0, 0, 1, 3),
        (1, "b"): (1, 0, 2, 3),
        (1, "c"): (1, 1, 3, 3),
        (2, "a"): (1, 0, 1, 1),
        (2, "b"): (0, 0, 2, 1),
        (2, "e"): (0, 0, 3, 1),
    }


def test_list_size_limits(nested):
    hits = sessions.explode_sessions(nested)
    assert sessions.session_lists(hits, 1.0, min_docs=4).count() == 0
    assert sessions.session_lists(hits, 1.0, max_docs=2).count() == 0
    assert sessions.session_lists(hits, 1.0, min_docs=1, max_docs=3).count() == 6


def test_visitors(nested):
    found = {
        row["fv"]: (row["channel_group"], row["avg_ticket"])
        for row in sessions.visitor_context(sessions.explode_sessions(nested)).collect()
    }
    assert found == {"v1": ("direct", 10), "v2": ("paid_search", 10), "v3": ("", 10)}


def test_average_of_averages(spark):
    rows = [
        ("v", 1, DAY, "Direct", [("/p", "0", [product("a", price=1), product("b", price=3)])]),
        ("v", 2, DAY, "Direct", [("/p", "0", [product("a", price=7)])]),
    ]
    hits = sessions.explode_sessions(spark.createDataFrame(rows, SESSIONS))
    # (2 + 7) / 2, not 11 / 3; half is rounded away from zero
    row = sessions.visitor_context(hits).first()
    assert (row["raw_ticket"], row["avg_ticket"]) == (4.5, 5)


def test_validation_uses_session_channel_and_any_purchase_page(nested):
    hits = sessions.explode_sessions(nested)
    sets = sessions.validation_sets(hits, sessions.visitor_context(hits))
    found = sorted((r["session_id"], r["channel_group"], r["sku"]) for r in sets.collect())
    assert found == [(1, "direct", "c"), (3, "paid_search", "a"), (3, "paid_search", "b")]


def test_windows_must_be_disjoint(spark, sf_dir):
    hits = adapter.event_hits(spark, sf_dir)
    with pytest.raises(ValueError):
        sessions.temporal_split(
            hits, {"a": ("2024-01-01", "2024-01-10"), "b": ("2024-01-10", "2024-01-12")}
        )


def test_numbering_of_a_hot_key(spark):
    """One key with a third of all rows, spread over many chunks."""
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("key"),
        F.col("id").alias("at"),
    )
    numbered = numbering.numbered_within(rows, ["key"], ["at"], F.floor(F.col("at") / 100), "n")
    hot = numbered.filter("key = 0").orderBy("at").collect()
    assert [row["n"] for row in hot] == list(range(1, 3001))
    assert numbered.filter("key <> 0 AND n <> 1").count() == 0


def test_sorted_index(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("value"))
    indexed = numbering.sorted_index(rows, ["value"], "at")
    assert indexed.filter("at <> value").count() == 0
    assert indexed.count() == 5000


def test_percentiles_match_the_builtin(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
            F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))
        ).alias("key"),
        (F.col("id") * 37 % 101 / 100).alias("value"),
        F.col("id").alias("unique"),
    )
    points = [0.2, 0.4, 0.6, 0.8, 1.0]
    ours = numbering.group_percentiles(rows, ["key"], "value", "unique", points)
    builtin = rows.groupBy("key").agg(
        F.percentile("value", F.array(*[F.lit(p) for p in points])).alias("expected")
    )
    for row in ours.join(builtin, "key").collect():
        assert row["percentiles"] == pytest.approx(row["expected"], abs=1e-12)
