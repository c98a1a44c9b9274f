"""Hot keys and plan shapes."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from shelfrank.operators import catalog, clicks, sessions, skew, textmatch
from shelfrank.plans import queries
from shelfrank.sources import adapter

PATH = "/google+redesign/shop/"


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of 6,000 hits in one session and one search; lists of three besides."""
    row = F.col("id")
    hot = row % 3 == 0
    return spark.range(0, 6000, 1, 8).select(
        F.when(hot, 0).otherwise(F.floor(row / 5) + 1).alias("fv"),
        F.when(hot, 0).otherwise(F.floor(row / 5) + 1).alias("session_id"),
        F.lit("2024-01-01").cast("date").alias("session_date"),
        F.lit("Direct").alias("channel"),
        row.alias("hit_pos"),
        F.lit(0).cast("bigint").alias("product_pos"),
        row.alias("place"),
        F.concat(F.lit(PATH), F.when(hot, F.lit("hot")).otherwise(F.lit("pen"))).alias("pagepath"),
        F.lit("0").alias("action_type"),
        F.concat(F.lit("d"), row.cast("string")).alias("sku"),
        F.lit("pen").alias("name"),
        F.lit("a/b").alias("category"),
        F.lit(1_000_000).cast("bigint").alias("price_micros"),
        F.when(row % 2 == 0, F.lit(True)).alias("is_click"),
        F.lit(True).alias("is_impression"),
    )


def test_hot_session_positions(skewed):
    positions = sessions.search_hits(skewed).filter("session_id = 0").orderBy("position")
    assert [r["position"] for r in positions.collect()] == list(range(1, 2001))


def test_hot_list_is_whole_or_dropped(skewed):
    kept = sessions.session_lists(skewed, 1.0, max_docs=2000)
    assert kept.filter("session_id = 0").count() == 2000
    limited = sessions.session_lists(skewed, 1.0, max_docs=1999)
    assert limited.filter("session_id = 0").count() == 0
    # every other list is untouched by the hot one
    assert limited.count() == kept.filter("session_id <> 0").count() > 0


def test_hot_search_is_graded_whole(spark, skewed):
    lists = sessions.session_lists(skewed, 1.0, max_docs=2000)
    judged = clicks.sdbn(lists, ["query"])
    spread = judged.withColumn(
        "judgment", (F.xxhash64("doc") % 1000 / 2000.0 + 0.5).cast("double")
    )
    graded = clicks.grade(spread, ["query"])
    assert graded.filter("query = 'hot'").count() == 2000
    shares = graded.filter("query = 'hot'").groupBy("grade").count().collect()
    assert {r["grade"] for r in shares} == {0, 1, 2, 3, 4}
    assert all(380 <= r["count"] <= 420 for r in shares)


def test_hot_sku_totals(skewed):
    one = skewed.withColumn("sku", F.when(F.col("session_id") == 0, F.lit("hot")).otherwise("sku"))
    rows = catalog.catalog_rows(catalog.product_channel(one)).filter("sku = 'hot'").first()
    assert (rows["impressions"], rows["clicks"]) == (2000, 1000)


def test_lists_read_the_log_once(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lists = queries.event_lists(spark, sf_dir)
        lists.collect()
        text = plan(lists).split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ReusedExchange" in text
    assert "WindowGroupLimit" in text
    assert "SortAggregate" not in text


def test_no_shuffle_for_nested_sessions(spark, sf_dir):
    for name in ("unnest_hits", "nested_search_hits", "purchased_from_search"):
        assert "Exchange" not in plan(queries.queries()[name](spark, sf_dir))


def test_scan_reads_only_what_is_used(spark, sf_dir):
    text = plan(queries.queries()["err_documents"](spark, sf_dir))
    assert "text" not in "".join(line for line in text.splitlines() if "ReadSchema" in line)


@pytest.mark.parametrize("name", ["first_pass_topk", "match_all_terms", "feature_log"])
def test_no_cross_joins(spark, sf_dir, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(queries.queries()[name](spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_common_terms_are_not_joined(spark):
    """Candidates come from the rarest term: common words cost nothing."""
    docs = spark.range(2000).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("sku"),
        F.concat(F.lit("common words word"), F.col("id").cast("string")).alias("name"),
        F.lit("c").alias("category"),
    )
    tokens = textmatch.with_tokens(docs, ["name", "category"])
    asked = spark.createDataFrame([("common words word7",)], "search_term string")
    found = textmatch.match_cross_fields(asked, tokens, ["name", "category"]).collect()
    assert [r["sku"] for r in found] == ["k7"]


def test_order_sessions_are_dealt_by_rows(spark, tmp_path, monkeypatch):
    """The step of join, sums and windows per session has as many tasks as its rows ask for."""
    row = F.col("id")
    spark.range(300).select(
        row.alias("o_orderkey"),
        (row % 7).alias("o_custkey"),
        F.lit("1998-02-06").cast("timestamp").alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority"),
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(1200).select(
        (row % 300).alias("l_orderkey"),
        row.alias("l_partkey"),
        F.floor(row / 300).cast("int").alias("l_linenumber"),
        F.lit(30.0).alias("l_extendedprice"),
        F.lit(3.0).alias("l_quantity"),
        F.when(row < 300, "R").otherwise("A").alias("l_returnflag"),
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(adapter, "tasks_for", lambda t: skew.tasks_for(t, 100), raising=False)
    rolled = sessions.rolled_docs(adapter.order_hits(spark, str(tmp_path)))
    assert rolled.rdd.getNumPartitions() == 12
    assert rolled.count() == 1200
    assert sessions.session_lists(adapter.order_hits(spark, str(tmp_path)), 1.0, 1).count() == 300


def test_matches_are_not_gathered_per_search(spark):
    """A candidate is checked in its own row: no sums by search and document of candidates."""
    docs = spark.range(600).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("sku"),
        F.concat_ws(" ", F.lit("a"), F.concat(F.lit("b"), F.col("id") % 2), F.concat(F.lit("c"), F.col("id") % 3)).alias("name"),
        F.concat(F.lit("t"), F.col("id") % 5).alias("category"),
    )
    index = textmatch.index_of(docs, ["name", "category"])
    asked = spark.createDataFrame([("a b1 c2 t4",), ("b1 t4",), ("c2",), ("b1 c9",)], "search_term string")
    scored = textmatch.matched_scores(asked, index, ["name", "category"])
    found = {}
    for r in scored.collect():
        found.setdefault(r["search_term"], set()).add(r["sku"])
    assert found == {
        "a b1 c2 t4": {f"k{i}" for i in range(600) if i % 2 == 1 and i % 3 == 2 and i % 5 == 4},
        "b1 t4": {f"k{i}" for i in range(600) if i % 2 == 1 and i % 5 == 4},
        "c2": {f"k{i}" for i in range(600) if i % 3 == 2},
    }
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        scored.explain()
    assert not re.search(r"Aggregate\(keys=\[search_term#\d+, sku#\d+", text.getvalue())


def test_counts_are_not_dealt_out(spark):
    """Words are counted where a document is read; only rows of a repeated key meet."""
    rows = [(i, f"w{i} x x") for i in range(50)]
    docs = spark.createDataFrame(rows, "sku bigint, name string")
    entries = textmatch.index_of(docs, ["name"]).entries
    assert {(r["sku"], r["term"], r["tf_name"]) for r in entries.filter("term IS NOT NULL").collect()} == {
        x for i in range(50) for x in ((i, f"w{i}", 1), (i, "x", 2))
    }
    entries.collect()
    assert not re.search(r"(?<!Broadcast)Exchange", plan(entries).split("== Initial Plan ==")[0])
    odd = [(1, "a b b"), (1, "b a c"), (1, "a"), (None, "a"), (None, "a"), (2, None), (3, "")]
    counted = textmatch.index_of(spark.createDataFrame(odd, "sku bigint, name string"), ["name"]).entries
    expected = [(1, "a", 2, 3), (1, "b", 3, 3), (1, "c", 1, 3), (1, "a", 1, 1), (None, "a", 2, 1)]
    found = counted.filter("term IS NOT NULL").select("sku", "term", "tf_name", "len_name")
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))
    alone = counted.filter("term IS NULL").select("sku", "len_name")
    assert sorted(map(str, map(tuple, alone.collect()))) == sorted(
        map(str, [(1, 3), (1, 1), (None, 1), (2, 0), (3, 0)])
    )
