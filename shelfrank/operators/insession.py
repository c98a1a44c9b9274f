"""Lists, contexts and product sums inside the row of a nested session.

A nested session holds all of its pages, so what ``sessions`` and ``catalog`` compute by
grouping hit rows is computed here by array functions over one row, with the same results:
no hit is ever shuffled. Groups are the runs of a sorted array, so work grows as the size of
a session times its logarithm.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.functions import numbers, text
from shelfrank.functions.arrays import with_runs
from shelfrank.operators.sessions import PURCHASE, visitors_of


def _entries(hit: Column, hit_pos: Column) -> Column:
    """Products of a page that may enter a list or mark a purchase."""
    on_search = F.coalesce(text.is_search_page(hit["pagepath"]), F.lit(False))
    bought = F.coalesce(hit["action_type"] == PURCHASE, F.lit(False))
    numbered = F.transform(
        hit["product"],
        lambda product, place: F.struct(
            F.when(on_search, text.normalize_query(hit["pagepath"])).alias("query"),
            product["sku"].alias("doc"),
            # two array indexes, so each fits in half a bigint
            (F.shiftleft(hit_pos.cast("bigint"), 32) + place).alias("seen"),
            numbers.flag(product["is_click"]).alias("click"),
            numbers.flag(bought).alias("bought"),
        ),
    )
    return F.filter(
        numbered, lambda x: F.coalesce(text.valid_sku(x["doc"]), F.lit(False)) & (on_search | bought)
    )


def rolled(sessions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per session with ``docs``: an array of (query, doc, seen, click, purchase).

    One entry per search and document, sorted by them: first place seen, highest click, and
    whether the document was bought on any page of the session.
    """
    # a page without products has none to give
    pages = F.transform("hits", lambda hit, i: F.coalesce(_entries(hit, i), F.array()))
    entries = sessions.select(
        *by, "session_id", "fv", "channel", F.coalesce(F.flatten(pages), F.array()).alias("_entries")
    )
    searched = F.filter("_entries", lambda x: x["query"].isNotNull())
    bought = F.transform(F.filter("_entries", lambda x: x["bought"] == 1), lambda x: x["doc"])
    by_place = F.sort_array(
        F.transform(searched, lambda x: F.struct(x["query"], x["doc"], x["seen"], x["click"]))
    )
    sorted_entries = entries.select(
        *by,
        "session_id",
        "fv",
        "channel",
        F.array_distinct(bought).alias("_bought"),
        by_place.alias("_sorted"),
    )
    same = lambda a, b: (a["query"] == b["query"]) & (a["doc"] == b["doc"])
    grouped = with_runs(sorted_entries, "_sorted", same, "_runs")

    def one(run: Column) -> Column:
        first = F.get(run, F.lit(0))
        purchase = numbers.flag(F.array_contains("_bought", first["doc"]))
        click = F.array_max(F.transform(run, lambda x: x["click"]))
        return F.struct(
            first["query"].alias("query"),
            first["doc"].alias("doc"),
            first["seen"].alias("seen"),
            F.greatest(click, purchase).alias("click"),
            purchase.alias("purchase"),
        )

    return grouped.select(*by, "session_id", "fv", "channel", F.transform("_runs", one).alias("docs"))


def rolled_docs(sessions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``rolled`` as rows, like ``sessions.rolled_docs`` over the exploded log."""
    return rolled(sessions, by).select(
        *by, "session_id", "fv", "channel", F.explode_outer("docs").alias("_doc")
    ).where("_doc IS NOT NULL").select(*by, "session_id", "fv", "channel", "_doc.*")


def session_lists(
    sessions: DataFrame, rate: float = 0.01, min_docs: int = 3, max_docs: int = 500
) -> DataFrame:
    """Result lists as ``sessions.session_lists`` makes them, without any exchange."""
    by_query = with_runs(
        rolled(sessions), "docs", lambda a, b: a["query"] == b["query"], "_lists"
    )

    def cut(docs: Column) -> Column:
        """A list up to its purchase, sampled, in the order in which it was seen."""
        last = F.array_max(F.transform(F.filter(docs, lambda x: x["purchase"] == 1), lambda x: x["seen"]))
        kept = F.filter(
            docs,
            lambda x: (last.isNull() | (x["seen"] <= last))
            & numbers.keep_sampled(x["click"], rate, F.col("session_id"), x["query"], x["doc"]),
        )
        return F.sort_array(
            F.transform(
                kept, lambda x: F.struct(x["seen"], x["query"], x["doc"], x["click"], x["purchase"])
            )
        )

    wanted = F.filter(
        "_lists",
        lambda docs: F.exists(docs, lambda x: x["click"] == 1)
        & (F.size(F.filter(docs, lambda x: x["purchase"] == 1)) <= 1),
    )
    lists = by_query.select("session_id", "fv", "channel", F.explode_outer(F.transform(wanted, cut)).alias("_list"))
    clicked = F.transform("_list", lambda x, i: F.when(x["click"] == 1, i + 1).otherwise(0))
    return (
        lists.where(F.size("_list").between(min_docs, max_docs))
        .select(
            "session_id",
            "fv",
            "channel",
            F.size("_list").cast("bigint").alias("n_docs"),
            F.array_max(clicked).cast("bigint").alias("last_click"),
            F.posexplode("_list").alias("_at", "_doc"),
        )
        .select(
            "session_id",
            "_doc.query",
            "fv",
            "channel",
            "_doc.doc",
            "_doc.click",
            "_doc.purchase",
            (F.col("_at") + 1).cast("bigint").alias("list_pos"),
            "last_click",
            "n_docs",
        )
    )


def _products(sessions: DataFrame) -> Column:
    """All products of a session; a page without products counts as one that is NULL."""
    kind = sessions.schema["hits"].dataType.elementType["product"].dataType.elementType
    none = F.array(F.lit(None).cast(kind))
    return F.flatten(
        F.transform(
            "hits", lambda hit: F.when(F.size(hit["product"]) > 0, hit["product"]).otherwise(none)
        )
    )


def visitor_context(sessions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per visitor what ``sessions.visitor_context`` finds; one row per session is shuffled."""
    prices = F.filter(
        F.transform(_products(sessions), lambda p: numbers.micros_to_units(p["price_micros"])),
        lambda x: x.isNotNull(),
    )
    per_session = (
        sessions.where(F.size("hits") > 0)
        .select(*by, "fv", "session_id", "channel", prices.alias("_prices"))
        .select(
            *by,
            "fv",
            "session_id",
            "channel",
            F.aggregate(
                "_prices", F.lit(0.0), lambda a, x: a + x, lambda a: F.try_divide(a, F.size("_prices"))
            ).alias("ticket"),
        )
    )
    return visitors_of(per_session, by)


def product_channel(sessions: DataFrame) -> DataFrame:
    """Impressions, clicks and price per session, channel and variant, without any exchange."""
    variant = ("sku", "category", "name")
    rows = sessions.select(
        "session_id",
        "channel",
        F.sort_array(
            F.transform(
                _products(sessions),
                lambda p: F.struct(
                    *(p[x].alias(x) for x in variant),
                    numbers.nullable_flag(p["is_impression"]).alias("impressions"),
                    numbers.nullable_flag(p["is_click"]).alias("clicks"),
                    numbers.micros_to_units(p["price_micros"]).alias("price"),
                ),
            )
        ).alias("_products"),
    )

    def same(a: Column, b: Column) -> Column:
        return a["sku"].eqNullSafe(b["sku"]) & a["category"].eqNullSafe(b["category"]) & a["name"].eqNullSafe(b["name"])

    def known(run: Column, name: str) -> Column:
        return F.filter(F.transform(run, lambda x: x[name]), lambda x: x.isNotNull())

    def total(values: Column, zero: Column) -> Column:
        return F.aggregate(values, zero, lambda a, x: a + x)

    def one(run: Column) -> Column:
        first = F.get(run, F.lit(0))
        flags = {x: F.transform(known(run, x), lambda v: v.cast("bigint")) for x in ("impressions", "clicks")}
        prices = known(run, "price")
        return F.struct(
            *(first[x].alias(x) for x in variant),
            *(F.when(F.size(v) > 0, total(v, F.lit(0).cast("bigint"))).alias(x) for x, v in flags.items()),
            F.try_divide(total(prices, F.lit(0.0)), F.size(prices)).alias("price"),
        )

    grouped = with_runs(rows, "_products", same, "_runs")
    rows = grouped.select("session_id", "channel", F.explode_outer(F.transform("_runs", one)).alias("_v"))
    return rows.where("_v IS NOT NULL").select("session_id", "channel", "_v.*")
