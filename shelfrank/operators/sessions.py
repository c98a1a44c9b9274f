"""From session logs to click lists, visitor contexts and evaluation sets.

A *hit* row is one product on one page of one session. ``place`` is unique in a
session and rises with ``(hit_pos, product_pos)``; comparing places gives the
same order as numbering the rows would, so the list operators never number a
session.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.functions import arrays, numbers, text
from shelfrank.operators.numbering import numbered_within

CONTEXT = ["search_term", "channel_group", "customer_avg_ticket"]

# fixed value: action type of a purchase page
PURCHASE = "6"

HITS_PER_CHUNK = 4096


# -- unnesting ---------------------------------------------------------------


def explode_sessions(sessions: DataFrame, outer: bool = True) -> DataFrame:
    """Nested sessions -> hit rows; ``outer`` keeps pages without products."""
    pages = sessions.select(
        "fv",
        "session_id",
        "session_date",
        "channel",
        F.posexplode("hits").alias("hit_pos", "hit"),
    )
    unnest = F.posexplode_outer if outer else F.posexplode
    rows = pages.select("*", unnest("hit.product").alias("product_pos", "product"))
    return rows.select(
        "fv",
        "session_id",
        "session_date",
        "channel",
        F.col("hit_pos").cast("bigint").alias("hit_pos"),
        F.col("product_pos").cast("bigint").alias("product_pos"),
        # two array indexes, so each fits in half a bigint
        (
            F.shiftleft(F.col("hit_pos").cast("bigint"), 32)
            + F.coalesce("product_pos", F.lit(0))
        ).alias("place"),
        F.col("hit.pagepath").alias("pagepath"),
        F.col("hit.action_type").alias("action_type"),
        "product.*",
    )


def nested_search_hits(sessions: DataFrame) -> DataFrame:
    """Search hits with positions, numbered inside the row: no shuffle at all."""
    kept_pages = F.filter("hits", lambda hit: text.is_search_page(hit["pagepath"]))
    per_page = F.transform(
        kept_pages,
        lambda hit: F.transform(
            F.filter(hit["product"], lambda product: text.valid_sku(product["sku"])),
            lambda product: F.struct(
                text.normalize_query(hit["pagepath"]).alias("query"),
                product["sku"].alias("doc"),
                numbers.flag(product["is_click"]).alias("click"),
            ),
        ),
    )
    rows = sessions.select(
        "session_id", "fv", F.posexplode(F.flatten(per_page)).alias("_at", "_hit")
    )
    return rows.select(
        "session_id", "fv", "_hit.*", (F.col("_at") + 1).cast("bigint").alias("position")
    )


def nested_purchases(sessions: DataFrame) -> DataFrame:
    """Searched skus of each session with their purchase flag, then the purchased ones.

    Array form of the membership test; one input row in, one output row out.
    """
    searched = F.array_distinct(
        F.flatten(
            F.transform(
                F.filter("hits", lambda hit: text.is_search_page(hit["pagepath"])),
                lambda hit: F.transform(
                    F.filter(hit["product"], lambda p: text.valid_sku(p["sku"])),
                    lambda p: p["sku"],
                ),
            )
        )
    )
    bought = F.array_distinct(
        F.flatten(
            F.transform(
                F.filter("hits", lambda hit: hit["action_type"] == PURCHASE),
                lambda hit: F.transform(hit["product"], lambda p: p["sku"]),
            )
        )
    )
    return (
        sessions.select("session_id", searched.alias("searched"), bought.alias("bought"))
        .withColumn("marked", arrays.mark_purchased(F.col("searched"), F.col("bought")))
        .withColumn("purchased", arrays.only_purchased(F.col("marked")))
    )


# -- hits --------------------------------------------------------------------


def between_dates(hits: DataFrame, first: str, last: str) -> DataFrame:
    """Inclusive date window, as a filter the scan can use."""
    return hits.filter(
        F.col("session_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    )


def temporal_split(hits: DataFrame, windows: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Label each hit with its date window; windows must not overlap."""
    spans = sorted(
        (datetime.date.fromisoformat(a), datetime.date.fromisoformat(b), name)
        for name, (a, b) in windows.items()
    )
    for first, last, name in spans:
        if last < first:
            raise ValueError(f"window {name} ends before it starts")
    for (_, end, left), (start, _, right) in zip(spans, spans[1:]):
        if start <= end:
            raise ValueError(f"windows {left} and {right} overlap")
    label = F.lit(None).cast("string")
    for first, last, name in spans:
        inside = F.col("session_date").between(F.lit(first), F.lit(last))
        label = F.when(inside, F.lit(name)).otherwise(label)
    return hits.withColumn("set_name", label).filter(F.col("set_name").isNotNull())


def search_rows(hits: DataFrame) -> DataFrame:
    """Products shown on search result pages, with their search term."""
    return hits.filter(
        text.valid_sku(F.col("sku")) & text.is_search_page(F.col("pagepath"))
    ).select(
        "session_id",
        "fv",
        text.normalize_query(F.col("pagepath")).alias("query"),
        F.col("sku").alias("doc"),
        numbers.flag(F.col("is_click")).alias("click"),
        "hit_pos",
        "place",
    )


def search_hits(hits: DataFrame) -> DataFrame:
    """Search rows numbered per session over all its searches."""
    return numbered_within(
        search_rows(hits),
        keys=["session_id"],
        order=["place"],
        chunk=F.floor(F.col("hit_pos") / HITS_PER_CHUNK),
        name="position",
    ).drop("hit_pos", "place")


# -- lists -------------------------------------------------------------------


def rolled_docs(hits: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per (session, search, document): first place, click, purchase.

    One scan serves both the search pages and the purchases, which count from
    any page of the session. Repeated views are combined before the exchange.
    """
    on_search = text.is_search_page(F.col("pagepath"))
    bought = F.col("action_type") == PURCHASE
    rows = (
        hits.filter(text.valid_sku(F.col("sku")))
        .filter(F.coalesce(on_search, F.lit(False)) | F.coalesce(bought, F.lit(False)))
        .select(
            *by,
            "session_id",
            "fv",
            "channel",
            F.col("sku").alias("doc"),
            F.when(on_search, text.normalize_query(F.col("pagepath"))).alias("query"),
            numbers.flag(F.col("is_click")).alias("click"),
            numbers.flag(bought).alias("bought"),
            F.col("place").alias("seen"),
        )
    )
    # visitor and channel belong to the session: as keys they keep the aggregate
    # on fixed-width buffers, and so hashed rather than sorted
    rolled = rows.groupBy(*by, "session_id", "fv", "channel", "doc", "query").agg(
        F.max("click").alias("click"),
        F.max("bought").alias("bought"),
        F.min("seen").alias("seen"),
    )
    # at most one row per search of the session that showed the document
    anywhere = Window.partitionBy(*by, "session_id", "doc")
    purchase = F.max("bought").over(anywhere)
    return (
        rolled.withColumn("purchase", purchase)
        .filter(F.col("query").isNotNull())
        .withColumn("click", F.greatest("click", "purchase"))
        .drop("bought")
    )


def session_lists(
    hits: DataFrame, rate: float = 0.01, min_docs: int = 3, max_docs: int = 500
) -> DataFrame:
    """Result lists for the click models, one row per document of a list.

    Keeps lists with a click and at most one purchased document, cuts each after
    its purchase, keeps a share ``rate`` of the documents without a click, then
    keeps lists of ``min_docs`` to ``max_docs`` documents. ``list_pos`` counts
    from 1; ``last_click`` is the place of the last click.
    """
    docs = rolled_docs(hits)
    totals = (
        docs.groupBy("session_id", "query")
        .agg(
            F.max("click").alias("any_click"),
            F.sum("purchase").alias("purchases"),
            F.max(F.when(F.col("purchase") == 1, F.col("seen"))).alias("purchase_seen"),
        )
        .filter((F.col("any_click") == 1) & (F.col("purchases") <= 1))
        .select("session_id", "query", "purchase_seen")
    )
    kept = docs.join(totals, ["session_id", "query"]).filter(
        (F.col("purchase_seen").isNull() | (F.col("seen") <= F.col("purchase_seen")))
        & numbers.keep_sampled(
            F.col("click"), rate, F.col("session_id"), F.col("query"), F.col("doc")
        )
    )
    in_list = Window.partitionBy("session_id", "query")
    # one place beyond the limit shows that a list is too long, so no list ever
    # holds more than max_docs + 1 rows from here on
    placed = kept.withColumn(
        "list_pos", F.row_number().over(in_list.orderBy("seen")).cast("bigint")
    ).filter(F.col("list_pos") <= max_docs + 1)
    return (
        placed.withColumn("n_docs", F.count("*").over(in_list))
        .withColumn(
            "last_click",
            F.coalesce(
                F.max(F.when(F.col("click") == 1, F.col("list_pos"))).over(in_list), F.lit(0)
            ),
        )
        .filter(F.col("n_docs").between(min_docs, max_docs))
        .select(
            "session_id",
            "query",
            "fv",
            "channel",
            "doc",
            "click",
            "purchase",
            "list_pos",
            "last_click",
            "n_docs",
        )
    )


def nested_lists(lists: DataFrame) -> DataFrame:
    """Lists as one row with an ordered array; a list is bounded by ``max_docs``."""
    entry = F.struct("list_pos", "doc", "click", "purchase")
    return lists.groupBy("session_id", "query", "fv").agg(
        F.array_sort(F.collect_list(entry)).alias("docs")
    )


# -- visitors and contexts ---------------------------------------------------


def visitor_context(hits: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per visitor: channel of the first session, average of session averages.

    ``by`` keeps visitors of several labelled date windows apart.
    """
    per_session = hits.groupBy(*by, "fv", "session_id", "channel").agg(
        F.avg(numbers.micros_to_units(F.col("price_micros"))).alias("ticket")
    )
    return visitors_of(per_session, by)


def visitors_of(per_session: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Visitors from their sessions' ``fv, session_id, channel, ticket``."""
    first = F.min_by(F.struct("channel"), "session_id")["channel"]
    return (
        per_session.groupBy(*by, "fv")
        .agg(
            F.coalesce(text.channel_group(first), F.lit("")).alias("channel_group"),
            numbers.stable(F.coalesce(F.avg("ticket"), F.lit(0.0))).alias("raw_ticket"),
        )
        .withColumn("avg_ticket", numbers.round_to_int(F.col("raw_ticket")))
    )


def train_sets(lists: DataFrame, visitors: DataFrame) -> DataFrame:
    """Lists under their full search context (visitor channel, rounded ticket)."""
    who = visitors.select("fv", "channel_group", "avg_ticket")
    return lists.join(who, "fv", "left").select(
        F.col("query").alias("search_term"),
        F.coalesce("channel_group", F.lit("")).alias("channel_group"),
        F.coalesce("avg_ticket", F.lit(0)).cast("bigint").alias("customer_avg_ticket"),
        "session_id",
        "query",
        "doc",
        "click",
        "purchase",
        "list_pos",
        "last_click",
        "n_docs",
    )


def train_contexts(sets: DataFrame) -> DataFrame:
    """Size of each training context."""
    return sets.groupBy(*CONTEXT).agg(
        F.sum(numbers.flag(F.col("list_pos") == 1)).alias("n_sessions"),
        F.count("*").alias("n_docs"),
        F.sum("click").alias("n_clicks"),
    )


def validation_sets(
    hits: DataFrame, visitors: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Purchased documents per search and session, under the session's context.

    The channel is the session's own and the ticket that groups rows is not
    rounded, so two groups may show the same ``customer_avg_ticket``. With
    ``by``, ``visitors`` must be grouped by the same labels.
    """
    return purchased_sets(rolled_docs(hits, by), visitors, by)


def purchased_sets(rolled: DataFrame, visitors: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The purchased ones of ``rolled_docs`` under their contexts."""
    who = visitors.select(*by, "fv", "raw_ticket", "avg_ticket")
    return (
        rolled.filter(F.col("purchase") == 1)
        .join(who, [*by, "fv"], "left")
        .select(
            *by,
            F.col("query").alias("search_term"),
            F.coalesce(text.channel_group(F.col("channel")), F.lit("")).alias("channel_group"),
            F.coalesce("avg_ticket", F.lit(0)).cast("bigint").alias("customer_avg_ticket"),
            F.coalesce("raw_ticket", F.lit(0.0)).alias("raw_ticket"),
            "session_id",
            F.col("doc").alias("sku"),
        )
    )


def validation_contexts(sets: DataFrame) -> DataFrame:
    """Purchases per context and document; ``n`` counts sessions."""
    return (
        sets.groupBy(*CONTEXT, "raw_ticket", "sku")
        .agg(F.count("*").alias("n"))
        .drop("raw_ticket")
    )
