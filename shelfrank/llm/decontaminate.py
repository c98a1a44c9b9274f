"""Benchmark passages in documents, found through a positional inverted index.

1. Benchmark texts become windows of ``WINDOW`` words; an item of fewer words is one window.
   Equal windows of several items are one.
2. The index holds a posting (term, document, place) for every occurrence of a benchmark
   term in the documents, and each document's length as a posting of an empty term, one of as
   many as there are partitions. It is built in one pass and written (``stored_index``).
3. Terms are counted in the index. Each window is looked up by its ``PROBES`` rarest terms:
   the places of the rarest are intersected with those of the next ones, offset by less than
   ``NEAR`` window lengths.
4. Places that are left are compared with the document's words: all of the window in its order
   is an exact match, all of its terms in any order within ``NEAR`` window lengths a near one.

``proximity`` finds terms of other items near each other, from the same postings if given.

Everything is DataFrame functions. Small tables (vocabulary, windows, starts) are written
before they are joined, so the planner broadcasts them only if their size allows.

Nulls: a null text has no words. A null document id is an id like others. Documents are told
apart by id and content, so rows of one id with different texts are measured apart and
repeated rows get equal results. Items with null id or no words are ignored; repeated items
count once by id. Empty tables give no hits.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.llm.shared import written

WINDOW = 13
PROBES = 3
NEAR = 2  # window lengths in which a near match has all terms of the window
PERCENT = 5  # hit words per hundred words that make a document contaminated

# words are letters, digits and everything beyond ASCII; A-Z count as a-z
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LENGTH_TERM = " "  # no word has a blank


def words(text: Column) -> Column:
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(F.coalesce(lower, F.lit("")), BETWEEN_WORDS, -1), "")


def identity(key: str, text: str) -> Column:
    """Tells documents apart by id and content, the same in every job over the same rows."""
    return F.struct(F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("digest"))


def windows(items: DataFrame, key: str, text: str, length: int) -> DataFrame:
    """``item, words``: every window of every item."""
    rows = items.select(F.col(key).cast("string").alias("item"), words(F.col(text)).alias("all"))
    rows = rows.where("item IS NOT NULL AND size(all) > 0")
    last = F.greatest(F.size("all") - length, F.lit(0))
    return rows.select(
        "item", "all", F.explode(F.sequence(F.lit(0), last)).alias("start")
    ).select("item", F.slice("all", F.col("start") + 1, F.lit(length)).alias("words"))


@dataclass(frozen=True)
class Stored:
    """An index as tables: ``postings`` (``term_id, document, place``), the ``vocabulary`` they
    are for (``term, term_id``), the ``lengths`` of all documents (``document, n_words``), and
    the windows (``window, words, items``)."""

    postings: DataFrame
    vocabulary: DataFrame
    lengths: DataFrame
    windows: DataFrame


def index(documents: DataFrame, key: str, text: str, vocabulary: DataFrame, salts: int = 1) -> DataFrame:
    """``term, term_id, document, place``: postings of the vocabulary's terms (``term, term_id``).

    A document has one more posting, whose place is its number of words, of one of ``salts``
    empty terms: with one for all, a third of a join's rows could have its key.
    """
    rows = documents.select(identity(key, text).alias("document"), words(F.col(text)).alias("all"))
    salt = F.pmod(F.xxhash64("document"), F.lit(salts)).cast("string")
    empty = F.concat(F.lit(LENGTH_TERM), salt)
    tokens = rows.select(
        "document", F.posexplode(F.concat("all", F.array(empty))).alias("place", "term")
    )
    return tokens.join(vocabulary, "term").select("term", "term_id", "document", "place")


def stored_index(
    documents: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    length: int = WINDOW,
) -> Stored:
    """The index of ``documents`` for all windows of ``items``, written."""
    spark = documents.sparkSession
    all_windows = written(windows(items, item_key, item_text, length))
    by_words = all_windows.groupBy("words").agg(F.collect_set("item").alias("items"))
    numbered = written(by_words.withColumn("window", F.xxhash64("words")))
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    empty = spark.range(salts).select(F.concat(F.lit(LENGTH_TERM), F.col("id").cast("string")).alias("term"))
    terms = numbered.select(F.explode("words").alias("term")).distinct().union(empty)
    vocabulary = written(terms.select("term", F.xxhash64("term").alias("term_id")))
    found = index(documents, key, text, vocabulary, salts)
    postings = written(
        found.select("term_id", "document", "place", F.startswith("term", F.lit(LENGTH_TERM)).alias("of_length"))
    )
    lengths = postings.where("of_length").select("document", F.col("place").cast("long").alias("n_words"))
    return Stored(postings.where("NOT of_length").drop("of_length"), vocabulary, lengths, numbered)


def probes(stored: Stored, count: int) -> DataFrame:
    """``window, term_id, offset, rank``: the rarest different terms of each window."""
    frequency = written(stored.postings.groupBy("term_id").agg(F.count("*").alias("found")))
    terms = stored.windows.select("window", F.posexplode("words").alias("offset", "term"))
    first = terms.groupBy("window", "term").agg(F.min("offset").alias("offset"))
    counted = (
        first.join(stored.vocabulary, "term")
        .join(frequency, "term_id", "left")
        .withColumn("found", F.coalesce("found", F.lit(0)))
    )
    order = Window.partitionBy("window").orderBy("found", "term_id")
    ranked = counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
    # a window with a term that no document has is nowhere
    gone = ranked.where("rank = 1 AND found = 0").select("window")
    return ranked.join(gone, "window", "left_anti").select("window", "term_id", "offset", "rank")


def places(postings: DataFrame, chosen: DataFrame, count: int, within: int | None) -> DataFrame:
    """``document, window, place, offset, start``: where a window's rarest term stands, ``offset``
    words into the window, with its other probes less than ``within`` words away; where
    ``within`` is None, at their places in a window from ``start``."""

    def listed(rank: int) -> DataFrame:
        start = F.col("place") - F.col("offset")
        found = postings.join(chosen.where(F.col("rank") == rank), "term_id")
        return found.select("document", "window", "place", "offset", start.alias("start"))

    found = listed(1)
    if count == 1:
        return found
    # the rarest terms' places are few: written, they decide how the next lists are joined
    found = written(found)
    sizes = chosen.groupBy("window").agg(F.max("rank").alias("ranks"))
    block = F.floor(F.col("place") / (within or 1))
    for rank in range(2, count + 1):
        others = listed(rank)
        if within is None:
            both = found.join(others, ["document", "window", "start"], "left_semi").select(*found.columns)
        else:
            there = others.select("document", "window", F.col("place").alias("at"), block.alias("block"))
            tried = found.withColumn("block", F.explode(F.array(block - 1, block, block + 1)))
            same = [tried[x] == there[x] for x in ("document", "window", "block")]
            close = [*same, F.abs(tried["place"] - there["at"]) < within]
            both = tried.join(there, close, "left_semi").drop("block").distinct()
        short = found.join(sizes.where(F.col("ranks") < rank), "window", "left_semi")
        found = both.unionByName(short)
    return found


def occurrences(
    documents: DataFrame,
    stored: Stored,
    key: str,
    text: str,
    length: int,
    nearly: bool = True,
    count: int = PROBES,
) -> DataFrame:
    """Where windows occur: ``document, start, size, items`` (the items of the window), once or
    more; ``start`` is null for near matches, which only ``nearly`` asks for."""
    chosen = written(probes(stored, count))
    possible = places(stored.postings, chosen, count, NEAR * length if nearly else None)
    by_document = written(
        possible.join(stored.windows.select("window", F.col("words").alias("wanted"), "items"), "window")
        .groupBy("document")
        .agg(F.collect_set(F.struct("place", "offset", "wanted", "items")).alias("tried"))
    )
    rows = documents.select(identity(key, text).alias("document"), F.col(text).alias("text"))
    own = F.col("all")

    def exact(x: Column) -> Column:
        start = x["place"] - x["offset"]
        return (start >= 0) & (
            F.slice(own, F.greatest(start, F.lit(0)) + 1, F.size(x["wanted"])) == x["wanted"]
        )

    def near(x: Column) -> Column:
        """Whether a run of words that has the place has all of the window's terms."""
        span = NEAR * F.size(x["wanted"])
        first = F.greatest(x["place"] - span + 1, F.lit(0))
        return F.exists(
            F.sequence(first, x["place"]),
            lambda start: F.size(F.array_except(x["wanted"], F.slice(own, start + 1, span))) == 0,
        )

    def judged(x: Column) -> Column:
        start = F.when(exact(x), x["place"] - x["offset"])
        return F.struct(
            start.alias("start"),
            F.size(x["wanted"]).alias("size"),
            x["items"].alias("items"),
            (start.isNotNull() | near(x) if nearly else start.isNotNull()).alias("found"),
        )

    return (
        rows.join(by_document, "document")
        .select("document", words(F.col("text")).alias("all"), "tried")
        .select("document", F.explode(F.filter(F.transform("tried", judged), lambda x: x["found"])).alias("hit"))
        .select("document", "hit.start", "hit.size", "hit.items")
    )


def covered(spans: Column) -> Column:
    """Words inside any of the spans ``(start, end)``, an array in order of starts."""
    zero = F.struct(F.lit(0).alias("total"), F.lit(0).alias("reach"))

    def add(state: Column, span: Column) -> Column:
        fresh = F.greatest(span["end"] - F.greatest(span["start"], state["reach"]), F.lit(0))
        return F.struct(
            (state["total"] + fresh).alias("total"),
            F.greatest(state["reach"], span["end"]).alias("reach"),
        )

    return F.aggregate(spans, zero, add, lambda state: state["total"])


def contamination(
    documents: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    length: int = WINDOW,
    percent: int = PERCENT,
    nearly: bool = True,
) -> DataFrame:
    """``document`` (see ``identity``), ``n_words``, ``n_hit``, ``items``, ``near_items`` and
    ``contaminated``.

    One row per row of ``documents``; ``items`` are the ids of items with occurring windows,
    in order as strings, ``near_items`` those with windows that occur or nearly do. Without
    ``nearly`` near matches are not looked for.
    """
    stored = stored_index(documents, items, key, text, item_key, item_text, length)
    hits = occurrences(documents, stored, key, text, length, nearly)
    span = F.struct("start", (F.col("start") + F.col("size")).alias("end"))
    own = F.col("start").isNotNull()
    by_document = hits.groupBy("document").agg(
        F.array_sort(F.collect_set(F.when(own, span))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(own, F.col("items")))))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("near_items"),
    )
    found = by_document.select("document", covered(F.col("spans")).alias("n_hit"), "items", "near_items")
    none = F.array().cast("array<string>")
    return (
        stored.lengths.join(found, "document", "left")
        .select(
            "document",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", none).alias("items"),
            F.coalesce("near_items", none).alias("near_items"),
        )
        .withColumn(
            "contaminated",
            (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words")),
        )
    )


def keep_clean(
    documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``documents`` that are not contaminated."""
    found = contamination(documents, items, key, text, nearly=False)
    gone = written(found.where("contaminated").select("document").distinct())
    rows = documents.select(F.struct("*").alias("row"), identity(key, text).alias("document"))
    return rows.join(gone, "document", "left_anti").select("row.*")


def proximity(
    documents: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    within: int = 10,
    stored: Stored | None = None,
) -> DataFrame:
    """``document, item, place``: places from which all words of an item lie within ``within``.

    With ``stored`` its postings are used, and only items whose terms it has can be found.

    Words may come in any order; meant for items of a few words. Each place of a term opens
    the span it begins, so spans are joined by their blocks of ``within`` places.
    """
    rows = items.select(
        F.col(item_key).cast("string").alias("item"), F.array_distinct(words(F.col(item_text))).alias("terms")
    ).where("item IS NOT NULL AND size(terms) > 0")
    wanted = written(rows.select("item", F.size("terms").alias("n"), F.explode("terms").alias("term")))
    terms = wanted.select("term").distinct().select("term", F.xxhash64("term").alias("term_id"))
    if stored is None:
        postings = index(documents, key, text, written(terms))
    else:
        postings = stored.postings.join(stored.vocabulary.join(terms, ["term", "term_id"]), "term_id")
    placed = written(postings.join(wanted, "term").select("item", "n", "term_id", "document", "place"))
    block = F.floor(F.col("place") / within)
    ahead = placed.select(
        "item", "document", "term_id", "place", F.explode(F.array(block, block - 1)).alias("block")
    ).withColumnsRenamed({"term_id": "other", "place": "at"})
    return (
        placed.withColumn("block", block)
        .join(ahead, ["item", "document", "block"])
        .where((F.col("at") >= F.col("place")) & (F.col("at") < F.col("place") + within))
        .groupBy("item", "document", "place", "n")
        .agg(F.count_distinct("other").alias("found"))
        .where("found = n")
        .select("document", "item", "place")
    )

