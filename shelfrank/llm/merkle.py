"""Document fingerprints: a Merkle tree over sentences, paragraphs and sections.

A text is split at line ends into paragraphs, and these at ``". "`` into sentences; both
splits lose nothing. Leaves are SHA-256 of the sentences, a paragraph's hash is that of its
leaves, a section's that of its paragraphs, the root's that of its sections. A section ends
with a paragraph whose hash begins with one of ``SECTION_ENDS``, so its bounds follow from
content and an edit moves them only nearby. Equal roots mean equal texts; where roots differ,
the branches that differ show where.

``tree`` gives a struct of ``root`` (whole) and the branches shortened to ``BRANCH`` digits;
``fingerprint`` writes it as text, ``root|sections|paragraphs:leaves``.

A null text counts as empty: one section of one paragraph of one empty sentence. Everything
is built from Spark's own functions; trees are made row by row without a shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.functions.arrays import with_runs
from shelfrank.llm.shared import written
from shelfrank.operators.numbering import sorted_index

BRANCH = 12
SECTION_ENDS = ("0", "1", "2", "3")
BUCKETS_PER_PARTITION = 4
SAMPLES = 100  # orders drawn for each range of ids
LEAST_ID = -(1 << 63)


def sha(column: Column) -> Column:
    return F.sha2(column.cast("binary"), 256)


def short(column: Column) -> Column:
    return F.substring(column, 1, BRANCH)


def with_tree(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the struct ``name``: ``root, sections, paragraphs, leaves``.

    ``leaves`` is one comma-joined string per paragraph.
    """
    ends = f"^[{''.join(SECTION_ENDS)}]"
    leaves = F.transform(
        F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1),
        lambda paragraph: F.transform(F.split(paragraph, "[.] ", -1), sha),
    )
    paragraphs = F.transform("_leaves", lambda x: sha(F.array_join(x, ",")))
    ended = F.transform("_paragraphs", lambda x: F.concat(x, F.when(x.rlike(ends), ";").otherwise(",")))
    sections = F.split(F.regexp_replace(F.array_join(ended, ""), "[,;]$", ""), ";", -1)
    return (
        df.withColumn("_leaves", leaves)
        .withColumn("_paragraphs", paragraphs)
        .withColumn("_sections", F.transform(sections, sha))
        .withColumn(
            name,
            F.struct(
                sha(F.array_join("_sections", ",")).alias("root"),
                F.transform("_sections", short).alias("sections"),
                F.transform("_paragraphs", short).alias("paragraphs"),
                F.transform(
                    "_leaves", lambda x: F.array_join(F.transform(x, short), ",")
                ).alias("leaves"),
            ),
        )
        .drop("_leaves", "_paragraphs", "_sections")
    )


def fingerprint(tree: str) -> Column:
    node = F.col(tree)
    paragraphs = F.zip_with(
        node["paragraphs"], node["leaves"], lambda a, b: F.concat(a, F.lit(":"), b)
    )
    return F.concat_ws("|", node["root"], F.array_join(node["sections"], ","), F.array_join(paragraphs, ";"))


def branches(tree: str) -> Column:
    """Different branches of all levels below the root."""
    node = F.col(tree)
    leaves = F.split(F.array_join(node["leaves"], ","), ",")
    return F.array_distinct(F.concat(node["sections"], node["paragraphs"], leaves))


def likeness(a: str, b: str) -> Column:
    """1 for equal roots, else the share of branches two trees have in common (Dice)."""
    left, right = branches(a), branches(b)
    common = F.size(F.array_intersect(left, right))
    share = 2.0 * common / (F.size(left) + F.size(right))
    return F.when(F.col(a)["root"] == F.col(b)["root"], 1.0).otherwise(share)


def differing(a: str, b: str) -> Column:
    """0-based places of the paragraphs of tree ``a`` that tree ``b`` does not have."""
    places = F.transform(
        F.col(a)["paragraphs"],
        lambda x, i: F.when(~F.array_contains(F.col(b)["paragraphs"], x), i),
    )
    return F.when(
        F.col(a)["root"] == F.col(b)["root"], F.array().cast("array<int>")
    ).otherwise(F.array_compact(places))


def with_changed(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """``df`` with ``differing(a, b)``, from one sorted array of both trees' paragraphs, so that
    texts of many paragraphs take time in proportion."""

    def marked(tree: str, own: int) -> Column:
        return F.transform(
            F.col(tree)["paragraphs"],
            lambda x, i: F.struct(x.alias("hash"), F.lit(own).alias("own"), i.alias("place")),
        )

    both = df.withColumn("_both", F.sort_array(F.concat(marked(b, 0), marked(a, 1))))
    runs = with_runs(both, "_both", lambda x, y: x["hash"] == y["hash"], "_runs")
    # in a run the paragraphs of ``b`` come first
    only = F.filter("_runs", lambda run: F.get(run, F.lit(0))["own"] == 1)
    places = F.sort_array(F.transform(F.flatten(only), lambda x: x["place"]))
    return runs.withColumn(name, places).drop("_both", "_runs")


def ranges_of(rows: DataFrame, count: int) -> DataFrame:
    """``range, low, top``: about ``count`` ranges of ``order`` with about as many rows each.

    A range has the orders above ``low`` (null in the first) up to ``top``. The tops come from
    a sample by hash of ``SAMPLES`` orders a range, sorted in parallel; the last is the highest
    order of all. Rows of one order are in one range.
    """
    share = min(1.0, SAMPLES * count / max(rows.count(), 1))
    parts = 1 << 30
    drawn = rows.select("order").where(
        F.pmod(F.xxhash64("order"), F.lit(parts)) <= int(share * parts)
    )
    placed = sorted_index(drawn.distinct(), ["order"], "at")
    step = max(1, placed.count() // count)
    inner = placed.where((F.col("at") + 1) % step == 0).select("order")
    highest = rows.agg(F.max("order").alias("order")).where("order IS NOT NULL")
    tops = sorted_index(inner.union(highest).distinct(), ["order"], "range")
    below = tops.select((F.col("range") + 1).alias("range"), F.col("order").alias("low"))
    return written(tops.join(below, "range", "left").select("range", "low", F.col("order").alias("top")))


def with_next(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, text, next``: each row with the text that follows it by falling ``key``.

    The last row is followed by the first. Rows are dealt to ranges of ids; a range's largest
    id also goes, as a ghost, to the end of the range above it. So every range is ordered by
    itself and texts are shuffled once. A row's range is looked up in two steps: its block in
    an array of about the square root of their number, then one of the block's ranges, which
    are broadcast (``BUCKETS_PER_PARTITION`` for each partition, and one more). Null ids come
    last, equal ids are ordered by text.
    """
    rows = df.select(
        F.col(key).alias("key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(F.col(key).cast("long"), F.lit(LEAST_ID)).alias("order"),
    )
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = ranges_of(rows, BUCKETS_PER_PARTITION * partitions)
    count = ranges.count()
    block = math.isqrt(count) or 1
    edges = [r["top"] for r in ranges.where((F.col("range") + 1) % block == 0).orderBy("top").collect()]
    blocks = F.array(*[F.lit(x) for x in edges]).cast("array<bigint>")
    known = ranges.select(F.floor(F.col("range") / block).cast("int").alias("block"), "range", "low", "top")
    in_block = F.size(F.filter(blocks, lambda x: x < F.col("order")))
    placed_rows = rows.withColumn("in_block", in_block).join(
        F.broadcast(known),
        on=[
            F.col("in_block") == F.col("block"),
            F.col("low").isNull() | (F.col("order") > F.col("low")),
            F.col("order") <= F.col("top"),
        ],
    )
    homes = F.array(
        F.struct(F.col("range"), F.lit(False).alias("ghost")),
        F.when(
            F.col("top") == F.col("order"),
            F.struct(((F.col("range") + 1) % max(count, 1)).alias("range"), F.lit(True).alias("ghost")),
        ),
    )
    placed = placed_rows.select(
        "key", "text", "order", F.explode(F.array_compact(homes)).alias("home")
    ).select("key", "text", "order", "home.*")
    inside = Window.partitionBy("range").orderBy("ghost", F.desc("order"), "text")
    return (
        placed.withColumn("next", F.lead("text").over(inside))
        .where("NOT ghost")
        .select("key", "text", "next")
    )


def edited_fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, how alike they are, and ``changed``:
    the edited text's paragraphs (from 0, comma-joined) that the text does not have.

    The edited text ends in the beginning of the next text instead of its own second half.
    """
    length = F.char_length("text")
    half = F.floor(length / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), length - half), F.substring("next", F.lit(1), half)
    )
    rows = with_next(df, key, text).withColumn("edited", edited)
    for column, tree in (("text", "own"), ("edited", "changed"), ("next", "following")):
        rows = with_tree(rows, column, tree)
    return with_changed(rows, "changed", "own", "places").select(
        F.col("key").alias(key),
        length.cast("long").alias("n_chars"),
        sha(F.col("edited")).alias("edited_sha256"),
        fingerprint("own").alias("fingerprint"),
        fingerprint("changed").alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"),
        likeness("own", "following").alias("near_next"),
        F.array_join(F.transform("places", lambda x: x.cast("string")), ",").alias("changed"),
    )
