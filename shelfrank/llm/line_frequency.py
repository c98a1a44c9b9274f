"""Boilerplate lines by site-relative frequency.

Pages are grouped by host. A line is boilerplate on a host when the different texts containing
it, divided by all different texts of the host, exceed ``MAX_RATIO``, and at least
``MIN_PAGES`` texts contain it (on a tiny host every line would be frequent). Such lines are
dropped from all pages of the host; other lines keep their order and their line ends. No page
is dropped.

Copies of a page are one text in both counts, told apart by a 64-bit hash: however many rows
repeat a page, its own lines are no more frequent for it. Of ``MAX_RATIO``: a host has a few
templates (article, list, profile, by language), and what belongs to one is on all its pages
only. At 0.08 a line of one of a dozen equal templates (1/12) still counts as boilerplate,
while a line of content would have to recur in every twelfth different text.

Lines end at ``\\n`` and are compared whole, by a 64-bit hash. Blank lines are never
boilerplate. A line counts once per text. A null text has no lines, counts as one text and
stays null; rows of a null host are counted nowhere and left unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.shared import comparable, written

MAX_RATIO = 0.08
MIN_PAGES = 5
SALTS = 16  # parts in which a host's pages meet its lines

LINE_END = "\n"


def boilerplate(
    df: DataFrame,
    host: str = "source",
    text: str = "text",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``host, lines, page_ratios``: hashes of the boilerplate lines of each host that has some,
    and beside each the share of the host's pages, copies counted each, that contain it. That
    is reported only: the ratio of different texts decides.

    Texts are taken once where the pages are read, before their line hashes are shuffled, and
    both counts are summed before the next shuffle: copies send one row per task, and a host
    with a third of all pages one row per task and line. A host has at most
    ``mean lines a text / max_ratio`` such lines.
    """
    lines = F.filter(F.split(F.col(text), LINE_END, -1), lambda line: F.trim(line) != "")
    hashes = F.array_distinct(F.transform(lines, lambda line: F.xxhash64(line)))
    texts = (
        df.select(F.col(host).alias("host"), F.xxhash64(text).alias("digest"), hashes.alias("hashes"))
        .where("host IS NOT NULL")
        .groupBy("host", "digest", "hashes")
        .agg(F.count("*").alias("copies"))
    )
    totals = texts.groupBy("host").agg(F.count("*").alias("texts"), F.sum("copies").alias("pages"))
    frequent = (
        texts.select("host", "copies", F.explode("hashes").alias("line"))
        .groupBy("host", "line")
        .agg(F.count("*").alias("found"), F.sum("copies").alias("on_pages"))
        .where(F.col("found") >= min_pages)
    )
    entry = F.struct("line", (F.col("on_pages") / F.col("pages")).alias("page_ratio"))
    return (
        frequent.join(totals, "host")
        .where(F.col("found") > F.col("texts") * max_ratio)
        .groupBy("host")
        .agg(F.collect_set(entry).alias("entries"))
        .select(
            "host",
            F.transform("entries", lambda x: x["line"]).alias("lines"),
            F.transform("entries", lambda x: x["page_ratio"]).alias("page_ratios"),
        )
    )


def drop_lines(
    df: DataFrame,
    host: str = "source",
    text: str = "text",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``row`` (all columns of ``df``), ``text`` without boilerplate, ``n_lines``, ``n_dropped``,
    and ``page_ratio``, the highest of a dropped line (null without any).

    The lines per host are a written table: the planner broadcasts it if its size allows,
    else a host's pages are dealt to ``SALTS`` tasks that each get its lines.
    """
    found = written(boilerplate(df, host, text, max_ratio, min_pages))
    salted = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64(*comparable(df)), F.lit(SALTS)).cast("int")
    rows = df.select(
        F.struct("*").alias("row"), F.col(host).alias("host"), F.col(text).alias("text"), salt.alias("salt")
    )
    split = F.split("text", LINE_END, -1)
    kept = F.filter(
        split, lambda x: (F.trim(x) == "") | ~F.array_contains(F.col("lines"), F.xxhash64(x))
    )
    own = F.transform(F.filter(split, lambda x: F.trim(x) != ""), lambda x: F.xxhash64(x))
    on_page = F.zip_with("lines", "page_ratios", lambda line, ratio: F.when(F.array_contains(own, line), ratio))
    return (
        rows.join(salted, ["host", "salt"], "left")
        .withColumn("kept", F.when(F.col("lines").isNull(), split).otherwise(kept))
        # of the text as it was: in the select below the name means the new one to some
        .withColumn("page_ratio", F.when(F.size("kept") < F.size(split), F.array_max(on_page)))
        .select(
            "row",
            F.array_join("kept", LINE_END).alias("text"),
            F.coalesce(F.size(split), F.lit(0)).cast("long").alias("n_lines"),
            F.coalesce(F.size(split) - F.size("kept"), F.lit(0)).cast("long").alias("n_dropped"),
            "page_ratio",
        )
    )


def drop_boilerplate(
    df: DataFrame,
    host: str = "source",
    text: str = "text",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
    length: str = "n_chars",
) -> DataFrame:
    """``df`` with boilerplate lines dropped; ``length``, if there, is that of the new text."""
    done = drop_lines(df, host, text, max_ratio, min_pages)
    columns = []
    for name in df.columns:
        own = F.col("row").getField(name)
        if name == text:
            own = F.col("text")
        elif name == length:
            own = F.when(F.col("n_dropped") > 0, F.char_length("text").cast(df.schema[name].dataType)).otherwise(own)
        columns.append(own.alias(name))
    return done.select(*columns)
