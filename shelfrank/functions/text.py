"""String functions: search terms, page filters, channels, tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: what is replaced, in this order, in the last segment of a page path
PLUS_RUN = r"\++"
T_SPACE = "t "
LONE_S = " s ?"
AXD_SUFFIX = ".axd"

# fixed values: which pages count as search result pages
NOT_SEARCH = r"\.html|home"
SEARCH = r"google\+redesign"

# fixed value: a product hit without a product
NO_SKU = "(not set)"

# word characters, with apostrophes and dots kept inside a word
WORD = r"[\p{L}\p{N}_]+(?:['’.][\p{L}\p{N}_]+)*"


def normalize_query(pagepath: Column) -> Column:
    """Search term of a page path; ``''`` where the path has no last segment."""
    # plain string functions where no pattern is needed: this runs on every hit
    term = F.substring_index(pagepath, "/", -1)
    term = F.regexp_replace(term, PLUS_RUN, " ")
    term = F.replace(term, F.lit(T_SPACE), F.lit("t"))
    term = F.regexp_replace(term, LONE_S, " ")
    return F.replace(term, F.lit(AXD_SUFFIX), F.lit(""))


def is_search_page(
    pagepath: Column, search: str = SEARCH, not_search: str = NOT_SEARCH
) -> Column:
    return pagepath.rlike(search) & ~pagepath.rlike(not_search)


def valid_sku(sku: Column) -> Column:
    """False for the placeholder, NULL (so filtered) for a missing sku."""
    return sku != F.lit(NO_SKU)


def channel_group(channel: Column) -> Column:
    return F.translate(F.lower(channel), " ", "_")


def clean_category(category: Column) -> Column:
    return F.translate(category, "/", " ")


def tokenize(text: Column) -> Column:
    """Lower-cased words in text order, duplicates kept; empty array for NULL."""
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    return F.coalesce(words, F.array().cast("array<string>"))


def parse_context_key(key: Column) -> Column:
    """``'a:x|b:y'`` -> map."""
    return F.str_to_map(key, F.lit(r"\|"), F.lit(":"))


def format_context_key(names: list[str]) -> Column:
    """The inverse of :func:`parse_context_key` over context columns."""
    parts = [
        F.concat(F.lit(f"{name}:"), F.coalesce(F.col(name).cast("string"), F.lit("")))
        for name in names
    ]
    return F.concat_ws("|", *parts)
