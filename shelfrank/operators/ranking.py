"""Search over a catalog for a whole table of search contexts at once.

Matching and the first pass depend on the search text alone, so they run once
per distinct text; contexts are joined to the short result lists afterwards and
only the rescoring window gets features.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.functions.numbers import ctr_boost, stable
from shelfrank.operators import textmatch
from shelfrank.operators.ensemble import LinearModel, Model, score_ensemble
from shelfrank.operators.features import (
    DEFAULT,
    TEXT_FIELDS,
    FeatureSet,
    attach_features,
    normalise,
)
from shelfrank.operators.textmatch import TextIndex

# fixed values: how the two scores are weighed, and the windows of the two uses
QUERY_WEIGHT = 0.1
MODEL_WEIGHT = 20.0
BATCH_WINDOW = 50
FRONT_WINDOW = 500
RESULT_SIZE = 1000


def ranked(
    df: DataFrame, keys: Sequence[str], score: str, key: str = "sku", size: int | None = None
) -> DataFrame:
    """Add the 0-based place by falling score; ties by key. Keep ``size`` rows.

    The limit is on ``row_number``, so each task passes on at most ``size`` rows
    per search.
    """
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(key))
    placed = df.withColumn("_rank", F.row_number().over(order))
    if size is not None:
        placed = placed.filter(F.col("_rank") <= size)
    return placed.withColumn("pos", F.col("_rank").cast("bigint") - 1).drop("_rank")


def catalog_index(catalog: DataFrame | TextIndex) -> TextIndex:
    """The index that searches and text features over a catalog need."""
    if isinstance(catalog, TextIndex):
        return catalog
    carried = [name for name in catalog.columns if name not in ("sku", *TEXT_FIELDS)]
    return textmatch.index_of(catalog, TEXT_FIELDS, "sku", carried)


def first_pass(queries: DataFrame, catalog: DataFrame | TextIndex) -> DataFrame:
    """``search_term, sku, score`` of all matches: match score plus CTR boost.

    A key that is the whole search text counts as a field of its own.
    """
    index = catalog_index(catalog)
    matched = textmatch.matched_scores(queries, index, TEXT_FIELDS, carry=["ctr"])
    # without lengths: one document of n holds the key
    key_score = textmatch.idf(index.total()["n"], F.lit(1.0))
    equal = textmatch.exact_keys(queries, index, "search_term", ["ctr"])
    names = ["search_term", "sku"]
    # at most one row per search; matches are not regrouped for them
    both = matched.join(equal.select(*names, F.lit(True).alias("exact")), names, "left").withColumn(
        "match_score", F.when(F.col("exact"), F.greatest("match_score", key_score)).otherwise(F.col("match_score"))
    )
    only = equal.join(matched.select(*names), names, "left_anti").withColumn("match_score", key_score)
    scored = both.select(*names, "ctr", "match_score").unionByName(only.select(*names, "ctr", "match_score"))
    return scored.select(*names, stable(F.col("match_score") + ctr_boost(F.col("ctr"))).alias("score"))


def first_pass_topk(
    queries: DataFrame, catalog: DataFrame | TextIndex, size: int = RESULT_SIZE
) -> DataFrame:
    return ranked(first_pass(queries, catalog), ["search_term"], "score", size=size)


def rescore(
    top: DataFrame,
    contexts: DataFrame,
    catalog: DataFrame | TextIndex,
    model: Model | LinearModel,
    window: int = BATCH_WINDOW,
    features: FeatureSet = DEFAULT,
    query_weight: float = QUERY_WEIGHT,
    model_weight: float = MODEL_WEIGHT,
    normalised: bool = False,
) -> DataFrame:
    """Rescore the first ``window`` results of each context with the model.

    Results beyond the window keep their order below it. ``contexts`` may hold
    columns besides the context (a set name); they are kept. ``normalised``
    scales the features of a window by their sums, as training lists may be.
    """
    keys = contexts.columns
    lists = contexts.distinct().join(top, "search_term")
    inside = rescored_window(
        lists.filter(F.col("pos") < window),
        keys,
        catalog,
        model,
        features,
        query_weight,
        model_weight,
        normalised,
    )
    outside = lists.filter(F.col("pos") >= window).select(*keys, "sku", "score", "pos")
    return inside.unionByName(outside)


def rescored_window(
    inside: DataFrame,
    keys: Sequence[str],
    catalog: DataFrame | TextIndex,
    model: Model | LinearModel,
    features: FeatureSet = DEFAULT,
    query_weight: float = QUERY_WEIGHT,
    model_weight: float = MODEL_WEIGHT,
    normalised: bool = False,
) -> DataFrame:
    """The first results of each search in the order of both scores.

    They only change places among themselves, so results below the window need
    no new place.
    """
    described = attach_features(inside, catalog, features)
    if normalised:
        described = normalise(described, len(features.features), keys)
    both = stable(F.col("score") * query_weight + F.col("model_score") * model_weight)
    scored = score_ensemble(described, model).select(*keys, "sku", both.alias("score"))
    return ranked(scored, keys, "score")


def search(
    contexts: DataFrame,
    catalog: DataFrame | TextIndex,
    model: Model | LinearModel | None = None,
    size: int = RESULT_SIZE,
    window: int = BATCH_WINDOW,
    features: FeatureSet = DEFAULT,
    use_ltr: bool = True,
    normalised: bool = False,
) -> DataFrame:
    """Result lists ``(context, sku, score, pos)``, at most ``size`` per context."""
    terms = contexts.select("search_term").distinct()
    top = first_pass_topk(terms, catalog, max(size, window) if use_ltr else size)
    if not use_ltr or model is None:
        return contexts.distinct().join(top, "search_term")
    found = rescore(
        top, contexts, catalog, model, window, features, normalised=normalised
    )
    return found.filter(F.col("pos") < size)
