"""Feature sets, the feature log, and training lists."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.functions import numbers
from shelfrank.operators import textmatch
from shelfrank.operators.numbering import dense_ids
from shelfrank.operators.skew import spread_join
from shelfrank.operators.textmatch import TextIndex
from shelfrank.schemas import CHANNELS
from shelfrank.session import cut_lineage

TEXT_FIELDS = ["name", "category"]


@dataclass(frozen=True)
class Feature:
    """A named value of a (context, document) row.

    ``params`` are columns of the context, ``doc_columns`` of the catalog. For each of
    ``text_fields`` the builder finds the field's text score as ``bm25_<field>``.
    """

    name: str
    params: tuple[str, ...]
    build: Callable[[], Column]
    doc_columns: tuple[str, ...] = ()
    text_fields: tuple[str, ...] = ()


@dataclass(frozen=True)
class FeatureSet:
    """An ordered list of features; the order is the feature number, from 1."""

    name: str
    features: tuple[Feature, ...]

    def _used(self, kind: str) -> list[str]:
        return sorted({name for feature in self.features for name in getattr(feature, kind)})

    @property
    def params(self) -> list[str]:
        return self._used("params")

    @property
    def doc_columns(self) -> list[str]:
        return self._used("doc_columns")

    @property
    def text_fields(self) -> list[str]:
        return self._used("text_fields")

    def as_array(self) -> Column:
        return F.array(
            *[F.coalesce(feature.build().cast("double"), F.lit(0.0)) for feature in self.features]
        )


# feature name in a definition file -> its Column builder
REGISTRY: dict[str, Feature] = {
    feature.name: feature
    for feature in (
        Feature(
            "customer_avg_ticket",
            ("customer_avg_ticket",),
            lambda: numbers.log_price_distance(F.col("price"), F.col("customer_avg_ticket")),
            doc_columns=("price",),
        ),
        Feature(
            "BM25 category",
            ("search_term",),
            lambda: F.col("bm25_category"),
            text_fields=("category",),
        ),
        Feature(
            "channel_group",
            ("channel_group",),
            lambda: numbers.channel_ctr_feature(F.col("channel_group")),
            doc_columns=tuple(f"ctr_{field}" for field in CHANNELS.values()),
        ),
        Feature(
            "BM25 name", ("search_term",), lambda: F.col("bm25_name"), text_fields=("name",)
        ),
    )
}


def register(feature: Feature) -> Feature:
    """Make a feature known to definition files and ``feature_set``; replaces its name's."""
    REGISTRY[feature.name] = feature
    return feature


def feature_set(name: str, features: Sequence[str] | None = None) -> FeatureSet:
    """A set of registered features; by default all, in the order of their files."""
    chosen = list(REGISTRY) if features is None else list(features)
    unknown = [feature for feature in chosen if feature not in REGISTRY]
    if unknown:
        raise ValueError(f"unknown features: {unknown}")
    return FeatureSet(name, tuple(REGISTRY[feature] for feature in chosen))


DEFAULT = feature_set("lambdamart0")


def attach_features(
    rows: DataFrame, catalog: DataFrame | TextIndex, features: FeatureSet = DEFAULT
) -> DataFrame:
    """Add ``features`` to rows of ``search_term, channel_group,
    customer_avg_ticket, sku``; rows whose document is not in the catalog go.

    With an index of the catalog no text is read.
    """
    missing = [param for param in features.params if param not in rows.columns]
    if missing:
        raise ValueError(f"feature set {features.name!r} needs columns {missing}")
    used, fields = features.doc_columns, features.text_fields
    if fields:
        index = textmatch.as_index(catalog, fields, "sku", used)
        # a pair is scored once, however many contexts share it
        pairs = rows.select("search_term", "sku").distinct()
        joined = rows.join(textmatch.bm25(pairs, index, fields, carry=used), ["search_term", "sku"])
    else:
        documents = catalog.documents if isinstance(catalog, TextIndex) else catalog
        joined = rows.join(documents.select("sku", *used), "sku")
    return (
        joined
        .withColumn("features", features.as_array())
        .select(*rows.columns, "features")
    )


def log_features(
    judgments: DataFrame, catalog: DataFrame | TextIndex, features: FeatureSet = DEFAULT
) -> DataFrame:
    """Features of each judged (context, document), paired by document."""
    rows = judgments.withColumnRenamed("doc", "sku")
    return attach_features(rows, catalog, features).withColumnRenamed("sku", "doc")


def training_lists(logged: DataFrame, keys: Sequence[str], min_docs: int = 2) -> DataFrame:
    """Lists of at least ``min_docs`` documents, numbered ``qid`` without gaps."""
    sizes = logged.groupBy(*keys).agg(F.count("*").alias("_n"))
    kept = sizes.filter(F.col("_n") >= min_docs)
    return logged.join(dense_ids(kept, keys, "qid"), list(keys))


def normalise(rows: DataFrame, size: int, keys: Sequence[str] = ("qid",)) -> DataFrame:
    """Divide each feature by its list's sum of absolute values; 0 where that is 0.

    ``size`` is the number of features; a row with another number is an error. The sums are
    an aggregate joined back, so a long list is not gathered.
    """
    right = F.size("features") == size
    wrong = F.raise_error(F.lit(f"normalise: a row does not have {size} features"))
    rows = rows.withColumn("features", F.when(right, F.col("features")).otherwise(wrong))
    sums = rows.groupBy(*keys).agg(  # one row per list
        F.array(*[F.sum(F.abs(F.get("features", F.lit(i)))) for i in range(size)]).alias("_sums"),
        F.count("*").alias("_rows"),
    )
    scaled = F.zip_with(
        "features", "_sums", lambda x, s: F.when(s > 0, x / s).otherwise(F.lit(0.0))
    )
    names = [name for name in ("doc", "sku", "features") if name in rows.columns]
    sums = cut_lineage(sums)
    joined = spread_join(rows, sums.drop("_rows"), keys, sums.select(*keys, "_rows"), names)
    return joined.withColumn("features", scaled).drop("_sums")


def letor_lines(rows: DataFrame) -> DataFrame:
    """``grade<TAB>qid:N<TAB>1:v<TAB>2:v…``; a missing value is written as 0."""
    values = F.transform(
        "features",
        lambda x, i: F.concat(
            (i + 1).cast("string"), F.lit(":"), F.coalesce(x.cast("string"), F.lit("0"))
        ),
    )
    line = F.concat_ws(
        "\t",
        F.col("grade").cast("string"),
        F.concat(F.lit("qid:"), F.col("qid").cast("string")),
        F.concat_ws("\t", values),
    )
    return rows.select("qid", "doc", line.alias("line"))
