"""Declared schemas of the data that crosses the library's edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

PRODUCT = T.StructType(
    [
        T.StructField("sku", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price_micros", T.LongType()),
        T.StructField("is_click", T.BooleanType()),
        T.StructField("is_impression", T.BooleanType()),
    ]
)

HIT = T.StructType(
    [
        T.StructField("pagepath", T.StringType()),
        T.StructField("action_type", T.StringType()),
        T.StructField("product", T.ArrayType(PRODUCT)),
    ]
)

SESSIONS = T.StructType(
    [
        T.StructField("fv", T.StringType()),
        T.StructField("session_id", T.LongType()),
        T.StructField("session_date", T.DateType()),
        T.StructField("channel", T.StringType()),
        T.StructField("hits", T.ArrayType(HIT)),
    ]
)

SEARCH_KEYS = T.StructType(
    [
        T.StructField("search_term", T.StringType()),
        T.StructField("channel_group", T.StringType()),
        T.StructField("customer_avg_ticket", T.LongType()),
    ]
)

CLICKSTREAM = T.StructType(
    [
        T.StructField("search_keys", SEARCH_KEYS),
        T.StructField(
            "judgment_keys",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(
                            "session",
                            T.ArrayType(
                                T.StructType(
                                    [
                                        T.StructField("doc", T.StringType()),
                                        T.StructField("click", T.IntegerType()),
                                        T.StructField("purchase", T.IntegerType()),
                                    ]
                                )
                            ),
                        )
                    ]
                )
            ),
        ),
    ]
)

VALIDATION = T.StructType(
    [
        T.StructField("search_keys", SEARCH_KEYS),
        T.StructField(
            "docs",
            T.ArrayType(
                T.StructType([T.StructField("purchased", T.ArrayType(T.StringType()))])
            ),
        ),
    ]
)

GRADED = T.StructType(
    [
        T.StructField("search_keys", T.MapType(T.StringType(), T.StringType())),
        T.StructField(
            "judgment_keys",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("doc", T.StringType()),
                        T.StructField("judgment", T.IntegerType()),
                    ]
                )
            ),
        ),
    ]
)

# fixed values: channel label in the session log -> name of its catalog field
CHANNELS = {
    "Organic Search": "organic_search",
    "Direct": "direct",
    "Referral": "referral",
    "Paid Search": "paid_search",
    "Display": "display",
    "Affiliates": "affiliates",
    "Social": "social",
}

_CTR = T.StructType([T.StructField("CTR", T.FloatType())])

CATALOG_DOCUMENT = T.StructType(
    [
        T.StructField("sku", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price", T.FloatType()),
        T.StructField(
            "performances",
            T.StructType(
                [
                    T.StructField(
                        "global",
                        T.StructType(
                            [
                                T.StructField("impressions", T.IntegerType()),
                                T.StructField("clicks", T.IntegerType()),
                                T.StructField("CTR", T.FloatType()),
                            ]
                        ),
                    ),
                    T.StructField(
                        "channel",
                        T.StructType(
                            [T.StructField(field, _CTR) for field in CHANNELS.values()]
                        ),
                    ),
                ]
            ),
        ),
    ]
)

TREE_NODES = T.StructType(
    [
        T.StructField("tree", T.IntegerType()),
        T.StructField("node", T.IntegerType()),
        T.StructField("weight", T.DoubleType()),
        T.StructField("feature", T.IntegerType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("left", T.IntegerType()),
        T.StructField("right", T.IntegerType()),
        T.StructField("output", T.DoubleType()),
    ]
)

TRIALS = T.StructType(
    [
        T.StructField("trial", T.IntegerType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("params", T.StringType()),
        T.StructField("rank_train", T.DoubleType()),
        T.StructField("rank_val", T.DoubleType()),
    ]
)


class StrictSchemaError(ValueError):
    """A frame holds fields its declared schema does not know."""


def _unknown(actual: T.DataType, declared: T.DataType, path: str) -> list[str]:
    if isinstance(actual, T.ArrayType) and isinstance(declared, T.ArrayType):
        return _unknown(actual.elementType, declared.elementType, path + "[]")
    if not isinstance(actual, T.StructType):
        return []
    if not isinstance(declared, T.StructType):
        return [path]
    known = {field.name: field.dataType for field in declared.fields}
    found = []
    for field in actual.fields:
        name = f"{path}.{field.name}" if path else field.name
        if field.name not in known:
            found.append(name)
        else:
            found += _unknown(field.dataType, known[field.name], name)
    return found


def require_schema(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Reject fields outside ``declared``, then put the columns in its order."""
    extra = _unknown(df.schema, declared, "")
    if extra:
        raise StrictSchemaError("fields not in the declared schema: " + ", ".join(extra))
    return df.to(declared)
