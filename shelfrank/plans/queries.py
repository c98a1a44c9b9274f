"""The named queries. Each takes ``(spark, sf_dir)`` and gives a flat DataFrame.

Whole tables in, no samples; doubles are rounded to six decimals at the very end
so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.functions import arrays, numbers, text
from shelfrank.functions.sql import register_sql_functions, run_sql
from shelfrank.operators import (
    catalog,
    clicks,
    dbn,
    ensemble,
    features,
    insession,
    linesearch,
    metrics,
    ranking,
    sessions,
    textmatch,
    training,
    tuning,
)
from shelfrank.operators.numbering import dense_ids, group_percentiles
from shelfrank.plans import workflow
from shelfrank.schemas import CLICKSTREAM, GRADED, VALIDATION
from shelfrank.session import cut_lineage, scratch_folder
from shelfrank.sources import adapter, buckets, readers, writers

CONTEXT = sessions.CONTEXT

WINDOWS = {
    "train": ("2024-01-01", "2024-01-10"),
    "validation": ("2024-01-11", "2024-01-20"),
    "test": ("2024-01-21", "2024-01-30"),
}

# two small trees over the four features
SMALL_MODEL = [
    ensemble.Node(1, 0, 0.1, feature=1, threshold=2.55, left=1, right=4),
    ensemble.Node(1, 1, 0.1, feature=4, threshold=1.05, left=2, right=3),
    ensemble.Node(1, 2, 0.1, output=-0.5),
    ensemble.Node(1, 3, 0.1, output=1.5),
    ensemble.Node(1, 4, 0.1, feature=3, threshold=4.05, left=5, right=6),
    ensemble.Node(1, 5, 0.1, output=-1.25),
    ensemble.Node(1, 6, 0.1, output=0.75),
    ensemble.Node(2, 0, 0.2, feature=3, threshold=6.15, left=1, right=2),
    ensemble.Node(2, 1, 0.2, output=-0.3),
    ensemble.Node(2, 2, 0.2, output=0.9),
]


def flat(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns with plain types: bigint, and doubles of six decimals."""
    chosen = []
    for name in columns or df.columns:
        kind = df.schema[name].dataType
        column = F.col(name)
        if isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            column = F.round(column.cast("double"), 6)
        chosen.append(column.alias(name))
    return df.select(*chosen)


def spread_features(df: DataFrame, *columns: str) -> DataFrame:
    numbered = [F.get("features", F.lit(i)).alias(f"f{i + 1}") for i in range(4)]
    return flat(df.select(*columns, *numbered))


# -- shared inputs -----------------------------------------------------------


def event_lists(spark: SparkSession, sf_dir: str, rate: float = 1.0) -> DataFrame:
    return sessions.session_lists(adapter.event_hits(spark, sf_dir), rate)


def order_lists(spark: SparkSession, sf_dir: str, rate: float = 1.0) -> DataFrame:
    return sessions.session_lists(adapter.order_hits(spark, sf_dir), rate)


def event_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = adapter.event_hits(spark, sf_dir)
    return sessions.train_sets(sessions.session_lists(hits, 1.0), sessions.visitor_context(hits))


def event_catalog_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.catalog_rows(catalog.product_channel(adapter.event_hits(spark, sf_dir)))


def event_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog as a table of its own: searches read it many times."""
    return cut_lineage(catalog.catalog_docs(event_catalog_rows(spark, sf_dir)))


def event_index(spark: SparkSession, sf_dir: str) -> textmatch.TextIndex:
    """The catalog's text index as tables, as it is stored beside a catalog."""
    return stored_index(ranking.catalog_index(event_catalog(spark, sf_dir)))


def stored_index(index: textmatch.TextIndex) -> textmatch.TextIndex:
    return textmatch.write_index(index, scratch_folder(index.documents.sparkSession))


def event_graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks.grade(clicks.sdbn(event_lists(spark, sf_dir), ["query"]), ["query"])


def context_graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks.grade(clicks.sdbn(event_sets(spark, sf_dir), CONTEXT), CONTEXT)


def order_graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks.grade(clicks.sdbn(order_lists(spark, sf_dir), ["query"]), ["query"])


def evaluation_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases of the three date windows, labelled, in one pass."""
    hits = sessions.temporal_split(adapter.event_hits(spark, sf_dir), WINDOWS)
    visitors = sessions.visitor_context(hits, by=["set_name"])
    return cut_lineage(sessions.validation_sets(hits, visitors, by=["set_name"]))


def feature_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.log_features(
        context_graded(spark, sf_dir).select(*CONTEXT, "doc", "grade"),
        event_index(spark, sf_dir),
    )


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = features.training_lists(feature_log(spark, sf_dir), CONTEXT)
    return cut_lineage(features.normalise(lists, len(features.DEFAULT.features)))


def searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = adapter.table(spark, sf_dir, "part")
    texts = [
        part.select(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("search_term")),
        part.select(F.col("p_name").alias("search_term")),
        part.select(F.col("p_partkey").cast("string").alias("search_term")),
    ]
    return reduce(DataFrame.unionAll, texts).distinct()


# -- session log -------------------------------------------------------------


def q_search_hits(spark, sf_dir):
    return flat(
        sessions.search_hits(adapter.event_hits(spark, sf_dir)),
        "session_id",
        "query",
        "doc",
        "click",
        "position",
    )


def q_unnest_hits(spark, sf_dir):
    rows = sessions.explode_sessions(adapter.event_sessions(spark, sf_dir))
    return flat(rows, "session_id", "hit_pos", "product_pos", "sku")


def q_unnest_products(spark, sf_dir):
    rows = sessions.explode_sessions(adapter.event_sessions(spark, sf_dir), outer=False)
    return flat(
        rows.groupBy("sku").agg(
            F.count("*").alias("n"),
            F.avg(numbers.micros_to_units(F.col("price_micros"))).alias("price"),
        )
    )


def q_nested_search_hits(spark, sf_dir):
    return flat(
        sessions.nested_search_hits(adapter.event_sessions(spark, sf_dir)),
        "session_id",
        "query",
        "doc",
        "click",
        "position",
    )


def q_purchased_from_search(spark, sf_dir):
    rows = sessions.nested_purchases(adapter.event_sessions(spark, sf_dir))
    return flat(
        rows.select(
            "session_id",
            F.size("searched").alias("searched"),
            F.size("purchased").alias("purchased"),
            arrays.element_or_null(F.col("searched"), 0).alias("first_sku"),
            F.array_join("purchased", ",").alias("purchased_skus"),
        )
    )


_LIST = ("session_id", "query", "doc", "click", "purchase", "list_pos", "last_click")


def q_session_lists(spark, sf_dir):
    return flat(event_lists(spark, sf_dir), *_LIST)


def q_session_lists_sampled(spark, sf_dir):
    return flat(event_lists(spark, sf_dir, 0.01), *_LIST)


def q_order_lists(spark, sf_dir):
    return flat(order_lists(spark, sf_dir), *_LIST)


def nested_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions as a stored log has them, one row each."""
    return cut_lineage(adapter.nested_event_hits(spark, sf_dir))


def q_nested_session_lists(spark, sf_dir):
    return flat(insession.session_lists(nested_log(spark, sf_dir), 1.0), *_LIST)


def q_nested_session_lists_sampled(spark, sf_dir):
    return flat(insession.session_lists(nested_log(spark, sf_dir), 0.01), *_LIST)


def q_nested_visitor_context(spark, sf_dir):
    visitors = insession.visitor_context(nested_log(spark, sf_dir))
    return flat(visitors, "fv", "channel_group", "avg_ticket", "raw_ticket")


def q_nested_product_channel(spark, sf_dir):
    return flat(insession.product_channel(nested_log(spark, sf_dir)))


def q_nested_validation_contexts(spark, sf_dir):
    log = nested_log(spark, sf_dir)
    sets = sessions.purchased_sets(insession.rolled_docs(log), insession.visitor_context(log))
    return flat(sessions.validation_contexts(sets))


def q_list_arrays(spark, sf_dir):
    nested = sessions.nested_lists(event_lists(spark, sf_dir))
    docs = F.col("docs")
    kept = nested.filter(arrays.size_between(docs, 3, 500) & arrays.any_click(docs))
    return flat(
        kept.select(
            "session_id",
            "query",
            F.size(docs).alias("n_docs"),
            arrays.any_click(docs).alias("any_click"),
            arrays.purchase_count(docs).alias("purchases"),
            arrays.element_or_null(docs, 0)["doc"].alias("first_doc"),
            F.array_join(F.transform(docs, lambda d: d["doc"]), ",").alias("docs"),
        )
    )


def q_visitor_context(spark, sf_dir):
    visitors = sessions.visitor_context(adapter.event_hits(spark, sf_dir))
    return flat(visitors, "fv", "channel_group", "avg_ticket", "raw_ticket")


def q_train_contexts(spark, sf_dir):
    return flat(sessions.train_contexts(event_sets(spark, sf_dir)))


def q_order_contexts(spark, sf_dir):
    hits = adapter.order_hits(spark, sf_dir)
    lists = sessions.session_lists(hits, 1.0)
    return flat(
        sessions.train_contexts(sessions.train_sets(lists, sessions.visitor_context(hits)))
    )


def q_validation_contexts(spark, sf_dir):
    hits = adapter.event_hits(spark, sf_dir)
    sets = sessions.validation_sets(hits, sessions.visitor_context(hits))
    return flat(sessions.validation_contexts(sets))


def q_temporal_split(spark, sf_dir):
    labelled = sessions.temporal_split(adapter.event_hits(spark, sf_dir), WINDOWS)
    per_session = labelled.groupBy("set_name", "session_id").agg(F.count("*").alias("hits"))
    return flat(
        per_session.groupBy("set_name").agg(
            F.sum("hits").alias("n_hits"), F.count("*").alias("n_sessions")
        )
    )


def q_hit_scalars(spark, sf_dir):
    hits = adapter.event_hits(spark, sf_dir)
    price = numbers.micros_to_units(F.col("price_micros"))
    path = F.col("pagepath")
    return flat(
        hits.filter(text.valid_sku(F.col("sku"))).select(
            "session_id",
            "hit_pos",
            text.normalize_query(path).alias("query"),
            text.is_search_page(path).alias("on_search"),
            F.coalesce(text.channel_group(F.col("channel")), F.lit("")).alias("channel_group"),
            text.clean_category(F.col("category")).alias("category"),
            price.alias("price"),
            numbers.round_to_int(price / 2).alias("half_price"),
            numbers.round_to_int(-price / 2).alias("minus_half_price"),
            numbers.flag(F.col("is_click")).alias("click"),
            numbers.nullable_flag(F.col("is_impression")).alias("impression"),
            numbers.log_price_distance(price, F.lit(40)).alias("price_distance"),
            numbers.hash_fraction(F.col("session_id"), F.col("hit_pos")).alias("fraction"),
        )
    )


def q_sql_functions(spark, sf_dir):
    register_sql_functions(spark)
    adapter.event_hits(spark, sf_dir).createOrReplaceTempView("shelfrank_event_hits")
    return flat(
        run_sql(
            spark,
            """
            SELECT coalesce(process_channel_group(channel), '') AS channel_group,
                   count(*) AS n, sum(log_price_distance(price_micros / 1e6, 40)) AS distance
            FROM shelfrank_event_hits
            WHERE session_date BETWEEN CAST(:first AS DATE) AND CAST(:last AS DATE)
            GROUP BY 1
            """,
            first="2024-01-05",
            last="2024-01-14",
        )
    )


# -- click models ------------------------------------------------------------

_JUDGED = ("doc", "alpha", "sigma", "judgment")
_GRADED = ("doc", "judgment", "grade")


def q_sdbn_judgments(spark, sf_dir):
    return flat(clicks.sdbn(event_lists(spark, sf_dir), ["query"]), "query", *_JUDGED)


def q_graded_judgments(spark, sf_dir):
    return flat(event_graded(spark, sf_dir), "query", *_GRADED)


def q_context_graded_judgments(spark, sf_dir):
    return flat(context_graded(spark, sf_dir), *CONTEXT, *_GRADED)


def q_order_sdbn_judgments(spark, sf_dir):
    return flat(clicks.sdbn(order_lists(spark, sf_dir), ["query"]), "query", *_JUDGED)


def q_order_graded_judgments(spark, sf_dir):
    return flat(order_graded(spark, sf_dir), "query", *_GRADED)


def q_judgment_percentiles(spark, sf_dir):
    judged = clicks.sdbn(order_lists(spark, sf_dir), ["query"])
    edges = group_percentiles(judged, ["query"], "judgment", "doc", clicks.GRADE_POINTS)
    picked = [
        F.get("percentiles", F.lit(i)).alias(f"p{20 * (i + 1)}")
        for i in range(len(clicks.GRADE_POINTS))
    ]
    return flat(edges.select("query", *picked))


def q_dbn_one_step(spark, sf_dir):
    fitted = dbn.dbn_em(event_lists(spark, sf_dir), ["query"], iterations=1)
    return flat(fitted, "query", "doc", "alpha", "sigma", "gamma", "judgment")


def q_dbn_judgments(spark, sf_dir):
    fitted = dbn.dbn_em(event_lists(spark, sf_dir), ["query"])
    return flat(fitted, "query", "doc", "alpha", "sigma", "gamma", "judgment")


def q_order_dbn_judgments(spark, sf_dir):
    """Five very hot searches."""
    fitted = dbn.dbn_em(order_lists(spark, sf_dir), ["query"], iterations=10)
    return flat(fitted, "query", "doc", "alpha", "sigma", "gamma", "judgment")


def q_context_keys(spark, sf_dir):
    sets = event_sets(spark, sf_dir).select(*CONTEXT).distinct()
    keyed = sets.select(text.format_context_key(CONTEXT).alias("key"))
    parsed = text.parse_context_key(F.col("key"))
    return flat(
        keyed.select(
            "key",
            parsed["search_term"].alias("search_term"),
            parsed["channel_group"].alias("channel_group"),
            parsed["customer_avg_ticket"].cast("bigint").alias("customer_avg_ticket"),
        )
    )


def as_json(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows written as JSON lines and read with a schema."""
    names = [field.name for field in schema.fields]
    lines = rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))
    return lines.select(F.from_json("value", schema).alias("row")).select(
        *[F.col("row")[name].alias(name) for name in names]
    )


def q_clickstream_round_trip(spark, sf_dir):
    nested = writers.clickstream_rows(event_sets(spark, sf_dir))
    lists = readers.long_clickstream(as_json(nested, CLICKSTREAM))
    shown = [*CONTEXT, "doc", "click", "purchase", "list_pos", "last_click"]
    return flat(lists.groupBy(*shown).agg(F.count("*").alias("n")))


def q_validation_round_trip(spark, sf_dir):
    hits = adapter.event_hits(spark, sf_dir)
    sets = sessions.validation_sets(hits, sessions.visitor_context(hits))
    rows = readers.long_validation(as_json(writers.validation_rows(sets), VALIDATION))
    each = rows.groupBy(*CONTEXT, "raw_ticket", "sku").agg(F.count("*").alias("n"))
    return flat(each.drop("raw_ticket"))


def q_judgment_rows(spark, sf_dir):
    nested = writers.judgment_rows(context_graded(spark, sf_dir), CONTEXT)
    graded = readers.long_graded(readers.graded_arrays(as_json(nested, GRADED)), CONTEXT)
    ticket = F.col("customer_avg_ticket").cast("bigint")
    return flat(graded.withColumn("customer_avg_ticket", ticket))


def q_raw_judgments(spark, sf_dir):
    """Exported judgments as one-key JSON lines, parsed again."""
    judged = clicks.sdbn(event_sets(spark, sf_dir), CONTEXT)
    exported = dbn.export_judgments(judged, CONTEXT)
    lines = exported.select(
        F.to_json(F.create_map("key", F.create_map("doc", "judgment"))).alias("value")
    )
    rows = readers.parse_raw_judgments(lines)
    return flat(
        rows.select(
            F.col("search_keys")["search_term"].alias("search_term"),
            F.col("search_keys")["channel_group"].alias("channel_group"),
            F.col("search_keys")["customer_avg_ticket"].cast("bigint").alias("customer_avg_ticket"),
            "doc",
            "judgment",
        )
    )


# -- catalog -----------------------------------------------------------------


def q_product_channel(spark, sf_dir):
    return flat(catalog.product_channel(adapter.event_hits(spark, sf_dir)))


def q_catalog_rows(spark, sf_dir):
    return flat(event_catalog_rows(spark, sf_dir))


def q_catalog_docs(spark, sf_dir):
    return flat(catalog.catalog_docs(event_catalog_rows(spark, sf_dir)))


def q_documents_strict(spark, sf_dir):
    """Catalog documents in the strict nested schema and back."""
    documents = catalog.to_documents(catalog.catalog_docs(event_catalog_rows(spark, sf_dir)))
    rows = catalog.from_documents(documents)
    return flat(rows.select("sku", "name", "category", F.col("price").cast("double").alias("price"), "impressions", "clicks"))


def q_catalog_last(spark, sf_dir):
    return flat(catalog.catalog_docs(event_catalog_rows(spark, sf_dir), mode="last"))


def q_upsert_catalog(spark, sf_dir):
    old = adapter.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("sku"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("price"),
    )
    new = catalog.catalog_docs(event_catalog_rows(spark, sf_dir)).select("sku", "name", "price")
    return flat(catalog.upsert_catalog(old, new, order="name"))


def q_upsert_catalog_buckets(spark, sf_dir):
    """The same loads into a bucketed table, read back by its manifest."""
    path = scratch_folder(spark)
    old = adapter.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("sku"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("price"),
    )
    buckets.upsert(old, path)
    new = catalog.catalog_docs(event_catalog_rows(spark, sf_dir)).select("sku", "name", "price")
    buckets.upsert(new, path)
    return flat(buckets.read_buckets(spark, path))


# -- text match and search ---------------------------------------------------


def q_bm25_judged(spark, sf_dir):
    pairs = event_graded(spark, sf_dir).select(
        F.col("query").alias("search_term"), F.col("doc").alias("sku")
    )
    scored = textmatch.bm25(pairs, event_index(spark, sf_dir), features.TEXT_FIELDS)
    return flat(
        scored.select(
            F.col("search_term").alias("query"),
            F.col("sku").alias("doc"),
            "bm25_name",
            "bm25_category",
        )
    )


def q_bm25_documents(spark, sf_dir):
    asked = adapter.table(spark, sf_dir, "benchmark").select(
        "item_id", F.col("text").alias("search_term")
    )
    documents = adapter.table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = stored_index(textmatch.index_of(documents, ["text"], "doc_id"))
    scored = textmatch.matched_scores(asked, docs, ["text"], key="doc_id", blended=False)
    return flat(
        scored.join(asked, "search_term").select(
            "item_id", "doc_id", F.col("bm25_text").alias("score")
        )
    )


def q_match_all_terms(spark, sf_dir):
    part = adapter.table(spark, sf_dir, "part")
    asked = reduce(
        DataFrame.unionAll,
        [
            part.select(F.col("p_name").alias("search_term")),
            part.select(F.concat_ws(" ", "p_type", "p_name").alias("search_term")),
            part.select(F.col("p_partkey").cast("string").alias("search_term")),
        ],
    ).distinct()
    docs = textmatch.with_tokens(
        part.select(
            F.col("p_partkey").cast("string").alias("sku"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("category"),
        ),
        features.TEXT_FIELDS,
    )
    matched = textmatch.match_cross_fields(asked, docs, features.TEXT_FIELDS)
    return flat(matched, "search_term", "sku")


def q_first_pass_topk(spark, sf_dir):
    top = ranking.first_pass_topk(searches(spark, sf_dir), event_index(spark, sf_dir))
    return flat(top, "search_term", "sku", "score", "pos")


def q_rescored_topk(spark, sf_dir):
    contexts = evaluation_sets(spark, sf_dir).select("set_name", *CONTEXT).distinct()
    found = ranking.search(contexts, event_index(spark, sf_dir), SMALL_MODEL)
    return flat(found, "set_name", *CONTEXT, "sku", "score", "pos")


# -- features and models -----------------------------------------------------


def q_feature_log(spark, sf_dir):
    return spread_features(feature_log(spark, sf_dir), *CONTEXT, "doc", "grade")


def q_feature_log_normalised(spark, sf_dir):
    lists = features.training_lists(feature_log(spark, sf_dir), CONTEXT)
    return spread_features(features.normalise(lists, len(features.DEFAULT.features)), *CONTEXT, "doc", "grade", "qid")


def q_normalised_wide(spark, sf_dir):
    """Six features: the grade and a difference beside the four."""
    lists = features.training_lists(feature_log(spark, sf_dir), CONTEXT)
    own = F.col("features")
    more = F.array(F.col("grade").cast("double"), F.get(own, F.lit(2)) - F.get(own, F.lit(0)))
    wide = features.normalise(lists.withColumn("features", F.concat(own, more)), 6)
    numbered = [F.get("features", F.lit(i)).alias(f"f{i + 1}") for i in range(6)]
    return flat(wide.select(*CONTEXT, "doc", "qid", *numbered))


def q_letor_parsed(spark, sf_dir):
    """Training text written and parsed again."""
    lists = features.training_lists(feature_log(spark, sf_dir), CONTEXT)
    exact = lists.withColumn("features", F.col("features").cast("array<decimal(18,6)>"))
    lines = features.letor_lines(exact).select(F.col("line").alias("value"))
    return spread_features(readers.parse_letor(lines), "qid", "grade")


def q_letor_sparse(spark, sf_dir):
    """Training text without its zeros, parsed again."""
    lists = features.training_lists(feature_log(spark, sf_dir), CONTEXT)
    exact = lists.withColumn("features", F.col("features").cast("array<decimal(18,6)>"))
    sparse = F.regexp_replace("line", r"\t[0-9]+:0\.0+(?=\t|$)", "")
    rows = readers.parse_letor(features.letor_lines(exact).select(sparse.alias("value")))
    whole = F.transform(
        F.sequence(F.lit(0), F.lit(3)), lambda i: F.coalesce(F.get("features", i), F.lit(0.0))
    )
    return spread_features(rows.withColumn("features", whole), "qid", "grade")


def q_letor_rows(spark, sf_dir):
    lists = features.training_lists(feature_log(spark, sf_dir), CONTEXT)
    exact = lists.withColumn("features", F.col("features").cast("array<decimal(18,6)>"))
    return flat(features.letor_lines(exact), "qid", "doc", "line")


def q_dense_list_ids(spark, sf_dir):
    return flat(dense_ids(event_sets(spark, sf_dir), CONTEXT, "qid"))


def q_ensemble_scores(spark, sf_dir):
    scored = ensemble.score_ensemble(feature_log(spark, sf_dir), SMALL_MODEL, name="score")
    return flat(scored, *CONTEXT, "doc", "score")


MANY_TREES = [
    ensemble.Node(**{**vars(node), "tree": node.tree + 2 * copy})
    for copy in range(30)
    for node in SMALL_MODEL
]


def q_ensemble_scores_many_trees(spark, sf_dir):
    scored = ensemble.score_ensemble(feature_log(spark, sf_dir), MANY_TREES, name="score")
    return flat(scored, *CONTEXT, "doc", "score")


def q_ensemble_scores_missing(spark, sf_dir):
    """Arrays that are NULL, hold NaN or NULL, or end early, scored by both engines."""
    own = F.col("features")
    kind = F.pmod(F.col("doc").cast("bigint"), F.lit(4))
    odd = (
        F.when(kind == 0, F.lit(None))
        .when(kind == 1, F.concat(F.array(F.lit(float("nan"))), F.slice(own, 2, 3)))
        .when(kind == 2, F.slice(own, 1, 2))
        .otherwise(F.concat(F.slice(own, 1, 3), F.array(F.lit(None).cast("double"))))
    )
    rows = feature_log(spark, sf_dir).withColumn("features", odd)
    few = ensemble.score_ensemble(rows, SMALL_MODEL, name="few")
    return flat(ensemble.score_ensemble(few, MANY_TREES, name="many"), *CONTEXT, "doc", "few", "many")


def model_text(model: ensemble.Model) -> str:
    """A model in the text form that ``readers.parse_ensemble`` takes."""
    trees = {}
    for node in model:
        trees.setdefault(node.tree, {})[node.node] = node

    def split(nodes, number, place=""):
        node = nodes[number]
        pos = f' pos="{place}"' if place else ""
        if node.is_leaf:
            return f"<split{pos}><output>{node.output}</output></split>"
        inner = split(nodes, node.left, "left") + split(nodes, node.right, "right")
        head = f"<feature>{node.feature}</feature><threshold>{node.threshold}</threshold>"
        return f"<split{pos}>{head}{inner}</split>"

    body = "".join(
        f'<tree id="{tree}" weight="{nodes[0].weight}">{split(nodes, 0)}</tree>'
        for tree, nodes in trees.items()
    )
    return f"## No. of trees = {len(trees)}\n<ensemble>{body}</ensemble>"


def q_model_nodes(spark, sf_dir):
    """Scores of a model that went through its text and its node table."""
    nodes, _ = readers.parse_ensemble(model_text(SMALL_MODEL))
    model = ensemble.model_from_frame(ensemble.model_frame(spark, nodes))
    scored = ensemble.score_ensemble(feature_log(spark, sf_dir), model, name="score")
    return flat(scored, *CONTEXT, "doc", "score")


def _scored(rows: DataFrame, model) -> DataFrame:
    return flat(ensemble.score_ensemble(rows, model, name="score"), *CONTEXT, "doc", "score")


def q_lambda_gradients(spark, sf_dir):
    """Gradients of ERR with the price distance as the current score."""
    lists = features.training_lists(feature_log(spark, sf_dir), CONTEXT)
    scored = lists.select(
        "qid",
        "doc",
        F.col("grade").cast("double").alias("grade"),
        F.round(F.get("features", F.lit(0)), 6).alias("F"),
    )
    found = training.lambda_gradients(scored)
    # gains are sixteenths, so many values lie on an edge of the sixth decimal
    exact = {name: numbers.stable(F.col(name)) for name in ("lam", "w")}
    return flat(found.withColumns(exact), "qid", "doc", "lam", "w")


def q_lambdamart_first_tree(spark, sf_dir):
    """Scores of one tree of two leaves, every value a candidate threshold."""
    lists = features.training_lists(feature_log(spark, sf_dir), CONTEXT)
    exact = F.transform("features", lambda x: F.round(x, 6))
    rows = cut_lineage(lists.select("qid", "doc", "grade", exact.alias("features")))
    model = training.train_lambdamart(rows, trees=1, leaf=2, tc=-1)
    return flat(ensemble.score_ensemble(rows, model, name="score"), "qid", "doc", "score")


def q_lambdamart_missing(spark, sf_dir):
    """The first tree on arrays that are NULL, short or hold NULL, and on repeated rows."""
    lists = features.training_lists(feature_log(spark, sf_dir), CONTEXT)
    exact = F.transform("features", lambda x: F.round(x, 6))
    kind = F.pmod(F.col("doc").cast("bigint"), F.lit(5))
    rows = lists.select("qid", "doc", "grade", exact.alias("features"), kind.alias("kind"))
    own = F.col("features")
    odd = (
        F.when(kind == 0, F.lit(None))
        .when(kind == 1, F.slice(own, 1, 2))
        .when(kind == 2, F.concat(F.slice(own, 1, 3), F.array(F.lit(None).cast("double"))))
        .otherwise(own)
    )
    rows = cut_lineage(rows.withColumn("features", odd))
    rows = rows.unionByName(rows.where("kind = 3")).drop("kind")
    model = training.train_lambdamart(rows, trees=1, leaf=2, tc=-1)
    return flat(ensemble.score_ensemble(rows, model, name="score"), "qid", "doc", "score")


def _exact_rows(spark, sf_dir):
    lists = features.training_lists(feature_log(spark, sf_dir), CONTEXT)
    exact = F.transform("features", lambda x: F.round(x, 6))
    return cut_lineage(lists.select("qid", "doc", "grade", exact.alias("features")))


def q_mart_first_tree(spark, sf_dir):
    rows = _exact_rows(spark, sf_dir)
    model = training.train_mart(rows, trees=1, leaf=2, tc=-1)
    return flat(ensemble.score_ensemble(rows, model, name="score"), "qid", "doc", "score")


def q_forest_first_tree(spark, sf_dir):
    """A forest of one tree of two leaves, on all rows and features."""
    rows = _exact_rows(spark, sf_dir)
    model = training.train_random_forest(rows, trees=1, leaf=2, tc=-1, bagging=False, feature_rate=1.0)
    return flat(ensemble.score_ensemble(rows, model, name="score"), "qid", "doc", "score")


def q_lambdamart_scores(spark, sf_dir):
    rows = training_rows(spark, sf_dir)
    return _scored(rows, training.train_lambdamart(rows))


def q_mart_scores(spark, sf_dir):
    rows = training_rows(spark, sf_dir)
    return _scored(rows, training.train_mart(rows))


def q_random_forest_scores(spark, sf_dir):
    rows = training_rows(spark, sf_dir)
    return _scored(rows, training.train_random_forest(rows))


def q_coordinate_ascent_scores(spark, sf_dir):
    rows = training_rows(spark, sf_dir)
    return _scored(rows, training.train_coordinate_ascent(rows, 4))


def q_line_search(spark, sf_dir):
    """The highest mean ERR along each weight of a linear ranker, all weights being equal."""
    rows = _exact_rows(spark, sf_dir)
    lists = rows.select("qid").distinct().count()
    found = [linesearch.best_on_coordinate(rows, [0.25] * 4, c) for c in range(4)]
    best = [(c, value / lists) for c, (_, value) in enumerate(found)] if lists else []
    return flat(spark.createDataFrame(best, "coordinate bigint, err double"))


# -- metrics -----------------------------------------------------------------


def q_err_documents(spark, sf_dir):
    documents = adapter.table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    labels = adapter.table(spark, sf_dir, "labels").select(
        "doc_id", (F.col("quality") * 4).alias("grade")
    )
    lists = documents.join(labels, "doc_id")
    return flat(metrics.err_at_k(lists, ["source"], [F.desc("n_chars"), F.asc("doc_id")]))


def q_err_judgments(spark, sf_dir):
    lists = order_graded(spark, sf_dir).withColumn("alpha", numbers.stable(F.col("alpha")))
    return flat(metrics.err_at_k(lists, ["query"], [F.desc("alpha"), F.asc("doc")]))


def q_mean_percentile_rank(spark, sf_dir):
    return flat(
        tuning.evaluate(None, evaluation_sets(spark, sf_dir), event_index(spark, sf_dir))
    )


def q_percentile_rank_full_lists(spark, sf_dir):
    """The metric over complete result lists, which ``evaluate`` does not build."""
    sets, docs = evaluation_sets(spark, sf_dir), event_index(spark, sf_dir)
    keys = ["set_name", *CONTEXT]
    lists = ranking.search(sets.select(*keys).distinct(), docs, None, use_ltr=False)
    return flat(
        metrics.mean_percentile_rank(lists, sets, keys, by=["set_name"], each=["raw_ticket"])
    )


def q_evaluated_model(spark, sf_dir):
    return flat(
        tuning.evaluate(SMALL_MODEL, evaluation_sets(spark, sf_dir), event_index(spark, sf_dir))
    )


def q_best_trial(spark, sf_dir):
    documents = adapter.table(spark, sf_dir, "documents").select("doc_id", "source")
    labels = adapter.table(spark, sf_dir, "labels").select("doc_id", "quality")
    trials = documents.join(labels, "doc_id").groupBy("source").agg(
        F.round(F.avg("quality"), 6).alias("rank_val")
    )
    numbered = trials.select(F.substring("source", 4, 9).cast("bigint").alias("trial"), "rank_val")
    return flat(tuning.best_trial(numbered))


def q_tuned_trials(spark, sf_dir):
    """Two trials of LambdaMART, measured on the training and validation windows."""
    rows = training_rows(spark, sf_dir)
    sets = evaluation_sets(spark, sf_dir)
    docs = event_index(spark, sf_dir)

    def ranks(model):
        found = {row["set_name"]: row["rank"] for row in tuning.evaluate(model, sets, docs).collect()}
        return {"train": found["train"], "validation": found["validation"]}

    space = {**training.SEARCH_SPACE["lambdamart"], "trees": ("int", 1, 3), "leaf": ("int", 2, 8)}
    _, done = tuning.tune(
        lambda **drawn: training.train_lambdamart(rows, **drawn),
        ranks,
        space,
        trials=2,
    )
    return flat(tuning.trials_frame(spark, done), "trial", "params", "rank_train", "rank_val")


def q_workflow_ranks(spark, sf_dir):
    """The whole job over the nested log, with one trial of few trees: its three ranks."""
    settings = workflow.Settings(
        root=scratch_folder(spark),
        windows=WINDOWS,
        rate=1.0,
        iterations=2,
        trials=1,
        source=sf_dir,
        space={"trees": ("int", 2, 2), "leaf": ("int", 4, 4)},
    )
    done = workflow.run_workflow(spark, nested_log(spark, sf_dir), settings)
    names = ("rank_train", "rank_val", "rank_test")
    return flat(spark.createDataFrame([tuple(float(done[x]) for x in names)], [*names]))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        name.removeprefix("q_"): value
        for name, value in globals().items()
        if name.startswith("q_") and callable(value)
    }
