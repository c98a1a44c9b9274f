"""Readers for every format that crosses a step."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Sequence
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.functions.text import parse_context_key
from shelfrank.operators.ensemble import Node
from shelfrank.operators.features import REGISTRY, FeatureSet
from shelfrank.schemas import GRADED, TREE_NODES, TRIALS
from shelfrank.session import cut_lineage


def read_sessions(spark: SparkSession, path: str, first: str, last: str) -> DataFrame:
    """Sessions of an inclusive date window; ``session_date`` prunes partitions."""
    return spark.read.parquet(path).filter(
        F.col("session_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    )


def read_session_shards(spark: SparkSession, path: str, first: str, last: str) -> DataFrame:
    """Sessions in files named ``…_yyyyMMdd.parquet``, window given as ``yyyyMMdd``."""
    shard = F.regexp_extract(F.col("_metadata.file_name"), r".*_(\d+)\.", 1)
    return (
        spark.read.parquet(path)
        .select("*", shard.alias("shard_date"))
        .filter(F.col("shard_date").between(first, last))
    )


def read_ndjson_gz(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines of every ``*.gz`` file of a folder.

    A gzip file is one task; rows are spread again before further work.
    """
    rows = spark.read.schema(schema).option("pathGlobFilter", "*.gz").json(path)
    return rows.hint("rebalance")


def long_clickstream(clickstream: DataFrame) -> DataFrame:
    """Nested training sets as click lists, one row per document.

    Lists in files carry no session, so they are numbered, and written down for
    every later stage to see the same numbers. The last click is found in the row.
    """
    lists = clickstream.select("search_keys.*", F.explode("judgment_keys").alias("list"))
    numbered = cut_lineage(
        lists.select("*", F.col("list.session").alias("docs"))
        .drop("list")
        .withColumn("session_id", F.monotonically_increasing_id())
    )
    clicked = F.transform("docs", lambda doc, i: F.when(doc["click"] == 1, i + 1).otherwise(0))
    keys = [name for name in numbered.columns if name not in ("docs", "session_id")]
    return numbered.select(
        *keys,
        "session_id",
        F.col("search_term").alias("query"),
        F.array_max(clicked).cast("bigint").alias("last_click"),
        F.posexplode("docs").alias("_at", "_doc"),
    ).select(
        *keys,
        "session_id",
        "query",
        "_doc.*",
        (F.col("_at") + 1).cast("bigint").alias("list_pos"),
        "last_click",
    )


def long_validation(validation: DataFrame) -> DataFrame:
    """Nested validation sets as one row per purchased document.

    Files carry only the rounded ticket, but one line per exact one (and part): the line's
    number stands for it as ``raw_ticket``, written down for every later stage.
    """
    lines = cut_lineage(
        validation.withColumn("raw_ticket", F.monotonically_increasing_id().cast("double"))
    )
    return lines.select("search_keys.*", "raw_ticket", F.explode("docs").alias("_session")).select(
        "search_term",
        "channel_group",
        "customer_avg_ticket",
        "raw_ticket",
        F.explode("_session.purchased").alias("sku"),
    )


def read_raw_judgments(spark: SparkSession, path: str) -> DataFrame:
    return parse_raw_judgments(spark.read.text(path))


def parse_raw_judgments(lines: DataFrame) -> DataFrame:
    """``{"search_term:q|k:v": {doc: judgment}}`` lines (``value``) in long form."""
    entries = F.explode(F.from_json("value", "map<string,map<string,double>>"))
    return (
        lines.select(entries.alias("key", "docs"))
        .select(
            "key", parse_context_key(F.col("key")).alias("search_keys"), F.explode("docs")
            .alias("doc", "judgment")
        )
    )


def read_graded_judgments(spark: SparkSession, path: str) -> DataFrame:
    return graded_arrays(spark.read.schema(GRADED).json(path))


def graded_arrays(graded: DataFrame) -> DataFrame:
    """``search_keys, docs, grades`` with parallel arrays in file order.

    A search in several parts has several rows; ``long_graded`` takes them together.
    """
    return graded.select(
        "search_keys",
        F.transform("judgment_keys", lambda entry: entry["doc"]).alias("docs"),
        F.transform("judgment_keys", lambda entry: entry["judgment"]).alias("grades"),
    )


def long_graded(graded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Graded judgments in long form with the named context columns."""
    pairs = F.explode(F.arrays_zip("docs", "grades")).alias("entry")
    return graded.select(
        *[F.col("search_keys")[key].alias(key) for key in keys], pairs
    ).select(*keys, F.col("entry.docs").alias("doc"), F.col("entry.grades").alias("grade"))


def read_letor(spark: SparkSession, path: str) -> DataFrame:
    return parse_letor(spark.read.text(path))


def parse_letor(lines: DataFrame) -> DataFrame:
    """``grade<TAB>qid:N<TAB>1:v…`` lines (``value``) as ``grade, qid, features``.

    A value stands at the place its number names; numbers that a line leaves out are 0, so an
    array ends with the line's highest number. What follows a ``#`` is a comment.
    """
    parts = F.split(F.rtrim(F.substring_index("value", "#", 1)), "[\t ]+")
    split = lines.select(
        F.get(parts, F.lit(0)).cast("int").alias("grade"),
        F.split_part(F.get(parts, F.lit(1)), F.lit(":"), F.lit(2)).cast("bigint").alias("qid"),
        F.transform(
            F.slice(parts, F.lit(3), F.size(parts)),
            lambda part: F.struct(
                F.split_part(part, F.lit(":"), F.lit(1)).cast("int").alias("at"),
                F.split_part(part, F.lit(":"), F.lit(2)).cast("double").alias("x"),
            ),
        ).alias("_given"),
    )
    named = F.map_from_entries("_given")
    highest = F.array_max(F.transform("_given", lambda e: e["at"]))
    spread = F.transform(
        F.sequence(F.lit(1), highest), lambda i: F.coalesce(F.try_element_at(named, i), F.lit(0.0))
    )
    dense = F.aggregate(
        F.transform("_given", lambda e, i: e["at"] == i + 1), F.lit(True), lambda a, x: a & x
    )
    features = F.when(dense, F.transform("_given", lambda e: e["x"])).otherwise(spread)
    return split.select("grade", "qid", features.alias("features"))


def read_features(spark: SparkSession, directory: str, name: str) -> FeatureSet:
    """Feature definitions ``{name, params, query}`` in the order of their file names.

    The name picks the registered builder; the parameters must be the ones it
    takes. The query template belongs to a search server and is not run.
    """
    chosen = []
    files = spark.read.option("pathGlobFilter", "*.json").text(directory, wholetext=True)
    # a handful of small files
    for row in files.select("value", "_metadata.file_name").orderBy("file_name").collect():
        definition = json.loads(row["value"])
        feature = REGISTRY.get(definition["name"])
        if feature is None:
            raise ValueError(f"no builder for feature {definition['name']!r}")
        if sorted(definition["params"]) != sorted(feature.params):
            raise ValueError(f"feature {feature.name!r} takes {list(feature.params)}")
        chosen.append(feature)
    return FeatureSet(name, tuple(chosen))


def parse_ensemble(text: str) -> tuple[list[Node], dict[str, str]]:
    """Model text -> nodes and the settings of its ``##`` header lines."""
    settings = {}
    body = []
    for line in text.splitlines():
        if line.startswith("##"):
            name, _, value = line[2:].partition("=")
            settings[name.strip()] = value.strip()
        else:
            body.append(line)
    nodes: list[Node] = []
    sizes: Counter[int] = Counter()

    def walk(split, tree: int, weight: float) -> int:
        number = sizes[tree]
        sizes[tree] += 1
        output = split.find("output")
        if output is not None:
            nodes.append(Node(tree, number, weight, output=float(output.text)))
            return number
        place = len(nodes)
        nodes.append(Node(tree, number, weight))
        children = {child.get("pos"): child for child in split.findall("split")}
        left = walk(children["left"], tree, weight)
        right = walk(children["right"], tree, weight)
        nodes[place] = Node(
            tree,
            number,
            weight,
            feature=int(split.findtext("feature")),
            threshold=float(split.findtext("threshold")),
            left=left,
            right=right,
        )
        return number

    for element in ElementTree.fromstring("\n".join(body)).findall("tree"):
        walk(element.find("split"), int(element.get("id")), float(element.get("weight")))
    return nodes, settings


def read_ensemble(spark: SparkSession, path: str) -> tuple[list[Node], dict[str, str]]:
    """A model file of a few hundred small trees at most."""
    return parse_ensemble(spark.read.text(path, wholetext=True).first()["value"])


def load_model(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Node table of a saved model."""
    return (
        spark.read.schema(T.StructType([*TREE_NODES.fields, T.StructField("name", T.StringType())]))
        .parquet(root)
        .filter(F.col("name") == name)
        .drop("name")
    )


def read_trials(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRIALS).parquet(path)
