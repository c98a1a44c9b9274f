"""Writers for every format that crosses a step."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.operators.ensemble import LinearModel, Model, model_frame
from shelfrank.operators.features import letor_lines
from shelfrank.operators.sessions import CONTEXT

# entries of one search in one output row at most; a larger search takes several rows
MAX_ENTRIES = 10_000


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace what is there."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def existing_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None where none was written to its end."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark):
        return None
    return spark.read.parquet(path)


def rebuild(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], force_restart: bool = False
) -> DataFrame:
    """Build and write only when forced or when nothing is there yet.

    The path has to name everything the table depends on (see ``Settings.path``).
    """
    if not force_restart:
        found = existing_table(spark, path)
        if found is not None:
            return found
    write_table(build(), path)
    return spark.read.parquet(path)


def write_ndjson_gz(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Gzip JSON lines; ``single_file`` is for the catalog, which is small."""
    # a shuffle of its own, so that the work before it keeps its tasks
    rows = df.repartition(1) if single_file else df
    rows.write.mode("overwrite").option("compression", "gzip").json(path)


def nest_entries(
    df: DataFrame,
    keys: Sequence[str],
    entry: Column,
    unique: Sequence[str],
    name: str,
    max_entries: int = MAX_ENTRIES,
) -> DataFrame:
    """Arrays of entries per key, in ``parts`` rows numbered ``part`` from 0.

    Entries of a key are spread by the hash of ``unique`` over as many rows as it takes to
    keep the arrays around half of ``max_entries``, so no row or task grows with the hottest
    key. A key of at most half of ``max_entries`` entries has one part; readers of the long
    forms take the parts together, as they explode them.
    """
    rows_per_key = F.ceil(F.col("_n") * 2 / F.lit(max_entries))
    sizes = (
        df.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .select(*[F.col(key).alias(f"_key_{key}") for key in keys], rows_per_key.alias("_rows"))
    )
    same = [F.col(key).eqNullSafe(F.col(f"_key_{key}")) for key in keys]
    return (
        df.join(sizes, same)
        .withColumn("_row", F.pmod(F.xxhash64(*unique), F.col("_rows")))
        .groupBy(
            *keys,
            F.col("_row").cast("int").alias("part"),
            F.col("_rows").cast("int").alias("parts"),
        )
        .agg(F.array_sort(F.collect_list(entry)).alias(name))
    )


def clickstream_rows(sets: DataFrame, max_sessions: int = MAX_ENTRIES) -> DataFrame:
    """Training sets in nested form: context, then sessions, then documents."""
    document = F.struct("list_pos", "doc", "click", "purchase")
    session = sets.groupBy(*CONTEXT, "session_id", "query").agg(
        F.array_sort(F.collect_list(document)).alias("docs")
    )
    plain = session.withColumn(
        "session",
        F.transform("docs", lambda d: F.struct(d["doc"], d["click"], d["purchase"])),
    )
    nested = nest_entries(
        plain, CONTEXT, F.struct("session"), ["session_id"], "judgment_keys", max_sessions
    )
    return nested.select(
        F.struct(*CONTEXT).alias("search_keys"), "judgment_keys", "part", "parts"
    )


def validation_rows(sets: DataFrame, max_sessions: int = MAX_ENTRIES) -> DataFrame:
    """Validation sets in nested form: context, then sessions, then purchased skus."""
    keys = [*CONTEXT, "raw_ticket"]
    session = sets.groupBy(*keys, "session_id").agg(
        F.array_sort(F.collect_list("sku")).alias("purchased")
    )
    nested = nest_entries(
        session, keys, F.struct("purchased"), ["session_id"], "docs", max_sessions
    )
    return nested.select(F.struct(*CONTEXT).alias("search_keys"), "docs", "part", "parts")


def judgment_rows(
    graded: DataFrame, keys: Sequence[str], max_docs: int = MAX_ENTRIES
) -> DataFrame:
    """Graded judgments in nested form."""
    entry = F.struct("doc", F.col("grade").cast("int").alias("judgment"))
    nested = nest_entries(graded, keys, entry, ["doc"], "judgment_keys", max_docs)
    parts = [part for key in keys for part in (F.lit(key), F.col(key).cast("string"))]
    return nested.select(
        F.create_map(*parts).alias("search_keys"), "judgment_keys", "part", "parts"
    )


def write_judgments(graded: DataFrame, keys: Sequence[str], path: str) -> None:
    write_ndjson_gz(judgment_rows(graded, keys), path)


def write_letor(rows: DataFrame, path: str) -> None:
    """Training text; files in name order hold the lists in ``qid`` order."""
    lines = letor_lines(rows)
    (
        lines.repartitionByRange("qid", "doc")
        .sortWithinPartitions("qid", "doc")
        .select("line")
        .write.mode("overwrite")
        .text(path)
    )


def write_catalog(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], force_restart: bool = False
) -> DataFrame:
    """Documents of the strict schema, rebuilt on request or when absent."""
    from shelfrank.operators.catalog import to_documents

    return rebuild(spark, path, lambda: to_documents(build()), force_restart)


def append_results(trials: DataFrame, path: str) -> None:
    trials.coalesce(1).write.mode("append").parquet(path)


def save_model(
    spark: SparkSession, model: Model | LinearModel, root: str, name: str
) -> None:
    """Write a model under its name; only a model of the same name is replaced."""
    (
        model_frame(spark, model)
        .withColumn("name", F.lit(name))
        .coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("name")
        .parquet(root)
    )


__all__ = [
    "MAX_ENTRIES",
    "append_results",
    "clickstream_rows",
    "existing_table",
    "judgment_rows",
    "nest_entries",
    "rebuild",
    "save_model",
    "validation_rows",
    "write_catalog",
    "write_judgments",
    "write_letor",
    "write_ndjson_gz",
    "write_table",
]
