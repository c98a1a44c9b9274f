"""Tables, shared folders and small helpers the text operators have in common."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from shelfrank.session import ensure_checkpoint_dir

Span = tuple[str, int, int]
UNORDERED = ("map<", "variant", "interval")  # types that Spark neither hashes nor compares


def comparable(df: DataFrame) -> list[str]:
    """Columns that can be hashed and ordered: extra columns may be of any type."""
    return [f"`{name}`" for name, kind in df.dtypes if not any(x in kind for x in UNORDERED)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the checkpoint folder, which driver and executors share.

    It goes when the session ends.
    """
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def written(df: DataFrame, folder: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, safe from lost executors.

    Its size is known to the planner, which then decides what may be broadcast.
    """
    folder = folder or shared_folder(df.sparkSession)
    df.write.mode("overwrite").parquet(f"{folder}/table")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/table")


def map_texts(
    df: DataFrame, key: str, text: str, schema: str, one: Callable[[str], tuple]
) -> DataFrame:
    """``one(text)`` for every row of ``df``, as the columns of ``schema`` after the key.

    A null text counts as empty. Each row is handled by itself, so nothing is shuffled.
    """
    names = [field.split()[0] for field in schema.split(", ")]
    kind = dict(df.dtypes)[key]

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [one(x if isinstance(x, str) else "") for x in frame["text"]]
            columns = dict(zip(names, zip(*found, strict=True), strict=True)) if found else {}
            yield pd.DataFrame({"key": frame["key"], **{n: columns.get(n, ()) for n in names}})

    chosen = df.selectExpr(f"`{key}` AS key", f"`{text}` AS text")
    # a nullable integer key would reach pandas as float: carry it as text
    out = chosen.selectExpr("CAST(key AS STRING) AS key", "text").mapInPandas(
        batches, f"key string, {schema}"
    )
    return out.selectExpr(f"CAST(key AS {kind}) AS `{key}`", *names)


def joined(spans: Iterable[Span], kinds: tuple[str, ...]) -> str:
    """``kind:start:end`` by start, then kind as listed, then end, comma-joined."""
    place = {kind: i for i, kind in enumerate(kinds)}
    ordered = sorted(spans, key=lambda s: (s[1], place[s[0]], s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in ordered)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
