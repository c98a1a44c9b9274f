"""A keyed table in hash buckets, of which a load rewrites only those it touches.

Rows are dealt to buckets by their key's hash. A load reads the buckets that its keys fall
into, writes their new rows to a folder of its own, and then switches the manifest, a small
file that names each bucket's folder. Readers go by the manifest, so they see the table
before the load or after it, and a load that breaks off leaves nothing that counts. One
writer at a time.
"""

from __future__ import annotations

import json
import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.operators.catalog import last_per_key

BUCKETS = 64
MANIFEST = "manifest.json"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def _path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """Hadoop's path and the file system it is on."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def manifest(spark: SparkSession, path: str) -> dict | None:
    place, files = _path(spark, f"{path}/{MANIFEST}")
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _switch(spark: SparkSession, path: str, content: dict) -> None:
    """The new manifest in the place of the old one, in one step."""
    fresh, files = _path(spark, f"{path}/.{uuid.uuid4().hex}")
    stream = files.create(fresh)
    try:
        stream.write(json.dumps(content).encode())
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    options[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    context = hadoop.FileContext.getFileContext(fresh.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fresh, hadoop.Path(f"{path}/{MANIFEST}"), options)


def read_buckets(spark: SparkSession, path: str, only: list[int] | None = None) -> DataFrame | None:
    """The table as of its last finished load, or some of its buckets; None before the first."""
    state = manifest(spark, path)
    if state is None:
        return None
    schema = T.StructType.fromJson(state["schema"])
    wanted = range(state["count"]) if only is None else only
    folders = [f"{path}/{state['buckets'][str(b)]}" for b in wanted if str(b) in state["buckets"]]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def upsert(
    incoming: DataFrame, path: str, key: str = "sku", order: str = "name", buckets: int = BUCKETS
) -> list[int]:
    """Load rows into the table at ``path``; the last write per key wins. Gives the buckets
    that were rewritten.

    Of several incoming rows of a key the last in ``order`` counts. The number of buckets is
    that of the first load. Columns may be added, not taken away: missing ones are NULL.
    """
    spark = incoming.sparkSession
    state = manifest(spark, path)
    count = state["count"] if state else buckets
    place = bucket_of(key, count)
    # at most one row per bucket
    touched = sorted(r["bucket"] for r in incoming.select(place.alias("bucket")).distinct().collect())
    if not touched and state:
        return []
    rows = incoming.withColumn("_load", F.lit(1))
    old = read_buckets(spark, path, touched) if state else None
    if old is not None:
        rows = old.withColumn("_load", F.lit(0)).unionByName(rows, allowMissingColumns=True)
    merged = last_per_key(rows, key, ["_load", order]).drop("_load")
    names = [f.name for f in T.StructType.fromJson(state["schema"])] if state else incoming.columns
    merged = merged.select(*names, *[name for name in merged.columns if name not in names])
    folder = f"data/{uuid.uuid4().hex}"
    merged.withColumn("_bucket", place).repartition(len(touched) or 1, "_bucket").write.partitionBy(
        "_bucket"
    ).parquet(f"{path}/{folder}")
    placed = {**(state["buckets"] if state else {}), **{str(b): f"{folder}/_bucket={b}" for b in touched}}
    _switch(spark, path, {"count": count, "schema": merged.schema.jsonValue(), "buckets": placed})
    return touched


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete the folders of loads of which no bucket is in use; how many there were.

    Readers that began before the last load may still need them, so this is a step of its own.
    """
    state = manifest(spark, path) or {"buckets": {}}
    used = {place.split("/")[1] for place in state["buckets"].values()}
    place, files = _path(spark, f"{path}/data")
    if not files.exists(place):
        return 0
    old = [entry.getPath() for entry in files.listStatus(place) if entry.getPath().getName() not in used]
    for folder in old:
        files.delete(folder, True)
    return len(old)
