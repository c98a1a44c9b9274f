"""WARC archives: written as one gzip stream each, normalised to one member per record.

A crawl often leaves a whole archive compressed as a single gzip stream, which can only be
read from its start. The normaliser inflates such a file once, writes every record as a gzip
member of its own, and puts a sidecar index beside it (one JSON line per record: file, offset
and length of the member). Readers then seek to the records they want, and one archive can be
read by many tasks.

Every row becomes a record; its payload is the text in UTF-8, empty for null. Of rows with
equal payloads of at least ``min_bytes`` bytes, those with the largest id are ``response``
records and the others ``revisit`` records that name it, without payload but with its digest
and size. A null id is smaller than any other; where all ids of equal payloads are null,
every row is a response. Repeated rows give repeated records. Without rows no file is written.

Files are written to a new name by every attempt of a task, and only names that a finished
task reports are read, so a lost executor leaves nothing behind that counts.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.llm.shared import shared_folder, written

MIN_REVISIT_BYTES = 0
DATE = "1970-01-01T00:00:00Z"  # the tables have no time of capture
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BLOCK = 1 << 20
LEVEL = 6
SALTS = 16

INDEX = "file string, page_id string, record_type string, offset long, length long"


def store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's address and the path on it."""
    scheme, colon, rest = uri.partition(":")
    if colon:
        # Hadoop's names of the same store, and its addresses without a host
        scheme = "s3" if scheme in ("s3a", "s3n") else scheme
        uri = f"{scheme}:{rest if rest.startswith('//') else f'//{rest}'}"
    return fs.FileSystem.from_uri(uri)


def base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record_id(page_id: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(page_id: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC record; ``digest`` is the payload's SHA-1 in base32."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": record_id(page_id, digest),
        "WARC-Date": DATE,
        "WARC-Target-URI": None if url is None else "".join(url.split()),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "X-Page-ID": page_id,
    }
    if refers_to is not None:
        fields |= {
            "WARC-Profile": PROFILE,
            "WARC-Refers-To": record_id(refers_to, digest),
            "X-Refers-To-Page-ID": refers_to,
        }
    fields |= {"Content-Type": "application/http; msgtype=response", "Content-Length": len(block)}
    lines = [f"{name}: {value}\r\n" for name, value in fields.items() if value is not None]
    return b"WARC/1.1\r\n" + "".join(lines).encode() + b"\r\n" + block + b"\r\n\r\n"


def read_head(stream: BinaryIO) -> tuple[bytes, dict[str, str]] | None:
    """The header of the next record, raw and by field; None at the end."""
    first = stream.readline()
    while first in (b"\r\n", b"\n"):
        first = stream.readline()
    if not first:
        return None
    if not first.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    lines, fields = [first], {}
    while (line := stream.readline()) not in (b"\r\n", b"\n"):
        if not line:
            raise EOFError("the archive ends in a record's header")
        lines.append(line)
        name, _, value = line.decode().partition(":")
        fields[name.lower()] = value.strip()
    return b"".join(lines) + b"\r\n", fields


def with_originals(pages: DataFrame, key: str, text: str, min_bytes: int) -> DataFrame:
    """``key`` (as text), ``url``, ``payload``, ``digest`` and, for revisits, ``refers_to``.

    Equal payloads meet as digests and counts, never as payloads. The groups of several rows
    are a written table; a group's rows are dealt to ``SALTS`` tasks unless it is broadcast.
    """
    url = F.col("url") if "url" in pages.columns else F.lit(None)
    rows = pages.select(
        F.col(key).alias("key"),
        url.cast("string").alias("url"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    groups = (
        rows.where(F.octet_length("payload") >= min_bytes)
        .groupBy("digest")
        .agg(F.max("key").alias("original"), F.count("*").alias("n"))
        .where("n > 1 AND original IS NOT NULL")
        .select("digest", "original")
    )
    salted = written(groups).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("key", "url"), F.lit(SALTS)).cast("int"))
    own = F.col("key").eqNullSafe(F.col("original"))
    return dealt.join(salted, ["digest", "salt"], "left").select(
        F.col("key").cast("string").alias("key"),
        "url",
        "payload",
        "digest",
        F.when(~own, F.col("original").cast("string")).alias("refers_to"),
    )


def write_monolithic(records: DataFrame, folder: str) -> DataFrame:
    """``file`` of each archive: one gzip stream per partition, many records long."""

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, path = store(folder)
        name = f"{path}/{uuid.uuid4().hex}.warc.gz"
        out = None
        for frame in frames:
            frame = frame.astype(object).where(frame.notna(), None)
            for key, url, payload, digest, refers_to in frame.itertuples(index=False):
                if out is None:
                    raw = system.open_output_stream(name, compression=None)
                    out = gzip.GzipFile(fileobj=raw, mode="wb", compresslevel=LEVEL, mtime=0)
                out.write(record(key, url, bytes(payload), base32(digest), refers_to))
        if out is not None:
            out.close()
            raw.close()
            yield pd.DataFrame({"file": [name]})

    columns = records.select("key", "url", "payload", "digest", "refers_to")
    return columns.mapInPandas(write, "file string")


def normalise_file(system: fs.FileSystem, source: str, target: str) -> int:
    """Rewrites one archive record by record; gives the number of records.

    Only a block of ``BLOCK`` bytes is in memory at a time, whatever a record's size.
    """
    count = 0
    with (
        system.open_input_stream(source, compression=None, buffer_size=BLOCK) as raw,
        gzip.GzipFile(fileobj=raw) as stream,
        system.open_output_stream(target, compression=None, buffer_size=BLOCK) as out,
        system.open_output_stream(f"{target}.jsonl", compression=None) as index,
    ):
        offset = 0
        while (head := read_head(stream)) is not None:
            raw_head, fields = head
            member = zlib.compressobj(LEVEL, wbits=31)
            length = out.write(member.compress(raw_head))
            left = int(fields["content-length"])
            while left:
                block = stream.read(min(left, BLOCK))
                if not block:
                    raise EOFError(f"{source} ends in a record")
                left -= len(block)
                length += out.write(member.compress(block))
            length += out.write(member.compress(b"\r\n\r\n") + member.flush())
            entry = {
                "file": target,
                "page_id": fields.get("x-page-id"),
                "record_type": fields["warc-type"],
                "offset": offset,
                "length": length,
            }
            index.write(json.dumps(entry).encode() + b"\n")
            offset += length
            count += 1
    return count


def normalise(files: DataFrame, folder: str) -> DataFrame:
    """``file, index_file, records`` of each normalised archive; one task per file at most."""

    def rewrite(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, path = store(folder)
        for frame in frames:
            for source in frame["file"]:
                target = f"{path}/{uuid.uuid4().hex}.warc.gz"
                count = normalise_file(system, source, target)
                yield pd.DataFrame(
                    {"file": [target], "index_file": [f"{target}.jsonl"], "records": [count]}
                )

    return files.select("file").mapInPandas(
        rewrite, "file string, index_file string, records long"
    )


def read_index(spark: SparkSession, archives: DataFrame, folder: str) -> DataFrame:
    """Index entries of the archives that finished tasks reported, from all sidecar files."""
    entries = spark.read.schema(INDEX).option("pathGlobFilter", "*.jsonl").json(folder)
    return entries.join(archives.select("file"), "file", "left_semi")


def read_record(raw: bytes) -> tuple:
    """Page id, payload size, payload digest, type and original of one member."""
    plain = zlib.decompress(raw, wbits=31)
    at = plain.index(b"\r\n\r\n") + 4
    fields = {}
    for line in plain[:at].decode().split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.lower()] = value.strip()
    block = plain[at : at + int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    named = fields["warc-payload-digest"].removeprefix("sha1:")
    size = len(payload)
    if fields["warc-type"] == "response":
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != named:
            raise ValueError(f"record {fields['warc-record-id']} does not have its digest")
    else:
        lines = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])
        size = int(lines["Content-Length"])
    return (
        fields.get("x-page-id"),
        size,
        named,
        fields["warc-type"],
        fields.get("x-refers-to-page-id"),
    )


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Reads the indexed records; each task seeks to its own."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, _ = store(folder)
        for frame in frames:
            for name, entries in frame.groupby("file"):
                with system.open_input_file(name) as file:
                    found = []
                    for at, length in zip(entries["offset"], entries["length"], strict=True):
                        file.seek(at)
                        found.append(read_record(file.read(length)))
                columns = zip(*found, strict=True)
                names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
                yield pd.DataFrame(dict(zip(names, columns, strict=True)))

    return index.select("file", "offset", "length").mapInPandas(
        read,
        "page_id string, payload_bytes long, payload_digest string, record_type string, "
        "refers_to string",
    )


def archive(
    pages: DataFrame,
    key: str = "page_id",
    text: str = "html",
    min_bytes: int = MIN_REVISIT_BYTES,
    folder: str | None = None,
) -> tuple[DataFrame, str]:
    """Writes and normalises archives of ``pages``: the normalised files, and their folder."""
    folder = folder or shared_folder(pages.sparkSession)
    files = written(write_monolithic(with_originals(pages, key, text, min_bytes), folder))
    target = shared_folder(pages.sparkSession)
    return written(normalise(files.repartition("file"), target)), target


def read_archives(spark: SparkSession, archives: DataFrame, folder: str, kind: str) -> DataFrame:
    """All records of normalised archives, ids cast to ``kind``."""
    found = read_records(read_index(spark, archives, folder), folder)
    return found.select(
        F.col("page_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
