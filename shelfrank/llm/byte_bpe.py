"""Byte-level BPE over whole texts, long ones in overlapping chunks.

A text of more than ``CHUNK`` code points is cut into chunks that overlap by ``OVERLAP``.
Chunks are pre-tokenised in parallel; a chunk starts at an arbitrary place, so its first
boundaries may be wrong, but the pattern looks at nothing before a match: from the first
boundary two neighbours share, they agree for good. There they are stitched. Where two
chunks share no boundary (one endless word), the text is pre-tokenised on in one go from the
last boundary that is certain until it meets a later chunk. The pieces between stitches are
encoded in parallel and their ids concatenated. Decoding concatenates the tokens' bytes.

A null text counts as empty and gives no ids. Equal long texts are encoded once and their
ids joined back to every row, so repeated rows stay. Token ids are little-endian unsigned
32-bit integers in a binary column.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.shared import written

VOCABULARY = "byte_bpe_50k.tiktoken"
CHUNK = 32768
OVERLAP = 512
# the pattern's lookahead and its contractions never see further than this
LOOKAHEAD = 4
BATCH_CHARS = 1 << 21  # texts of so many code points go back to Spark at a time


@functools.cache
def pattern() -> regex.Pattern:
    return regex.compile(public_tokenizers.PATTERN)


@functools.cache
def ranks(name: str) -> dict[bytes, int]:
    with open(public_tokenizers.path(name), "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@functools.cache
def encoding(name: str) -> tiktoken.Encoding:
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(name), special_tokens={}
    )


@functools.cache
def token_bytes(name: str) -> list[bytes]:
    return sorted(ranks(name), key=ranks(name).get)


def ids_of(text: str, name: str) -> bytes:
    return encoding(name).encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()


def bytes_of(ids: bytes, name: str) -> bytes:
    return b"".join(map(token_bytes(name).__getitem__, np.frombuffer(ids, "<u4").tolist()))


def boundaries(text: str, start: int, stop: int) -> list[int]:
    """Where pre-tokens of ``text[start:stop]`` begin, if later text can't change it.

    White space is matched by what follows it, so a text is only cut behind other characters.
    """
    sure = stop if stop >= len(text) else stop - LOOKAHEAD
    found = (m.start() for m in pattern().finditer(text, start, stop))
    return [at for at in found if start < at <= sure and not text[at - 1].isspace()]


def chunk_bounds(piece: str, last: bool, chunk: int, overlap: int) -> tuple[list[int], list[int]]:
    """Boundaries in the parts of a chunk shared with the one before and the one after."""
    at = boundaries(piece, 0, len(piece))
    if not last:
        at = [b for b in at if b <= len(piece) - LOOKAHEAD]
    return [b for b in at if b < overlap], [b for b in at if b >= chunk]


def stitch(
    text: str, heads: list[list[int]], tails: list[list[int]], chunk: int, overlap: int
) -> list[int]:
    """Starts of pieces of ``text``; every one is a true pre-token boundary.

    ``heads`` and ``tails`` are the boundaries at the start and the end of each chunk,
    counted from the chunk's start. No part of the text is gone through more than twice.
    """
    starts, sure, part = [0], set(tails[0]), 1
    while part < len(heads):
        here = part * chunk
        met = next((b + here for b in heads[part] if b + here in sure), None)
        if met is None:
            met = resumed(text, starts[-1], heads, part, chunk)
            if met is None:  # the rest shares no boundary with any chunk
                break
            part = met // chunk
        starts.append(met)
        sure = {b + part * chunk for b in tails[part]}
        part += 1
    return starts


def resumed(text: str, start: int, heads: list[list[int]], part: int, chunk: int) -> int | None:
    """The first boundary behind the certain one ``start`` that chunk ``part`` or a later one has.

    The text is pre-tokenised on until then, in one go: an endless word is one match.
    """
    known: dict[int, set[int]] = {}
    for match in pattern().finditer(text, start):
        at = match.start()
        number, inside = divmod(at, chunk)
        if number < part or at <= start or text[at - 1].isspace():
            continue
        if number not in known:
            known = {number: set(heads[number]) if number < len(heads) else set()}
        if inside in known[number]:
            return at
    return None


def encode(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    name: str = VOCABULARY,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    decoded: bool = False,
) -> DataFrame:
    """``key``, ``n_tokens`` and the token ids of every row of ``df``.

    With ``decoded`` also the bytes the ids decode to, made in the same pass, some rows at a
    time: a column of ids is larger than the texts and need not go to Python again.
    """
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = dict(rows.dtypes)["key"]
    carried = F.col("key").cast("string").alias("key")  # pandas has no nullable long

    def whole(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in bounded(frame, "text"):
                ids = [ids_of(t, name) for t in part["text"]]
                columns = {"key": part["key"], "ids": ids}
                if decoded:
                    columns["decoded"] = [bytes_of(x, name) for x in ids]
                yield pd.DataFrame(columns)

    length = F.char_length("text")
    short = rows.where(length <= chunk).select(carried, "text")
    more = ", decoded binary" if decoded else ""
    encoded = short.mapInPandas(whole, f"key string, ids binary{more}")
    long = rows.where(length > chunk).select(
        carried, F.sha2(F.col("text").cast("binary"), 256).alias("digest"), "text"
    )
    pieces = long_ids(long.select("digest", "text"), name, chunk, overlap)
    if decoded:
        pieces = decode(pieces, "ids", name)
    of_long = long.select("key", "digest").join(pieces, "digest").drop("digest")
    return encoded.unionByName(of_long).select(
        F.col("key").cast(kind).alias(key),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        *(["decoded"] if decoded else []),
    )


def long_ids(texts: DataFrame, name: str, chunk: int, overlap: int) -> DataFrame:
    """Ids by ``digest`` for long texts, each different one encoded once, in pieces."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for digest, text in zip(frame["digest"], frame["text"], strict=True):
                count = -(-len(text) // chunk)
                for part in range(count):
                    piece = text[part * chunk : (part + 1) * chunk + overlap]
                    yield pd.DataFrame(
                        {
                            "digest": [digest],
                            "part": [part],
                            "last": [part + 1 == count],
                            "piece": [piece],
                        }
                    )

    def pretokenise(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [
                chunk_bounds(piece, last, chunk, overlap)
                for piece, last in zip(frame["piece"], frame["last"], strict=True)
            ]
            yield pd.DataFrame(
                {
                    "digest": frame["digest"],
                    "part": frame["part"],
                    "head": [x[0] for x in found],
                    "tail": [x[1] for x in found],
                }
            )

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for digest, text, bounds in zip(
                frame["digest"], frame["text"], frame["bounds"], strict=True
            ):
                heads = [list(b["head"]) for b in bounds]
                tails = [list(b["tail"]) for b in bounds]
                starts = stitch(text, heads, tails, chunk, overlap)
                for part, (a, b) in enumerate(zip(starts, [*starts[1:], len(text)], strict=True)):
                    yield pd.DataFrame({"digest": [digest], "part": [part], "piece": [text[a:b]]})

    def encode_pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for some in bounded(frame, "piece"):
                yield pd.DataFrame(
                    {
                        "digest": some["digest"],
                        "part": some["part"],
                        "ids": [ids_of(t, name) for t in some["piece"]],
                    }
                )

    @F.pandas_udf("binary")
    def concatenated(parts: pd.Series) -> pd.Series:
        return pd.Series([b"".join(p["ids"] for p in row) for row in parts])

    once = written(texts.dropDuplicates(["digest"]))
    chunks = once.mapInPandas(cut, "digest string, part int, last boolean, piece string")
    bounds = (
        chunks.repartition("digest", "part")
        .mapInPandas(pretokenise, "digest string, part int, head array<int>, tail array<int>")
        .groupBy("digest")
        .agg(F.array_sort(F.collect_list(F.struct("part", "head", "tail"))).alias("bounds"))
    )
    pieces = once.join(bounds, "digest").mapInPandas(
        split, "digest string, part int, piece string"
    )
    return (
        pieces.repartition("digest", "part")
        .mapInPandas(encode_pieces, "digest string, part int, ids binary")
        .groupBy("digest")
        .agg(F.array_sort(F.collect_list(F.struct("part", "ids"))).alias("parts"))
        .select("digest", concatenated("parts").alias("ids"))
    )


def bounded(frame: pd.DataFrame, text: str) -> Iterator[pd.DataFrame]:
    """Runs of rows of about ``BATCH_CHARS`` code points, so that results stay small."""
    before = (frame[text].str.len().cumsum() // BATCH_CHARS).to_numpy()
    edges = [0, *(np.flatnonzero(np.diff(before)) + 1), len(frame)]
    for a, b in zip(edges, edges[1:], strict=False):
        if a < b:
            yield frame.iloc[a:b]


def decode(df: DataFrame, ids: str = "ids", name: str = VOCABULARY) -> DataFrame:
    """``df`` with ``decoded``: the raw bytes of its tokens, joined."""

    @F.pandas_udf("binary")
    def joined_bytes(column: pd.Series) -> pd.Series:
        return column.map(lambda x: bytes_of(x, name))

    return df.withColumn("decoded", joined_bytes(ids))
