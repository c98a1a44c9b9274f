"""Documents packed into sequences of tokens by best-two-fit.

1. One pass tokenises whole texts, ends each document with the id 0 and cuts longer ones into
   pieces, the first of which takes what is left over. Tasks number their pieces by length as
   they write them, so a piece's place among all of its length follows from counts per task.
2. How many pieces there are of each length, at most one number per length, is all the
   packing needs: pieces of one length are alike. A bin is filled greedily with the longest
   lengths that fit. Then, while that leaves a smaller gap, its smallest document gives way to
   the two unpacked ones that fit the gap and its place most tightly. The bin is made as often
   as the counts allow, which uses up a length, so there are few kinds of bins whatever the
   number of documents (``most_slots`` is a bound).
3. Each kind of bin takes a run of places of each of its lengths. A piece finds its sequence and
   its offset there by its length and place.

Token ids are those of the ``tokenizers`` library for the same vocabulary; the strings of special
tokens in a text are ordinary text. The ranks are read by ``tiktoken``, which is five times as
fast and gives equal ids.

Nulls: a null text is empty, its document only the last id; a null id is an id. Repeated rows are
packed each. An empty table has no sequences. A text is encoded in one task, however long.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.llm.byte_bpe import VOCABULARY, bounded, ids_of
from shelfrank.llm.shared import written

SEQUENCE = 2048
END = 0


def cut(tokens: int, size: int) -> list[int]:
    """Lengths of a document's pieces: full ones behind a first one with the rest."""
    first = (tokens - 1) % size + 1
    return [first] + [size] * ((tokens - first) // size)


def pieces(documents: DataFrame, key: str, text: str, size: int, name: str) -> DataFrame:
    """``key, piece, start, length, ids_crc32``, and by length the ``place`` in task ``part``."""
    kind = dict(documents.dtypes)[key]

    def made(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)
        for frame in frames:
            for some in bounded(frame, "text"):
                rows = []
                for doc, one in zip(some["key"], some["text"], strict=True):
                    ids = ids_of(one, name) + END.to_bytes(4, "little")
                    start = 0
                    for piece, length in enumerate(cut(len(ids) // 4, size)):
                        own = ids[4 * start : 4 * (start + length)]
                        rows.append((doc, piece, start, length, zlib.crc32(own), part, seen[length]))
                        seen[length] += 1
                        start += length
                yield pd.DataFrame(
                    rows, columns=["key", "piece", "start", "length", "ids_crc32", "part", "place"]
                )

    # a nullable integer key would reach pandas as float: carry it as text
    rows = documents.select(
        F.col(key).cast("string").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    schema = "key string, piece int, start long, length int, ids_crc32 long, part int, place long"
    return rows.mapInPandas(made, schema).withColumn("key", F.col("key").cast(kind))


class Lengths:
    """Unpacked pieces by length."""

    def __init__(self, counts: dict[int, int], size: int) -> None:
        self.size = size
        self.left = np.zeros(size + 1, np.int64)
        for length, count in counts.items():
            self.left[length] = count

    def longest(self, left: np.ndarray) -> np.ndarray:
        """For every room the longest length that fits it, 0 if none."""
        return np.maximum.accumulate(np.where(left > 0, np.arange(self.size + 1), 0))

    def filled(self) -> tuple[dict[int, int], int]:
        """A bin, longest pieces that fit first, as counts by length; and its gap."""
        fits = self.longest(self.left)
        gap, inside = self.size, {}
        room = gap
        while length := int(fits[room]):
            inside[length] = min(int(self.left[length]), gap // length)
            gap -= length * inside[length]
            room = min(gap, length - 1)
        return inside, gap

    def tightened(self, inside: dict[int, int], gap: int) -> tuple[dict[int, int], int]:
        """The bin with two unpacked pieces for its smallest, while that leaves a smaller gap."""
        inside = dict(inside)
        while gap:
            smallest = min(inside)
            room = gap + smallest
            left = self.left.copy()
            for length, times in inside.items():
                left[length] -= times
            fits = self.longest(left)
            one = np.flatnonzero(left[:room] > 0)
            two = fits[room - one]
            alone = (two == one) & (left[one] < 2)
            two[alone] = fits[one[alone] - 1]
            both = np.where(two > 0, one + two, 0)
            if not len(both) or both.max() <= smallest:
                break
            best = int(both.argmax())
            gap = room - int(both[best])
            inside[smallest] -= 1
            for length in (int(one[best]), int(two[best])):
                inside[length] = inside.get(length, 0) + 1
            inside = {length: times for length, times in inside.items() if times}
        return inside, gap

    def take(self, inside: dict[int, int]) -> int:
        """Make the bin as often as the counts allow."""
        times = min(int(self.left[length]) // count for length, count in inside.items())
        for length, count in inside.items():
            self.left[length] -= times * count
        return times


def most_slots(size: int) -> int:
    """How many rows ``best_two_fit`` can return at most, whatever the counts.

    Making a bin leaves one of its lengths with fewer pieces than the bin has, which is at most
    ``size / length`` and then less than half as many each time. Distinct lengths in a bin add
    up to ``size``.
    """
    bins = sum(2 + int(np.log2(size // length)) for length in range(1, size + 1))
    return bins * int((2 * size) ** 0.5 + 1)


def best_two_fit(counts: dict[int, int], size: int) -> list[tuple[int, int, int, int, int, int]]:
    """``length, first, count, times, sequence, offset``: what becomes of the pieces by length.

    Pieces ``first .. first + times * count`` of that length go to ``times`` sequences from
    ``sequence`` on, ``count`` to each, side by side from ``offset`` on.
    """
    lengths, used, sequence, slots = Lengths(counts, size), dict.fromkeys(counts, 0), 0, []
    while lengths.left.any():
        inside, _ = lengths.tightened(*lengths.filled())
        times, offset = lengths.take(inside), 0
        for length, count in sorted(inside.items(), reverse=True):
            slots.append((length, used[length], count, times, sequence, offset))
            used[length] += times * count
            offset += length * count
        sequence += times
    return slots


def pack(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = SEQUENCE,
    name: str = VOCABULARY,
) -> DataFrame:
    """One row per piece: ``key, piece, start, length, ids_crc32, sequence_id, offset``."""
    cut_up = written(pieces(documents, key, text, size, name))
    by_task = written(cut_up.groupBy("length", "part").agg(F.count("*").alias("here")))
    counts = {
        row["length"]: row["n"]
        for row in by_task.groupBy("length").agg(F.sum("here").alias("n")).collect()
    }  # at most one row per length
    slots = np.array(sorted(best_two_fit(counts, size)) or np.empty((0, 6)), np.int64).reshape(-1, 6)
    # (length, first) as one ascending number: places are below the pieces of a length
    most = max(counts.values(), default=0) + 1
    starts = slots[:, 0] * most + slots[:, 1]

    def seated(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            length, place = frame["length"].to_numpy(np.int64), frame["place"].to_numpy(np.int64)
            slot = slots[np.searchsorted(starts, length * most + place, "right") - 1]
            nth = place - slot[:, 1]
            frame["sequence_id"] = slot[:, 4] + nth // slot[:, 2]
            frame["offset"] = slot[:, 5] + nth % slot[:, 2] * length
            yield frame.drop(columns=["place"])

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = by_task.select(
        "length", "part", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("shift")
    )
    kind = dict(cut_up.dtypes)["key"]
    placed = cut_up.join(shifts, ["length", "part"]).select(
        F.col("key").cast("string").alias("key"),
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        (F.col("place") + F.col("shift")).alias("place"),
    )
    schema = (
        "key string, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long"
    )
    return placed.mapInPandas(seated, schema).select(
        F.col("key").cast(kind).alias(key),
        "piece",
        "start",
        "length",
        "ids_crc32",
        "sequence_id",
        "offset",
    )
