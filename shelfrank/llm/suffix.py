"""Repeated byte strings across documents, by column-wise construction of a collection's BWT.

A byte is repeated if a string of ``LENGTH`` bytes that covers it also starts earlier: in a
document of smaller id, or earlier in the same document. All strings are judged on the input.

1. Anchors. Of the ``GRAM``-byte strings in every window of ``LENGTH`` bytes, the one with the
   least hash is the window's anchor (of equal hashes the last). Equal windows have equal
   anchors at equal places, so windows can only be equal around equal anchors. An anchor's
   piece is what its windows cover: at most ``2 * LENGTH - GRAM`` bytes.
2. Occurrences are dealt out by anchor and sorted by anchor and piece. Equal pieces (two 64-bit
   hashes) are settled there: all but the first are covered whole. Equal pieces of one batch
   are settled before they are dealt out: the later ones only pass through, spread evenly.
   Only the first of each piece goes on, and only where an anchor has different pieces. Pieces
   that agree with no other on half of a window's bytes before or behind the anchor repeat
   nowhere and are left out, by hashes that each occurrence brings along.
   An anchor of more than ``HOT`` different pieces is not gathered: its pieces are cut into
   single windows, which are dealt out and settled as pieces of their own.
3. These pieces are one collection per task, whose Burrows-Wheeler transform is built column
   by column: each round inserts one symbol of every piece, the next to the left, at the place
   that the symbols before it give. The transform is a file in the task's temporary folder,
   read from the start and written anew by every round, ``BLOCK`` entries at a time.
4. The finished transform gives the suffixes in order, and one more sequential pass whether
   each has ``LENGTH`` bytes in common with the one before; only that much of the common
   prefixes is asked for, so they are not carried through the rounds. Suffixes that share
   ``LENGTH`` bytes are equal windows; all but the first are covered.

Step 2 alone finds what whole equal pieces cover, most of the repeated bytes in tables with many
copies; the rounds of step 3 find what pieces share in part.

A document is told apart by id and content. Rows that repeat both are one document with equal
results; rows of one id with different texts are ordered by a hash of the text. A null id
comes after all others. A null text is empty, and a text of fewer bytes than ``LENGTH`` has
nothing repeated.
"""

from __future__ import annotations

import functools
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.shared import written
from shelfrank.llm.shingles import mixed
from shelfrank.session import release

LENGTH = 100
GRAM = 32
SLICE = 1 << 20  # bytes of a text in which anchors are sought at a time
BLOCK = 1 << 20  # entries of a collection's files handled at a time
RUN = 256  # entries whose symbol counts are summed up together
PIECES_PER_TASK = 10_000
HOT = 10_000  # different pieces of an anchor that are gathered
BATCH = 200_000  # occurrences that a task hands on at a time
BROADCAST_BYTES = 1 << 20  # piece lists of so many bytes may be broadcast, else joined
LIST_BYTES, PIECE_BYTES = 64, 48  # of a document's list, and each piece in it, as Spark's rows
LAST_ID = (1 << 63) - 1

_RANDOM = np.random.default_rng(1009)
_BYTE, _OTHER_BYTE = _RANDOM.integers(1, 1 << 63, (2, 256), np.uint64)
_FACTOR = 0x9E3779B97F4A7C15


@functools.cache
def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """The factor's powers and their inverses modulo 2**64."""
    out = []
    for factor in (_FACTOR, pow(_FACTOR, -1, 1 << 64)):
        each = np.full(count, factor, np.uint64)
        each[0] = 1
        out.append(np.multiply.accumulate(each))
    return out[0], out[1]


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Least or greatest value of every run of ``width`` values."""
    reach = 1
    while reach * 2 <= width:
        values = pick(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(raw: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """``hash, piece, at, start, end``: anchors of a text and their pieces."""
    return anchors_and_halves(raw, length, gram)[:5]


def anchors_and_halves(raw: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """``anchors``, and as one number two 32-bit hashes of each: of the anchor with half of a
    window's other bytes before it, and behind it.

    A hash is 0 where the text does not have so many bytes. Windows around equal anchors are
    only equal if one of the halves is, whatever the window's place.
    """
    width = length - gram + 1
    half = width // 2
    power, inverse = powers(SLICE + 3 * length + 1)
    found = []
    for first in range(0, max(len(raw) - length + 1, 0), SLICE):
        left = max(0, first - length)
        part = raw[left : first + SLICE + 2 * length]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * power[: len(part)], out=sums[1:])
        grams = mixed((sums[gram:] - sums[:-gram]) * inverse[: len(part) - gram + 1])
        # windows that start in this slice
        stop = min(first + SLICE, len(raw) - length + 1)
        own = grams[first - left : stop - left + width - 1]
        # the least hash of each window, of equal ones the last
        places = np.arange(len(own), dtype=np.uint64)
        ranked = (own & ~np.uint64(0xFFFFFFFF)) | (np.uint64(0xFFFFFFFF) - places)
        least = np.uint64(0xFFFFFFFF) - (sliding(ranked, width, np.minimum) & np.uint64(0xFFFFFFFF))
        at = least.astype(np.int64)
        start = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        end = np.append(start[1:], len(at)) - 1 + length
        at, start, end = (x + (first - left) for x in (at[start], start, end))
        piece = (sums[end] - sums[start]) * inverse[start]
        piece = mixed(piece + ((at - start) * 4 * length + (end - at)).astype(np.uint64) * np.uint64(_FACTOR))
        sides = []
        for begin, last in ((at - half, at + gram), (at, at + gram + half)):
            there = (begin >= 0) & (last <= len(part))
            begin, last = np.where(there, begin, 0), np.where(there, last, 0)
            value = mixed((sums[last] - sums[begin]) * inverse[begin])
            sides.append(np.where(there, (value >> np.uint64(32)) | np.uint64(1), np.uint64(0)))
        halves = (sides[0] << np.uint64(32)) | sides[1]
        columns = (grams[at], piece, at + left, start + left, end + left, halves)
        found.append(np.stack([x.astype(np.int64) for x in columns]))
    return tuple(np.concatenate(found, axis=1) if found else np.empty((6, 0), np.int64))


def utf8(text: str | None) -> bytes:
    return (text if isinstance(text, str) else "").encode("utf-8", "surrogatepass")


def identity(key: str, text: str) -> list[Column]:
    """Columns ``id`` (order of documents) and ``digest``, and the text without nulls."""
    plain = F.coalesce(F.col(text), F.lit(""))
    return [
        F.coalesce(F.col(key).cast("long"), F.lit(LAST_ID)).alias("id"),
        F.xxhash64(plain).alias("digest"),
        plain.alias("text"),
    ]


def told_apart(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``id, digest, text, …`` and every document of them once (``id, digest, text``).

    Only ids and digests are counted over all rows; just the texts of repeated rows are
    grouped, each task's copies before they are dealt out. Where no id has two texts the digest
    becomes 0: it tells nothing apart, and zeros need little room in what is dealt out.
    """
    names = ["id", "digest"]
    counted = written(rows.groupBy(*names).agg(F.count("*").alias("rows")))
    of_id = counted.groupBy("id").agg(F.count("*").alias("texts"), F.max("rows").alias("rows"))
    most = of_id.agg(F.max("texts").alias("texts"), F.max("rows").alias("rows")).first()
    if (most["texts"] or 0) <= 1:
        rows = rows.withColumn("digest", F.lit(0).cast("long"))
        counted = counted.withColumn("digest", F.lit(0).cast("long"))
    documents = rows.select(*names, "text")
    if (most["rows"] or 0) <= 1:
        return rows, documents
    repeated = written(counted.where("rows > 1").select(*names))
    single = documents.join(repeated, names, "left_anti")
    several = documents.join(repeated, names, "left_semi").groupBy(*names).agg(F.min("text").alias("text"))
    return rows, written(single.unionByName(several))


def packed(at: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """An anchor's place and, relative to it, its piece's as one number that rises with the place."""
    return (at << 20) | ((at - start) << 10) | (end - at)


def unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at = place >> 20
    return at, at - ((place >> 10) & 1023), at + (place & 1023)


OCCURRENCE = ["anchor", "piece", "id", "digest", "place", "halves"]
OCCURRENCE_SCHEMA = ", ".join(f"{x} long" for x in OCCURRENCE) + ", later boolean"


def handed_on(rows: list[tuple]) -> pd.DataFrame:
    """Occurrences of some documents; ``later`` marks those that repeat a piece among them."""
    columns = [np.concatenate(c) for c in zip(*rows, strict=True)]
    anchor, piece, key, digest, place, _ = columns
    order = np.lexsort((place, digest, key, piece, anchor))
    same = (anchor[order][1:] == anchor[order][:-1]) & (piece[order][1:] == piece[order][:-1])
    later = np.zeros(len(anchor), bool)
    later[order[1:][same]] = True
    return pd.DataFrame(dict(zip(OCCURRENCE, columns, strict=True))).assign(later=later)


def occurrences(documents: DataFrame, length: int, gram: int) -> DataFrame:
    """``OCCURRENCE`` and ``later`` of every anchor of every document."""

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, size = [], 0
        for frame in frames:
            for key, digest, text in zip(frame["id"], frame["digest"], frame["text"], strict=True):
                raw = np.frombuffer(utf8(text), np.uint8)
                hashes, pieces, at, starts, ends, halves = anchors_and_halves(raw, length, gram)
                many = len(hashes)
                place = packed(at, starts, ends)
                rows.append((hashes, pieces, np.full(many, key), np.full(many, digest), place, halves))
                size += many
                if size > BATCH:
                    yield handed_on(rows)
                    rows, size = [], 0
        if rows:
            yield handed_on(rows)

    return documents.mapInPandas(find, OCCURRENCE_SCHEMA)


SETTLED = "anchor long, id long, digest long, start int, end int, kind int"
# what becomes of an occurrence: covered whole; a piece of a collection; one of a hot anchor
COVERED, PIECE_KIND, HOT_KIND = 0, 1, 2


def settled(found: DataFrame, length: int, gram: int) -> DataFrame:
    """What becomes of occurrences that matter (``SETTLED``): see the module's second step."""
    half = (length - gram + 1) // 2

    def out(rows: pd.DataFrame, kind: int) -> pd.DataFrame:
        _, start, end = unpacked(rows["place"].to_numpy())
        return pd.DataFrame(
            {"anchor": rows["anchor"], "id": rows["id"], "digest": rows["digest"], "start": start, "end": end, "kind": kind}
        )

    def close(firsts: pd.DataFrame) -> pd.DataFrame:
        """First pieces of whole anchors that share a half with another, as far as it reaches."""
        if not len(firsts):
            return out(firsts, PIECE_KIND)
        at, start, end = unpacked(firsts["place"].to_numpy())
        anchor, halves = firsts["anchor"].to_numpy(), firsts["halves"].to_numpy().astype(np.uint64)
        begins, stops = np.full(len(at), np.iinfo(np.int64).max), np.full(len(at), -1)
        edges = (
            (halves >> np.uint64(32), start, np.minimum(end, at + gram + half)),
            (halves & np.uint64(0xFFFFFFFF), np.maximum(at - half, start), end),
        )
        for side, first, last in edges:
            order = np.lexsort((side, anchor))
            a, h = anchor[order], side[order]
            same = (a[1:] == a[:-1]) & (h[1:] == h[:-1]) & (h[1:] != 0)
            shared = np.zeros(len(at), bool)
            shared[order] = np.append(same, False) | np.append(False, same)
            begins[shared] = np.minimum(begins[shared], first[shared])
            stops[shared] = np.maximum(stops[shared], last[shared])
        kept = stops - begins >= length
        found = out(firsts[kept], PIECE_KIND)
        return found.assign(start=begins[kept], end=stops[kept])

    def settle(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Sorted occurrences in. Only the first pieces of one anchor are remembered."""
        before: tuple[int, int] | None = None
        waiting: list[pd.DataFrame] = []  # first pieces of the last anchor
        hot = False  # whether it has more than can wait
        for frame in frames:
            later = frame["later"].to_numpy()
            if later.any():
                yield out(frame[later], COVERED)
                frame = frame[~later]
            if not len(frame):
                continue
            anchor, piece = frame["anchor"].to_numpy(), frame["piece"].to_numpy()
            new = np.append(True, (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1]))
            if before is not None:
                new[0] = (int(anchor[0]), int(piece[0])) != before
            if not new.all():
                yield out(frame[~new], COVERED)
            if before is not None and before[0] != anchor[0]:
                if not hot:
                    yield close(pd.concat(waiting))
                waiting, hot = [], False
            before = (int(anchor[-1]), int(piece[-1]))
            firsts = frame[new]
            last = firsts["anchor"].to_numpy() == anchor[-1]
            if anchor[0] != anchor[-1]:
                whole = firsts[~last]
                if hot:
                    own = whole["anchor"].to_numpy() == anchor[0]
                    yield out(whole[own], HOT_KIND)
                    whole = whole[~own]
                yield close(pd.concat([*waiting, whole]))
                waiting, hot = [], False
            waiting.append(firsts[last])
            if hot or sum(map(len, waiting)) > HOT:
                yield out(pd.concat(waiting), HOT_KIND)
                waiting, hot = [], True
        if waiting and not hot:
            yield close(pd.concat(waiting))

    spread = F.when(F.col("later"), F.xxhash64("id", "place")).otherwise(F.col("anchor"))
    return (
        found.repartition(spread)
        .sortWithinPartitions("later", "anchor", "piece", "id", "digest", "place")
        .mapInPandas(settle, SETTLED)
    )


class Sequence:
    """One sequential file of a collection, rewritten by every round."""

    def __init__(self, folder: Path, name: str, dtype: type) -> None:
        self.path, self.spare = folder / name, folder / f"{name}.new"
        self.dtype = np.dtype(dtype)
        self.path.touch()
        self.spare.touch()

    def blocks(self) -> Iterator[np.ndarray]:
        with self.path.open("rb") as file:
            while len(block := np.fromfile(file, self.dtype, BLOCK)):
                yield block

    def insert(self, places: np.ndarray, values: np.ndarray) -> None:
        """Puts ``values`` at ``places`` (sorted, of the new file) among the old entries."""
        done = 0
        # a file only grows, so its spare is overwritten in place
        with self.path.open("rb") as old, self.spare.open("r+b") as new:
            total = self.path.stat().st_size // self.dtype.itemsize + len(places)
            for start in range(0, total, BLOCK):
                stop = min(start + BLOCK, total)
                upto = int(np.searchsorted(places, stop))
                here = places[done:upto] - start
                block = np.empty(stop - start, self.dtype)
                gaps = np.ones(stop - start, bool)
                gaps[here] = False
                block[here] = values[done:upto]
                block[gaps] = np.fromfile(old, self.dtype, stop - start - len(here))
                block.tofile(new)
                done = upto
        self.path, self.spare = self.spare, self.path

    def mapped(self, mode: str = "r") -> np.ndarray:
        return np.memmap(self.path, self.dtype, mode)


def next_places(block: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """For each entry the number of equal ones before it in the block, and all counts."""
    order = np.argsort(block, kind="stable")
    count = np.bincount(block, minlength=symbols)
    begins = (np.cumsum(count) - count).astype(np.int32)
    before = np.empty(len(block), np.int32)
    before[order] = np.arange(len(block), dtype=np.int32) - np.repeat(begins, count)
    return before, count


def equal_before(
    block: np.ndarray, here: np.ndarray, symbols: int
) -> tuple[np.ndarray, np.ndarray]:
    """For the entries at ``here`` the number of equal ones before them, and all counts.

    Counts are kept per run of ``RUN`` entries; only the runs asked for are looked into.
    """
    runs = -(-len(block) // RUN)
    padded = np.zeros(runs * RUN, block.dtype)
    padded[: len(block)] = block
    padded = padded.reshape(runs, RUN)
    slots = padded + (np.arange(runs, dtype=np.int32) * symbols)[:, None]
    table = np.bincount(slots.ravel(), minlength=runs * symbols).reshape(runs, symbols)
    upto = table.cumsum(0)
    count = upto[-1].copy()
    count[0] -= runs * RUN - len(block)
    upto -= table
    out = np.empty(len(here), np.int64)
    ahead = np.tri(RUN, k=-1, dtype=bool)  # row i: the places before i
    for some in range(0, len(here), BLOCK // RUN * 8):
        part = here[some : some + BLOCK // RUN * 8]
        run, inside = np.divmod(part, RUN)
        symbol = block[part]
        equal = padded[run] == symbol[:, None]
        equal &= ahead[inside]
        out[some : some + len(part)] = upto[run, symbol] + np.count_nonzero(equal, axis=1)
    return out, count


def ranks(transform: Sequence, places: np.ndarray, totals: np.ndarray, pieces: int) -> np.ndarray:
    """For sorted places: the place that the suffix one symbol longer has in the new order.

    In front are the empty suffixes, one a piece, then all others by their first symbol;
    ``totals`` counts the symbols of the transform, 0 where a piece has no more.
    """
    base = pieces + np.cumsum(totals) - totals - totals[0]
    out, done, start = np.empty(len(places), np.int64), 0, 0
    for block in transform.blocks():
        upto = int(np.searchsorted(places, start + len(block)))
        here = places[done:upto] - start
        before, count = equal_before(block, here, len(totals))
        out[done:upto] = base[block[here]] + before
        base += count
        done, start = upto, start + len(block)
    return out


def equal_windows(
    raw: np.ndarray, lengths: np.ndarray, length: int, folder: Path
) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of a collection that share ``length`` bytes with another.

    ``raw`` has the pieces one after the other, each with one more byte behind it. Gives, in
    suffix order, offsets in ``raw`` and the number of the group of equal windows.
    """
    ends = np.cumsum(lengths + 1) - 1
    used = np.zeros(256, bool)
    used[raw] = True
    code = np.cumsum(used).astype(np.uint16 if used.all() else np.uint8)
    transform = Sequence(folder, "transform", code.dtype)
    totals = np.zeros(int(used.sum()) + 1, np.int64)
    piece = places = np.arange(len(lengths))
    for column in range(int(lengths.max()) + 1):
        # suffixes of so many symbols; a piece with no more symbols has a 0 before them
        if column:
            places = ranks(transform, places, totals, len(lengths))
            order = np.argsort(places)
            places, piece = places[order], piece[order]
        more = lengths[piece] > column
        before = raw[np.maximum(ends[piece] - column - 1, 0)]
        symbol = np.where(more, code[before], 0).astype(code.dtype)
        transform.insert(places, symbol)
        totals += np.bincount(symbol, minlength=len(totals))
        piece, places = piece[more], places[more]
        if not len(piece):
            break
    order = suffixes(transform, totals, ends, folder)
    return grouped(order, shares(raw, ends, order, length, folder))


def suffixes(transform: Sequence, totals: np.ndarray, ends: np.ndarray, folder: Path) -> np.ndarray:
    """Where each suffix starts, in order: all pieces are followed through the transform at
    once, a symbol a step, from their ends to their starts."""
    step = Sequence(folder, "step", np.int64)
    base = len(ends) + np.cumsum(totals) - totals - totals[0]
    with step.path.open("wb") as out:
        for block in transform.blocks():
            before, count = next_places(block, len(totals))
            (base[block] + before).tofile(out)
            base += count
    symbols, forward = transform.mapped(), step.mapped()
    order = Sequence(folder, "order", np.int64)
    with order.path.open("wb") as out:
        out.truncate(8 * len(symbols))
    found = order.mapped("r+")
    place, at = np.arange(len(ends)), ends.copy()
    while len(place):
        found[place] = at
        more = symbols[place] > 0
        place, at = forward[place[more]], at[more] - 1
    return found


def shares(
    raw: np.ndarray, ends: np.ndarray, order: np.ndarray, length: int, folder: Path
) -> np.ndarray:
    """Whether each suffix has its first ``length`` bytes in common with the one before."""
    flags = Sequence(folder, "shares", np.uint8)
    windows = np.lib.stride_tricks.sliding_window_view(raw, length)
    with flags.path.open("wb") as out:
        for begin in range(0, len(order), BLOCK // 8):
            at = np.asarray(order[max(begin - 1, 0) : begin + BLOCK // 8])
            # both must have enough bytes left in their own piece
            whole = room(ends, at) >= length
            pairs = np.flatnonzero(whole[1:] & whole[:-1])
            equal = np.zeros(len(at), np.uint8)
            equal[pairs + 1] = (windows[at[pairs]] == windows[at[pairs + 1]]).all(1)
            equal[1 if begin else 0 :].tofile(out)
    return flags.mapped()


def room(ends: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Bytes from ``at`` to the end of its piece."""
    return ends[np.searchsorted(ends, at)] - at


def grouped(order: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that share with a neighbour, and the numbers of their groups."""
    starts, groups, number = [np.empty(0, np.int64)], [np.empty(0, np.int64)], 0
    for begin in range(0, len(order), BLOCK):
        flags = np.append(shares[begin : begin + BLOCK + 1], 0).astype(bool)
        count = min(BLOCK, len(order) - begin)
        follows, leads = flags[:count], flags[1 : count + 1]
        group = number + np.cumsum(~follows)
        member = follows | leads
        starts.append(order[begin : begin + count][member])
        groups.append(group[member])
        number = int(group[-1])
    return np.concatenate(starts), np.concatenate(groups)


def later_windows(
    starts: np.ndarray, groups: np.ndarray, documents: np.ndarray, places: np.ndarray
) -> np.ndarray:
    """Which windows are not the first of their group, by document and place in it.

    The same window may come from several pieces; it is first in all of them.
    """
    order = np.lexsort((places, documents, groups))
    g, d, p = groups[order], documents[order], places[order]
    lead = np.flatnonzero(np.append(True, g[1:] != g[:-1])) if len(g) else np.empty(0, int)
    of = np.repeat(lead, np.diff(np.append(lead, len(g))))
    out = np.zeros(len(starts), bool)
    out[order] = (d != d[of]) | (p != p[of])
    return out


def construct(length: int):
    """A function over a task's pieces that gives the windows covered in them, merged."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with tempfile.TemporaryDirectory() as name:
            folder = Path(name)
            rows, raw_path = [], folder / "pieces"
            with raw_path.open("wb") as out:
                for frame in frames:
                    for piece in frame["bytes"]:
                        out.write(piece)
                        out.write(b"\0")
                    rows.append(frame.drop(columns="bytes"))
            if not rows or not sum(map(len, rows)):
                return
            pieces = pd.concat(rows, ignore_index=True)
            raw = np.memmap(raw_path, np.uint8, "r")
            lengths = (pieces["end"] - pieces["start"]).to_numpy(np.int64)
            begins = np.cumsum(lengths + 1) - lengths - 1
            starts, groups = equal_windows(raw, lengths, length, folder)
            of = np.searchsorted(begins, starts, "right") - 1
            place = pieces["start"].to_numpy(np.int64)[of] + starts - begins[of]
            # documents in their order, as numbers
            pairs = pd.MultiIndex.from_frame(pieces[["id", "digest"]])
            number, named = pd.factorize(pairs, sort=True)
            later = later_windows(starts, groups, number[of], place)
            document, place = number[of][later], place[later]
            order = np.lexsort((place, document))
            document, place = document[order], place[order]
            if not len(place):
                return
            gap = np.append(True, (document[1:] != document[:-1]) | (place[1:] > place[:-1] + length))
            first = np.flatnonzero(gap)
            last = np.append(first[1:], len(place)) - 1
            of_run = named[document[first]]
            yield pd.DataFrame(
                {
                    "id": of_run.get_level_values(0),
                    "digest": of_run.get_level_values(1),
                    "start": place[first],
                    "end": place[last] + length,
                }
            )

    return run


def with_wanted(documents: DataFrame, wanted: DataFrame, *columns: str) -> DataFrame:
    """``id, digest, text, wanted`` (an array of ``columns``) of the documents in ``wanted``.

    ``wanted`` is written first; it is broadcast if all its lists are small, else joined.
    """
    lists = written(
        wanted.groupBy("id", "digest").agg(
            F.collect_set(F.struct(*columns)).alias("wanted")
        )
    )
    count, pieces = lists.agg(F.count("*"), F.coalesce(F.sum(F.size("wanted")), F.lit(0))).first()
    side = F.broadcast(lists) if count * LIST_BYTES + pieces * PIECE_BYTES <= BROADCAST_BYTES else lists
    return documents.join(side, ["id", "digest"]).select("id", "digest", "text", "wanted")


def first_pieces(documents: DataFrame, chosen: DataFrame) -> DataFrame:
    """``anchor, id, digest, start, end, bytes`` of the chosen pieces."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for key, digest, text, wanted in frame.itertuples(index=False):
                raw = utf8(text)
                for piece in wanted:
                    start, end = piece["start"], piece["end"]
                    rows.append((piece["anchor"], key, digest, start, end, raw[start:end]))
                if len(rows) >= 10_000:
                    yield pd.DataFrame(rows, columns=PIECE)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=PIECE)

    return with_wanted(documents, chosen, "anchor", "start", "end").mapInPandas(
        cut, "anchor long, id long, digest long, start int, end int, bytes binary"
    )


PIECE = ["anchor", "id", "digest", "start", "end", "bytes"]


def windows_of(documents: DataFrame, chosen: DataFrame, length: int) -> DataFrame:
    """The windows in the chosen pieces as occurrences: a window is its own anchor and piece."""
    power_count = 4 * length

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        power, inverse = powers(power_count)
        rows, size = [], 0
        for frame in frames:
            for key, digest, text, wanted in frame.itertuples(index=False):
                raw = np.frombuffer(utf8(text), np.uint8)
                for piece in wanted:
                    part = raw[piece["start"] : piece["end"]]
                    many = len(part) - length + 1
                    hashes = []
                    for table in (_BYTE, _OTHER_BYTE):
                        sums = np.zeros(len(part) + 1, np.uint64)
                        np.cumsum(table[part] * power[: len(part)], out=sums[1:])
                        value = (sums[length:] - sums[:-length]) * inverse[:many]
                        hashes.append(mixed(value).astype(np.int64))
                    at = piece["start"] + np.arange(many, dtype=np.int64)
                    zero = np.zeros(many, np.int64)
                    rows.append((*hashes, zero + key, zero + digest, packed(at, at, at + length), zero))
                    size += many
                if size > BATCH:
                    yield handed_on(rows)
                    rows, size = [], 0
        if rows:
            yield handed_on(rows)

    return with_wanted(documents, chosen, "start", "end").mapInPandas(cut, OCCURRENCE_SCHEMA)


def covered(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``id, digest, start, end``: stretches of documents' bytes that are repeated.

    Takes ``id, digest, text``, each document once; stretches may overlap.
    """
    names = ["id", "digest", "start", "end"]
    first = written(settled(occurrences(documents, length, gram), length, gram))
    release(documents.sparkSession)
    found = first.where(F.col("kind") == COVERED).select(*names)
    kinds = {r["kind"]: r["n"] for r in first.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    if kinds.get(HOT_KIND):
        hot = first.where(F.col("kind") == HOT_KIND)
        single = settled(windows_of(documents, hot, length), length, gram)
        found = found.unionByName(written(single.where(F.col("kind") == COVERED).select(*names)))
    if kinds.get(PIECE_KIND):
        close = first.where(F.col("kind") == PIECE_KIND)
        tasks = -(-kinds[PIECE_KIND] // PIECES_PER_TASK)
        pieces = first_pieces(documents, close).repartition(tasks, "anchor")
        windows = pieces.mapInPandas(construct(length), "id long, digest long, start int, end int")
        found = found.unionByName(written(windows))
        release(documents.sparkSession)
    return found


def remove_repeated(
    df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM
) -> DataFrame:
    """``key, n_bytes, n_removed, spans, kept`` for every row: ``spans`` are the stretches
    taken out (``start``, ``end`` in UTF-8 bytes), ``kept`` the bytes that are left."""

    def take_out(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for begin in range(0, len(frame), 1000):
                some = frame.iloc[begin : begin + 1000]
                done = [one(*x) for x in zip(some["text"], some["parts"], strict=True)]
                size, removed, spans, kept = zip(*done, strict=True)
                yield pd.DataFrame(
                    {
                        "key": some["key"],
                        "n_bytes": size,
                        "n_removed": removed,
                        "spans": list(spans),
                        "kept": kept,
                    }
                )

    def one(text: str, parts: np.ndarray | None) -> tuple:
        raw = utf8(text)
        spans, kept, at = [], [], 0
        for start, end in sorted((p["start"], p["end"]) for p in (parts if parts is not None else ())):
            if spans and start <= spans[-1]["end"]:
                spans[-1]["end"] = max(end, spans[-1]["end"])
            else:
                spans.append({"start": start, "end": end})
        for span in spans:
            kept.append(raw[at : span["start"]])
            at = span["end"]
        kept.append(raw[at:])
        removed = sum(s["end"] - s["start"] for s in spans)
        return len(raw), removed, spans, b"".join(kept)

    rows, documents = told_apart(
        df.select(*identity(key, text), F.col(key).cast("string").alias("key"))
    )
    parts = (
        covered(documents, length, gram)
        .groupBy("id", "digest")
        .agg(F.collect_set(F.struct("start", "end")).alias("parts"))
    )
    kind = dict(df.dtypes)[key]
    return (
        rows.join(parts, ["id", "digest"], "left")
        .select("key", "text", "parts")
        .mapInPandas(
            take_out,
            "key string, n_bytes long, n_removed long, "
            "spans array<struct<start: int, end: int>>, kept binary",
        )
        .withColumnRenamed("key", key)
        .withColumn(key, F.col(key).cast(kind))
    )
