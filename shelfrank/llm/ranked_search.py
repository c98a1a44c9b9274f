"""Ranked lexical search of many items at once, with shared partial scores.

1. Items are dealt to blocks of about ``BLOCK_TERMS`` terms. A block's terms are its vocabulary.
2. One pass over the documents writes the block's index: for each document its number of terms,
   and the vocabulary's terms in it with their counts. Document frequencies and lengths are
   added up from it.
3. Term sets that items share are mined: each item's terms stand in order of the number of
   items that have them, and neighbours that stand together in several items become one node
   of a DAG, round by round, until no pair is shared.
4. Tasks read the index some documents at a time. The score of every term is computed once per
   document, each node adds the accumulators of its two parts once, and items add what is left
   of their own. All sums are whole numbers, so any order of adding gives the same score.
5. A task keeps the best documents of each item and gives them to one aggregate per item.

No pair of item and document is ever a row, except a task's best.

Nulls: a null text has no terms; a null document id comes after others of equal score; an item
with null text or no terms gives no rows, a null item id is an id. Repeated documents and ids
are documents like others; of repeated rows of one item (same id and text) one counts. Empty
tables give no rows. Very long texts are read in parts of ``PART_BYTES``, cut between terms.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.llm.shared import written

TOP = 10
BLOCK_TERMS = 50_000
PART_BYTES = 1 << 22
DOCUMENTS_AT_ONCE = 512
CELLS = 1 << 23  # accumulators of a task at a time, 8 bytes each
# the contract's length normalisation, in hundredths
LENGTH_SHARE = 75

TERM_BYTES = frozenset((string.ascii_letters + string.digits).encode()) | set(range(128, 256))
# bytes of terms, A-Z lowered; all others are blanks
FOLDED = bytes(ord(chr(b).lower()) if b < 128 else b for b in range(256))
FOLDED = bytes(f if b in TERM_BYTES else 32 for b, f in enumerate(FOLDED))


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded size."""
    if not text:
        return
    folded = text.encode().translate(FOLDED)
    start = 0
    while start < len(folded):
        stop = folded.find(b" ", start + PART_BYTES)
        stop = len(folded) if stop < 0 else stop
        yield folded[start:stop].split()
        start = stop


def term_counts(text: str | None) -> Counter:
    found: Counter = Counter()
    for part in terms(text):
        found.update(part)
    return found


class SharedSums:
    """How a block's items are added up: a DAG over the vocabulary.

    Rows ``0 .. len(vocabulary)-1`` of an accumulator are single terms; then come terms that an
    item has more than once (``repeats``: term and times), then sums of two earlier rows, in
    ``levels`` of pairs that only need rows before them. ``items`` lists the rows an item adds.
    """

    def __init__(self, items: list[Counter]) -> None:
        self.vocabulary = sorted(set().union(*items)) if items else []
        place = {term: i for i, term in enumerate(self.vocabulary)}
        self.repeats: list[tuple[int, int]] = sorted(
            {(place[t], n) for item in items for t, n in item.items() if n > 1}
        )
        base = len(place)
        repeated = {x: base + i for i, x in enumerate(self.repeats)}
        rows = [
            [repeated[place[t], n] if n > 1 else place[t] for t, n in item.items()] for item in items
        ]
        shared = Counter(x for item in rows for x in item)
        self.items = [sorted(item, key=lambda x: (-shared[x], x)) for item in rows]
        self.size = base + len(self.repeats)
        self.levels: list[list[tuple[int, int]]] = []
        while self._share():
            pass

    def _share(self) -> bool:
        """Turn neighbours that several items have into nodes; whether there were any."""
        pairs = Counter(pair for item in self.items for pair in zip(item, item[1:], strict=False))
        nodes: dict[tuple[int, int], list[tuple[int, int]]] = {
            pair: [] for pair, times in pairs.items() if times > 1
        }
        for number, item in enumerate(self.items):
            at = 0
            while at + 1 < len(item):
                here, after = tuple(item[at : at + 2]), tuple(item[at + 1 : at + 3])
                # a pair gives way to one that overlaps it and is shared more often
                if here in nodes and not pairs.get(after, 0) > pairs[here]:
                    nodes[here].append((number, at))
                    at += 1
                at += 1
        level = [pair for pair, places in nodes.items() if len(places) > 1]
        for offset, pair in enumerate(level):
            for number, at in nodes[pair]:
                self.items[number][at : at + 2] = [self.size + offset, -1]
        self.items = [[x for x in item if x >= 0] for item in self.items]
        if level:
            self.levels.append(level)
            self.size += len(level)
        return bool(level)

    def additions(self) -> tuple[int, int]:
        """Sums per document with sharing, and without."""
        nodes = sum(map(len, self.levels))
        parts = {x: 1 for x in range(len(self.vocabulary) + len(self.repeats))}
        for pair in (pair for level in self.levels for pair in level):
            parts[len(parts)] = parts[pair[0]] + parts[pair[1]]
        return (
            nodes + sum(max(len(item) - 1, 0) for item in self.items),
            sum(max(sum(parts[x] for x in item) - 1, 0) for item in self.items),
        )

    def scores(self, single: np.ndarray) -> np.ndarray:
        """Scores by item and document from those by term and document."""
        sums = np.empty((self.size, single.shape[1]), np.int64)
        at = len(single)
        sums[:at] = single
        for term, times in self.repeats:
            sums[at] = times * single[term]
            at += 1
        for level in self.levels:
            left, right = np.array(level).T
            np.add(sums[left], sums[right], out=sums[at : at + len(level)])
            at += len(level)
        out = np.zeros((len(self.items), single.shape[1]), np.int64)
        for number, item in enumerate(self.items):
            if item:
                sums[item].sum(axis=0, out=out[number])
        return out


def index(documents: DataFrame, vocabulary: list[bytes], key: str, text: str) -> DataFrame:
    """``doc, no_doc, n, terms, counts``: a row per document with terms.

    ``doc`` is the id, 0 where ``no_doc`` says that it is null; ``terms`` are places in the
    vocabulary.
    """
    place = {term: i for i, term in enumerate(vocabulary)}

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sizes, found = [], []
            for one in frame["text"]:
                n, hits = 0, Counter()
                for part in terms(one):
                    n += len(part)
                    hits.update(map(place.get, part))
                hits.pop(None, None)
                sizes.append(n)
                found.append(hits)
            yield pd.DataFrame(
                {
                    "doc": frame["doc"],
                    "no_doc": frame["no_doc"],
                    "n": sizes,
                    "terms": [list(x) for x in found],
                    "counts": [list(x.values()) for x in found],
                }
            )

    rows = documents.select(
        F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("doc"),
        F.col(key).isNull().alias("no_doc"),
        F.col(text).alias("text"),
    )
    schema = "doc long, no_doc boolean, n long, terms array<int>, counts array<long>"
    return rows.mapInPandas(counted, schema).where("n > 0")


def weights(postings: DataFrame, size: int) -> tuple[list[int], int, int]:
    """The weight of each term of the vocabulary, the number of documents and of their terms."""
    whole = postings.agg(F.count("*").alias("documents"), F.sum("n").alias("terms")).first()
    frequency = dict(
        postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    )  # one row per term of the block's vocabulary
    n = whole["documents"]
    weight = [
        math.floor(1000 * math.log((2 * n + 2) / (2 * frequency.get(term, 0) + 1)))
        for term in range(size)
    ]
    return weight, n, whole["terms"] or 0


class Best:
    """The best ``top`` documents of each item so far."""

    def __init__(self, items: int, top: int) -> None:
        self.top = top
        self.score = np.zeros((items, top), np.int64)
        self.doc = np.zeros((items, top), np.int64)
        self.no_doc = np.ones((items, top), bool)

    def add(self, scores: np.ndarray, doc: np.ndarray, no_doc: np.ndarray) -> None:
        least = self.score[:, -1]
        hopeful = (scores > 0) & (scores >= least[:, None])
        for item in np.flatnonzero(hopeful.any(axis=1)):
            at = np.flatnonzero(hopeful[item])
            score = np.concatenate([self.score[item], scores[item, at]])
            docs = np.concatenate([self.doc[item], doc[at]])
            none = np.concatenate([self.no_doc[item], no_doc[at]])
            order = np.lexsort((docs, none, -score))[: self.top]
            self.score[item], self.doc[item], self.no_doc[item] = score[order], docs[order], none[order]

    def rows(self) -> pd.DataFrame:
        item, place = np.nonzero(self.score)
        return pd.DataFrame(
            {
                "item": item,
                "doc": self.doc[item, place],
                "no_doc": self.no_doc[item, place],
                "score": self.score[item, place],
            }
        )


def best_of_block(postings: DataFrame, sharing: SharedSums, top: int) -> DataFrame:
    """``item, doc, no_doc, score``: at least the ``top`` best documents of each item."""
    weight, documents, length = weights(postings, len(sharing.vocabulary))

    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = Best(len(sharing.items), top)
        weighing = np.array(weight, np.int64)
        step = max(1, min(DOCUMENTS_AT_ONCE, CELLS // max(sharing.size, 1)))
        for frame in frames:
            for start in range(0, len(frame), step):
                some = frame.iloc[start : start + step]
                # whole numbers of any size
                scale = np.array(
                    [
                        8 * (100 - LENGTH_SHARE + LENGTH_SHARE * n * documents // length)
                        for n in some["n"].tolist()
                    ],
                    np.int64,
                )
                sizes = some["terms"].str.len().to_numpy()
                column = np.repeat(np.arange(len(some)), sizes)
                single = np.zeros((len(weighing), len(some)), np.int64)
                if len(column):
                    row = np.concatenate(some["terms"].to_list()).astype(np.int64)
                    count = np.concatenate(some["counts"].to_list()).astype(np.int64)
                    gain = (1_000_000_000 * count) // (1000 * count + scale[column])
                    single[row, column] = weighing[row] * gain
                best.add(sharing.scores(single), some["doc"].to_numpy(), some["no_doc"].to_numpy())
        yield best.rows()

    return postings.mapInPandas(scored, "item int, doc long, no_doc boolean, score long")


def search(
    documents: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """The ``top`` documents of each item: ``item_key, rank, key, score``.

    Document ids are whole numbers; scores above 0 only, equal ones by ascending id.
    """
    spark = documents.sparkSession
    asked = items.select(F.col(item_key).alias("id"), F.col(item_text).alias("text")).distinct()
    length = F.coalesce(F.sum(F.length("text")), F.lit(0))
    asked = written(asked.where("text IS NOT NULL"))
    # a term has two characters at least, with the blank behind it
    blocks = 1 + int(asked.agg(length.alias("n")).first()["n"]) // (2 * block_terms)
    asked = written(asked.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks))))
    kind = dict(asked.dtypes)["id"]
    found = spark.createDataFrame([], f"id {kind}, rank int, doc long, no_doc boolean, score long")
    for block in range(blocks):
        here = asked.where(F.col("block") == block).collect()  # bounded by block_terms
        if not here:
            continue
        sharing = SharedSums([term_counts(row["text"]) for row in here])
        postings = written(index(documents, sharing.vocabulary, key, text))
        best = best_of_block(postings, sharing, top)
        order = Window.partitionBy("item").orderBy(F.desc("score"), "no_doc", "doc")
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        ids = spark.createDataFrame(
            [(i, row["id"]) for i, row in enumerate(here)], f"item int, id {kind}"
        )
        found = found.unionByName(
            written(ranked.join(ids, "item").select("id", "rank", "doc", "no_doc", "score"))
        )
    return found.select(
        F.col("id").alias(item_key),
        "rank",
        F.when(~F.col("no_doc"), F.col("doc")).alias(key),
        "score",
    )
