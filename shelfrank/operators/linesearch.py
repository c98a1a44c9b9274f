"""Exact line search of a linear ranker's ERR along one weight.

While one weight moves by t, a document's score is a line in t. The order of a list, and so
its ERR, only changes where two of its lines cross. Each list gives its ERR as a step function
of t; the steps of all lists are added in the order of t, and the best stretch between two
steps is the optimum.

A document that ten others of its list beat at both ends of the range beats none of them in
between, so it is never seen. Such documents are dropped where they are read, before lists are
gathered: what is left of a list does not grow with its length, but for equal documents.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.operators.ensemble import LinearModel, value_at
from shelfrank.operators.metrics import DEPTH, gain
from shelfrank.operators.numbering import sorted_index

REACH = 4.0  # how far a weight moves either way, where all weights add up to 1
CHUNK = 1 << 16  # steps whose running sum is made in one task
CELLS = 1 << 20  # scores looked at a time


def lines(rows: DataFrame, weights: Sequence[float], coordinate: int) -> DataFrame:
    """``qid, doc, gain, at`` (the score where the weight stays) and ``slope`` of each row."""
    features = F.col("features")
    return rows.select(
        "qid",
        F.col("doc").cast("string").alias("doc"),
        gain(F.col("grade").cast("double")).alias("gain"),
        LinearModel(tuple(weights)).column(features).alias("at"),
        value_at(features, coordinate).alias("slope"),
    )


def unbeaten(low: np.ndarray, high: np.ndarray, place: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Which of a list's lines fewer than ``depth`` others beat at both ends.

    ``place`` decides between equal lines.
    """
    order = np.lexsort((place, -high, -low))
    keep = np.ones(len(low), bool)
    best = np.full(depth, -np.inf)  # the highest values at the upper end so far
    for i in order:
        if high[i] <= best[0]:
            keep[i] = False
        else:
            best[0] = high[i]
            best.sort()
    return keep


def steps_of(at: np.ndarray, slope: np.ndarray, gains: np.ndarray, reach: float, depth: int = DEPTH):
    """A list's ERR as a step function: where it changes, and its values from there on.

    The first place is the lower end. Lines come in the order that decides between equal ones.
    """
    i, j = np.triu_indices(len(at), 1)
    apart = slope[i] != slope[j]
    cross = (at[j][apart] - at[i][apart]) / (slope[i][apart] - slope[j][apart])
    places = np.unique(np.concatenate([[-reach], cross[(cross > -reach) & (cross < reach)]]))
    middles = (places + np.append(places[1:], reach)) / 2
    values = np.empty(len(middles))
    weight = 1.0 / np.arange(1, depth + 1)
    step = max(1, CELLS // max(len(at), 1))
    for start in range(0, len(middles), step):
        some = middles[start : start + step, None]
        order = np.argsort(-(at + some * slope), axis=1, kind="stable")[:, :depth]
        own = gains[order]
        values[start : start + step] = (own * reached(own) * weight[: own.shape[1]]).sum(1)
    changed = np.append(True, values[1:] != values[:-1])
    return places[changed], values[changed]


def reached(own: np.ndarray) -> np.ndarray:
    """The chance to get to each place, given the gains down the list."""
    ones = np.ones((len(own), 1))
    return np.hstack((ones, np.cumprod(1 - own, axis=1)[:, :-1]))


def steps(rows: DataFrame, reach: float = REACH) -> DataFrame:
    """``t, change``: what each list's ERR changes by, from -``reach`` on (its first value)."""

    def dropped(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            low = (frame["at"] - reach * frame["slope"]).to_numpy()
            high = (frame["at"] + reach * frame["slope"]).to_numpy()
            place = frame["doc"].rank(method="first").to_numpy()
            keep = np.zeros(len(frame), bool)
            for own in frame.groupby("qid", sort=False).indices.values():
                keep[own] = unbeaten(low[own], high[own], place[own])
            yield frame[keep]

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("doc", kind="stable")
        at, slope, gains = (frame[x].to_numpy(float) for x in ("at", "slope", "gain"))
        keep = unbeaten(at - reach * slope, at + reach * slope, np.arange(len(at)))
        places, values = steps_of(at[keep], slope[keep], gains[keep], reach)
        return pd.DataFrame({"t": places, "change": np.diff(values, prepend=0.0)})

    kept = rows.mapInPandas(dropped, rows.schema)
    return kept.groupBy("qid").applyInPandas(one, "t double, change double")


def best_stretch(changes: DataFrame, reach: float = REACH) -> tuple[float, float] | None:
    """Where the sum of all lists' ERR is highest, and that sum; the lowest such t on ties."""
    by_place = changes.groupBy("t").agg(F.sum("change").alias("change"))
    chunked = sorted_index(by_place, ["t"], "_at").withColumn("chunk", F.floor(F.col("_at") / CHUNK))
    whole = Window.orderBy("chunk")
    # one row per chunk of steps
    chunks = chunked.groupBy("chunk").agg(F.sum("change").alias("sum"), F.min("t").alias("first"))
    starts = chunks.select(
        "chunk",
        F.coalesce(F.sum("sum").over(whole.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("start"),
        F.lead("first").over(whole).alias("follows"),
    )
    inside = Window.partitionBy("chunk").orderBy("t")
    running = chunked.join(starts, "chunk").select(
        "t",
        F.round(F.col("start") + F.sum("change").over(inside.rowsBetween(Window.unboundedPreceding, 0)), 9).alias("value"),
        F.coalesce(F.lead("t").over(inside), "follows", F.lit(reach)).alias("until"),
    )
    best = running.agg(F.max_by(F.struct("t", "until", "value"), F.struct("value", -F.col("t"))).alias("b")).first()["b"]
    return None if best is None else ((best["t"] + best["until"]) / 2, best["value"])


def best_on_coordinate(
    rows: DataFrame, weights: Sequence[float], coordinate: int, reach: float = REACH
) -> tuple[float, float] | None:
    """How far to move one weight for the highest sum of the lists' ERR, and that sum.

    Rows are ``qid, doc, grade, features``; None where there are none.
    """
    return best_stretch(steps(lines(rows, weights, coordinate), reach), reach)
