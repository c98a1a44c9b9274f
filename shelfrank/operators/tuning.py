"""Hyper-parameter trials and model evaluation."""

from __future__ import annotations

import json
import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.operators import ranking
from shelfrank.operators.ensemble import LinearModel, Model
from shelfrank.operators.features import DEFAULT, FeatureSet
from shelfrank.operators.sessions import CONTEXT
from shelfrank.operators.textmatch import TextIndex
from shelfrank.schemas import TRIALS
from shelfrank.session import cut_lineage

# fixed values: trials in all, at a time, and how many may fail
MAX_TRIALS = 6
PARALLEL_TRIALS = 2
MAX_FAILED = 1


@dataclass
class Trial:
    number: int
    params: dict
    rank_train: float
    rank_val: float
    model: Model | LinearModel = field(repr=False)


def draw_parameters(space: Mapping[str, tuple], trials: int, seed: int) -> list[dict]:
    """Seeded draws from typed ranges."""
    draw = random.Random(seed)
    drawn = []
    for _ in range(trials):
        values = {}
        for name, (kind, low, high) in space.items():
            values[name] = draw.randint(low, high) if kind == "int" else draw.uniform(low, high)
        drawn.append(values)
    return drawn


def evaluate(
    model: Model | LinearModel | None,
    sets: DataFrame,
    catalog: DataFrame | TextIndex,
    size: int = ranking.RESULT_SIZE,
    window: int = ranking.BATCH_WINDOW,
    features: FeatureSet = DEFAULT,
    normalised: bool = False,
    top: DataFrame | None = None,
) -> DataFrame:
    """Mean percentile rank per ``set_name``, all sets in one job.

    ``sets`` holds the purchased ``sku`` per context, set and ``raw_ticket``: visitors whose
    tickets are equal only when rounded share a context but count each. The result equals
    ``metrics.mean_percentile_rank`` over the full result lists, without building
    them per context: below the window a document keeps the place of the first
    pass, which the search text alone decides, and the window is only rescored
    for contexts that bought something in it. ``top`` may pass in the first
    pass, which does not depend on the model.
    """
    keys = ["set_name", *CONTEXT]
    if top is None:
        top = first_pass_lists(sets, catalog, size, window)
    lengths = top.groupBy("search_term").agg((F.max("pos") + 1).alias("n"))
    kept = top.join(lengths.withColumn("n", F.least("n", F.lit(size))), "search_term").filter(
        F.col("n") >= 2
    )
    bought = sets.select(*keys, "raw_ticket", "sku").distinct()
    found = bought.join(kept, ["search_term", "sku"])
    if model is not None:
        hit = found.filter(F.col("pos") < window)
        lists = (
            hit.select(*keys).distinct().join(kept.filter(F.col("pos") < window), "search_term")
        )
        moved = ranking.rescored_window(
            lists, keys, catalog, model, features, normalised=normalised
        ).select(*keys, "sku", "pos")
        rescored = hit.drop("pos").join(moved, [*keys, "sku"])
        found = found.filter(F.col("pos") >= window).unionByName(rescored)
    ranks = (
        found.filter(F.col("pos") < size)
        .groupBy("set_name")
        .agg((F.sum(F.col("pos") / (F.col("n") - 1)) / F.count("*")).alias("_rank"))
    )
    return (
        sets.select("set_name")
        .distinct()
        .join(ranks, "set_name", "left")
        .select("set_name", F.coalesce("_rank", F.lit(0.5)).alias("rank"))
    )


def first_pass_lists(
    sets: DataFrame, catalog: DataFrame | TextIndex, size: int = ranking.RESULT_SIZE, window: int = 0
) -> DataFrame:
    """First-pass results of every search text in ``sets``, as a table of its own."""
    terms = sets.select("search_term").distinct()
    return cut_lineage(ranking.first_pass_topk(terms, catalog, max(size, window)))


def best_trial(trials: DataFrame) -> DataFrame:
    """The trial with the lowest validation rank; the first one on ties."""
    rest = [name for name in trials.columns]
    return trials.agg(
        F.min_by(F.struct(*rest), F.struct("rank_val", "trial")).alias("_best")
    ).select("_best.*")


def tune(
    train: Callable[..., Model | LinearModel],
    ranks: Callable[[Model | LinearModel], Mapping[str, float]],
    space: Mapping[str, tuple],
    trials: int = MAX_TRIALS,
    parallel: int = PARALLEL_TRIALS,
    max_failed: int = MAX_FAILED,
    seed: int = 42,
    on_trial: Callable[[Trial], None] | None = None,
) -> tuple[Trial, list[Trial]]:
    """Random search for the lowest validation rank.

    ``train(**params)`` gives a model, ``ranks(model)`` its ``train`` and
    ``validation`` ranks. Trials are driver threads that submit Spark jobs.
    """
    drawn = draw_parameters(space, trials, seed)

    def run(number: int) -> Trial:
        model = train(**drawn[number])
        measured = ranks(model)
        return Trial(number, drawn[number], measured["train"], measured["validation"], model)

    done: list[Trial] = []
    failures: list[Exception] = []
    # trials run under the caller's job group and local properties
    target = inheritable_thread_target(SparkSession.active())(run)
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        for future in [pool.submit(target, number) for number in range(trials)]:
            try:
                trial = future.result()
            except Exception as error:  # a failed trial is counted, not hidden
                failures.append(error)
                if len(failures) > max_failed:
                    pool.shutdown(cancel_futures=True)
                    raise
                continue
            done.append(trial)
            if on_trial is not None:
                on_trial(trial)
    if not done:
        raise failures[0]
    best = min(done, key=lambda trial: (trial.rank_val, trial.number))
    return best, done


def trials_frame(spark: SparkSession, trials: Sequence[Trial]) -> DataFrame:
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    rows = [
        (t.number, now, json.dumps(t.params, sort_keys=True), t.rank_train, t.rank_val)
        for t in trials
    ]
    return spark.createDataFrame(rows, TRIALS)
