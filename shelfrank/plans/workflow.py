"""The whole run: catalog, evaluation sets, training set, trials, best model, test.

Each step writes its result under ``root`` and reads it back, so a step that is
done is not done again and a lost executor never reaches back past a step. A
step's folder carries a digest of the settings its table depends on, so a run
with other windows, rates or features makes tables of its own.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.operators import catalog as products
from shelfrank.operators import (
    clicks,
    dbn,
    features,
    insession,
    ranking,
    sessions,
    textmatch,
    training,
    tuning,
)
from shelfrank.operators.ensemble import LinearModel, Model, model_from_frame
from shelfrank.sources import readers, writers

CONTEXT = sessions.CONTEXT


@dataclass
class Settings:
    """What a run is told; windows are inclusive ISO dates.

    ``source`` names the input: give another name for other hits. ``space`` is by
    default the ranker's own (``training.SEARCH_SPACE``).
    """

    root: str
    windows: Mapping[str, tuple[str, str]]
    model_name: str = "lambdamart0"
    ranker: str = "lambdamart"
    rate: float = 0.01
    iterations: int = 10
    trials: int = tuning.MAX_TRIALS
    parallel: int = tuning.PARALLEL_TRIALS
    size: int = ranking.RESULT_SIZE
    window: int = ranking.BATCH_WINDOW
    normalised: bool = True
    force_restart: bool = False
    seed: int = 42
    source: str = ""
    space: Mapping[str, tuple] | None = None

    def __post_init__(self) -> None:
        if self.space is None and self.ranker in training.SEARCH_SPACE:
            self.space = training.SEARCH_SPACE[self.ranker]
        training.check_space(self.ranker, self.space or {})

    def path(self, name: str) -> str:
        """Where a step's table is, by all that the table depends on."""
        lists = [self.windows["train"], self.rate]
        judged = [*lists, self.iterations]
        parts = {
            "evaluation": sorted(self.windows.items()),
            "clickstream": lists,
            "judgments": judged,
            "train": [*judged, self.normalised, [f.name for f in features.DEFAULT.features]],
            "train_letor": [*judged, self.normalised],
        }
        if name not in parts and not self.source:
            return f"{self.root}/{self.model_name}/{name}"
        text = json.dumps([self.source, parts.get(name, [])])
        digest = hashlib.sha256(text.encode()).hexdigest()[:12]
        return f"{self.root}/{self.model_name}/{name}-{digest}"


def build_catalog(spark: SparkSession, hits: DataFrame, settings: Settings) -> DataFrame:
    """Catalog documents of all dates, kept unless a restart is forced."""
    own = insession if is_nested(hits) else products
    documents = writers.write_catalog(
        spark,
        settings.path("catalog"),
        lambda: products.catalog_docs(products.catalog_rows(own.product_channel(hits))),
        settings.force_restart,
    )
    return products.from_documents(documents)


def build_index(spark: SparkSession, catalog: DataFrame, settings: Settings) -> textmatch.TextIndex:
    """The catalog's text index beside the catalog, built where the catalog is."""
    path = settings.path("catalog") + "-index"
    wanted = ranking.catalog_index(catalog)
    done = writers.existing_table(spark, f"{path}/totals") is not None
    if settings.force_restart or not done:
        return textmatch.write_index(wanted, path)
    return textmatch.read_index(spark, path, wanted.fields, wanted.key, wanted.carry)


def is_nested(log: DataFrame) -> bool:
    """Whether a log has a row per session, with its pages, rather than a row per hit."""
    return "hits" in log.columns


def build_evaluation_sets(spark: SparkSession, hits: DataFrame, settings: Settings) -> DataFrame:
    """Purchases of all windows in one table."""

    def build() -> DataFrame:
        labelled = sessions.temporal_split(hits, settings.windows)
        by = ["set_name"]
        if is_nested(hits):
            visitors = insession.visitor_context(labelled, by)
            return sessions.purchased_sets(insession.rolled_docs(labelled, by), visitors, by)
        return sessions.validation_sets(labelled, sessions.visitor_context(labelled, by), by)

    return writers.rebuild(
        spark, settings.path("evaluation"), build, settings.force_restart
    )


def build_training_set(
    spark: SparkSession, hits: DataFrame, catalog: DataFrame | textmatch.TextIndex, settings: Settings
) -> DataFrame:
    """Click lists -> judgments -> grades -> features -> numbered lists, and their text file."""
    window = sessions.between_dates(hits, *settings.windows["train"])
    restart = settings.force_restart
    own = insession if is_nested(hits) else sessions

    def lists() -> DataFrame:
        kept = own.session_lists(window, settings.rate)
        return sessions.train_sets(kept, own.visitor_context(window))

    sets = writers.rebuild(spark, settings.path("clickstream"), lists, restart)
    judged = writers.rebuild(
        spark,
        settings.path("judgments"),
        lambda: clicks.grade(dbn.dbn_em(sets, CONTEXT, settings.iterations), CONTEXT),
        restart,
    )

    def rows() -> DataFrame:
        logged = features.log_features(judged.select(*CONTEXT, "doc", "grade"), catalog)
        numbered = features.training_lists(logged, CONTEXT)
        size = len(features.DEFAULT.features)
        return features.normalise(numbered, size) if settings.normalised else numbered

    training_rows = writers.rebuild(spark, settings.path("train"), rows, restart)
    writers.write_letor(training_rows, settings.path("train_letor"))
    return training_rows


def run_workflow(spark: SparkSession, hits: DataFrame, settings: Settings) -> dict[str, object]:
    """Run every step; returns the best trial's parameters and the three ranks.

    ``hits`` has a row per hit, or per session with its pages nested; then no hit is shuffled.
    """
    catalog = build_index(spark, build_catalog(spark, hits, settings), settings)
    sets = build_evaluation_sets(spark, hits, settings)
    rows = build_training_set(spark, hits, catalog, settings)

    top = tuning.first_pass_lists(sets, catalog, settings.size, settings.window)

    def ranks(model: Model | LinearModel, *names: str) -> dict[str, float]:
        wanted = sets.filter(F.col("set_name").isin(*names))
        measured = tuning.evaluate(
            model,
            wanted,
            catalog,
            settings.size,
            settings.window,
            normalised=settings.normalised,
            top=top,
        )
        # one row per window
        found = {row["set_name"]: row["rank"] for row in measured.collect()}
        return {name: found.get(name, 0.5) for name in names}

    def train(**parameters) -> Model | LinearModel:
        return training.train(
            settings.ranker, rows, len(features.DEFAULT.features), **parameters
        )

    leading: list[tuning.Trial] = []

    def keep(trial: tuning.Trial) -> None:
        """Results, and the best model so far, survive a run that breaks off."""
        writers.append_results(tuning.trials_frame(spark, [trial]), settings.path("results"))
        if not leading or trial.rank_val < leading[0].rank_val:
            leading[:] = [trial]
            writers.save_model(
                spark, trial.model, settings.path("models"), settings.model_name
            )

    best, _ = tuning.tune(
        train,
        lambda model: ranks(model, "train", "validation"),
        settings.space,
        settings.trials,
        settings.parallel,
        seed=settings.seed,
        on_trial=keep,
    )
    saved = readers.load_model(spark, settings.path("models"), settings.model_name)
    model = model_from_frame(saved)
    return {
        "params": best.params,
        "rank_train": best.rank_train,
        "rank_val": best.rank_val,
        "rank_test": ranks(model, "test")["test"],
    }
