"""Files, model registry, trials and the whole workflow."""

import dataclasses
import datetime
import json

import pytest
from pyspark.sql import functions as F

from shelfrank.operators import (
    dbn,
    ensemble,
    features,
    metrics,
    ranking,
    sessions,
    training,
    tuning,
)
from shelfrank.plans import queries, workflow
from shelfrank.schemas import CLICKSTREAM, VALIDATION
from shelfrank.sources import adapter, readers, writers

NODE = ensemble.Node(1, 0, 0.1, output=1.5)


def test_letor_golden(spark, tmp_path):
    logged = spark.createDataFrame(
        [
            ("keyword0", "doc0", 0, [0.01, 0.02]),
            ("keyword0", "doc1", 4, [0.03, 0.04]),
            ("keyword0", "doc2", 2, [0.05, 0.06]),
            ("keyword1", "doc1", 0, [0.03, 0.04]),
            ("keyword1", "doc2", 4, [0.05, None]),
            ("keyword2", "doc3", 0, [0.06, 0.07]),
        ],
        "search_term string, doc string, grade int, features array<double>",
    )
    lists = features.training_lists(logged, ["search_term"])
    path = tmp_path / "letor"
    writers.write_letor(lists, str(path))
    text = "".join(file.read_text() for file in sorted(path.glob("part-*")))
    assert text == (
        "0\tqid:0\t1:0.01\t2:0.02\n4\tqid:0\t1:0.03\t2:0.04\n2\tqid:0\t1:0.05\t2:0.06\n"
        "0\tqid:1\t1:0.03\t2:0.04\n4\tqid:1\t1:0.05\t2:0\n"
    )
    back = readers.read_letor(spark, str(path)).collect()
    assert sorted((r["qid"], r["grade"], list(r["features"])) for r in back) == [
        (0, 0, [0.01, 0.02]),
        (0, 2, [0.05, 0.06]),
        (0, 4, [0.03, 0.04]),
        (1, 0, [0.03, 0.04]),
        (1, 4, [0.05, 0.0]),
    ]


def test_feature_files(spark, tmp_path):
    def write(file, name, params):
        (tmp_path / file).write_text(json.dumps({"name": name, "params": params, "query": {}}))

    write("b.json", "BM25 name", ["search_term"])
    write("a.json", "customer_avg_ticket", ["customer_avg_ticket"])
    loaded = readers.read_features(spark, str(tmp_path), "m")
    assert [f.name for f in loaded.features] == ["customer_avg_ticket", "BM25 name"]
    assert loaded.params == ["customer_avg_ticket", "search_term"]
    write("c.json", "other", [])
    with pytest.raises(ValueError, match="other"):
        readers.read_features(spark, str(tmp_path), "m")


def test_clickstream_and_validation_files(spark, sf_dir, tmp_path):
    hits = adapter.event_hits(spark, sf_dir)
    visitors = sessions.visitor_context(hits)
    sets = sessions.train_sets(sessions.session_lists(hits, 1.0), visitors)
    path = str(tmp_path / "clickstream")
    writers.write_ndjson_gz(writers.clickstream_rows(sets), path)
    back = readers.read_ndjson_gz(spark, path, CLICKSTREAM)
    lists = readers.long_clickstream(back)
    columns = [*sessions.CONTEXT, "doc", "click", "purchase", "list_pos", "last_click"]
    assert sorted(lists.select(columns).collect()) == sorted(sets.select(columns).collect())
    # the click model gives the same judgments from files as from the log
    judged = [
        sorted(dbn.dbn_em(frame, sessions.CONTEXT, iterations=2).drop("gamma").collect())
        for frame in (lists, sets)
    ]
    assert len(judged[0]) == len(judged[1]) > 0
    for from_file, from_log in zip(*judged):
        assert from_file[:4] == from_log[:4]
        assert from_file[4:] == pytest.approx(from_log[4:], abs=1e-9)

    bought = sessions.validation_sets(hits, visitors)
    path = str(tmp_path / "validation")
    writers.write_ndjson_gz(writers.validation_rows(bought), path)
    back = readers.read_ndjson_gz(spark, path, VALIDATION)
    columns = [*sessions.CONTEXT, "sku"]
    assert sorted(readers.long_validation(back).select(columns).collect()) == sorted(
        bought.select(columns).collect()
    )


def test_a_hot_key_takes_several_rows(spark):
    """Half of all entries under one key: no array gets long, nothing is lost."""
    rows = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot"))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string")))
        .alias("key"),
        F.col("id").alias("doc"),
    )
    nested = writers.nest_entries(rows, ["key"], F.struct("doc"), ["doc"], "docs", 100)
    sizes = {r["key"]: (r["n"], r["most"]) for r in nested.groupBy("key").agg(
        F.sum(F.size("docs")).alias("n"), F.max(F.size("docs")).alias("most")
    ).collect()}
    assert sizes["hot"][0] == 2000 and sizes["hot"][1] <= 100
    numbered = nested.groupBy("key").agg(F.max("part").alias("last"), F.max("parts").alias("parts"))
    assert numbered.filter("last >= parts").isEmpty()
    assert sum(n for n, _ in sizes.values()) == 4000
    assert nested.groupBy("key").count().filter("key <> 'hot' AND count > 1").count() == 0


def test_session_readers(spark, tmp_path):
    days = [datetime.date(2024, 1, day) for day in (1, 2, 3)]
    frame = spark.createDataFrame([(i, day) for i, day in enumerate(days)], "n int, session_date date")
    path = str(tmp_path / "sessions")
    writers.write_table(frame, path, partition_by=["session_date"])
    window = readers.read_sessions(spark, path, "2024-01-02", "2024-01-03")
    assert sorted(r["n"] for r in window.collect()) == [1, 2]
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(session_date" in plan

    shards = tmp_path / "shards"
    shards.mkdir()
    for number, day in enumerate(("20240101", "20240102")):
        frame.filter(f"n = {number}").toPandas()[["n"]].to_parquet(shards / f"visits_{day}.parquet")
    found = readers.read_session_shards(spark, str(shards), "20240102", "20240131").collect()
    assert [(r["n"], r["shard_date"]) for r in found] == [(1, "20240102")]


def test_model_registry(spark, tmp_path):
    root = str(tmp_path / "models")
    writers.save_model(spark, [NODE], root, "one")
    writers.save_model(spark, queries.SMALL_MODEL, root, "two")
    writers.save_model(spark, [ensemble.Node(1, 0, 0.1, output=9.0)], root, "one")
    one = ensemble.model_from_frame(readers.load_model(spark, root, "one"))
    two = ensemble.model_from_frame(readers.load_model(spark, root, "two"))
    assert [n.output for n in one] == [9.0]
    assert two == queries.SMALL_MODEL


def test_best_trial_and_results(spark, tmp_path):
    path = str(tmp_path / "results")
    for number, (rank_train, rank_val) in enumerate([(0.2, 0.3), (0.1, 0.2), (0.3, 0.4), (0.1, 0.2)]):
        trial = tuning.Trial(number, {"var1": number}, rank_train, rank_val, [NODE])
        writers.append_results(tuning.trials_frame(spark, [trial]), path)
    trials = readers.read_trials(spark, path)
    assert trials.count() == 4
    best = tuning.best_trial(trials).first()
    assert (best["trial"], best["rank_val"], json.loads(best["params"])) == (1, 0.2, {"var1": 1})


def test_tune(spark):
    space = {"tree": ("int", 1, 5), "rate": ("double", 0.0, 1.0)}

    def train(tree, rate):
        assert 1 <= tree <= 5 and 0 <= rate <= 1
        return [ensemble.Node(1, 0, 1.0, output=rate)]

    def ranks(model):
        return {"train": 0.5, "validation": abs(model[0].output - 0.5)}

    seen = []
    best, done = tuning.tune(train, ranks, space, trials=6, on_trial=seen.append)
    assert len(done) == len(seen) == 6
    assert best.rank_val == min(t.rank_val for t in done)
    again, _ = tuning.tune(train, ranks, space, trials=6)
    assert again.params == best.params


def test_tune_allows_one_failure(spark):
    calls = []

    def train(x):
        calls.append(x)
        if x == min(calls) and len(calls) == 1:
            raise RuntimeError("lost")
        return [NODE]

    ranks = {"train": 0.1, "validation": 0.2}
    best, done = tuning.tune(train, lambda m: ranks, {"x": ("double", 0, 1)}, trials=3, parallel=1)
    assert len(done) == 2

    def broken(x):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        tuning.tune(broken, lambda m: ranks, {"x": ("double", 0, 1)}, trials=3, parallel=1)


def test_training_from_text(spark, sf_dir, tmp_path):
    """Training text -> model, without documents in the rows."""
    rows = queries.training_rows(spark, sf_dir)
    path = str(tmp_path / "letor")
    writers.write_letor(rows, path)
    read = training.with_document_ids(readers.read_letor(spark, path))
    assert read.count() == rows.count()
    model = training.train_lambdamart(read, trees=1, leaf=4)
    assert sum(node.is_leaf for node in model) >= 2


def test_evaluation_equals_full_lists(spark, sf_dir):
    """The shortcut gives the metric of complete result lists."""
    sets = queries.evaluation_sets(spark, sf_dir)
    docs = queries.event_catalog(spark, sf_dir)
    keys = ["set_name", *sessions.CONTEXT]
    for model, size, window in ((None, 1000, 50), (queries.SMALL_MODEL, 6, 4)):
        short = tuning.evaluate(model, sets, docs, size, window)
        lists = ranking.search(
            sets.select(*keys).distinct(), docs, model, size, window, use_ltr=model is not None
        )
        full = metrics.mean_percentile_rank(
            lists, sets, keys, by=["set_name"], each=["raw_ticket"]
        )
        expected = {r["set_name"]: r["rank"] for r in full.collect()}
        found = {r["set_name"]: r["rank"] for r in short.collect()}
        assert found == pytest.approx(expected, abs=1e-12)


def test_renaming_documents_keeps_metrics(spark):
    rows = spark.createDataFrame(
        [("q", i, f"d{i}", g) for i, g in enumerate([2, 0, 4, 1])],
        "query string, pos bigint, sku string, grade int",
    )
    renamed = rows.withColumn("sku", F.concat(F.lit("x"), F.col("sku")))
    bought = [frame.filter("grade = 4").select("query", "sku") for frame in (rows, renamed)]
    errs = [metrics.err_at_k(f, ["query"], [F.asc("pos")]).first()["err"] for f in (rows, renamed)]
    ranks = [
        metrics.mean_percentile_rank(f, b, ["query"]).first()["rank"]
        for f, b in zip((rows, renamed), bought)
    ]
    assert errs[0] == errs[1] and ranks[0] == ranks[1] == pytest.approx(2 / 3)


def test_feature_parameters_are_checked(spark, sf_dir):
    docs = queries.event_catalog(spark, sf_dir)
    rows = spark.createDataFrame([("pen", "1")], "search_term string, sku string")
    with pytest.raises(ValueError, match="channel_group"):
        features.attach_features(rows, docs)


def test_workflow(spark, sf_dir, tmp_path):
    settings = workflow.Settings(
        root=str(tmp_path / "run"),
        windows=queries.WINDOWS,
        rate=1.0,
        iterations=2,
        trials=2,
        space={"trees": ("int", 2, 3), "leaf": ("int", 2, 4)},
    )
    hits = adapter.event_hits(spark, sf_dir)
    result = workflow.run_workflow(spark, hits, settings)
    for name in ("rank_train", "rank_val", "rank_test"):
        assert 0.0 <= result[name] <= 1.0
    assert readers.read_trials(spark, settings.path("results")).count() == 2
    # a run with other windows makes tables of its own
    later = dataclasses.replace(settings, windows={**queries.WINDOWS, "train": ("2024-01-03", "2024-01-06")})
    first = workflow.build_evaluation_sets(spark, hits, settings)
    second = workflow.build_evaluation_sets(spark, hits, later)
    train = "set_name = 'train'"
    assert sorted(first.filter(train).collect()) != sorted(second.filter(train).collect())
    # a second run finds every table in place
    catalog = workflow.build_catalog(spark, hits.limit(0), settings)
    assert catalog.count() > 0
