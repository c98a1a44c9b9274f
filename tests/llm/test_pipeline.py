"""The pipeline's stages against their operators' brute-force versions."""

import math
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from shelfrank.llm import byte_bpe, importance, line_frequency
from shelfrank.llm.shared import table, written
from test_tables import contamination_brute, groups_brute


def weights_brute(rows, good):
    """Log weight of each (id, text) from counts of n-grams in plain dictionaries."""
    tokens = importance.Tokens()
    grams = [set(importance.ngrams(text or "", tokens).tolist()) for _, text in rows]
    raw = Counter(x for own in grams for x in own)
    target = Counter(x for (key, _), own in zip(rows, grams, strict=True) if good.get(key) for x in own)
    if not target:
        return [0.0] * len(rows)
    share = sum(target.values()) / sum(raw.values())
    ratio = {}
    for x, n in raw.items():
        t, expected = target[x], n * share
        deviance = t * math.log(max(t, 1e-9) / expected) - (t - expected)
        value = math.log((t + importance.PSEUDO_COUNT) / (expected + importance.PSEUDO_COUNT))
        if deviance >= importance.MIN_DEVIANCE and abs(value) >= math.log(importance.MIN_FACTOR):
            ratio[x] = value
    return [sum(ratio.get(x, 0.0) for x in own) for own in grams]


def threshold_brute(weights, marks):
    """The multiple of a bin that takes labelled documents with the fewest errors."""
    binned = [(math.floor(max(w, importance.LOWEST) / importance.BIN), m) for w, m in zip(weights, marks, strict=True)]
    errors = {cut: sum((b >= cut) != m for b, m in binned) for cut in {b for b, _ in binned}}
    return min(errors, key=lambda cut: (errors[cut], cut)) * importance.BIN


def labels_of(rows):
    marks = defaultdict(lambda: True)
    for r in rows:
        if r.doc_id is not None and r.quality is not None and r.toxic is not None:
            marks[r.doc_id] &= r.quality == 1 and r.toxic == 0
    return dict(marks)


def test_quality_against_brute_force(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    good = labels_of(labels.collect())
    weighed = written(importance.weigh(docs, labels).select("id", "good", "row.text", "log_weight"))
    rows = weighed.collect()
    expected = weights_brute([(r.id, r.text) for r in rows], good)
    assert [r.log_weight for r in rows] == pytest.approx(expected, abs=1e-6)
    assert all(r.good == good.get(r.id) for r in rows)
    known = [(w, good[r.id]) for r, w in zip(rows, expected, strict=True) if r.id in good]
    cut = threshold_brute(*zip(*known, strict=True))
    assert importance.threshold(weighed) == cut
    drawn = importance.sample(docs, labels).collect()
    k = sum(w >= cut for w in expected)
    assert sum(r.above for r in drawn) == k
    sharpness = importance.tempering(weighed, cut)
    assert {r.sharpness for r in drawn} == {sharpness}
    keyed = importance.keys(importance.weigh(docs, labels), sharpness=sharpness)
    keyed = {r.id: r.key for r in keyed.collect()}
    least = sorted(keyed.values(), reverse=True)[k - 1]
    assert {r.id for r in drawn if r.kept} == {i for i, key in keyed.items() if key >= least}


def lines_brute(rows):
    """(id, source, text) without the lines on more than the ratio of a source's different texts."""
    texts = defaultdict(set)
    for _, source, text in rows:
        texts[source].add(text)
    bad = defaultdict(set)
    for source, own in texts.items():
        found = Counter(line for text in own if text is not None for line in set(text.split("\n")))
        bad[source] = {
            line
            for line, n in found.items()
            if line.strip(" ") and n >= line_frequency.MIN_PAGES and n > line_frequency.MAX_RATIO * len(own)
        }
    return {
        (key, None if text is None else "\n".join(x for x in text.split("\n") if source is None or x not in bad[source]))
        for key, source, text in rows
    }


def test_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    labels = {r.doc_id: r for r in table(spark, sf_dir, "labels").collect()}
    items = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "lines", "near_duplicates", "benchmark", "tokens"]

    after = written(stages["quality"](spark, docs, sf_dir))
    good = [k for k, r in labels.items() if r.quality == 1 and r.toxic == 0]
    ids = {r.doc_id for r in after.select("doc_id").collect()}
    assert after.columns == columns and sum(k in ids for k in good) >= 0.99 * len(good)

    lines = written(stages["lines"](spark, after, sf_dir))
    assert lines.columns == columns and lines.count() == after.count()
    kept = lines_brute([(r.doc_id, r.source, r.text) for r in after.collect()])
    assert {(r.doc_id, r.text) for r in lines.collect()} == kept

    single = written(stages["near_duplicates"](spark, lines, sf_dir))
    rows = [(r.doc_id, r.text) for r in lines.collect()]
    assert single.columns == columns
    assert {r.doc_id for r in single.collect()} == set(groups_brute(rows, 5).values())

    clean = written(stages["benchmark"](spark, single, sf_dir))
    rows = [(r.doc_id, r.text) for r in single.collect()]
    few = [(k, t) for k, t in items if re.search(r"\w", t)]
    bad = {r[0] for r in contamination_brute(rows, few, 13) if r[4]}
    assert clean.columns == columns
    assert {r.doc_id for r in clean.collect()} == {k for k, _ in rows} - bad

    done = stages["tokens"](spark, clean, sf_dir).collect()
    library = byte_bpe.encoding(byte_bpe.VOCABULARY)
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert {r.doc_id: r.n_tokens for r in done} == {k: len(library.encode_ordinary(t)) for k, t in texts.items()}
