"""Operators over whole tables, against brute force, with odd rows and hot groups."""

import base64
import gzip
import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfrank.llm import components, decontaminate, importance, line_frequency, merkle, near_dup, shingles, suffix, warc

SCHEMA = "doc_id long, text string, source string, n_chars long, row string, document int"


def frame(spark, rows):
    """Rows of (id, text[, source]) with columns whose names clash with the operators' own."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "s", len(r[1] or ""), "clash", 1) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


# -- lines -------------------------------------------------------------------


def test_boilerplate_lines(spark):
    rows = [(i, f"own {i}\ncookies\n\nown {i}\nend", "a") for i in range(20)]
    rows += [(100, "cookies", "b"), (101, None, "a"), (102, "", "a"), (103, "cookies", None)]
    rows += [(0, "own 0\ncookies\n\nown 0\nend", "a")]
    found = line_frequency.drop_boilerplate(frame(spark, rows), max_ratio=0.5)
    assert found.columns == [x.split()[0] for x in SCHEMA.split(", ")]
    by_id = defaultdict(list)
    for r in found.collect():
        by_id[r.doc_id].append(r)
    assert len(by_id[0]) == 2 and by_id[0][0].text == "own 0\n\nown 0"
    assert by_id[0][0].n_chars == len("own 0\n\nown 0")
    assert by_id[100][0].text == "cookies" and by_id[103][0].text == "cookies"
    assert by_id[101][0].text is None and by_id[102][0].text == ""
    assert line_frequency.drop_boilerplate(frame(spark, [])).count() == 0


def test_lines_of_a_hot_host(spark):
    rows = [(i, f"l{i % 7}\nx{i}\nfoot" if i % 3 else f"x{i}", f"h{0 if i % 3 else i}") for i in range(300)]
    found = {r.doc_id: r.text for r in line_frequency.drop_boilerplate(frame(spark, rows), max_ratio=0.1, min_pages=2).collect()}
    pages, lines = defaultdict(int), defaultdict(set)
    for i, text, host in rows:
        pages[host] += 1
        for line in text.split("\n"):
            lines[host, line].add(i)
    for i, text, host in rows:
        kept = [x for x in text.split("\n") if len(lines[host, x]) < 2 or len(lines[host, x]) <= 0.1 * pages[host]]
        assert found[i] == "\n".join(kept)


def test_extra_columns_of_any_type(spark):
    """A column of maps can be neither hashed nor compared."""
    text = "\n".join(["a line", "footer"])
    df = spark.createDataFrame([(i % 9, f"own {i}\n{text}", "s") for i in range(20)], "doc_id long, text string, source string")
    odd = df.withColumn("extra", F.create_map(F.lit("k"), F.col("doc_id")))
    assert line_frequency.drop_boilerplate(odd).count() == 20
    kept = near_dup.keep_first(odd)
    assert kept.columns == odd.columns and kept.count() == kept.select("doc_id").distinct().count()


def test_page_ratio_counts_copies(spark):
    rows = [(i, f"own {i}\nfooter", "a") for i in range(9)] + [(50 + i, "own 0\nfooter", "a") for i in range(10)] + [(99, "x", "a")]
    found = {r.row.doc_id: r.page_ratio for r in line_frequency.drop_lines(frame(spark, rows)).collect()}
    assert found[99] is None and found[0] == found[55] == 19 / 20


def test_copies_of_a_page_keep_their_lines(spark):
    """A third of a host's rows are one clean page; only the shared footer is boilerplate."""
    clean = "a clean page\nof three lines\nand no others"
    rows = [(i, f"own {i}\nmore {i}\nfooter", "a") for i in range(60)]
    rows += [(100 + i, clean, "a") for i in range(30)]
    found = {r.doc_id: r.text for r in line_frequency.drop_boilerplate(frame(spark, rows)).collect()}
    assert found == {i: f"own {i}\nmore {i}" if i < 60 else text for i, text, _ in rows}


# -- fingerprints ------------------------------------------------------------


def test_edited_texts_follow_the_order(spark):
    rows = [(i * 7 % 101, "é" * (i % 5) + f"{i}. b\nc. {i}") for i in range(101)]
    rows += [(None, "null id"), (5000, None), (5001, "")]
    found = {r.doc_id: r for r in merkle.edited_fingerprints(frame(spark, rows)).collect()}
    assert len(found) == len(rows)
    ordered = sorted(rows, key=lambda r: -(10**9) if r[0] is None else r[0], reverse=True)
    for (key, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        text, following = text or "", following or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        got = found[key]
        assert got.n_chars == len(text)
        assert got.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (got.near_edited == 1) == (edited == text) and 0 <= got.near_next <= 1
    assert merkle.edited_fingerprints(frame(spark, [])).collect() == []
    one = merkle.edited_fingerprints(frame(spark, [(1, "ab. cd")])).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"ab.ab.").hexdigest()


def test_trees_locate_edits(spark):
    paragraphs = [f"first {i}. second {i}" for i in range(30)]
    changed = [*paragraphs[:12], "new words", *paragraphs[13:]]
    df = spark.createDataFrame([("\n".join(paragraphs), "\n".join(changed))], "a string, b string")
    trees = merkle.with_tree(merkle.with_tree(df, "a", "x"), "b", "y")
    row = trees.select(
        merkle.differing("x", "y").alias("at"),
        merkle.differing("x", "x").alias("none"),
        merkle.likeness("x", "y").alias("near"),
        merkle.fingerprint("x").alias("print"),
    ).first()
    assert row.at == [12] and row.none == [] and 0.8 < row.near < 1
    leaf = hashlib.sha256(b"first 0").hexdigest()
    assert f":{leaf[:12]}," in row.print


def test_ranges_of_many_partitions(spark):
    """Thousands of ranges, hot ids and few rows: the plan holds the square root of them only."""
    rows = [(i % 37 if i % 3 else 5, f"{i}. b\nc") for i in range(400)] + [(None, "n"), (-(2**63), "least")]
    docs = frame(spark, rows).select("doc_id", "text")
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, ), reverse=True)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "20000")
        ids = spark.range(0, 50_000, 1, 4).selectExpr("id AS key", "'t' AS text", "id AS order")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        ranges = merkle.ranges_of(ids, 20_000)
        assert 15_000 <= ranges.count() <= 25_001
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    found = merkle.with_next(docs, "doc_id", "text").collect()
    assert len(found) == len(rows)
    followed = sorted((r.text, r.next) for r in found)
    texts = [t for _, t in sorted(rows, key=lambda r: (-(2**63) - 1 if r[0] is None else r[0], ), reverse=True)]
    assert sorted(t for t, _ in followed) == sorted(texts)
    # every text follows once, and the next one's id is not higher, but for the last
    assert sorted(n for _, n in followed) == sorted(texts)
    order = {t: -(2**63) if i is None else i for i, t in rows}
    assert sum(order[n] > order[t] for t, n in followed) == 1
    assert len(ordered) == len(rows)


def test_changed_paragraphs(spark):
    rng = random.Random(17)
    rows = [tuple("\n".join(rng.choice("abcd") for _ in range(rng.randrange(1, 9))) for _ in "ab") for _ in range(60)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "i int, a string, b string")
    trees = merkle.with_tree(merkle.with_tree(df, "a", "x"), "b", "y")
    found = merkle.with_changed(trees, "x", "y", "at").select("i", "at", merkle.differing("x", "y").alias("same")).collect()
    for r in found:
        a, b = (t.split("\n") for t in rows[r.i])
        assert r["at"] == [i for i, x in enumerate(a) if x not in b] == r["same"]


# -- archives ----------------------------------------------------------------


def test_archives_round_trip(spark, tmp_path):
    html = ["a", "b", "", "a", None, "é" * 9, "long" * 300_000, "a", "b"]
    rows = [(i, f"http://x/{i} y\n", h) for i, h in enumerate(html)] + [(7, "http://x/7", "a"), (None, None, "only null"), (None, "u", "a")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    archives, folder = warc.archive(pages.withColumn("digest", F.lit(1)))
    found = warc.read_archives(spark, archives, folder, "bigint").collect()
    groups = defaultdict(list)
    for page, _, text in rows:
        groups[text or ""].append(page)
    expected = []
    for page, _, text in rows:
        payload = (text or "").encode()
        top = max((p for p in groups[text or ""] if p is not None), default=None)
        refers = top if top is not None and page != top else None
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        expected.append((page, len(payload), digest, "response" if refers is None else "revisit", refers))
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(expected, key=key)


def test_normalised_members_stand_alone(spark):
    pages = spark.range(50).selectExpr("id AS page_id", "'u' AS url", "repeat(cast(id AS string), 500) AS html")
    archives, folder = warc.archive(pages)
    index = warc.read_index(spark, archives, folder).collect()
    assert len(index) == 50 and sum(r.records for r in archives.collect()) == 50
    for entry in index:
        with open(entry.file, "rb") as file:
            file.seek(entry.offset)
            member = gzip.decompress(file.read(entry.length))
        assert member.startswith(b"WARC/1.1\r\n") and member.endswith(b"\r\n\r\n")
        assert f"X-Page-ID: {entry.page_id}\r\n".encode() in member
    empty, place = warc.archive(pages.limit(0))
    assert warc.read_archives(spark, empty, place, "bigint").collect() == []


def test_names_of_object_stores():
    """Hadoop's schemes for the same store."""
    seen = []

    class Systems:
        @staticmethod
        def from_uri(uri):
            seen.append(uri)

    original, warc.fs = warc.fs, type("fs", (), {"FileSystem": Systems})
    try:
        for uri in ("s3a://bucket/a", "s3n://bucket/a", "s3://bucket/a", "file:/tmp/a", "hdfs://host:1/a"):
            warc.store(uri)
    finally:
        warc.fs = original
    assert seen == ["s3://bucket/a"] * 3 + ["file:///tmp/a", "hdfs://host:1/a"]


def test_small_payloads_are_all_responses(spark):
    pages = spark.createDataFrame([(1, "ab"), (2, "ab"), (3, "abcd"), (4, "abcd")], "page_id long, html string")
    archives, folder = warc.archive(pages, min_bytes=3)
    kinds = {r.page_id: r.record_type for r in warc.read_archives(spark, archives, folder, "bigint").collect()}
    assert kinds == {1: "response", 2: "response", 3: "revisit", 4: "response"}


# -- decontamination ---------------------------------------------------------


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def contamination_brute(documents, items, length):
    out = []
    for key, text in documents:
        w, hit, ids = words(text), set(), set()
        for item, passage in items:
            p = words(passage)
            size = min(length, len(p))
            for a in range(len(p) - size + 1 if p else 0):
                for b in range(len(w) - size + 1):
                    if w[b : b + size] == p[a : a + size]:
                        hit |= set(range(b, b + size))
                        ids.add(str(item))
        out.append((key, len(w), len(hit), tuple(sorted(ids)), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def test_contamination(spark):
    rng = random.Random(6)
    some = ["a", "B", "b", "É", "é", "x1", "the", "the"]
    text = lambda n: " ".join(rng.choice(some) for _ in range(n))
    items = [(i, text(rng.randrange(9))) for i in range(12)] + [(99, None), (98, ""), (97, "the")]
    documents = [(i, text(rng.randrange(40)) + "." + (items[i % 12][1] if i % 3 else "")) for i in range(60)]
    documents += [(7, documents[7][1]), (8, "another text of one id"), (None, "the"), (500, None), (501, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(frame(spark, documents), bench, length=4)
    got = [(r.document.id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in found.collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(contamination_brute(documents, items, 4), key=key)
    clean = decontaminate.keep_clean(frame(spark, documents), bench)
    assert clean.columns == frame(spark, documents).columns
    nothing = spark.createDataFrame([], "item_id long, text string")
    none = decontaminate.contamination(frame(spark, documents), nothing).collect()
    assert len(none) == len(documents) and not any(r.contaminated for r in none)
    assert decontaminate.contamination(frame(spark, []), bench).collect() == []


def test_proximity(spark):
    documents = [(1, "alpha x x beta x gamma"), (2, "gamma alpha beta"), (3, "alpha " + "x " * 30 + "beta gamma")]
    items = spark.createDataFrame([(1, "Alpha beta GAMMA")], "item_id long, text string")
    found = decontaminate.proximity(frame(spark, documents), items, within=6).collect()
    assert sorted((r.document.id, r.place) for r in found) == [(1, 0), (2, 0)]


def near_brute(documents, items, length):
    out = []
    for key, text in documents:
        w, ids = words(text), set()
        for item, passage in items:
            p = words(passage)
            size = min(length, len(p))
            for a in range(len(p) - size + 1 if p else 0):
                wanted = set(p[a : a + size])
                if any(wanted <= set(w[b : b + 2 * size]) for b in range(len(w))):
                    ids.add(str(item))
        out.append((key, tuple(sorted(ids))))
    return out


def test_near_matches_and_proximity_share_the_index(spark):
    rng = random.Random(16)
    some = [f"v{i}" for i in range(30)]
    text = lambda n: " ".join(rng.choice(some) for _ in range(n))
    items = [(i, text(rng.randrange(1, 9))) for i in range(15)]
    documents = [(i, text(rng.randrange(60))) for i in range(80)]
    for i in range(20):
        shuffled = words(items[i % 15][1])
        rng.shuffle(shuffled)
        documents.append((100 + i, text(5) + " " + " zz ".join(shuffled) + " " + text(5)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, documents)
    found = decontaminate.contamination(docs, bench, length=4)
    got = [(r.document.id, tuple(r.near_items)) for r in found.collect()]
    assert sorted(got) == sorted(near_brute(documents, items, 4))
    exact = decontaminate.contamination(docs, bench, length=4, nearly=False)
    names = ["document", "n_words", "n_hit", "items", "contaminated"]
    key = lambda r: str(r)
    assert sorted(exact.select(*names).collect(), key=key) == sorted(found.select(*names).collect(), key=key)
    assert all(r["near_items"] == r["items"] for r in exact.collect())
    stored = decontaminate.stored_index(docs, bench, length=4)
    known = sorted(r.term for r in stored.vocabulary.collect() if r.term.startswith("v"))
    asked = [(1, " ".join(known[:2])), (2, " ".join(known[2:5]))]
    asked = spark.createDataFrame(asked, "item_id long, text string")
    own = decontaminate.proximity(docs, asked, within=6).collect()
    assert sorted(own, key=key) == sorted(decontaminate.proximity(docs, asked, within=6, stored=stored).collect(), key=key)
    assert stored.lengths.count() == len(documents)


# -- quality -----------------------------------------------------------------


@pytest.fixture(scope="module")
def graded(spark):
    rng = random.Random(8)
    good = [f"w{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(900):
        bad = i % 5 == 0
        text = [rng.choice(good) for _ in range(60)]
        if bad:
            text[::12] = ["nasty"] * 5
        rows.append((i, " ".join(text)))
        if i % 2:
            labels.append((i, 1, int(bad)))
    return rows, labels


def test_importance_resampling_separates(spark, graded):
    rows, labels = graded
    rows = [*rows, (None, "w1 w2"), (5000, None), (5001, ""), (1, rows[1][1])]
    marks = spark.createDataFrame([*labels, (None, 1, 1), (3, None, 0)], "doc_id long, quality int, toxic int")
    kept = importance.keep_good(frame(spark, rows), marks)
    assert kept.columns == frame(spark, rows).columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None and i < 900) == sorted([i for i in range(900) if i % 5] + [1])
    assert {None, 5000, 5001} <= set(ids)
    assert importance.keep_good(frame(spark, []), marks).count() == 0
    assert importance.keep_good(frame(spark, rows), marks.limit(0)).count() == len(rows)


def test_tempering_is_fitted(spark):
    """No sharper than needed for the labelled good documents; 1 where the weights do."""
    near = [(i, i % 2 == 0, 1.0 if i % 2 == 0 else -2.0) for i in range(400)]
    far = [(i, g, w * 40) for i, g, w in near]
    schema = "id long, good boolean, log_weight double"
    found = [importance.tempering(spark.createDataFrame(rows, schema), 0.0) for rows in (near, far)]
    assert found[1] == 1 and 1 < found[0] <= importance.SHARPEST
    assert importance.tempering(spark.createDataFrame([], schema), 0.0) == 1


def test_inclusion_follows_the_weights(spark):
    """How often a document is drawn, over many seeds, against draws of numpy's generator."""
    many, k, seeds = 200, 60, 80
    weight = np.linspace(-4, 4, many)
    rows = [(i, f"t{i}", float(w)) for i, w in enumerate(weight)]
    df = spark.createDataFrame(rows, "id long, text string, log_weight double").withColumn("row", F.struct("text"))
    keyed = [importance.keys(df, seed).select("id", F.lit(seed).alias("seed"), "key") for seed in range(seeds)]
    whole = keyed[0]
    for part in keyed[1:]:
        whole = whole.union(part)
    keys = np.empty((seeds, many))
    for r in whole.collect():
        keys[r.seed, r.id] = r.key
    cut = np.sort(keys, axis=1)[:, -k, None]
    share = (keys >= cut).mean(0)
    noise = np.random.default_rng(3).gumbel(size=(4000, many)) + weight
    expected = (noise >= np.sort(noise, axis=1)[:, -k, None]).mean(0)
    blocks = lambda x: x.reshape(10, -1).mean(1)
    assert np.abs(blocks(share) - blocks(expected)).max() < 0.05
    # a weaker document is drawn now and then, a stronger one left out
    assert 0 < share[: many // 2].mean() < 0.2


def test_ngram_model_against_sets(spark, graded):
    rows, _ = graded
    tokens, expected = importance.Tokens(), defaultdict(int)
    for _, text in rows:
        for bucket in importance.ngrams(text, tokens).tolist():
            expected[bucket] += 1
    counted = importance.counts(frame(spark, rows).withColumn("good", F.lit(False)).repartition(5))
    assert {r.bucket: r.raw for r in counted.collect()} == expected


def test_kth_largest(spark):
    values = [0.5, -2.0, 3.0, 3.0, 8.0, -1e9, 7.5]
    df = spark.createDataFrame([(v,) for v in values], "key double")
    for k in range(1, len(values)):
        cut = importance.kth_largest(df, k, bins=3)
        assert sum(v >= cut for v in values) == (4 if k == 3 else k)


# -- near duplicates ---------------------------------------------------------


def shingle_brute(text, size):
    w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    size = min(size, len(w))
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if w else frozenset()


def groups_brute(rows, size=2):
    sets = [(k, shingle_brute(t, size)) for k, t in rows if k is not None]
    of = {k: k for k, _ in sets}

    def find(x):
        while of[x] != x:
            x = of[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                x, y = find(a), find(b)
                of[max(x, y)] = min(x, y)
    return {k: find(k) for k in of}


def test_near_duplicates(spark):
    rng = random.Random(9)
    base = [[f"w{rng.randrange(5000)}" for _ in range(80)] for _ in range(12)]
    rows = []
    for i in range(220):
        text = list(base[0] if i % 3 == 0 else rng.choice(base))
        for _ in range(rng.randrange(5)):
            text[rng.randrange(80)] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    rows += [(i + 300, rows[0][1].upper()) for i in range(80)]
    rows += [(600, "one"), (601, "ONE "), (602, ""), (603, None), (604, " \t"), (None, rows[0][1]), (5, rows[5][1])]
    rows += [(610, rows[3][1]), (610, "another text for the same id"), (611, "another text for the same id")]
    found = near_dup.find_near_duplicates(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    expected = groups_brute(rows)
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == expected[r.doc_id], r
            assert r.kept == (r.doc_id == r.component_id)
    sizes = {(r.doc_id, r.n_shingles) for r in found}
    assert {(600, 1), (602, 0), (603, 0), (0, len(shingle_brute(rows[0][1], 2)))} <= sizes
    kept = near_dup.keep_first(frame(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(set(expected.values()))
    assert near_dup.find_near_duplicates(frame(spark, [])).collect() == []


@pytest.mark.parametrize("size", [1 << 30, 4000])
def test_a_bucket_of_loose_copies_is_compared_whole(spark, size, monkeypatch):
    """Members that are not linked with a bucket's first one still meet each other."""
    monkeypatch.setattr(near_dup, "BLOCK_BYTES", size)
    rng = np.random.default_rng(2)
    hashing = shingles.MinHash(near_dup.BANDS * near_dup.ROWS)
    base = rng.integers(0, 1 << 62, 100, np.uint64)
    rows = []
    for i in range(24):
        changed = np.unique(np.append(base[: 100 - 3 * (i % 9)], rng.integers(0, 1 << 62, 3 * (i % 9), np.uint64)))
        rows.append((i, bytearray(hashing.signature(changed).tobytes()), bytearray(changed.tobytes())))
    sets = spark.createDataFrame(rows, "id long, signature binary, shingles binary")
    members = sets.select(F.lit(1).cast("long").alias("bucket"), F.lit(0).alias("band"), "id")
    none = spark.createDataFrame([], "a long, b long")
    found = near_dup.linked_components(sets, members, none, 80)
    values = {i: np.frombuffer(bytes(v), np.uint64) for i, _, v in rows}
    label = {i: i for i in values}
    for i in values:
        for j in values:
            if i != j and near_dup.similar(values[i], values[j], 80) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = {k: low if v == high else v for k, v in label.items()}
    assert len(set(label.values())) > 3
    assert {r.id: r.component for r in found.collect()} == label


def test_bounds_keep_similar_signatures():
    rng = np.random.default_rng(1)
    hashing = shingles.MinHash(160)
    sets = rng.integers(0, 1 << 62, (60, 200), np.uint64)
    left = np.stack([hashing.signature(s) for s in sets])
    close = np.stack([hashing.signature(np.concatenate([s[:182], rng.integers(0, 1 << 62, 18, np.uint64)])) for s in sets])
    far = np.stack([hashing.signature(np.concatenate([s[:60], rng.integers(0, 1 << 62, 140, np.uint64)])) for s in sets])
    assert near_dup.survives(left, close, 80, 32, 1e-6).all()
    assert near_dup.survives(left, far, 80, 32, 1e-6).mean() < 0.05


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1003, 1001)]
    links = spark.createDataFrame([(b, a) if a % 3 else (a, b) for a, b in chain], "a long, b long")
    found = {r.node: r.label for r in components.components(links).collect()}
    assert found == {**{i: 0 for i in range(201)}, **{i: 1000 for i in (1000, 1001, 1003)}}


# -- repeated bytes ----------------------------------------------------------


def repeats_brute(rows, length):
    seen, out = set(), {}
    for key, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        raw = (text or "").encode()
        marks = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            window = raw[i : i + length]
            if window in seen:
                marks[i : i + length] = b"\1" * length
            seen.add(window)
        spans = sum(1 for i, m in enumerate(marks) if m and (i == 0 or not marks[i - 1]))
        out[key] = (len(raw), sum(marks), spans, bytes(b for b, m in zip(raw, marks, strict=True) if not m))
    return out


@pytest.mark.parametrize("block", [1 << 20, 64])
def test_repeated_bytes(spark, block, monkeypatch):
    rng = random.Random(4)
    monkeypatch.setattr(suffix, "BLOCK", block)
    base = ["".join(rng.choice("ab") for _ in range(120)) for _ in range(4)]
    part = lambda: rng.choice([rng.choice(base)[rng.randrange(60) :][: rng.randrange(90)], rng.choice("abé"), "a" * rng.randrange(30)])
    rows = [(i, "".join(part() for _ in range(rng.randrange(8)))) for i in range(90)]
    rows += [(500 + i, rows[3][1]) for i in range(40)] + [(600, ""), (601, None), (602, "ab" * 200), (None, base[0])]
    found = suffix.remove_repeated(frame(spark, rows), length=12, gram=5).collect()
    expected = repeats_brute(rows, 12)
    assert len(found) == len(rows)
    for r in found:
        assert (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) == expected[r.doc_id]
    twice = suffix.remove_repeated(frame(spark, [rows[3], rows[3]]), length=12, gram=5).collect()
    assert len(twice) == 2 and twice[0] == twice[1]
    assert suffix.remove_repeated(frame(spark, [])).collect() == []


def test_repeated_rows_are_one_document(spark):
    """Copies of a row take nothing from each other; what starts earlier elsewhere still goes."""
    rng = random.Random(6)
    own, late, shared = ("".join(rng.choice("abcdefgh") for _ in range(n)) for n in (300, 250, 130))
    single = [(1, own), (2, own[:40] + shared), (3, late + shared), (None, late[::-1] + shared)]
    for rows in ([(1, own)] * 2, [(None, own)] * 2, [(1, own)] * 30 + single[1:3] * 3 + single[3:] * 2):
        found = suffix.remove_repeated(frame(spark, rows)).collect()
        expected = repeats_brute(rows=list(dict.fromkeys(rows)), length=suffix.LENGTH)
        assert len(found) == len(rows)
        for r in found:
            assert (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) == expected[r.doc_id]


def test_long_piece_lists_are_not_broadcast(spark, monkeypatch):
    """A single document's list may be long, so bytes decide, not the count of documents."""
    monkeypatch.setattr(suffix, "BROADCAST_BYTES", 10_000, raising=False)
    documents = frame(spark, [(1, "a"), (2, "b")]).select(*suffix.identity("doc_id", "text"))
    for many, forced in ((5, True), (1000, False)):
        places = spark.range(many).select(F.col("id").cast("int").alias("at"))
        wanted = documents.where("id = 1").select("id", "digest").crossJoin(places)
        joined = suffix.with_wanted(documents, wanted, "at")
        assert ("strategy=broadcast" in joined._jdf.queryExecution().analyzed().toString()) == forced
        assert [(r.id, r.text, len(r.wanted)) for r in joined.collect()] == [(1, "a", many)]


@pytest.mark.parametrize("hot, batch", [(3, 50), (10_000, 50), (3, 200_000)])
def test_hot_anchors_are_cut_into_windows(spark, hot, batch, monkeypatch):
    """A line that many documents share in different surroundings has a piece for each."""
    rng = random.Random(7)
    line = "".join(rng.choice("abcdefgh") for _ in range(40))
    own = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    rows = [(i, own(30) + line[: rng.randrange(25, 41)] + own(30)) for i in range(60)]
    rows += [(100 + i, rows[i][1][5:] + own(5)) for i in range(10)]
    monkeypatch.setattr(suffix, "HOT", hot)
    monkeypatch.setattr(suffix, "BATCH", batch)
    found = suffix.remove_repeated(frame(spark, rows), length=20, gram=8).collect()
    expected = repeats_brute(rows, 20)
    for r in found:
        assert (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) == expected[r.doc_id]


def test_copies_of_a_passage_are_spread(spark):
    """Of a piece that all rows repeat, only the first of each batch goes to the anchor's task."""
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefgh") for _ in range(400))
    rows = [(i, passage) for i in range(600)]
    documents = frame(spark, rows).select(*suffix.identity("doc_id", "text")).repartition(6)
    found = suffix.occurrences(documents, 100, 32)
    counted = found.groupBy("later").count().collect()
    each = {r.later: r["count"] for r in counted}
    assert each[True] + each[False] == 600 * (each[False] // 6) and each[False] <= 6 * 10


def test_windows_of_a_collection(tmp_path):
    rng = np.random.default_rng(3)
    pieces = [rng.integers(0, 3, n).astype(np.uint8) for n in (20, 30, 8, 25)]
    pieces.append(pieces[1].copy())
    raw = np.concatenate([np.append(p, 0) for p in pieces]).astype(np.uint8)
    lengths = np.array(list(map(len, pieces)))
    starts, groups = suffix.equal_windows(raw, lengths, 6, tmp_path)
    begins = np.cumsum(lengths + 1) - lengths - 1
    found = defaultdict(set)
    for at, group in zip(starts, groups, strict=True):
        found[group].add(int(at))
    expected = defaultdict(set)
    for begin, piece in zip(begins, pieces, strict=True):
        for i in range(len(piece) - 5):
            expected[piece[i : i + 6].tobytes()].add(int(begin) + i)
    assert sorted(map(sorted, found.values())) == sorted(sorted(x) for x in expected.values() if len(x) > 1)


def test_anchors_follow_content():
    """Equal windows have equal anchors at equal places, also across slices."""
    rng = np.random.default_rng(5)
    shared = rng.integers(97, 123, 300).astype(np.uint8)
    texts = [np.concatenate([rng.integers(97, 123, n).astype(np.uint8), shared]) for n in (50, 777)]
    sets = []
    for text in texts:
        hashes, _, at, start, end = suffix.anchors(text, 100, 32)
        # every window has one piece
        assert start[0] == 0 and end[-1] == len(text)
        assert (start[1:] == end[:-1] - 99).all() and (end - start <= 168).all()
        inner = end >= len(text) - 200
        sets.append({(int(h), int(a) - len(text)) for h, a in zip(hashes[inner], at[inner], strict=True)})
    assert sets[0] == sets[1] and sets[0]
