"""Operators that work on each text by itself, against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from shelfrank.llm import boosting, byte_bpe, pii, secret_scan

ODD = [
    (None, "null id: a.b@c.de"),
    (1, None),
    (2, ""),
    (3, "x" * 200_000),
    (4, "1" * 50_000),
    (5, "mail me@example.org or +1 (555) 123-4567, 10.0.0.1"),
    (5, "mail me@example.org or +1 (555) 123-4567, 10.0.0.1"),
    (6, "token = abcdef123456 and AKIA" + "Q" * 16 + " " + "0a" * 20),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(a, b, "clash", 1) for a, b in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string, n_tokens int")


def pii_brute(text):
    found = []
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    for kind, pattern in patterns.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((kind, *m.span()))
    return sorted(found)


def test_personal_data_base_formats():
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice("11250a.b@+-- ()é%4.\n") for _ in range(rng.randrange(60)))
        assert pii_brute(text) == sorted(pii.base_spans(text)), text


def test_personal_data_held_out():
    """The trees find nearly all personal spans of another seed and few harmless ones."""
    texts, marks = pii.labelled(2000, seed=99)
    trees, thresholds = pii.model()
    score = trees.score(np.array([pii.features(*t) for t in texts], float))
    taken = np.array([s >= thresholds[t[1][0]] for s, t in zip(score, texts, strict=True)])
    marks = np.array(marks)
    assert marks[taken].mean() > 0.97 and taken[marks].mean() > 0.9


def test_more_spans_never_cover_base_ones():
    text = "SSN 123-45-6789, my phone number is 555-123-4567, write to joe [at] home [dot] org, +1 (555) 123-4567"
    spans = pii.scan(text)[5]
    kinds = [s.split(":")[0] for s in spans.split(",")]
    assert kinds == ["identity", "local_phone", "spelled_email", "phone"]
    edges = [tuple(map(int, s.split(":")[1:])) for s in spans.split(",")]
    assert all(a[1] <= b[0] for a, b in zip(edges, edges[1:], strict=False))
    assert pii.redact(text, spans).startswith("SSN [identity], my phone number is [local_phone]")


def planted_cards(spark, sf_dir, seed):
    """Texts of the table with a number of 16 digits each, and whether it is a card."""
    rng = random.Random(seed)
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect() if r.text]
    out = []
    for i in range(300):
        own = rng.choice(texts)[:3000]
        digits = "".join(rng.choice("0123456789") for _ in range(15))
        check = [c for c in "0123456789" if pii.luhn(digits + c) == (i % 2 == 0)]
        at = rng.randrange(len(own) + 1)
        at = own.find(" ", at) + 1 or len(own)
        out.append((f"{own[:at]} {digits}{rng.choice(check)} {own[at:]}", i % 2 == 0))
    return out


def test_personal_data_in_held_out_documents(spark, sf_dir):
    """Trained on spans of documents: precision and recall by kind on other documents."""
    fit, held = planted_cards(spark, sf_dir, 1), planted_cards(spark, sf_dir, 2)
    table = spark.createDataFrame([(t,) for t, _ in fit], "text string")
    x, y, kinds = pii.document_spans(table, "text")
    assert {"number"} <= set(kinds) and 100 < y.sum() < len(y) - 100
    assert len(pii.document_spans(table, "text", each=5)[1]) <= 5 * 2 * len(pii.MORE_KINDS)
    trees, thresholds = known = pii.fitted(pii.TRAINING_SPANS, (x, y, kinds))
    found = [(t, span, good) for t, _ in held for span, good in pii.labelled_spans(t) if span[0] == "number"]
    score = trees.score(np.array([pii.features(t, span) for t, span, _ in found], float))
    good = np.array([g for *_, g in found])
    taken = score >= thresholds["number"]
    assert good[taken].mean() >= 0.97 and taken[good].mean() >= 0.9
    # the generated spans are still told apart
    texts, marks = pii.labelled(2000, seed=99)
    score = trees.score(np.array([pii.features(*t) for t in texts], float))
    taken = np.array([s >= thresholds[t[1][0]] for s, t in zip(score, texts, strict=True)])
    marks = np.array(marks)
    assert marks[taken].mean() > 0.97 and taken[marks].mean() > 0.9
    # two cards with a blank between are one run that the base format drops
    card = next(t.split()[-1] for t, g in [("4111111111111111", True)])
    spans = pii.scan(f"paid with {card} {card} today", known)[5]
    assert [s.split(":", 1)[1] for s in spans.split(",")] == ["10:26", "27:43"]
    grouped = "4111 1111 1111 1111"
    spans = pii.scan(f"paid with {grouped} {grouped} today", known)[5]
    assert [s.split(":", 1)[1] for s in spans.split(",")] == ["10:29", "30:49"]


def test_threshold_is_calibrated():
    score = np.array([0.1, 0.2, 0.3, 0.4, 0.5])
    assert boosting.calibrated_threshold(score, np.array([0, 1, 0, 1, 1]), 0.9) == 0.4
    assert boosting.calibrated_threshold(score, np.zeros(5), 0.9) == np.inf


def test_personal_data_rows(spark, odd):
    rows = pii.find_personal_data(odd).collect()
    assert len(rows) == len(ODD)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[None].n_email == 1 and by_id[1].spans == "" and by_id[4].n_card == 0
    assert (by_id[5].n_email, by_id[5].n_phone, by_id[5].n_ip) == (1, 1, 1)
    assert pii.find_personal_data(odd.limit(0)).collect() == []


def secret_brute(text):
    keyword = "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    found = [("assign", *m.span()) for m in re.finditer(keyword + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[1]) >= 6]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_secret_base_formats():
    rng = random.Random(5)
    parts = ["token", "PASSWD", "apiKey", "api_key", "ſecret", "secret", " ", "=", ":", '"', "'", "abc", "0f" * 13, "AKIA", "Z9" * 9, "\n", "x.y"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        assert secret_brute(text) == sorted(secret_scan.base_spans(text)), text


def test_random_strings_and_their_exceptions():
    key = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY9"
    assert secret_scan.random_spans(f"use {key} here") == [("random", 4, 4 + len(key))]
    for harmless in (
        "d41d8cd98f00b204e9800998ecf8427e",
        "123e4567-e89b-12d3-a456-426614174000",
        "sha256-47DEQpj8HBSa1TImW5JCeuQeRkm5NMpJWZG3hSuFU1=",
        "my_long_variable_name_2024_final",
        "internationalisation" * 3,
        "-" * 60,
    ):
        assert secret_scan.random_spans(f"see {harmless} here") == []


def test_random_strings_after_an_equals_sign():
    key = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY9"
    for before in ("access_key=", "https://a.example/b?sig=", "AWS_SECRET_ACCESS_KEY_OF_THE_SITE_2=", "x=="):
        text = f"{before}{key}== end"
        assert secret_scan.random_spans(text) == [("random", len(before), len(before) + len(key) + 2)]
    for harmless in ("name=my_long_variable_name_2024_final", "md5=d41d8cd98f00b204e9800998ecf8427e"):
        assert secret_scan.random_spans(harmless) == []


def test_base32_keys_are_no_identifiers():
    rng = random.Random(8)
    for size, least in ((20, 0.95), (32, 0.99)):
        keys = ["".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(size)) for _ in range(1000)]
        assert sum(secret_scan.random_spans(f"use {key} here") != [] for key in keys) >= least * len(keys)
    for harmless in ("SHA256_RSA2048_OAEP_KEY", "Base64EncoderForUtf8Strings", "libraries/2024/version12"):
        assert secret_scan.known(harmless)
    # of a lower-case run that is no identifier every split into words was tried
    assert not secret_scan.known("a" * 100_000 + "B9c")


def test_random_letters_alone_are_found():
    """The token ratio decides, not the kinds of characters; words of prose have another."""
    rng = random.Random(12)
    lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    for letters in (lower, upper, lower + upper, lower + upper + "0123456789"):
        keys = ["".join(rng.choice(letters) for _ in range(size)) for size in (20, 24, 32, 40) for _ in range(200)]
        found = sum(secret_scan.random_spans(f"use {key} here") != [] for key in keys)
        assert found >= 0.93 * len(keys)
    for word in ("donaudampfschifffahrtsgesellschaft", "antidisestablishmentarianism", "internationalization-and-localization"):
        assert secret_scan.random_spans(f"a {word} b") == []


def test_keys_planted_in_documents(spark, sf_dir):
    rng = random.Random(13)
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect() if r.text]
    found = added = 0
    for text in texts:
        before = secret_scan.random_spans(text)
        added += len(before)
        key = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") for _ in range(32))
        after = secret_scan.random_spans(f"{text} {key} {text[:50]}")
        found += ("random", len(text) + 1, len(text) + 33) in after
    assert found >= 0.98 * len(texts) and added <= 0.01 * len(texts)


def test_secret_rows(spark, odd):
    rows = secret_scan.find_secrets(odd).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == len(ODD) and by_id[1].spans == ""
    assert (by_id[6].n_assign, by_id[6].n_access, by_id[6].n_hex) == (1, 1, 1)
    assert secret_scan.find_secrets(odd.limit(0)).collect() == []


def test_long_texts_encode_as_the_library_does(spark):
    rng = random.Random(1)
    bits = ["a", "b'll", " ", "  ", "\n", "é", "1", "'s", "!!", "漢", "\U0001f600"]
    texts = [None, "", "a" * 500, "x" * 40 + " " * 30 + "don't we'll   \n\n é" * 9]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randrange(200))) for _ in range(60)]
    rows = [(i or None, t, 7) for i, t in enumerate(texts)] + [(3, texts[3], 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    both = byte_bpe.encode(df, chunk=24, overlap=10, decoded=True)
    again = byte_bpe.decode(both.drop("decoded")).select("n_tokens", "ids", "decoded")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, both.drop("doc_id").collect()))
    found = both.collect()
    assert len(found) == len(rows) and sum(r.doc_id == 3 for r in found) == 2
    library = byte_bpe.encoding(byte_bpe.VOCABULARY)
    for row in found:
        text = texts[row.doc_id or 0] or ""
        ids = np.array(library.encode_ordinary(text), "<u4").tobytes()
        assert (bytes(row.ids), bytes(row.decoded)) == (ids, text.encode())
        assert row.n_tokens == len(ids) // 4
    assert byte_bpe.encode(df.limit(0)).collect() == []


def test_an_endless_word_takes_time_in_proportion():
    chunk, overlap, count = 4096, 64, 3000
    text = "a" * (chunk * count)
    asked = []

    class Counted:
        def finditer(self, own, start=0, stop=None):
            asked.append((len(own) if stop is None else stop) - start)
            return whole.finditer(own, start) if stop is None else whole.finditer(own, start, stop)

    whole, byte_bpe.pattern = byte_bpe.pattern(), lambda: Counted()
    try:
        heads, tails = [[] for _ in range(count)], [[] for _ in range(count)]
        assert byte_bpe.stitch(text, heads, tails, chunk, overlap) == [0]
    finally:
        byte_bpe.pattern = lambda: whole
    assert sum(asked) <= len(text)


def test_stitches_are_true_boundaries():
    rng = random.Random(2)
    bits = ["a", "b'll", " ", "   ", "\n\n", "é", "12", "'s", "!!"]
    for _ in range(300):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(20, 150)))
        chunk, overlap = 24, 10
        count = -(-len(text) // chunk)
        bounds = [
            byte_bpe.chunk_bounds(text[p * chunk : (p + 1) * chunk + overlap], p + 1 == count, chunk, overlap)
            for p in range(count)
        ]
        starts = byte_bpe.stitch(text, [b[0] for b in bounds], [b[1] for b in bounds], chunk, overlap)
        assert set(starts) <= {m.start() for m in byte_bpe.pattern().finditer(text)} | {0}


def test_query_texts_equal_the_library(spark, sf_dir):
    from shelfrank.llm import queries

    library = byte_bpe.encoding(byte_bpe.VOCABULARY)
    found = {r.doc_id: r for r in queries.op6_overlapping_chunks(spark, sf_dir).collect()}
    for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = np.array(library.encode_ordinary(row.text), "<u4").tobytes()
        assert found[row.doc_id].ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert found[row.doc_id].decoded_sha256 == hashlib.sha256(row.text.encode()).hexdigest()
