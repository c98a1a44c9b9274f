"""Prefix trie, ranked search and packing against brute force, with odd rows and hot groups."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfrank.llm import packing, prefix_trie, ranked_search
from shelfrank.llm.byte_bpe import VOCABULARY, ids_of
from shelfrank.llm.shared import table

# -- prefix trie -------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, node string, depth int, last long"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], TURNS)


def trie_brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[conv].append((turn is not None, turn or 0, digest, (role, text)))
    own = {c: [x[3] for x in sorted(turns)] for c, turns in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children, leaves, saved = Counter(x[:-1] for x in members if x), Counter(), Counter()
    for x, of in members.items():
        for d in range(len(x) + 1):
            leaves[x[:d]] += not children[x]
            saved[x[:d]] += (len(of) - 1) * len(x[-1][1].encode()) if x else 0
    out = []
    for x, of in members.items():
        ends = ",".join(str(c) for c in sorted(of) if paths[c] == x)
        parent = min(members[x[:-1]]) if x else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(of), len(x), parent, len(of), children[x], leaves[x], saved[x], digest))
    return sorted(out, key=str)


def trie(spark, rows, **settings):
    found = prefix_trie.prefix_trie(conversations(spark, rows), **settings)
    assert found.columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    ]
    return sorted(map(tuple, found.collect()), key=str)


def odd_conversations():
    draw = random.Random(11)
    rows = [(c, t, draw.choice("ab"), f"é{draw.randrange(2)}") for c in range(60) for t in range(c % 12)]
    # copies of one conversation, one first turn, one endless conversation and its copy
    rows += [(c, t, "user", f"copy {t}") for c in range(1000, 1080) for t in range(4)]
    rows += [(c, 0, "system", "the same") for c in range(2000, 2060, 5)]
    rows += [(c, 1, "user", f"own {c}") for c in range(2000, 2060, 5)]
    rows += [(c, t, "user", f"{t % 3}") for c in (5000, 5005) for t in range(150)]
    rows += [(None, 0, "user", "nobody's"), (7000, None, None, None), (7000, 0, "", ""), (7000, 0, "", "")]
    rows += [(7005, 1, None, "x" * 100_000), (7005, None, "user", ""), (7005, 2**40, "a", "b")]
    return rows


@pytest.mark.parametrize("light", [None, 3])
def test_trie(spark, light, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 64)
    rows = odd_conversations()
    assert trie(spark, rows, light=light) == trie_brute(rows)


def test_trie_of_little(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 1, "a", "b")]) == []
    # its checksum takes away the only turn, and the group has no first conversation
    lonely = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9)
    rows = [(lonely, 1, "a", "b")]
    assert trie(spark, rows) == trie_brute(rows) and len(trie_brute(rows)) == 1


def test_slots_are_minimal_and_verified():
    keys = np.random.default_rng(1).integers(0, 2**64, (5000, 2), np.uint64)
    slots = prefix_trie.NodeSlots(keys[:4000])
    assert sorted(slots.slots) == list(range(4000))
    assert (slots.find(keys[:4000]) == slots.slots).all()
    assert (slots.find(keys[4000:]) == -1).all()
    assert len(prefix_trie.NodeSlots(keys[:0]).find(keys)) == 5000


def test_different_turns_of_one_digest_are_an_error(spark):
    rows = [(1, 1, 1, 1, 5, 1, 1), (2, 1, 1, 1, 6, 1, 1)]
    steps = spark.createDataFrame(
        rows, "conv long, depth long, node long, parent long, turn_digest long, bytes long, rows long"
    ).withColumns({"last": F.lit(1), "bytes_below": F.lit(1)})
    steps = steps.withColumns({x: F.encode(F.col(x).cast("string"), "utf-8") for x in ("node", "parent")})
    convs = spark.createDataFrame([(1, 1), (2, 1)], "conv long, length long")
    with pytest.raises(Exception, match="two prefixes share a digest"):
        prefix_trie.nodes_of(steps, convs).collect()


def test_a_hot_conversation_meets_in_no_task(spark):
    """Rows dealt to shards and to the table above them, with half of all rows in copies."""
    rows = [(c, t, "user", f"copy {t}") for c in range(0, 2000, 5) for t in range(6)]
    rows += [(c, t, "user", f"{c} {t}") for c in range(5000, 7000, 5) for t in range(6)]
    steps, convs = prefix_trie.rebuilt(prefix_trie.turns(conversations(spark, rows)))
    nodes = prefix_trie.nodes_of(prefix_trie.paths(steps), convs)
    heavy = nodes.where("rows > 50")
    assert heavy.count() == 7 and heavy.where("NOT alike").count() == 1


# -- ranked search -----------------------------------------------------------

DOCS = "doc_id long, text string, n int, term string, score long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or ""))


def search_brute(docs, items, top=10):
    tokens = [(doc, Counter(words(text))) for doc, text in docs]
    tokens = [(doc, c) for doc, c in tokens if c]
    df = Counter(t for _, c in tokens for t in c)
    n, total, out = len(tokens), sum(sum(c.values()) for _, c in tokens), []
    for item, text in set(items):
        scored = []
        for doc, c in tokens:
            m = 100 - 75 + (75 * sum(c.values()) * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in words(text) if t in c
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        scored.sort(key=lambda x: x[:3])
        out += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(scored[:top], 1)]
    return sorted(out, key=str)


def found_by_search(spark, docs, items, **settings):
    documents = spark.createDataFrame([(*d, 1, "clash", 2) for d in docs], DOCS)
    asked = spark.createDataFrame([(*i, 1, "clash", 2) for i in items], DOCS.replace("doc_id", "item_id"))
    found = ranked_search.search(documents, asked, **settings)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=str)


def odd_texts():
    draw = random.Random(12)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "ß", "K", "K", "x" * 3000]
    text = lambda: draw.choice(" -.\n").join(draw.choices(vocabulary, k=draw.randrange(1, 30)))
    docs = [(i, text()) for i in range(200)]
    docs += [(1000 + i, "w1 W1 w2") for i in range(100)]  # copies: equal scores
    docs += [(None, "w1 w2 w3"), (None, None), (7, ""), (8, "..."), (0, docs[0][1]), (0, "w1"), (9, "w5 " * 5000)]
    items = [(i, text()) for i in range(30)] + [(30, "w1 w2 w3 w1"), (31, "w1 w2 w3 w4 W1")]
    items += [(None, "w5"), (32, None), (33, ""), (34, "nowhere"), (35, "w1 w2"), (35, "w1 w2"), (35, "w9")]
    return docs, items


def test_search(spark, monkeypatch):
    docs, items = odd_texts()
    assert found_by_search(spark, docs, items) == search_brute(docs, items)
    assert found_by_search(spark, docs, items, block_terms=50) == search_brute(docs, items)
    assert found_by_search(spark, [], items) == [] and found_by_search(spark, docs, []) == []


def test_texts_are_read_in_parts(monkeypatch):
    text = "ab Cd-é9 " * 500
    whole = ranked_search.term_counts(text)
    monkeypatch.setattr(ranked_search, "PART_BYTES", 7)
    assert len(list(ranked_search.terms(text))) > 100
    assert ranked_search.term_counts(text) == whole == Counter(x.encode() for x in words(text))


def test_shared_term_sets_are_added_once():
    common = [f"c{i}".encode() for i in range(20)]
    items = [Counter([*common, f"own{i}".encode(), b"twice", b"twice"]) for i in range(50)]
    sharing = ranked_search.SharedSums(items)
    once, without = sharing.additions()
    assert without == 50 * 21 and once < 50 * 2 + 30
    single = np.random.default_rng(2).integers(0, 1000, (len(sharing.vocabulary), 7))
    place = {t: i for i, t in enumerate(sharing.vocabulary)}
    expected = [sum(n * single[place[t]] for t, n in item.items()) for item in items]
    assert (sharing.scores(single) == np.array(expected)).all()


# -- packing -----------------------------------------------------------------


def packed(spark, rows, **settings):
    schema = "doc_id long, text string, piece string, length string, part int"
    documents = spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], schema).repartition(3)
    found = packing.pack(documents, **settings)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return found.collect()


def check_sequences(found, size):
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= size
    return len(sequences)


def expected_pieces(rows, size):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    out = []
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        first, start, piece = (len(ids) - 1) % size + 1, 0, 0
        while start < len(ids):
            stop = first if not start else start + size
            crc = zlib.crc32(b"".join(struct.pack("<I", x) for x in ids[start:stop]))
            out.append((doc, piece, start, stop - start, crc))
            start, piece = stop, piece + 1
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [16, 64])
def test_pack(spark, size):
    draw = random.Random(13)
    rows = [(i, " ".join(draw.choices(["one", "two,", "dré", "4"], k=draw.randrange(60)))) for i in range(300)]
    rows += [(1000 + i, "a copy of a text") for i in range(150)]
    rows += [(None, "null id"), (7, None), (8, ""), (8, ""), (9, "long " * 1000), (10, "<|endoftext|>")]
    found = packed(spark, rows, size=size)
    assert sorted((tuple(r)[:5] for r in found), key=str) == expected_pieces(rows, size)
    count = check_sequences(found, size)
    assert count <= 1.02 * sum(r.length for r in found) / size + 2
    assert packed(spark, []) == []


def test_whole_table(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    found = packing.pack(documents).collect()
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert sorted((tuple(r)[:5] for r in found), key=str) == expected_pieces(rows, 2048)
    assert check_sequences(found, 2048) <= math.ceil(sum(r.length for r in found) / 2048) + 1


def test_two_documents_replace_the_smallest():
    """Greedy fills 60 + 30 and leaves 10; 60 + 25 + 15 leaves nothing."""
    lengths = packing.Lengths({60: 1, 30: 1, 25: 1, 15: 1}, 100)
    inside, gap = lengths.filled()
    assert (inside, gap) == ({60: 1, 30: 1}, 10)
    assert lengths.tightened(inside, gap) == ({60: 1, 25: 1, 15: 1}, 0)
    # the only two of a length may both be taken, one alone can't be taken twice
    assert packing.Lengths({60: 1, 30: 1, 20: 2}, 100).tightened({60: 1, 30: 1}, 10)[0] == {60: 1, 20: 2}
    assert packing.Lengths({60: 1, 30: 1, 20: 1}, 100).tightened({60: 1, 30: 1}, 10)[1] == 10


def test_kinds_of_bins_are_bounded():
    draw = random.Random(14)
    for size in (7, 64, 300):
        for top in (1, 3, 1000, 10**12):
            # longer ones may have no partner, whatever the packing
            longest = size if size == 7 else size // 2
            counts = {x: draw.randrange(1, top + 1) for x in range(1, longest + 1) if draw.random() < 0.7}
            slots = packing.best_two_fit(counts, size)
            assert len(slots) <= packing.most_slots(size)
            made = Counter()
            for length, first, count, times, _, _ in slots:
                assert first == made[length]
                made[length] += count * times
            assert made == counts
            bins = max((s[4] + s[3] for s in slots), default=0)
            if size > 7:  # lengths of a few can't always fill a bin
                assert bins <= 1.02 * sum(k * n for k, n in counts.items()) / size + 12


def test_ids_are_those_of_the_library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    draw = random.Random(15)
    alphabet = "abcdefgh  \n\t'stll0123456789.,é漢字🙂  <|>\x00"
    for _ in range(500):
        text = "".join(draw.choices(alphabet, k=draw.randrange(80)))
        own = np.frombuffer(ids_of(text, VOCABULARY), "<u4").tolist()
        assert own == tokenizer.encode(text, add_special_tokens=False).ids
