"""The operators' queries over whole tables, and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.llm import (
    byte_bpe,
    decontaminate,
    importance,
    line_frequency,
    merkle,
    near_dup,
    packing,
    pii,
    prefix_trie,
    ranked_search,
    secret_scan,
    suffix,
    warc,
)
from shelfrank.llm.shared import table


def op1_candidate_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op2_merkle_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edited_fingerprints(table(spark, sf_dir, "documents"))


def op3_site_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_frequency.drop_lines(table(spark, sf_dir, "documents"))
    return done.select(
        F.col("row.doc_id"),
        "n_lines",
        "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
        "page_ratio",
    )


def op4_gzip_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    archives, folder = warc.archive(pages)
    return warc.read_archives(spark, archives, folder, dict(pages.dtypes)["page_id"])


def op5_token_efficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


def op6_overlapping_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), decoded=True)
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contamination(documents, items).select(
        F.col("document.id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
        F.size("near_items").cast("long").alias("n_near"),
    )


def op8_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    drawn = importance.sample(documents, labels, keep_rows=False)
    return drawn.select(F.col("row.doc_id"), "log_weight", "above", "kept", "sharpness")


def op9_bayesian_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.find_near_duplicates(table(spark, sf_dir, "documents"))


def op10_column_bwt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeated(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op11_hash_slot_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_shared_accumulators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}


# a text's tree as a macro-free expression, for the columns named in OP2_TEXTS
OP2_TREE = """
{name}_leaves AS (
    SELECT *, list_transform(string_split({name}, chr(10)), lambda p:
        list_transform(string_split(p, '. '), lambda s: sha256(s))) AS {name}_l FROM {source}
), {name}_paragraphs AS (
    SELECT *, list_transform({name}_l, lambda x: sha256(array_to_string(x, ','))) AS {name}_p
    FROM {name}_leaves
), {name}_sections AS (
    SELECT *, list_transform(string_split(regexp_replace(array_to_string(list_transform({name}_p,
        lambda x: x || CASE WHEN x[1] IN ('0', '1', '2', '3') THEN ';' ELSE ',' END), ''),
        '[,;]$', ''), ';'), lambda s: sha256(s)) AS {name}_s
    FROM {name}_paragraphs
), {name}_tree AS (
    SELECT *, sha256(array_to_string({name}_s, ',')) AS {name}_root,
        list_distinct(list_transform(flatten([{name}_s, {name}_p, flatten({name}_l)]),
            lambda x: x[1:12])) AS {name}_b,
        sha256(array_to_string({name}_s, ',')) || '|'
        || array_to_string(list_transform({name}_s, lambda x: x[1:12]), ',') || '|'
        || array_to_string(list_transform(list_zip({name}_p, {name}_l), lambda z: z[1][1:12] || ':'
            || array_to_string(list_transform(z[2], lambda x: x[1:12]), ',')), ';') AS {name}_print
    FROM {name}_sections
)"""
OP2_LIKE = """CASE WHEN own_root = {other}_root THEN 1.0::DOUBLE ELSE
    2.0::DOUBLE * len(list_intersect(own_b, {other}_b)) / (len(own_b) + len({other}_b)) END"""
OP2_SQL = (
    """
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS own FROM documents
), ordered AS (
    SELECT *, coalesce(lead(own) OVER (ORDER BY doc_id DESC),
                       first_value(own) OVER (ORDER BY doc_id DESC)) AS following,
           length(own) AS n, length(own) // 2 AS half
    FROM texts
), edits AS (
    SELECT *, own[1:n - half] || following[1:half] AS changed FROM ordered
), """
    + ", ".join(
        OP2_TREE.format(name=name, source=source)
        for name, source in (("own", "edits"), ("changed", "own_tree"), ("following", "changed_tree"))
    )
    + f"""
SELECT doc_id, n::BIGINT AS n_chars, sha256(changed) AS edited_sha256, own_print AS fingerprint,
       changed_print AS edited_fingerprint, {OP2_LIKE.format(other="changed")} AS near_edited,
       {OP2_LIKE.format(other="following")} AS near_next,
       array_to_string(list_filter(list_transform(range(1, len(changed_p) + 1), lambda i:
           CASE WHEN NOT list_contains(list_transform(own_p, lambda x: x[1:12]), changed_p[i][1:12])
                THEN (i - 1)::VARCHAR END), lambda x: x IS NOT NULL), ',') AS changed
FROM following_tree
"""
)

OP3_SQL = """
WITH texts AS (
    SELECT source, text, count(*) AS copies, row_number() OVER () AS page
    FROM documents WHERE source IS NOT NULL GROUP BY source, text
), found AS (
    SELECT DISTINCT page, source, copies, unnest(string_split(text, chr(10))) AS line FROM texts
), totals AS (
    SELECT source, count(*) AS texts, sum(copies) AS pages FROM texts GROUP BY source
), bad AS (
    SELECT source, line, sum(copies)::DOUBLE / any_value(pages) AS page_ratio
    FROM found JOIN totals USING (source)
    WHERE trim(line) <> ''
    GROUP BY source, line
    HAVING count(*) >= 5 AND count(*) > any_value(totals.texts) * 0.08
), listed AS (
    SELECT source, list(line) AS bad, map(list(line), list(page_ratio)) AS ratios
    FROM bad GROUP BY source
), done AS (
    SELECT doc_id, string_split(text, chr(10)) AS all_lines, coalesce(bad, []) AS bad, ratios,
           list_filter(string_split(text, chr(10)),
                       lambda x: NOT list_contains(coalesce(bad, []), x)) AS kept
    FROM documents LEFT JOIN listed USING (source)
)
SELECT doc_id,
       coalesce(len(all_lines), 0)::BIGINT AS n_lines,
       coalesce(len(all_lines) - len(kept), 0)::BIGINT AS n_dropped,
       sha256(coalesce(array_to_string(kept, chr(10)), '')) AS kept_sha256,
       list_max(list_transform(list_filter(all_lines, lambda x: list_contains(bad, x)),
                               lambda x: ratios[x])) AS page_ratio
FROM done
"""


OP4_SQL = """
WITH payloads AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
           sha1(coalesce(html, '')) AS hex
    FROM pages
), originals AS (
    SELECT hex, max(page_id) AS original FROM payloads GROUP BY hex
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr(
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           (1 + (((instr('0123456789abcdef', substr(hex, (5 * i // 4 + 1)::BIGINT, 1)) - 1) * 16
            + instr('0123456789abcdef', substr(hex, (5 * i // 4 + 2)::BIGINT, 1)) - 1)
            // (1 << (3 - (5 * i) % 4)::INT)) % 32)::BIGINT, 1)), '') AS payload_digest,
       CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to
FROM payloads JOIN originals USING (hex)
"""

OP7_SQL = r"""
WITH docs AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents
), items AS (
    SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark
), item_windows AS (
    SELECT item_id, least(len(w), 13) AS size,
           unnest(list_transform(range(greatest(len(w) - 12, 1)),
               lambda i: array_to_string(w[i + 1:i + 13], ' '))) AS win
    FROM items WHERE len(w) > 0
), sizes AS (
    SELECT DISTINCT size FROM item_windows
), doc_windows AS (
    SELECT doc_id, size, s AS start, array_to_string(w[s + 1:s + size], ' ') AS win
    FROM (SELECT doc_id, w, size, unnest(range(len(w) - size + 1)) AS s
          FROM docs, sizes WHERE len(w) >= size)
), hits AS (
    SELECT doc_id, start, size, item_id FROM doc_windows JOIN item_windows USING (size, win)
), hit_words AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(start, start + size)) AS place FROM hits) GROUP BY doc_id
), hit_items AS (
    SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM hits GROUP BY doc_id
), wanted AS (
    SELECT item_id, win, size, len(list_distinct(string_split(win, ' '))) AS n,
           unnest(list_distinct(string_split(win, ' '))) AS word
    FROM (SELECT DISTINCT item_id, size, win FROM item_windows)
), placed AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS place FROM docs
), having_all AS (
    SELECT doc_id, item_id, win FROM (SELECT DISTINCT doc_id, word FROM placed) JOIN wanted USING (word)
    GROUP BY doc_id, item_id, win HAVING count(*) = any_value(n)
), spots AS (
    SELECT doc_id, item_id, win, n, 2 * size AS span, word, place, place // 26 AS block
    FROM having_all JOIN wanted USING (item_id, win) JOIN placed USING (doc_id, word)
), near AS (
    SELECT DISTINCT doc_id, item_id FROM (
        SELECT a.doc_id, a.item_id, a.win, a.place
        FROM (SELECT *, unnest([block, block + 1]) AS b FROM spots) a
        JOIN spots c ON c.doc_id = a.doc_id AND c.item_id = a.item_id AND c.win = a.win AND c.block = a.b
            AND c.place >= a.place AND c.place < a.place + a.span
        GROUP BY a.doc_id, a.item_id, a.win, a.place
        HAVING count(DISTINCT c.word) = any_value(a.n))
), near_items AS (
    SELECT doc_id, count(*) AS n_near FROM near GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(len(ids), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
       coalesce(n_near, 0)::BIGINT AS n_near
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
LEFT JOIN near_items USING (doc_id)
"""

OP11_SQL = """
WITH turns AS (
    SELECT conv_id AS c, octet_length(encode(coalesce(text, ''))) AS bytes,
           sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '')
                  || coalesce(text, '')) AS turn_digest, turn
    FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, turn_digest) - 1 AS place
    FROM turns
), sizes AS (
    SELECT c, count(*) AS n, c - c % 5 AS base, xor(4294967295, list_reduce(list_prepend(4294967295,
        list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda s, b: list_reduce(list_prepend(xor(s, b), range(8)),
            lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) % 9 AS h
    FROM turns GROUP BY c
), convs AS (
    SELECT s.c, s.n, s.base, s.h, least(s.h, coalesce(b.n, 0)) AS taken
    FROM sizes s LEFT JOIN sizes b ON b.c = s.base
), rebuilt AS (
    SELECT c, place - h + taken + 1 AS depth, turn_digest, bytes
    FROM placed JOIN convs USING (c) WHERE place >= h
    UNION ALL
    SELECT convs.c, place + 1, turn_digest, bytes
    FROM convs JOIN placed ON placed.c = convs.base WHERE place < taken
    UNION ALL
    SELECT c, 0, '', 0 FROM convs
), paths AS (
    SELECT c, depth, bytes, string_agg(turn_digest, '') OVER (PARTITION BY c ORDER BY depth) AS prefix,
           max(depth) OVER (PARTITION BY c) AS length
    FROM rebuilt
), nodes AS (
    SELECT prefix, depth, min(c) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
           CASE WHEN depth > 0 THEN left(prefix, (64 * (depth - 1))::BIGINT) END AS parent
    FROM paths GROUP BY prefix, depth
), children AS (
    SELECT parent AS prefix, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), below AS (
    SELECT p.prefix, count(*) FILTER (n_children IS NULL) AS n_leaves,
           sum((n_convs - 1) * nodes.bytes) AS saved_tokens
    FROM nodes LEFT JOIN children USING (prefix)
    JOIN paths p ON p.c = nodes.conv_id AND p.depth <= nodes.depth
    GROUP BY p.prefix
), ends AS (
    SELECT prefix, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends_sha256
    FROM paths WHERE depth = length GROUP BY prefix
)
SELECT n.conv_id, n.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs,
       coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
       saved_tokens::BIGINT AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM nodes n LEFT JOIN nodes up ON up.prefix = n.parent LEFT JOIN children ON children.prefix = n.prefix
JOIN below ON below.prefix = n.prefix LEFT JOIN ends ON ends.prefix = n.prefix
"""

OP12_SQL = r"""
WITH words AS (
    SELECT row, doc_id, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT *, row_number() OVER () AS row FROM documents)
), counts AS (
    SELECT row, doc_id, term, count(*) AS tf FROM words WHERE term <> '' GROUP BY ALL
), docs AS (
    SELECT row, sum(tf)::BIGINT AS n FROM counts GROUP BY row
), whole AS (
    SELECT count(*) AS documents, sum(n)::BIGINT AS terms FROM docs
), weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(documents) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM counts, whole GROUP BY term
), asked AS (
    SELECT item_id, term, count(*) AS times FROM (
        SELECT item_id, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT DISTINCT item_id, text FROM benchmark)) WHERE term <> '' GROUP BY ALL
), scored AS (
    SELECT item_id, row, doc_id, sum(times * w * ((1000000000 * tf)
        // (1000 * tf + 8 * (100 - 75 + ((75 * n * documents) // terms)))))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN docs USING (row), whole
    GROUP BY item_id, row, doc_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def oracles() -> dict[str, str]:
    return {
        "op2_merkle_tree": OP2_SQL,
        "op3_site_frequency": OP3_SQL,
        "op4_gzip_normaliser": OP4_SQL,
        "op7_positional_index": OP7_SQL,
        "op11_hash_slot_trie": OP11_SQL,
        "op12_shared_accumulators": OP12_SQL,
    }
