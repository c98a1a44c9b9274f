"""Secrets in texts: fixed formats, and random strings shown by their token efficiency.

A byte-pair vocabulary spells natural words with few tokens and random characters with
many. A run of key-like characters is a secret when its characters per token stay at or
under ``MAX_CHARS_PER_TOKEN``, unless it is a known digest (hex of a digest's length, the
``sha256-…`` forms, a UUID) or an identifier (words joined by ``_``, ``-``, ``/`` or case,
with a number only at the end of a word: base32 has digits amid its letters). A word of an
identifier has few letters, or more than ``WORD_CHARS_PER_TOKEN`` itself: a long run of letters
alone is judged by its ratio like any other.

Rows: one per input row, a null text counting as empty; repeated rows give repeated results.
"""

from __future__ import annotations

import base64
import functools
import re

import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame

from shelfrank.llm.shared import Span, joined, map_texts, sha256

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "random")
MAX_CHARS_PER_TOKEN = 2.4
MIN_RANDOM_CHARS = 20
VOCABULARY = "byte_bpe_50k.tiktoken"

# fixed formats
ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # leftmost and greedy, so whole runs of 24 or more

# ``=`` is only padding behind a run; before one it assigns, as in KEY=… or ?sig=…
RUN = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{MIN_RANDOM_CHARS},}}={{0,2}}")
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
DIGEST_CHARS = (32, 40, 56, 64, 96, 128)  # hex lengths of MD5, SHA-1 and the SHA-2 family
NAMED_DIGEST = re.compile(r"(?:md5|sha1|sha256|sha384|sha512)-[A-Za-z0-9+/]+={0,2}")
# words of one case, or numbers, between separators or at a change of case; behind a number
# only a separator or a capitalised word. Possessive, so a long run costs time in proportion
WORDS = re.compile(r"(?:[A-Z]?[a-z]{2,}+|[A-Z]{2,}+|[0-9]++(?![a-z]|[A-Z](?![a-z]))|[+/_=-])+")
LONG_WORD = 16  # words of fewer letters pass as parts of an identifier
WORD_CHARS_PER_TOKEN = 2.1  # words are spelled with fewer tokens than the run as a whole
# token counts are summed over pieces of this many characters, so that a run of any
# length costs time in proportion
PIECE = 256


@functools.cache
def vocabulary(name: str = VOCABULARY) -> tiktoken.Encoding:
    with open(public_tokenizers.path(name), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def base_spans(text: str) -> list[Span]:
    found = []
    if "=" in text or ":" in text:
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def known(run: str, name: str = VOCABULARY) -> bool:
    """Digests and identifiers, which look random or long but are no secrets."""
    bare = run.strip("=")
    if len(bare) in DIGEST_CHARS and re.fullmatch("[0-9a-f]+|[0-9A-F]+", bare):
        return True
    if UUID.fullmatch(run) or NAMED_DIGEST.fullmatch(run):
        return True
    if WORDS.fullmatch(run) is None:
        return False
    long_words = re.findall(rf"[A-Za-z]{{{LONG_WORD},}}", run)
    return all(chars_per_token(word, name) > WORD_CHARS_PER_TOKEN for word in long_words)


def chars_per_token(run: str, name: str = VOCABULARY) -> float:
    encode = vocabulary(name).encode_ordinary
    tokens = sum(len(encode(run[i : i + PIECE])) for i in range(0, len(run), PIECE))
    return len(run) / tokens


def random_spans(text: str, name: str = VOCABULARY) -> list[Span]:
    found = []
    for match in RUN.finditer(text):
        if not known(match[0], name) and chars_per_token(match[0], name) <= MAX_CHARS_PER_TOKEN:
            found.append(("random", *match.span()))
    return found


def scan(text: str, name: str = VOCABULARY) -> tuple:
    base = base_spans(text)
    counts = [sum(s[0] == kind for s in base) for kind in BASE_KINDS]
    extra = random_spans(text, name)
    return (
        *counts,
        sha256(joined(base, KINDS)),
        joined(base + extra, KINDS),
        len(extra),
    )


def find_secrets(
    df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary_name: str = VOCABULARY
) -> DataFrame:
    """Counts and spans of secrets for each row (offsets in code points, end exclusive)."""
    schema = (
        "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"
    )
    return map_texts(df, key, text, schema, lambda x: scan(x, vocabulary_name))
