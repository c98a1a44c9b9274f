"""Personal data: generous generators propose spans, boosted trees decide, thresholds select.

The base formats (``email``, ``ip``, ``card``, ``phone``) are redacted wherever they are
valid. Generators of high recall also propose spans that are personal only in the right
setting: phone numbers without a country code, identity numbers, bank accounts, spelled-out
mail addresses, long numbers, cards inside longer runs of digits. Proposals may overlap. Gradient-boosted trees score each from
its format and the words around it; a proposal is selected when its score reaches the
threshold of its kind, calibrated on held-out spans to ``PRECISION``. Of overlapping
selections the best score stays; base spans always stay and are never covered again.

The trees learn from ``TRAINING_SPANS`` labelled spans that ``labelled`` makes from a seed
(personal and harmless settings of the same formats), and from spans of at most about
``TRAINING_DOCUMENTS`` documents, drawn by a hash of the text: proposals over valid base spans
are personal, those in strings of a base format that fail its check are not. They show the
trees what else stands around such strings in these documents, and how far a check can be
trusted there. Not more than ``SPANS_PER_CLASS`` spans of a kind and label are used; a sample,
bounded at any size.

Rows: one per input row, a null text counting as empty; repeated rows give repeated results.
"""

from __future__ import annotations

import functools
import random
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.llm import boosting
from shelfrank.llm.shared import Span, joined, map_texts, sha256

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("spelled_email", "local_phone", "identity", "iban", "number", "card_part")
KINDS = BASE_KINDS + MORE_KINDS
TRAINING_SPANS = 6000
TRAINING_DOCUMENTS = 20_000
SPANS_PER_CLASS = 400
TREES = 60
PRECISION = 0.98
CONTEXT = 40  # characters looked at on either side

# fixed formats; possessive and anchored so that a long run costs time in proportion
LOCAL_PART = re.compile(r"[A-Za-z0-9._%+-]+\Z")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# proposals
SPELLED = re.compile(r"[\[({ ][aA][tT][\])} ]")
SPELLED_LOCAL = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?\Z")
SPELLED_DOMAIN = re.compile(r"(?i) ?[a-z0-9-]{1,63}(?:(?: ?[\[({]dot[\])}] ?| dot |\.)[a-z0-9-]{1,63}){1,5}")
LOCAL_PHONE = re.compile(r"(?<![0-9])\(?[0-9]{2,4}\)?[ ./-]{1,2}[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])")
IDENTITY = re.compile(r"(?<![0-9])[0-9]{3}[ -][0-9]{2}[ -][0-9]{4}(?![0-9])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
NUMBER = re.compile(r"(?<![0-9.,-])[0-9]{7,19}(?![0-9])")

DIGITS = re.compile(r"[0-9]+")
RUN_BEFORE = re.compile(r"[0-9 -]*\Z")
RUN_AFTER = re.compile(r"[0-9 -]*")

# words near a span, by what they speak for
CUES = {
    "phone": "phone|tel|call|mobile|cell|fax|whatsapp|dial|sms|ring",
    "mail": "mail|contact|write|reach|reply",
    "identity": "ssn|social security|passport|identity|national id|licen[cs]e no|tax id|born",
    "bank": "iban|bank|account|acct|transfer|bic|swift|pay",
    "person": "my |mr |mrs |ms |name|owner|holder|patient|customer",
    "harmless": "order|invoice|version|isbn|sku|ref|serial|part|page|track|build|item|batch|"
    "model|case|ticket|score|pixel|total|count|look|arrive|meet|commit",
}
CUE_PATTERNS = [re.compile(rf"(?i)\b(?:{words})") for words in CUES.values()]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[Span]:
    """Leftmost matches, found from each ``@`` outwards."""
    found, behind, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > behind and text[start - 1] in LOCAL_CHARS:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append(("email", start, domain.end()))
            behind = domain.end()
        else:
            behind = max(behind, at + 1)
        at = text.find("@", max(at + 1, behind))
    return found


def base_spans(text: str) -> list[Span]:
    found = emails(text)
    for m in IP.finditer(text):
        # leading zeros count for nothing; the length guard keeps int() short
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        # 12 to 19 digits with single separators
        if 12 <= m.end() - m.start() <= 37:
            digits = digits_of(m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(digits_of(m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


def card_parts(text: str) -> list[Span]:
    """Groups of digits inside a run too long for one card that could be a card each."""
    found = []
    for m in CARD.finditer(text):
        if m.end() - m.start() < 24:
            continue
        groups = [(g.start(), g.end()) for g in DIGITS.finditer(text, *m.span())]
        if sum(b - a for a, b in groups) <= 19:
            continue
        for first in range(len(groups)):
            size = 0
            for a, b in groups[first:]:
                size += b - a
                if size > 19:
                    break
                if size >= 13 and luhn(digits_of(text[groups[first][0] : b])):
                    found.append(("card_part", groups[first][0], b))
    return found


def proposals(text: str) -> list[Span]:
    found = card_parts(text)
    for m in SPELLED.finditer(text):
        local = SPELLED_LOCAL.search(text[max(0, m.start() - 66) : m.start()])
        domain = SPELLED_DOMAIN.match(text, m.end())
        if local and domain:
            found.append(("spelled_email", m.start() - len(local[0]), domain.end()))
    for kind, pattern in (
        ("local_phone", LOCAL_PHONE),
        ("identity", IDENTITY),
        ("iban", IBAN),
        ("number", NUMBER),
    ):
        found += [(kind, *m.span()) for m in pattern.finditer(text)]
    return found


def mod97(text: str) -> bool:
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def tiled(text: str, start: int, end: int) -> bool:
    """Whether the run of digits around a span is cards of its length, one after the other."""
    size = len(digits_of(text[start:end]))
    before = digits_of(RUN_BEFORE.search(text[max(0, start - CONTEXT) : start])[0])
    after = digits_of(RUN_AFTER.match(text[end : end + CONTEXT])[0])
    parts = [x[i : i + size] for x in (before, after) for i in range(0, len(x), size)]
    return bool(parts) and all(len(x) == size and luhn(x) for x in parts)


def features(text: str, span: Span) -> list[float]:
    """Format of the span and its setting."""
    kind, start, end = span
    own, digits = text[start:end], digits_of(text[start:end])
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    separators = [c for c in own if not c.isalnum()]
    return [
        *(kind == k for k in MORE_KINDS),
        len(own),
        len(digits),
        len(digits) / len(own),
        sum(c.isupper() for c in own),
        len(separators),
        len(set(separators)),
        len(set(digits)),
        "(" in own,
        any(c in own for c in "[{") or " dot " in own.lower(),
        own[:1] == "0",
        bool(digits) and luhn(digits),
        len(digits) >= 12 and luhn(digits),
        kind == "iban" and mod97(own),
        kind == "card_part" and digits[:1] in "3456",
        kind == "card_part" and {len(g) for g in DIGITS.findall(own)} <= {4},
        kind == "card_part" and not before.rstrip(" -")[-1:].isdigit(),
        kind == "card_part" and tiled(text, start, end),
        digits[:3] in ("000", "666") or digits[:1] == "9" or digits[3:5] == "00",
        before[-1:].isalnum() or after[:1].isalnum(),
        before.rstrip()[-1:] in "#$€£=v" and before.strip() != "",
        before.rstrip()[-1:] == ":",
        *(p.search(before) is not None for p in CUE_PATTERNS),
        *(p.search(after) is not None for p in CUE_PATTERNS),
    ]


def labelled(rows: int = TRAINING_SPANS, seed: int = 17) -> tuple[list[tuple[str, Span]], list[bool]]:
    """Texts with one span each, and whether it is personal."""
    rng = random.Random(seed)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("aeioulnrstdmch") for _ in range(rng.randint(2, 9)))
    prose = lambda: " ".join(word() for _ in range(rng.randint(1, 8)))

    def iban(valid: bool) -> str:
        country, body = rng.choice(["DE", "FR", "ES", "GB"]), number(18)
        check = 98 - int(body + "".join(str(int(c, 36)) for c in country) + "00") % 97
        check = check if valid else (check + rng.randint(1, 90)) % 97
        plain = f"{country}{check:02d}{body}"
        return " ".join(plain[i : i + 4] for i in range(0, len(plain), 4)) if rng.random() < 0.5 else plain

    def identity() -> str:
        sep = rng.choice("- ")
        return f"{rng.randint(100, 665)}{sep}{rng.randint(10, 99)}{sep}{number(4)}"

    def local() -> str:
        a, b, c = number(3), number(3), number(4)
        return rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}"])

    def spelled() -> str:
        at, dot = rng.choice([(" [at] ", " [dot] "), (" at ", " dot "), (" (at) ", "."), ("[at]", "[dot]")])
        return f"{word()}{at}{word()}{dot}{rng.choice(['com', 'org', 'net', 'de'])}"

    def card() -> str:
        body = rng.choice("3456") + number(14)
        return body + next(c for c in "0123456789" if luhn(body + c))

    def doubled(good: bool) -> tuple[str, int, int]:
        """A run of digits, and a part of it that passes the check of cards."""
        sep, width = rng.choice("  -"), rng.choice([4, 16])
        while True:
            first = card()
            cards = good or rng.random() < 0.3
            digits = first + (first if rng.random() < 0.6 else card()) if cards else number(16 * rng.randint(2, 3))
            run = sep.join(digits[i : i + width] for i in range(0, len(digits), width))
            parts = [(a, b) for _, a, b in card_parts(run)]
            # whole cards, or parts that only happen to pass
            whole = [(a, b) for a, b in parts if len(digits_of(run[:a])) % 16 == 0 == len(digits_of(run[:b])) % 16]
            wanted = whole if good else [x for x in parts if not (cards and x in whole)]
            if wanted:
                return run, *rng.choice(wanted)

    def plain_number() -> str:
        """Long digits that no base format takes for a card."""
        digits = number(rng.randint(7, 19))
        return plain_number() if len(digits) >= 12 and luhn(digits) else digits

    personal = {
        "local_phone": (local, ["call me on", "my phone number is", "tel:", "mobile", "fax"]),
        "identity": (identity, ["SSN", "social security number", "tax id:", "passport", "national id"]),
        "iban": (lambda: iban(True), ["IBAN", "my bank account", "transfer to", "", "pay to"]),
        "number": (lambda: number(rng.randint(8, 12)), ["account number", "phone", "passport", "my bank account is"]),
        "spelled_email": (spelled, ["mail me at", "contact", "write to", "", "reach me:"]),
    }
    harmless = {
        "local_phone": (local, ["order", "serial", "", "score", "ref #", "part"]),
        "identity": (identity, ["", "part", "item no", "ref", "batch", "invoice"]),
        "iban": (lambda: iban(False), ["", "serial", "model", "order", "IBAN"]),
        "number": (plain_number, ["", "order", "", "ticket", "track", "$", "isbn", "version"]),
        "spelled_email": (lambda: f"{word()} at {word()}.{word()}", ["look", "we", "", "arrive", "meet"]),
    }
    texts, marks = [], []
    for i in range(rows):
        kind, good = MORE_KINDS[i % len(MORE_KINDS)], rng.random() < 0.5
        if kind == "card_part":
            run, a, b = doubled(good)
            lead = f"{prose()} {rng.choice(['', 'card', 'pay with', 'visa', 'order', 'id'])} ".replace("  ", " ")
            texts.append((f"{lead}{run} {prose()}", (kind, len(lead) + a, len(lead) + b)))
            marks.append(good)
            continue
        make, cues = (personal if good else harmless)[kind]
        own, cue = make(), rng.choice(cues)
        lead = f"{prose()} {cue} ".replace("  ", " ") if rng.random() < 0.9 else f"{cue} ".lstrip()
        texts.append((f"{lead}{own} {prose()}", (kind, len(lead), len(lead) + len(own))))
        marks.append(good)
    return texts, marks


def overlaps(taken: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether a span overlaps one of the sorted, disjoint spans ``taken``."""
    at = bisect_left(taken, (start, start))
    return bool(at and taken[at - 1][1] > start or at < len(taken) and taken[at][0] < end)


def labelled_spans(text: str) -> list[tuple[Span, bool]]:
    """Proposals of a document's text that its base formats tell to be personal, or not."""
    found = proposals(text)
    if not found:
        return []
    right = sorted((a, b) for kind, a, b in base_spans(text) if kind in ("card", "phone"))
    wrong = []
    for m in CARD.finditer(text):
        digits = digits_of(m[0]) if m.end() - m.start() <= 37 else ""
        if 12 <= len(digits) <= 19 and not luhn(digits):
            wrong.append(m.span())
    out = []
    for span in found:
        _, start, end = span
        if overlaps(right, start, end):
            out.append((span, True))
        elif overlaps(wrong, start, end):
            out.append((span, False))
    return out


def document_spans(
    df: DataFrame, text: str, documents: int = TRAINING_DOCUMENTS, each: int = SPANS_PER_CLASS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and kinds of ``labelled_spans`` of about ``documents`` documents.

    At most ``each`` spans of a kind and label, those of least hashes, come to the driver.
    """
    parts = 1 << 30
    share = min(1.0, documents / max(df.count(), 1))
    digest = F.xxhash64(F.col(text))
    chosen = df.where(F.pmod(digest, F.lit(parts)) <= int(share * parts)).select(
        F.col(text).alias("text")
    ).where("text IS NOT NULL").distinct()

    def spans(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [
                (span[0], good, zlib.crc32(f"{span} {one[span[1]:span[2]]}".encode()), features(one, span))
                for one in frame["text"]
                for span, good in labelled_spans(one)
            ]
            yield pd.DataFrame(rows, columns=["kind", "good", "hash", "features"])

    found = chosen.mapInPandas(spans, "kind string, good boolean, hash long, features array<double>")
    order = Window.partitionBy("kind", "good").orderBy("hash", "features")
    kept = found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= each).collect()
    x = np.array([r["features"] for r in kept], float)  # nothing to stack where no span was found
    return x, np.array([r["good"] for r in kept], float), np.array([r["kind"] for r in kept], object)


Model = tuple[boosting.Boosted, dict[str, float]]


def fitted(rows: int, more: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> Model:
    """Trees fitted on two thirds of the labelled spans, thresholds from the rest."""
    texts, marks = labelled(rows)
    x = np.array([features(*t) for t in texts], float)
    y, kinds = np.array(marks, float), np.array([span[0] for _, span in texts], object)
    if more is not None and len(more[1]):
        x, y, kinds = (np.concatenate(pair) for pair in zip((x, y, kinds), more, strict=True))
    held = np.random.default_rng(5).random(len(y)) < 1 / 3
    trees = boosting.fit(x[~held], y[~held], trees=TREES)
    score = trees.score(x[held])
    thresholds = {
        kind: boosting.calibrated_threshold(score[kinds[held] == kind], y[held][kinds[held] == kind], PRECISION)
        for kind in MORE_KINDS
    }
    return trees, thresholds


@functools.cache
def model(rows: int = TRAINING_SPANS) -> Model:
    """The model of generated spans alone."""
    return fitted(rows)


def selected(text: str, base: list[Span], known: Model) -> list[Span]:
    """Proposals the trees accept, without overlaps."""
    found = proposals(text)
    if not found:
        return []
    taken = sorted((start, end) for _, start, end in base)
    trees, thresholds = known
    score = trees.score(np.array([features(text, s) for s in found], float))
    best = sorted(
        (-value, span[1], span[2], span[0])
        for value, span in zip(score, found, strict=True)
        if value >= thresholds[span[0]]
    )
    return without_overlaps(best, taken)


def without_overlaps(best: list[tuple], taken: list[tuple[int, int]]) -> list[Span]:
    """The best first, each that overlaps nothing in ``taken`` (sorted) or kept before."""
    kept = []
    for _, start, end, kind in best:
        if overlaps(taken, start, end):
            continue
        insort(taken, (start, end))
        kept.append((kind, start, end))
    return kept


def scan(text: str, known: Model | None = None) -> tuple:
    base = base_spans(text)
    extra = selected(text, base, known or model())
    counts = [sum(s[0] == kind for s in base) for kind in BASE_KINDS]
    return (*counts, sha256(joined(base, KINDS)), joined(base + extra, KINDS), len(extra))


def find_personal_data(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    training_spans: int = TRAINING_SPANS,
    training_documents: int = TRAINING_DOCUMENTS,
) -> DataFrame:
    """Counts and spans of personal data for each row (code points, end exclusive)."""
    schema = (
        "n_email long, n_ip long, n_card long, n_phone long, "
        "base_sha256 string, spans string, n_more long"
    )
    known = fitted(training_spans, document_spans(df, text, training_documents))
    return map_texts(df, key, text, schema, lambda x: scan(x, known))


def redact(text: str, spans: str) -> str:
    """``text`` with each span of a ``spans`` column replaced by its kind."""
    out, at = [], 0
    for item in spans.split(",") if spans else []:
        kind, start, end = item.split(":")
        if int(end) > at:
            out += [text[at : max(at, int(start))], f"[{kind}]"]
            at = int(end)
    return "".join([*out, text[at:]])
