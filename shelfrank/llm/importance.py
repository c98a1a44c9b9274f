"""Quality classifier by importance resampling.

Two hashed n-gram models are counted over whole texts: the target model over documents
labelled good, the raw model over all documents. N-grams are words, word pairs and pairs of
word shapes (case, digits, punctuation, repetition); a document counts each n-gram once, so
that one long document cannot shape a model. A document's log weight is the sum of
log p_target / p_raw over its n-grams that speak: those whose target count differs from the
expectation by ``MIN_DEVIANCE`` nats of Poisson deviance and by a factor of ``MIN_FACTOR``.
Others are noise of the sample, which would otherwise add up in long documents.

Documents are drawn without replacement by Gumbel top-k: a document's chances follow its
importance weight, raised to a power (``sharpness``, a column of the result). k is the size of the
target part: the number of documents whose log weight reaches the threshold that best separates
the labelled documents. The power is the least power of two with which the draw is expected to
lose a share of ``MAX_LOSS`` of the labelled good documents; 1 leaves the weights as they are.
Sampled documents are ``kept``; ``above`` tells which reach the threshold itself.

Nulls: a null text has no n-grams and log weight 0; a null id draws the noise of its text;
labels that are null, or of unknown documents, are ignored; a document is good if some label
row says so and none says otherwise. Without good labels nothing can be
told apart and all rows are kept. Repeated rows get equal weights and noise: ties at the k-th
place are all kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.shared import written

WORD_BITS = 22
PAIR_BITS = 16
SHAPE_BITS = 14
MIN_DEVIANCE = 9.0
MIN_FACTOR = 3.0
# the target model and the threshold are fitted on so many labelled documents at most; the
# raw model counts all documents
MAX_LABELLED = 50_000
SEED = 8
PSEUDO_COUNT = 0.5
CACHED_TOKENS = 120_000
# log weights are binned so finely to find the threshold
BIN = 0.25
MAX_LOSS = 0.0005
SHARPEST = 64
LOWEST = -50.0

PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


class Tokens(dict):
    """Word bucket and shape of a token, remembered: tokens repeat all the time."""

    def __missing__(self, token: str) -> int:
        if len(self) >= CACHED_TOKENS:
            self.clear()
        body = token.rstrip(PUNCTUATION)
        tail = token[len(body) :]
        word = body.lstrip(PUNCTUATION)
        head = body[: len(body) - len(word)]
        if word.islower():
            case = "a"
        elif word.isupper() and len(word) > 1:
            case = "A"
        else:
            case = "0" if word.isdigit() else "Aa" if word else ""
        form = zlib.crc32(f"{head[:2]} {case} {tail[:3]}".encode())
        value = zlib.crc32((word.lower() or token).encode()) & ((1 << WORD_BITS) - 1)
        value |= (form & 0x3FFFFFFF) << WORD_BITS
        self[token] = value
        return value


def ngrams(text: str, tokens: Tokens) -> np.ndarray:
    """Different n-gram buckets of a text: words, then word pairs, then shape pairs."""
    split = text.split()
    if not split:
        return np.empty(0, np.int64)
    packed = np.fromiter(map(tokens.__getitem__, split), np.int64, len(split))
    words = packed & ((1 << WORD_BITS) - 1)
    shapes = packed >> WORD_BITS
    mixed = (words[:-1] * 0x9E3779B1 + words[1:] * 0x85EBCA77) & 0xFFFFFFFF
    pairs = (mixed >> (32 - PAIR_BITS)) + (1 << WORD_BITS)
    repeated = words[:-1] == words[1:]
    formed = (shapes[:-1] * 0x27D4EB2F + shapes[1:] * 0x165667B1 + repeated * 0x2545F491) & 0xFFFFFFFF
    forms = (formed >> (32 - SHAPE_BITS)) + (1 << WORD_BITS) + (1 << PAIR_BITS)
    return np.unique(np.concatenate([words, pairs, forms]))


def counts(documents: DataFrame) -> DataFrame:
    """``bucket, raw, target``: documents, and good documents, with each n-gram.

    Takes ``text`` and the flag ``good``. A task adds up in arrays of fixed size first.
    """

    def of_partition(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = (1 << WORD_BITS) + (1 << PAIR_BITS) + (1 << SHAPE_BITS)
        sums, tokens = np.zeros((2, size), np.int32), Tokens()
        for frame in frames:
            for text, good in zip(frame["text"], frame["good"], strict=True):
                found = ngrams(text, tokens)
                sums[0, found] += 1
                if good:
                    sums[1, found] += 1
        seen = np.flatnonzero(sums[0])
        for some in np.array_split(seen, len(seen) // 100_000 + 1):
            yield pd.DataFrame({"bucket": some, "raw": sums[0, some], "target": sums[1, some]})

    return (
        documents.select(F.coalesce("text", F.lit("")).alias("text"), "good")
        .mapInPandas(of_partition, "bucket long, raw long, target long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    )


def speaking(model: DataFrame) -> pd.DataFrame:
    """``bucket, ratio`` of the n-grams that speak (at most the number of buckets)."""
    total = model.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).first()
    if not total.target:
        return pd.DataFrame({"bucket": np.empty(0, np.int64), "ratio": np.empty(0)})
    expected = F.col("raw") * F.lit(total.target / total.raw)
    seen = F.greatest(F.col("target"), F.lit(1e-9))
    deviance = F.col("target") * F.log(seen / expected) - (F.col("target") - expected)
    ratio = F.log((F.col("target") + PSEUDO_COUNT) / (expected + PSEUDO_COUNT))
    return (
        model.select("bucket", ratio.alias("ratio"), deviance.alias("deviance"))
        .where((F.col("deviance") >= MIN_DEVIANCE) & (F.abs("ratio") >= float(np.log(MIN_FACTOR))))
        .select("bucket", "ratio")
        .toPandas()
        .sort_values("bucket")
    )


def good_documents(labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """``id, good`` by labelled document: good quality and not toxic in all of its rows.

    Of more than ``most`` documents, those with the least hashes: about ``most``.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    each = known.groupBy(F.col("doc_id").alias("id")).agg(F.min(good).alias("good"))
    each = written(each)
    parts = 1 << 20
    share = min(1.0, most / max(each.count(), 1))
    return each.where(F.pmod(F.xxhash64("id"), F.lit(parts)) < int(share * parts))


def weigh(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``row`` (all columns of ``documents``), ``good`` (null: no label) and ``log_weight``."""
    rows = documents.select(
        F.struct("*").alias("row"),
        F.col("doc_id").alias("id"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).join(F.broadcast(good_documents(labels)), "id", "left")
    model = written(counts(rows.select("text", F.coalesce("good", F.lit(False)).alias("good"))))
    chosen = speaking(model)
    bucket, ratio = chosen["bucket"].to_numpy(), chosen["ratio"].to_numpy()
    tokens = Tokens()

    @F.pandas_udf("double")
    def log_weight(texts: pd.Series) -> pd.Series:
        if not len(bucket):
            return pd.Series(0.0, texts.index)
        out = np.zeros(len(texts))
        for i, text in enumerate(texts):
            found = ngrams(text, tokens)
            at = np.minimum(np.searchsorted(bucket, found), len(bucket) - 1)
            out[i] = ratio[at][bucket[at] == found].sum()
        return pd.Series(out, texts.index)

    return rows.select("row", "id", "good", log_weight("text").alias("log_weight"))


def threshold(weighed: DataFrame) -> float:
    """The log weight that separates good from other labelled documents with fewest errors."""
    bins = F.floor(F.greatest("log_weight", F.lit(LOWEST)) / BIN)
    found = (
        weighed.where("good IS NOT NULL")
        .groupBy(bins.alias("bin"))
        .agg(F.sum(F.col("good").cast("long")).alias("good"), F.count("*").alias("all"))
        .toPandas()  # at most (highest - LOWEST) / BIN rows
        .sort_values("bin")
    )
    if found.empty or found["good"].sum() in (0, found["all"].sum()):
        return -np.inf
    good, bad = found["good"].to_numpy(), (found["all"] - found["good"]).to_numpy()
    # errors if all bins from i on are taken: good ones before, others from there
    errors = np.concatenate([[0], np.cumsum(good)[:-1]]) + np.cumsum(bad[::-1])[::-1]
    return float(found["bin"].to_numpy()[errors.argmin()] * BIN)


def tempering(weighed: DataFrame, cut: float) -> int:
    """The power of the weights: see the module. A document of log weight w is drawn with
    probability 1 - exp(-exp(s w - c)), with c such that the probabilities add up to k."""
    found = (
        weighed.groupBy(F.floor(F.greatest("log_weight", F.lit(LOWEST)) / BIN).alias("bin"))
        .agg(
            F.count("*").alias("all"),
            F.sum(F.coalesce(F.col("good"), F.lit(False)).cast("long")).alias("good"),
            F.sum((F.col("log_weight") >= cut).cast("long")).alias("above"),
        )
        .toPandas()  # at most (highest - LOWEST) / BIN rows
    )
    many, good, k = found["all"].to_numpy(), found["good"].to_numpy(), found["above"].sum()
    if not good.sum() or k >= many.sum():
        return 1
    weight, sharpness = found["bin"].to_numpy() * BIN, 1
    while sharpness < SHARPEST:
        low, high = -1e6, 1e6
        for _ in range(100):
            c = (low + high) / 2
            left_out = np.exp(-np.exp(np.clip(sharpness * weight - c, -700, 700)))
            low, high = (c, high) if (many * (1 - left_out)).sum() > k else (low, c)
        if (good * left_out).sum() <= MAX_LOSS * good.sum():
            break
        sharpness *= 2
    return sharpness


def keys(weighed: DataFrame, seed: int = SEED, sharpness: int = 1) -> DataFrame:
    """``weighed`` with ``key``: ``sharpness`` times the log weight plus Gumbel noise from a hash of the seed and id."""
    bits = F.xxhash64(F.lit(seed), F.coalesce("id", F.xxhash64("row.text")))
    uniform = (F.shiftrightunsigned(bits, 11).cast("double") + 0.5) / float(1 << 53)
    return weighed.withColumn("key", F.col("log_weight") * sharpness - F.log(-F.log(uniform)))


def kth_largest(values: DataFrame, k: int, bins: int = 1024) -> float:
    """The k-th largest ``key`` by counting ever finer bins; never sorts the rows."""
    least, most = values.agg(F.min("key"), F.max("key")).first()
    if least is None or k >= values.count():
        return -np.inf
    while True:
        width = (most - least) / bins
        if width <= max(abs(least), abs(most), 1.0) * 1e-15:
            return least
        place = F.least(F.floor((F.col("key") - least) / width), F.lit(bins - 1))
        inside = values.where((F.col("key") >= least) & (F.col("key") <= most))
        found = (
            inside.groupBy(place.alias("bin"))
            .agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
            .toPandas()
            .sort_values("bin", ascending=False)
        )
        upto = found["n"].cumsum().to_numpy()
        at = int(np.searchsorted(upto, k))
        k -= int(upto[at - 1]) if at else 0
        least, most = float(found["low"].iloc[at]), float(found["high"].iloc[at])
        if k == int(found["n"].iloc[at]):
            return least
        if least == most:
            return least


def sample(documents: DataFrame, labels: DataFrame, keep_rows: bool = True) -> DataFrame:
    """``row, id, log_weight, above, kept, sharpness`` for all rows of ``documents``.

    ``keep_rows=False`` leaves all columns but the id out of ``row``.
    """
    weighed = weigh(documents, labels)
    if not keep_rows:
        row = F.struct(F.col("id").alias("doc_id"), F.xxhash64("row.text").alias("text")).alias("row")
        weighed = weighed.select(row, "id", "good", "log_weight")
    weighed = written(weighed)
    cut = threshold(weighed)
    above = F.col("log_weight") >= cut
    k = weighed.where(above).count()
    sharpness = tempering(weighed, cut)
    drawn = keys(weighed, sharpness=sharpness)
    least = kth_largest(drawn.select("key"), k) if k else np.inf
    return drawn.select(
        "row",
        "id",
        "log_weight",
        above.alias("above"),
        (F.col("key") >= least).alias("kept"),
        F.lit(sharpness).alias("sharpness"),
    )


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The sampled rows of ``documents`` with their columns."""
    return sample(documents, labels).where("kept").select("row.*")
