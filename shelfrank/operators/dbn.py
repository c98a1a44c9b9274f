"""Dynamic Bayesian network click model (Chapelle and Zhang, 2009), fitted by EM.

A user goes down the list. Each examined document attracts a click with
probability alpha; a click satisfies with probability sigma and ends the list;
otherwise the user goes on with probability gamma. alpha and sigma belong to a
(search, document) pair, gamma is shared. A purchase means satisfied.

Down to the last click of a list everything is observed, so those rows add the
same counts in every round and are summed once. Only the *tail* (last click and
what follows) depends on the parameters; equal tails of a search are fitted once
with a weight.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.functions.text import format_context_key
from shelfrank.session import cut_lineage

# rows of one (search, document) pair that go into one task of the parameter join
ROWS_PER_SALT = 250_000


def _fixed_counts(lists: DataFrame, keys: Sequence[str]) -> DataFrame:
    above = F.col("list_pos") <= F.col("last_click")
    at_last = F.col("list_pos") == F.col("last_click")
    one = F.lit(1.0)
    zero = F.lit(0.0)
    return lists.groupBy(*keys, "doc").agg(
        F.sum(F.when(above, F.col("click")).otherwise(0)).cast("double").alias("alpha_fixed"),
        F.count("*").cast("double").alias("alpha_total"),
        F.sum(F.when(at_last & (F.col("purchase") == 1), one).otherwise(zero)).alias("sigma_fixed"),
        F.sum("click").cast("double").alias("sigma_total"),
        F.sum(F.when(F.col("list_pos") < F.col("last_click"), one).otherwise(zero)).alias(
            "gamma_fixed"
        ),
        F.sum(F.when(~above | (at_last & (F.col("purchase") == 0)), 1).otherwise(0)).alias(
            "tail_rows"
        ),
    )


def _tails(lists: DataFrame, pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct tails with their weight, one row per tail; arrays are list-bounded."""
    list_keys = ["session_id", "query"]
    rows = lists.filter(F.col("list_pos") >= F.col("last_click")).select(
        *list_keys,
        *[key for key in keys if key not in list_keys],
        "doc",
        "list_pos",
        (F.col("list_pos") == F.col("last_click")).alias("is_head"),
        (F.col("purchase") == 1).alias("bought"),
    )
    numbered = rows.join(pairs.select(*keys, "doc", "pair"), [*keys, "doc"])
    entry = F.struct("list_pos", "pair")
    per_list = numbered.groupBy(*list_keys).agg(
        F.max(F.when(F.col("is_head"), F.col("pair"))).alias("head"),
        F.max(F.when(F.col("is_head"), F.col("bought")).otherwise(F.lit(False))).alias("bought"),
        F.array_sort(F.collect_list(F.when(~F.col("is_head"), entry))).alias("rest"),
    )
    return (
        per_list.select(
            "head", "bought", F.transform("rest", lambda place: place["pair"]).alias("rest")
        )
        # bought at the end of the list: nothing left to infer
        .filter(~(F.col("bought") & (F.size("rest") == 0)))
        .groupBy("head", "bought", "rest")
        .agg(F.count("*").cast("double").alias("weight"))
        .withColumn("tail", F.monotonically_increasing_id())
    )


def _examined(alphas: Column, sigma: Column, bought: Column, has_head: Column, gamma: Column):
    """Probability that each place after the last click was examined.

    ``quiet[r]`` is the probability of no click from place r on, given that r is
    examined; ``reach[r]`` that the user comes from the head to r without one.
    """
    # quiet[r] = (1 - alpha_r) (1 - gamma + gamma quiet[r+1]), quiet after the end is 1
    quiet = F.aggregate(
        F.reverse(alphas),
        F.array(F.lit(1.0)),
        lambda acc, alpha: F.concat(
            F.array((1 - alpha) * (1 - gamma + gamma * acc[0])), acc
        ),
    )
    reach = F.aggregate(
        alphas,
        F.array(F.lit(1.0)),
        lambda acc, alpha: F.concat(
            acc, F.array(F.element_at(acc, -1) * gamma * (1 - alpha))
        ),
    )
    size = F.size(alphas)
    go_on = F.when(has_head, (1 - sigma) * gamma).otherwise(F.lit(1.0))
    evidence = (
        F.when(~has_head, quiet[0])
        .when(size == 0, F.lit(1.0))
        .otherwise(sigma + (1 - sigma) * (1 - gamma + gamma * quiet[0]))
    )
    # the evidence of an observed list is positive but may underflow
    start = F.when(bought, F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(go_on, evidence), F.lit(0.0))
    )
    seen = F.zip_with(
        F.slice(reach, F.lit(1), size),
        F.slice(quiet, F.lit(1), size),
        lambda reached, silent: reached * silent * start,
    )
    satisfied = F.when(bought, F.lit(1.0)).otherwise(
        F.coalesce(F.try_divide(sigma, evidence), F.lit(0.0))
    )
    return seen, satisfied


def _expectation() -> Callable[[DataFrame, DataFrame], DataFrame]:
    """The E-step: expected numerators per pair, and gamma's on the NULL pair.

    The expressions are the same in every round, so they are built once; gamma
    comes in as a column next to alpha and sigma.
    """
    first_doc = F.get("docs", F.lit(0))
    has_head = first_doc["place"] == 0
    split = [
        "weight",
        "bought",
        first_doc["gamma"].alias("gamma"),
        has_head.alias("has_head"),
        F.when(has_head, first_doc).alias("head"),
        F.filter("docs", lambda doc: doc["place"] > 0).alias("rest"),
    ]
    seen, satisfied = _examined(
        F.transform("rest", lambda doc: doc["alpha"]),
        F.col("head.sigma"),
        F.col("bought"),
        F.col("has_head"),
        F.col("gamma"),
    )
    nothing = F.lit(0.0)

    def entry(pair, alpha_part, sigma_part, gamma_part, gamma_total):
        return F.struct(
            pair.alias("pair"),
            alpha_part.alias("alpha_part"),
            sigma_part.alias("sigma_part"),
            gamma_part.alias("gamma_part"),
            gamma_total.alias("gamma_total"),
        )

    weight = F.col("weight")
    below = F.zip_with(
        "rest",
        "seen",
        lambda doc, prob: entry(
            doc["pair"], weight * doc["alpha"] * (1 - prob), nothing, nothing, nothing
        ),
    )
    head = F.when(
        F.col("has_head") & ~F.col("bought"),
        F.array(
            entry(F.col("head.pair"), nothing, weight * F.col("satisfied"), nothing, nothing)
        ),
    )
    total = F.aggregate("seen", nothing, lambda acc, prob: acc + prob)
    first = F.coalesce(F.get("seen", F.lit(0)), nothing)
    last = F.coalesce(F.get("seen", F.size("seen") - 1), nothing)
    # places with a successor: the head (when the list goes on) and all but the last
    went_on = F.when(F.col("has_head"), total).otherwise(total - first)
    could = total - last + F.when(
        F.col("has_head") & (F.size("rest") > 0), 1 - F.col("satisfied")
    ).otherwise(nothing)
    no_pair = F.lit(None).cast("bigint")
    shared = F.array(entry(no_pair, nothing, nothing, weight * went_on, weight * could))
    none = F.filter(shared, lambda unused: F.lit(False))
    parts = F.explode(F.concat(below, F.coalesce(head, none), shared)).alias("part")
    documents = F.array_sort(
        F.collect_list(F.struct("place", "pair", "alpha", "sigma", "gamma"))
    ).alias("docs")
    sums = [
        F.sum(name).alias(name)
        for name in ("alpha_part", "sigma_part", "gamma_part", "gamma_total")
    ]
    solved = {"seen": seen, "satisfied": satisfied}

    def step(tails_long: DataFrame, parameters: DataFrame) -> DataFrame:
        return (
            tails_long.join(parameters, ["pair", "salt"])
            .groupBy("tail", "weight", "bought")
            .agg(documents)
            .select(*split)
            .withColumns(solved)
            .select(parts)
            .select("part.*")
            .groupBy("pair")
            .agg(*sums)
        )

    return step


def dbn_em(
    lists: DataFrame,
    keys: Sequence[str],
    iterations: int = 10,
    alpha: float = 0.5,
    sigma: float = 0.5,
    gamma: float = 0.9,
    smoothing: bool = False,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Fit the model; returns ``keys, doc, alpha, sigma, gamma, judgment``.

    ``lists`` has the columns of :func:`session_lists` (plus ``keys``).
    ``smoothing`` adds one success and one failure to every ratio.
    """
    spare = F.lit(1.0 if smoothing else 0.0)
    lists = lists.select(
        *dict.fromkeys([*keys, "session_id", "query"]),
        "doc",
        "click",
        "purchase",
        "list_pos",
        "last_click",
    )
    salts = F.greatest(F.ceil(F.col("tail_rows") / F.lit(rows_per_salt)), F.lit(1)).cast("int")
    lists = cut_lineage(lists)
    pairs = cut_lineage(
        _fixed_counts(lists, keys)
        .withColumn("salts", salts)
        .withColumn("pair", F.monotonically_increasing_id())
    )
    gamma_fixed = pairs.agg(F.sum("gamma_fixed")).first()[0] or 0.0

    tails = cut_lineage(_tails(lists, pairs, keys))
    head = F.when(F.col("head").isNotNull(), F.array("head"))
    none = F.filter("rest", lambda unused: F.lit(False))
    shift = F.when(F.col("head").isNotNull(), F.lit(0)).otherwise(F.lit(1))
    tails_long = (
        tails.select(
            "tail",
            "weight",
            "bought",
            shift.alias("shift"),
            F.posexplode(F.concat(F.coalesce(head, none), "rest")).alias("at", "pair"),
        )
        .withColumn("place", F.col("at") + F.col("shift"))
        .join(pairs.select("pair", "salts"), "pair")
        .withColumn("salt", F.pmod(F.xxhash64("tail"), F.col("salts")).cast("int"))
        .select("tail", "weight", "bought", "place", "pair", "salt")
        # one layout for all rounds: a round moves parameters, not the lists
        .repartition("pair", "salt")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )

    def ratio(part: Column, total: Column) -> Column:
        top, bottom = part + spare, total + 2 * spare
        return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))

    update = {
        "alpha": ratio(
            F.col("alpha_fixed") + F.coalesce("alpha_part", F.lit(0.0)), F.col("alpha_total")
        ),
        "sigma": ratio(
            F.col("sigma_fixed") + F.coalesce("sigma_part", F.lit(0.0)), F.col("sigma_total")
        ),
    }
    expect = _expectation()
    each_salt = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    fitted = pairs.withColumns({"alpha": F.lit(float(alpha)), "sigma": F.lit(float(sigma))})
    for _ in range(iterations):
        salted = fitted.select("pair", "alpha", "sigma", F.lit(gamma).alias("gamma"), each_salt)
        # one small row per pair; the next round starts from this table
        counts = cut_lineage(expect(tails_long, salted))
        shared = counts.filter(F.col("pair").isNull()).select("gamma_part", "gamma_total").first()
        went_on, could = shared or (0.0, 0.0)
        bonus = 1.0 if smoothing else 0.0
        bottom = gamma_fixed + could + 2 * bonus
        gamma = (gamma_fixed + went_on + bonus) / bottom if bottom > 0 else gamma
        part = counts.filter(F.col("pair").isNotNull()).select("pair", "alpha_part", "sigma_part")
        fitted = pairs.join(part, "pair", "left").withColumns(update)
    tails_long.unpersist()
    return fitted.select(
        *keys,
        "doc",
        "alpha",
        "sigma",
        F.lit(gamma).alias("gamma"),
        (F.col("alpha") * F.col("sigma")).alias("judgment"),
    )


def export_judgments(judgments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Long form with one text key per search, as the judgment files hold it."""
    return judgments.select(format_context_key(list(keys)).alias("key"), "doc", "judgment")
