"""Lists, contexts and product sums inside nested rows, against the exploded log."""

import random

import pytest
from pyspark.sql import functions as F

from shelfrank.operators import catalog, insession, sessions
from shelfrank.schemas import SESSIONS

PRODUCT = ("sku", "name", "category", "price_micros", "is_click", "is_impression")


def log(spark, seed=1, many=80):
    draw = random.Random(seed)
    pages = ["/google+redesign/shop/a+b", "/google+redesign/shop/red+t shirts.axd", "/google+redesign/home", "/x.html", None]

    def product():
        sku = draw.choice(["p1", "p2", "p3", "p4", "p5", "p6", "(not set)", None])
        return {
            "sku": sku, "name": draw.choice(["n", None]), "category": "a/b", "price_micros": draw.choice([None, 1500000, 99]),
            "is_click": draw.choice([True, None, False]), "is_impression": draw.choice([True, None]),
        }

    rows = []
    for n in range(many):
        hits = [
            {"pagepath": draw.choice(pages), "action_type": draw.choice(["0", "6", None, "0"]),
             "product": draw.choice([None, [product() for _ in range(draw.randrange(9))]])}
            for _ in range(draw.randrange(7))
        ]
        rows.append({"fv": n % 9, "session_id": n, "session_date": None, "channel": draw.choice(["Direct", None]), "hits": hits})
    return spark.createDataFrame([as_schema(r, SESSIONS) for r in rows], SESSIONS)


def as_schema(value, kind):
    """A value with the fields, and the types of keys, that a schema names."""
    if value is None:
        return None
    if hasattr(kind, "fields"):
        return {f.name: as_schema(value.get(f.name), f.dataType) for f in kind.fields}
    if hasattr(kind, "elementType"):
        return [as_schema(x, kind.elementType) for x in value]
    return str(value) if kind.simpleString() == "string" else value


def same(a, b):
    def rounded(df):
        return sorted(
            (tuple((k, round(v, 6) if isinstance(v, float) else v) for k, v in sorted(r.asDict().items())) for r in df.collect()),
            key=str,
        )

    return rounded(a) == rounded(b)


@pytest.mark.parametrize("rate", [1.0, 0.3])
def test_lists(spark, rate):
    nested = log(spark)
    own = insession.session_lists(nested, rate, min_docs=1)
    expected = sessions.session_lists(sessions.explode_sessions(nested), rate, min_docs=1)
    assert own.columns == expected.columns and own.count() > 5
    assert same(own, expected)
    short = insession.session_lists(nested, rate, min_docs=2, max_docs=3)
    assert same(short, sessions.session_lists(sessions.explode_sessions(nested), rate, min_docs=2, max_docs=3))


def test_contexts_and_products(spark):
    nested = log(spark, seed=2)
    hits = sessions.explode_sessions(nested)
    assert same(insession.visitor_context(nested), sessions.visitor_context(hits))
    assert same(insession.product_channel(nested), catalog.product_channel(hits))
    assert same(
        insession.rolled_docs(nested).select("session_id", "fv", "channel", "doc", "query", "click", "seen", "purchase"),
        sessions.rolled_docs(hits).select("session_id", "fv", "channel", "doc", "query", "click", "seen", "purchase"),
    )


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_hit_is_shuffled(spark):
    nested = log(spark)
    for df in (insession.session_lists(nested), insession.product_channel(nested), insession.rolled_docs(nested)):
        assert "Exchange" not in plan(df)
    # a visitor's sessions meet, one row each
    assert plan(insession.visitor_context(nested)).count("Exchange") == 1


def test_empty_log(spark):
    nested = log(spark).where(F.lit(False))
    assert insession.session_lists(nested).count() == 0
    assert insession.visitor_context(nested).count() == 0
    assert insession.product_channel(nested).count() == 0
